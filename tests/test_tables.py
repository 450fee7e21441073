import pytest
from pyspark.sql import functions as F

from recordhaul.operators import dedup, paging
from recordhaul.plans.duplicates import find_duplicates
from recordhaul.schemas import ARTICLE_MAPPING, mapping_fields, mapping_schema
from recordhaul.sinks.manifest import add_to_manifest, pending_files, read_manifest
from recordhaul.sinks.messages import broker_write_options
from recordhaul.sinks.tables import append_table, full_refresh, jdbc_write_options, read_refreshed, refresh
from recordhaul.sources.messages import broker_options
from recordhaul.sources.tables import jdbc_read_options, read_table


def keys(spark):
    """One key holds a third of the rows, another is null."""
    n = F.col("id")
    key = F.when(n % 3 == 0, "hot").when(n < 10, None).otherwise(F.concat(F.lit("k"), n % 100))
    return spark.range(0, 3000, 1, 5).select("id", key.alias("origin_id"))


def test_key_counts(spark):
    counts = {row["origin_id"]: row["n"] for row in dedup.key_counts(keys(spark), "origin_id").collect()}
    assert counts["hot"] == 1000
    assert counts[None] == 6
    assert sum(counts.values()) == 3000
    single = keys(spark).unionAll(spark.createDataFrame([(9999, "once")], "id long, origin_id string"))
    found = {row["origin_id"] for row in dedup.duplicate_keys(single, "origin_id").collect()}
    assert found == set(counts)


def test_duplicate_summary(spark):
    frame = spark.createDataFrame([("a",), ("a",), ("a",), ("b",), (None,)], "k string")
    assert tuple(dedup.duplicate_summary(frame, "k").first()) == (5, 3, 1, 2)
    assert tuple(dedup.duplicate_summary(frame.limit(0), "k").first()) == (0, 0, 0, 0)


def test_keep_first_row_of_each_key(spark):
    found = dedup.dedup_keep_first(keys(spark), ["origin_id"], ["id"]).collect()
    least = {}
    for row in keys(spark).collect():
        least[row["origin_id"]] = min(row["id"], least.get(row["origin_id"], 1 << 60))
    assert {row["origin_id"]: row["id"] for row in found} == least


def test_find_duplicates_in_a_table(spark, tmp_path):
    keys(spark).write.parquet(str(tmp_path / "t"))
    found = find_duplicates(spark, str(tmp_path / "t"), min_count=1000).collect()
    assert [tuple(row) for row in found] == [("hot", 1000)]


def ids(spark):
    return spark.range(0, 1005, 1, 6).select((F.col("id") * 7 + 3).alias("id"), F.lit("x").alias("t"))


def test_pages_cover_the_table_once(spark):
    plan = paging.page_plan(ids(spark), "id", 100).orderBy("page_no").collect()
    assert [row["rows"] for row in plan] == [100] * 10 + [5]
    assert plan[0]["first_id"] == 3 and plan[-1]["last_id"] == 1004 * 7 + 3
    assert all(a["last_id"] + 7 == b["first_id"] for a, b in zip(plan, plan[1:]))


def test_following_pages_ends(spark):
    seen, last = [], 0
    while page := [row["id"] for row in paging.next_page(ids(spark), "id", last, 400).collect()]:
        seen += page
        last = page[-1]
    assert seen == [n * 7 + 3 for n in range(1005)]


@pytest.mark.parametrize("bins", [64, 4096])
def test_pages_at_any_depth(spark, monkeypatch, bins):
    monkeypatch.setattr(paging, "BINS", bins)
    keys = [-(1 << 63), -(1 << 40), -5, -4, 0, 1, 2, 1 << 50, (1 << 63) - 1]
    table = spark.createDataFrame([(k,) for k in [*keys[::-1], None]], "id long")
    for skip in (0, 3, 7, 9):
        page = [row["id"] for row in paging.page_at(table, "id", skip, 3).collect()]
        assert page == keys[skip : skip + 3]
    assert paging.page_at(table, "id", 0, 0).collect() == []
    assert paging.page_at(table.filter("id IS NULL"), "id", 0, 5).collect() == []
    assert [paging.key_at(table, "id", n) for n in (-1, 4, 9)] == [None, 0, None]


def test_pages_need_an_integer_key(spark):
    with pytest.raises(TypeError):
        paging.page_at(spark.createDataFrame([("a",)], "id string"), "id", 0, 1)


def test_keyset_page_starts_at_the_key(spark):
    page = [row["id"] for row in paging.keyset_page(ids(spark), "id", 10, 3).collect()]
    assert page == [10, 17, 24]


def test_id_ranges_are_disjoint_and_complete(spark):
    ranged = paging.range_counts(paging.id_ranges(ids(spark), "id", 8), "id")
    rows = ranged.orderBy("range_no").collect()
    assert [row["range_no"] for row in rows] == list(range(8))
    assert sum(row["rows"] for row in rows) == 1005
    assert all(a["max_id"] < b["min_id"] for a, b in zip(rows, rows[1:]))


def test_fetch_blocks(spark):
    blocks = paging.fetch_blocks(ids(spark), "id", ["id"], 300).groupBy("block_no").count()
    assert {tuple(row) for row in blocks.collect()} == {(0, 300), (1, 300), (2, 300), (3, 105)}


def test_append_refresh_and_read(spark, tmp_path):
    path = str(tmp_path / "t")
    append_table(ids(spark), path, load_id="a")
    append_table(ids(spark), path, load_id="b")
    append_table(ids(spark), path, load_id="b")
    assert read_table(spark, path, columns=["id"]).count() == 2010
    full_refresh(ids(spark).limit(5), path)
    assert read_table(spark, path).count() == 5
    with pytest.raises(ValueError):
        read_table(spark)


def test_a_refresh_that_breaks_off_leaves_the_table(spark, tmp_path):
    path = str(tmp_path / "t")
    with pytest.raises(ValueError):
        read_refreshed(spark, path)
    assert refresh(ids(spark).limit(5), path) == 1
    broken = ids(spark).withColumn("id", F.when(F.col("id") > 700, F.raise_error(F.lit("stop"))).otherwise(F.col("id")))
    with pytest.raises(Exception, match="stop"):
        refresh(broken, path)
    assert read_refreshed(spark, path).count() == 5
    held = read_refreshed(spark, path)
    assert refresh(ids(spark).limit(9), path) == 3 and read_refreshed(spark, path).count() == 9
    assert held.count() == 5  # a reader of the generation before
    assert refresh(read_refreshed(spark, path).limit(2), path) == 4  # from the table itself
    assert read_refreshed(spark, path).count() == 2
    assert sorted(p.name for p in (tmp_path / "t").iterdir()) == ["generation=3", "generation=4"]


def test_manifest(spark, tmp_path):
    path = str(tmp_path / "done")
    files = spark.createDataFrame([("a",), ("b",), ("c",)], "file string")
    assert pending_files(files, read_manifest(spark, path)).count() == 3
    add_to_manifest(files.filter("file < 'c'"), path, "one")
    add_to_manifest(files.filter("file < 'c'"), path, "one")
    assert [row[0] for row in pending_files(files, read_manifest(spark, path)).collect()] == ["c"]


def test_connector_options():
    read = jdbc_read_options("jdbc:x", "article", "id", (1, 900), 8, user="u")
    assert read == {
        "url": "jdbc:x", "dbtable": "article", "fetchsize": "10000", "user": "u",
        "partitionColumn": "id", "lowerBound": "1", "upperBound": "900", "numPartitions": "8",
    }
    with pytest.raises(ValueError):
        jdbc_read_options("jdbc:x", "article", "id")
    assert jdbc_write_options("jdbc:x", "article")["batchsize"] == "3000"
    source = broker_options("host:1", ["a", "b"], max_rows=500)
    assert source["subscribe"] == "a,b"
    assert source["startingOffsets"] == "earliest"
    assert source["maxOffsetsPerTrigger"] == "500"
    assert broker_write_options("host:1")["kafka.acks"] == "all"


def test_mapping_in_both_shapes():
    full = {"mappings": {"properties": {k: {"type": v} for k, v in ARTICLE_MAPPING.items()}}}
    assert mapping_fields(full) == ARTICLE_MAPPING
    assert mapping_schema(full)["created_at"].dataType.simpleString() == "timestamp"
