import pytest
from pyspark.sql import functions as F

from recordhaul.operators import numbering


def table(spark, rows, partitions):
    """A third of the rows share one source; ids have gaps."""
    source = F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("s"), F.col("id") % 7))
    frame = spark.range(0, rows, 1, partitions)
    return frame.select(source.alias("source"), (F.col("id") * 3 + 1).alias("key")).repartition(
        partitions, F.rand(1)
    )


@pytest.mark.parametrize("partitions", [1, 3, 8])
def test_ids_follow_the_order(spark, partitions):
    frame = table(spark, 500, partitions)
    found = numbering.assign_ids(frame, ["source", "key"], first_id=11).collect()
    expected = sorted((row["source"], row["key"]) for row in found)
    assert {(row["source"], row["key"]): row["id"] for row in found} == {
        pair: n for n, pair in enumerate(expected, 11)
    }


@pytest.mark.parametrize("partitions", [1, 5])
def test_positions_within_groups(spark, partitions):
    found = numbering.number_rows(table(spark, 600, partitions), ["key"], ["source"]).collect()
    groups = {}
    for row in found:
        groups.setdefault(row["source"], []).append((row["key"], row["pos"]))
    assert len(groups["hot"]) == 200
    for rows in groups.values():
        assert [pos for _, pos in sorted(rows)] == list(range(1, len(rows) + 1))


def test_null_is_a_group(spark):
    frame = spark.createDataFrame([(None, 2), (None, 1), ("a", 3)], "g string, key long")
    found = numbering.number_rows(frame, ["key"], ["g"]).collect()
    assert sorted((row["key"], row["pos"]) for row in found) == [(1, 1), (2, 2), (3, 1)]


@pytest.mark.parametrize("limit", [0, 1, 99, 100, 437, 499, 500, 10_000])
@pytest.mark.parametrize("partitions", [1, 6])
def test_cap_is_exact(spark, limit, partitions):
    frame = table(spark, 500, partitions)
    found = numbering.cap_rows(frame, limit, ["source", "key"]).collect()
    everything = sorted(tuple(row) for row in frame.collect())
    assert sorted(tuple(row) for row in found) == everything[:limit]


def test_cap_with_nulls_in_the_key(spark):
    frame = spark.createDataFrame([(None, 1), (None, 2), ("a", 1), ("b", 1)], "s string, k long")
    for limit in range(5):
        assert numbering.cap_rows(frame, limit, ["s", "k"]).count() == limit


def test_batches_fill_up_per_group(spark):
    batched = numbering.assign_batches(table(spark, 600, 4), "source", ["key"], size=30)
    rows = {
        (row["source"], row["batch_no"]): row["rows"]
        for row in numbering.batch_counts(batched, "source").collect()
    }
    assert [rows["hot", n] for n in range(7)] == [30] * 6 + [20]
    assert sum(rows.values()) == 600


def test_running_total(spark):
    frame = spark.range(0, 1000, 1, 7).select("id", (F.col("id") % 5).alias("w"))
    found = numbering.running_total(frame, ["id"], "w").orderBy("id").collect()
    total = 0
    for row in found:
        assert row["before"] == total
        total += row["w"]


@pytest.mark.parametrize("blocks", [500_000, 0])
@pytest.mark.parametrize("within_file", [False, True])
def test_lines_are_numbered_where_they_are(spark, monkeypatch, blocks, within_file):
    monkeypatch.setattr(numbering, "BROADCAST_BLOCKS", blocks)
    lines = [(f"f{n % 3}", 100 * (n % 4), n) for n in range(240)]
    frame = spark.createDataFrame(lines, "file string, block_start long, n long")
    placed = frame.repartition(2, "file", "block_start").sortWithinPartitions("file", "block_start", "n")
    rows = numbering.stage(placed.withColumn("kept_seq", F.monotonically_increasing_id()), "lines")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        numbered = numbering.number_lines(rows, within_file)
        text = numbered._jdf.queryExecution().executedPlan().toString()
        found = numbered.collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert ("Exchange hashpartitioning" in text) == (blocks == 0)
    expected = {row: n for n, row in enumerate(sorted(lines), 1)}
    if within_file:
        expected = {row: n - 80 * int(row[0][1]) for row, n in expected.items()}
    assert {(r["file"], r["block_start"], r["n"]): r["pos"] for r in found} == expected
