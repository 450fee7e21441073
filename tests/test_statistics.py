import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from recordhaul.operators import stats
from recordhaul.plans.statistics import directory_statistics
from recordhaul.sources.lines import list_files, read_lines


@pytest.fixture
def folder(tmp_path):
    (tmp_path / "sub ü").mkdir()
    (tmp_path / "a b%.jsonl").write_bytes(b'{"a":1}\n\n  \t\n\xc2\xa0\n[1]\r\n{"a":1} x\n')
    (tmp_path / "sub ü" / "B.JSONL").write_bytes(b'"x\ry"\nnull')
    (tmp_path / "empty.jsonl").write_bytes(b"")
    (tmp_path / "blank.jsonl").write_bytes(b"\n\n")
    (tmp_path / "c.json").write_bytes(b"{}\n")
    return str(tmp_path)


def by_name(per_file):
    return {row["file"].rsplit("/", 1)[1]: row for row in per_file.collect()}


def test_counts_every_file(spark, folder):
    per_file, summary = directory_statistics(spark, folder)
    rows = by_name(per_file)
    assert {name: row["records"] for name, row in rows.items()} == {
        "a%20b%25.jsonl": 3, "B.JSONL": 2, "empty.jsonl": 0, "blank.jsonl": 0,
    }
    assert not any(row["failed"] for row in rows.values())
    assert tuple(summary.first()) == (4, 5, 0, 1)


def test_validates(spark, folder):
    per_file, summary = directory_statistics(spark, folder, validate=True)
    rows = by_name(per_file)
    assert (rows["a%20b%25.jsonl"]["records"], rows["a%20b%25.jsonl"]["invalid"]) == (2, 1)
    # A lone CR does not end a line; raw in a string it makes that line invalid.
    assert (rows["B.JSONL"]["records"], rows["B.JSONL"]["invalid"]) == (1, 1)
    assert tuple(summary.first()) == (4, 3, 2, 0, 60.0, 0)


def test_invalid_bytes_do_not_make_json_invalid(spark):
    lines = spark.createDataFrame([(bytearray(b'{"a":"\xff"}'),)], "b binary").select(
        F.lit("f").alias("file"), F.col("b").cast("string").alias("value")
    )
    assert tuple(stats.json_counts(lines).first()) == ("f", 1, 0)


def test_unreadable_file_is_counted_apart(spark):
    files = spark.createDataFrame([("a", 10), ("b", 10), ("c", 0)], "file string, length long")
    counts = spark.createDataFrame([("a", 7)], "file string, records long")
    per_file = stats.with_all_files(counts, files)
    assert tuple(stats.line_count_summary(per_file).first()) == (2, 7, 1, 3)


@pytest.mark.parametrize("validate", [False, True])
def test_a_file_read_in_part_counts_nowhere(spark, tmp_path, validate):
    # Written with checksums, of which one fails in the middle.
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    jvm = spark.sparkContext._jvm.org.apache.hadoop.fs
    files = jvm.FileSystem.getLocal(conf)
    for name in ("whole", "broken"):
        out = files.create(jvm.Path(str(tmp_path / f"{name}.jsonl")))
        out.write(bytearray(b'{"a": 1}\n' * 40_000))
        out.close()
    (tmp_path / "mark.jsonl").write_bytes(b"\xef\xbb\xbf{}\n{}")
    data = bytearray((tmp_path / "broken.jsonl").read_bytes())
    data[200_000] = ord("x")
    (tmp_path / "broken.jsonl").write_bytes(data)
    per_file, summary = directory_statistics(spark, str(tmp_path), validate)
    rows = by_name(per_file)
    assert {n: (r["records"], r["failed"]) for n, r in rows.items()} == {
        "whole.jsonl": (40_000, False), "broken.jsonl": (0, True), "mark.jsonl": (2, False),
    }
    row = summary.first()
    assert (row["files"], row["records"], row["error_files"]) == (2, 40_002, 1)


def test_summary_of_nothing(spark):
    counts = spark.createDataFrame([], "file string, records long, invalid long")
    assert tuple(stats.json_summary(counts).first()) == (0, 0, 0, 0, None, None)


def test_flat_scan_reads_the_folder_only(spark, folder, tmp_path_factory):
    names = [row["file"].rsplit("/", 1)[1] for row in list_files(spark, folder, False).collect()]
    assert sorted(names) == ["a%20b%25.jsonl", "blank.jsonl", "empty.jsonl"]
    assert read_lines(spark, folder, recursive=False).count() == 8
    nothing = str(tmp_path_factory.mktemp("nothing"))
    assert read_lines(spark, nothing, recursive=False).count() == 0
    assert list_files(spark, nothing, recursive=False).count() == 0


def test_missing_folder_is_an_error(spark, tmp_path):
    with pytest.raises(AnalysisException):
        read_lines(spark, str(tmp_path / "none"))


def test_lines_are_in_file_order(spark, tmp_path):
    for name in ("x", "y"):
        (tmp_path / f"{name}.jsonl").write_text("".join(f"{name}{n:05d}\n" for n in range(3000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    try:
        lines = read_lines(spark, str(tmp_path))
        assert lines.rdd.getNumPartitions() > 4
        values = [row["value"] for row in lines.orderBy("file", "block_start", "seq").collect()]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert values == [f"{name}{n:05d}" for name in ("x", "y") for n in range(3000)]
