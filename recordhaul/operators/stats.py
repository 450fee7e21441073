"""Counting and validating lines per file."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordhaul.functions.jsonl import is_strict_json
from recordhaul.functions.text import trim_space, trim_space_left


#: Files of these kinds do not show in their length whether all of them was read.
COMPRESSED = r"\.(gz|bz2|deflate|lz4|snappy|zst)$"


def _bytes(value: str) -> Column:
    """Bytes of a line in its file, with the line feed that ends it."""
    return F.octet_length(value) + 1


def line_counts(
    lines: DataFrame, file: str = "file", value: str = "value", sized: bool = False
) -> DataFrame:
    """Non-blank lines per file; if ``sized``, also the ``bytes`` that were read of it."""
    counted = F.count_if(trim_space_left(F.make_valid_utf8(value)) != "")
    size = [F.sum(_bytes(value)).alias("bytes")] if sized else []
    return lines.groupBy(file).agg(counted.alias("records"), *size)


def json_counts(
    lines: DataFrame, file: str = "file", value: str = "value", sized: bool = False
) -> DataFrame:
    """Valid and invalid non-blank lines per file; if ``sized``, also its ``bytes``."""
    size = [_bytes(value).alias("size")] if sized else []
    judged = lines.select(
        file, trim_space(F.make_valid_utf8(value)).alias("line"), *size
    ).select(
        file,
        (F.col("line") != "").alias("filled"),
        is_strict_json(F.col("line")).alias("ok"),
        *(["size"] if sized else []),
    )
    return judged.groupBy(file).agg(
        F.count_if(F.col("filled") & F.col("ok")).alias("records"),
        F.count_if(F.col("filled") & ~F.col("ok")).alias("invalid"),
        *([F.sum("size").alias("bytes")] if sized else []),
    )


def with_all_files(counts: DataFrame, files: DataFrame) -> DataFrame:
    """One row per listed file: empty files count 0, unreadable ones are marked.

    ``files`` has ``file`` and ``length``. A file with content of which nothing could be
    read is an error; with ``bytes`` in the counts, so is one of which not all was read, and what was
    read of it counts nowhere. Its last line may lack a line feed, and the reader drops a
    byte-order mark of three bytes. Of compressed files the length tells nothing.
    """
    numbers = [name for name in counts.columns if name not in ("file", "bytes")]
    seen = counts.withColumn("_seen", F.lit(True))
    failed = F.col("_seen").isNull() & (F.col("length") > 0)
    if "bytes" in counts.columns:
        left = F.col("length") - F.col("bytes")
        partly = F.col("_seen").isNotNull() & ~left.isin(0, -1, 3, 2)
        failed = failed | (partly & ~F.col("file").rlike(COMPRESSED))
    return files.join(seen, "file", "left").select(
        "file",
        *[F.when(failed, 0).otherwise(F.coalesce(name, F.lit(0))).alias(name) for name in numbers],
        failed.alias("failed"),
    )


def line_count_summary(counts: DataFrame) -> DataFrame:
    """Files, records and whole records per file; failed files are only counted."""
    failed = F.col("failed") if "failed" in counts.columns else F.lit(False)
    good = ~failed
    files = F.count_if(good)
    records = F.coalesce(F.sum(F.when(good, F.col("records"))), F.lit(0))
    return counts.agg(
        files.alias("files"),
        records.alias("records"),
        F.count_if(failed).alias("error_files"),
        F.when(files > 0, F.call_function("div", records, files)).alias("avg_records"),
    )


def json_summary(counts: DataFrame) -> DataFrame:
    """As ``line_count_summary``, with invalid lines and the valid share in percent."""
    failed = F.col("failed") if "failed" in counts.columns else F.lit(False)
    good = ~failed
    files = F.count_if(good)
    records = F.coalesce(F.sum(F.when(good, F.col("records"))), F.lit(0))
    invalid = F.coalesce(F.sum(F.when(good, F.col("invalid"))), F.lit(0))
    return counts.agg(
        files.alias("files"),
        records.alias("records"),
        invalid.alias("invalid"),
        F.count_if(failed).alias("error_files"),
        F.round(records * 100.0 / F.nullif(records + invalid, F.lit(0)), 2).alias("valid_pct"),
        F.when(files > 0, F.call_function("div", records, files)).alias("avg_records"),
    )
