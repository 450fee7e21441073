"""Find rows of a table that share a key."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from recordhaul.operators.dedup import key_counts
from recordhaul.sources.tables import read_table


def find_duplicates(
    spark: SparkSession,
    path: str | None = None,
    jdbc: dict[str, str] | None = None,
    key: str = "origin_id",
    min_count: int = 2,
) -> DataFrame:
    """Keys with at least ``min_count`` rows; 1 lists every key."""
    return key_counts(read_table(spark, path, jdbc, [key]), key, min_count)
