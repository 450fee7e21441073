"""Finding and removing rows with the same key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def key_counts(df: DataFrame, key: str, min_count: int = 1) -> DataFrame:
    """Rows per key; counted before the shuffle, so a frequent key is no burden.

    Null is a key of its own.
    """
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return counts.filter(F.col("n") >= min_count) if min_count > 1 else counts


def duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    return key_counts(df, key, min_count=2)


def duplicate_summary(df: DataFrame, key: str) -> DataFrame:
    """Rows, distinct keys, keys with several rows, and rows beyond the first of a key."""
    return key_counts(df, key).agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
        F.count(F.lit(1)).alias("keys"),
        F.count_if(F.col("n") > 1).alias("duplicate_keys"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("extra_rows"),
    )


def dedup_keep_first(df: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key, the least in ``order``. Reduced on the map side, no window."""
    first = F.min_by(F.struct(*df.columns), F.struct(*order))
    kept = df.groupBy(*[F.col(name).alias(f"_key_{name}") for name in key])
    return kept.agg(first.alias("_row")).select("_row.*")
