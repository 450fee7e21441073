"""Ordered reads and pages of a table with a unique id."""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordhaul.operators.numbering import batch_of, number_rows
from recordhaul.schemas import FETCH_SIZE, PAGE_SIZE


def ordered_scan(df: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """The whole table in key order: a range-partitioned sort of the columns asked for."""
    return df.select(*columns).orderBy(key)


def fetch_blocks(
    df: DataFrame, key: str, columns: Sequence[str], fetch: int = FETCH_SIZE
) -> DataFrame:
    """``ordered_scan`` with the number of the fetch block each row arrives in."""
    numbered = number_rows(df.select(*columns), [key])
    return numbered.withColumn("block_no", batch_of(F.col("pos"), fetch)).drop("pos")


def keyset_page(df: DataFrame, key: str, start: int, size: int = PAGE_SIZE) -> DataFrame:
    """``size`` rows from key ``start`` on."""
    return df.filter(F.col(key) >= start).orderBy(key).limit(size)


def next_page(df: DataFrame, key: str, last: int, size: int = PAGE_SIZE) -> DataFrame:
    """The page after the one that ended in key ``last``; empty after the last page."""
    return df.filter(F.col(key) > last).orderBy(key).limit(size)


#: Counts that one pass over the keys gives back.
BINS = 4096


def key_at(df: DataFrame, key: str, place: int) -> int | None:
    """The integer key at a 0-based place of the order; None beyond the last one.

    An order statistic by histograms: a pass counts the keys of ``BINS`` equal ranges, and the next one looks
    into the range that holds the place. Six passes do for any 64-bit keys, each over one column and, after the
    first, over what the scan cannot prune of one range. Nothing is sorted or shuffled but the counts.
    """
    if df.schema[key].dataType.typeName() not in ("byte", "short", "integer", "long"):
        raise TypeError("the key must be an integer")
    keys = df.select(F.col(key).cast("bigint").alias("key")).filter("key IS NOT NULL")
    low, high, count = keys.agg(F.min("key"), F.max("key"), F.count("*")).first()
    if place < 0 or place >= count:
        return None
    while low < high:
        width = -(-(high - low + 1) // BINS)
        inside = keys.filter(F.col("key").between(low, high))
        if high - low < 1 << 62:
            number = F.call_function("div", F.col("key") - low, F.lit(width))
        else:  # the difference may exceed 64 bits
            number = F.call_function("div", F.col("key").cast("decimal(20,0)") - low, F.lit(Decimal(width)))
        within = inside.select(number.cast("int").alias("bin"))
        counts = within.groupBy("bin").agg(F.count("*").alias("n")).collect()  # BINS rows at most
        for number, n in sorted(map(tuple, counts)):
            if place < n:
                low, high = low + number * width, min(high, low + (number + 1) * width - 1)
                break
            place -= n
    return low


def page_at(df: DataFrame, key: str, skip: int, size: int) -> DataFrame:
    """``size`` rows after the first ``skip`` in key order, however deep the page lies.

    The page's first and last key are found by ``key_at``, and a filter on them reaches the scan; rows before the
    page are counted and never brought together. Keys are unique; rows without one are in no page.
    """
    first = key_at(df, key, skip) if size > 0 else None
    if first is None:
        return df.filter(F.lit(False))
    last = key_at(df.filter(F.col(key) >= first), key, size - 1)
    page = df.filter(F.col(key) >= first)
    if last is not None:
        page = page.filter(F.col(key) <= last)
    return page.orderBy(key).limit(size)


def page_plan(df: DataFrame, key: str, size: int = PAGE_SIZE) -> DataFrame:
    """All keyset pages of the table: disjoint, complete, each row once."""
    numbered = number_rows(df.select(key), [key])
    return (
        numbered.groupBy(batch_of(F.col("pos"), size).alias("page_no"))
        .agg(
            F.min(key).alias("first_id"),
            F.max(key).alias("last_id"),
            F.count(F.lit(1)).alias("rows"),
        )
    )


def id_ranges(df: DataFrame, key: str, ranges: int) -> DataFrame:
    """Add ``range_no``: equal, disjoint id ranges between the least and the greatest id."""
    lo, hi = df.agg(F.min(key), F.max(key)).first()
    if lo is None:
        return df.withColumn("range_no", F.lit(None).cast("bigint"))
    number = F.call_function("div", (F.col(key) - lo) * ranges, F.lit(hi - lo + 1))
    return df.withColumn("range_no", number)


def range_counts(ranged: DataFrame, key: str) -> DataFrame:
    return ranged.groupBy("range_no").agg(
        F.count(F.lit(1)).alias("rows"), F.min(key).alias("min_id"), F.max(key).alias("max_id")
    )
