"""Exact positions, caps and batches without one big sort task or one big limit.

A position is *rows in earlier parts + place within the part*. Parts are what Spark
already has: the range partitions of a sort, or the byte blocks of a file scan. Only
the per-part counts are summed up across parts, so a file or a group that holds most
of the rows is spread over as many tasks as it has parts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recordhaul.schemas import BATCH_SIZE
from recordhaul.session import stage

FILE_ORDER = ["file", "block_start", "seq"]
#: Blocks of a scan whose shifts are broadcast: three numbers each, some 50 MB in all.
BROADCAST_BLOCKS = 500_000
_ROW_BITS = 33  # monotonically_increasing_id keeps the row within the task in these bits


def number_rows(
    df: DataFrame, order: Sequence[str], within: Sequence[str] = (), name: str = "pos"
) -> DataFrame:
    """Add the 1-based position of every row in ``order``, restarting per ``within``.

    ``order`` must be unique within a group. One range shuffle sorts the rows; the
    sorted rows are written once, so that counting and numbering see the same parts.
    """
    keys = [*within, *[column for column in order if column not in within]]
    ordered = df.orderBy(*keys).withColumn("_mark", F.monotonically_increasing_id())
    rows = stage(ordered, "numbered").withColumn("_part", F.shiftright("_mark", _ROW_BITS))
    counts = rows.groupBy("_part", *within).agg(
        F.count(F.lit(1)).alias("_rows"), F.min("_mark").alias("_first")
    )
    # At most one row per (sort partition, group): within a group only as many rows as
    # the sort had partitions, whatever the number of rows counted.
    earlier = (
        Window.partitionBy(*within).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    )
    shifts = counts.select(
        F.col("_part").alias("_part_of"),
        *[F.col(column).alias(f"_of_{column}") for column in within],
        (F.coalesce(F.sum("_rows").over(earlier), F.lit(0)) - F.col("_first")).alias("_shift"),
    )
    if within:
        # Groups are not bounded in number: written out, the table has a known size and
        # Spark broadcasts it only below its threshold.
        shifts = stage(shifts, "shifts")
    else:
        shifts = F.broadcast(shifts)
    same = F.col("_part") == F.col("_part_of")
    for column in within:
        same = same & F.col(column).eqNullSafe(F.col(f"_of_{column}"))
    return rows.join(shifts, same).select(
        *df.columns, (F.col("_mark") + F.col("_shift") + 1).alias(name)
    )


def running_total(
    df: DataFrame, order: Sequence[str], value: str, name: str = "before"
) -> DataFrame:
    """Add the sum of ``value`` over all earlier rows in ``order`` (unique)."""
    ordered = df.orderBy(*order).withColumn("_mark", F.monotonically_increasing_id())
    rows = stage(ordered, "summed").withColumn("_part", F.shiftright("_mark", _ROW_BITS))
    earlier_parts = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = rows.groupBy("_part").agg(F.sum(value).alias("_sum"))
    shifts = parts.select(
        "_part", F.coalesce(F.sum("_sum").over(earlier_parts), F.lit(0)).alias("_shift")
    )
    earlier_rows = (
        Window.partitionBy("_part").orderBy("_mark").rowsBetween(Window.unboundedPreceding, -1)
    )
    return (
        rows.join(F.broadcast(shifts), "_part")
        .withColumn(
            name, F.coalesce(F.sum(value).over(earlier_rows), F.lit(0)) + F.col("_shift")
        )
        .select(*df.columns, name)
    )


def number_lines(rows: DataFrame, within_file: bool = False, name: str = "pos") -> DataFrame:
    """Positions of rows that come straight from a file scan, without sorting them.

    ``rows`` must have been staged with ``file``, ``block_start`` and ``kept_seq``, the
    row mark taken after filtering, so marks are gapless within a block. What is added to the marks of a block
    is one narrow row a block, which is broadcast up to ``BROADCAST_BLOCKS`` of them, so that the rows
    themselves stay where they are; beyond that the two are joined by shuffle.
    """
    blocks = rows.groupBy("file", "block_start").agg(
        F.count(F.lit(1)).alias("_rows"), F.min("kept_seq").alias("_first")
    )
    if within_file:
        earlier = (
            Window.partitionBy("file")
            .orderBy("block_start")
            .rowsBetween(Window.unboundedPreceding, -1)
        )
        blocks = blocks.withColumn("_before", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)))
    else:
        blocks = running_total(blocks, ["file", "block_start"], "_rows", "_before")
    shift = (F.col("_before") - F.col("_first")).alias("_shift")
    key = F.xxhash64("file")
    shifts = stage(blocks.select("file", key.alias("_file"), F.col("block_start").alias("_block"), shift), "blocks")
    count, files, keys = shifts.agg(F.count("*"), F.countDistinct("file"), F.countDistinct("_file")).first()
    if files == keys:
        of_block = F.broadcast(shifts.drop("file")) if count <= BROADCAST_BLOCKS else shifts.drop("file")
        joined = rows.join(of_block, (key == F.col("_file")) & (F.col("block_start") == F.col("_block")))
    else:  # two names of one hash
        of_block = shifts.withColumnRenamed("file", "_name")
        joined = rows.join(of_block, (F.col("file") == F.col("_name")) & (F.col("block_start") == F.col("_block")))
    return joined.select(*rows.columns, (F.col("kept_seq") + F.col("_shift") + 1).alias(name))


def assign_ids(df: DataFrame, order: Sequence[str], first_id: int = 1) -> DataFrame:
    """Number the rows from ``first_id`` on, in ``order``, as column ``id``."""
    numbered = number_rows(df, order, name="id")
    return numbered.withColumn("id", F.col("id") + F.lit(first_id - 1))


def batch_of(position: Column, size: int) -> Column:
    """0-based batch of a 1-based position."""
    return F.call_function("div", position - 1, F.lit(size))


def assign_batches(
    df: DataFrame, group: str, order: Sequence[str], size: int = BATCH_SIZE
) -> DataFrame:
    """Add ``batch_no``: batches of ``size`` rows within each group, the last one shorter."""
    numbered = number_rows(df, order, within=[group], name="_pos")
    return numbered.withColumn("batch_no", batch_of(F.col("_pos"), size)).drop("_pos")


def batch_counts(batched: DataFrame, group: str) -> DataFrame:
    return batched.groupBy(group, "batch_no").agg(F.count(F.lit(1)).alias("rows"))


def cap_rows(df: DataFrame, limit: int, order: Sequence[str]) -> DataFrame:
    """The first ``limit`` rows in ``order`` (a unique key), exactly.

    Only the key columns are sorted. The key of the last row kept then becomes a filter
    on the input, which is neither shuffled nor written.
    """
    if limit <= 0:
        return df.filter(F.lit(False))
    last = number_rows(df.select(*order), order).filter(F.col("pos") == limit).first()
    if last is None:
        return df
    key = F.struct(*[F.col(column) for column in order])
    types = {field.name: field.dataType for field in df.select(*order).schema.fields}
    bound = F.struct(*[F.lit(last[c]).cast(types[c]).alias(c) for c in order])
    kept = df.filter(key <= bound)
    head = order[0]
    if last[head] is not None:  # implied by the filter above, but the scan can use it
        kept = kept.filter(F.col(head).isNull() | (F.col(head) <= F.lit(last[head])))
    return kept
