"""Rows in the order of a key, each with the row that follows it, without one global task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def split_points(table: DataFrame, key: str, parts: int) -> list[int]:
    """At most ``parts - 1`` keys that cut the table into parts of about equal size."""
    shares = [n / parts for n in range(1, parts)]
    if not shares:
        return []
    points = table.agg(F.percentile_approx(key, shares, 10_000)).first()[0]
    return sorted(set(points or ()))


def part_of(key: Column, points: list[int]) -> Column:
    """How many of the sorted ``points`` are not above the key; 0 for a null key."""
    if not points:
        return F.lit(0)
    strides = [1 << n for n in range(len(points).bit_length() - 1, -1, -1)]
    held = F.lit(points)
    step = lambda low, stride: F.when(
        (low + stride <= len(points)) & (F.get(held, low + stride - 1) <= key), low + stride
    ).otherwise(low)
    return F.aggregate(F.lit(strides), F.lit(0), step)


def with_followers(table: DataFrame, key: str, order: list[Column]) -> DataFrame:
    """``table`` in parts sorted by ``key``, with ``part`` and ``borrowed``.

    The last row of each part is a copy, marked ``borrowed``, of the first row of the next part, and in
    the last part of the first row of all. So every other row stands before the one that follows
    it. Rows are shuffled once; only a list of parts, one entry each, reaches the driver. Rows without a
    key come first and are never borrowed. Where a borrowed key occurs several times, all its rows
    are borrowed, in their order.
    """
    spark = table.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = table.select(F.col(key).alias("key"))
    points = split_points(keys, "key", parts)
    part = part_of(F.col(key), points)
    firsts = keys.groupBy(part_of(F.col("key"), points).alias("part")).agg(F.min("key").alias("key"))
    firsts = sorted((r["part"], r["key"]) for r in firsts.collect() if r["key"] is not None)
    before = [(first, firsts[n - 1][0]) for n, (_, first) in enumerate(firsts)]
    lent = spark.createDataFrame(before, "_key long, _part int")
    placed = table.join(F.broadcast(lent), F.col(key) == F.col("_key"), "left")
    own = F.struct(part.alias("part"), F.lit(False).alias("borrowed"))
    other = F.struct(F.col("_part").alias("part"), F.lit(True).alias("borrowed"))
    places = F.when(F.col("_part").isNull(), F.array(own)).otherwise(F.array(own, other))
    rows = placed.withColumn("_place", F.explode(places)).select(*table.columns, "_place.*")
    return rows.repartitionById(parts, F.col("part")).sortWithinPartitions("part", "borrowed", key, *order)
