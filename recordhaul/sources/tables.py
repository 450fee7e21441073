"""Tables, from files or over JDBC."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from recordhaul.schemas import FETCH_SIZE


def jdbc_read_options(
    url: str,
    table: str,
    key: str | None = None,
    bounds: tuple[int, int] | None = None,
    partitions: int | None = None,
    fetch: int = FETCH_SIZE,
    **more: str,
) -> dict[str, str]:
    """Options of the JDBC reader; with ``key`` and ``bounds`` it reads disjoint id ranges."""
    options = {"url": url, "dbtable": table, "fetchsize": str(fetch), **more}
    if key is not None:
        if bounds is None or partitions is None:
            raise ValueError("an id-range read needs bounds and partitions")
        options |= {
            "partitionColumn": key,
            "lowerBound": str(bounds[0]),
            "upperBound": str(bounds[1]),
            "numPartitions": str(partitions),
        }
    return options


def read_table(
    spark: SparkSession,
    path: str | None = None,
    jdbc: dict[str, str] | None = None,
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """A parquet folder or a JDBC table; only ``columns`` are fetched."""
    if (path is None) == (jdbc is None):
        raise ValueError("give either path or jdbc")
    table = spark.read.parquet(path) if path else spark.read.format("jdbc").options(**jdbc).load()
    return table.select(*columns) if columns else table
