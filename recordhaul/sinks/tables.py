"""Appends to and refreshes of tables."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from recordhaul.schemas import BATCH_SIZE
from recordhaul.session import matches, remove


def jdbc_write_options(url: str, table: str, batch: int = BATCH_SIZE, **more: str) -> dict[str, str]:
    return {"url": url, "dbtable": table, "batchsize": str(batch), **more}


def append_table(
    df: DataFrame,
    path: str | None = None,
    jdbc: dict[str, str] | None = None,
    load_id: str | None = None,
) -> None:
    """Append to a parquet folder or a JDBC table. A failed write fails the job.

    With ``load_id`` the rows go to their own sub-folder, which a repeated load with the
    same id replaces: running it again after a crash leaves no row twice.
    """
    if (path is None) == (jdbc is None):
        raise ValueError("give either path or jdbc")
    if jdbc is not None:
        df.write.format("jdbc").options(**jdbc).mode("append").save()
    elif load_id is not None:
        df.write.mode("overwrite").parquet(f"{path}/load_id={load_id}")
    else:
        df.write.mode("append").parquet(path)


def full_refresh(df: DataFrame, path: str) -> None:
    """Replace the whole table; it need not exist."""
    df.write.mode("overwrite").parquet(path)


def _generations(spark: SparkSession, path: str, mark: str = "") -> list[int]:
    found = matches(spark, f"{path}/generation=*{mark}")
    return sorted(int(re.search(r"generation=(\d+)", name)[1]) for name in found)


def refresh(df: DataFrame, path: str, keep: int = 2) -> int:
    """Replace the whole table by a new generation of it; returns its number.

    A generation counts from the marker on that ends its write, so a write that breaks off leaves the table as it
    was, and readers of the one before go on. ``keep`` finished generations stay, and broken-off ones older than
    them go. Two refreshes of one table must not run at once.
    """
    if keep < 1:
        raise ValueError("the generation just written has to stay")
    spark = df.sparkSession
    number = max(_generations(spark, path), default=0) + 1
    df.write.parquet(f"{path}/generation={number}")
    done = _generations(spark, path, "/_SUCCESS")
    for old in _generations(spark, path):
        if old < done[-keep:][0]:
            remove(spark, f"{path}/generation={old}")
    return number


def read_refreshed(spark: SparkSession, path: str) -> DataFrame:
    """The newest finished generation."""
    done = _generations(spark, path, "/_SUCCESS")
    if not done:
        raise ValueError(f"no refresh of {path} has ended yet")
    return spark.read.parquet(f"{path}/generation={done[-1]}")
