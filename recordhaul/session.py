"""Session defaults and the shared folder in which intermediate tables are written."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
}


def build_session(app: str = "recordhaul", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach: ``spark.checkpoint.dir`` of the session.

    Where it is unset, a folder of the application's own below the warehouse stands in, which
    executors share as well.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
    return f"{warehouse}/recordhaul-{spark.sparkContext.applicationId}"


def new_folder(spark: SparkSession, label: str) -> str:
    """A path below the shared folder that nothing has used before."""
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage in a way that outlives lost executors, computes the input once
    however often the result is read, and fixes values such as row marks that a
    second run could assign differently. Readers get column pruning and pushdown.
    """
    spark = df.sparkSession
    path = new_folder(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def matches(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that match a glob pattern; a plain path matches itself if it exists."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(pattern)
    files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return [status.getPath().toString() for status in files.globStatus(path) or []]


def file_sizes(spark: SparkSession, pattern: str) -> dict[str, int]:
    """Path and bytes of what matches a glob pattern."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(pattern)
    files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return {s.getPath().toString(): s.getLen() for s in files.globStatus(path) or []}


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder with all that is in it."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    files.delete(place, True)


def finished(spark: SparkSession, path: str) -> bool:
    """True if a table write to ``path`` or to one of its sub-folders has been committed."""
    return bool(matches(spark, f"{path}/_SUCCESS") or matches(spark, f"{path}/*/_SUCCESS"))
