"""The list of files that have been loaded."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recordhaul.session import finished, matches

MANIFEST = "file STRING, taken BIGINT"


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """Loaded files; ``taken`` is null for a whole file, else the rows of it that are in.

    Entries that were written without a commit marker are neither there nor missing, and loading
    on would double rows, so they are an error.
    """
    for entry in matches(spark, f"{path}/load_id=*"):
        if not finished(spark, entry) and matches(spark, f"{entry}/*.parquet"):
            raise ValueError(f"{entry} has no _SUCCESS marker: switch the markers on, then check it")
    if not finished(spark, path):
        return spark.createDataFrame([], MANIFEST)
    return spark.read.schema(MANIFEST).parquet(path)


def add_to_manifest(files: DataFrame, path: str, load_id: str) -> None:
    """Note files as loaded, once their rows are in the table."""
    if "taken" not in files.columns:
        files = files.withColumn("taken", F.lit(None).cast("long"))
    noted = files.select("file", "taken").distinct()
    noted.write.mode("overwrite").parquet(f"{path}/load_id={load_id}")


def partly_loaded(manifest: DataFrame) -> DataFrame:
    """Files of which some rows are in, with their number."""
    whole = manifest.filter("taken IS NULL").select("file").distinct()
    part = manifest.filter("taken IS NOT NULL").groupBy("file").agg(F.max("taken").alias("taken"))
    return part.join(whole, "file", "left_anti")


def pending_files(files: DataFrame, manifest: DataFrame) -> DataFrame:
    """Files that are not in as a whole."""
    if "taken" in manifest.columns:
        manifest = manifest.filter("taken IS NULL")
    return files.join(manifest.select("file").distinct(), "file", "left_anti")
