"""JSON-lines folders as DataFrames of lines."""

from __future__ import annotations

import re
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recordhaul.session import matches

# Which files are read, by the recursive and by the flat scan.
ANY_CASE = "*.[jJ][sS][oO][nN][lL]"
LOWER_CASE = "*.jsonl"

LINES = "value STRING, file STRING, block_start BIGINT, seq BIGINT"


def _reader(spark: SparkSession, recursive: bool, pattern: str | None):
    reader = spark.read.option("recursiveFileLookup", recursive)
    return reader.option("pathGlobFilter", pattern or (ANY_CASE if recursive else LOWER_CASE))


def _place(directory: str, recursive: bool, pattern: str | None) -> str:
    return directory if recursive else f"{directory.rstrip('/')}/{pattern or LOWER_CASE}"


def _with_place(lines: DataFrame) -> DataFrame:
    return lines.select(
        "value",
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block_start"),
        F.monotonically_increasing_id().alias("seq"),
    )


def read_lines(
    spark: SparkSession,
    directory: str,
    recursive: bool = True,
    pattern: str | None = None,
    skip_unreadable: bool = False,
) -> DataFrame:
    """``value, file, block_start, seq``: every line that ends in LF, in file order.

    (``file``, ``block_start``, ``seq``) orders the lines. ``recursive`` also walks
    sub-folders and ignores the case of the suffix; without it only the folder itself is
    read. A missing folder is an error in the recursive scan, no match is none in the flat.
    """
    reader = _reader(spark, recursive, pattern).option("lineSep", "\n")
    if skip_unreadable:
        reader = reader.option("ignoreCorruptFiles", True).option("ignoreMissingFiles", True)
    place = _place(directory, recursive, pattern)
    if not recursive and not matches(spark, place):
        return spark.createDataFrame([], LINES)
    return _with_place(reader.text(place))


def read_files(spark: SparkSession, files: list[str]) -> DataFrame:
    """As ``read_lines``, of the files named as in column ``file``."""
    paths = [unquote(name) for name in files]
    return _with_place(spark.read.option("lineSep", "\n").text(paths))


def _as_metadata(name: str) -> str:
    """A listed name as the metadata column spells it: no empty host part."""
    return re.sub("^([a-z0-9]+):///", r"\1:/", name)


def list_files(
    spark: SparkSession, directory: str, recursive: bool = True, pattern: str | None = None
) -> DataFrame:
    """``file, length`` of every file the scan covers, empty ones included."""
    place = _place(directory, recursive, pattern)
    if not recursive and not matches(spark, place):
        return spark.createDataFrame([], "file STRING, length BIGINT")
    found = _reader(spark, recursive, pattern).format("binaryFile").load(place)
    # The listing is the reader's own; empty files are in it but give no row below.
    names = spark.createDataFrame([(_as_metadata(name),) for name in found.inputFiles()], "file STRING")
    sizes = found.select(F.col("_metadata.file_path").alias("file"), "length")
    return names.join(sizes, "file", "left").select(
        "file", F.coalesce("length", F.lit(0)).alias("length")
    )
