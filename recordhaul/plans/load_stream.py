"""Load a growing folder of JSON lines as a stream of files.

Spark's file source keeps which files it has given out in its checkpoint, so neither a manifest nor a list of
names is kept here, and nothing of a file list is collected. A micro-batch takes ``max_files`` files at most,
writes its rows into a folder of its own, and numbers them after those of the batches before it. So a batch
that is run again writes the same rows under the same ids, and what a batch needs besides its rows is one
row for each block of its files.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from recordhaul.operators.ingest import clean_records, mark_kept, parse_records
from recordhaul.operators.numbering import number_lines
from recordhaul.plans.load import REASONS
from recordhaul.schemas import ARTICLE_FIELDS
from recordhaul.session import matches, stage
from recordhaul.sinks.tables import append_table
from recordhaul.sources.lines import LOWER_CASE

MAX_FILES = 1000


def _loads(spark: SparkSession, table: str) -> list[int]:
    done = matches(spark, f"{table}/load_id=*/_SUCCESS")
    return sorted(int(path.split("load_id=")[-1].split("/")[0]) for path in done)


def _first_id(spark: SparkSession, table: str, batch_id: int) -> int:
    """After the ids of all batches before this one."""
    before = [n for n in _loads(spark, table) if n < batch_id]
    # From the newest batch with rows on; mostly that is one small read.
    while before:
        last = spark.read.parquet(f"{table}/load_id={before.pop()}").agg(F.max("id")).first()[0]
        if last is not None:
            return last + 1
    return 1


def load_handler(
    table: str, load_ts: Column | None = None, max_line_bytes: int | None = None
) -> Callable[[DataFrame, int], None]:
    """The ``foreachBatch`` function: parse, clean, number and append; refused lines are counted per batch."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        lines = batch.withColumn("seq", F.monotonically_increasing_id())
        cleaned = clean_records(parse_records(lines, max_line_bytes), load_ts)
        seen = Observation()
        counts = [F.count_if(F.col("reason") == reason).alias(reason) for reason in REASONS]
        # Rows are marked where their lines are read, in that order.
        rows = stage(mark_kept(cleaned.observe(seen, *counts)).drop("reason"), "load")
        refused = spark.createDataFrame(list(seen.get.items()), "reason string, rows long").filter("rows > 0")
        refused.write.mode("overwrite").parquet(f"{table}-refused/load_id={batch_id}")
        first = _first_id(spark, table, batch_id)
        numbered = number_lines(rows).select((F.col("pos") + (first - 1)).alias("id"), *ARTICLE_FIELDS)
        append_table(numbered, table, load_id=str(batch_id))

    return handle


def load_stream(
    spark: SparkSession,
    directory: str,
    table: str,
    checkpoint: str,
    load_ts: Column | None = None,
    pattern: str = LOWER_CASE,
    recursive: bool = False,
    max_files: int = MAX_FILES,
    max_line_bytes: int | None = None,
) -> StreamingQuery:
    """Load every file that ``checkpoint`` does not know yet, and end; run it again for later files.

    Files must be complete when they appear and not be changed afterwards. A file is loaded whole, in the batch
    that takes it. Ids are in file order within a batch.
    """
    reader = spark.readStream.option("lineSep", "\n").option("maxFilesPerTrigger", max_files)
    reader = reader.option("pathGlobFilter", pattern).option("recursiveFileLookup", recursive)
    lines = reader.text(directory).select(
        "value",
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block_start"),
    )
    writer = lines.writeStream.foreachBatch(load_handler(table, load_ts, max_line_bytes))
    return writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def loaded(spark: SparkSession, table: str) -> DataFrame:
    """The articles of all finished batches."""
    done = [f"{table}/load_id={n}" for n in _loads(spark, table)]
    if not done:
        raise ValueError(f"nothing has been loaded into {table}")
    return spark.read.parquet(*done)
