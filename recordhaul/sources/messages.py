"""Message logs as streams of envelopes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recordhaul.operators.messages import PLACE
from recordhaul.schemas import ENVELOPE

#: Tasks a slot that a micro-batch is dealt out to.
SLOT_TASKS = 2


def broker_options(
    servers: str, topics: list[str], start: str = "earliest", max_rows: int | None = None, **more
) -> dict[str, str]:
    """Options of the Kafka reader; ``max_rows`` bounds what one micro-batch takes."""
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": ",".join(topics),
        "startingOffsets": start,
        **more,
    }
    if max_rows is not None:
        options["maxOffsetsPerTrigger"] = str(max_rows)
    return options


def read_broker(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    """Messages from a broker (needs Spark's Kafka connector on the class path)."""
    log = spark.readStream.format("kafka").options(**options).load()
    return log.select(
        "topic",
        "partition",
        "offset",
        F.col("key").cast("string").alias("key"),
        F.col("value").cast("string").alias("value"),
        "timestamp",
    )


def read_message_files(
    spark: SparkSession,
    folder: str,
    max_files: int | None = None,
    topics: list[str] | None = None,
    schema: T.StructType = ENVELOPE,
) -> DataFrame:
    """Messages from parquet files of envelopes that arrive in ``folder``."""
    reader = spark.readStream.schema(schema)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    log = reader.parquet(folder)
    return log.filter(F.col("topic").isin(*topics)) if topics else log


def spread(batch: DataFrame) -> DataFrame:
    """The messages of a micro-batch, dealt out to all slots by their place in the log.

    A batch is often one file or a few partitions of a topic, and so would be decoded by as few tasks,
    however many messages it has. Only the messages as they came are moved.
    """
    slots = batch.sparkSession.sparkContext.defaultParallelism
    return batch.repartition(SLOT_TASKS * slots, *[name for name in PLACE if name in batch.columns])
