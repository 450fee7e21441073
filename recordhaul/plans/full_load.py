"""Table snapshot -> messages -> documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recordhaul.operators import messages as M
from recordhaul.operators.changes import upsert
from recordhaul.schemas import ARTICLE_MAPPING, TOPIC, mapping_fields
from recordhaul.sinks.messages import write_message_files
from recordhaul.sources.messages import read_message_files
from recordhaul.streaming.sync import DEFAULT_ORDER, current_documents, run_sync


def snapshot_messages(articles: DataFrame, topic: str = TOPIC) -> DataFrame:
    return M.to_messages(M.sync_records(articles), topic)


def full_load(articles: DataFrame, mapping: dict = ARTICLE_MAPPING) -> tuple[DataFrame, DataFrame]:
    """(documents, dead letters) of the whole table in one batch job.

    There is one message per id; of rows that share one, the one of the greatest digest stays. Only the
    fields are shuffled, not the message that they came from.
    """
    decoded = M.decode_messages(snapshot_messages(articles), mapping)
    documents, dead = M.split_dead_letters(decoded)
    fields = list(mapping_fields(mapping))
    narrow = documents.select("_id", *fields, F.xxhash64(*fields).alias("_digest"))
    return upsert(None, narrow, "_id", ["_digest"]).drop("_digest"), dead


def full_load_through_log(
    spark: SparkSession, articles: DataFrame, log: str, root: str, mapping: dict = ARTICLE_MAPPING
) -> DataFrame:
    """The same through a log of files and the streaming sync.

    A row's id is its offset: ids are unique, and a log need not be without gaps.
    """
    envelopes = snapshot_messages(articles).select(
        "topic",
        "partition",
        F.col("key").cast("bigint").alias("offset"),
        "key",
        "value",
        F.current_timestamp().alias("timestamp"),
    )
    write_message_files(envelopes, log)
    run_sync(read_message_files(spark, log), root, mapping=mapping).awaitTermination()
    return current_documents(spark, root, DEFAULT_ORDER)
