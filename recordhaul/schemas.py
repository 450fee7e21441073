"""Record types of the engine."""

from __future__ import annotations

from pyspark.sql import types as T

# Input field names and types, the table's columns, the columns that
# are synchronised, the index mapping, and the job's constants.
RECORD_FIELDS = ["id", "content", "text", "title", "created_at", "updated_at", "account_id"]
TEXT_FIELDS = ["id", "content", "text", "title"]
TIME_FIELDS = ["created_at", "updated_at"]
ARTICLE_FIELDS = ["origin_id", "title", "content", "account_id", "created_at", "updated_at"]
SYNC_FIELDS = ["content", "origin_id", "id", "title", "created_at", "account_id"]
ARTICLE_MAPPING = {
    "id": "long",
    "account_id": "long",
    "origin_id": "keyword",
    "title": "text",
    "content": "text",
    "created_at": "date",
}
TITLE_LENGTH = 15
DEFAULT_ACCOUNT = 1
BATCH_SIZE = 3000
FETCH_SIZE = 10_000
PAGE_SIZE = 100
TOPIC_PARTITIONS = 3
TOPIC = "full_load"
DEAD_LETTER_TOPIC = "full_load_dlq"

ARTICLE = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("origin_id", T.StringType()),
        T.StructField("title", T.StringType()),
        T.StructField("content", T.StringType()),
        T.StructField("account_id", T.IntegerType()),
        T.StructField("created_at", T.TimestampType()),
        T.StructField("updated_at", T.TimestampType()),
    ]
)

ENVELOPE = T.StructType(
    [
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("key", T.StringType()),
        T.StructField("value", T.StringType()),
        T.StructField("timestamp", T.TimestampType()),
    ]
)

#: Messages that say what they do: ``put`` (also null), ``patch`` or ``delete``.
TYPED_ENVELOPE = T.StructType([*ENVELOPE.fields, T.StructField("op", T.StringType())])

_SPARK_TYPES = {
    "long": T.LongType(),
    "keyword": T.StringType(),
    "text": T.StringType(),
    "date": T.TimestampType(),
}


def mapping_fields(mapping: dict) -> dict[str, str]:
    """Field -> index type, from a flat dict or from a full index definition."""
    properties = mapping.get("mappings", {}).get("properties")
    if properties is None:
        return dict(mapping)
    return {name: spec["type"] for name, spec in properties.items()}


def mapping_schema(mapping: dict) -> T.StructType:
    return T.StructType(
        [T.StructField(name, _SPARK_TYPES[kind]) for name, kind in mapping_fields(mapping).items()]
    )
