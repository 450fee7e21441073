"""Rows <-> messages of a log, dead letters and progress figures."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordhaul.functions import jsonl, times
from recordhaul.operators.changes import document_id
from recordhaul.operators.once import evaluate_once
from recordhaul.schemas import (
    ARTICLE_MAPPING,
    DEAD_LETTER_TOPIC,
    SYNC_FIELDS,
    TOPIC,
    TOPIC_PARTITIONS,
    mapping_fields,
)

PLACE = ["topic", "partition", "offset"]


def sync_records(articles: DataFrame) -> DataFrame:
    """The synchronised columns of the table, with time cut to milliseconds."""
    kept = articles.select(*SYNC_FIELDS)
    return kept.withColumn("created_at", times.truncate_ms(F.col("created_at").cast("timestamp")))


def to_messages(
    records: DataFrame, topic: str = TOPIC, key: str = "id", partitions: int = TOPIC_PARTITIONS
) -> DataFrame:
    """One JSON message per row; the partition follows from the id."""
    return records.select(
        F.lit(topic).alias("topic"),
        F.pmod(F.col(key), F.lit(partitions)).cast("int").alias("partition"),
        F.col(key).cast("string").alias("key"),
        F.to_json(F.struct(*records.columns)).alias("value"),
    )


def decode_messages(
    messages: DataFrame,
    mapping: dict = ARTICLE_MAPPING,
    key: str = "id",
    need_key: bool | Column = True,
    present: str | None = None,
) -> DataFrame:
    """Message values as typed documents with ``_id``; ``reason`` marks the undeliverable.

    ``malformed``: not one JSON object. ``no_id``: ``key`` is not a number. ``type``: a
    field does not fit its type. The message itself is kept untouched beside the fields.
    With ``need_key`` off, a message without the key gets an id from its place in the log; it
    may also be a column. ``present`` names a column for the fields that the message holds, null or not.
    """
    fields = mapping_fields(mapping)
    value = F.make_valid_utf8(F.col("value"))
    parsed = messages.withColumn("_doc", jsonl.parse_object(value, list(fields))).withColumn(
        "_whole",
        jsonl.opens_object(value)
        & jsonl.is_single_value(value)
        & jsonl.parsed_well(F.col("_doc")),
    )

    def raw(name: str) -> Column:
        return F.col(f"_doc.v.{name}")

    seen = parsed.withColumns(
        {
            **{f"_kind_{name}": jsonl.variant_kind(raw(name)) for name in fields},
            **{
                f"_raw_{name}": (jsonl.as_bigint if kind == "long" else jsonl.as_text)(raw(name))
                for name, kind in fields.items()
            },
        }
    )

    def typed(name: str, kind: str) -> Column:
        found = F.col(f"_raw_{name}")
        if kind == "long":
            return found
        if kind == "date":
            return times.parse_date(found)
        return F.when(jsonl.is_scalar_kind(F.col(f"_kind_{name}")), found)

    cast = seen.withColumns({f"_f_{name}": typed(name, kind) for name, kind in fields.items()})
    misfit = F.lit(False)
    for name in fields:
        misfit = misfit | (jsonl.is_filled(F.col(f"_kind_{name}")) & F.col(f"_f_{name}").isNull())
    kind_of_key = F.col(f"_kind_{key}")
    no_id = ~jsonl.is_number_kind(kind_of_key) | F.col(f"_f_{key}").isNull()
    if need_key is not True:
        needed = need_key if isinstance(need_key, Column) else F.lit(False)
        no_id = no_id & (needed | jsonl.is_filled(kind_of_key))
    reason = (
        F.when(~F.col("_whole"), "malformed").when(no_id, "no_id").when(misfit, "type")
    )
    has_place = set(PLACE) <= set(messages.columns)
    if need_key is True or not has_place:
        doc_id = F.col(f"_f_{key}").cast("string")
    else:
        doc_id = document_id(F.col(f"_f_{key}"), *[F.col(name) for name in PLACE])
    judged = cast.withColumn("reason", reason)
    deliverable = F.col("reason").isNull()
    envelope = [F.col(name).alias(f"m_{name}") for name in messages.columns]
    held = [F.when(F.col(f"_kind_{name}").isNotNull(), F.lit(name)) for name in fields]
    named = [] if present is None else [F.array_compact(F.array(*held)).alias(present)]
    decoded = judged.select(
        *envelope,
        F.when(deliverable, doc_id).alias("_id"),
        *[F.when(deliverable, F.col(f"_f_{name}")).alias(name) for name in fields],
        *named,
        "reason",
    )
    return evaluate_once(decoded, ["_id", *fields, *([present] if present else []), "reason"])


def split_dead_letters(decoded: DataFrame, attempts: int = 0) -> tuple[DataFrame, DataFrame]:
    """(documents, dead letters); a dead letter is the message as it came, and the reason."""
    envelope = [name for name in decoded.columns if name.startswith("m_")]
    documents = decoded.filter(F.col("reason").isNull()).drop("reason")
    dead = decoded.filter(F.col("reason").isNotNull()).select(
        *[F.col(name).alias(name[2:]) for name in envelope],
        "reason",
        F.lit(attempts).alias("attempts"),
    )
    return documents, dead


def dead_letter_messages(dead: DataFrame, topic: str = DEAD_LETTER_TOPIC) -> DataFrame:
    """Dead letters as messages of their own topic, unchanged and in the same partition."""
    key = F.col("key") if "key" in dead.columns else F.lit(None).cast("string")
    return dead.select(F.lit(topic).alias("topic"), "partition", key.alias("key"), "value")


def dead_letter_counts(dead: DataFrame) -> DataFrame:
    return dead.groupBy("reason").agg(F.count(F.lit(1)).alias("rows"))


def next_offsets(messages: DataFrame) -> DataFrame:
    """Where to go on reading: one offset per topic and partition."""
    return messages.groupBy("topic", "partition").agg(
        (F.max("offset") + 1).alias("next_offset")
    )


def sync_columns(ok: Column) -> list[Column]:
    """The progress figures as aggregates, for ``agg`` as well as ``observe``."""
    return [
        F.count(F.lit(1)).alias("consumed"),
        F.count_if(ok).alias("ok"),
        F.count_if(~ok).alias("failed"),
    ]


def sync_totals(decoded: DataFrame) -> DataFrame:
    """Messages consumed, delivered and failed, and the delivered share in percent."""
    totals = decoded.agg(*sync_columns(F.col("reason").isNull()))
    share = F.round(F.col("ok") * 100.0 / F.nullif(F.col("consumed"), F.lit(0)), 2)
    return totals.withColumn("ok_pct", share)
