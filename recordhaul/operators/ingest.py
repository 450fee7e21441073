"""JSON lines -> clean records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordhaul.functions import jsonl, text, times
from recordhaul.operators.once import evaluate_once
from recordhaul.schemas import (
    DEFAULT_ACCOUNT,
    RECORD_FIELDS,
    TEXT_FIELDS,
    TIME_FIELDS,
)


def parse_records(lines: DataFrame, max_line_bytes: int | None = None) -> DataFrame:
    """Parse ``value`` into the input fields; ``reason`` says why a line is refused.

    Every field must have its type, also those that are overwritten later. Unknown
    fields are ignored, missing and null ones allowed. Names are matched in any case; of
    several members with one name the last counts.
    """
    too_long = F.lit(False) if max_line_bytes is None else F.octet_length("value") >= max_line_bytes
    readable = F.when(~too_long, F.col("value"))
    body = (
        lines.withColumn("_utf8", text.drop_invalid_utf8(readable))
        .withColumn("_paired", jsonl.repair_surrogates(F.col("_utf8")))
        .withColumn("_body", jsonl.exact_names(F.col("_paired"), RECORD_FIELDS))
    )
    parsed = body.withColumn("_doc", jsonl.parse_object(F.col("_body"), RECORD_FIELDS)).withColumn(
        "_single", jsonl.is_single_value(F.col("_body"))
    )

    def field(name: str) -> Column:
        return F.col(f"_doc.v.{name}")

    seen = parsed.withColumns(
        {
            **{f"_kind_{name}": jsonl.variant_kind(field(name)) for name in RECORD_FIELDS},
            **{f"_raw_{name}": jsonl.as_text(field(name)) for name in TEXT_FIELDS + TIME_FIELDS},
            "_well": jsonl.parsed_well(F.col("_doc")),
        }
    )
    typed = jsonl.is_kind(F.col("_kind_account_id"), "BIGINT")
    for name in TEXT_FIELDS + TIME_FIELDS:
        typed = typed & jsonl.is_kind(F.col(f"_kind_{name}"), "STRING")
    for name in TIME_FIELDS:
        typed = typed & times.is_rfc3339(F.col(f"_raw_{name}"))
    reason = (
        F.when(too_long, "too_long")
        .when(~F.col("_single"), "malformed")
        .when(
            ~F.col("_well"),
            F.when(jsonl.opens_object(F.col("_body")), "malformed")
            .when(jsonl.is_blank(F.col("_body")), "malformed")
            .otherwise("wrong_type"),
        )
        .when(~typed, "wrong_type")
    )
    fields = [
        F.col(f"_raw_{name}").alias("origin_id" if name == "id" else name) for name in TEXT_FIELDS
    ]
    return seen.select(
        *[name for name in lines.columns if name != "value"], *fields, reason.alias("reason")
    )


def clean_records(parsed: DataFrame, load_ts: Column | None = None) -> DataFrame:
    """Defaults, derived title and cleaning; records left without text get ``reason`` empty.

    The title is cut from the content before NUL characters are removed from both, and
    load time and account always replace what the line said.
    """
    load_ts = F.current_timestamp() if load_ts is None else load_ts
    carried = [
        name
        for name in parsed.columns
        if name not in {"origin_id", "content", "text", "title", "reason"}
    ]
    filled = parsed.withColumn(
        "content", text.first_non_empty(F.col("content"), F.col("text"))
    ).withColumn("title", text.title_of(F.col("content")))
    cleaned = filled.withColumns(
        {
            name: text.strip_nul(text.drop_invalid_utf8(F.col(name)))
            for name in ("title", "content")
        }
    )
    empty = (F.col("content") == "") | (F.col("title") == "")
    judged = cleaned.select(
        *carried,
        F.coalesce("origin_id", F.lit("")).alias("origin_id"),
        "title",
        "content",
        F.lit(DEFAULT_ACCOUNT).alias("account_id"),
        load_ts.alias("created_at"),
        load_ts.alias("updated_at"),
        F.when(F.col("reason").isNotNull(), F.col("reason"))
        .when(empty, "empty")
        .alias("reason"),
    )
    return evaluate_once(judged, ["origin_id", "title", "content", "reason"])


def accepted(cleaned: DataFrame) -> DataFrame:
    return cleaned.filter(F.col("reason").isNull()).drop("reason")


def ingest_rejects(cleaned: DataFrame) -> DataFrame:
    """Refused lines per reason."""
    refused = cleaned.filter(F.col("reason").isNotNull())
    return refused.groupBy("reason").agg(F.count(F.lit(1)).alias("rows"))


def mark_kept(cleaned: DataFrame) -> DataFrame:
    """Accepted rows to stage, marked in order."""
    kept = cleaned.filter(F.col("reason").isNull())
    return kept.withColumn("kept_seq", F.monotonically_increasing_id())
