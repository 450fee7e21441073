"""Typed changes of documents, and their fold.

A *put* replaces a document, a *patch* sets the fields that it names, a *delete* leaves a tombstone.
The state of a document is what is needed to go on from there: its last put or delete, and for
each field the last patch behind it. Both are the greatest by their place in the log, so folding is
associative, takes changes in any order, and adds nothing if one comes twice. Spark therefore
folds on the map side first; the many changes of one document are a row a task.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordhaul.operators.messages import PLACE, decode_messages
from recordhaul.schemas import ARTICLE_MAPPING, mapping_fields

PUT, PATCH, DELETE = "put", "patch", "delete"


def decode_changes(
    messages: DataFrame, mapping: dict = ARTICLE_MAPPING, key: str = "id", generate_ids: bool = False
) -> DataFrame:
    """``decode_messages`` of typed messages, with ``op`` and ``present``.

    ``op`` is a column of the messages; where it is null or missing, a message without a value is a
    delete and any other one a put. A patch or delete goes to the document that the message's key
    names. Reasons are those of ``decode_messages``, and ``op`` for one that is not known. With ``generate_ids``
    a put without an id gets one from its place in the log.
    """
    told = F.lower("op") if "op" in messages.columns else F.lit(None).cast("string")
    op = F.coalesce(told, F.when(F.col("value").isNull(), DELETE), F.lit(PUT))
    sent = messages.withColumn("_op", op).drop("op")
    need_key = False if generate_ids else F.col("_op") == PUT
    # The flag is a column of the message on the way.
    decoded = decode_messages(sent, mapping, key, need_key, present="present")
    kind, keyed = F.col("m__op"), F.col("m_key")
    reason = (
        F.when(~kind.isin(PUT, PATCH, DELETE), "op")
        .when(kind == PUT, F.col("reason"))
        .when(keyed.isNull(), "no_id")
        .when(kind == PATCH, F.col("reason"))
    )
    judged = decoded.withColumn("reason", reason)
    own = F.when(kind == PUT, F.col("_id")).otherwise(keyed)
    return judged.withColumn("_id", F.when(F.col("reason").isNull(), own)).withColumnRenamed(
        "m__op", "op"
    )


def change_states(
    decoded: DataFrame, fields: Sequence[str], order: Sequence[str] = tuple(f"m_{n}" for n in PLACE)
) -> DataFrame:
    """The state that each deliverable change is by itself: ``_id``, ``_put`` and a ``_set_`` per field.

    Of the message only its place in the log is kept.
    """
    place = F.struct(*order)
    whole = F.struct(
        place.alias("place"), (F.col("op") == DELETE).alias("gone"),
        *[F.when(F.col("op") == PUT, F.col(name)).alias(name) for name in fields],
    )
    patched = (F.col("op") == PATCH) & F.col("reason").isNull()
    sets = [
        F.when(
            patched & F.array_contains("present", name),
            F.struct(place.alias("place"), F.col(name).alias("value")),
        ).alias(f"_set_{name}")
        for name in fields
    ]
    deliverable = decoded.filter(F.col("reason").isNull())
    return deliverable.select("_id", F.when(F.col("op") != PATCH, whole).alias("_put"), *sets)


def fold_states(states: DataFrame, fields: Sequence[str], by: Sequence[str] = ("_id",)) -> DataFrame:
    """One state per document; patches that a later put or delete hides are dropped."""
    folded = states.groupBy(*by).agg(
        F.max_by("_put", "_put.place").alias("_put"),
        *[F.max(f"_set_{name}").alias(f"_set_{name}") for name in fields],
    )
    reset = F.col("_put.place")
    seen = {
        f"_set_{name}": F.when(
            reset.isNull() | (F.col(f"_set_{name}.place") > reset), F.col(f"_set_{name}")
        )
        for name in fields
    }
    return folded.withColumns(seen)


def _value(name: str) -> Column:
    patch = F.col(f"_set_{name}")
    return F.when(patch.isNotNull(), patch["value"]).otherwise(F.col(f"_put.{name}"))


def settled_states(folded: DataFrame, fields: Sequence[str]) -> DataFrame:
    """States as they stand where nothing is below them: tombstones and patches of unknown documents go.

    The patches are put into their documents, whose place is then that of the last of them.
    """
    places = [F.col("_put.place"), *[F.col(f"_set_{name}.place") for name in fields]]
    last = reduce(lambda a, b: F.when(b > a, b).otherwise(a), places)
    put = F.struct(
        last.alias("place"), F.lit(False).alias("gone"), *[_value(name).alias(name) for name in fields]
    )
    known = folded.filter(F.col("_put").isNotNull() & ~F.col("_put.gone"))
    none = [F.lit(None).cast(folded.schema[f"_set_{n}"].dataType).alias(f"_set_{n}") for n in fields]
    others = [c for c in folded.columns if c != "_put" and not c.startswith("_set_")]
    return known.select(*others, put.alias("_put"), *none)


def documents_of(folded: DataFrame, fields: Sequence[str]) -> DataFrame:
    """``_id`` and the fields of every document that is there."""
    known = folded.filter(F.col("_put").isNotNull() & ~F.col("_put.gone"))
    return known.select("_id", *[_value(name).alias(name) for name in fields])


def apply_changes(decoded: DataFrame, mapping: dict = ARTICLE_MAPPING, **options) -> DataFrame:
    """The documents that a whole log of typed changes leaves, in one batch job."""
    fields = list(mapping_fields(mapping))
    return documents_of(fold_states(change_states(decoded, fields, **options), fields), fields)
