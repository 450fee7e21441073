"""Row-level changes on a keyed table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordhaul.functions import times
from recordhaul.schemas import mapping_fields


def latest_per_key(df: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """The greatest row in ``order`` per key, reduced on the map side first."""
    last = F.max_by(F.struct(*df.columns), F.struct(*order))
    return df.groupBy(F.col(key).alias("_key")).agg(last.alias("_row")).select("_row.*")


def upsert(target: DataFrame | None, changes: DataFrame, key: str, order: Sequence[str]):
    """Put ``changes`` over ``target``: per key the row that is last in ``order`` wins.

    ``order`` must be a total order present in both, so the result depends neither on
    how changes are cut into batches nor on how often one is applied. ``target`` holds one row
    per key, as an upsert leaves it. Only the rows of changed keys are compared. The others pass by: where Spark can broadcast the changed keys, nothing of
    the target is shuffled but the rows that have one. The target is read twice.
    """
    if target is None:
        return latest_per_key(changes, key, order)
    keys = changes.select(F.col(key).alias("_changed")).distinct()
    same = target[key].eqNullSafe(F.col("_changed"))
    touched = target.join(keys, same, "left_semi")
    winners = latest_per_key(
        touched.unionByName(changes, allowMissingColumns=True), key, order
    )
    untouched = target.join(keys, same, "left_anti")
    return untouched.unionByName(winners, allowMissingColumns=True)


def document_id(id_column: Column, topic: Column, partition: Column, offset: Column) -> Column:
    """The id as text; without an id, one derived from the message's place in the log.

    A replayed message therefore gets the id it had before.
    """
    place = F.concat_ws("/", topic, partition.cast("string"), offset.cast("string"))
    return F.coalesce(id_column.cast("string"), F.sha2(place, 256))


def merge_fields(
    target: DataFrame,
    patch: DataFrame,
    key: str,
    fields: Sequence[str],
    order: Sequence[str],
    present: str = "present",
) -> DataFrame:
    """Write the patched fields into the documents, leaving the others alone.

    ``present`` holds the names a patch row really carries, so a field can be set to
    null. Several patches of one key are folded first, field by field, the last winning;
    fields new to the target are added. Patches of unknown keys change nothing.
    """
    place = F.struct(*order)
    folded = patch.groupBy(key).agg(
        *[
            F.max_by(
                F.struct(F.col(name).alias("value")),
                F.when(F.array_contains(present, name), place),
            ).alias(f"_set_{name}")
            for name in fields
        ]
    )
    columns = target.columns
    joined = target.join(folded, key, "left")

    def merged(name: str) -> Column:
        box = F.col(f"_set_{name}")
        old = F.col(name) if name in columns else F.lit(None)
        return F.when(box.isNotNull(), box["value"]).otherwise(old).alias(name)

    return joined.select(
        *[merged(name) if name in fields else F.col(name) for name in columns],
        *[merged(name) for name in fields if name not in columns],
    )


def delete_keys(target: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    return target.join(keys.select(key).distinct(), key, "left_anti")


def missing_keys(target: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """Keys to update or delete that the target does not have.

    The target is first cut down to the keys asked for, which Spark broadcasts if they are few.
    """
    wanted = keys.select(key).distinct()
    found = target.select(key).join(wanted, key, "left_semi").distinct()
    return wanted.join(found, key, "left_anti")


def conform_to_mapping(df: DataFrame, mapping: dict, bad: str = "bad_fields") -> DataFrame:
    """Cast text columns to the types of an index mapping.

    ``bad`` lists the fields whose value does not fit; such fields become null.
    """

    def cast(name: str, kind: str) -> Column:
        if kind == "long":
            return F.col(name).try_cast("bigint")
        if kind == "date":
            return times.parse_date(F.col(name).cast("string"))
        return F.col(name).cast("string")

    fields = mapping_fields(mapping)
    others = [name for name in df.columns if name not in fields]
    typed = df.select(
        *others,
        *[F.col(name).alias(f"_raw_{name}") for name in fields],
        *[cast(name, kind).alias(name) for name, kind in fields.items()],
    )
    failed = [
        F.when(F.col(f"_raw_{name}").isNotNull() & F.col(name).isNull(), F.lit(name))
        for name in fields
    ]
    return typed.withColumn(bad, F.array_compact(F.array(*failed))).drop(
        *[f"_raw_{name}" for name in fields]
    )
