"""Continuous synchronisation: message log -> keyed documents, restart-safe.

Each micro-batch writes what it changed into a folder of its own, named by the batch
id, and nothing else. A batch that is run again replaces its folder, so at-least-once
delivery ends in the same documents, and a batch costs what it holds, not what the
whole collection holds. Reading takes the latest row per id over the newest base and
the batches after it; ``compact`` writes a new base from time to time.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from recordhaul.operators.changes import latest_per_key
from recordhaul.operators.messages import (
    PLACE,
    dead_letter_messages,
    decode_messages,
    split_dead_letters,
    sync_totals,
)
from recordhaul.schemas import ARTICLE_MAPPING
from recordhaul.session import matches, stage
from recordhaul.sinks.delivery import Sender, deliver
from recordhaul.sources.messages import spread

# Tries and pause of a failing write, time between commits.
ATTEMPTS = 3
PAUSE_SECONDS = 2.0
COMMIT_INTERVAL = "10 seconds"

DEFAULT_ORDER = [f"m_{name}" for name in PLACE]

Writer = Callable[[DataFrame, str], None]


def write_parquet(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


@dataclass
class WriteOutcome:
    ok: bool
    attempts: int
    error: Exception | None = None


def write_with_retry(
    df: DataFrame,
    path: str,
    write: Writer = write_parquet,
    attempts: int = ATTEMPTS,
    pause: float = PAUSE_SECONDS,
    sleep: Callable[[float], None] = time.sleep,
) -> WriteOutcome:
    """Write a batch, trying again after a pause; no pause follows the last failure."""
    if attempts < 1:
        raise ValueError("attempts must be at least 1")
    for attempt in range(1, attempts + 1):
        try:
            write(df, path)
            return WriteOutcome(True, attempt)
        except Exception as error:  # noqa: BLE001 - whatever the sink raises is retried
            last = error
        if attempt < attempts:
            sleep(pause)
    return WriteOutcome(False, attempts, last)


def batch_handler(
    root: str,
    mapping: dict = ARTICLE_MAPPING,
    key: str = "id",
    order: Sequence[str] = DEFAULT_ORDER,
    write: Writer = write_parquet,
    attempts: int = ATTEMPTS,
    pause: float = PAUSE_SECONDS,
    dead_topic: str | None = None,
) -> Callable[[DataFrame, int], None]:
    """The ``foreachBatch`` function: decode, keep the last row per id, write, account.

    Messages that cannot be decoded, and all documents of a batch whose write keeps
    failing, become dead letters; the offset moves on. An error in computing the batch is none of its
    write: it fails the query, which goes on from its checkpoint. With ``dead_topic`` dead letters are
    also written there, as messages of their own topic.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        decoded = decode_messages(spread(batch), mapping, key).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            documents, dead = split_dead_letters(decoded)
            # Of the message only its place is kept beside the fields.
            envelope = [c for c in documents.columns if c.startswith("m_") and c not in order]
            changes = latest_per_key(documents.drop(*envelope), "_id", order)
            changes = changes.persist(StorageLevel.MEMORY_AND_DISK)
            changes.count()  # computed before the first try, so that only the write is tried again
            outcome = write_with_retry(
                changes, f"{root}/changes/batch_id={batch_id}", write, attempts, pause
            )
            judged = decoded
            if not outcome.ok:
                judged = decoded.withColumn(
                    "reason", F.coalesce("reason", F.lit("write_failed"))
                )
                _, dead = split_dead_letters(judged)
                dead = dead.withColumn(
                    "attempts",
                    F.when(F.col("reason") == "write_failed", outcome.attempts).otherwise(0),
                )
            changes.unpersist()
            write_dead_letters(dead, root, batch_id, dead_topic)
            write_parquet(sync_totals(judged), f"{root}/totals/batch_id={batch_id}")
        finally:
            decoded.unpersist()

    return handle


def write_dead_letters(dead: DataFrame, root: str, batch_id: int, topic: str | None = None) -> None:
    """Dead letters of a batch with their reasons, and as messages to the log ``topic`` if there is one.

    Both go to folders of the batch, so a batch that is run again leaves none twice.
    """
    write_parquet(dead, f"{root}/dead_letters/batch_id={batch_id}")
    if topic is not None:
        kept = dead.sparkSession.read.schema(dead.schema).parquet(f"{root}/dead_letters/batch_id={batch_id}")
        write_parquet(dead_letter_messages(kept), f"{topic}/batch_id={batch_id}")


def delivery_handler(
    root: str,
    make_sender: Callable[[], Sender],
    mapping: dict = ARTICLE_MAPPING,
    key: str = "id",
    order: Sequence[str] = DEFAULT_ORDER,
    generate_ids: bool = False,
    dead_topic: str | None = None,
    **delivery,
) -> Callable[[DataFrame, int], None]:
    """The ``foreachBatch`` function for a sink outside of Spark: each task sends its rows, in calls.

    A task retries its own calls; what it gives up or the sink refuses comes back as rows and becomes dead
    letters, the rest of the batch is delivered. Documents of one batch are sent once per id. With
    ``generate_ids``, a message without an id gets one from its place in the log. A batch that is run
    again sends again, under the same ids.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        decoded = decode_messages(spread(batch), mapping, key, not generate_ids)
        decoded = decoded.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            documents, undecoded = split_dead_letters(decoded)
            sent = deliver(latest_per_key(documents, "_id", order), make_sender, **delivery)
            sent = stage(sent, "delivery")  # sends; a lost task sends its rows again
            rejected = sent.filter(F.col("reason").isNotNull())
            _, given_up = split_dead_letters(rejected.drop("attempts", "delivered"))
            tries = rejected.select(*[F.col(c) for c in order], F.col("attempts").alias("_tries"))
            at = [given_up[c.removeprefix("m_")].eqNullSafe(tries[c]) for c in order]
            given_up = given_up.join(tries, at).withColumn("attempts", F.col("_tries"))
            dead = undecoded.unionByName(given_up.select(*undecoded.columns))
            write_dead_letters(dead, root, batch_id, dead_topic)
            lost = rejected.select(F.lit("x").alias("reason"))
            held = decoded.select(F.col("reason")).unionByName(lost)
            figures = held.agg(
                F.count("*").alias("seen"), F.count_if(F.col("reason") == "x").alias("lost"),
                F.count_if(F.col("reason").isNotNull()).alias("failed"),
            )
            consumed = F.col("seen") - F.col("lost")
            share = F.round((consumed - F.col("failed")) * 100.0 / F.nullif(consumed, F.lit(0)), 2)
            write_parquet(
                figures.select(
                    consumed.alias("consumed"), (consumed - F.col("failed")).alias("ok"), "failed",
                    share.alias("ok_pct"),
                ),
                f"{root}/totals/batch_id={batch_id}",
            )
        finally:
            decoded.unpersist()

    return handle


def run_sync(
    messages: DataFrame,
    root: str,
    checkpoint: str | None = None,
    continuous: bool = False,
    interval: str = COMMIT_INTERVAL,
    handler: Callable[[DataFrame, int], None] | None = None,
    **options,
) -> StreamingQuery:
    """Start the sync. It stops by itself at the end of the log unless ``continuous``.

    Offsets live in the checkpoint. How much one batch takes is an option of the source.
    """
    handler = handler or batch_handler(root, **options)
    writer = messages.writeStream.foreachBatch(handler).option(
        "checkpointLocation", checkpoint or f"{root}/checkpoint"
    )
    if continuous:
        writer = writer.trigger(processingTime=interval)
    else:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def _bases(spark: SparkSession, root: str) -> list[int]:
    """Batch ids up to which a finished base exists, in ascending order."""
    done = matches(spark, f"{root}/base/through=*/_SUCCESS")
    return sorted(int(path.split("through=")[-1].split("/")[0]) for path in done)


def _batches(spark: SparkSession, pattern: str) -> set[int]:
    found = matches(spark, pattern)
    return {int(path.split("batch_id=")[-1].split("/")[0]) for path in found}


def _committed(spark: SparkSession, root: str) -> list[int]:
    """Batches whose changes are in, up to the first one that broke off and will be run again.

    A batch whose write was given up has its totals and no changes, and stops nothing.
    """
    done = _batches(spark, f"{root}/changes/batch_id=*/_SUCCESS")
    settled = done | _batches(spark, f"{root}/totals/batch_id=*/_SUCCESS")
    broken = _batches(spark, f"{root}/changes/batch_id=*") - settled
    return sorted(batch for batch in done if not broken or batch < min(broken))


def _changes(spark: SparkSession, root: str, after: int | None) -> DataFrame | None:
    batches = [n for n in _committed(spark, root) if after is None or n > after]
    if not batches:
        return None
    folders = [f"{root}/changes/batch_id={n}" for n in batches]
    return spark.read.option("basePath", f"{root}/changes").parquet(*folders)


def current_documents(
    spark: SparkSession, root: str, order: Sequence[str] = DEFAULT_ORDER
) -> DataFrame:
    """The latest row per id."""
    bases = _bases(spark, root)
    through = bases[-1] if bases else None
    changes = _changes(spark, root, through)
    parts = [] if changes is None else [changes.drop("batch_id")]
    if through is not None:
        parts.append(spark.read.parquet(f"{root}/base/through={through}"))
    if not parts:
        raise ValueError(f"nothing has been synchronised to {root}")
    rows = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    return latest_per_key(rows, "_id", order)


def compact(spark: SparkSession, root: str, order: Sequence[str] = DEFAULT_ORDER) -> int | None:
    """Write a base that holds everything up to the newest committed batch; returns its id.

    Older bases and batches stay as they are; readers take the newest finished base.
    """
    bases = _bases(spark, root)
    newest = max(_committed(spark, root), default=None)
    if newest is None or (bases and newest <= bases[-1]):
        return bases[-1] if bases else None
    changes = _changes(spark, root, bases[-1] if bases else None)
    rows = changes.filter(F.col("batch_id") <= newest).drop("batch_id")
    if bases:
        rows = rows.unionByName(spark.read.parquet(f"{root}/base/through={bases[-1]}"))
    write_parquet(latest_per_key(rows, "_id", order), f"{root}/base/through={newest}")
    return newest


def dead_letters(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.parquet(f"{root}/dead_letters")


def totals(spark: SparkSession, root: str) -> DataFrame:
    """Messages consumed, delivered and failed over all batches."""
    batches = spark.read.parquet(f"{root}/totals")
    summed = batches.agg(*[F.sum(name).alias(name) for name in ("consumed", "ok", "failed")])
    share = F.round(F.col("ok") * 100.0 / F.nullif(F.col("consumed"), F.lit(0)), 2)
    return summed.withColumn("ok_pct", share)
