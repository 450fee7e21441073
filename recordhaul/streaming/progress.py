"""Progress of running syncs as a table: rows, rates and completion of every batch.

Spark tells a listener what each micro-batch took, with the figures that were observed in its plan. Those
figures are counted where the rows pass, so nothing is read again for them. The listener holds the
batches that it has not written yet, ``FLUSH`` at most, and writes them to a folder of their own.
"""

from __future__ import annotations

import json
import threading
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

FLUSH = 100
OBSERVED = "sync"

PROGRESS = (
    "run string, query string, batch bigint, at string, rows bigint, rows_per_second double, "
    "seconds double, observed bigint, ended boolean, error string"
)


def observed(messages: DataFrame) -> DataFrame:
    """A stream of messages whose number is observed in every batch."""
    return messages.observe(OBSERVED, F.count(F.lit(1)).alias("consumed"))


class ProgressLog(StreamingQueryListener):
    """Writes the progress of all queries of a session below ``path``; add it with ``spark.streams.addListener``."""

    def __init__(self, spark: SparkSession, path: str, flush: int = FLUSH):
        self.spark, self.path, self.limit = spark, path, flush
        self.held: list[tuple] = []
        self.ended: set[str] = set()
        self._lock = threading.Lock()

    def onQueryStarted(self, event) -> None:  # noqa: N802 - the names are Spark's
        pass

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def onQueryProgress(self, event) -> None:  # noqa: N802
        told = json.loads(event.progress.json)
        counted = (told.get("observedMetrics") or {}).get(OBSERVED) or {}
        seconds = told.get("durationMs", {}).get("triggerExecution", 0) / 1000
        rows = told.get("numInputRows", 0)
        self._hold((
            told["runId"], told.get("name"), told["batchId"], told["timestamp"], rows,
            rows / seconds if seconds else None, seconds, counted.get("consumed"), False, None,
        ))

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        error = event.exception
        self._hold((str(event.runId), None, None, None, None, None, None, None, True, error and error[:1000]))
        self.flush()
        self.ended.add(str(event.runId))

    def _hold(self, row: tuple) -> None:
        with self._lock:
            self.held.append(row)
            full = len(self.held) >= self.limit
        if full:
            self.flush()

    def flush(self) -> None:
        """Write what is held; a batch is a row, so these are few."""
        with self._lock:
            rows, self.held = self.held, []
        if rows:
            part = self.spark.createDataFrame(rows, PROGRESS).coalesce(1)
            part.write.parquet(f"{self.path}/part={uuid.uuid4().hex}")


def progress(spark: SparkSession, path: str) -> DataFrame:
    """Every batch and every end of a run."""
    return spark.read.schema(PROGRESS).option("recursiveFileLookup", True).parquet(path)


def run_summary(told: DataFrame) -> DataFrame:
    """One row a run: batches, rows, rows per second over all its batches, and whether it has ended well."""
    return told.groupBy("run").agg(
        F.countDistinct("batch").alias("batches"),
        F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"),
        F.coalesce(F.sum("observed"), F.lit(0)).alias("consumed"),
        (F.sum("rows") / F.nullif(F.sum("seconds"), F.lit(0.0))).alias("rows_per_second"),
        F.bool_or("ended").alias("ended"),
        F.max("error").alias("error"),
    )
