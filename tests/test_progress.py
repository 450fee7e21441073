"""Progress of streaming runs as a table."""

from __future__ import annotations

import time

import pytest

from recordhaul.sources.messages import read_message_files
from recordhaul.streaming import progress, sync
from tests.test_streaming import doc, put


def _ended(log):
    until = time.time() + 30
    while not log.ended and time.time() < until:
        time.sleep(0.1)
    assert log.ended


@pytest.mark.parametrize("flush", [1, 100])
def test_progress_of_a_run_equals_its_totals(spark, tmp_path, flush):
    log, root, path = (str(tmp_path / name) for name in ("log", "root", "progress"))
    put(spark, log, "a", [(0, doc(1, "one")), (1, "{"), (2, doc(2, "two"))])
    put(spark, log, "b", [(3, doc(3, "three"))])
    listener = progress.ProgressLog(spark, path, flush)
    spark.streams.addListener(listener)
    try:
        stream = read_message_files(spark, f"{log}/*", max_files=1)
        query = sync.run_sync(progress.observed(stream), root)
        query.awaitTermination()
        _ended(listener)
    finally:
        spark.streams.removeListener(listener)
    row = progress.run_summary(progress.progress(spark, path)).filter(f"run = '{query.runId}'").first()
    totals = sync.totals(spark, root).first()
    assert (row["batches"], row["consumed"], row["ended"], row["error"]) == (2, totals["consumed"], True, None)
    assert row["rows"] >= 4 and row["rows_per_second"] > 0


def test_a_run_that_fails_ends_with_its_error(spark, tmp_path):
    log, path = str(tmp_path / "log"), str(tmp_path / "progress")
    put(spark, log, "a", [(0, doc(1, "one"))])
    listener = progress.ProgressLog(spark, path)
    spark.streams.addListener(listener)

    def broken(batch, batch_id):
        raise ValueError("no sink")

    try:
        query = sync.run_sync(read_message_files(spark, f"{log}/*"), str(tmp_path / "root"), handler=broken)
        with pytest.raises(Exception, match="no sink"):
            query.awaitTermination()
        _ended(listener)
    finally:
        spark.streams.removeListener(listener)
    row = progress.run_summary(progress.progress(spark, path)).first()
    assert row["ended"] and "no sink" in row["error"]
