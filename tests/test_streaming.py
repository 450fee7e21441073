import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from recordhaul.plans.full_load import full_load_through_log
from recordhaul.schemas import ENVELOPE
from recordhaul.sinks.delivery import send_rows
from recordhaul.sources.messages import read_message_files
from recordhaul.streaming import collection, sync


def put(spark, log, name, rows):
    """One file of (offset, value) messages."""
    frame = spark.createDataFrame(
        [("t", 0, offset, None, value, None) for offset, value in rows], ENVELOPE
    )
    frame.coalesce(1).write.parquet(f"{log}/{name}")


def doc(n, title, **more):
    return json.dumps({"id": n, "title": title, **more})


@pytest.fixture
def places(tmp_path):
    return str(tmp_path / "log"), str(tmp_path / "root")


def run(spark, log, root, **options):
    stream = read_message_files(spark, f"{log}/*", max_files=1, topics=["t"])
    query = sync.run_sync(stream, root, **options)
    query.awaitTermination()
    return query


def titles(spark, root):
    return {row["_id"]: row["title"] for row in sync.current_documents(spark, root).collect()}


def test_sync_restart_and_replay(spark, places):
    log, root = places
    put(spark, log, "a", [(0, doc(1, "one")), (1, doc(2, "two")), (2, "{"), (3, doc(1, "uno"))])
    put(spark, log, "b", [(4, doc(2, "dos")), (5, json.dumps({"title": "no id"}))])
    run(spark, log, root)
    assert titles(spark, root) == {"1": "uno", "2": "dos"}
    reasons = {(row["offset"], row["reason"]) for row in sync.dead_letters(spark, root).collect()}
    assert reasons == {(2, "malformed"), (5, "no_id")}
    assert tuple(sync.totals(spark, root).first()) == (6, 4, 2, 66.67)

    run(spark, log, root)  # nothing new: nothing read twice
    assert sync.totals(spark, root).first()["consumed"] == 6

    put(spark, log, "c", [(6, doc(3, "three"))])
    run(spark, log, root)
    assert titles(spark, root) == {"1": "uno", "2": "dos", "3": "three"}

    batch = spark.read.schema(ENVELOPE).parquet(f"{log}/a")
    last = spark.read.parquet(f"{root}/changes").agg(F.max("batch_id")).first()[0]
    handler = sync.batch_handler(root)
    for _ in range(2):  # an old batch delivered again changes nothing
        handler(batch, last + 1)
        assert titles(spark, root) == {"1": "uno", "2": "dos", "3": "three"}
    assert sync.totals(spark, root).first()["consumed"] == 11


def test_compaction_changes_nothing(spark, places):
    log, root = places
    put(spark, log, "a", [(n, doc(n % 4, f"t{n}")) for n in range(10)])
    run(spark, log, root)
    before = titles(spark, root)
    assert sync.compact(spark, root) == 0
    assert titles(spark, root) == before
    assert sync.compact(spark, root) == 0
    put(spark, log, "b", [(10, doc(0, "new")), (11, doc(9, "nine"))])
    run(spark, log, root)
    after = {**before, "0": "new", "9": "nine"}
    assert titles(spark, root) == after
    assert sync.compact(spark, root) == 1
    assert titles(spark, root) == after


def test_failing_sink_becomes_dead_letters(spark, places):
    log, root = places
    put(spark, log, "a", [(0, doc(1, "one")), (1, "x")])

    def broken(df, path):
        raise OSError("sink is down")

    run(spark, log, root, write=broken, attempts=2, pause=0)
    dead = {
        (row["offset"], row["reason"], row["attempts"])
        for row in sync.dead_letters(spark, root).collect()
    }
    assert dead == {(0, "write_failed", 2), (1, "malformed", 0)}
    assert tuple(sync.totals(spark, root).first()) == (2, 0, 2, 0.0)
    with pytest.raises(ValueError):
        sync.current_documents(spark, root)


@pytest.mark.parametrize(("failures", "ok", "attempts", "pauses"), [(0, True, 1, 0), (2, True, 3, 2), (9, False, 3, 2)])
def test_retry(failures, ok, attempts, pauses):
    calls, slept = [], []

    def flaky(df, path):
        calls.append(path)
        if len(calls) <= failures:
            raise OSError("again")

    outcome = sync.write_with_retry(None, "p", flaky, sleep=slept.append)
    assert (outcome.ok, outcome.attempts, len(slept)) == (ok, attempts, pauses)
    assert set(slept) <= {2.0}
    with pytest.raises(ValueError):
        sync.write_with_retry(None, "p", flaky, attempts=0)


def test_continuous_run_can_be_stopped(spark, places):
    log, root = places
    put(spark, log, "a", [(0, doc(1, "one"))])
    stream = read_message_files(spark, f"{log}/*")
    query = sync.run_sync(stream, root, continuous=True, interval="1 second")
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    assert titles(spark, root) == {"1": "one"}


def test_full_load_through_the_log(spark, tmp_path):
    articles = spark.range(1, 200).select(
        "id",
        F.concat(F.lit("o"), "id").alias("origin_id"),
        F.lit("title").alias("title"),
        F.lit("content").alias("content"),
        F.lit(1).alias("account_id"),
        F.lit("2024-01-01 00:00:00").cast("timestamp").alias("created_at"),
    )
    log, root = str(tmp_path / "log"), str(tmp_path / "root")
    documents = full_load_through_log(spark, articles, log, root)
    assert sorted(row["id"] for row in documents.collect()) == list(range(1, 200))


def test_compaction_stops_at_a_batch_that_broke_off(spark, places):
    log, root = places
    for n, name in enumerate("abc"):
        put(spark, log, name, [(n, doc(n, f"t{n}"))])
        run(spark, log, root)
    whole = titles(spark, root)
    marks = [Path(f"{root}/{kind}/batch_id=1/_SUCCESS") for kind in ("changes", "totals")]
    for mark in marks:
        mark.unlink()
    assert sync.compact(spark, root) == 0
    assert titles(spark, root) == {"0": "t0"}
    for mark in marks:  # the batch is delivered again
        mark.touch()
    assert titles(spark, root) == whole
    assert sync.compact(spark, root) == 2
    assert titles(spark, root) == whole


def test_an_error_in_computing_fails_the_query(spark, places):
    log, root = places
    put(spark, log, "a", [(0, doc(1, "one"))])
    stream = read_message_files(spark, f"{log}/*", topics=["t"])
    broken = stream.withColumn("value", F.when(F.col("offset") >= 0, F.raise_error(F.lit("no row"))))
    with pytest.raises(Exception, match="no row"):
        sync.run_sync(broken, root, attempts=2, pause=0).awaitTermination()
    assert not Path(f"{root}/dead_letters").exists()


def test_dead_letters_reach_their_topic_once(spark, places, tmp_path):
    log, root = places
    topic = str(tmp_path / "dlq")
    put(spark, log, "a", [(0, doc(1, "one")), (1, "{"), (2, "[]")])
    run(spark, log, root, dead_topic=topic)
    sync.batch_handler(root, dead_topic=topic)(spark.read.schema(ENVELOPE).parquet(f"{log}/a"), 0)
    rows = {(r["topic"], r["partition"], r["value"]) for r in spark.read.parquet(topic).collect()}
    assert rows == {("full_load_dlq", 0, "{"), ("full_load_dlq", 0, "[]")}
    assert spark.read.parquet(topic).count() == 2


def _sender_that_refuses(number, failures=0):
    def make():
        calls = []

        def send(rows):
            calls.append(1)
            if len(calls) <= failures:
                raise OSError("down")
            return ["too long" if r["id"] == number else None for r in rows]

        return send

    return make


def test_a_task_retries_its_own_rows(spark, places):
    log, root = places
    put(spark, log, "a", [(n, doc(n, f"t{n}")) for n in range(9)] + [(9, "x")])
    handler = sync.delivery_handler(root, _sender_that_refuses(4, failures=2), call_rows=100, pause=0)
    run(spark, log, root, handler=handler)
    dead = {(r["offset"], r["reason"], r["attempts"]) for r in sync.dead_letters(spark, root).collect()}
    assert (9, "malformed", 0) in dead and len(dead) == 2
    assert {x[:2] for x in dead} == {(4, "too long"), (9, "malformed")}
    assert tuple(sync.totals(spark, root).first()) == (10, 8, 2, 80.0)


def test_a_sink_that_stays_down_costs_its_calls_only(spark, places):
    log, root = places
    put(spark, log, "a", [(n, doc(n, f"t{n}")) for n in range(6)])

    def make():
        def send(rows):
            if any(r["id"] == 2 for r in rows):
                raise OSError("down")
            return [None] * len(rows)

        return send

    run(spark, log, root, handler=sync.delivery_handler(root, make, call_rows=1, pause=0, attempts=2))
    dead = [(r["offset"], r["reason"], r["attempts"]) for r in sync.dead_letters(spark, root).collect()]
    assert dead == [(2, "write_failed", 2)]


def test_messages_without_an_id_are_delivered_with_one(spark, places):
    log, root = places
    put(spark, log, "a", [(0, json.dumps({"title": "a"})), (1, json.dumps({"title": "b"}))])

    def make():
        return lambda rows: [None if len(r["_id"]) == 64 else "no id" for r in rows]

    run(spark, log, root, handler=sync.delivery_handler(root, make, generate_ids=True))
    assert sync.dead_letters(spark, root).count() == 0 and sync.totals(spark, root).first()["ok"] == 2


@pytest.mark.parametrize(("failures", "tries", "pauses"), [(0, 1, 0), (2, 3, 2), (9, 3, 2)])
def test_calls_and_pauses(failures, tries, pauses):
    slept = []
    send = _sender_that_refuses(1, failures)()
    refused, took = send_rows([{"id": 1}, {"id": 2}], send, 3, 2.0, slept.append)
    assert (took, len(slept)) == (tries, pauses)
    assert refused == (["write_failed"] * 2 if failures > 3 else ["too long", None])
    with pytest.raises(ValueError):
        send_rows([{"id": 1}], lambda rows: [], 3, 0)


def test_a_batch_of_one_file_is_decoded_by_all_slots(spark, tmp_path, monkeypatch):
    rows = [("t", 0, n, str(n), doc(n, "x"), None) for n in range(400)]
    batch = spark.createDataFrame(rows, ENVELOPE).coalesce(1)
    seen = {}

    def told(name, decode):
        def count(messages, *args, **options):
            tasks = messages.groupBy(F.spark_partition_id().alias("task")).count().collect()
            seen[name] = len(tasks), sum(row["count"] for row in tasks)
            return decode(messages, *args, **options)

        return count

    monkeypatch.setattr(sync, "decode_messages", told("sync", sync.decode_messages))
    sync.batch_handler(str(tmp_path / "a"))(batch, 0)
    monkeypatch.setattr(sync, "decode_messages", told("delivery", sync.decode_messages))
    sync.delivery_handler(str(tmp_path / "b"), lambda: lambda rows: [None] * len(rows))(batch, 0)
    monkeypatch.setattr(collection, "decode_changes", told("collection", collection.decode_changes))
    collection.collection_handler(str(tmp_path / "c"))(batch, 0)
    assert sorted(seen) == ["collection", "delivery", "sync"]
    assert all(tasks >= 4 and rows == 400 for tasks, rows in seen.values()), seen
