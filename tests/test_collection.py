"""Typed changes, their fold, and the collection of bucketed runs."""

from __future__ import annotations

import itertools
import json
import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from recordhaul.operators.folding import (
    change_states,
    decode_changes,
    documents_of,
    fold_states,
    settled_states,
)
from recordhaul.schemas import TYPED_ENVELOPE
from recordhaul.sources.messages import read_message_files
from recordhaul.streaming import collection as C
from recordhaul.streaming.sync import run_sync

FIELDS = ["id", "account_id", "origin_id", "title", "content", "created_at"]


def message(offset, key, value, op=None, topic="t"):
    body = None if value is None else value if isinstance(value, str) else json.dumps(value)
    return (topic, 0, offset, None if key is None else str(key), body, None, op)


def put(offset, key, **fields):
    return message(offset, key, {"id": key, **fields})


def patch(offset, key, **fields):
    return message(offset, key, fields, "patch")


def delete(offset, key):
    return message(offset, key, None, "delete")


def frame(spark, rows):
    return spark.createDataFrame(rows, TYPED_ENVELOPE)


def expected(rows):
    """The documents that the messages leave, one after the other."""
    held = {}
    for _, _, _, key, value, _, op in sorted(rows, key=lambda r: r[2]):
        if op == "delete" or value is None:
            held.pop(key, None)
        elif op == "patch":
            if key in held:
                held[key].update(json.loads(value))
        else:
            held[key] = json.loads(value)
    return {k: (v.get("title"), v.get("content")) for k, v in held.items()}


def found(documents):
    return {r["_id"]: (r["title"], r["content"]) for r in documents.collect()}


def log(seed, count=120, ids=9):
    draw = random.Random(seed)
    out = []
    for n in range(count):
        key, kind = draw.randrange(ids), draw.random()
        if kind < 0.2:
            out.append(delete(n, key))
        elif kind < 0.6:
            fields = draw.choice([{"title": f"p{n}"}, {"content": None}, {"title": None, "content": f"c{n}"}, {}])
            out.append(patch(n, key, **fields))
        else:
            out.append(put(n, key, title=f"t{n}", content=f"b{n}"))
    return out


def test_changes_are_decoded_by_what_they_say(spark):
    rows = [
        put(0, 1, title="a"), message(1, 1, None), patch(2, 1, title="b"), message(3, None, {"title": "x"}, "patch"),
        message(4, 1, "{", "patch"), message(5, 1, {"created_at": "when"}, "patch"), message(6, 1, {}, "move"),
        message(7, 1, {"title": "no id"}), message(8, None, None), message(9, 1, {"id": 1}, "PUT"),
    ]
    decoded = {r["m_offset"]: r for r in decode_changes(frame(spark, rows)).collect()}
    assert [decoded[n]["reason"] for n in range(10)] == [
        None, None, None, "no_id", "malformed", "type", "op", "no_id", "no_id", None
    ]
    assert [decoded[n]["op"] for n in (0, 1, 2, 9)] == ["put", "delete", "patch", "put"]
    assert decoded[2]["present"] == ["title"] and decoded[1]["_id"] == "1"
    made = decode_changes(frame(spark, rows[7:8]), generate_ids=True).first()
    assert made["reason"] is None and len(made["_id"]) == 64


@pytest.mark.parametrize("seed", [1, 2])
def test_fold_is_associative_and_takes_any_order(spark, seed):
    rows = log(seed, 60, 5)
    states = change_states(decode_changes(frame(spark, rows)), FIELDS)
    assert found(documents_of(fold_states(states, FIELDS), FIELDS)) == expected(rows)
    draw = random.Random(seed)
    mixed = rows[:]
    draw.shuffle(mixed)
    cuts = [mixed[:20], mixed[20:25], mixed[25:], mixed[:7]]  # the last ones come twice
    parts = [fold_states(change_states(decode_changes(frame(spark, c)), FIELDS), FIELDS) for c in cuts]
    left = parts[0]
    for part in parts[1:]:
        left = fold_states(left.unionByName(part), FIELDS)
    assert found(documents_of(left, FIELDS)) == expected(rows)


def test_a_fold_needs_no_row_per_change_in_the_shuffle(spark):
    rows = [put(n, n % 2, title=f"t{n}") for n in range(200)]
    states = change_states(decode_changes(frame(spark, rows)), FIELDS)
    plan = fold_states(states, FIELDS)._jdf.queryExecution().executedPlan().toString()
    assert "partial_max" in plan


def test_tombstones_end_at_the_bottom(spark):
    rows = [put(0, 1, title="a"), delete(1, 1), delete(2, 2), patch(3, 3, title="x"), put(4, 4), patch(5, 4, title="y")]
    folded = fold_states(change_states(decode_changes(frame(spark, rows)), FIELDS), FIELDS)
    assert folded.count() == 4
    bottom = settled_states(folded, FIELDS)
    assert [r["_id"] for r in bottom.collect()] == ["4"]
    row = bottom.first()
    assert row["_put"]["title"] == "y" and row["_put"]["place"]["m_offset"] == 5 and row["_set_title"] is None


def deliver(spark, root, batches, **options):
    handler = C.collection_handler(root, **options)
    for n, rows in batches:
        handler(frame(spark, rows), n)


def _files(root, part):
    return {str(p) for p in Path(root).glob(f"{part}/*/bucket=*/part-*.parquet")}


@pytest.mark.parametrize("seed", [3, 4])
def test_collection_after_any_compaction(spark, tmp_path, seed):
    root, rows = str(tmp_path / "c"), log(seed)
    sizes = [10, 1, 30, 5, 25, 9, 20, 20]
    starts = [0, *itertools.accumulate(sizes)]
    for n, (a, b) in enumerate(itertools.pairwise(starts)):
        deliver(spark, root, [(n, rows[a:b])], buckets=4)
        if n % 2:
            C.compact(spark, root, fanout=2)
        if n in (3, 6):
            C.merge_base(spark, root, share=0.5)
        if n == 5:
            C.clean_up(spark, root)
        assert found(C.collection(spark, root)) == expected(rows[:b])
    C.merge_base(spark, root, share=0)
    C.clean_up(spark, root)
    assert found(C.collection(spark, root)) == expected(rows)
    assert not _files(root, "runs")
    gone = spark.read.parquet(f"{root}/base").filter("_put.gone OR _put IS NULL")
    assert gone.count() == 0


def test_untouched_buckets_keep_their_files(spark, tmp_path):
    root = str(tmp_path / "c")
    deliver(spark, root, [(0, [put(n, n, title="first") for n in range(60)])], buckets=8)
    assert len(C.merge_base(spark, root)) == 8
    before = _files(root, "base")
    deliver(spark, root, [(1, [patch(100, 7, title="new"), put(101, 7, title="newer")])], buckets=8)
    known = C.layout(spark, root)
    assert len(known.touched) == 1
    assert C.merge_base(spark, root, share=0) == known.touched
    assert before <= _files(root, "base") and len(_files(root, "base")) == 9
    C.clean_up(spark, root)
    kept = _files(root, "base")
    assert len(before & kept) == 7 and len(kept) == 8
    assert found(C.collection(spark, root))["7"] == ("newer", None)


def test_small_changes_do_not_rewrite_a_base(spark, tmp_path):
    root = str(tmp_path / "c")
    deliver(spark, root, [(0, [put(n, n, content="x" * 500 + str(n * 7919)) for n in range(400)])], buckets=1)
    C.merge_base(spark, root)
    deliver(spark, root, [(1, [patch(999, 3, title="new")])], buckets=1)
    assert C.merge_base(spark, root, share=0.9) == set()
    assert found(C.collection(spark, root))["3"][0] == "new"


def test_reading_opens_changed_buckets_and_bases_only(spark, tmp_path):
    root = str(tmp_path / "c")
    deliver(spark, root, [(0, [put(n, n, title="first") for n in range(60)])], buckets=8)
    C.merge_base(spark, root)
    C.clean_up(spark, root)
    deliver(spark, root, [(1, [put(100, 7, title="new")])], buckets=8)
    plan = C.collection(spark, root)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan
    read = C.collection(spark, root).select("_id", F.input_file_name().alias("f")).distinct()
    assert read.count() == 60


def test_delivery_again_and_broken_off_merges_change_nothing(spark, tmp_path):
    root = str(tmp_path / "c")
    batches = [(n, [put(10 * n + k, k, title=f"b{n}") for k in range(n, 5)]) for n in range(4)]
    deliver(spark, root, batches[:2], buckets=2)
    deliver(spark, root, batches[1:2], buckets=2)
    state = found(C.collection(spark, root))
    assert state == expected([m for _, rows in batches[:2] for m in rows])
    C.compact(spark, root, fanout=2)
    deliver(spark, root, batches[:2], buckets=2)  # in a higher run: nothing to do
    assert {run.level for run in C.layout(spark, root).runs} == {1}
    for broken in (f"{root}/runs/2-0-3/bucket=0", f"{root}/base/1-3/bucket=0", f"{root}/merged/1-3/bucket=0"):
        Path(broken).mkdir(parents=True)
    assert found(C.collection(spark, root)) == state
    deliver(spark, root, batches[2:], buckets=2)
    assert C.merge_base(spark, root, share=0) == {0, 1}
    assert found(C.collection(spark, root)) == expected([m for _, rows in batches for m in rows])
    deliver(spark, root, batches[3:], buckets=2)
    assert found(C.collection(spark, root)) == expected([m for _, rows in batches for m in rows])


def test_empty_batches_and_everything_deleted(spark, tmp_path):
    root = str(tmp_path / "c")
    with pytest.raises(ValueError):
        C.collection(spark, root)
    deliver(spark, root, [(0, []), (1, [message(0, 1, "{")])], buckets=2)
    assert found(C.collection(spark, root)) == {}
    assert C.merge_base(spark, root) == set()
    deliver(spark, root, [(2, [put(1, 1)]), (3, [delete(2, 1)])], buckets=2)
    C.compact(spark, root, fanout=2)
    assert found(C.collection(spark, root)) == {}
    assert len(C.merge_base(spark, root)) == 1
    assert found(C.collection(spark, root)) == {} and C.clean_up(spark, root)
    assert found(C.collection(spark, root)) == {}
    dead = spark.read.parquet(f"{root}/dead_letters").collect()
    assert [(r["offset"], r["reason"]) for r in dead] == [(0, "malformed")]


def test_collection_follows_a_stream(spark, tmp_path):
    rows, folder, root = log(9), str(tmp_path / "log"), str(tmp_path / "c")
    for n in range(6):
        frame(spark, rows[20 * n : 20 * n + 20]).coalesce(1).write.parquet(f"{folder}/{n}")
    stream = read_message_files(spark, f"{folder}/*", max_files=1, schema=TYPED_ENVELOPE)
    handler = C.collection_handler(root, buckets=4, compact_every=2)
    run_sync(stream, root, handler=handler).awaitTermination()
    assert found(C.collection(spark, root)) == expected(rows)
    assert C.layout(spark, root).base
