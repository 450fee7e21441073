"""Progress of a log by bitmaps, against sets of numbers."""

from __future__ import annotations

import random

import pytest

from recordhaul.schemas import ENVELOPE
from recordhaul.sinks.messages import write_message_files
from recordhaul.sources.messages import read_message_files
from recordhaul.streaming import offsets


def frame(spark, places):
    rows = [("t" if p is not None else None, p, o, None, "{}", None) for p, o in places]
    return spark.createDataFrame(rows, ENVELOPE)


def expected(places):
    seen, rows = {}, {}
    for p, o in places:
        if p is not None and o is not None and o >= 0:
            seen.setdefault(p, set()).add(o)
            rows[p] = rows.get(p, 0) + 1
    told, gaps = set(), set()
    for p, numbers in seen.items():
        span = max(numbers) + 1 - min(numbers)
        told.add(("t", p, min(numbers), max(numbers) + 1, rows[p], rows[p] - len(numbers), span - len(numbers)))
        ordered = sorted(numbers)
        gaps |= {("t", p, a + 1, b - 1) for a, b in zip(ordered, ordered[1:]) if b > a + 1}
    return told, gaps


def found(blocks):
    order = ["topic", "partition", "first_offset", "next_offset", "messages", "replays", "missing"]
    told = {tuple(row) for row in offsets.offset_progress(blocks).select(*order).collect()}
    return told, {tuple(row) for row in offsets.offset_gaps(blocks).collect()}


EDGE = offsets.BLOCK
CASES = {
    "none": [],
    "one": [(0, 0)],
    "block ends": [(0, EDGE - 1), (0, EDGE), (1, EDGE - 1), (1, EDGE + 1), (2, 3 * EDGE), (2, 9 * EDGE - 1)],
    "full block": [(0, n) for n in range(EDGE + 3)] + [(0, EDGE + 5)],
    "no place": [(None, 4), (0, None), (0, -1), (1, 7)],
    "far": [(0, 2**40), (0, 2**40 + 2), (0, 2**40 + 2)],
    "replays": [(1, n % 50) for n in range(1000)],
}


@pytest.mark.parametrize("name", sorted(CASES))
def test_table(spark, name):
    assert found(offsets.offset_blocks(frame(spark, CASES[name]))) == expected(CASES[name])


def test_random_places(spark):
    draw = random.Random(3)
    places = [(draw.randrange(4), int(draw.paretovariate(0.6)) * draw.choice([1, 7])) for _ in range(5000)]
    assert found(offsets.offset_blocks(frame(spark, places))) == expected(places)


def test_state_goes_on_after_a_restart_and_ignores_arrival_order(spark, tmp_path):
    log, root = str(tmp_path / "log"), str(tmp_path / "root")
    assert found(offsets.read_blocks(spark, root)) == (set(), set())
    draw, all_places = random.Random(5), []
    for part in range(3):
        places = [(draw.randrange(2), draw.randrange(70_000)) for _ in range(800)] + all_places[:40]
        all_places += places
        write_message_files(frame(spark, places), f"{log}/part={part}")
        stream = read_message_files(spark, f"{log}/*", max_files=1)
        offsets.run_offsets(stream, root).awaitTermination()
        assert found(offsets.read_blocks(spark, root)) == expected(all_places)
    # A batch that broke off is not read.
    newest = max((tmp_path / "root" / "blocks").glob("batch_id=*"), key=lambda p: int(p.name.split("=")[1]))
    (newest / "_SUCCESS").unlink()
    assert found(offsets.read_blocks(spark, root)) != expected(all_places)


def test_tasks_reduce_before_the_shuffle(spark):
    text = offsets.offset_blocks(frame(spark, [(0, n) for n in range(10)]))
    plan = text._jdf.queryExecution().executedPlan().toString()
    assert "partial_bitmap_construct_agg" in plan and "Python" not in plan
