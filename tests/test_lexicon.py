"""Words of scripts without spaces, against plain loops."""

from __future__ import annotations

import math
import random
from collections import Counter

import pytest

from recordhaul.operators import lexicon as lx

WORDS = ["記録", "検索", "同期", "重複", "文書", "データ", "一覧", "更新", "機械学習", "東京都"]
LINKS = ["の", "は", "を", "に", "と", "で", "𠮷", "が", "も", "へ", "や", "か"]


def texts(count, seed=1):
    draw = random.Random(seed)
    made = []
    for _ in range(count):
        parts = []
        for _ in range(draw.randrange(2, 6)):
            parts += [draw.choice(WORDS), draw.choice(LINKS)]
        made.append("".join(parts))
    return made


def table(spark, rows):
    return spark.createDataFrame(list(enumerate(rows)), "id bigint, text string")


def brute_lexicon(runs, longest, min_count, min_cohesion, min_entropy):
    counts, before, after = Counter(), {}, {}
    for run, n in runs.items():
        for at in range(len(run)):
            for size in range(1, longest + 1):
                if at + size <= len(run):
                    piece = run[at : at + size]
                    counts[piece] += n
                    if at:
                        before.setdefault(piece, Counter())[run[at - 1]] += n
                    if at + size < len(run):
                        after.setdefault(piece, Counter())[run[at + size]] += n
    total = sum(n for piece, n in counts.items() if len(piece) == 1)

    def entropy(piece, side):
        near = side.get(piece, Counter())
        alone = counts[piece] - sum(near.values())  # at an end of a run: each a neighbour of its own
        shares = [*near.values(), *[1] * alone]
        return -sum(c / counts[piece] * math.log(c / counts[piece]) for c in shares)

    found = {}
    for piece, n in counts.items():
        if len(piece) < 2 or n < min_count:
            continue
        odds = min(n * total / (counts[piece[:c]] * counts[piece[c:]]) for c in range(1, len(piece)))
        sides = min(entropy(piece, before), entropy(piece, after))
        if round(math.log(odds), 6) >= min_cohesion and round(sides, 6) >= min_entropy:
            found[piece] = (n, math.log(odds), sides)
    return found, total, counts


def brute_path(run, weights, longest):
    best = {len(run): (0.0, 0)}
    for at in range(len(run) - 1, -1, -1):
        best[at] = max(
            (weights[run[at : at + k]] + best[at + k][0], k)
            for k in range(1, longest + 1)
            if at + k <= len(run) and run[at : at + k] in weights
        )
    at, words = 0, []
    while at < len(run):
        k = best[at][1]
        words.append((at + 1, run[at : at + k]))
        at += k
    return words


@pytest.fixture(scope="module")
def learned(spark):
    rows = texts(300)
    runs = lx.text_runs(table(spark, rows), "text").persist()
    found = lx.learn_lexicon(runs).persist()
    return rows, runs, found


def test_lexicon(learned):
    rows, runs, found = learned
    counted = {row["run"]: row["n"] for row in runs.collect()}
    assert counted == Counter(rows)
    expected, _, _ = brute_lexicon(counted, lx.LONGEST, lx.MIN_COUNT, lx.MIN_COHESION, lx.MIN_ENTROPY)
    expected_counts = brute_lexicon(counted, 1, 1, 0, 0)[2]
    assert {row["piece"]: row["n"] for row in found.filter("size = 1").collect()} == expected_counts
    got = {row["piece"]: row for row in found.filter("size > 1").collect()}
    assert set(got) == set(expected) and set(WORDS) <= set(got)
    for piece, (n, cohesion, entropy) in expected.items():
        row = got[piece]
        assert (row["n"], row["size"]) == (n, len(piece))
        assert row["cohesion"] == pytest.approx(cohesion, abs=2e-6)
        assert row["entropy"] == pytest.approx(entropy, abs=2e-6)


def test_path(spark, learned):
    rows, runs, found = learned
    counted = {row["run"]: row["n"] for row in runs.collect()}
    _, total, _ = brute_lexicon(counted, 1, 10**9, 0, 0)
    weights = {row["piece"]: math.log(row["n"] / (total + 1)) for row in found.collect()}
    got = {}
    named = spark.createDataFrame(list(enumerate(sorted(counted))), "rid bigint, run string")
    for row in lx.segment_runs(named, found).collect():
        got.setdefault(sorted(counted)[row["rid"]], []).append((row["at"], row["word"]))
    assert set(got) == set(counted)
    told = right = 0
    for run, words in got.items():
        words.sort()
        assert "".join(word for _, word in words) == run
        assert words == brute_path(run, weights, lx.LONGEST)
        told += len(words)
        right += sum(word in WORDS or word in LINKS for _, word in words)
    assert right / told > 0.95


def test_long_covered_run_and_awkward_rows(spark):
    long = "哈" * 6000
    rows = [None, "", "abc 12", "東", long, "東京 東京", "東京。東京"]
    frame = table(spark, rows).unionByName(table(spark, rows))
    words = spark.createDataFrame([("哈哈", 2, 50), ("東京", 2, 60)], "piece string, size int, n bigint")
    got = {(row["_id"], row["token"]): row["tf"] for row in lx.word_tokens(frame, "id", "text", words).collect()}
    assert got == {("3", "東"): 2, ("4", "哈哈"): 6000, ("5", "東京"): 4, ("6", "東京"): 4}
    none = frame.filter("false")
    assert lx.word_tokens(none, "id", "text", words).isEmpty()
    assert lx.learn_lexicon(lx.text_runs(none, "text")).isEmpty()
