"""Quality classifier: naive Bayes support vectors.

A document is the set of its n-grams, hashed to ``BUCKETS``: byte trigrams, one and two words, and one to
three word shapes. Each indicator is scaled by the log of the ratio of its smoothed share in class 1 to that
in class 0; on the scaled vectors, at unit length, dual coordinate descent fits a linear model with hinge
loss. A sigmoid, fitted by Newton steps to the margins of a quarter of the rows that a first fit left
out, makes the margins probabilities.

The model is fitted in one task to ``max_rows`` labelled rows at most, the ones of least hash; it is of fixed
size (two tables of ``BUCKETS`` numbers), and scoring takes whole texts and shuffles nothing.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordhaul.llm.shingles import byte_groups, mix, word_places

BUCKETS = 1 << 18
#: Rows that the classifier is fitted to, at most.
MAX_ROWS = 8_000
#: Rows of which an n-gram has to be in one to count.
LEAST_ROWS = 4
SMOOTHING = 1.0
COST = 1.0
PASSES = 40

#: What a byte adds to the shape of its word.
_KINDS = np.full(256, 32, np.uint8)
_KINDS[[0x20, *range(0x09, 0x0E)]] = 0
_KINDS[0x61:0x7B] = 1
_KINDS[0x41:0x5B] = 2
_KINDS[0x30:0x3A] = 4
_KINDS[list(b".,;:'\"()-")] = 8
_KINDS[list(b"!?")] = 16
_KINDS[128:] = 64


def _shapes(data: np.ndarray, first: np.ndarray, last: np.ndarray, hashes: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """Kinds of bytes in each word, its length in steps of four, and whether it repeats a word of its text just before."""
    shape = np.bitwise_or.reduceat(_KINDS[data], first).astype(np.int64)
    shape |= np.minimum((last - first) >> 2, 3) << 7
    for n in (1, 2):
        same = (hashes[n:] == hashes[:-n]) & (owner[n:] == owner[:-n])
        shape[n:] |= same.astype(np.int64) << (8 + n)
    return shape.astype(np.uint64)


def features(texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For parts of a column: the sorted distinct buckets of its texts, and where each text begins among them."""
    for _, data, bounds in byte_groups(texts):
        count = len(bounds) - 1
        found = []

        def add(kind: int, grams: np.ndarray, owner: np.ndarray, own: np.ndarray) -> None:
            # A gram that reaches over the end of a text is none.
            bucket = mix(grams[own] + np.uint64(kind << 56)) & np.uint64(BUCKETS - 1)
            found.append(owner[own] * BUCKETS + bucket.view(np.int64))  # noqa: B023

        if len(data):
            first, last, hashes = word_places(data, bounds)
            wide = data.astype(np.uint64)
            grams = wide[:-2] << np.uint64(16) | wide[1:-1] << np.uint64(8) | wide[2:]
            owner = np.repeat(np.arange(count), np.diff(bounds))
            add(1, grams, owner[: len(grams)], owner[: len(grams)] == owner[2:])
            if len(first):
                owner = np.searchsorted(bounds, first, "right") - 1
                shapes = _shapes(data, first, last, hashes, owner)
                for kind, units, longest in ((2, hashes, 2), (3, shapes, 3)):
                    out = units
                    for n in range(1, longest + 1):
                        if n > 1:
                            if len(units) < n:
                                break
                            out = mix(out[:-1] * np.uint64(0xD6E8FEB86659FD93)) + units[n - 1 :]
                        add(kind * 8 + n, out, owner[: len(out)], owner[: len(out)] == owner[n - 1 :])
        keys = np.unique(np.concatenate(found)) if found else np.zeros(0, np.int64)
        yield keys & (BUCKETS - 1), np.searchsorted(keys, np.arange(count + 1) * BUCKETS)


@dataclass
class Model:
    """The score is a sigmoid of ``slope * margin + level``."""

    weights: np.ndarray
    squares: np.ndarray
    bias: float = 0.0
    slope: float = 1.0
    level: float = 0.0

    def margins(self, buckets: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        sums = [np.concatenate([[0.0], np.cumsum(t[buckets], dtype=np.float64)]) for t in (self.weights, self.squares)]
        top, length = (s[bounds[1:]] - s[bounds[:-1]] for s in sums)
        return top / np.sqrt(np.maximum(length, 1e-12)) * (length > 1e-12) + self.bias

    def scores(self, buckets: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * self.margins(buckets, bounds) + self.level, -30, 30)))


def log_ratios(buckets: np.ndarray, bounds: np.ndarray, labels: np.ndarray) -> np.ndarray:
    """Per bucket: log of its smoothed share of indicators in class 1 over that in class 0; 0 for rare ones."""
    of = np.repeat(labels, np.diff(bounds))
    one, none = (np.bincount(buckets[of == k], minlength=BUCKETS).astype(float) for k in (1, 0))
    p, q = one + SMOOTHING, none + SMOOTHING
    ratios = np.log((p / p.sum()) / (q / q.sum()))
    return np.where(one + none >= LEAST_ROWS, ratios, 0.0)


def descend(rows: list[tuple[np.ndarray, np.ndarray]], signs: np.ndarray, costs: np.ndarray) -> tuple[np.ndarray, float]:
    """Weights and bias of least hinge loss, by dual coordinate descent.

    A row is its buckets and their values, of unit length; the bias is one more feature of value 1. A step
    takes one row and sets its dual variable, from 0 to the row's cost, to the best value with all others
    held; passes over shuffled rows end when no gradient is off by more than a thousandth.
    """
    weights, bias = np.zeros(BUCKETS), 0.0
    dual = np.zeros(len(rows))
    curve = np.array([values @ values + 1 for _, values in rows])
    random = np.random.default_rng(11)
    for _ in range(PASSES):
        worst = 0.0
        for n in random.permutation(len(rows)):
            at, values = rows[n]
            slope = signs[n] * (weights[at] @ values + bias) - 1
            wrong = min(slope, 0.0) if dual[n] <= 0 else max(slope, 0.0) if dual[n] >= costs[n] else slope
            worst = max(worst, abs(wrong))
            if wrong:
                new = min(max(dual[n] - slope / curve[n], 0.0), costs[n])
                step = (new - dual[n]) * signs[n]
                dual[n] = new
                weights[at] += step * values
                bias += step
        if worst < 1e-3:
            break
    return weights, bias


def sigmoid(margins: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and level of most likelihood, by Newton steps; targets are kept off 0 and 1."""
    ones = labels.sum()
    goal = np.where(labels == 1, (ones + 1) / (ones + 2), 1 / (len(labels) - ones + 2))
    x = np.stack([margins, np.ones(len(margins))])
    at = np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(at @ x, -30, 30)))
        slope = x @ (p - goal) + 1e-3 * at
        step = np.linalg.solve((x * np.maximum(p * (1 - p), 1e-6)) @ x.T + 1e-3 * np.eye(2), slope)
        at = at - step * min(1.0, 2 / max(np.abs(step).max(), 1e-9))
        if np.abs(step).max() < 1e-6:
            break
    return float(at[0]), float(at[1])


def fit(buckets: list[np.ndarray], labels: np.ndarray, held: np.ndarray) -> Model:
    """The model of rows given by their distinct buckets; ``held`` rows fit the sigmoid first."""

    def linear(chosen: np.ndarray) -> Model:
        own = [buckets[n] for n in np.flatnonzero(chosen)]
        bounds = np.concatenate([[0], np.cumsum([len(x) for x in own])])
        ratios = log_ratios(np.concatenate(own), bounds, labels[chosen])
        rows = []
        for at in own:
            at = at[ratios[at] != 0]
            values = ratios[at]
            rows.append((at, values / max(np.sqrt(values @ values), 1e-9)))
        signs = labels[chosen] * 2.0 - 1
        # Both classes have the same whole cost.
        share = np.array([(signs < 0).sum(), (signs > 0).sum()])
        costs = COST * (len(signs) / 2 / share)[(signs > 0).astype(int)]
        weights, bias = descend(rows, signs, costs)
        return Model(weights * ratios, ratios**2, bias)

    def both(chosen: np.ndarray) -> bool:
        return len(np.unique(labels[chosen])) == 2

    nothing = np.zeros(BUCKETS)
    if not both(np.ones(len(labels), bool)):
        share = (labels.sum() + 1) / (len(labels) + 2)
        return Model(nothing, nothing, level=float(np.log(share / (1 - share))))
    slope, level = 4.0, 0.0
    if both(held) and both(~held):
        first = linear(~held)
        own = [buckets[n] for n in np.flatnonzero(held)]
        bounds = np.concatenate([[0], np.cumsum([len(x) for x in own])])
        slope, level = sigmoid(first.margins(np.concatenate(own), bounds), labels[held])
    model = linear(np.ones(len(labels), bool))
    model.slope, model.level = slope, level
    return model


def train(documents: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> Model:
    """The model of the labelled rows; no labelled row gives even odds."""
    known = labels.select(F.col("doc_id").cast("long").alias("_id"), F.col("quality").cast("int").alias("_label"))
    known = known.where(F.col("_id").isNotNull() & F.col("_label").isin(0, 1))
    known = known.orderBy(F.xxhash64("_id"), "_label").limit(max_rows)
    found = documents.join(F.broadcast(known), F.col("doc_id") == F.col("_id"))  # at most max_rows narrow rows
    order = F.xxhash64("_id", "text", "_label")
    # Documents may repeat an id.
    rows = found.select("text", "_label", order.alias("_order")).orderBy("_order").limit(max_rows)

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [
                part[a:b].astype("<i4").tobytes()
                for part, bounds in features(batch.column("text"))
                for a, b in zip(bounds, bounds[1:], strict=False)
            ]
            made = [pa.array(out, pa.binary()), batch.column("_label"), batch.column("_order")]
            yield pa.RecordBatch.from_arrays(made, names=["buckets", "label", "order"])

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [r for batch in batches for r in zip(*(c.to_pylist() for c in batch.columns), strict=True)]
        rows.sort(key=lambda r: (r[2], r[1], r[0]))
        buckets = [np.frombuffer(r[0], "<i4").astype(np.int64) for r in rows]
        held = np.array([r[2] % 4 == 0 for r in rows], bool)
        model = fit(buckets, np.array([r[1] for r in rows], int), held)
        made = [[model.weights.astype("<f4").tobytes()], [model.squares.astype("<f4").tobytes()]]
        made += [[model.bias], [model.slope], [model.level]]
        names = ["weights", "squares", "bias", "slope", "level"]
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in made], names=names)

    sample = rows.mapInArrow(hashed, "buckets binary, label int, order long").repartition(1)
    schema = "weights binary, squares binary, bias double, slope double, level double"
    row = sample.mapInArrow(learn, schema).first()
    if row is None:
        return Model(np.zeros(BUCKETS), np.zeros(BUCKETS))
    tables = (np.frombuffer(row[n], "<f4") for n in ("weights", "squares"))
    return Model(*tables, row["bias"], row["slope"], row["level"])


def score(documents: DataFrame, model: Model) -> DataFrame:
    """``documents`` with ``score``, the probability of class 1, in place of their whole texts."""
    source = documents.drop("score")
    kept = source.drop("text")
    names = kept.columns

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [model.scores(*part) for part in features(batch.column("text"))]
            made = pa.array(np.concatenate(found) if found else np.zeros(0))
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), made], names=[*names, "score"])

    return source.mapInArrow(make, kept.schema.add("score", "double"))


def held_out(key: str = "doc_id"):
    """Rows never learned from: a fifth, by ``crc32`` of the key's text, and rows without a key."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 5 == 0, F.lit(True))


def classify(documents: DataFrame, labels: DataFrame, threshold: float = 0.3, max_rows: int = MAX_ROWS) -> DataFrame:
    """``doc_id``, ``held_out``, ``score`` and ``predicted`` (1 from ``threshold`` on) of every row.

    Null and empty texts have no n-gram; their score follows from the bias. Equal texts have equal scores, and
    repeated rows are kept. Labels are learned from rows that are not held out only; several labels of a document all
    count, null ones do not. Without labels every score is 0.5, with one class its smoothed share. Of an empty table
    nothing comes. Other columns are not looked at, and very long texts are taken whole.
    """
    source = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    model = train(source, labels.where(~held_out()), max_rows)
    narrow = source.withColumn("held_out", held_out())
    return score(narrow, model).select(
        "doc_id", "held_out", "score", (F.col("score") >= threshold).cast("int").alias("predicted")
    )
