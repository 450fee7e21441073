"""Quality rules: counts of each text, and an isolation forest on the rates they give.

The counts of a text need nothing but the text, so they come from the scan and only they are
staged. The forest is grown on a bounded sample of the labelled rows (``TREES * SAMPLE`` at most,
those of the smallest hashes), by how far each feature lies outside the range that rows labelled
good have; its random splits isolate unusual rows after few steps, so a short mean path is a high
score. All labelled rows that pass the base rules then calibrate the
threshold: of the scores that reject at most ``false_share`` of those labelled good, the one that
parts good from bad best. Every row is scored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from math import log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordhaul.session import stage

TREES, SAMPLE = 100, 256
#: Steps of the score in which labelled rows are counted.
STEPS = 4096
#: Share of the good rows that lie below, and above, the usual range of a feature.
TAIL = 0.0005

WHITE = b" \t\n\x0b\x0c\r"
SYMBOLS = b"#*$%&|<>"
ENDERS = b".!?"
_UPPER = bytes(range(0x41, 0x5B))
_DIGITS = b"0123456789"

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
FEATURES = (
    "word_length", "symbol_rate", "dup_line_rate", "repeat_rate", "upper_rate", "digit_rate",
    "ender_rate", "distinct_rate", "words_per_line",
)


def repeated_words(words: list[bytes]) -> int:
    """Words that lie in a window of three which occurs twice or more."""
    windows = list(zip(words, words[1:], words[2:], strict=False))
    if len(set(windows)) == len(windows):
        return 0
    often = {w for w, n in Counter(windows).items() if n > 1}
    inside = np.zeros(len(words), bool)
    for n in [n for n, w in enumerate(windows) if w in often]:
        inside[n : n + 3] = True
    return int(inside.sum())


def describe(text: str | None) -> tuple[list[int], list[float]]:
    """The counts and the features of a text."""
    text = text or ""
    data = text.encode()
    words = data.split()  # at ASCII white space
    n = len(words)
    chars = len(text) - (len(data) - len(data.translate(None, WHITE)))
    symbols = len(data) - len(data.translate(None, SYMBOLS))
    lines = [line for line in data.split(b"\n") if line.strip(WHITE)]
    dup_lines = len(lines) - len(set(lines))
    repeats = repeated_words(words)
    count = lambda some: len(data) - len(data.translate(None, some))
    features = [
        chars / max(n, 1),
        symbols / max(chars, 1),
        dup_lines / max(len(lines), 1),
        repeats / max(n, 1),
        count(_UPPER) / max(chars, 1),
        count(_DIGITS) / max(chars, 1),
        count(ENDERS) / max(n, 1),
        log(1 + len(set(words))) / log(1 + max(n, 1)),
        log(max(n, 1) / max(len(lines), 1)),
    ]
    return [n, chars, symbols, dup_lines, repeats], features


def rule_statistics(documents: DataFrame) -> DataFrame:
    """``doc_id``, a hash of the text as ``row``, the counts and the features of each row."""
    names = ["doc_id", "row", *COUNTS, "features"]
    schema = "doc_id long, row long, " + ", ".join(f"{c} long" for c in COUNTS) + ", features array<double>"

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [describe(text.as_py()) for text in batch.column("text")]
            counts = np.array([m[0] for m in made], np.int64).reshape(-1, len(COUNTS))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("row"),
                    *(pa.array(counts[:, n]) for n in range(len(COUNTS))),
                    pa.array([m[1] for m in made], pa.list_(pa.float64())),
                ],
                names=names,
            )

    source = documents.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("row"), "text")
    return source.mapInArrow(make, schema)


def _mean_path(n: float) -> float:
    """Steps that an unsuccessful search takes on average in a tree of ``n`` rows."""
    return 2 * (log(n - 1) + 0.5772156649) - 2 * (n - 1) / n if n > 2 else float(n == 2)


def _excess(rows: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """How far features lie outside their usual range, in logarithms of its width."""
    outside = np.maximum(np.maximum(low - rows, rows - high), 0)
    return np.log1p(outside / (high - low + 1e-3))


@dataclass
class Forest:
    """Trees as arrays: ``feature`` -1 marks a leaf, whose ``value`` is its path length."""

    feature: np.ndarray
    value: np.ndarray
    child: np.ndarray
    roots: np.ndarray
    norm: float
    low: np.ndarray
    high: np.ndarray

    @classmethod
    def grow(cls, rows: np.ndarray, low: np.ndarray, high: np.ndarray, seed: int = 0) -> Forest:
        rows = _excess(rows, low, high)
        random = np.random.default_rng(seed)
        size = min(SAMPLE, len(rows))
        limit = int(np.ceil(np.log2(max(size, 2))))
        order = random.permutation(len(rows))
        feature, value, child, roots = [], [], [], []

        def add(part: np.ndarray, depth: int) -> int:
            at = len(feature)
            feature.append(-1)
            value.append(depth + _mean_path(len(part)))
            child.append(at)
            spread = np.flatnonzero(np.ptp(part, axis=0) > 0) if len(part) > 1 else []
            if depth < limit and len(spread):
                f = int(random.choice(spread))
                cut = random.uniform(part[:, f].min(), part[:, f].max())
                below = part[:, f] <= cut
                feature[at], value[at] = f, cut
                left = add(part[below], depth + 1)
                child[at] = add(part[~below], depth + 1)
                assert left == at + 1
            return at

        for n in range(TREES):
            take = order[np.arange(n * size, (n + 1) * size) % len(rows)]
            roots.append(add(rows[take], 0))
        arrays = (np.array(x) for x in (feature, value, child, roots))
        return cls(*arrays, norm=_mean_path(size) or 1.0, low=low, high=high)

    def score(self, rows: np.ndarray) -> np.ndarray:
        """Between 0 and 1; rows that few splits isolate come near 1."""
        rows = _excess(rows, self.low, self.high)
        total = np.zeros(len(rows))
        every = np.arange(len(rows))
        for root in self.roots:
            at = np.full(len(rows), root)
            while True:
                feature = self.feature[at]
                inner = feature >= 0
                if not inner.any():
                    break
                below = rows[every, feature] <= self.value[at]
                at = np.where(inner, np.where(below, at + 1, self.child[at]), at)
            total += self.value[at]
        return 2.0 ** (-total / len(self.roots) / self.norm)


def _scored(rows: DataFrame, forest: Forest) -> DataFrame:
    """``rows`` with ``anomaly`` in the place of ``features``."""
    kept = [c for c in rows.columns if c != "features"]

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            features = batch.column("features").flatten().to_numpy().reshape(-1, len(FEATURES))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in kept), pa.array(forest.score(features))],
                names=[*kept, "anomaly"],
            )

    return rows.mapInArrow(make, rows.select(*kept).schema.add("anomaly", "double"))


def _usual(labelled: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The range of each feature over the rows labelled good, or over all if none is."""
    best = labelled.agg(F.max("quality")).first()[0]
    quantiles = labelled.where(F.col("quality") == best).agg(
        *(
            F.percentile_approx(F.get("features", n), [TAIL, 1 - TAIL], 10_000)
            for n in range(len(FEATURES))
        )
    )
    low, high = np.array([list(q) for q in quantiles.first()]).T
    return low, high


def _threshold(scored: DataFrame, false_share: float) -> float:
    """Where the labels part best: the middle of the steps that do so equally well."""
    step = F.floor(F.col("anomaly") * STEPS).cast("int").alias("step")
    counts = np.zeros((2, STEPS + 1))
    for row in scored.groupBy("quality", step).agg(F.count("*").alias("n")).collect():
        counts[row["quality"], row["step"]] = row["n"]  # at most two rows a step
    bad, good = np.cumsum(counts[:, ::-1], axis=1)[:, ::-1] / np.maximum(counts.sum(1), 1)[:, None]
    gain = np.where(good <= false_share, bad - good, -1.0)
    if not counts.sum() or gain.max() <= 0:
        return 1.0
    best = np.flatnonzero(gain == gain.max())
    return float(best.min() + best.max() + 1) / 2 / STEPS


def quality_verdicts(
    documents: DataFrame, labels: DataFrame, false_share: float = 0.002, seed: int = 0
) -> DataFrame:
    """``doc_id``, ``row``, the counts, ``base_failed``, ``anomaly`` and ``kept`` for every row.

    ``base_failed``: fewer than 50 words, or more than half of them in repeated windows of three.
    ``kept`` is false for those and for rows whose ``anomaly`` is at the threshold or above.
    ``labels`` has ``doc_id`` and ``quality`` (1 good, 0 bad; others are passed over). Without a
    labelled row ``anomaly`` is 0, and where no score parts good from bad the base rules alone
    decide. Null and empty texts have no word and fail. ``row`` tells apart rows that share a ``doc_id``; repeated
    rows get equal verdicts. Labels of a ``doc_id`` that comes twice count for each of its rows.
    """
    failed = (F.col("n_words") < 50) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 50)
    statistics = stage(
        rule_statistics(documents).withColumn("base_failed", failed), "rule-statistics"
    )
    known = labels.where("quality IN (0, 1)").select(F.col("doc_id").cast("long"), "quality")
    passed = statistics.where("NOT base_failed").select("doc_id", "features")
    labelled = stage(passed.join(known, "doc_id"), "labelled")
    sample = (
        labelled.select("features", F.xxhash64("doc_id", F.lit(seed)).alias("at"))
        .orderBy("at", "features")
        .limit(TREES * SAMPLE)
        .select("features")
        .collect()
    )
    if sample:
        rows = np.array([row["features"] for row in sample])
        forest = Forest.grow(rows, *_usual(labelled), seed)
        threshold = _threshold(_scored(labelled.select("features", "quality"), forest), false_share)
        scored = _scored(statistics, forest)
    else:
        threshold = 1.0
        scored = statistics.drop("features").withColumn("anomaly", F.lit(0.0))
    return scored.withColumn("kept", ~F.col("base_failed") & (F.col("anomaly") < threshold))
