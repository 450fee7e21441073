"""Mixing to target weights with soft membership. DataFrame functions only.

A classifier trained on the labelled table gives each document a probability for each domain. Projected
gradient steps then fit a rate of 0 or more to each document so that the expected tokens of
every domain, summed over ``rate * tokens * probability``, match the targets in least squares.

The classifier is a naive Bayes one on the hashed words that a text holds and on three levels of simple
rates; it is trained on at most ``max_labels`` labelled rows, which bounds the broadcast that finds
their texts. Words are counted in ``BUCKETS``; all that tell are kept. How strongly
they count is chosen by log loss on a quarter of the rows.

A gradient step needs one sum per domain over all documents, so a step is one aggregation of a narrow
table; the rates are never stored, as they follow from a document's probabilities and the steps taken.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from math import log

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordhaul.session import stage

BUCKETS = 1 << 18
#: Rows of the table of telling words: a word lies in the row of its lowest bits.
ROWS = 1 << 10
LEVELS = 8
SYMBOLS = "#*$%&|<>"
#: Tried for the weight of the words: a factor, and the power of their number that divides it.
FACTORS = (0.1, 0.25, 0.5, 1.0, 2.0, 4.0)
POWERS = (0.0, 0.25, 0.5)
#: Tried for the log odds that every text has against the first domain besides: a text without a telling
#: word is less likely of another domain than the shares of the domains say.
SHIFTS = (0.0, -0.5, -1.0, -1.5, -2.0, -3.0)
#: Standard errors by which a word's log odds differ from 0 to be used.
CERTAIN = 3.0
#: Log odds of a word below which it is passed over.
LEAST_ODDS = 1.0
#: Most gradient steps tried, the share of all tokens by which a domain may end off its target, and how
#: far a step must bring the squares down for another one.
TRIES, NEAR, STALLED = 25, 1e-5, 0.97

DOMAINS = ("good", "poor", "toxic")


def label_domain() -> Column:
    """The domain of a row of ``labels``."""
    return (
        F.when(F.col("toxic") == 1, "toxic")
        .when(F.col("quality") == 1, "good")
        .when(F.col("quality") == 0, "poor")
    )


def _features(documents: DataFrame) -> DataFrame:
    """``documents`` with ``n_tokens``, hashed words as ``_words``, and the levels as ``_rates``."""
    text = F.coalesce("text", F.lit(""))
    words = F.filter(F.split(F.lower(text), r"\s+"), lambda w: w != "")
    bare = F.char_length(F.translate(text, SYMBOLS, ""))
    out = documents.withColumns({
        "_parts": words,
        "_chars": F.greatest(F.char_length(text), F.lit(1)),
        "_symbols": F.char_length(text) - bare,
    }).withColumn("n_tokens", F.size("_parts").cast("long"))
    some = F.greatest("n_tokens", F.lit(1))
    rates = (
        F.col("_symbols") / F.col("_chars") * 40,
        (1 - F.size(F.array_distinct("_parts")) / some) * LEVELS,
        F.col("_chars") / some - 2,
    )
    level = lambda x: F.least(F.greatest(F.floor(x), F.lit(0)), F.lit(LEVELS - 1)).cast("int")
    places = [level(x) + n * LEVELS for n, x in enumerate(rates)]
    hashed = F.transform("_parts", lambda w: F.pmod(F.xxhash64(w), F.lit(BUCKETS)).cast("int"))
    out = out.withColumns({"_words": F.array_distinct(hashed), "_rates": F.array(*places)})
    return out.drop("_parts", "_chars", "_symbols")


def _numbers(values: list[float]) -> Column:
    """The values as one constant."""
    return F.split(F.lit(",".join(map(repr, values))), ",").cast("array<double>")


def _integers(values: list[int]) -> Column:
    return F.split(F.lit(",".join(map(str, values))), ",").cast("array<int>")


def displaced(words: list[int]) -> tuple[list[int], list[int]]:
    """A sparse table of the words by ``(word % ROWS, word // ROWS)``, its rows laid over each other.

    The word lies at ``shift[word % ROWS] + word // ROWS``, where the second list has the word itself, so
    that no two words meet; free places hold -1. The fullest rows are laid first, each as far
    to the front as it goes.
    """
    rows: dict[int, list[int]] = {}
    for word in sorted(words):
        rows.setdefault(word % ROWS, []).append(word)
    shift, tags = [0] * ROWS, [-1] * (BUCKETS // ROWS)
    for row, own in sorted(rows.items(), key=lambda x: (-len(x[1]), x[0])):
        places = [word // ROWS for word in own]
        while any(tags[shift[row] + place] >= 0 for place in places):
            shift[row] += 1
            if shift[row] + BUCKETS // ROWS > len(tags):
                tags.append(-1)
        for word, place in zip(own, places, strict=True):
            tags[shift[row] + place] = word
    return shift, tags


@dataclass
class Classifier:
    """Log odds of hashed words and of levels against the first domain, and those of the domains.

    The words that tell are of ``BUCKETS`` at most, and their number follows from the labelled rows; so the
    tables are constants of a plan.
    """

    domains: tuple[str, ...]
    prior: list[float]
    words: dict[int, list[float]]
    levels: list[list[float]]
    factor: float = 1.0
    power: float = 0.0
    shift: float = 0.0

    def evidence(self, featured: DataFrame) -> DataFrame:
        """``featured`` with ``_lexical`` and ``_levels``: a sum for each domain but the first."""
        names = [f"d{n}" for n in range(len(self.domains) - 1)]
        shift, tags = displaced(list(self.words))
        tables = [[self.words[w][n] if w >= 0 else 0.0 for w in tags] for n in range(len(names))]
        zero = F.struct(*(F.lit(0.0).alias(n) for n in names))

        def sums(tables: list[list[float]], place: Callable[[Column], Column]):
            columns = [_numbers(table) for table in tables]
            return lambda total, at: F.struct(
                *((total[n] + F.get(c, place(at))).alias(n) for n, c in zip(names, columns, strict=True))
            )

        shifts, tag = _integers(shift), _integers(tags)
        place = lambda at: F.get(shifts, at % ROWS) + F.shiftright(at, ROWS.bit_length() - 1)
        telling = F.filter("_words", lambda at: F.get(tag, place(at)) == at)
        return featured.withColumns({
            "_lexical": F.aggregate(telling, zero, sums(tables, place)),
            "_levels": F.aggregate("_rates", zero, sums(self.levels, lambda at: at)),
        }).drop("_words", "_rates")

    def odds(self, factor: Column, power: Column, shift: Column) -> list[Column]:
        """Unnormalised log probabilities of the domains."""
        scale = factor / F.pow(F.greatest("n_tokens", F.lit(1)), power)
        rest = [
            F.lit(self.prior[n + 1]) + shift + F.col("_levels")[f"d{n}"] + scale * F.col("_lexical")[f"d{n}"]
            for n in range(len(self.domains) - 1)
        ]
        return [F.lit(self.prior[0]), *rest]

    def probabilities(self, evidence: DataFrame) -> DataFrame:
        """``evidence`` with ``p_<domain>`` for every domain; they sum to 1."""
        chosen = (F.lit(self.factor), F.lit(self.power), F.lit(self.shift))
        odds = {f"_o{n}": o for n, o in enumerate(self.odds(*chosen))}
        out = evidence.withColumns(odds).withColumn("_top", F.greatest(*odds))
        raised = {name: F.exp(F.col(name) - F.col("_top")) for name in odds}
        out = out.withColumns(raised).withColumn("_sum", sum((F.col(o) for o in odds), F.lit(0.0)))
        found = {f"p_{d}": F.col(o) / F.col("_sum") for d, o in zip(self.domains, odds, strict=True)}
        return out.withColumns(found).drop(*odds, "_top", "_sum", "_lexical", "_levels")


def train(documents: DataFrame, labels: DataFrame, domains: tuple[str, ...], max_labels: int) -> Classifier:
    known = labels.select(F.col("doc_id").alias("_id"), label_domain().alias("_domain"))
    known = known.where(F.col("_domain").isin(*domains) & F.col("_id").isNotNull())
    chosen = known.orderBy(F.xxhash64("_id"), "_domain").limit(max_labels)
    found = documents.select("doc_id", "text").join(
        F.broadcast(chosen), F.col("doc_id") == F.col("_id")
    )  # at most max_labels narrow rows are broadcast
    rows = _features(found).select(
        "_domain", "n_tokens", "_words", "_rates", (F.pmod(F.xxhash64("_id", F.lit(1)), F.lit(4)) == 0).alias("_held")
    )
    rows = stage(rows, "labelled-words")
    learned = rows.where("NOT _held")
    each = [F.count_if(F.col("_domain") == d).alias(d) for d in domains]
    sizes = learned.agg(*each).first()
    prior = [log((sizes[d] + 1) / (sum(sizes) + len(domains))) for d in domains]

    words = learned.select("_domain", F.explode("_words").alias("place")).groupBy("place").agg(*each)
    words = stage(words, "word-counts")
    # Shares of texts that hold a word. Of all words they would be off by the size of a domain: with as many
    # buckets as smoothing, each common word would tell against the smaller one.
    totals = [sizes[d] + 1.0 for d in domains]
    telling, odds = F.lit(False), []
    for d, total in zip(domains[1:], totals[1:], strict=True):
        odd = F.log((F.col(d) + 0.5) / total) - F.log((F.col(domains[0]) + 0.5) / totals[0])
        chance = F.sqrt(1 / (F.col(d) + 0.5) + 1 / (F.col(domains[0]) + 0.5)) * CERTAIN
        # Small odds, or what may be chance in so many counts, would add up over a long text.
        tells = F.abs(odd) > F.greatest(F.lit(LEAST_ODDS), chance)
        odds.append(F.when(tells, odd).otherwise(0.0).alias(f"odds_{d}"))
        telling = telling | tells
    told = words.where(telling).select("place", *odds).collect()  # of BUCKETS rows at most
    counts = {d: [0.5] * (3 * LEVELS) for d in domains}
    level = learned.select("_domain", F.explode("_rates").alias("place")).groupBy("place").agg(*each)
    for row in level.collect():  # a row a level at most
        for d in domains:
            counts[d][row["place"]] += row[d]
    shares = {
        d: [c / sum(own[n - n % LEVELS : n - n % LEVELS + LEVELS]) for n, c in enumerate(own)]
        for d, own in counts.items()
    }
    levels = [[log(x / y) for x, y in zip(shares[d], shares[domains[0]], strict=True)] for d in domains[1:]]
    model = Classifier(domains, prior, {row["place"]: list(row[1:]) for row in told}, levels)
    tried = [(f, p, s) for s in SHIFTS for f in FACTORS for p in POWERS]
    # Each held row once for every choice that is tried.
    grid = F.lit(";".join(f"{n},{f},{p},{s}" for n, (f, p, s) in enumerate(tried)))
    held = stage(model.evidence(rows.where("_held")), "held-evidence")
    held = held.withColumn("_choice", F.explode(F.split(grid, ";")))
    held = held.withColumn("_choice", F.split("_choice", ",").cast("array<double>"))
    odds = model.odds(*(F.get("_choice", n) for n in (1, 2, 3)))
    top = F.greatest(*odds)
    total = top + F.log(sum((F.exp(o - top) for o in odds), F.lit(0.0)))
    right = F.coalesce(*(F.when(F.col("_domain") == d, o) for d, o in zip(domains, odds, strict=True)))
    losses = held.groupBy(F.get("_choice", 0).cast("int")).agg(F.avg(total - right)).collect()  # a row a choice
    loss = dict(map(tuple, losses))
    best = min(range(len(tried)), key=lambda n: loss[n] if n in loss else n)
    model.factor, model.power, model.shift = tried[best]
    return model


#: The least and the most rate: numbers, or columns of a document's probabilities.
Bounds = tuple[float | Column, float | Column | None]


def _as_columns(bounds: Bounds) -> tuple[Column, Column | None]:
    least, most = (F.lit(float(b)) if isinstance(b, (int, float)) else b for b in bounds)
    return least, most


def _rate(names: list[str], steps: list[list[float]], bounds: Bounds) -> Column:
    """The rate of a document after the steps, from its probabilities."""
    least, most = _as_columns(bounds)
    rate = F.lit(1.0)
    for step in steps:
        moved = sum((F.col(n) * F.lit(s) for n, s in zip(names, step, strict=True)), F.lit(0.0))
        rate = F.greatest(least, rate - moved)
        if most is not None:
            rate = F.least(most, rate)
    return rate


def fit_steps(
    scored: DataFrame, names: list[str], targets: list[float], bounds: Bounds = (0.0, None)
) -> list[list[float]]:
    """Projected gradient steps toward the targets, as a number for each domain and step.

    They bring down the squares ``sum(w * e ** 2)`` of the distances ``e = totals - targets``, with ``w`` 1
    over the target. The gradient by a rate is ``tokens`` times a sum of ``p * e`` over domains; a step goes
    by it per token, in the measure of the curvature of the rates between their bounds. A step that
    leads away is taken back and tried again with the measure damped, which makes it shorter and
    more like the plain gradient. The steps end at the targets, or where they hardly lead on, as
    targets may be out of reach.
    """
    size = range(len(names))
    pairs = [(j, k) for j in size for k in size if j <= k]

    def look() -> tuple[np.ndarray, np.ndarray]:
        rate = _rate(names, steps, bounds)
        part = rate * F.col("n_tokens")
        least, most = _as_columns(bounds)
        free = rate > least if most is None else (rate > least) & (rate < most)
        free = free if steps else F.lit(True)
        moving = F.when(free, F.col("n_tokens")).otherwise(0)
        sums = [F.sum(part * F.col(n)) for n in names]
        sums += [F.sum(moving * F.col(names[j]) * F.col(names[k])) for j, k in pairs]
        found = [x or 0.0 for x in scored.agg(*sums).first()]
        products = dict(zip(pairs, found[len(names) :], strict=True))
        curve = np.array([[products[min(j, k), max(j, k)] for k in size] for j in size])
        return np.subtract(found[: len(names)], targets), curve

    steps: list[list[float]] = []
    weight = np.array([1 / t if t > 0 else 1 / max(sum(targets), 1.0) for t in targets])
    away, curve = look()
    best, damping = float(weight @ away**2), 0.0
    for _ in range(TRIES):
        if np.abs(away).max() <= NEAR * sum(targets) or not curve.any() or damping > 1e4:
            break
        measure = curve + damping * np.diag(np.diag(curve))
        steps.append([float(x) for x in np.linalg.pinv(measure) @ away])
        next_away, next_curve = look()
        squares = float(weight @ next_away**2)
        if squares >= best:
            steps.pop()
            damping = max(0.05, damping * 8)
            continue
        hardly = squares > best * STALLED
        away, curve, best, damping = next_away, next_curve, squares, damping / 4
        if hardly:
            break
    return steps


def mix(
    documents: DataFrame,
    labels: DataFrame,
    weights: dict[str, float],
    anchor: tuple[str, float] | None = None,
    bounds: Bounds = (0.0, None),
    max_labels: int = 16_000,
    at_most: tuple[str, ...] = (),
    carry: tuple[str, ...] | None = None,
) -> DataFrame:
    """``documents`` with ``n_tokens``, ``p_<domain>``, ``rate`` and ``copies``.

    ``weights`` are the shares of expected tokens that the domains should have, in any unit. The sum
    of the targets is the number of all tokens; with ``anchor = (domain, factor)`` it is instead
    such that this domain's target is ``factor`` times its present expected tokens. Tokens are
    words between white space. ``bounds`` are the least rate, from 0 to 1, and the most, 1 or more, if
    any; either may be a column of ``p_<domain>``. Targets that they or the documents put out of reach
    are met as nearly as can be. Domains of ``at_most`` that lie below their target are left there.
    ``copies`` is the rate rounded up or down by a hash of ``doc_id``, so
    that its mean is the rate.

    With ``carry``, the result has those columns of ``documents`` only, besides ``doc_id``: what it has is
    written once on the way.

    ``labels`` has ``doc_id``, ``quality`` and ``toxic``; without any, all domains are equally
    likely. Null and empty texts have no token; their rate follows from the domains' shares.
    Repeated rows get equal values. Columns of the names added are replaced; other names
    that begin with ``_`` may be used on the way, and columns of such names go.
    """
    domains = tuple(weights)
    names = [f"p_{d}" for d in domains]
    documents = documents.drop("n_tokens", *names, "rate", "copies")
    documents = documents.select(*(c for c in documents.columns if not c.startswith("_")))
    model = train(documents, labels, domains, max_labels)
    scored = model.probabilities(model.evidence(_features(documents)))
    carried = documents.columns if carry is None else [c for c in documents.columns if c in carry or c == "doc_id"]
    # Written with all that the result has, as scoring is the costly part.
    scored = stage(scored.select(*carried, "n_tokens", *names), "memberships")
    sums = [F.sum(F.col("n_tokens") * F.col(n)) for n in names]
    *present, total = (x or 0.0 for x in scored.agg(*sums, F.sum("n_tokens")).first())
    whole = sum(weights.values())
    if anchor:
        domain, factor = anchor
        total = present[domains.index(domain)] * factor * whole / weights[domain]
    targets = [total * weights[d] / whole for d in domains]
    targets = [min(t, p) if d in at_most else t for d, t, p in zip(domains, targets, present, strict=True)]
    steps = fit_steps(scored, names, targets, bounds)
    chance = F.pmod(F.xxhash64("doc_id", F.lit(2)), F.lit(1 << 20)) / (1 << 20)
    up = (chance < F.col("rate") - F.floor("rate")).cast("long")
    return scored.withColumn("rate", _rate(names, steps, bounds)).withColumn(
        "copies", F.floor("rate") + up
    )
