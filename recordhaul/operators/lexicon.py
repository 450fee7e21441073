"""Words of scripts without spaces: a lexicon learned from the table, and the best path through a text.

A run is a stretch of letters of the script without a break. A piece of a run is a word if its parts
hold together (*cohesion*: it is far more frequent than its parts would make it by chance) and its neighbours
on both sides vary (*branching entropy*). Equal runs are counted first, and pieces are counted by tasks
before the shuffle. A run is then cut along the path of greatest summed log frequency.

Null and empty texts have no runs. Nothing is capped: runs are taken whole, whatever their length.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recordhaul.operators.once import evaluate_once
from recordhaul.session import stage

# Fixed value: the scripts whose words are not set apart by spaces, and the marks of long vowels, which are of no
# script.
UNSPACED = r"[\p{IsHan}\p{IsHiragana}\p{IsKatakana}\x{30fc}\x{ff70}]+"

LONGEST = 4
MIN_COUNT = 5
MIN_COHESION = 2.5
MIN_ENTROPY = 0.5
PLACES = 6


def text_runs(df: DataFrame, field: str, script: str = UNSPACED) -> DataFrame:
    """``run, n``: the distinct runs of the column and how often they occur."""
    found = F.regexp_extract_all(F.lower(F.col(field)), F.lit(script), F.lit(0))
    return df.select(F.explode(found).alias("run")).groupBy("run").agg(F.count(F.lit(1)).alias("n"))


def _letters(run: Column) -> Column:
    """The characters of a run; cutting them out by number would walk the run again for each."""
    return F.split(run, "")


def _piece(letters: Column, at: Column, size: Column) -> Column:
    return F.array_join(F.slice(letters, at, size), "")


def _pieces(runs: DataFrame, longest: int, *keep: str) -> DataFrame:
    """``at`` (from 1), ``size`` and ``piece``: every piece of up to ``longest`` characters of each run.

    Pieces are cut inside the row, so that no row holds a whole run beside a piece: a run may be a whole text.
    """
    spelled = evaluate_once(
        runs.select(*keep, _letters(F.col("run")).alias("letters")), ["letters"]
    ).filter(F.size("letters") > 0)
    length = F.size("letters")

    def from_here(at: Column) -> Column:
        return F.transform(
            F.sequence(F.lit(1), F.least(F.lit(longest), length - at + 1)),
            lambda size: F.struct(
                at.alias("at"), size.alias("size"), _piece(F.col("letters"), at, size).alias("piece")
            ),
        )

    cut = F.flatten(F.transform(F.sequence(F.lit(1), length), from_here))
    return spelled.select(*keep, F.inline(cut))


def piece_counts(runs: DataFrame, longest: int = LONGEST) -> DataFrame:
    """``piece, size, n``: how often every piece of up to ``longest`` characters occurs."""
    pieces = _pieces(runs, longest, "n")
    return pieces.groupBy("piece", "size").agg(F.sum("n").alias("n"))


def _entropy(counts: DataFrame, part: Column, name: str) -> DataFrame:
    """Entropy of the neighbours on one side, by the pieces one longer.

    An end of a run is a neighbour of its own each time: it adds to the total and nothing to the sum.
    """
    longer = counts.filter("size > 1").select(part.alias("piece"), "n")
    weight = F.sum(F.col("n") * F.ln("n")).alias(name)
    return longer.groupBy("piece").agg(weight)


def learn_lexicon(
    runs: DataFrame,
    longest: int = LONGEST,
    min_count: int = MIN_COUNT,
    min_cohesion: float = MIN_COHESION,
    min_entropy: float = MIN_ENTROPY,
) -> DataFrame:
    """``piece, size, n, cohesion, entropy``: the words of two characters or more that a table shows.

    Single characters are listed with their counts and neither figure, whatever their count. Cohesion is the least, over the ways to cut the piece in two, of ``ln(n * total / (n of the left part *
    n of the right part))``, with the characters of the table as ``total``. Entropy is the lesser one of the
    two sides. Both are rounded to 6 places.
    """
    counts = stage(piece_counts(runs, longest + 1), "pieces")
    total = _characters(counts)
    frequent = counts.filter((F.col("size").between(2, longest)) & (F.col("n") >= min_count))
    ways = frequent.select(
        "piece", "size", "n", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("cut")
    ).select(
        "piece", "size", "n",
        F.left("piece", F.col("cut")).alias("l"), F.right("piece", F.col("size") - F.col("cut")).alias("r"),
    )
    parts = counts.filter(F.col("size") < longest)
    left = parts.select(F.col("piece").alias("l"), F.col("n").alias("ln"))
    right = parts.select(F.col("piece").alias("r"), F.col("n").alias("rn"))
    scored = ways.join(left, "l").join(right, "r")
    odds = F.col("n").cast("double") * F.lit(total) / (F.col("ln").cast("double") * F.col("rn"))
    bound = scored.groupBy("piece", "size", "n").agg(F.round(F.ln(F.min(odds)), PLACES).alias("cohesion"))
    bound = bound.filter(F.col("cohesion") >= min_cohesion)
    before = _entropy(counts, F.right("piece", F.col("size") - 1), "before")
    after = _entropy(counts, F.left("piece", F.col("size") - 1), "after")
    sides = bound.join(before, "piece", "left").join(after, "piece", "left")
    most = F.greatest(F.coalesce("before", F.lit(0.0)), F.coalesce("after", F.lit(0.0)))
    words = sides.withColumn("entropy", F.round(F.ln("n") - most / F.col("n"), PLACES))
    words = words.filter(F.col("entropy") >= min_entropy).select("piece", "size", "n", "cohesion", "entropy")
    none = F.lit(None).cast("double")
    return words.unionByName(
        counts.filter("size = 1").select("piece", "size", "n", none.alias("cohesion"), none.alias("entropy"))
    )


def _characters(counts: DataFrame) -> int:
    """Characters of the table: one number."""
    return counts.filter("size = 1").agg(F.sum("n")).first()[0] or 0


def _path(weights: Column, longest: int) -> Column:
    """Sizes of the words along the best path, from the right: the scores of the next ``longest`` ends suffice.

    ``weights`` holds, for each character, the weight of the word of each size that starts there, or null.
    Of equal scores the longer word wins.
    """
    start = F.struct(
        F.array(F.lit(0.0)).alias("scores"), F.array().cast("array<int>").alias("sizes")
    )

    def step(acc: Column, here: Column) -> Column:
        ways = F.zip_with(here, acc["scores"], lambda w, s: w + s)
        tried = F.filter(
            F.transform(ways, lambda v, i: F.struct(v.alias("v"), (i + 1).alias("k"))),
            lambda way: way["v"].isNotNull(),
        )
        best = F.array_max(tried)
        return F.struct(
            F.slice(F.concat(F.array(best["v"]), acc["scores"]), 1, longest).alias("scores"),
            F.concat(acc["sizes"], F.array(best["k"])).alias("sizes"),
        )

    chosen = F.reverse(F.aggregate(F.reverse(weights), start, step, lambda acc: acc["sizes"]))
    # Walk along the choices: those inside of a word are passed over.
    walk = F.struct(F.lit(0).alias("left"), F.array().cast("array<int>").alias("taken"))
    return F.aggregate(
        chosen,
        walk,
        lambda acc, size: F.struct(
            (F.when(acc["left"] > 0, acc["left"]).otherwise(size) - 1).alias("left"),
            F.when(acc["left"] > 0, acc["taken"])
            .otherwise(F.concat(acc["taken"], F.array(size)))
            .alias("taken"),
        ),
        lambda acc: acc["taken"],
    )


def segment_runs(runs: DataFrame, lexicon: DataFrame, longest: int = LONGEST) -> DataFrame:
    """``rid, at, word``: every ``run`` cut into words of the lexicon and single characters; ``rid`` names it.

    The weight of a word is ``ln(n / (total + 1))`` over the counts of the lexicon and its characters, and that of an
    unknown character that of a count of 1; so a run is cut alike in every table. A
    character that no word of the lexicon covers ends the path before and after it, so a run falls into short
    stretches, each a group of its own; only such a stretch is ever put together. The lexicon is written
    first, so that Spark broadcasts it only if it is small.
    """
    known = stage(lexicon.filter(F.col("size").between(1, longest)).select("piece", "size", "n"), "words")
    share = F.lit(_characters(known) + 1).cast("double")
    weighed = known.select("piece", F.ln(F.col("n") / share).alias("w"))
    unknown = F.when(F.col("size") == 1, F.ln(F.lit(1.0) / share))
    pieces = _pieces(runs, longest, "rid").join(weighed, "piece", "left")
    found = pieces.withColumn("w", F.coalesce("w", unknown)).filter(F.col("w").isNotNull())
    by_size = F.array(*[F.max(F.when(F.col("size") == k, F.col("w"))) for k in range(1, longest + 1)])
    first = F.max(F.when(F.col("size") == 1, F.col("piece"))).alias("letter")
    starts = found.groupBy("rid", "at").agg(
        by_size.alias("weights"), F.max(F.col("at") + F.col("size")).alias("end"), first
    )
    order = Window.partitionBy("rid").orderBy("at")
    reach = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    cut = starts.withColumn("opens", (F.coalesce(reach, F.lit(0)) <= F.col("at")).cast("int"))
    cut = cut.withColumn("stretch", F.sum("opens").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    whole = cut.groupBy("rid", "stretch").agg(
        F.sort_array(F.collect_list(F.struct("at", "weights", "letter"))).alias("row")
    )
    sized = evaluate_once(whole.withColumn("sizes", _path(F.col("row.weights"), longest)), ["sizes"])
    ends = F.aggregate(
        "sizes", F.array(F.lit(0)), lambda acc, k: F.concat(acc, F.array(F.element_at(acc, -1) + k))
    )
    placed = evaluate_once(sized.withColumn("ends", ends), ["ends"])
    words = F.zip_with(
        "sizes", "ends",
        lambda k, end: F.struct(
            (F.get("row.at", F.lit(0)) + end).alias("at"), _piece(F.col("row.letter"), end + 1, k).alias("word")
        ),
    )
    told = F.filter(words, lambda word: word["at"].isNotNull())
    return placed.select("rid", F.inline(F.filter(told, lambda word: word["word"].isNotNull())))


def word_tokens(
    df: DataFrame, key: str, field: str, lexicon: DataFrame, script: str = UNSPACED, longest: int = LONGEST
) -> DataFrame:
    """``_id, field, token, tf``: the words of every document's runs, counted; texts stay where they are.

    Repeated rows of one key count together.
    """
    found = F.regexp_extract_all(F.lower(F.col(field)), F.lit(script), F.lit(0))
    held = df.select(F.col(key).cast("string").alias("_id"), F.explode(found).alias("run"))
    held = stage(held.groupBy("_id", "run").agg(F.count(F.lit(1)).alias("times")), "runs")
    # A run is named by a number from here on: it would be with each of its words otherwise.
    runs = held.select("run").distinct().withColumn("rid", F.monotonically_increasing_id())
    runs = stage(runs, "runs")
    words = segment_runs(runs, lexicon, longest).groupBy("rid", "word").agg(F.count("*").alias("inside"))
    named = held.join(runs, "run").select("_id", "rid", "times")
    both = named.join(words, "rid").groupBy("_id", F.col("word").alias("token"))
    return both.agg(F.sum(F.col("times") * F.col("inside")).alias("tf")).select(
        "_id", F.lit(field).alias("field"), "token", "tf"
    )
