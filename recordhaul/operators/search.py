"""Searches over a table of documents: exact, range, paged, and ranked full text."""

from __future__ import annotations

from collections import Counter

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from recordhaul.functions.text import tokens
from recordhaul.session import stage

# The usual parameters of the BM25 formula.
K1 = 1.2
B = 0.75
SCORE_PLACES = 6

INDEX_BUCKETS = 64
INDEX_SPREAD = 4


def with_id(df: DataFrame, key: str) -> DataFrame:
    """Add the document id ``_id`` to the hits."""
    return df.withColumn("_id", F.col(key).cast("string"))


def _page(df: DataFrame, order: str, size: int | None, skip: int = 0) -> DataFrame:
    if size is None:
        return df
    ordered = df.orderBy(order)
    return (ordered.offset(skip) if skip else ordered).limit(size)


def search_all(df: DataFrame, key: str, size: int | None = None) -> DataFrame:
    return with_id(_page(df, key, size), key)


def page_search(df: DataFrame, key: str, skip: int, size: int) -> DataFrame:
    """``size`` documents after the first ``skip``; for deep pages use ``next_page``."""
    return with_id(_page(df, key, size, skip), key)


def term_search(
    df: DataFrame, key: str, field: str, value, size: int | None = None, text: bool = False
) -> DataFrame:
    """Documents whose ``field`` is ``value``, or has it as a token if ``text``."""
    if text:
        hit = F.array_contains(tokens(F.col(field)), F.lit(value))
    else:
        hit = F.col(field) == F.lit(value)
    return with_id(_page(df.filter(hit), key, size), key)


def range_search(
    df: DataFrame, key: str, field: str, gte=None, lte=None, size: int | None = None
) -> DataFrame:
    """Inclusive bounds, each optional; without any, every document that has the field."""
    hits = df.filter(F.col(field).isNotNull())
    if gte is not None:
        hits = hits.filter(F.col(field) >= F.lit(gte))
    if lte is not None:
        hits = hits.filter(F.col(field) <= F.lit(lte))
    return with_id(_page(hits, key, size), key)


def doc_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n"))


def postings(df: DataFrame, key: str, field: str) -> DataFrame:
    """``_id, field, token, tf, dl``: every distinct token of every document.

    A document is one row, so its tokens are sorted and counted inside the row: runs of
    equal tokens start where a token differs from the one before. Nothing is shuffled.
    """
    words = df.select(
        F.col(key).cast("string").alias("_id"), F.sort_array(tokens(F.col(field))).alias("words")
    )
    sized = words.select("_id", "words", F.size("words").alias("dl"))
    places = F.when(F.col("dl") > 0, F.sequence(F.lit(0), F.col("dl") - 1))
    starts = F.filter(places, lambda i: (i == 0) | (F.get("words", i) != F.get("words", i - 1)))
    marked = sized.withColumn("starts", starts)
    runs = F.transform(
        F.col("starts"),
        lambda start, n: F.struct(
            F.get("words", start).alias("token"),
            (F.coalesce(F.get("starts", n + 1), F.col("dl")) - start).cast("bigint").alias("tf"),
        ),
    )
    return marked.select("_id", "dl", F.inline(runs)).select(
        "_id", F.lit(field).alias("field"), "token", "tf", F.col("dl").cast("bigint").alias("dl")
    )


def token_doc_freq(df: DataFrame, field: str) -> DataFrame:
    """Documents per token; counted before the shuffle, so common words cost little."""
    words = df.select(F.explode(F.array_distinct(tokens(F.col(field)))).alias("token"))
    return words.groupBy("token").agg(F.count(F.lit(1)).alias("df"))


def index_stats(df: DataFrame, index: DataFrame) -> DataFrame:
    """One row: number of documents, and their mean length in tokens from the postings.

    Neither reads the text again.
    """
    docs = df.agg(F.count(F.lit(1)).alias("docs"))
    total = index.agg(F.coalesce(F.sum("tf"), F.lit(0)).alias("total"))
    both = docs.select("docs", F.lit(0).alias("total")).unionByName(
        total.select(F.lit(0).alias("docs"), "total")
    )
    summed = both.agg(F.sum("docs").alias("docs"), F.sum("total").alias("total"))
    return summed.select("docs", (F.col("total") / F.nullif("docs", F.lit(0))).alias("avgdl"))


def query_terms(spark: SparkSession, text: str) -> Counter:
    """Tokens of the query text, cut as the documents are, with their number."""
    found = spark.range(1).select(tokens(F.lit(text)).alias("t")).first()
    return Counter(found["t"])


def _times(words: str, term: str) -> Column:
    return F.size(F.filter(words, lambda word: word == F.lit(term)))


def _idf(docs: Column, df: Column) -> Column:
    return F.log(1 + (docs - df + 0.5) / (df + 0.5))


def _saturation(tf: Column, dl: Column, avgdl: Column) -> Column:
    return tf / (tf + K1 * (1 - B + B * dl / avgdl))


def match_search(
    df: DataFrame, key: str, field: str, text: str, size: int | None = None
) -> DataFrame:
    """Documents with any word of ``text``, best BM25 score first.

    The text is read and cut once. What is left of a document, its length and the counts
    of the words asked for, is written, and gives both the statistics and the scores; only
    the top ``size`` rows per task are compared in the end. For repeated queries write
    ``postings`` once and use ``match_postings``.
    """
    terms = query_terms(df.sparkSession, text)
    if not terms:
        return with_id(df.filter(F.lit(False)).select(key), key).withColumn(
            "score", F.lit(0.0)
        )
    words = df.select(key, tokens(F.col(field)).alias("words"))
    counted = stage(
        words.select(
            key,
            F.size("words").alias("dl"),
            *[_times("words", term).alias(f"tf_{n}") for n, term in enumerate(terms)],
        ),
        "counted",
    )
    found = [F.col(f"tf_{n}") > 0 for n in range(len(terms))]
    stats = counted.agg(
        F.count(F.lit(1)).alias("docs"),
        F.avg("dl").alias("avgdl"),
        *[F.count_if(hit).alias(f"df_{n}") for n, hit in enumerate(found)],
    ).first()  # one row of numbers, put into the scores as constants
    score = F.lit(0.0)
    for n, weight in enumerate(terms.values()):
        gain = _idf(F.lit(stats["docs"]), F.lit(stats[f"df_{n}"])) * _saturation(
            F.col(f"tf_{n}"), F.col("dl"), F.lit(stats["avgdl"])
        )
        score = score + F.lit(float(weight)) * gain
    any_hit = found[0]
    for hit in found[1:]:
        any_hit = any_hit | hit
    scored = counted.filter(any_hit).select(key, F.round(score, SCORE_PLACES).alias("score"))
    return with_id(_best(scored, key, size), key)


def _best(scored: DataFrame, key: str, size: int | None) -> DataFrame:
    """The top hits; ties go by the key, as a number where it is one, as text or not."""
    if size is None:
        return scored
    number = F.col(key).try_cast("bigint").asc_nulls_last()
    return scored.orderBy(F.desc("score"), number, key).limit(size)


def _bucket(token: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(token), F.lit(buckets))


def write_index(
    index: DataFrame, path: str, buckets: int = INDEX_BUCKETS, spread: int = INDEX_SPREAD
) -> None:
    """Store postings by token, so that a search reads only the words asked for.

    A token's bucket is a folder; within its files rows are sorted by token. The rows of
    a bucket come from ``spread`` tasks, split by document, so a word that is in every
    document fills several files. One hash shuffle: no pass to find range bounds first.
    Every row holds the number of buckets, so that a search cannot take another one.
    """
    placed = index.withColumn("bucket", _bucket(F.col("token"), buckets))
    placed = placed.withColumn("buckets", F.lit(buckets))
    share = F.pmod(F.xxhash64("_id"), F.lit(spread))
    spread_out = placed.repartition("bucket", share).sortWithinPartitions("bucket", "token", "_id")
    spread_out.write.mode("overwrite").partitionBy("bucket").parquet(path)


def _wanted(index: DataFrame, terms: list[str]) -> Column:
    """The postings of some tokens; of a stored index only their folders are read."""
    wanted = F.col("token").isin(*terms)
    if "bucket" in index.columns:
        first = index.select("buckets").first()
        buckets = first["buckets"] if first else 1
        wanted = wanted & F.col("bucket").isin(*[_bucket(F.lit(term), buckets) for term in terms])
    return wanted


def with_documents(hits: DataFrame, documents: DataFrame, key: str) -> DataFrame:
    """Hits with every field of their documents; a few top hits are broadcast by their size."""
    return with_id(documents, key).join(hits, "_id")


def term_postings(index: DataFrame, documents: DataFrame, key: str, value: str) -> DataFrame:
    """As ``term_search`` on text, from postings: no document is cut into tokens for it."""
    hits = index.filter(_wanted(index, [value])).select("_id").distinct()
    return with_documents(hits, documents, key)


def match_postings(
    index: DataFrame,
    stats: DataFrame,
    text: str,
    size: int | None = None,
) -> DataFrame:
    """As ``match_search``, from postings and ``index_stats``; stored ones are pruned."""
    terms = query_terms(index.sparkSession, text)
    hits = index.filter(_wanted(index, list(terms))).select("_id", "token", "tf", "dl")
    # As many rows as the query has words.
    frequencies = hits.groupBy("token").agg(F.count(F.lit(1)).alias("df"))
    whole = stats.first()
    weight = F.lit(0.0)
    for term, times in terms.items():
        weight = F.when(F.col("token") == term, float(times)).otherwise(weight)
    gain = _idf(F.lit(whole["docs"]), F.col("df")) * _saturation(
        F.col("tf"), F.col("dl"), F.lit(whole["avgdl"])
    )
    scored = (
        hits.join(F.broadcast(frequencies), "token")
        .groupBy("_id")
        .agg(F.round(F.sum(weight * gain), SCORE_PLACES).alias("score"))
    )
    return _best(scored, "_id", size)
