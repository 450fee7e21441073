"""A stored index whose top hits are found without reading whole posting lists.

Documents are put into ranges of about ``RANGE_DOCS``, by length, as short documents score higher. The
postings of a token in a range are one *block*, a row with the greatest saturation that any of them has. For
a query, the blocks' heads alone bound the score of every document of a range; the ranges of the
greatest bounds are scored first, and then only those whose bound reaches the worst of the hits found.

Blocks are laid out by size: in the order of their token's hash and of their range, running sums of their
bytes deal them out to write parts of ``PART_BYTES``. A word that is in every document fills several parts, one
behind the other, and rare words share one; no part has more than a block too much, and the number of parts
follows from the data. A dictionary holds each token's documents and parts.
"""

from __future__ import annotations

from math import log2

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from recordhaul.operators.search import SCORE_PLACES, _best, _idf, _saturation, query_terms
from recordhaul.session import stage

RANGE_DOCS = 4096
PART_BYTES = 64 << 20
#: Ranges that are scored first.
PROBED = 8
#: Blocks whose sizes are summed up in one window, about; those of one token are in one.
SLICE_BLOCKS = 1_000_000
#: Tasks that the tokens of a range are dealt out to.
TOKEN_SHARES = 4

BLOCKS = "token string, range int, n bigint, top double, bytes bigint, hits array<struct<_id: string, tf: bigint, dl: bigint>>, part int"
DICTIONARY = "token string, df bigint, first_part int, last_part int, slice int"
#: Lengths up to this are told apart; longer ones by 1/256 of their logarithm. So there are few classes.
EXACT_LENGTHS = 4096


def _length_class(dl: Column) -> Column:
    over = F.floor(F.log2(dl / EXACT_LENGTHS) * 256)
    return F.when(dl < EXACT_LENGTHS, dl).otherwise(EXACT_LENGTHS + over).cast("int")


def assign_ranges(counts: dict[int, int], size: int) -> list[tuple[int, int, int]]:
    """``(length class, first range, ranges)`` for the documents of each class, shortest first.

    Small classes share a range until it has ``size`` documents; a larger one has ranges of its own.
    """
    out, number, held = [], 0, 0
    for kind, docs in sorted(counts.items()):
        if docs > size:
            number += held > 0
            own = -(-docs // size)
            out.append((kind, number, own))
            number, held = number + own, 0
            continue
        if held + docs > size:
            number, held = number + 1, 0
        out.append((kind, number, 1))
        held += docs
    return out


def with_ranges(index: DataFrame, size: int = RANGE_DOCS) -> DataFrame:
    """Postings with ``range``: their documents' number in the order of length.

    A document of ``dl`` tokens has as many in its postings, so the number of documents of a length is a
    sum over postings; no text is read.
    """
    spark = index.sparkSession
    share = F.sum(F.col("tf") / F.col("dl"))
    found = index.groupBy(_length_class(F.col("dl")).alias("kind")).agg(F.ceil(F.round(share, 3)).alias("docs"))
    # A row a length class: fewer than EXACT_LENGTHS + 256 * 51, as no length exceeds 2 ** 63.
    assert EXACT_LENGTHS + 256 * (63 - log2(EXACT_LENGTHS)) < 20_000
    counts = {row["kind"]: row["docs"] for row in found.collect()}
    placed = spark.createDataFrame(assign_ranges(counts, size), "kind int, first int, ranges int")
    joined = index.withColumn("kind", _length_class(F.col("dl"))).join(F.broadcast(placed), "kind")
    number = F.col("first") + F.pmod(F.xxhash64("_id"), F.col("ranges")).cast("int")
    return joined.withColumn("range", number).drop("kind", "first", "ranges")


def posting_blocks(ranged: DataFrame, avgdl: float) -> DataFrame:
    """``token, range, n, top, bytes, hits``: one row for the postings of a token in a range.

    A block holds about as many postings as a range has documents, at most. Postings are dealt out by range and
    share of the tokens, so those of one document stay together, which compresses well, and not grouped
    before: few postings of a task fall into one block.
    """
    hit = F.struct("_id", "tf", "dl")
    top = F.max(_saturation(F.col("tf"), F.col("dl"), F.lit(avgdl)))
    share = F.pmod(F.xxhash64("token"), F.lit(TOKEN_SHARES)).alias("share")
    dealt = ranged.select("token", "range", "_id", "tf", "dl", share).repartition("range", "share")
    blocks = dealt.groupBy("range", "share", "token").agg(
        F.count(F.lit(1)).alias("n"), top.alias("top"),
        F.sum(F.octet_length("_id") + 20).alias("bytes"), F.sort_array(F.collect_list(hit)).alias("hits"),
    )
    return blocks.select("token", "range", "n", "top", "bytes", "hits")


def _slice(hashed: Column, bits: int) -> Column:
    """The first bits of a hash."""
    return F.shiftrightunsigned(hashed, 64 - bits).cast("int") if bits else F.lit(0)


def deal_out(blocks: DataFrame, part_bytes: int = PART_BYTES) -> DataFrame:
    """``token, range, n, bits, slice, part, opens`` of every block.

    The running sum is taken over the heads of blocks, in slices of the hash, each one window; to it the sums
    of the slices before are added, of which there is one number a slice. ``opens`` marks the first block of a
    part in a slice.
    """
    heads = blocks.select("token", "range", "n", "bytes", F.xxhash64("token").alias("hash"))
    bits = max(0, -(-blocks.count() // SLICE_BLOCKS) - 1).bit_length()
    heads = heads.withColumn("bits", F.lit(bits)).withColumn("slice", _slice(F.col("hash"), bits))
    earlier = Window.rowsBetween(Window.unboundedPreceding, -1)
    sums = heads.groupBy("slice").agg(F.sum("bytes").alias("whole"))
    starts = sums.select("slice", F.coalesce(F.sum("whole").over(earlier.orderBy("slice")), F.lit(0)).alias("before"))
    ordered = Window.partitionBy("slice").orderBy("hash", "token", "range")
    running = F.sum("bytes").over(ordered.rowsBetween(Window.unboundedPreceding, -1))
    placed = heads.withColumn("at", F.coalesce(running, F.lit(0))).withColumn("last_at", F.lag("at").over(ordered))
    placed = placed.join(starts, "slice")

    def part(at: str) -> Column:
        return F.floor((F.col("before") + F.col(at)) / part_bytes).cast("int")

    opens = F.col("last_at").isNull() | (part("last_at") < part("at"))
    return placed.select("token", "range", "n", "bits", "slice", part("at").alias("part"), opens.alias("opens"))


def with_parts(blocks: DataFrame, placed: DataFrame, bits: int) -> DataFrame:
    """Blocks with their part: that of the last block before them, or they themselves, that opens one.

    Only those, about one a part, are sent to the blocks, which stay where they are.
    """
    place = F.struct(F.xxhash64("token").alias("hash"), F.col("token"), F.col("range"))
    opening = placed.filter("opens").select("slice", "part", place.alias("low"))
    following = F.lead("low").over(Window.partitionBy("slice").orderBy("low"))
    bounds = F.broadcast(opening.withColumn("high", following))
    keyed = blocks.withColumns({"_slice": _slice(F.xxhash64("token"), bits), "_place": place})
    held = (F.col("_place") >= F.col("low")) & (F.col("high").isNull() | (F.col("_place") < F.col("high")))
    joined = keyed.join(bounds, (F.col("_slice") == F.col("slice")) & held)
    return joined.select(*blocks.columns, "part")


def write_block_index(
    index: DataFrame, stats: DataFrame, path: str, part_bytes: int = PART_BYTES, range_docs: int = RANGE_DOCS
) -> None:
    """Store postings as blocks below ``path``, with their dictionary and ``index_stats``.

    Postings are shuffled once into blocks, and blocks once into their parts. A part is a folder of one
    file, sorted by token and range, so that a search opens the parts of its words only. The postings are read
    twice and should be stored. On their way hits are arrays of ids and ints, as arrays of rows are wide; a
    document's tokens are elements of an array, so an int can count them.
    """
    whole = stats.first()
    avgdl = whole["avgdl"] or 1.0
    blocks = stage(posting_blocks(with_ranges(index, range_docs), avgdl), "blocks")
    placed = stage(deal_out(blocks, part_bytes), "dealt")
    last, bits = placed.agg(F.max("part"), F.max("bits")).first()
    hits = {"_id": F.col("hits._id"), **{n: F.col(f"hits.{n}").cast("array<int>") for n in ("tf", "dl")}}
    flat = with_parts(blocks, placed, bits or 0).withColumns(hits).drop("hits")
    dealt = flat.repartitionById((last or 0) + 1, F.col("part")).sortWithinPartitions("part", "token", "range")
    numbers = {n: F.col(n).cast("array<bigint>") for n in ("tf", "dl")}
    dealt = dealt.withColumns(numbers).withColumn("hits", F.arrays_zip("_id", "tf", "dl"))
    dealt = dealt.select("token", "range", "n", "top", "bytes", "hits", "part")
    dealt.write.mode("overwrite").partitionBy("part").parquet(f"{path}/blocks")
    dictionary = placed.groupBy("slice", "token").agg(
        F.sum("n").alias("df"), F.min("part").alias("first_part"), F.max("part").alias("last_part")
    )
    slices = dictionary.repartition("slice").sortWithinPartitions("slice", "token")
    slices.write.mode("overwrite").partitionBy("slice").parquet(f"{path}/dictionary")
    stats.withColumn("bits", F.lit(bits).cast("int")).write.mode("overwrite").parquet(f"{path}/stats")  # one row


def _words(spark: SparkSession, path: str, terms: list[str], bits: int) -> list:
    """The dictionary's rows of some tokens: one each."""
    hashes = spark.range(1).select(*[_slice(F.xxhash64(F.lit(t)), bits) for t in terms]).first()
    own = sorted(set(hashes))
    dictionary = spark.read.schema(DICTIONARY).parquet(f"{path}/dictionary")
    return dictionary.filter(F.col("slice").isin(*own) & F.col("token").isin(*terms)).collect()


def _blocks_of(spark: SparkSession, path: str, words: list) -> DataFrame:
    parts = sorted({p for w in words for p in range(w["first_part"], w["last_part"] + 1)})
    blocks = spark.read.schema(BLOCKS).parquet(f"{path}/blocks")
    found = F.col("part").isin(*parts) & F.col("token").isin(*[w["token"] for w in words])
    return blocks.filter(found)


def _weight(words: list, terms: dict[str, int], docs: int) -> Column:
    weight = F.lit(0.0)
    for word in words:
        worth = F.lit(float(terms[word["token"]])) * _idf(F.lit(docs), F.lit(word["df"]))
        weight = F.when(F.col("token") == word["token"], worth).otherwise(weight)
    return weight


def range_bounds(blocks: DataFrame, weight: Column) -> DataFrame:
    """``range, bound``: what no document of the range scores above. Reads the heads of blocks only."""
    return blocks.groupBy("range").agg(F.sum(weight * F.col("top")).alias("bound"))


def _scores(blocks: DataFrame, weight: Column, avgdl: float) -> DataFrame:
    """Documents of whole ranges with their scores; a range's blocks have all of a document's words."""
    hits = blocks.select("token", F.inline("hits"))
    gain = _saturation(F.col("tf"), F.col("dl"), F.lit(avgdl))
    return hits.groupBy("_id").agg(F.round(F.sum(weight * gain), SCORE_PLACES).alias("score"))


def top_hits(
    spark: SparkSession, path: str, text: str, size: int, probed: int = PROBED
) -> tuple[DataFrame, dict[str, int]]:
    """The ``size`` best hits for ``text``, as ``match_postings`` gives them, and what was read.

    The second value counts the blocks that the words have and those whose postings were read.
    """
    terms = query_terms(spark, text)
    whole = spark.read.parquet(f"{path}/stats").first()
    words = _words(spark, path, list(terms), whole["bits"] or 0) if terms else []
    if not words:
        empty = spark.createDataFrame([], "_id string, score double")
        return empty, {"blocks": 0, "read": 0}
    blocks = _blocks_of(spark, path, words)
    weight = _weight(words, terms, whole["docs"])
    bounds = stage(range_bounds(blocks, weight), "range-bounds")
    first = [row["range"] for row in bounds.orderBy(F.desc("bound"), "range").limit(probed).collect()]
    probe = _best(_scores(blocks.filter(F.col("range").isin(*first)), weight, whole["avgdl"]), "_id", size)
    found = stage(probe, "probed").agg(F.count("*"), F.min("score")).first()
    # Scores are rounded; a bound may lie below by half a unit, and by what sums of doubles differ.
    least = found[1] - 2 * 10**-SCORE_PLACES if found[0] >= size else 0.0
    wanted = bounds.filter(F.col("bound") >= least)
    edges = wanted.agg(F.min("range"), F.max("range"), F.count("*")).first()
    # The edges reach the scan; the ranges between them are picked by a join.
    near = blocks.filter(F.col("range").between(edges[0], edges[1]))
    if edges[2] < edges[1] - edges[0] + 1:
        near = near.join(wanted.select("range"), "range", "left_semi")
    read = near.agg(F.count("*")).first()[0]
    figures = {"blocks": blocks.count(), "read": read}
    return _best(_scores(near, weight, whole["avgdl"]), "_id", size), figures
