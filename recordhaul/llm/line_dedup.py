"""Line de-duplication: drop lines that many documents share, but for their last holder.

Lines are exploded, normalised and hashed; the distinct documents of each hash are counted; lines
over the threshold are dropped, and what stays is put together by position. DataFrame functions
only. A line that sits in a third of all documents costs one row per task in the counts, which
are taken over distinct (hash, document) pairs, and is split by the adaptive skew join where the
hashes meet the positions. The text itself moves once, to meet its dropped positions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordhaul.session import stage

WHITE = " \t\n\x0b\x0c\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def line_key(line: Column) -> Column:
    """The line without ASCII white space at its ends and with A-Z in lower case."""
    bare = F.btrim(line, F.lit(WHITE))
    ascii_only = F.octet_length(bare) == F.char_length(bare)
    return F.when(ascii_only, F.lower(bare)).otherwise(F.translate(bare, UPPER, UPPER.lower()))


def _without(lines: Column, dropped: Column) -> Column:
    """``lines`` without the positions in the sorted array ``dropped``, joined by line feeds."""
    begin = lambda n: F.when(n == 0, 0).otherwise(F.get(dropped, n - 1) + 1)
    end = lambda n: F.coalesce(F.get(dropped, n), F.size(lines))
    runs = F.transform(
        F.sequence(F.lit(0), F.size(dropped)),
        lambda n: F.slice(lines, begin(n) + 1, end(n) - begin(n)),
    )
    return F.array_join(F.flatten(runs), "\n")


def drop_shared_lines(documents: DataFrame, min_chars: int = 40, min_documents: int = 5) -> DataFrame:
    """``documents`` with ``text`` reduced, and ``n_lines`` (before) and ``n_dropped`` added.

    A line whose key has ``min_chars`` code points or more and occurs in ``min_documents``
    distinct ``doc_id`` or more goes wherever it stands, except in the largest ``doc_id``.

    Null text counts as empty, which is one empty line. Rows without ``doc_id`` count as no
    document and lose nothing. Rows that share a ``doc_id`` count as one document; each is
    reduced by its own lines. Other columns are carried along, save any of the names
    ``n_lines`` and ``n_dropped``, which are replaced, and ``_row`` and ``_dropped``, which go.
    """
    source = documents.drop("n_lines", "n_dropped", "_row", "_dropped").withColumn("text", F.coalesce("text", F.lit("")))
    source = source.withColumn("_row", F.xxhash64("text"))
    lines = source.select("doc_id", "_row", F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    keyed = (
        lines.select("doc_id", "_row", "pos", line_key(F.col("line")).alias("key"))
        .where((F.char_length("key") >= min_chars) & F.col("doc_id").isNotNull())
        .select(
            "doc_id", "_row", "pos",
            F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), "key").alias("h2"),
        )
    )
    keyed = stage(keyed, "line-keys")
    holders = keyed.select("h1", "h2", "doc_id").distinct().groupBy("h1", "h2")
    shared = holders.agg(F.count("*").alias("documents"), F.max("doc_id").alias("last"))
    shared = stage(shared.where(F.col("documents") >= min_documents), "shared-lines")
    dropped = (
        keyed.join(shared, ["h1", "h2"])
        .where(F.col("doc_id") < F.col("last"))
        .groupBy("doc_id", "_row")
        .agg(F.sort_array(F.collect_set("pos")).alias("_dropped"))
    )
    split = F.split("text", "\n")
    kept = F.when(F.col("_dropped").isNull(), F.col("text")).otherwise(_without(split, F.col("_dropped")))
    return (
        source.join(dropped, ["doc_id", "_row"], "left")
        .withColumn("n_lines", F.size(split).cast("long"))
        .withColumn("n_dropped", F.coalesce(F.size("_dropped"), F.lit(0)).cast("long"))
        .withColumn("text", kept)
        .drop("_row", "_dropped")
        .select(*source.drop("_row").columns, "n_lines", "n_dropped")
    )
