"""A training-data pipeline over ``documents``, of operators in ``recordhaul.llm``.

``STAGES`` names the stages in their order. Each function takes ``(spark, docs, sf_dir)`` and returns
what it makes of ``docs``; ``run`` writes each result below the shared folder and reads it again. All
but the last return the columns of ``documents``, and nothing else that ``docs`` may have.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from recordhaul.llm.line_dedup import drop_shared_lines
from recordhaul.llm.minhash import near_duplicates
from recordhaul.llm.mixing import mix
from recordhaul.llm.packing import pack_documents
from recordhaul.llm.quality import quality_verdicts
from recordhaul.session import stage

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")

#: Shares of expected tokens after mixing. They are set by what a corpus should hold, not by what these
#: documents hold: little that is toxic, and a quarter more of good text than there is. The first stage
#: judges what is poor.
MIXTURE = {"good": 0.95, "toxic": 0.05}
ANCHOR = ("good", 1.25)
#: Documents likelier toxic than not may go and do not come twice; all others come once at least.
TOXIC = 0.5
MOST = 4.0


def _documents(docs: DataFrame) -> DataFrame:
    return docs.select(*COLUMNS)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules or the forest reject go.

    Null, empty and short texts are rejected; rows are judged by their own text, also where they
    share a ``doc_id`` or have none.
    """
    docs = _documents(docs)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    kept = quality_verdicts(docs, labels).where("kept")
    kept = kept.select(F.col("doc_id").alias("_id"), F.col("row").alias("_row"))
    same = docs.doc_id.eqNullSafe(F.col("_id")) & (F.xxhash64(docs.text) == F.col("_row"))
    return _documents(docs.join(kept, same, "left_semi"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that five documents or more share stay in the last of them only.

    ``n_chars`` becomes that of the reduced text. A null text becomes an empty one.
    """
    reduced = drop_shared_lines(_documents(docs))
    return _documents(reduced.withColumn("n_chars", F.char_length("text").cast("long")))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document of the smallest ``doc_id`` stays, once.

    Rows that share a ``doc_id`` stay if any of them is that document, and once each if they are
    equal in text. Texts without words are nobody's duplicate. Rows without a ``doc_id`` stay.
    """
    docs = _documents(docs)
    kept = near_duplicates(docs).where("kept AND doc_id IS NOT NULL").select("doc_id").distinct()
    again = Window.partitionBy("doc_id", "_row").orderBy("source")
    once = (
        docs.join(kept, "doc_id", "left_semi")
        .withColumn("_row", F.xxhash64("text"))
        .withColumn("_again", F.row_number().over(again))
        .where("_again = 1")
    )
    return _documents(once).union(docs.where("doc_id IS NULL"))


def target_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their rate says: likely toxic ones once or not at all, others up to four times.

    Null and empty texts have no token and come as often as texts without a telling word. Repeated rows
    come equally often each. Without labels every document is half toxic by chance alone, so none is
    likelier toxic than not and all stay. An empty table stays empty.
    """
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    toxic = F.col("p_toxic") > TOXIC
    bounds = (F.when(toxic, 0.0).otherwise(1.0), F.when(toxic, 1.0).otherwise(MOST))
    mixed = mix(_documents(docs), labels, MIXTURE, ANCHOR, bounds, at_most=("toxic",))
    copies = F.explode(F.array_repeat(F.lit(0), F.col("copies").cast("int")))
    return _documents(mixed.withColumn("_copy", copies))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents, over sequences of at most 4096 tokens.

    Null and empty texts are their end id alone; repeated rows and copies are packed each; an empty table
    has no piece.
    """
    return pack_documents(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup),
    ("MinHash near-dedup", near_dedup),
    ("mixing to target weights", target_mixing),
    ("packing", packing),
]

#: The stages train, hash and pack; SQL cannot express them. Tests compare them with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, function in STAGES:
        docs = stage(function(spark, docs, sf_dir), name.lower().replace(" ", "-"))
    return docs
