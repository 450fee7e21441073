"""Queries of the operators in this package, and the SQL that gives the same rows where it can."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recordhaul.llm.html_text import extract_pages
from recordhaul.llm.line_dedup import drop_shared_lines
from recordhaul.llm.merkle import edited_fingerprints
from recordhaul.llm.minhash import near_duplicates
from recordhaul.llm.mixing import mix
from recordhaul.llm.nb_svm import classify
from recordhaul.llm.packing import pack_documents
from recordhaul.llm.prefix_trie import prefix_nodes, rebuild, turn_lists
from recordhaul.llm.quality import COUNTS, quality_verdicts
from recordhaul.llm.secrets import scan_secrets, span_list
from recordhaul.llm.sentence_spans import drop_repeated_spans
from recordhaul.llm.token_alignment import align
from recordhaul.llm.token_files import read_token_files, write_token_files
from recordhaul.session import new_folder

QUERIES = {}
ORACLE_SQL = {}


def _query(sql: str | None = None):
    def register(function):
        QUERIES[function.__name__] = function
        if sql:
            ORACLE_SQL[function.__name__] = sql
        return function

    return register


#: Where this package can be imported from.
_ROOT = str(Path(__file__).resolve().parents[2])


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    # Python workers import the operators; a driver that was started elsewhere has no path for them.
    spark.sparkContext.environment.setdefault("PYTHONPATH", _ROOT)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@_query(r"""
    WITH lines AS (
        SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
               generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
        FROM documents),
    keyed AS (
        SELECT *, translate(
            trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
        FROM lines),
    shared AS (
        SELECT key, max(doc_id) AS last FROM keyed WHERE length(key) >= 40
        GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
    marked AS (
        SELECT k.*, coalesce(k.doc_id < s.last, false) AS gone
        FROM keyed k LEFT JOIN shared s ON k.key = s.key)
    SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
           sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), ''))
               AS kept_sha256
    FROM marked GROUP BY doc_id""")
def op6_line_dedup(spark, sf_dir):
    reduced = drop_shared_lines(_table(spark, sf_dir, "documents"))
    digest = F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256")
    return reduced.select("doc_id", "n_lines", "n_dropped", digest)


@_query()
def op9_minhash_near_dedup(spark, sf_dir):
    return near_duplicates(_table(spark, sf_dir, "documents"), size=3, percent=85)


@_query()
def op10_substring_dedup(spark, sf_dir):
    return drop_repeated_spans(_table(spark, sf_dir, "documents").select("doc_id", "text"))


@_query()
def op5_quality_rules(spark, sf_dir):
    labels = _table(spark, sf_dir, "labels")
    verdicts = quality_verdicts(_table(spark, sf_dir, "documents"), labels)
    return verdicts.select("doc_id", *COUNTS, "base_failed", "kept")


@_query()
def op7_token_files(spark, sf_dir):
    folder = new_folder(spark, "token-files")
    write_token_files(_table(spark, sf_dir, "documents"), folder)
    checksum = F.crc32("ids").alias("ids_crc32")
    return read_token_files(spark, folder).select("doc_id", "start", "n_tokens", checksum)


@_query()
def op8_packing(spark, sf_dir):
    # About a quarter of a document, four characters an id, is its prompt and bears no loss.
    prompt = F.floor(F.char_length("text") / 16).alias("prompt_tokens")
    documents = _table(spark, sf_dir, "documents").select("doc_id", "text", prompt)
    return pack_documents(documents, segments=64, loss_tokens=3200)


@_query()
def op3_secret_scan(spark, sf_dir):
    found = scan_secrets(_table(spark, sf_dir, "documents"))
    digest = F.sha2(span_list("base").cast("binary"), 256).alias("base_sha256")
    return found.select(
        "doc_id", "n_assign", "n_access", "n_hex", "n_linked", digest, span_list("spans").alias("spans")
    )


@_query()
def op4_document_fingerprints(spark, sf_dir):
    return edited_fingerprints(_table(spark, sf_dir, "documents"))


@_query()
def op1_html_extraction(spark, sf_dir):
    return extract_pages(_table(spark, sf_dir, "pages"))


@_query()
def op2_target_mixing(spark, sf_dir):
    labels = _table(spark, sf_dir, "labels")
    weights = {"good": 0.85, "poor": 0.10, "toxic": 0.05}
    return mix(_table(spark, sf_dir, "documents"), labels, weights, carry=("doc_id",))


@_query()
def op11_quality_classifier(spark, sf_dir):
    return classify(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


@_query()
def op12_token_alignment(spark, sf_dir):
    return align(_table(spark, sf_dir, "documents"))


@_query(r"""
    WITH turns AS (
        SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
        FROM conversations WHERE conv_id IS NOT NULL),
    lists AS (
        SELECT conv_id, list({'role': role, 'text': text} ORDER BY turn NULLS FIRST) AS turns
        FROM turns GROUP BY conv_id),
    counted AS (
        -- crc32, a byte at a time and then a bit at a time
        SELECT conv_id, turns, xor(4294967295, list_reduce(
            list_prepend(4294967295::BIGINT, list_transform(
                string_split(conv_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
            lambda crc, byte: list_reduce(
                list_prepend(xor(crc, byte), range(8)),
                lambda x, bit: xor(x >> 1, 3988292384 * (x & 1))))) % 4 AS h
        FROM lists),
    rebuilt AS (
        SELECT c.conv_id, list_concat(
            coalesce(b.turns, [])[1:c.h], c.turns[c.h + 1:]) AS turns
        FROM counted c LEFT JOIN lists b ON b.conv_id = c.conv_id - c.conv_id % 20),
    prefixes AS (
        SELECT conv_id, d AS depth, turns[1:d] AS prefix, len(turns) = d AS ends
        FROM (SELECT *, unnest(range(0, len(turns) + 1)) AS d FROM rebuilt)),
    nodes AS (
        SELECT prefix, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
               sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE ends), ''))
                   AS ends_sha256
        FROM prefixes GROUP BY prefix, depth),
    below AS (
        SELECT prefix[1:depth - 1] AS prefix, count(*) AS n_children
        FROM nodes WHERE depth > 0 GROUP BY 1),
    valued AS (
        SELECT n.*, coalesce(b.n_children, 0) AS n_children,
               CASE WHEN n.depth = 0 THEN 0 ELSE (n.n_convs - 1) * len(regexp_extract_all(
                   n.prefix[n.depth].text, '[^ 	-]+')) END AS saved
        FROM nodes n LEFT JOIN below b ON n.prefix = b.prefix),
    summed AS (
        SELECT prefix[1:d] AS prefix, sum(saved)::BIGINT AS saved_tokens,
               count(*) FILTER (WHERE n_children = 0) AS n_leaves
        FROM (SELECT *, unnest(range(0, depth + 1)) AS d FROM valued) GROUP BY 1)
    SELECT v.conv_id, v.depth::BIGINT AS depth, p.conv_id AS parent_conv_id, v.n_convs, v.n_children,
           s.n_leaves, s.saved_tokens, v.ends_sha256
    FROM valued v JOIN summed s ON v.prefix = s.prefix
    LEFT JOIN nodes p ON v.depth > 0 AND p.prefix = v.prefix[1:v.depth - 1]""")
def op13_prefix_trie(spark, sf_dir):
    return prefix_nodes(rebuild(turn_lists(_table(spark, sf_dir, "conversations"))))
