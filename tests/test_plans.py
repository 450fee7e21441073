"""Properties of the physical plans that decide how a query grows."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from recordhaul.operators import dedup, ingest, messages, paging, search, stats

SF_DIR = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def optimized(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def read(spark, name):
    return spark.read.parquet(f"{SF_DIR}/{name}.parquet")


LAZY = sorted(
    set(entry._QUERIES)
    - {
        "load_folder", "stream_sync", "stream_sync_totals", "full_load_log", "stream_sync_compacted",
        "stream_changes", "stream_dead_letters", "load_stream", "stream_offsets", "stream_offset_gaps",
    }
)


@pytest.mark.parametrize("name", LAZY)
def test_no_python_and_no_pair_join(spark, name):
    text = plan(entry._QUERIES[name](spark, SF_DIR))
    assert not re.search("Python|ArrowEval|MapInPandas|MapInArrow|CartesianProduct|NestedLoop", text)


def test_parsing_happens_once(spark):
    lines = spark.createDataFrame([("{}",)], "value string")
    kept = ingest.accepted(ingest.clean_records(ingest.parse_records(lines)))
    assert optimized(kept).count("from_json") == 2
    sent = spark.createDataFrame([("t", "{}")], "topic string, value string")
    documents, _ = messages.split_dead_letters(messages.decode_messages(sent))
    assert optimized(documents).count("from_json") == 2


def test_filters_and_columns_reach_the_scan(spark):
    text = plan(paging.keyset_page(read(spark, "orders").select("o_orderkey"), "o_orderkey", 137))
    assert "GreaterThanOrEqual(o_orderkey,137)" in text
    assert "ReadSchema: struct<o_orderkey:bigint>" in text
    assert "TakeOrderedAndProject" in text
    prices = search.range_search(read(spark, "orders"), "o_orderkey", "o_totalprice", 1.0, 2.0)
    assert "LessThanOrEqual(o_totalprice,2.0)" in plan(prices)


def test_narrow_operators_do_not_shuffle(spark):
    documents = read(spark, "documents")
    assert "Exchange" not in plan(search.postings(documents, "doc_id", "text"))
    lines = documents.select(F.col("text").alias("value"))
    assert "Exchange" not in plan(ingest.accepted(ingest.clean_records(ingest.parse_records(lines))))


def test_groups_are_reduced_before_the_shuffle(spark):
    documents = read(spark, "documents")
    lines = documents.select(F.col("source").alias("file"), F.col("text").alias("value"))
    for df in (
        stats.line_counts(lines),
        dedup.key_counts(documents, "source"),
        dedup.dedup_keep_first(documents, ["source"], ["doc_id"]),
        search.token_doc_freq(documents, "text"),
    ):
        assert "partial_" in plan(df)


def test_match_reads_two_columns(spark):
    text = plan(search.match_search(read(spark, "documents"), "doc_id", "text", "the", 5))
    assert "lang" not in text
    assert "TakeOrderedAndProject" in text


def test_a_deep_page_brings_no_skipped_row_together(spark):
    orders = read(spark, "orders").select("o_orderkey")
    text = plan(paging.page_at(orders, "o_orderkey", 1200, 40))
    assert "TakeOrderedAndProject(limit=40" in text and "Exchange" not in text
    assert "GreaterThanOrEqual(o_orderkey" in text and "LessThanOrEqual(o_orderkey" in text
