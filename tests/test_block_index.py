"""The index of blocks: layout by size and top hits by bounds."""

from __future__ import annotations

import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from recordhaul.operators import block_index as B
from recordhaul.operators import search

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def texts(spark):
    draw = random.Random(7)
    words = [f"word{n}" for n in range(300)]
    rows = []
    for n in range(1500):
        size = draw.choice([4, 9, 30, 120])
        picked = draw.choices(words, weights=[1 / (k + 1) for k in range(300)], k=size)
        rows.append((n, " ".join(["every", *picked, *(["rare"] * (n % 97 == 0))])))
    rows += [(9000, None), (9001, ""), (9002, "!!")]
    return spark.createDataFrame(rows, "doc_id long, text string").cache()


@pytest.fixture(scope="module")
def stored(spark, texts, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("index"))
    index = search.postings(texts, "doc_id", "text")
    stats = search.index_stats(texts, index)
    B.write_block_index(index, stats, path, part_bytes=8000, range_docs=50)
    return path, index, stats


def test_ranges_follow_length():
    assert B.assign_ranges({3: 10, 1: 5, 2: 4, 9: 30}, 10) == [(1, 0, 1), (2, 0, 1), (3, 1, 1), (9, 2, 3)]
    assert B.assign_ranges({1: 25, 2: 1}, 10) == [(1, 0, 3), (2, 3, 1)]
    assert B.assign_ranges({1: 1, 2: 25}, 10) == [(1, 0, 1), (2, 1, 3)]
    assert B.assign_ranges({}, 10) == []


def test_every_posting_is_in_one_block(spark, stored):
    path, index, _ = stored
    blocks = spark.read.parquet(f"{path}/blocks")
    held = blocks.select("token", F.inline("hits")).select("_id", "token", "tf", "dl")
    assert held.exceptAll(index.select("_id", "token", "tf", "dl")).isEmpty() and held.count() == index.count()
    documents = blocks.select("range", F.inline("hits")).groupBy("_id").agg(F.countDistinct("range").alias("n"))
    assert documents.filter("n > 1").isEmpty()
    assert blocks.agg(F.max("n")).first()[0] < 100


def test_parts_are_of_even_size_whatever_word_is_everywhere(spark, stored):
    path, _, _ = stored
    sizes = spark.read.parquet(f"{path}/blocks").groupBy("part").agg(F.sum("bytes").alias("b"))
    most, mean, parts = sizes.agg(F.max("b"), F.avg("b"), F.count("*")).first()
    assert parts > 20 and most <= 1.5 * mean
    word = spark.read.parquet(f"{path}/dictionary").filter("token = 'every'").first()
    assert word["df"] == 1500 and word["last_part"] > word["first_part"]
    assert all(len(list(p.glob("*.parquet"))) == 1 for p in Path(f"{path}/blocks").glob("part=*"))


def test_parts_in_slices(spark, stored, monkeypatch):
    path, _, _ = stored
    blocks = spark.read.parquet(f"{path}/blocks").drop("part")
    monkeypatch.setattr(B, "SLICE_BLOCKS", 100)
    dealt = B.deal_out(blocks, 8000)
    assert dealt.select("slice").distinct().count() > 5 and dealt.count() == blocks.count()
    sizes = dealt.join(blocks, ["token", "range"]).groupBy("part").agg(F.sum("bytes").alias("b"))
    most, fewest, parts, last = sizes.agg(F.max("b"), F.min("b"), F.count("*"), F.max("part")).first()
    assert most <= 8000 + 50 * 30 * 2 and parts == last + 1
    spread = dealt.groupBy("token").agg((F.max("part") - F.min("part") + 1 - F.countDistinct("part")).alias("gap"))
    assert spread.filter("gap <> 0").isEmpty()


@pytest.mark.parametrize("text", ["every word0 rare", "rare", "word1 word1 word250 nothing", "word0", "every", "no such words", "", "Every WORD3"])
@pytest.mark.parametrize("size", [3, 400])
def test_top_hits_equal_those_of_whole_lists(spark, stored, text, size):
    path, index, stats = stored
    whole = [tuple(r) for r in search.match_postings(index, stats, text, size).collect()] if text else []
    hits, figures = B.top_hits(spark, path, text, size, probed=3)
    assert [tuple(r) for r in hits.collect()] == whole
    assert figures["read"] <= figures["blocks"]


def test_few_hits_read_few_blocks(spark, stored):
    path, _, _ = stored
    figures = {text: B.top_hits(spark, path, text, 5, probed=3)[1] for text in ("every", "word2 rare", "word0 word5")}
    assert all(f["read"] < f["blocks"] for f in figures.values()), figures
    assert figures["every"]["read"] < figures["every"]["blocks"] / 2, figures


def test_heads_are_read_without_postings(spark, stored):
    path, _, _ = stored
    words = B._words(spark, path, ["word0", "every"], 0)
    bounds = B.range_bounds(B._blocks_of(spark, path, words), F.lit(1.0))
    plan = bounds._jdf.queryExecution().executedPlan().toString()
    assert "hits" not in plan and "PartitionFilters" in plan


def test_no_document_at_all(spark, tmp_path):
    none = spark.createDataFrame([], "doc_id long, text string")
    index = search.postings(none, "doc_id", "text")
    B.write_block_index(index, search.index_stats(none, index), str(tmp_path / "i"))
    assert B.top_hits(spark, str(tmp_path / "i"), "word", 5)[0].collect() == []


def test_blocks_get_their_parts_where_they_are(spark, stored, monkeypatch):
    path, index, stats = stored
    staged = []
    keep = B.stage
    monkeypatch.setattr(B, "stage", lambda df, label: staged.append(label) or keep(df, label))
    monkeypatch.setattr(B, "SLICE_BLOCKS", 100)
    B.write_block_index(index, stats, f"{path}-again", part_bytes=8000, range_docs=50)
    assert staged == ["blocks", "dealt"]  # postings are not written once more
    blocks = spark.read.parquet(f"{path}/blocks").drop("part")
    placed = keep(B.deal_out(blocks, 8000), "placed")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        parts = B.with_parts(blocks, placed, placed.first()["bits"])
        plan = parts._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" not in plan and placed.first()["bits"] > 2
    wanted = placed.select("token", "range", "part")
    found = parts.select("token", "range", "part")
    assert found.count() == wanted.count() and found.exceptAll(wanted).isEmpty()
    again = spark.read.parquet(f"{path}-again/blocks").select("token", "range", "part", "hits")
    hits = spark.read.parquet(f"{path}/blocks").select("token", "range", "hits")
    assert again.exceptAll(hits.join(wanted, ["token", "range"]).select(*again.columns)).isEmpty()
