"""The registered queries of the package and the pipeline."""

from __future__ import annotations

import re

import numpy as np
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from recordhaul.session import stage
from tests.compare import connect, mismatch
from tests.llm.cases import LABELS, documents

SF = "/root/testdata/sf0.001"


def test_one_query_for_each_operator():
    numbers = sorted(int(m[1]) for n in entry.queries() if (m := re.match(r"op(\d+)_", n)))
    assert numbers == list(range(1, 14)) and "pipeline" in entry.queries()


@pytest.mark.parametrize("name", ["op6_line_dedup", "op13_prefix_trie"])
def test_query_equals_its_sql(spark, name):
    assert mismatch(entry.queries()[name](spark, SF), connect(SF), entry.oracle_sql()[name]) is None


def test_pipeline_stages_keep_clean_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet").where("quality = 1 AND toxic = 0")
    for name, function in corpus_pipeline.STAGES[:-1]:
        made = stage(function(spark, docs, SF), "trial")
        assert made.columns == docs.columns, name
        gone = docs.join(made, "doc_id", "left_anti").join(labels, "doc_id")
        if name in ("line dedup", "mixing to target weights"):
            assert gone.count() == 0
        docs = made
    pieces = corpus_pipeline.packing(spark, docs, SF)
    assert {r[0] for r in pieces.select("doc_id").distinct().collect()} == {
        r[0] for r in docs.select("doc_id").distinct().collect()
    }


def test_stages_take_awkward_rows(spark, tmp_path):
    for name, rows in (("labels", [(1, 1, 0), (9, 0, 1)]), ("none", [])):
        folder = tmp_path / name
        spark.createDataFrame(rows, LABELS).write.parquet(str(folder / "labels.parquet"))
        for table in (documents(spark), documents(spark, [])):
            docs = table.selectExpr("*", "1 AS _row", "3 AS _id", "2 AS node")
            for _, function in corpus_pipeline.STAGES:
                docs = stage(function(spark, docs, str(folder)), "trial")


@pytest.mark.parametrize("percent", [2, 30])
def test_mixing_stage_meets_its_shares_whatever_is_toxic(spark, tmp_path, percent):
    random = np.random.default_rng(percent)
    rows, labels, toxic = [], [], set()
    for n in range(2000):
        words = [f"w{x}" for x in random.integers(0, 400, 100)]
        if n % 100 < percent:
            toxic.add(n)
            words[:3] = random.choice(["awful", "rotten", "vile", "nasty"], 3)
        rows.append((n, " ".join(words), "en", "s", 0))
        if n // 100 % 2:
            labels.append((n, 1, int(n in toxic)))
    spark.createDataFrame(labels, LABELS).write.parquet(str(tmp_path / "labels.parquet"))
    mixed = [r["doc_id"] for r in corpus_pipeline.target_mixing(spark, documents(spark, rows), str(tmp_path)).collect()]
    clean = set(range(2000)) - toxic
    share = sum(n in toxic for n in mixed) / len(mixed)
    assert clean <= set(mixed)
    assert share < 0.06 and (percent == 2 or share > 0.02)
    assert sum(n in toxic for n in mixed) <= len(toxic)
    assert 1.15 < sum(n in clean for n in mixed) / len(clean) < 1.35
