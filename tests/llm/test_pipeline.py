"""The pipeline against brute force, stage by stage and as a whole; the native queries' plans and targets."""

from __future__ import annotations

import re
from collections import Counter, defaultdict

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline as P
from recordhaul.llm.mixing import displaced, mix
from recordhaul.llm.quality import quality_verdicts
from recordhaul.llm.queries import QUERIES
from recordhaul.session import stage
from tests.llm.test_dedup import _links, _shingles

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["op2_target_mixing", "op6_line_dedup"])
def test_native_queries_run_no_python(spark, name):
    plan = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|ArrowEval|MapInPandas|MapInArrow|CartesianProduct", plan)


def test_expected_tokens_meet_their_targets(spark):
    weights = {"good": 0.85, "poor": 0.10, "toxic": 0.05}
    rows = QUERIES["op2_target_mixing"](spark, "/root/testdata/sf0.01").collect()
    total = sum(r["n_tokens"] for r in rows)
    for domain, share in weights.items():
        expected = sum(r["rate"] * r["n_tokens"] * r[f"p_{domain}"] for r in rows)
        assert abs(expected / total - share) < 1e-3


def test_no_two_telling_words_meet():
    words = [(n * 7919 * 31 + n * n) % (1 << 18) for n in range(30_000)]
    shift, tags = displaced(words)
    assert all(tags[shift[w % len(shift)] + w // len(shift)] == w for w in words)
    assert len(tags) < 3 * len(set(words)) and displaced([])[1] == [-1] * 256


def _lines(docs):
    """Lines of 40 characters or more that five documents share stay in the last of them."""
    strip = lambda x: re.sub(r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$", "", x)
    key = lambda x: re.sub("[A-Z]", lambda m: m[0].lower(), strip(x))
    holders = defaultdict(set)
    for doc, text in docs.items():
        for line in text.split("\n"):
            holders[key(line)].add(doc)
    gone = lambda doc, k: len(k) >= 40 and len(holders[k]) >= 5 and doc != max(holders[k])
    return {d: "\n".join(x for x in t.split("\n") if not gone(d, key(x))) for d, t in docs.items()}


def test_pipeline_equals_brute_force(spark):
    table = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    held = {r["doc_id"]: r["text"] or "" for r in table.collect()}
    made, docs = {}, table
    for name, function in P.STAGES[:-1]:
        docs = stage(function(spark, docs, SF), "trial")
        made[name] = [(r["doc_id"], r["text"]) for r in docs.collect()]

    judged = {r["doc_id"]: r["kept"] for r in quality_verdicts(table, labels).collect()}
    good = {d: t for d, t in held.items() if judged[d]}
    assert dict(made["quality rules"]) == good and len(made["quality rules"]) == len(good)
    assert all(len(re.findall(r"[^\x20\x09-\x0D]+", t)) >= 50 for t in good.values())

    reduced = _lines(good)
    assert dict(made["line dedup"]) == reduced and len(made["line dedup"]) == len(reduced)

    component = _links({d: _shingles(t, 5) for d, t in reduced.items()}, 80)
    single = {d: t for d, t in reduced.items() if component[d] == d}
    assert dict(made["MinHash near-dedup"]) == single and len(made["MinHash near-dedup"]) == len(single)

    kept = spark.createDataFrame([(d, t) for d, t in single.items()], "doc_id long, text string")
    kept = table.drop("text").join(kept, "doc_id")
    toxic = F.col("p_toxic") > P.TOXIC
    bounds = (F.when(toxic, 0.0).otherwise(1.0), F.when(toxic, 1.0).otherwise(P.MOST))
    rows = mix(kept, labels, P.MIXTURE, P.ANCHOR, bounds, at_most=("toxic",)).collect()
    copies = {r["doc_id"]: r["copies"] for r in rows}
    assert Counter(d for d, _ in made["mixing to target weights"]) == Counter(copies)
    assert all(single[d] == t for d, t in made["mixing to target weights"])
    assert all(r["copies"] >= 1 or r["p_toxic"] > P.TOXIC for r in rows)

    plain = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    tokens = {d: len(plain.encode(single[d], add_special_tokens=False).ids) + 1 for d in copies}
    pieces = defaultdict(list)
    for r in P.run(spark, SF).collect():
        pieces[r["doc_id"], r["row"]].append((r["start"], r["length"], r["doc_tokens"]))
    found = Counter()
    for (doc, _), own in pieces.items():
        at = 0
        for start, length, whole in sorted(own):
            assert start == at and whole == tokens[doc]
            at += length
        assert at == tokens[doc]
        found[doc] += 1
    assert found == Counter(copies)
