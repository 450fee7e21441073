import math
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from recordhaul.operators import search

TEXTS = [
    "the cat sat on the mat",
    "a dog",
    "the the the cat",
    "",
    None,
    "数据导入 data import",
    "Cat! dog? CAT.",
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(
        [(n, text, n * 10.0 if n % 2 else None) for n, text in enumerate(TEXTS)],
        "id long, body string, price double",
    )


def brute(terms):
    words = [
        [w.strip("!?.").lower() for w in (text or "").split()] if n != 5
        else ["数", "据", "导", "入", "数据", "据导", "导入", "data", "import"]
        for n, text in enumerate(TEXTS)
    ]
    average = sum(map(len, words)) / len(words)
    scores = {}
    for term, weight in Counter(terms).items():
        df = sum(term in doc for doc in words)
        for n, doc in enumerate(words):
            tf = doc.count(term)
            if tf:
                idf = math.log(1 + (len(words) - df + 0.5) / (df + 0.5))
                gain = idf * tf / (tf + 1.2 * (0.25 + 0.75 * len(doc) / average))
                scores[n] = scores.get(n, 0) + weight * gain
    return {str(n): round(score, 6) for n, score in scores.items()}


def scores(frame):
    return {row["_id"]: row["score"] for row in frame.collect()}


@pytest.mark.parametrize("text", ["the cat", "cat cat dog", "数据", "nowhere", "dog nowhere"])
def test_match_against_brute_force(spark, docs, text):
    terms = ["数", "据", "数据"] if text == "数据" else text.split()
    expected = brute(terms)
    assert scores(search.match_search(docs, "id", "body", text)) == pytest.approx(expected)
    index = search.postings(docs, "id", "body")
    stats = search.index_stats(docs, index)
    assert scores(search.match_postings(index, stats, text)) == pytest.approx(expected)


def test_match_orders_by_score(docs):
    found = search.match_search(docs, "id", "body", "the cat", 2).collect()
    best = sorted(brute(["the", "cat"]).items(), key=lambda pair: -pair[1])[:2]
    assert [row["_id"] for row in found] == [key for key, _ in best]


def test_match_without_words(docs):
    assert search.match_search(docs, "id", "body", " .! ").count() == 0


def test_postings(docs):
    rows = search.postings(docs, "id", "body").filter("_id in ('0', '2', '6')").collect()
    found = {(row["_id"], row["token"]): (row["tf"], row["dl"]) for row in rows}
    assert found == {
        ("0", "the"): (2, 6), ("0", "cat"): (1, 6), ("0", "sat"): (1, 6), ("0", "on"): (1, 6),
        ("0", "mat"): (1, 6), ("2", "the"): (3, 4), ("2", "cat"): (1, 4),
        ("6", "cat"): (2, 3), ("6", "dog"): (1, 3),
    }


def test_doc_freq(docs):
    found = {row["token"]: row["df"] for row in search.token_doc_freq(docs, "body").collect()}
    assert (found["the"], found["cat"], found["dog"], found["数据"]) == (2, 3, 2, 1)


def test_stored_index_is_pruned_by_token(spark, docs, tmp_path):
    path = str(tmp_path / "index")
    search.write_index(search.postings(docs, "id", "body"), path)
    index = spark.read.parquet(path)
    stored = search.match_postings(index, search.index_stats(docs, index), "dog")
    assert set(scores(stored)) == {"1", "6"}
    plan = stored._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(token,dog)" in plan or "In(token, [dog])" in plan
    assert re.search(r"PartitionFilters: \[[^\]]*bucket", plan)


def test_ties_and_bucket_numbers_are_those_of_the_index(spark, tmp_path):
    docs = spark.createDataFrame([(n, "same words") for n in (100, 10, 9, 2)], "id int, body string")
    search.write_index(search.postings(docs, "id", "body"), str(tmp_path / "index"), buckets=3)
    index = spark.read.parquet(str(tmp_path / "index"))
    stored = search.match_postings(index, search.index_stats(docs, index), "words", 2).collect()
    direct = search.match_search(docs, "id", "body", "words", 2).collect()
    assert [row["_id"] for row in stored] == [row["_id"] for row in direct] == ["2", "9"]


def ids(frame):
    return sorted(row["id"] for row in frame.collect())


def test_range(docs):
    assert ids(search.range_search(docs, "id", "price")) == [1, 3, 5]
    assert ids(search.range_search(docs, "id", "price", gte=30.0)) == [3, 5]
    assert ids(search.range_search(docs, "id", "price", lte=30.0)) == [1, 3]
    assert ids(search.range_search(docs, "id", "price", 30.0, 30.0)) == [3]
    assert ids(search.range_search(docs, "id", "price", size=1)) == [1]


def test_term_and_pages(docs):
    assert ids(search.term_search(docs, "id", "price", 30.0)) == [3]
    assert ids(search.term_search(docs, "id", "body", "cat", text=True)) == [0, 2, 6]
    assert ids(search.term_search(docs, "id", "body", "cat", 2, text=True)) == [0, 2]
    assert ids(search.page_search(docs, "id", 5, 10)) == [5, 6]
    assert ids(search.page_search(docs, "id", 50, 10)) == []
    assert ids(search.search_all(docs, "id", 100)) == list(range(7))
    assert search.search_all(docs, "id", 3).filter(F.col("_id") != F.col("id").cast("string")).count() == 0
    assert search.doc_count(docs).first()["n"] == 7
