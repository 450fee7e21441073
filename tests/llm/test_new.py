"""Quality classifier, tokenizer alignment and prefix trie against brute force."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

import __spark_entry__ as entry
from recordhaul.llm import nb_svm, prefix_trie, token_alignment
from recordhaul.llm.nb_svm import classify, descend, features, sigmoid
from recordhaul.llm.prefix_trie import Minima, prefix_nodes, rebuild, turn_lists
from recordhaul.llm.queries import QUERIES
from recordhaul.llm.token_alignment import ByteTokens, PieceTokens, _encoder, align, gallop
from recordhaul.llm.tokens import BYTE_BPE
from tests.compare import connect, mismatch
from tests.llm.cases import LABELS, ROWS, clashing, documents
from tests.llm.test_tokens import ODD

SF = "/root/testdata/sf0.001"


# Quality classifier


def _held(key):
    return zlib.crc32(str(key).encode()) % 5 == 0


def test_features_are_distinct_grams_of_each_text():
    values = ["The cat the cat. The", None, "", "ab", "The cat the cat. The", "x" * 3000, "é!! é!!"]
    alone = [[part[a:b].tolist() for part, bounds in features(pa.array([v], pa.string())) for a, b in zip(bounds, bounds[1:], strict=False)][0] for v in values]
    together = [part[a:b].tolist() for part, bounds in features(pa.array(values)) for a, b in zip(bounds, bounds[1:], strict=False)]
    assert together == alone and alone[0] == alone[4] and alone[1] == alone[2] == []
    assert all(x == sorted(set(x)) for x in alone)
    # Without a trigram: a word and its shape.
    assert len(alone[3]) == 2
    words, trigrams = ["the", "cat", "the", "cat.", "the"], {"The cat the cat. The"[n : n + 3] for n in range(18)}
    assert len(alone[0]) >= len(trigrams) + len(set(words)) + len(set(zip(words, words[1:], strict=False)))


def test_dual_descent_reaches_the_least_hinge_loss():
    random = np.random.default_rng(5)
    rows, signs = [], []
    for n in range(120):
        at = np.sort(random.choice(30, 6, replace=False))
        values = random.normal(size=6)
        rows.append((at, values / np.linalg.norm(values)))
        signs.append(1.0 if values[0] + random.normal() * 0.3 > 0 else -1.0)
    signs, costs = np.array(signs), np.ones(120)
    weights, bias = descend(rows, signs, costs)

    def loss(w, b):
        slack = [max(0, 1 - y * (w[at] @ v + b)) for (at, v), y in zip(rows, signs, strict=True)]
        return (w @ w + b * b) / 2 + sum(slack)

    least = loss(weights, bias)
    for _ in range(300):
        moved = weights.copy()
        moved[:30] += random.normal(size=30) * random.choice([1e-3, 1e-2, 0.1])
        assert loss(moved, bias + random.normal() * 1e-2) >= least * 0.999


def test_sigmoid_fits_chances():
    random = np.random.default_rng(6)
    margins = random.normal(size=20_000) * 2
    labels = (random.random(20_000) < 1 / (1 + np.exp(-(1.5 * margins - 0.5)))).astype(int)
    slope, level = sigmoid(margins, labels)
    assert abs(slope - 1.5) < 0.1 and abs(level + 0.5) < 0.1


def test_classifier_on_rows_held_out(spark):
    folder = "/root/testdata/sf0.01"
    rows = {r["doc_id"]: r for r in QUERIES["op11_quality_classifier"](spark, folder).collect()}
    labels = spark.read.parquet(f"{folder}/labels.parquet").where("quality IS NOT NULL").collect()
    assert len(rows) == spark.read.parquet(f"{folder}/documents.parquet").count()
    for key, r in rows.items():
        assert r["held_out"] == _held(key) and 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3)
    held = [(rows[x["doc_id"]], x["quality"]) for x in labels if _held(x["doc_id"])]
    assert len(held) > 50
    assert np.mean([r["predicted"] for r, q in held if q == 1]) > 0.95
    assert np.mean([r["predicted"] for r, q in held if q == 0]) < 0.25


def test_labels_of_held_out_rows_change_nothing(spark):
    table = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    turned = labels.selectExpr("doc_id", "CASE WHEN crc32(CAST(doc_id AS STRING)) % 5 = 0 THEN 1 - quality ELSE quality END AS quality", "toxic")
    one, other = (sorted(map(tuple, classify(table, x).collect())) for x in (labels, turned))
    assert one == other


def test_classifier_takes_awkward_rows(spark):
    labels = spark.createDataFrame([(1, 1, 0), (9, 0, 0), (9, None, 1), (None, 1, 0), (8, 0, 0), (6, 1, 1)], LABELS)
    rows = classify(clashing(documents(spark)), clashing(labels)).collect()
    assert len(rows) == 11 and all(0 <= r["score"] <= 1 for r in rows)
    assert [r["held_out"] for r in rows if r["doc_id"] is None] == [True]
    assert len({r["score"] for r in rows if r["doc_id"] in (2, 3)}) == 1
    none = classify(documents(spark), spark.createDataFrame([], LABELS)).collect()
    assert {r["score"] for r in none} == {0.5}
    single = classify(documents(spark), spark.createDataFrame([(n, 1, 0) for n in range(9)], LABELS)).collect()
    assert all(r["score"] > 0.5 for r in single)
    assert classify(documents(spark, []), labels).collect() == []
    assert nb_svm.MAX_ROWS == 8_000


# Cross-tokenizer alignment


def _byte_letters():
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(256) if b not in plain]
    return {**{chr(b): b for b in plain}, **{chr(256 + n): b for n, b in enumerate(other)}}


@pytest.fixture(scope="module")
def libraries():
    a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    return a, SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model")), _byte_letters()


def _tokens(text, libraries):
    a, b, letters = libraries
    ids_a = a.encode(" " + text, add_special_tokens=False).ids
    ids_b = b.encode(text)
    bytes_a = [bytes(letters[c] for c in a.id_to_token(n)) for n in ids_a]
    bytes_b = [bytes([int(p[3:5], 16)]) if re.fullmatch("<0x[0-9A-F]{2}>", p) else p.replace("▁", " ").encode() for p in map(b.id_to_piece, ids_b)]
    whole = (" " + text).encode()
    if not text or b"".join(bytes_a) != whole or b"".join(bytes_b) != whole:
        return [], []
    return list(zip(ids_a, map(len, bytes_a), strict=True)), list(zip(ids_b, map(len, bytes_b), strict=True))


def _brute(rows, libraries):
    made, count = [], Counter()
    for key, text in rows:
        sides = []
        for tokens in _tokens(text or "", libraries):
            at, out = 0, []
            for n, size in tokens:
                out.append((n, at, at + size))
                at += size
            sides.append(out)
        a, b = sides
        links = [(x[0], y[0]) for x in a for y in b if x[1] < y[2] and y[1] < x[2]]
        ends = sorted({x[2] for x in a} & {y[2] for y in b})
        groups = [
            ",".join(str(x[0]) for x in a if lo < x[2] <= hi) + "|" + ",".join(str(y[0]) for y in b if lo < y[2] <= hi)
            for lo, hi in zip([0, *ends], ends, strict=False)
        ]
        count.update(links)
        made.append((key, len(a), len(b), len(groups), links, hashlib.sha256(";".join(groups).encode()).hexdigest() if a else ""))
    top = defaultdict(int)
    for (_, b), n in count.items():
        top[b] = max(top[b], n)
    return [(*r[:4], len(r[4]), sum(count[x] == top[x[1]] for x in r[4]), sum(count[x] for x in r[4]), r[5]) for r in made]


def _aligned(rows):
    return sorted((tuple(r) for r in rows), key=lambda r: (r[0] is None, r))


SPECIAL = ["<|endoftext|> x", "<s> a </s>", "a▁b", "x  y", "tab\there", "line\nfeed\n\nx", "ﬁ é́", "<0x41>", "a\rb"]


def test_alignment_equals_brute_force(spark, libraries):
    table = spark.read.parquet(f"{SF}/documents.parquet").where("length(text) < 1500")
    extra = [(10_000 + n, x, "en", "s", 0) for n, x in enumerate([*ODD, *SPECIAL])]
    table = table.unionByName(documents(spark, extra))
    rows = [(r["doc_id"], r["text"]) for r in table.collect()]
    assert _aligned(align(table).collect()) == _aligned(_brute(rows, libraries))


def test_alignment_over_many_blocks(spark, libraries, monkeypatch):
    table = spark.read.parquet(f"{SF}/documents.parquet").where("length(text) < 600").repartition(3)
    whole = _aligned(align(table).collect())
    monkeypatch.setattr(token_alignment, "BLOCK_BYTES", 500)
    assert _aligned(align(table).collect()) == whole


def test_alignment_takes_awkward_rows(spark, libraries):
    rows = align(clashing(documents(spark))).collect()
    found = defaultdict(list)
    for r in rows:
        found[r["doc_id"]].append(r)
    assert len(rows) == 11 and len(found[5]) == 2 and found[5][0] == found[5][1]
    for key in (2, 3):
        assert tuple(found[key][0])[1:] == (0,) * 6 + ("",)
    assert found[7][0]["n_a"] > 30_000 and found[None][0]["count_sum"] > 0
    assert align(documents(spark, [])).collect() == []
    short = [(r[0], r[1]) for r in ROWS if len(r[1] or "") < 2000 and r[0] is not None]
    assert _aligned(align(documents(spark, [(*r, "", "", 0) for r in short])).collect()) == _aligned(_brute(short, libraries))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from(" \n\t.,'aZé1|日▁<>"), max_size=30), min_size=1, max_size=5))
def test_ids_of_both_tokenizers(values):
    a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    b = SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    values = [*values, "x <|endoftext|>", "<s>"]
    found = [x.tolist() for x in _encoder(ByteTokens, BYTE_BPE).encode(pa.array(values))]
    assert found == [a.encode(" " + v, add_special_tokens=False).ids for v in values]
    found = [x.tolist() for x in _encoder(PieceTokens, token_alignment.PIECE_BPE).encode(pa.array(values))]
    assert found == [b.encode(v) for v in values]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 200), max_size=60), st.lists(st.integers(0, 200), max_size=60), st.integers(0, 60))
def test_gallop_is_a_search_from_the_left(short, long, cut):
    long = np.array(sorted(long), np.int64)
    short = np.array(sorted(short), np.int64)
    cut = min(cut, len(long))
    for begin, end in ((0, len(long)), (0, cut), (cut, len(long))):
        edges = (np.full(len(short), begin), np.full(len(short), end))
        assert gallop(short, long, *edges).tolist() == (begin + np.searchsorted(long[begin:end], short)).tolist()


# Conversation prefix trie


def _rebuilt(rows):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(v, key=lambda t: t[:2])] for c, v in own.items()}
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        out[c] = own.get(c - c % 20, [])[:h] + turns[h:]
    return out


def _trie(rows):
    rebuilt = _rebuilt(rows)
    members = defaultdict(list)
    for c, turns in rebuilt.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    children, leaves, saved = Counter(), Counter(), Counter()
    for node in members:
        if node:
            children[node[:-1]] += 1
    for node, own in members.items():
        words = len(re.findall(r"[^\x20\x09-\x0D]+", node[-1][1])) if node else 0
        for d in range(len(node) + 1):
            saved[node[:d]] += (len(own) - 1) * words
            leaves[node[:d]] += children[node] == 0
    out = []
    for node, own in members.items():
        ends = ",".join(str(c) for c in sorted(own) if len(rebuilt[c]) == len(node))
        out.append((
            min(own), len(node), min(members[node[:-1]]) if node else None, len(own), children[node], leaves[node],
            saved[node], hashlib.sha256(ends.encode()).hexdigest(),
        ))
    return sorted(out, key=str)


TURNS = "conv_id long, turn long, role string, text string"


def _nodes(table):
    return sorted((tuple(r) for r in prefix_nodes(rebuild(turn_lists(table))).collect()), key=str)


@pytest.mark.parametrize("window", [1, 7, 1 << 17])
def test_trie_equals_brute_force(spark, monkeypatch, window):
    table = spark.read.parquet(f"{SF}/conversations.parquet")
    monkeypatch.setattr(prefix_trie, "WINDOW", window)
    assert _nodes(table) == _trie([tuple(r) for r in table.select("conv_id", "turn", "role", "text").collect()])


@pytest.mark.parametrize("window", [1, 40, 1 << 17])
def test_trie_of_hot_turns_and_copies(spark, monkeypatch, window):
    rows = []
    for c in range(120):
        depth = (c * 7) % 9
        same = c % 3 == 0
        rows += [(c, t, "user" if t % 2 else "bot", "one two" if same or t < 2 else f"word {c % 5} {t}") for t in range(depth)]
    rows += [(300 + c, t, None, f"deep {t}") for c in range(3) for t in range(40)]
    monkeypatch.setattr(prefix_trie, "WINDOW", window)
    monkeypatch.setattr(prefix_trie, "CHUNK", 48)
    table = spark.createDataFrame(rows, TURNS)
    assert _nodes(table) == _trie(rows)


def test_trie_takes_awkward_rows(spark):
    rows = [
        (0, 1, "a", "x y"), (0, 0, "a", "x"), (0, None, None, None), (7, 0, "", ""), (7, 2, "b", None), (21, 0, "a", "x"),
        (21, 0, "a", "x"), (None, 0, "a", "x"), (40, 5, "u", "w " * 20_000), (45, 0, None, "z"),
    ]
    table = spark.createDataFrame(rows, TURNS).selectExpr("*", "1 AS depth", "2 AS turns", "3 AS a", "4 AS k1", "5 AS chunk")
    assert _nodes(table) == _trie(rows)
    assert _nodes(spark.createDataFrame([], TURNS)) == []
    only = [(c, 0, "a", "x") for c in range(1, 20)]
    assert _nodes(spark.createDataFrame(only, TURNS)) == _trie(only)


def test_trie_equals_its_sql(spark):
    name = "op13_prefix_trie"
    assert mismatch(QUERIES[name](spark, SF), connect(SF), entry.oracle_sql()[name]) is None


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 5), min_size=1, max_size=40), st.data())
def test_minima(values, data):
    values = np.array(values)
    table = Minima(values)
    first = data.draw(st.integers(0, len(values) - 1))
    last = data.draw(st.integers(first, len(values) - 1))
    depth = data.draw(st.integers(0, 6))
    one = lambda n: np.array([n])
    assert table.least(one(first), one(last))[0] == values[first : last + 1].min()
    right = first
    while right + 1 < len(values) and values[right + 1] >= depth:
        right += 1
    left = first
    while left > 0 and values[left] >= depth:
        left -= 1
    assert table.right(one(first), one(depth))[0] == right and table.left(one(first), one(depth))[0] == left




def test_pieces_of_a_batch_are_encoded_in_one_call():
    from recordhaul.llm.token_alignment import PIECE_BPE
    from recordhaul.llm.tokens import tokenizer_path

    tokens = PieceTokens(tokenizer_path(PIECE_BPE))
    model, calls = tokens._model, []

    class Counted:
        def encode(self, texts, **options):
            calls.append(texts)
            return model.encode(texts, **options)

    tokens._model = Counted()
    texts = ["one two three\nfour", "five six two"]
    found = [ids.tolist() for ids in tokens.encode(pa.array(texts))]
    assert found == [model.encode(text) for text in texts] and len(calls) == 1
