"""Token ids, block files and packing: exact round trips."""

from __future__ import annotations

import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from recordhaul.llm.packing import Example, Packer, pack_documents
from recordhaul.llm.queries import QUERIES
from recordhaul.llm.token_files import decode_blocks, encode_blocks, read_token_files, write_token_files
from recordhaul.llm.tokens import BYTE_BPE, WORD_BPE, encoder
from recordhaul.session import new_folder
from tests.llm.cases import ROWS, clashing, documents, texts

ODD = [
    "", "a", "  a b", "a  b\n\nc \n d ", "x\ty", "don't stop it's. we'll", "Éa ÉÉ, a²b x1y2 3.4", "a b",
    "tail \n", "\n", "é́ x", "ǅ Σ ΑΣ ß", "a.b,c|d | e", "日本語 テキスト。", "a\x1cb \x1c c", "K ſ K",
]


@pytest.mark.parametrize("name", [BYTE_BPE, WORD_BPE])
def test_ids_equal_the_whole_text(name):
    plain = Tokenizer.from_file(public_tokenizers.path(name))
    values = [*ODD, *(r[1] or "" for r in ROWS)]
    found = list(encoder(name).encode(pa.array([*values, None])))
    assert [x.tolist() for x in found[:-1]] == [plain.encode(v, add_special_tokens=False).ids for v in values]
    assert len(found[-1]) == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from(" \n\t.,'%#aZéß1|-日"), max_size=30), min_size=1, max_size=5))
def test_ids_of_any_text(values):
    values = [*values, *(f"{v}<|endoftext|>{v} <|startoftext|> {v}" for v in values[:1])]
    for name in (BYTE_BPE, WORD_BPE):
        plain = Tokenizer.from_file(public_tokenizers.path(name))
        found = [x.tolist() for x in encoder(name).encode(pa.array(values))]
        assert found == [plain.encode(v, add_special_tokens=False).ids for v in values]


@pytest.mark.parametrize("name", [BYTE_BPE, WORD_BPE])
def test_special_tokens_as_plain_text(name):
    plain = Tokenizer.from_file(public_tokenizers.path(name))
    plain.encode_special_tokens = True
    found = [x.tolist() for x in encoder(name, plain=True).encode(pa.array(ODD))]
    assert found == [plain.encode(v, add_special_tokens=False).ids for v in ODD]


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(0, 2**32 - 1) | st.integers(0, 60_000), max_size=700))
def test_blocks_round_trip(values):
    ids = np.array(values, np.uint32)
    data = encode_blocks(ids)
    assert decode_blocks(data).tolist() == values
    assert decode_blocks(data, 1, 2).tolist() == values[128:256]


def _ids(name, text, end):
    plain = Tokenizer.from_file(public_tokenizers.path(name))
    return [*plain.encode(text, add_special_tokens=False).ids, end]


def test_files_give_back_every_document(spark):
    table = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    folder = new_folder(spark, "token-files")
    write_token_files(clashing(table), folder)
    found = {r["doc_id"]: r for r in read_token_files(spark, folder).collect()}
    start = 0
    for key, text in sorted(texts(table).items()):
        ids = _ids(BYTE_BPE, text, 0)
        row = found[key]
        assert (row["start"], row["n_tokens"]) == (start, len(ids))
        assert np.frombuffer(row["ids"], "<u4").tolist() == ids
        start += len(ids)


def test_files_take_awkward_rows(spark):
    folder = new_folder(spark, "token-files")
    write_token_files(documents(spark), folder)
    rows = sorted(read_token_files(spark, folder).collect(), key=lambda r: r["start"])
    assert [r["doc_id"] for r in rows] == [None, 1, 2, 3, 4, 5, 5, 6, 7, 8, 9]
    assert [r["n_tokens"] for r in rows if r["doc_id"] in (2, 3)] == [1, 1]
    empty = new_folder(spark, "token-files")
    write_token_files(documents(spark, []), empty)
    assert read_token_files(spark, empty).collect() == []


def _check_pieces(rows, expected, tokens, segments, loss):
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r["row"]].append(r)
        sequences[r["sequence_id"]].append(r)
    seen = []
    for own in pieces.values():
        own.sort(key=lambda r: r["start"])
        at = 0
        for r in own:
            assert r["start"] == at and r["length"] > 0
            at += r["length"]
        seen.append((own[0]["doc_id"], at))
    key = lambda x: (x[0] is None, x)
    assert sorted(seen, key=key) == sorted(((k, len(ids)) for k, ids in expected), key=key)
    padding = 0
    for own in sequences.values():
        own.sort(key=lambda r: r["offset"])
        at = 0
        for r in own:
            assert r["offset"] == at
            at += r["length"]
        assert at <= tokens and len(own) <= segments and sum(r["loss_tokens"] for r in own) <= loss
        padding += 0 if at & (at - 1) == 0 else tokens - at
    return padding


def test_packing_keeps_every_id(spark):
    table = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = pack_documents(clashing(table)).collect()
    expected = {k: _ids(WORD_BPE, t, 2) for k, t in texts(table).items()}
    assert _check_pieces(rows, expected.items(), 4096, 256, 4096) == 0
    for r in rows:
        ids = np.array(expected[r["doc_id"]][r["start"] : r["start"] + r["length"]], "<u4")
        assert r["ids_crc32"] == zlib.crc32(ids.tobytes()) and r["doc_tokens"] == len(expected[r["doc_id"]])


def test_packing_under_all_limits(spark):
    table = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").selectExpr("*", "doc_id % 90 AS prompt_tokens")
    rows = pack_documents(table, tokens=512, segments=3, loss_tokens=300).collect()
    expected = [(k, _ids(WORD_BPE, t, 2)) for k, t in texts(table).items()]
    _check_pieces(rows, expected, 512, 3, 300)


def test_packing_takes_awkward_rows(spark):
    rows = pack_documents(documents(spark)).collect()
    expected = [(r[0], _ids(WORD_BPE, r[1] or "", 2)) for r in ROWS]
    assert _check_pieces(rows, expected, 4096, 256, 4096) == 0
    assert pack_documents(documents(spark, [])).collect() == []
    with pytest.raises(ValueError):
        pack_documents(documents(spark), tokens=0)
    assert Packer(8, 1, 8, 0).rows == []


def test_equal_demands_are_picked_as_one():
    packer = Packer(4096, 256, 4096, 0)
    for n in range(100_000):
        packer.add(Example(n, n, np.array([2], np.uint32), 0))
    packer.pack(last=True)
    assert packer.picks <= 100_000 + 100_000 / 256 + 1
    assert len(packer.rows) == 100_000 and {r[5] for r in packer.rows} >= set(range(390))


def test_the_query_packs_under_limits_that_bind(spark):
    rows = QUERIES["op8_packing"](spark, "/root/testdata/sf0.001").collect()
    table = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    expected = {k: _ids(WORD_BPE, t, 2) for k, t in texts(table).items()}
    assert _check_pieces(rows, expected.items(), 4096, 64, 3200) == 0
    loss = defaultdict(int)
    for r in rows:
        loss[r["sequence_id"]] += r["loss_tokens"]
    assert 3200 in loss.values()
