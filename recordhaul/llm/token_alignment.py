"""Alignment of two tokenizers over one text, by the byte offsets at which tokens end.

The offsets at which tokens of both end cut the tokens into groups. They are found by galloping: each end of the
shorter list goes into the longer one in steps that double until they are past it, and by binary search
from there. The ranks found that way are all that is needed: common ends slice the groups, and the difference of
the ranks of a token's two ends is the range of tokens of the other side that it overlaps.

Texts are tokenised and aligned once, in blocks of bounded size. A block is a row with its documents, the distinct
id pairs that it links and how often, and the pair of each link. Only a block's distinct pairs are shuffled, to be
counted over the corpus and to meet their counts; the counts of a block's pairs then go back to it. So the pairs
that nearly every text holds cost one row a block.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordhaul.llm.tokens import BYTE_BPE, ChunkEncoder, byte_letters, tokenizer_path
from recordhaul.session import stage

PIECE_BPE = "piece_bpe_32k.model"
#: UTF-8 bytes of a block, unless one text is longer.
BLOCK_BYTES = 2 << 20
#: Chunks that each of the two encoders remembers, as both lie in a worker's memory.
CHUNKS = 250_000
#: Of so many ends one is searched in the whole document, and the others near it.
STRIDE = 16
#: Ids of the second tokenizer are less than this.
B_IDS = 1 << 20

RESULT = (
    "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
)


class ByteTokens(ChunkEncoder):
    """Ids of a byte-level tokenizer for a space and the text, and the bytes of each id."""

    lead = " "
    remembered = CHUNKS

    def __init__(self, path: str):
        super().__init__(path, plain=True)
        byte_of = {c: b for b, c in byte_letters().items()}
        entries = self._tokenizer.get_vocab()
        self.bytes = [b""] * (max(entries.values()) + 1)
        for entry, n in entries.items():
            # Special tokens have no bytes; they are never met.
            self.bytes[n] = bytes(byte_of.get(c, 0) for c in entry)


class PieceTokens(ChunkEncoder):
    """Ids of a sentencepiece model, which adds the space itself, and the bytes of each id.

    If no piece has a space behind another character, none reaches over a single one, and texts are cut
    there; line feeds are cut off where no piece holds one. Otherwise texts are encoded whole.
    """

    lead = " "
    remembered = CHUNKS

    def __init__(self, path: str):
        import sentencepiece

        self._model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [self._model.id_to_piece(n) for n in range(self._model.get_piece_size())]
        self.bytes = [self._bytes(n, piece) for n, piece in enumerate(pieces)]
        cuttable = not any("▁" in p.lstrip("▁") or "\n" in p for p in pieces)
        self._irregular = self._irregular_of([] if cuttable else ["."])
        self._space = self._model.piece_to_id("▁")
        self._forget()

    def _bytes(self, n: int, piece: str) -> bytes:
        if self._model.is_byte(n):
            return bytes([int(piece[3:5], 16)])
        if self._model.is_control(n) or self._model.is_unknown(n):
            return b""
        return piece.replace("▁", " ").encode()

    def whole(self, text: str) -> list[int]:
        """The ids of a text that begins with the space that the model adds."""
        return self._model.encode(text[1:])

    def _chunks(self, chunks: list[str]) -> list[list[int]]:
        # One call for all; the model adds the space of those that begin with one.
        ids = self._model.encode([c[1:] if c[0] == " " else c for c in chunks], num_threads=1)
        for n, chunk in enumerate(chunks):
            if chunk[0] != " ":
                if ids[n][:1] != [self._space]:
                    raise ValueError("the model joins its leading space to a line feed")
                ids[n] = ids[n][1:]
        return ids


_encoders: dict[tuple[type, str], ByteTokens | PieceTokens] = {}


def _encoder(kind: type, name: str) -> ByteTokens | PieceTokens:
    key = kind, tokenizer_path(name)
    if key not in _encoders:
        _encoders[key] = kind(key[1])
    return _encoders[key]


def gallop(short: np.ndarray, long: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """For each of ``short``: the first place in ``long[begin:end]``, which is sorted, of a value not below it.

    All go at once: a step of twice the size for those whose step is still below them, and then a binary search
    between the last step that was below and the one that was not. A value above all gives ``end``.
    """
    low, high = begin - 1, end.copy()
    active = np.arange(len(short))
    step = 1
    while len(active):
        at = low[active] + step
        inside = at < end[active]
        active, at = active[inside], at[inside]
        below = long[at] < short[active]
        high[active[~below]] = at[~below]
        active = active[below]
        low[active] = at[below]
        step *= 2
    # ``low`` is below, ``high`` is not.
    active = np.flatnonzero(high - low > 1)
    while len(active):
        middle = (low[active] + high[active]) >> 1
        below = long[middle] < short[active]
        low[active[below]] = middle[below]
        high[active[~below]] = middle[~below]
        active = active[high[active] - low[active] > 1]
    return high


def overlaps(short: np.ndarray, long: np.ndarray, bounds: np.ndarray, of: np.ndarray) -> tuple[np.ndarray, ...]:
    """First and last token of the longer list that each of the shorter overlaps, and whether they end together.

    ``bounds`` are the documents' places in ``long``, ``of`` each short token's document; both lists end a document
    at the same offset.
    """
    # Every STRIDE-th goes first; the others lie between the places of those around them.
    marked = of[::STRIDE]
    marks = gallop(short[::STRIDE], long, bounds[marked], bounds[marked + 1])
    begin = np.maximum(bounds[of], np.repeat(marks, STRIDE)[: len(of)])
    end = np.minimum(bounds[of + 1], np.repeat(np.append(marks[1:], len(long)), STRIDE)[: len(of)])
    last = gallop(short, long, begin, end)
    common = long[last] == short
    first = np.empty_like(last)
    first[:1] = 0
    # Behind the token in which the one before ends, if both end there.
    first[1:] = last[:-1] + common[:-1]
    return first, last, common


class _Dictionary:
    """Decimal ids with every mark that can follow one, to be joined by taking them in order."""

    def __init__(self, size_a: int, size_b: int):
        ids = [*(f"{n}," for n in range(size_a)), *(f"{n}|" for n in range(size_a))]
        for mark in (",", ";", ""):
            ids += [f"{n}{mark}" for n in range(size_b)]
        self.size_a, self.size_b = size_a, size_b
        self.values = pa.array(ids, pa.large_string())

    def digests(self, a: np.ndarray, b: np.ndarray, ends_a: np.ndarray, ends_b: np.ndarray, group_a: np.ndarray, group_b: np.ndarray, doc_a: np.ndarray, doc_b: np.ndarray, count: int) -> list[str]:
        """SHA-256 of the groups of each document that has tokens."""
        code_a = a + self.size_a * ends_a
        last_b = np.append(doc_b[1:] != doc_b[:-1], True)
        code_b = 2 * self.size_a + b + self.size_b * (ends_b.astype(np.int64) + (ends_b & last_b))
        # Tokens of A come before those of B in each group.
        order = np.argsort(np.concatenate([group_a * 2, group_b * 2 + 1]), kind="stable")
        joined = self.values.take(pa.array(np.concatenate([code_a, code_b])[order]))
        offsets = np.frombuffer(joined.buffers()[1], np.int64)[: len(joined) + 1]
        sizes = np.bincount(doc_a, minlength=count) + np.bincount(doc_b, minlength=count)
        at = offsets[np.concatenate([[0], np.cumsum(sizes)])].tolist()
        data = memoryview(joined.buffers()[2])
        return [hashlib.sha256(data[x:y]).hexdigest() if y > x else "" for x, y in zip(at, at[1:], strict=False)]


_dictionaries: dict[tuple[int, int], _Dictionary] = {}


def _flat(parts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    counts = np.array([len(p) for p in parts], np.int64)
    return np.concatenate([np.zeros(0, np.int64), *parts]).astype(np.int64), counts


def _same_bytes(tokens: ByteTokens | PieceTokens, ids: np.ndarray, counts: np.ndarray, led: list[bytes]) -> np.ndarray:
    """Whether the bytes of each document's tokens are its text behind a space."""
    joined = pa.array(tokens.bytes, pa.large_binary()).take(pa.array(ids))
    offsets = np.frombuffer(joined.buffers()[1], np.int64)[: len(joined) + 1]
    data = memoryview(joined.buffers()[2] or b"").cast("B")  # bytes are compared unsigned
    at = offsets[np.concatenate([[0], np.cumsum(counts)])].tolist()
    return np.array([data[x:y] == text for x, y, text in zip(at, at[1:], led, strict=False)], bool)


def _planes(values: np.ndarray) -> bytes:
    """Numbers as planes of their bytes, compressed."""
    planes = values.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()
    return pa.compress(planes, "zstd", asbytes=True)


def _from_planes(data: bytes, count: int) -> np.ndarray:
    planes = pa.decompress(data, 4 * count, "zstd", asbytes=True) if count else b""
    return np.frombuffer(np.frombuffer(planes, np.uint8).reshape(4, -1).T.tobytes(), "<u4").astype(np.int64)


def align_block(doc_ids: pa.Array, texts: pa.Array, a: ByteTokens, b: PieceTokens) -> dict[str, object]:
    """A block's row: its documents, its distinct linked pairs with their number, and the pair of each link."""
    count = len(texts)
    texts = pc.fill_null(texts.cast(pa.string()), "")
    led = [b" " + t for t in texts.cast(pa.binary()).to_pylist()]
    (ids_a, n_a), (ids_b, n_b) = (_flat(list(t.encode(texts))) for t in (a, b))
    whole = np.array([len(t) > 1 for t in led], bool)
    whole &= _same_bytes(a, ids_a, n_a, led) & _same_bytes(b, ids_b, n_b, led)
    documents = np.arange(count)
    ids_a, ids_b = ids_a[np.repeat(whole, n_a)], ids_b[np.repeat(whole, n_b)]
    n_a, n_b = n_a * whole, n_b * whole
    doc_a, doc_b = np.repeat(documents, n_a), np.repeat(documents, n_b)
    sizes_a, sizes_b = (np.array([len(x) for x in t.bytes], np.int64) for t in (a, b))
    ends_a, ends_b = np.cumsum(sizes_a[ids_a]), np.cumsum(sizes_b[ids_b])
    turned = len(ids_a) > len(ids_b)
    short, long, n_long, of = (ends_b, ends_a, n_a, doc_b) if turned else (ends_a, ends_b, n_b, doc_a)
    first, last, common = overlaps(short, long, np.concatenate([[0], np.cumsum(n_long)]), of)
    # Groups are numbered over the block; a group ends where both sides do.
    group_short = np.cumsum(common) - common
    ends_long = np.zeros(len(long), bool)
    ends_long[last[common]] = True
    group_long = np.cumsum(ends_long) - ends_long
    width = last - first + 1
    links = int(width.sum())
    owner = np.repeat(np.arange(len(short)), width)
    other = np.arange(links) - np.repeat(np.cumsum(width) - width - first, width)
    link_a, link_b = (other, owner) if turned else (owner, other)
    pairs, which, times = np.unique(ids_a[link_a] * B_IDS + ids_b[link_b], return_inverse=True, return_counts=True)
    # Frequent pairs get small numbers.
    order = np.argsort(-times, kind="stable")
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    group_a, group_b = (group_long, group_short) if turned else (group_short, group_long)
    last_a, last_b = (ends_long, common) if turned else (common, ends_long)
    key = len(a.bytes), len(b.bytes)
    if key not in _dictionaries:
        _dictionaries[key] = _Dictionary(*key)
    digests = _dictionaries[key].digests(ids_a, ids_b, last_a, last_b, group_a, group_b, doc_a, doc_b, count)
    table = pa.table({
        "doc_id": doc_ids, "n_a": n_a, "n_b": n_b,
        "n_groups": np.bincount(of[common], minlength=count),
        "n_links": np.bincount(of[owner], minlength=count), "groups_sha256": digests,
    })
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema) as writer:
        writer.write_table(table)
    return {
        "documents": sink.getvalue().to_pybytes(),
        "pairs": pairs[order].astype("<i8").tobytes(),
        "times": times[order].astype("<i8").tobytes(),
        "links": _planes(rank[which.reshape(-1)]),
    }


_BLOCK = "block string, documents binary, pairs binary, times binary, links binary"


def aligned_blocks(documents: DataFrame, byte_tokens: str, piece_tokens: str) -> DataFrame:
    """Blocks of documents that lie together; a block's name is that of its task and its number there."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        a, b = _encoder(ByteTokens, byte_tokens), _encoder(PieceTokens, piece_tokens)
        task, number = TaskContext.get().partitionId(), 0
        names = [part.split()[0] for part in _BLOCK.split(", ")]
        for batch in batches:
            sizes = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False)
            cuts = np.flatnonzero(np.diff(np.cumsum(sizes) // BLOCK_BYTES)) + 1
            for begin, end in zip([0, *cuts.tolist()], [*cuts.tolist(), len(batch)], strict=True):
                if begin == end:
                    continue
                part = batch.slice(begin, end - begin)
                row = align_block(part.column("doc_id"), part.column("text"), a, b)
                row["block"] = f"{task}-{number}"
                number += 1
                yield pa.RecordBatch.from_arrays([pa.array([row[n]]) for n in names], names=names)

    source = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return source.mapInArrow(make, _BLOCK)


def _pair_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for block, pairs, times in zip(*(batch.column(n) for n in ("block", "pairs", "times")), strict=True):
            made = [np.frombuffer(x.as_py(), "<i8") for x in (pairs, times)]
            blocks = pa.array([block.as_py()]).take(pa.array(np.zeros(len(made[0]), np.int64)))
            at = np.arange(len(made[0]), dtype=np.int32)
            yield pa.RecordBatch.from_arrays([blocks, *map(pa.array, (at, *made))], names=["block", "at", "pair", "times"])


def _finish(key: tuple, blocks: pd.DataFrame, counts: pd.DataFrame) -> pd.DataFrame:
    """The documents of a block, with what its links count."""
    names = [part.split()[0] for part in RESULT.split(", ")]
    out = []
    for row in blocks.itertuples():
        table = pa.ipc.open_stream(row.documents).read_all()
        count = np.zeros(len(row.pairs) // 8, np.int64)
        best = np.zeros(len(count), np.int64)
        count[counts["at"].to_numpy()] = counts["n"].to_numpy()
        best[counts["at"].to_numpy()] = counts["best"].to_numpy()
        n_links = table.column("n_links").to_numpy()
        links = _from_planes(row.links, int(n_links.sum()))
        at = np.concatenate([[0], np.cumsum(n_links)])
        sums = [np.concatenate([[0], np.cumsum(x[links])])[at] for x in (best, count)]
        for name, total in zip(("n_best", "count_sum"), sums, strict=True):
            table = table.append_column(name, pa.array(np.diff(total)))
        frame = table.select(names).to_pandas()
        frame["doc_id"] = frame["doc_id"].astype("Int64")
        out.append(frame)
    return pd.concat(out) if out else pd.DataFrame(columns=names)


def align(documents: DataFrame, byte_tokens: str = BYTE_BPE, piece_tokens: str = PIECE_BPE) -> DataFrame:
    """Groups and links of every row's tokens, and how frequent its links are over all rows.

    ``n_best`` counts the links whose pair is the most frequent of its B id, ties included; ``count_sum`` adds up
    the counts of all links' pairs; ``groups_sha256`` is the digest of the ids, by group. Null and empty texts,
    and texts that the tokens of either side do not give back byte for byte, have no tokens: zeros and ``''``.
    Repeated rows count as often as they occur. A very long text is a block of its own. An empty table
    gives no rows; other columns are not looked at.
    """
    blocks = stage(aligned_blocks(documents, byte_tokens, piece_tokens), "aligned-blocks")
    pairs = blocks.select("block", "pairs", "times").mapInArrow(_pair_rows, "block string, at int, pair long, times long")
    totals = stage(pairs.groupBy("pair").agg(F.sum("times").alias("n")), "pair-counts")
    b_id = F.pmod("pair", F.lit(B_IDS)).alias("b")
    tops = totals.groupBy(b_id).agg(F.max("n").alias("top"))  # one row an id of the vocabulary
    ranked = totals.withColumn("b", b_id).join(F.broadcast(tops), "b")
    ranked = ranked.select("pair", "n", (F.col("n") == F.col("top")).cast("int").alias("best"))
    met = pairs.join(ranked, "pair").select("block", "at", "n", "best")
    parts = blocks.select("block", "documents", "pairs", "links").groupBy("block")
    return parts.cogroup(met.groupBy("block")).applyInPandas(_finish, RESULT)
