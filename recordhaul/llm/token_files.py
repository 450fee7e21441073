"""Token ids in compressed blocks: patched frame of reference.

The ids of a run of documents are cut into blocks of ``BLOCK``. A block stores its minimum and the
differences to it, packed at the width that ``PERCENT`` of them fit in; the high bits of the
others stand in an exception list. An index holds the start of every block, so any
block can be read without those before it.

The files are Parquet, one shard per range of ``doc_id`` and one row per chunk of whole documents, with
the blocks as a binary column. So Spark's committer handles lost tasks, any store will do, and a
chunk is read without its neighbours. Texts move once, into the order of ``doc_id``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from recordhaul.llm.tokens import BYTE_BPE, encoder

BLOCK = 128
PERCENT = 90
#: A chunk is closed once it holds so many ids.
CHUNK = 1 << 16

CHUNKS = (
    "shard long, chunk long, ids_before long, n_ids long, doc_ids array<long>, "
    "lengths array<long>, blocks binary"
)

#: Of the index: start of the packed block, its minimum, its width, and its number of exceptions.
_INDEX = np.dtype([("start", "<u4"), ("least", "<u4"), ("width", "u1"), ("patched", "u1")])
_PATCH = np.dtype([("place", "u1"), ("high", "<u4")])


def encode_blocks(ids: np.ndarray) -> bytes:
    """Number of ids and of exceptions, index, exceptions and packed blocks of up to 2**25 ids."""
    count = len(ids)
    blocks = -(-count // BLOCK)
    full = np.concatenate([ids, np.repeat(ids[-1:], blocks * BLOCK - count)]).reshape(-1, BLOCK)
    full = full.astype(np.uint32)
    least = full.min(axis=1) if blocks else np.empty(0, np.uint32)
    above = full - least[:, None]
    bits = np.frexp(above.astype(np.float64))[1]
    rank = min(BLOCK - 1, BLOCK * PERCENT // 100)
    width = np.partition(bits, rank, axis=1)[:, rank] if blocks else np.empty(0, int)
    odd = bits > width[:, None]
    index = np.zeros(blocks, _INDEX)
    index["least"], index["width"], index["patched"] = least, width, odd.sum(axis=1)
    sizes = width.astype(np.int64) * BLOCK // 8
    ends = np.cumsum(sizes)
    index["start"] = ends - sizes
    patches = np.zeros(int(odd.sum()), _PATCH)
    row, place = np.nonzero(odd)
    patches["place"], patches["high"] = place, above[row, place] >> width[row].astype(np.uint32)
    packed = np.zeros(int(ends[-1]) if blocks else 0, np.uint8)
    for w in np.unique(width[width > 0]).tolist():
        at = np.flatnonzero(width == w)
        planes = np.stack([(above[at] >> np.uint32(b)).astype(np.uint8) & 1 for b in range(w)], 2)
        rows = np.packbits(planes.reshape(len(at), -1), axis=1, bitorder="little")
        packed[index["start"][at].astype(np.int64)[:, None] + np.arange(rows.shape[1])] = rows
    head = np.array([count, len(patches)], "<u4")
    return b"".join(x.tobytes() for x in (head, index, patches, packed))


def _parts(data: bytes) -> tuple[int, np.ndarray, np.ndarray, np.ndarray]:
    count, patched = np.frombuffer(data, "<u4", 2).tolist()
    blocks = -(-count // BLOCK)
    at = 8
    index = np.frombuffer(data, _INDEX, blocks, at)
    at += index.nbytes
    patches = np.frombuffer(data, _PATCH, patched, at)
    return count, index, patches, np.frombuffer(data, np.uint8, offset=at + patches.nbytes)


def decode_blocks(data: bytes, first: int = 0, last: int | None = None) -> np.ndarray:
    """The ids of blocks ``first`` to ``last`` (exclusive; null: all)."""
    count, index, patches, packed = _parts(data)
    last = len(index) if last is None else min(last, len(index))
    first = min(first, last)
    before = np.concatenate([[0], np.cumsum(index["patched"], dtype=np.int64)])
    patches = patches[before[first] : before[last]]
    index = index[first:last]
    out = np.zeros((len(index), BLOCK), np.uint32)
    for w in np.unique(index["width"]).tolist():
        if not w:
            continue
        at = np.flatnonzero(index["width"] == w)
        starts = index["start"][at].astype(np.int64)
        rows = packed[starts[:, None] + np.arange(w * BLOCK // 8)]
        planes = np.unpackbits(rows, axis=1, bitorder="little").reshape(len(at), BLOCK, w)
        values = np.zeros((len(at), BLOCK), np.uint32)
        for b in range(w):
            values |= planes[:, :, b].astype(np.uint32) << np.uint32(b)
        out[at] = values
    row = np.repeat(np.arange(len(index)), index["patched"])
    out[row, patches["place"]] |= patches["high"] << index["width"][row].astype(np.uint32)
    ids = (out + index["least"][:, None]).reshape(-1)
    return ids[: max(0, count - first * BLOCK)]


def write_token_files(
    documents: DataFrame, folder: str, tokenizer: str = BYTE_BPE, end_id: int = 0
) -> None:
    """Encodes every text, with ``end_id`` behind it, in the order of ``doc_id``.

    Null and empty texts are one id. Rows that share a ``doc_id`` stand one behind the other, by
    a hash of their text; a null ``doc_id`` comes first. Other columns are not looked at.
    """

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = TaskContext.get().partitionId()
        tail = np.array([end_id], np.uint32)
        docs: list[int | None] = []
        parts: list[np.ndarray] = []
        lengths: list[int] = []
        chunk = before = held = 0

        def close() -> pa.RecordBatch:
            nonlocal chunk, before, held
            row = {
                "shard": shard, "chunk": chunk, "ids_before": before, "n_ids": held,
                "doc_ids": list(docs), "lengths": list(lengths),
                "blocks": encode_blocks(np.concatenate(parts)),
            }
            chunk, before, held = chunk + 1, before + held, 0
            for x in (docs, parts, lengths):
                x.clear()
            return pa.RecordBatch.from_pylist([row], schema=layout)

        layout = pa.schema([
            *((n, pa.int64()) for n in ("shard", "chunk", "ids_before", "n_ids")),
            ("doc_ids", pa.list_(pa.int64())), ("lengths", pa.list_(pa.int64())), ("blocks", pa.binary()),
        ])
        for batch in batches:
            ids = batch.column("doc_id").to_pylist()
            for n, part in enumerate(encoder(tokenizer).encode(batch.column("text"))):
                docs.append(ids[n])
                parts.append(np.concatenate([part, tail]))
                lengths.append(len(part) + 1)
                held += lengths[-1]
                if held >= CHUNK:
                    yield close()
        if docs:
            yield close()

    ordered = documents.select(F.col("doc_id").cast("long"), "text").repartitionByRange("doc_id")
    ordered = ordered.sortWithinPartitions("doc_id", F.xxhash64("text"))
    ordered.mapInArrow(make, CHUNKS).write.parquet(folder)


def read_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids`` of every document, from the files alone.

    ``start`` counts the ids of all documents before it, ``ids`` are little-endian unsigned 32-bit
    integers. Only the totals of the shards are put in one place.
    """

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "start", "n_tokens", "ids"]
        for batch in batches:
            for row in batch.to_pylist():
                data = decode_blocks(row["blocks"]).astype("<u4").tobytes()
                lengths = np.array(row["lengths"], np.int64)
                ends = np.cumsum(lengths)
                starts = ends - lengths
                ids = [data[4 * a : 4 * b] for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(row["doc_ids"], pa.int64()),
                        pa.array(starts + row["first"]),
                        pa.array(lengths),
                        pa.array(ids, pa.binary()),
                    ],
                    names=names,
                )

    chunks = spark.read.schema(CHUNKS).parquet(folder)
    totals = chunks.groupBy("shard").agg(F.sum("n_ids").alias("n"))
    earlier = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    # One row per shard, so the window and the broadcast are as small as the list of files.
    bases = totals.select("shard", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
    first = (F.col("base") + F.col("ids_before")).alias("first")
    return (
        chunks.join(F.broadcast(bases), "shard")
        .select("doc_ids", "lengths", "blocks", first)
        .mapInArrow(make, "doc_id long, start long, n_tokens long, ids binary")
    )
