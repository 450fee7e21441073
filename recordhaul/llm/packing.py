"""Packing of examples into sequences under several limits at once.

Vector bin packing: an example asks for tokens, one segment and its loss-bearing tokens, a
sequence has a limit on each. A sequence is filled by the example, of those that fit, whose demand
has the largest dot product with the room that is left; both are taken as shares of the limits.
Where none fits any more, one is cut so that its beginning fills the sequence. What cannot be
filled up is written as sequences of lengths that are powers of two, which need no padding either.

Each task packs what it has read, in windows of bounded size, and carries what is left of a window
into the next: nothing is shuffled, and a task that runs again gives the same sequences.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordhaul.llm.tokens import WORD_BPE, encoder

#: Ids that are held before they are packed.
WINDOW = 1 << 20
#: Sequence and row numbers of a task start at its number times this.
PER_TASK = 1 << 33

PIECES = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, "
    "offset long, row long, loss_tokens long"
)


@dataclass
class Example:
    """What is still to be placed of a row: ``ids[at:]``, whose loss begins at ``loss_from``."""

    doc_id: int | None
    row: int
    ids: np.ndarray
    loss_from: int
    at: int = 0

    def loss(self, begin: int, end: int) -> int:
        return max(0, end - max(begin, self.loss_from))

    def fit(self, tokens: int, loss: int) -> int:
        """Ids from the front that go into so much room."""
        free = max(0, self.loss_from - self.at)
        return min(tokens, len(self.ids) - self.at, free + loss)


class Packer:
    """Takes examples and gives the rows of their pieces."""

    def __init__(self, tokens: int, segments: int, loss: int, first_sequence: int):
        self.limits = np.array([tokens, segments, loss], float)
        self.tokens, self.segments, self.loss = tokens, segments, loss
        self.sequence = first_sequence
        self.waiting: list[Example] = []
        self.held = 0
        self.picks = 0
        self.rows: list[tuple] = []

    def add(self, example: Example) -> None:
        while example.fit(self.tokens, self.loss) == self.tokens:
            self._write([self._cut(example, self.tokens)])
        if example.at < len(example.ids):
            self.waiting.append(example)
            self.held += len(example.ids) - example.at
        if self.held > WINDOW:
            self.pack()

    def _cut(self, example: Example, count: int) -> tuple[Example, int, int]:
        begin = example.at
        example.at += count
        return example, begin, example.at

    def _write(self, pieces: list[tuple[Example, int, int]]) -> None:
        """The pieces as one full sequence, or as sequences of powers of two."""
        left = sum(end - begin for _, begin, end in pieces)
        pieces = pieces[::-1]
        while left:
            room = self.tokens if left == self.tokens else 1 << (left.bit_length() - 1)
            left -= room
            offset = 0
            while offset < room:
                example, begin, end = pieces.pop()
                stop = min(end, begin + room - offset)
                if stop < end:
                    pieces.append((example, stop, end))
                crc = zlib.crc32(example.ids[begin:stop].astype("<u4").tobytes())
                self.rows.append((
                    example.doc_id, begin, stop - begin, crc, len(example.ids), self.sequence,
                    offset, example.row, example.loss(begin, stop),
                ))
                offset += stop - begin
            self.sequence += 1

    def pack(self, last: bool = False) -> None:
        """Fills sequences from what waits; keeps less than one sequence back unless ``last``."""
        # Examples of equal demand are one candidate, so that a pick looks at each demand once.
        alike: dict[tuple[int, int], int] = {}
        groups: list[list[Example]] = []
        demands: list[tuple[int, int, int]] = []

        def wait(example: Example) -> int:
            demand = len(example.ids) - example.at, example.loss(example.at, len(example.ids))
            n = alike.setdefault(demand, len(groups))
            if n == len(groups):
                groups.append([])
                demands.append((demand[0], 1, demand[1]))
            groups[n].append(example)
            return n

        for example in reversed(self.waiting):
            wait(example)
        sizes = np.array(demands, float).reshape(-1, 3)
        open_ = np.ones(len(groups), bool)
        total = sum(len(x.ids) - x.at for x in self.waiting)
        while open_.any() and (last or total >= self.tokens):
            room, pieces = self.limits.copy(), []
            while room[0] >= 1 and room[1] >= 1:
                self.picks += 1
                fits = open_ & (sizes <= room).all(1)
                if fits.any():
                    gain = (sizes / self.limits) @ (room / self.limits)
                    n = int(np.argmax(np.where(fits, gain, -1)))
                    count = int(sizes[n, 0])
                else:
                    able = np.where(open_, sizes[:, 0], -1)
                    n = int(np.argmax(able))
                    count = groups[n][-1].fit(int(room[0]), int(room[2])) if able[n] > 0 else 0
                if not count:
                    break
                example, begin, end = self._cut(groups[n].pop(), count)
                pieces.append((example, begin, end))
                room -= (count, 1, example.loss(begin, end))
                total -= count
                open_[n] = bool(groups[n])
                if example.at < len(example.ids):
                    n = wait(example)
                    if n == len(sizes):
                        sizes = np.vstack([sizes, demands[n]])
                        open_ = np.append(open_, True)
                    open_[n] = True
            if not pieces:
                break
            self._write(pieces)
        self.waiting = [example for group in groups for example in reversed(group)]
        self.held = total

    def take(self) -> pa.RecordBatch:
        rows, self.rows = self.rows, []
        names = [part.split()[0] for part in PIECES.split(", ")]
        columns = list(zip(*rows, strict=True)) or [()] * len(names)
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=names)


def pack_documents(
    documents: DataFrame,
    tokenizer: str = WORD_BPE,
    end_id: int = 2,
    tokens: int = 4096,
    segments: int = 256,
    loss_tokens: int = 4096,
) -> DataFrame:
    """The pieces of every row: its ids, with ``end_id`` behind them, cut over sequences.

    A sequence has at most ``tokens`` ids, ``segments`` pieces and ``loss_tokens`` ids that bear
    loss. All ids of a row bear loss but its first ``prompt_tokens``, if there is such a column
    (null: none). ``doc_tokens`` counts the ids of the row, ``start`` those before the piece,
    ``offset`` those before it in its sequence; ``row`` tells apart rows that share a ``doc_id``.
    Null and empty texts are one id. Other columns are not looked at. Very long texts are cut over as many
    sequences as they fill; examples of equal demand go in the order in which they are read, and repeated rows
    are examples of their own. An empty table has no pieces.
    """
    if min(tokens, segments, loss_tokens) < 1:
        raise ValueError("every limit must be 1 or more")

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() * PER_TASK
        packer, row = Packer(tokens, segments, loss_tokens, first), first
        tail = np.array([end_id], np.uint32)
        for batch in batches:
            ids = batch.column("doc_id").to_pylist()
            prompts = batch.column("prompt_tokens").to_pylist()
            for n, part in enumerate(encoder(tokenizer).encode(batch.column("text"))):
                packer.add(Example(ids[n], row, np.concatenate([part, tail]), prompts[n] or 0))
                row += 1
            yield packer.take()
        packer.pack(last=True)
        yield packer.take()

    prompt = F.col("prompt_tokens") if "prompt_tokens" in documents.columns else F.lit(None)
    source = documents.select(
        F.col("doc_id").cast("long"), "text", prompt.cast("long").alias("prompt_tokens")
    )
    return source.mapInArrow(make, PIECES)
