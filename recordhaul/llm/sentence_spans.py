"""Substring de-duplication: remove sentences that a repeated run of sentences covers.

Every run of several consecutive sentences is hashed and the hashes are joined globally: a hash
that occurs twice or more has a first place, and the sentences of all its other places go. The
counts are reduced per task before they are shuffled, so a passage in a third of all documents
costs one row per task there; where the repeated hashes meet the runs again, the adaptive skew join
splits such a passage. Texts move once, to meet the numbers of their covered sentences.

A run begins at each sentence and goes on until it has ``min_words`` words and has crossed the end of a
sentence; where no such run ends at a sentence, the shortest one that ends there is added. So
each sentence of a repeated passage lies in a run that the passage holds in full, if the passage is
as long as that. One sentence is no run, unless it has more than ``PASSAGE`` words and so holds a
passage by itself.

Words lie between ASCII white space, with A-Z read as a-z. A sentence ends with a word that ends in
``.``, ``!`` or ``?``, and before a line feed. Sentences of more than ``LONG`` words are also cut into
pieces, which then stand for sentences: behind the word of the least hash, the last one of
equals, in each window of ``WINDOW`` words. So text is cut at the same words wherever
it stands, save for less than a window at its ends, and no piece is longer than a window. Of a passage of 51
words, either a sentence and a piece beside it lie whole in all its places, or a sentence of more than
``PASSAGE`` words and so many of its pieces.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordhaul.llm.shingles import byte_groups, mix, word_places
from recordhaul.session import stage

MIN_WORDS = 16
LONG = 12
WINDOW = 12
PASSAGE = 24

_STOPS = np.zeros(256, bool)
_STOPS[list(b".!?")] = True
#: Bases of the two halves of a run's hash.
_BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)


@dataclass
class Cut:
    """The sentences and pieces of texts that lie one behind the other, as arrays.

    ``start`` is the first byte of a piece, ``first`` and ``last`` its words, ``sentence`` the number of its
    sentence, ``long`` whether that has more than ``PASSAGE`` words; pieces ``text[n]`` to ``text[n + 1]``
    are those of text ``n``.
    """

    hashes: np.ndarray
    start: np.ndarray
    first: np.ndarray
    last: np.ndarray
    sentence: np.ndarray
    long: np.ndarray
    text: np.ndarray


def cut_texts(data: np.ndarray, bounds: np.ndarray) -> Cut:
    first, last, hashes = word_places(data, bounds)
    count = len(first)
    none = np.zeros(0, np.int64)
    if not count:
        return Cut(hashes, none, none, none, none, none, np.zeros(len(bounds), np.int64))
    words_before = np.searchsorted(first, bounds)
    feeds = np.cumsum(data == 10)
    ends = _STOPS[data[last]]
    ends[:-1] |= feeds[first[1:]] > feeds[last[:-1]]
    ends[words_before[1:][words_before[1:] > 0] - 1] = True
    sentence = np.concatenate([[0], np.cumsum(ends[:-1])])
    size = np.bincount(sentence)[sentence]
    if count >= WINDOW:
        # The last of the least: the first of the least from behind.
        windows = np.lib.stride_tricks.sliding_window_view(hashes, WINDOW)
        begin = np.flatnonzero((sentence[: len(windows)] == sentence[WINDOW - 1 :]) & (size[: len(windows)] > LONG))
        ends[begin + WINDOW - 1 - np.argmin(windows[begin, ::-1], axis=1)] = True
    piece_last = np.flatnonzero(ends)
    piece_first = np.concatenate([[0], piece_last[:-1] + 1])
    return Cut(
        hashes,
        first[piece_first],
        piece_first,
        piece_last,
        sentence[piece_first],
        size[piece_first] > PASSAGE,
        np.searchsorted(piece_first, words_before),
    )


def find_runs(cut: Cut, min_words: int) -> tuple[np.ndarray, np.ndarray]:
    """First and last piece of every run."""
    count = len(cut.first)
    every = np.arange(count)
    owner = np.searchsorted(cut.text, every, "right") - 1
    # A run may begin and end in one sentence only if that is a long one.
    beyond = np.searchsorted(cut.sentence, cut.sentence, "right")
    ahead = np.searchsorted(cut.last, cut.first + (min_words - 1))
    ahead = np.where(cut.long, ahead, np.maximum(ahead, beyond))
    held = ahead < cut.text[owner + 1]
    before = np.searchsorted(cut.sentence, cut.sentence) - 1
    back = np.searchsorted(cut.first, cut.last + (1 - min_words), "right") - 1
    back = np.where(cut.long, back, np.minimum(back, before))
    reached = np.zeros(count + 1, bool)
    reached[ahead[held]] = True
    added = (back >= cut.text[owner]) & ~reached[:-1]
    return (
        np.concatenate([every[held], back[added]]),
        np.concatenate([ahead[held], every[added]]),
    )


def hash_runs(cut: Cut, first: np.ndarray, last: np.ndarray) -> list[np.ndarray]:
    """Two 64-bit halves of the hash of the words of each run."""
    begin, end = cut.first[first], cut.last[last]
    out = []
    for base in _BASES:
        powers = np.cumprod(np.full(len(cut.hashes) + 1, base, np.uint64), dtype=np.uint64)
        inverse = np.uint64(pow(base, -1, 1 << 64))
        backs = np.cumprod(np.full(len(cut.hashes) + 1, inverse, np.uint64), dtype=np.uint64)
        sums = np.concatenate([[np.uint64(0)], np.cumsum(mix(cut.hashes ^ np.uint64(base)) * powers[:-1], dtype=np.uint64)])
        whole = (sums[end + 1] - sums[begin]) * backs[begin]
        out.append(mix(whole + (end - begin).astype(np.uint64)).view(np.int64))
    return out


def _hashed_runs(documents: DataFrame, min_words: int) -> DataFrame:
    """One row for each run of each text; a place is its first piece in the text and its length."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin, data, bounds in byte_groups(batch.column("text")):
                cut = cut_texts(data, bounds)
                if not len(cut.first):
                    continue
                first, last = find_runs(cut, min_words)
                owner = np.searchsorted(cut.text, first, "right") - 1
                place = (first - cut.text[owner]) << 24 | (last - first)
                owner = pa.array(owner + begin)
                ids = [batch.column(c).take(owner) for c in ("doc_id", "row")]
                yield pa.RecordBatch.from_arrays(
                    [*map(pa.array, hash_runs(cut, first, last)), *ids, pa.array(place)],
                    names=["h1", "h2", "doc_id", "row", "place"],
                )

    return documents.select("doc_id", F.xxhash64("text").alias("row"), "text").mapInArrow(
        make, "h1 long, h2 long, doc_id long, row long, place long"
    )


def _without(texts: pa.Array, covered: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The texts without the pieces of the covered places, and how many went; a text each has some."""
    out: list[bytes] = []
    removed: list[np.ndarray] = []
    for begin, data, bounds in byte_groups(texts):
        cut = cut_texts(data, bounds)
        lists = covered.slice(begin, len(bounds) - 1)
        places = lists.flatten().to_numpy()
        owner = np.repeat(np.arange(len(lists)), pc.list_value_length(lists).to_numpy())
        first = (places >> 24) + cut.text[owner]
        last = first + (places & 0xFFFFFF)
        depth = np.zeros(len(cut.first) + 1, np.int64)
        np.add.at(depth, first, 1)
        np.add.at(depth, last + 1, -1)
        gone = np.cumsum(depth)[:-1] > 0
        # A piece reaches to the next one of its text; what stands before the first piece stays.
        edges = np.concatenate([bounds[:-1], cut.start])
        order = np.argsort(edges, kind="stable")
        stays = np.concatenate([np.ones(len(bounds) - 1, bool), ~gone])[order]
        mask = np.repeat(stays, np.diff(np.concatenate([edges[order], bounds[-1:]])))
        kept = data[mask].tobytes()
        ends = np.concatenate([[0], np.cumsum(mask)])[bounds].tolist()
        out += [kept[a:b] for a, b in zip(ends, ends[1:], strict=False)]
        total = np.concatenate([[0], np.cumsum(gone)])
        removed.append(total[cut.text[1:]] - total[cut.text[:-1]])
    return pa.array(out, pa.binary()).cast(pa.string()), np.concatenate(removed)


def drop_repeated_spans(documents: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``documents`` with ``text`` reduced, and ``n_removed`` added: sentences, or pieces of long ones, removed.

    The first place of a run is the one of the smallest ``doc_id``, in it the earliest. A removed
    sentence goes with the white space behind it. Null or empty text has no sentence and becomes
    empty; so does an empty table. Rows without ``doc_id`` count as the smallest one. Rows that repeat both
    ``doc_id`` and text are one document, and all or none of them keep a sentence; exact copies under
    other ids lose all that a run covers. Very long texts are taken whole. Other columns are carried
    along, save any named ``n_removed``, which is replaced, and ``_id``, ``_row`` and ``_covered``, which go.
    """
    source = documents.drop("n_removed", "_id", "_row", "_covered").withColumn("text", F.coalesce("text", F.lit("")))
    source = source.withColumn("doc_id", F.col("doc_id").cast("long"))
    found = _hashed_runs(source, min_words)
    place = F.struct("doc_id", "row", "place")
    repeated = found.groupBy("h1", "h2").agg(F.count("*").alias("n"), F.min(place).alias("first"))
    repeated = stage(repeated.where("n > 1").select("h1", "h2", "first"), "repeated-spans")
    covered = (
        found.join(repeated, ["h1", "h2"])
        .where(~place.eqNullSafe(F.col("first")))
        .groupBy("doc_id", "row")
        .agg(F.collect_set("place").alias("_covered"))
    )
    covered = covered.select(F.col("doc_id").alias("_id"), F.col("row").alias("_row"), "_covered")
    joined = source.join(
        covered, source.doc_id.eqNullSafe(F.col("_id")) & (F.xxhash64("text") == F.col("_row")), "left"
    ).drop("_id", "_row")
    schema = source.schema.add("n_removed", "long")
    names = [field.name for field in schema]

    def reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, removed = batch.column("text"), np.zeros(len(batch), np.int64)
            touched = batch.column("_covered").is_valid()
            if touched.true_count:
                kept, gone = _without(texts.filter(touched), batch.column("_covered").filter(touched))
                texts = pc.replace_with_mask(texts, touched, kept.cast(texts.type))
                removed[touched.to_numpy(zero_copy_only=False)] = gone
            made = {"text": texts, "n_removed": pa.array(removed)}
            yield pa.RecordBatch.from_arrays(
                [made[n] if n in made else batch.column(n) for n in names], names=names
            )

    return joined.mapInArrow(reduce, schema)
