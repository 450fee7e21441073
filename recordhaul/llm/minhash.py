"""Near-duplicate documents by b-bit MinHash.

1. One pass makes of each text the set of its word shingles, the minima of the set under ``HASHES``
   hash functions, a key per band of ``ROWS`` minima, and a packed signature with the low ``BITS``
   bits of each minimum.
2. Sets that share a band key are candidates. Within a bucket each set is first paired with the
   bucket's smallest one only, so that thousands of copies give thousands of pairs, not millions.
3. A pair is kept if the number of equal lanes of its signatures, corrected for lanes that agree by
   chance, leaves the similarity asked for possible (six standard deviations), and if the sizes do.
4. What is left is confirmed on the full sets, and components are formed.
5. Buckets that still hold several components are compared in full, in blocks: by signature, then,
   for pairs of different components that pass, on the sets. A block gives no more links than join
   its components. So no link is lost that shares a band.

Equal sets are one node from the start. With 32 bands of 4 rows a pair at similarity 0.85 shares no
band with probability 6e-11, at 0.8 with 5e-8. Shingles and sets are told apart by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordhaul.llm.components import connected
from recordhaul.llm.shingles import mix, shingle_set, word_hashes
from recordhaul.session import stage

HASHES, ROWS, BITS = 128, 4, 2
WORDS = HASHES * BITS // 64
SIGNATURE = [f"s{n}" for n in range(WORDS)]
#: Sets of a bucket that are compared in one block.
BLOCK = 1024
#: Shingles that a part of a bucket holds; with ``BLOCK`` it decides the number of parts.
BLOCK_SHINGLES = 500_000

_seeds = mix(np.arange(1, 2 * HASHES + 1, dtype=np.uint64))
_FACTORS, _SHIFTS = _seeds[:HASHES, None] | np.uint64(1), _seeds[HASHES:, None]
_LANES = np.uint64(0x5555555555555555)


def _minima(shingles: np.ndarray) -> np.ndarray:
    least = np.full(HASHES, np.iinfo(np.uint64).max, np.uint64)
    for n in range(0, len(shingles), 2048):
        part = shingles[None, n : n + 2048] * _FACTORS
        part += _SHIFTS
        np.minimum(least, part.min(axis=1), out=least)
    return least


def _packed(minima: np.ndarray) -> np.ndarray:
    """The low bits of all minima, in 64-bit words."""
    low = (mix(minima) & np.uint64((1 << BITS) - 1)).reshape(WORDS, -1)
    places = np.arange(low.shape[1], dtype=np.uint64) * np.uint64(BITS)
    return np.bitwise_or.reduce(low << places, axis=1)


def _band_keys(minima: np.ndarray) -> np.ndarray:
    bands = minima.reshape(-1, ROWS)
    keys = np.arange(len(bands), dtype=np.uint64)
    for n in range(ROWS):
        keys = mix(keys * np.uint64(0xD6E8FEB86659FD93) + bands[:, n])
    return keys


def _node(shingles: np.ndarray) -> int:
    total = np.cumsum(mix(shingles), dtype=np.uint64)[-1:]
    return int(mix(total + np.array([len(shingles)], np.uint64)).astype(np.int64)[0])


def signatures(documents: DataFrame, size: int) -> DataFrame:
    """``doc_id, node, n_shingles``, the signature and the band keys of each row.

    ``node`` is a hash of the set, null for an empty one.
    """
    schema = "doc_id long, node long, n_shingles long, " + ", ".join(f"{s} long" for s in SIGNATURE)

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes, counts, packed, keys = [], [], [], []
            for words in word_hashes(batch.column("text")):
                shingles = shingle_set(words, size)
                counts.append(len(shingles))
                if not len(shingles):
                    nodes.append(None)
                    packed.append(np.zeros(WORDS, np.int64))
                    keys.append(np.empty(0, np.int64))
                    continue
                minima = _minima(shingles)
                nodes.append(_node(shingles))
                packed.append(_packed(minima).astype(np.int64))
                keys.append(_band_keys(minima).astype(np.int64))
            columns = np.array(packed, np.int64).reshape(-1, WORDS)
            ends = np.concatenate([[0], np.cumsum([len(k) for k in keys])]).astype(np.int32)
            bands = pa.ListArray.from_arrays(ends, np.concatenate(keys or [np.empty(0, np.int64)]))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(nodes, pa.int64()),
                    pa.array(counts, pa.int64()),
                    *(pa.array(columns[:, n]) for n in range(WORDS)),
                    bands,
                ],
                names=["doc_id", "node", "n_shingles", *SIGNATURE, "bands"],
            )

    source = documents.select(F.col("doc_id").cast("long"), F.col("text"))
    return source.mapInArrow(make, schema + ", bands array<long>")


def lanes_needed(percent: int) -> int:
    """Equal lanes below which a pair of that similarity is ruled out."""
    chance = 2.0**-BITS
    expected = chance + (1 - chance) * percent / 100
    return int(HASHES * expected - 6 * sqrt(HASHES * expected * (1 - expected)))


def equal_lanes(left: str, right: str) -> Column:
    """Lanes that agree in the signatures of two aliases."""
    differing = F.lit(0)
    for name in SIGNATURE:
        x = F.col(f"{left}.{name}").bitwiseXOR(F.col(f"{right}.{name}"))
        lanes = x.bitwiseOR(F.shiftrightunsigned(x, 1)).bitwiseAND(F.lit(int(_LANES)))
        differing = differing + F.bit_count(lanes)
    return F.lit(HASHES) - differing


def _possible(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """Pairs ``(a, b)`` whose signatures and sizes leave the similarity possible."""
    x = nodes.select(F.col("node").alias("a"), "n_shingles", *SIGNATURE).alias("x")
    y = nodes.select(F.col("node").alias("b"), "n_shingles", *SIGNATURE).alias("y")
    small = F.least("x.n_shingles", "y.n_shingles")
    large = F.greatest("x.n_shingles", "y.n_shingles")
    return (
        pairs.join(x, "a")
        .join(y, "b")
        .where((small * 100 >= large * percent) & (equal_lanes("x", "y") >= lanes_needed(percent)))
        .select("a", "b")
    )


def _confirmed(pairs: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """Pairs whose full sets have the similarity."""

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets: dict[int, np.ndarray] = {}
        for batch in batches:
            right = []
            ends = batch.select(["a", "b"]).to_pydict()
            for n, (a, b) in enumerate(zip(ends["a"], ends["b"], strict=True)):
                found = []
                for node, name in ((a, "text_a"), (b, "text_b")):
                    if node not in sets:
                        if len(sets) >= 256:
                            sets.clear()
                        words = next(word_hashes(batch.column(name).slice(n, 1)))
                        sets[node] = shingle_set(words, size)
                    found.append(sets[node])
                both = len(np.intersect1d(*found, assume_unique=True))
                either = len(found[0]) + len(found[1]) - both
                right.append(_node(found[0]) == a and _node(found[1]) == b and 100 * both >= percent * either)
            yield batch.select(["a", "b"]).filter(pa.array(right, pa.bool_()))

    with_texts = pairs.join(
        texts.select(F.col("node").alias("a"), F.col("text").alias("text_a")), "a"
    ).join(texts.select(F.col("node").alias("b"), F.col("text").alias("text_b")), "b")
    return with_texts.select("a", "b", "text_a", "text_b").mapInArrow(check, "a long, b long")


def _joined(group: pa.Table, size: int, percent: int) -> list[tuple[int, int]]:
    """Links between different components of a block, as many as join what the block can join."""
    needed = lanes_needed(percent)
    column = {n: group.column(n).to_numpy() for n in ("i", "j", "side", "node", "component")}
    texts = group.column("text").combine_chunks()
    sets = [shingle_set(words, size) for words in word_hashes(texts)]
    right_text = np.array([len(x) > 0 and _node(x) == n for x, n in zip(sets, column["node"], strict=True)])
    sizes = np.array([len(x) for x in sets])
    signature = np.stack([group.column(s).to_numpy() for s in SIGNATURE], 1).astype(np.uint64)
    same = column["i"][0] == column["j"][0]
    left = np.arange(len(sets)) if same else np.flatnonzero(column["side"] == 0)
    right = left if same else np.flatnonzero(column["side"] == 1)
    # Shingles as small numbers, so that one look-up finds those that a set shares with all others.
    numbers = np.unique(np.concatenate(sets), return_inverse=True)[1]
    begins = np.concatenate([[0], np.cumsum(sizes)])
    marked = np.zeros(len(numbers) + 1, np.int32)
    label = np.unique(column["component"], return_inverse=True)[1]
    links = []
    for n in left:
        x = signature[n] ^ signature[right]
        lanes = HASHES - np.bitwise_count((x | (x >> np.uint64(1))) & _LANES).sum(1)
        small, large = np.minimum(sizes[n], sizes[right]), np.maximum(sizes[n], sizes[right])
        good = (lanes >= needed) & (label[right] != label[n]) & (small * 100 >= large * percent)
        good &= right_text[right] & right_text[n]
        if same:
            good &= right > n
        if not good.any():
            continue
        own = numbers[begins[n] : begins[n + 1]]
        marked[own] = 1
        running = np.concatenate([[0], np.cumsum(marked[numbers])])
        marked[own] = 0
        both = (running[begins[1:]] - running[begins[:-1]])[right]
        good &= both * 100 >= (sizes[n] + sizes[right] - both) * percent
        for m in right[good]:
            if label[m] != label[n]:
                links.append((int(column["node"][n]), int(column["node"][m])))
                label[label == label[m]] = label[n]
    return links


def _links_within(rows: DataFrame, size: int, percent: int) -> DataFrame:
    """Confirmed links ``(a, b)`` between components that meet in a block.

    ``rows`` are sorted so that a block ``(key, i, j)`` stands together; ``side`` tells which of
    the two parts of its bucket a row is from.
    """

    def links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(block: pa.Table) -> pa.RecordBatch:
            found = np.array(_joined(block, size, percent), np.int64).reshape(-1, 2)
            return pa.RecordBatch.from_arrays([pa.array(found[:, 0]), pa.array(found[:, 1])], names=["a", "b"])

        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch])
            held = table if held is None else pa.concat_tables([held, table])
            change = np.zeros(held.num_rows, bool)
            for name in ("key", "i", "j"):
                values = held.column(name).to_numpy()
                change[1:] |= values[1:] != values[:-1]
            cuts = [0, *np.flatnonzero(change).tolist()]
            for a, b in zip(cuts, cuts[1:], strict=False):
                yield out(held.slice(a, b - a))
            held = held.slice(cuts[-1])
        if held is not None:
            yield out(held)

    return rows.mapInArrow(links, "a long, b long")


def near_duplicates(documents: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for every row of ``documents``.

    Two documents are linked if ``100 * |intersection| >= percent * |union|`` of their sets of
    distinct ``size``-word shingles. A text of fewer words is one shingle; a null, empty or blank
    text has none and is linked with nothing. ``component_id`` is the smallest ``doc_id`` that can
    be reached, ``kept`` says whether it is the row's own. Repeated rows fall into one component;
    rows that share a ``doc_id`` but not their text are told apart by their sets. A row without a ``doc_id``
    belongs to the component of the rows of an equal set that have one; where there is none, it is
    linked with nothing, has a null component and is kept. Other columns are not looked at.
    """
    made = stage(signatures(documents, size), "signatures")
    nodes = (
        made.where("node IS NOT NULL")
        .groupBy("node")
        .agg(
            F.min("doc_id").alias("first_doc"),
            F.min("n_shingles").alias("n_shingles"),
            *(F.min(s).alias(s) for s in SIGNATURE),
        )
    )
    nodes = stage(nodes, "nodes")

    bands = made.where("node IS NOT NULL").select("node", F.explode("bands").alias("key"))
    buckets = bands.groupBy("key").agg(F.min("node").alias("hub"), F.max("node").alias("other"))
    shared = buckets.where("hub <> other").select("key", "hub")
    inside = stage(bands.join(shared, "key").where("node <> hub").distinct(), "buckets")

    hub_pairs = inside.select(F.col("hub").alias("a"), F.col("node").alias("b")).distinct()
    hub_pairs = stage(_possible(hub_pairs, nodes, percent), "hub-pairs")
    wanted = inside.select("node").union(inside.select("hub")).distinct()
    wanted = nodes.join(wanted, "node", "left_semi").select("node", F.col("first_doc").alias("doc_id"))
    texts = documents.select(F.col("doc_id").cast("long"), "text").join(wanted, "doc_id")
    texts = stage(texts.select("node", "text"), "candidate-texts")
    links = stage(_confirmed(hub_pairs, texts, size, percent), "links")

    components = connected(links)
    placed = inside.join(components, "node", "left").select(
        "key", "node", F.coalesce("component", "node").alias("component")
    )
    placed = placed.join(nodes.select("node", "n_shingles", *SIGNATURE), "node")
    mixed = placed.groupBy("key").agg(
        F.min("component").alias("least"), F.max("component").alias("most"),
        F.count("*").alias("n"), F.sum("n_shingles").alias("total"),
    )
    parts = F.ceil(F.greatest(F.col("n") / BLOCK, F.col("total") / BLOCK_SHINGLES))
    mixed = mixed.where("least <> most").select("key", parts.alias("parts"))
    part = F.pmod(F.xxhash64("node"), F.col("parts"))
    rows = (
        placed.join(mixed, "key")
        .withColumn("part", part)
        .withColumn("with", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
        .select(
            "key", F.least("part", "with").alias("i"), F.greatest("part", "with").alias("j"),
            (F.col("part") > F.col("with")).cast("long").alias("side"),
            "node", "component", *SIGNATURE,
        )
        .join(texts, "node")
    )
    rows = rows.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")
    more = stage(_links_within(rows, size, percent), "links")

    components = connected(links.union(more))
    firsts = components.join(nodes.select("node", "first_doc"), "node")
    least = firsts.groupBy("component").agg(F.min("first_doc").alias("component_id"))
    of_node = components.join(least, "component").select("node", "component_id")
    of_node = nodes.select("node", "first_doc").join(of_node, "node", "left")
    of_node = of_node.select("node", F.coalesce("component_id", "first_doc").alias("component_id"))
    rows = made.select("doc_id", "node", "n_shingles").join(of_node, "node", "left")
    component = F.coalesce("component_id", "doc_id")
    return rows.select(
        "doc_id", "n_shingles", component.alias("component_id"),
        F.col("doc_id").eqNullSafe(component).alias("kept"),
    )
