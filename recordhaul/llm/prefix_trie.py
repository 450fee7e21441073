"""Prefix trie of conversations: sorted turn sequences, their LCPs, and range minima over those.

Conversations are sorted over the cluster by the digests of their turns. In sorted order the conversations that
begin with a prefix are an interval; with the lengths that neighbours have in common (LCPs) in a sparse table of range
minima, each prefix finds the two ends of its interval by a binary search to the left and one to the
right, by itself. Nodes come in preorder, so sums over a subtree are differences of running sums.

A task works through its part of the sort in windows of bounded size, so a first turn that a third of all
conversations share is spread over many tasks. A prefix of a window's first or last conversation may go on in other
windows: such nodes are *open*. Their parts are merged by key, and their subtree sums, which need other open
nodes, are found by doubling: in a round each node takes over the sums of its descendants twice as far down. What
stays one row is the list of a conversation's turn digests (24 bytes a turn).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordhaul.llm.shingles import mix
from recordhaul.session import stage

#: Turns of a window, at least.
WINDOW = 1 << 17
#: Bytes of ids that are handed on at once, about.
CHUNK = 1 << 18

WORDS = r"[^\x20\x09-\x0D]+"
NODE = (
    "k1 long, k2 long, p1 long, p2 long, depth long, conv_id long, parent_conv_id long, n_convs long, "
    "n_children long, n_leaves long, saved_tokens long, words long, ends_sha256 string, open boolean, chunk binary"
)
_COLUMNS = [part.split()[0] for part in NODE.split(", ")]
_NO_ENDS = hashlib.sha256(b"").hexdigest()


def turn_lists(conversations: DataFrame) -> DataFrame:
    """``conv_id`` and ``turns`` of each conversation, in order of ``turn``, as digests and word counts.

    A null turn comes first; turns of one number are ordered by their digests. Null roles and texts are empty.
    Rows without a ``conv_id`` belong to no conversation.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    turn = F.struct(
        F.col("turn").cast("long").alias("turn"),
        F.xxhash64(role, text).alias("a"),
        F.xxhash64(text, role, F.lit(1)).alias("b"),
        F.regexp_count(text, F.lit(WORDS)).alias("words"),
    )
    turns = F.sort_array(F.collect_list(turn))
    grouped = conversations.where("conv_id IS NOT NULL").groupBy(F.col("conv_id").cast("long").alias("conv_id"))
    return grouped.agg(turns.alias("turns"))


def rebuild(lists: DataFrame, family: int = 20, most: int = 4) -> DataFrame:
    """Turn lists that begin as the first of their family does.

    Conversation ``c`` gets the first ``h`` turns of ``c - c % family`` (all if fewer, none if there is no such
    conversation) in place of its own first ``h``, with ``h = crc32(c) % most``.
    """
    heads = lists.where(F.col("conv_id") % family == 0)
    heads = heads.select(F.col("conv_id").alias("_base"), F.slice("turns", 1, most - 1).alias("_head"))
    base = F.col("conv_id") - F.col("conv_id") % family
    found = lists.withColumn("_base", base).join(heads, "_base", "left")
    count = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % most).cast("int")
    none = F.slice("turns", 1, 0)
    head = F.slice(F.coalesce("_head", none), F.lit(1), count)
    own = F.slice("turns", count + 1, F.greatest(F.size("turns") - count, F.lit(0)))
    return found.select("conv_id", F.concat(head, own).alias("turns"))


def _keys(at: np.ndarray, a: np.ndarray, b: np.ndarray, starts: np.ndarray, lens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A digest, in two halves, of the turns up to each turn; ``at`` are places within the conversation."""
    out = []
    for base, one, other in ((0x9E3779B97F4A7C15, a, b), (0xC2B2AE3D27D4EB4F, b, a)):
        powers = np.cumprod(np.full(int(at.max(initial=0)) + 1, base, np.uint64), dtype=np.uint64)
        terms = mix(one.view(np.uint64) ^ mix(other.view(np.uint64) + np.uint64(base))) * powers[at]
        sums = np.concatenate([[np.uint64(0)], np.cumsum(terms, dtype=np.uint64)])
        prefix = sums[1:] - np.repeat(sums[starts], lens)
        out.append(mix(prefix + (at + 1).astype(np.uint64)).view(np.int64))
    return out[0], out[1]


class Minima:
    """Sparse table: the least of each run of ``2 ** k`` values."""

    def __init__(self, values: np.ndarray):
        self.levels = [values]
        while (step := 1 << (len(self.levels) - 1)) * 2 <= len(values):
            below = self.levels[-1]
            self.levels.append(np.minimum(below[: len(below) - step], below[step:]))

    def least(self, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """The least value from ``first`` to ``last``."""
        level = np.frexp(last - first + 1)[1] - 1
        out = np.empty(len(first), self.levels[0].dtype)
        for k in np.unique(level):
            own = level == k
            table = self.levels[k]
            out[own] = np.minimum(table[first[own]], table[last[own] - (1 << int(k)) + 1])
        return out

    def right(self, at: np.ndarray, depth: np.ndarray) -> np.ndarray:
        """The last place to which all values behind ``at`` are ``depth`` at least."""
        at, count = at.copy(), len(self.levels[0])
        for k in range(len(self.levels) - 1, -1, -1):
            able = at + (1 << k) < count
            able[able] = self.levels[k][at[able] + 1] >= depth[able]
            at[able] += 1 << k
        return at

    def left(self, at: np.ndarray, depth: np.ndarray) -> np.ndarray:
        """The first place behind which all values up to the one at ``at`` are ``depth`` at least."""
        at = at.copy()
        for k in range(len(self.levels) - 1, -1, -1):
            able = at - (1 << k) >= 0
            able[able] = self.levels[k][at[able] - (1 << k) + 1] >= depth[able]
            at[able] -= 1 << k
        return at


def shared_depths(keys: tuple[np.ndarray, np.ndarray], starts: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """How many turns each conversation begins with as the one before it does; -1 for the first."""
    out = np.zeros(len(lens), np.int64)
    active = np.arange(1, len(lens))
    depth = 0
    while len(active):
        active = active[np.minimum(lens[active], lens[active - 1]) > depth]
        here, before = starts[active] + depth, starts[active - 1] + depth
        same = np.ones(len(active), bool)
        for k in keys:
            same &= k[here] == k[before]
        active = active[same]
        depth += 1
        out[active] = depth
    out[:1] = -1
    return out


def window_nodes(convs: np.ndarray, lens: np.ndarray, a: np.ndarray, b: np.ndarray, words: np.ndarray) -> pa.RecordBatch:
    """The nodes of conversations in sorted order: closed ones complete, open ones in parts."""
    count = len(convs)
    ends = np.cumsum(lens)
    starts = ends - lens
    row = np.repeat(np.arange(count), lens)
    place = np.arange(len(row)) - starts[row]
    keys = _keys(place, a, b, starts, lens)
    common = shared_depths(keys, starts, lens)
    minima = Minima(common)
    # A prefix is a candidate where it is new: in preorder.
    new = place >= common[row]
    node_of = np.cumsum(new) - 1
    flat = np.flatnonzero(new)
    row_of, depth = row[flat], place[flat] + 1
    left, right = minima.left(row_of, depth), minima.right(row_of, depth)
    least = Minima(convs).least(left, right) if count else convs
    members = right - left + 1
    opened = (left == 0) | (right == count - 1)
    # The parent is the shorter prefix, at the first conversation of its interval.
    deeper = depth > 1
    parent = np.full(len(flat), -1, np.int64)
    above = minima.left(row_of[deeper], depth[deeper] - 1)
    parent[deeper] = node_of[starts[above] + depth[deeper] - 2]
    closed = ~opened
    children = np.bincount(parent[closed] + 1, minlength=len(flat) + 1)
    before = np.concatenate([[0], np.cumsum(np.bincount(row_of, minlength=count))])
    begin, end = np.arange(len(flat)), before[right + 1]
    leaf = closed & (children[1:] == 0)
    sums = [np.concatenate([[0], np.cumsum(x)]) for x in (leaf, np.where(closed, (members - 1) * words[flat], 0))]
    leaves, saved = (s[end] - s[begin] for s in sums)
    if_closed = (parent >= 0) & closed
    if_closed[if_closed] = closed[parent[if_closed]]
    parent_conv = np.where(if_closed, least[parent], 0)
    # Conversations of the node's own length come first in its interval, in order of their ids.
    full = lens[left] == depth
    alike = np.flatnonzero(np.concatenate([[True], (common[1:] != lens[1:]) | (lens[1:] != lens[:-1])]))
    last = np.append(alike, count)[np.searchsorted(alike, left, "right")] - 1
    text = [b"%d" % c for c in convs.tolist()]
    digests: list[str | None] = [None if o else _NO_ENDS for o in opened.tolist()]
    chunks: list[tuple[int, int, int]] = []
    for n in np.flatnonzero(full).tolist():
        first, stop = int(left[n]), int(last[n]) + 1
        if opened[n]:
            chunks += [(n, k, min(k + CHUNK // 16, stop)) for k in range(first, stop, CHUNK // 16)]
        else:
            digests[n] = hashlib.sha256(b",".join(text[first:stop])).hexdigest()
    turnless = int(np.searchsorted(lens > 0, True)) if count else 0
    chunks += [(-1, k, min(k + CHUNK // 16, turnless)) for k in range(0, turnless, CHUNK // 16)]

    def key(half: np.ndarray, nodes: np.ndarray) -> np.ndarray:
        """The root, which is node -1, has key 0."""
        return np.where(nodes >= 0, half[flat[nodes]] if len(flat) else 0, 0)

    every = np.arange(-1, len(flat))
    of_chunk = np.array([c[0] for c in chunks], np.int64)
    total = len(every) + len(chunks)

    def column(nodes: np.ndarray, of_chunks: np.ndarray | None = None, mask: np.ndarray | None = None) -> pa.Array:
        more = np.zeros(len(chunks), np.int64) if of_chunks is None else of_chunks
        hidden = np.concatenate([np.zeros(len(every), bool) if mask is None else mask, np.full(len(chunks), of_chunks is None)])
        return pa.array(np.concatenate([nodes, more]).astype(np.int64), mask=hidden)

    parents = np.concatenate([[-1], parent])
    firsts = np.array([convs[c[1]] for c in chunks], np.int64)
    made = [
        column(key(keys[0], every), key(keys[0], of_chunk)),
        column(key(keys[1], every), key(keys[1], of_chunk)),
        column(key(keys[0], parents)),
        column(key(keys[1], parents)),
        column(np.concatenate([[0], depth])),
        # Of a chunk, its first id: chunks of a node are put together in this order.
        column(np.concatenate([[convs.min()], least]), firsts),
        column(np.concatenate([[0], parent_conv]), mask=np.concatenate([[True], ~if_closed])),
        column(np.concatenate([[count], members])),
        column(children),
        column(np.concatenate([[leaf.sum()], leaves])),
        column(np.concatenate([sums[1][-1:], saved])),
        column(np.concatenate([[0], words[flat]])),
        pa.array([None, *digests, *[None] * len(chunks)], pa.string()),
        pa.array(np.concatenate([[True], opened, np.ones(len(chunks), bool)])),
        pa.array([None] * len(every) + [b",".join(text[c[1] : c[2]]) for c in chunks], pa.binary()),
    ]
    assert all(len(m) == total for m in made)
    return pa.RecordBatch.from_arrays(made, names=_COLUMNS)


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[tuple[np.ndarray, ...]] = []
    turns = 0

    def flush() -> pa.RecordBatch:
        arrays = [np.concatenate(x) for x in zip(*held, strict=True)]
        held.clear()
        return window_nodes(*arrays)

    for batch in batches:
        lists = batch.column("a")
        lens = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        flat = [batch.column(c).flatten().to_numpy(zero_copy_only=False).astype(np.int64) for c in ("a", "b", "words")]
        held.append((batch.column("conv_id").to_numpy(), lens, *flat))
        turns += int(lens.sum()) + len(lens)
        if turns >= WINDOW:
            yield flush()
            turns = 0
    if turns:
        yield flush()


def _hash_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One digest a node from its chunks in order, held one at a time."""
    current, state = None, None

    def done() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([current[0]], pa.int64()), pa.array([current[1]], pa.int64()), pa.array([state.hexdigest()])],
            names=["k1", "k2", "ends_sha256"],
        )

    for batch in batches:
        for k1, k2, chunk in zip(*(batch.column(n) for n in ("k1", "k2", "chunk")), strict=True):
            node = k1.as_py(), k2.as_py()
            if node != current:
                if current is not None:
                    yield done()
                current, state = node, hashlib.sha256()
            else:
                state.update(b",")
            state.update(chunk.as_py())
    if current is not None:
        yield done()


def _subtree_sums(nodes: DataFrame) -> DataFrame:
    """``leaf`` and ``saved`` of each of ``nodes``, summed over all of them below it and itself.

    After ``n`` rounds a node has the sums of descendants less than ``2 ** n`` levels below it, and knows
    its ancestor so many levels above; so the rounds grow with the logarithm of the depth.
    """
    deepest = nodes.agg(F.max("depth")).first()[0] or 0
    sums = nodes.select("k1", "k2", F.when(F.col("depth") > 0, F.col("p1")).alias("u1"), F.when(F.col("depth") > 0, F.col("p2")).alias("u2"), "leaf", "saved")
    sums = stage(sums, "subtree-sums")
    step = 1
    while step <= deepest:
        below = sums.where("u1 IS NOT NULL").groupBy(F.col("u1").alias("k1"), F.col("u2").alias("k2"))
        below = below.agg(F.sum("leaf").alias("_leaf"), F.sum("saved").alias("_saved"))
        up = sums.select(F.col("k1").alias("u1"), F.col("k2").alias("u2"), F.col("u1").alias("_u1"), F.col("u2").alias("_u2"))
        sums = sums.join(below, ["k1", "k2"], "left").join(up, ["u1", "u2"], "left")
        sums = sums.select(
            "k1", "k2", F.col("_u1").alias("u1"), F.col("_u2").alias("u2"),
            (F.col("leaf") + F.coalesce("_leaf", F.lit(0))).alias("leaf"),
            (F.col("saved") + F.coalesce("_saved", F.lit(0))).alias("saved"),
        )
        sums = stage(sums, "subtree-sums")
        step *= 2
    return sums.select("k1", "k2", F.col("leaf").alias("_leaves"), F.col("saved").alias("_tokens"))


RESULT = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def prefix_nodes(lists: DataFrame) -> DataFrame:
    """One row for each distinct beginning of the turn lists, the empty one included.

    ``lists`` has ``conv_id``, unique and not null, and ``turns`` with ``a``, ``b`` and ``words``; lists without
    turns are members of the root. Without any list there is no node. Equal lists share all their nodes and are told
    apart by their ids in ``ends_sha256`` alone, the digest of the ids of those that end at the node.
    """
    spark = lists.sparkSession
    flat = lists.select("conv_id", *(F.col("turns")[c].alias(c) for c in ("a", "b", "words")))
    # Written first, as the sort reads it twice.
    flat = stage(flat, "turn-lists")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = flat.repartitionByRange(parts, "a", "conv_id").sortWithinPartitions("a", "conv_id")
    nodes = stage(order.mapInArrow(_parts, NODE), "prefix-nodes")

    chunks = nodes.where("chunk IS NOT NULL").select("k1", "k2", "conv_id", "chunk")
    chunks = chunks.repartition("k1", "k2").sortWithinPartitions("k1", "k2", "conv_id").select("k1", "k2", "chunk")
    ends = chunks.mapInArrow(_hash_chunks, "k1 long, k2 long, ends_sha256 string")
    merged = nodes.where("open AND chunk IS NULL").groupBy("k1", "k2", "p1", "p2", "depth").agg(
        F.min("conv_id").alias("conv_id"), F.max("words").alias("words"),
        *(F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")),
    )
    merged = stage(merged, "open-nodes")
    below = merged.where("depth > 0").groupBy(F.col("p1").alias("k1"), F.col("p2").alias("k2")).agg(F.count("*").alias("_open"))
    merged = merged.join(below, ["k1", "k2"], "left").withColumn("n_children", F.col("n_children") + F.coalesce("_open", F.lit(0)))
    merged = merged.withColumns({
        "leaf": (F.col("n_children") == 0).cast("long"),
        "saved": (F.col("n_convs") - 1) * F.col("words"),
    })
    merged = stage(merged.drop("_open"), "open-nodes")
    # The parts have the sums over closed nodes; those over open ones, which they lack, are added.
    opened = merged.join(_subtree_sums(merged), ["k1", "k2"]).withColumns({
        "n_leaves": F.col("n_leaves") + F.col("_leaves"),
        "saved_tokens": F.col("saved_tokens") + F.col("_tokens"),
    })
    opened = opened.join(ends, ["k1", "k2"], "left").withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(_NO_ENDS)))

    closed = nodes.where("NOT open")
    named = merged.select(F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("conv_id").alias("_parent"))
    # Children of the root are many and of one key: its id is one number.
    top = merged.where("depth = 0").select("conv_id").first()
    top = F.lit(top[0] if top else None).cast("long")
    lacking = closed.where("parent_conv_id IS NULL AND depth > 1").join(named, ["p1", "p2"], "left")
    closed_parts = (
        closed.where("parent_conv_id IS NOT NULL").select(*RESULT),
        lacking.withColumn("parent_conv_id", F.col("_parent")).select(*RESULT),
        closed.where("depth = 1").withColumn("parent_conv_id", top).select(*RESULT),
    )
    opened = opened.join(named, ["p1", "p2"], "left").withColumn("parent_conv_id", F.when(F.col("depth") > 0, F.col("_parent")))
    out = opened.select(*RESULT)
    for part in closed_parts:
        out = out.union(part)
    return out
