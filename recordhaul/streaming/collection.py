"""A collection of documents kept as levels of sorted runs, by bucket of the id.

    root/runs/<level>-<from>-<through>/bucket=<b>/   states of the changes of those batches
    root/base/<serial>-<through>/bucket=<b>/         documents after batch <through>
    root/merged/<serial>-<through>/bucket=<b>        names the buckets of that base, empty ones too
    root/dead_letters/, root/totals/                 one folder per batch

A micro-batch writes one run of level 0, with folders of the buckets that it touched. ``compact``
folds ``fanout`` runs of a level into one of the next. ``merge_base`` writes a new base generation of
those buckets only whose changes have grown to a share of what their base holds; every other bucket keeps
its files. Reading folds the buckets that have changes and passes the others through. So
each of them costs what changed, and never what the collection holds.

A run or generation counts from its ``_SUCCESS`` marker on and is never changed, so whatever
breaks off leaves the last state, and readers need no lock. ``clean_up`` removes what finished newer
ones have replaced. The driver handles names of runs and buckets only.
"""

from __future__ import annotations

import json
import re
from collections import defaultdict
from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recordhaul.operators.folding import (
    change_states,
    decode_changes,
    documents_of,
    fold_states,
    settled_states,
)
from recordhaul.operators.messages import split_dead_letters, sync_totals
from recordhaul.schemas import ARTICLE_MAPPING, mapping_fields
from recordhaul.session import file_sizes, finished, matches, remove
from recordhaul.sources.messages import spread

BUCKETS = 64
FANOUT = 4
#: A bucket's base is written anew when its changes have this share of its bytes.
SHARE = 0.25


@dataclass(frozen=True)
class Run:
    level: int
    first: int
    through: int
    path: str
    buckets: frozenset[int] = field(default=frozenset(), compare=False)


@dataclass(frozen=True, order=True)
class Generation:
    serial: int
    through: int


@dataclass
class Layout:
    """What of a collection counts: runs that no other one holds, and each bucket's newest base."""

    runs: list[Run]
    base: dict[int, Generation]
    replaced: list[str]  # folders that hold nothing that counts
    serials: int  # generations begun so far

    def pending(self, run: Run) -> set[int]:
        """Buckets of a run whose base is older."""
        return {b for b in run.buckets if b not in self.base or self.base[b].through < run.through}

    @property
    def touched(self) -> set[int]:
        return set().union(*(self.pending(run) for run in self.runs))


def _bucket(path: str) -> int:
    return int(re.search(r"bucket=(\d+)", path)[1])


def _generation(path: str) -> Generation:
    return Generation(*map(int, re.search(r"/(?:base|merged)/(\d+)-(\d+)", path).groups()))


def layout(spark: SparkSession, root: str) -> Layout:
    """Read from the names of finished folders."""
    found: dict[str, set[int]] = defaultdict(set)
    for path in matches(spark, f"{root}/runs/*/bucket=*"):
        found[path.rsplit("/", 1)[0]].add(_bucket(path))
    runs = []
    for mark in matches(spark, f"{root}/runs/*/_SUCCESS"):
        path = mark.rsplit("/", 1)[0]
        level, first, through = map(int, path.rsplit("/", 1)[1].split("-"))
        runs.append(Run(level, first, through, path, frozenset(found[path])))
    live = [
        run for run in runs
        if not any(o.level > run.level and o.first <= run.first and run.through <= o.through for o in runs)
    ]
    done = {_generation(mark) for mark in matches(spark, f"{root}/base/*/_SUCCESS")}
    base: dict[int, Generation] = {}
    for mark in matches(spark, f"{root}/merged/*/bucket=*"):
        bucket, made = _bucket(mark), _generation(mark)
        if made in done:
            base[bucket] = max(base.get(bucket, made), made)
    begun = [_generation(path).serial for path in matches(spark, f"{root}/merged/*")]
    out = Layout(sorted(live, key=lambda r: r.first), base, [], max(begun, default=0))
    out.replaced += [run.path for run in runs if run not in live or (run.buckets and not out.pending(run))]
    for path in matches(spark, f"{root}/base/*/bucket=*"):
        made = _generation(path)
        if made in done and base[_bucket(path)] != made:
            out.replaced.append(path)
    return out


@dataclass
class Settings:
    """Fixed by the first batch."""

    buckets: int
    schema: T.StructType  # of states


def _settings(spark: SparkSession, root: str, buckets: int = BUCKETS, states: DataFrame | None = None) -> Settings:
    path = f"{root}/settings"
    if states is not None and not finished(spark, path):
        row = [(buckets, states.schema.json())]
        spark.createDataFrame(row, "buckets int, states string").write.mode("overwrite").parquet(path)
    if not finished(spark, path):
        raise ValueError(f"nothing has been synchronised to {root}")
    row = spark.read.parquet(path).first()
    return Settings(row["buckets"], T.StructType.fromJson(json.loads(row["states"])))


def _write(states: DataFrame, path: str, buckets: int, fields: list[str], bottom: bool = False) -> None:
    """Folded states in a folder per bucket, sorted by id; a bucket is one task's.

    The fold runs on the map side first; what it leaves is dealt out by bucket.
    """
    placed = states.withColumn("bucket", F.pmod(F.xxhash64("_id"), F.lit(buckets)).cast("int"))
    folded = fold_states(placed, fields, ("bucket", "_id"))
    if bottom:
        folded = settled_states(folded, fields)
    dealt = folded.repartition("bucket").sortWithinPartitions("bucket", "_id")
    dealt.write.mode("overwrite").partitionBy("bucket").parquet(path)


def _read(spark: SparkSession, path: str, buckets: set[int], schema: T.StructType) -> DataFrame:
    """Some buckets of a run or generation; the others' files are not opened."""
    every = spark.read.schema(T.StructType([*schema, T.StructField("bucket", T.IntegerType())])).parquet(path)
    return every.filter(F.col("bucket").isin(*sorted(buckets))).drop("bucket")


def _states(spark: SparkSession, parts: list[DataFrame], schema: T.StructType) -> DataFrame:
    return reduce(DataFrame.unionByName, parts) if parts else spark.createDataFrame([], schema)


def _run_parts(spark: SparkSession, known: Layout, runs: list[Run], buckets: set[int], schema: T.StructType) -> list[DataFrame]:
    return [_read(spark, run.path, own, schema) for run in runs if (own := known.pending(run) & buckets)]


def _base_parts(
    spark: SparkSession, root: str, base: dict[int, Generation], buckets: set[int], schema: T.StructType
) -> list[DataFrame]:
    generations: dict[Generation, set[int]] = defaultdict(set)
    for bucket in buckets & base.keys():
        generations[base[bucket]].add(bucket)
    return [
        _read(spark, f"{root}/base/{made.serial}-{made.through}", own, schema)
        for made, own in sorted(generations.items())
    ]


def _fields(schema: T.StructType) -> list[str]:
    return [name.removeprefix("_set_") for name in schema.names if name.startswith("_set_")]


def collection_handler(
    root: str,
    mapping: dict = ARTICLE_MAPPING,
    key: str = "id",
    buckets: int = BUCKETS,
    generate_ids: bool = False,
    compact_every: int | None = None,
) -> Callable[[DataFrame, int], None]:
    """The ``foreachBatch`` function: decode typed changes, fold them, write one run, account.

    A batch that is delivered again replaces its run, or does nothing if its changes are already in a
    higher run or in the base. With ``compact_every``, levels and bases are merged after so many batches.
    An error fails the query, which goes on from its checkpoint when it is started again.
    """
    fields = list(mapping_fields(mapping))

    def handle(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        known = layout(spark, root)
        if any(run.level > 0 and run.first <= batch_id <= run.through for run in known.runs):
            return
        if any(made.through >= batch_id for made in known.base.values()):
            return
        decoded = decode_changes(spread(batch), mapping, key, generate_ids)
        decoded = decoded.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            _, dead = split_dead_letters(decoded.drop("present"))
            dead.write.mode("overwrite").parquet(f"{root}/dead_letters/batch_id={batch_id}")
            sync_totals(decoded).write.mode("overwrite").parquet(f"{root}/totals/batch_id={batch_id}")
            states = change_states(decoded, fields)
            count = _settings(spark, root, buckets, states).buckets
            _write(states, f"{root}/runs/0-{batch_id}-{batch_id}", count, fields)
        finally:
            decoded.unpersist()
        if compact_every and (batch_id + 1) % compact_every == 0:
            compact(spark, root)
            merge_base(spark, root)

    return handle


def compact(spark: SparkSession, root: str, fanout: int = FANOUT) -> list[str]:
    """Fold each ``fanout`` runs of a level, oldest first, into one of the next; returns the new runs.

    Only buckets that are in those runs and not yet in a base are read and written. Tombstones stay, as
    what they hide may lie below.
    """
    made: list[str] = []
    while True:
        known = layout(spark, root)
        levels: dict[int, list[Run]] = defaultdict(list)
        for run in known.runs:
            levels[run.level].append(run)
        full = sorted(level for level, runs in levels.items() if len(runs) >= fanout)
        if not full:
            return made
        merged = levels[full[0]][:fanout]
        kept = _settings(spark, root)
        parts = _run_parts(spark, known, merged, known.touched, kept.schema)
        path = f"{root}/runs/{full[0] + 1}-{merged[0].first}-{merged[-1].through}"
        _write(_states(spark, parts, kept.schema), path, kept.buckets, _fields(kept.schema))
        made.append(path)


def _bytes(spark: SparkSession, folder: str) -> dict[int, int]:
    out: dict[int, int] = defaultdict(int)
    for path, size in file_sizes(spark, f"{folder}/bucket=*/part-*").items():
        out[_bucket(path)] += size
    return out


def merge_base(spark: SparkSession, root: str, share: float = SHARE) -> set[int]:
    """Write a new base of the buckets whose changes have ``share`` of its bytes; returns them.

    Tombstones and patches of documents that are not there end here.
    """
    known = layout(spark, root)
    if not known.runs:
        return set()
    through = max(run.through for run in known.runs)
    changed: dict[int, int] = defaultdict(int)
    for run in known.runs:
        sizes = _bytes(spark, run.path)
        for bucket in known.pending(run):
            changed[bucket] += sizes[bucket]
    paths = {made: f"{root}/base/{made.serial}-{made.through}" for made in known.base.values()}
    held = {made: _bytes(spark, path) for made, path in paths.items()}
    due = {
        bucket for bucket, size in changed.items()
        if bucket not in known.base or size >= share * held[known.base[bucket]][bucket]
    }
    if not due:
        return due
    kept = _settings(spark, root)
    parts = _run_parts(spark, known, known.runs, due, kept.schema)
    parts += _base_parts(spark, root, known.base, due, kept.schema)
    # Named before it counts: the generation's marker makes both count.
    name = f"{known.serials + 1}-{through}"
    for bucket in sorted(due):
        _touch(spark, f"{root}/merged/{name}/bucket={bucket}")
    fields = _fields(kept.schema)
    _write(_states(spark, parts, kept.schema), f"{root}/base/{name}", kept.buckets, fields, bottom=True)
    return due


def _touch(spark: SparkSession, path: str) -> None:
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    files.create(place, True).close()


def clean_up(spark: SparkSession, root: str) -> list[str]:
    """Remove runs and bases that newer finished ones have replaced; readers of them must be done."""
    gone = layout(spark, root).replaced
    for path in gone:
        remove(spark, path)
    return gone


def collection(spark: SparkSession, root: str) -> DataFrame:
    """The documents as they stand.

    Buckets without changes are scanned and pass; those with changes are folded.
    """
    kept = _settings(spark, root)
    known = layout(spark, root)
    touched, fields = known.touched, _fields(kept.schema)
    quiet = _base_parts(spark, root, known.base, set(known.base) - touched, kept.schema)
    changed = _run_parts(spark, known, known.runs, touched, kept.schema)
    changed += _base_parts(spark, root, known.base, touched, kept.schema)
    folded = fold_states(_states(spark, changed, kept.schema), fields)
    return reduce(DataFrame.unionByName, [documents_of(part, fields) for part in (folded, *quiet)])
