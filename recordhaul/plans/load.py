"""Load a folder of JSON lines into the article table."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from recordhaul.operators.ingest import clean_records, mark_kept, parse_records
from recordhaul.operators.numbering import batch_of, number_lines
from recordhaul.schemas import ARTICLE_FIELDS, BATCH_SIZE
from recordhaul.session import finished, matches, stage
from recordhaul.sinks.manifest import add_to_manifest, partly_loaded, pending_files, read_manifest
from recordhaul.sinks.tables import append_table
from recordhaul.sources.lines import list_files, read_files

REASONS = ["too_long", "malformed", "wrong_type", "empty"]


@dataclass
class LoadReport:
    lines: int
    refused: dict[str, int]
    left: int  # rows that a cap left for the next load
    batches: DataFrame  # file, batch_no, rows


def _first_free_id(spark: SparkSession, path: str, load_id: str) -> int:
    """After the ids of all other loads, so that a load that is run again gives the same ids."""
    own = f"/load_id={load_id}"
    others = [folder for folder in matches(spark, f"{path}/load_id=*") if not folder.endswith(own)]
    others = [folder for folder in others if finished(spark, folder)]
    if not others:
        return 1
    last = spark.read.parquet(*others).agg(F.max("id")).first()[0]
    return (last or 0) + 1


def load_directory(
    spark: SparkSession,
    directory: str,
    table: str,
    manifest: str,
    load_id: str,
    load_ts: Column | None = None,
    max_rows: int | None = None,
    batch_size: int = BATCH_SIZE,
    max_line_bytes: int | None = None,
    pattern: str | None = None,
    recursive: bool = False,
) -> LoadReport | None:
    """Load what the manifest does not name yet; None if there is nothing.

    The text is read and parsed once and written as marked rows; ids, batches and the
    cap come from counts over that table. Rows get ids in file order after those the
    table has. The manifest follows the rows. There is no cap unless ``max_rows`` gives one;
    what it leaves is counted, the manifest says how many rows of a file are in, and the next
    load goes on after them. A line of ``max_line_bytes`` or more is refused, and it alone.
    A load that broke off may be run again under its ``load_id``, which replaces its rows
    and gives them the same ids. Two loads into one table must not run at once.
    """
    files = list_files(spark, directory, recursive, pattern)
    done = read_manifest(spark, manifest)
    pending = pending_files(files, done)
    # As many names as the scan has files; the reader needs them as paths.
    names = [row["file"] for row in pending.select("file").collect()]
    if not names:
        return None
    if finished(spark, f"{manifest}/load_id={load_id}"):
        raise ValueError(f"load {load_id} is complete; new files need a new load_id")
    seen = Observation()
    cleaned = clean_records(parse_records(read_files(spark, names), max_line_bytes), load_ts)
    watched = cleaned.observe(
        seen,
        F.count(F.lit(1)).alias("lines"),
        *[F.count_if(F.col("reason") == reason).alias(reason) for reason in REASONS],
    )
    rows = stage(mark_kept(watched), "load").drop("reason")
    figures = seen.get
    earlier = partly_loaded(done)
    if not earlier.isEmpty():
        in_file = number_lines(rows, within_file=True).join(earlier, "file", "left")
        rows = in_file.filter(F.col("pos") > F.coalesce("taken", F.lit(0))).drop("pos", "taken")
        rows = stage(rows, "load")
    numbered = number_lines(rows)
    kept = numbered if max_rows is None else numbered.filter(F.col("pos") <= max_rows)
    first = _first_free_id(spark, table, load_id)
    articles = kept.select((F.col("pos") + (first - 1)).alias("id"), *ARTICLE_FIELDS)
    append_table(articles, table, load_id=load_id)
    left, noted = 0, pending.select("file", F.lit(None).cast("long").alias("taken"))
    if max_rows is not None:
        counts = numbered.groupBy("file").agg(
            F.count_if(F.col("pos") <= max_rows).alias("new"),
            F.count_if(F.col("pos") > max_rows).alias("over"),
        )
        counts = stage(counts.join(earlier, "file", "left"), "taken")
        left = counts.agg(F.sum("over")).first()[0] or 0
        cut = counts.filter(F.col("over") > 0)
        cut = cut.select("file", (F.coalesce("taken", F.lit(0)) + F.col("new")).alias("taken"))
        noted = noted.join(cut, "file", "left_anti").unionByName(cut)
    add_to_manifest(noted, manifest, load_id)
    in_file = number_lines(rows.select("file", "block_start", "kept_seq"), within_file=True)
    batches = in_file.groupBy(
        "file", batch_of(F.col("pos"), batch_size).alias("batch_no")
    ).agg(F.count(F.lit(1)).alias("rows"))
    return LoadReport(figures["lines"], {name: figures[name] for name in REASONS}, left, batches)
