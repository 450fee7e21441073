"""Count, and optionally validate, the records of a folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from recordhaul.operators import stats
from recordhaul.sources.lines import list_files, read_lines


def directory_statistics(
    spark: SparkSession, directory: str, validate: bool = False, pattern: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """(one row per file, one summary row) of all JSON-lines files below ``directory``."""
    lines = read_lines(spark, directory, recursive=True, pattern=pattern, skip_unreadable=True)
    files = list_files(spark, directory, recursive=True, pattern=pattern)
    counts = stats.json_counts(lines, sized=True) if validate else stats.line_counts(lines, sized=True)
    per_file = stats.with_all_files(counts, files)
    summary = stats.json_summary(per_file) if validate else stats.line_count_summary(per_file)
    return per_file, summary
