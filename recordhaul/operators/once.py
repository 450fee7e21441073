"""Keeping costly columns from being computed more than once."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def evaluate_once(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """``df`` with the columns ``names`` computed at this point.

    Spark moves a filter below the projection that makes the column it tests, and so
    repeats the column's whole expression, here a JSON parse, in the filter. It does not
    move one below a generator; this one yields a single row.
    """
    others = [name for name in df.columns if name not in names]
    generated = df.select(*others, F.inline(F.array(F.struct(*names))))
    return generated.select(*df.columns)
