"""Time stamps."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The accepted shapes of date text, and the time format of input lines.
ISO_DATE = (
    r"^\d{4}(-\d{2}(-\d{2}(T(\d{2}(:\d{2}(:\d{2}([.,]\d{1,9})?)?)?"
    r"(Z|[+-]\d{2}(:?\d{2})?)?)?)?)?)?$"
)
EPOCH_MILLIS = r"^-?\d+$"
RFC3339 = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(\.\d+)?(Z|[+-]\d{2}:\d{2})$"


def truncate_ms(col: Column) -> Column:
    """Cut to milliseconds, towards the past."""
    return F.date_trunc("MILLISECOND", col)


def _completed(col: Column) -> Column:
    """ISO text with the parts filled in that a cast to a time stamp asks for."""
    zone = r"(Z|[+-]\d{2}(?::?\d{2})?)?$"
    text = F.regexp_replace(col, "T" + zone, "T00$1")
    text = F.regexp_replace(text, r"(T\d{2})" + zone, "$1:00$2")
    text = F.regexp_replace(text, r"(T\d{2}:\d{2})" + zone, "$1:00$2")
    text = F.regexp_replace(text, r"(T.*[+-]\d{2})(\d{2})$", "$1:$2")
    text = F.regexp_replace(text, r"(T.*[+-]\d{2})$", "$1:00")
    return F.replace(text, F.lit(","), F.lit("."))


def parse_date(col: Column) -> Column:
    """Time stamp from ISO text with an optional time, or from epoch milliseconds."""
    return (
        F.when(col.rlike(RFC3339), col.try_cast("timestamp"))
        .when(col.rlike(ISO_DATE), _completed(col).try_cast("timestamp"))
        .when(col.rlike(EPOCH_MILLIS), F.timestamp_millis(col.try_cast("bigint")))
    )


def is_rfc3339(col: Column) -> Column:
    """True for a valid RFC 3339 time, and for null."""
    return col.isNull() | (col.rlike(RFC3339) & col.try_cast("timestamp").isNotNull())
