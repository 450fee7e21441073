"""Text cleaning and tokens."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from recordhaul.schemas import TITLE_LENGTH

# The characters with the Unicode White_Space property.
WHITE_SPACE = (
    "\t\n\v\f\r \u0085\u00a0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

_REPLACEMENT = "\ufffd"
_ESCAPE = "\ufdd0"

# Code points at which a text may hold such scripts; a quick test before the exact one.
_CJK_PLANES = r"[\x{1100}-\x{11ff}\x{2e80}-\x{d7ff}\x{f900}-\x{ffdc}\x{16fe0}-\x{3ffff}]"
_CJK = r"\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsHangul}"


def trim_space_left(col: Column) -> Column:
    return F.ltrim(col, F.lit(WHITE_SPACE))


def trim_space(col: Column) -> Column:
    """Strip Unicode white space from both ends.

    The built-in right trim walks the whole text, so it is used only where the last
    character is one to be removed, which is a comparison of a few bytes.
    """
    left = trim_space_left(col)
    ends_in_space = F.lit(False)
    for space in WHITE_SPACE:
        ends_in_space = ends_in_space | left.endswith(space)
    return F.when(ends_in_space, F.rtrim(left, F.lit(WHITE_SPACE))).otherwise(left)


def drop_invalid_utf8(col: Column) -> Column:
    """Remove bytes that are not valid UTF-8.

    The built-in repair puts U+FFFD in their place, so U+FFFD that was really in the
    text is escaped first and restored after the inserted ones have been removed.
    """
    escaped = F.replace(col, F.lit(_ESCAPE), F.lit(_ESCAPE + "0"))
    escaped = F.replace(escaped, F.lit(_REPLACEMENT), F.lit(_ESCAPE + "1"))
    cleaned = F.replace(F.make_valid_utf8(escaped), F.lit(_REPLACEMENT), F.lit(""))
    restored = F.replace(cleaned, F.lit(_ESCAPE + "1"), F.lit(_REPLACEMENT))
    restored = F.replace(restored, F.lit(_ESCAPE + "0"), F.lit(_ESCAPE))
    return F.when(F.is_valid_utf8(col), col).otherwise(restored)


def strip_nul(col: Column) -> Column:
    return F.replace(col, F.lit("\x00"), F.lit(""))


def title_of(content: Column) -> Column:
    """The first code points of the content."""
    return F.left(content, F.lit(TITLE_LENGTH))


def first_non_empty(content: Column, fallback: Column) -> Column:
    """``content``, or ``fallback`` where it is empty or missing, or the empty string."""
    return F.coalesce(F.nullif(content, F.lit("")), fallback, F.lit(""))


def tokens(col: Column) -> Column:
    """Lower-cased runs of letters and digits, in text order, repeats kept.

    Scripts written without spaces are cut into single characters and overlapping
    pairs instead, so that any two-character word can be found.
    """
    lowered = F.lower(col)
    words = F.array_remove(F.split(lowered, r"[^\p{L}\p{N}]+"), "")
    runs = F.regexp_extract_all(
        lowered, F.lit(rf"[{_CJK}]+|[\p{{L}}\p{{N}}&&[^{_CJK}]]+"), F.lit(0)
    )

    def cut(run: Column) -> Column:
        size = F.length(run)
        letters = F.transform(F.sequence(F.lit(1), size), lambda i: F.substring(run, i, F.lit(1)))
        pairs = F.transform(
            F.when(size > 1, F.sequence(F.lit(1), size - 1)).otherwise(
                F.array().cast("array<int>")
            ),
            lambda i: F.substring(run, i, F.lit(2)),
        )
        return F.when(run.rlike(rf"^[{_CJK}]"), F.concat(letters, pairs)).otherwise(F.array(run))

    beyond_ascii = F.octet_length(col) > F.length(col)
    return (
        F.when(col.isNull(), F.array().cast("array<string>"))
        .when(beyond_ascii & col.rlike(_CJK_PLANES), F.flatten(F.transform(runs, cut)))
        .otherwise(words)
    )
