"""Strict JSON, one value per line.

Spark's JSON functions stop at the end of the first value and so accept text after
it. A line is therefore parsed in two frames, ``{"v":LINE}`` and ``{"v":[LINE]}``.
Text that closes one frame early breaks the other: what follows a value must be a
``"key":value`` in the first and must not be one in the second.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_BAD = "_bad"

# JSON's own rules for quotes, numbers, white space and nesting.
STRICT_OPTIONS = {
    "mode": "PERMISSIVE",
    "columnNameOfCorruptRecord": _BAD,
    "allowSingleQuotes": "false",
    "allowNonNumericNumbers": "false",
    "maxNestingDepth": "10000",
    "maxNumLen": "2147483647",
    "maxStringLen": "2147483647",
}
JSON_SPACE = " \t\r\n"


def _framed(col: Column, before: str, after: str, schema: str) -> Column:
    text = F.concat(F.lit(before), col, F.lit(after))
    return F.from_json(text, schema, STRICT_OPTIONS)


def is_single_value(col: Column) -> Column:
    """The array frame. A blank line passes it; the object frame refuses that."""
    return _framed(col, '{"v":[', "]}", f"{_BAD} STRING")[_BAD].isNull()


def is_strict_json(col: Column) -> Column:
    """True when ``col`` holds exactly one JSON value.

    Neither frame asks for a field that is in it, so values are skipped, not built.
    """
    in_object = _framed(col, '{"v":', "}", f"{_BAD} STRING")[_BAD].isNull()
    return F.coalesce(in_object & is_single_value(col), F.lit(False))


def parse_object(col: Column, fields: list[str]) -> Column:
    """The object frame: the named fields as VARIANT under ``v``.

    ``parsed_well`` holds for an object and for a lone ``null``. Combine with
    ``is_single_value`` to refuse text after the value.
    """
    inner = ", ".join(f"`{name}`: VARIANT" for name in fields)
    return _framed(col, '{"v":', "}", f"v STRUCT<{inner}>, {_BAD} STRING")


def parsed_well(parsed: Column) -> Column:
    return parsed[_BAD].isNull()


def opens_object(col: Column) -> Column:
    return F.ltrim(col, F.lit(JSON_SPACE)).startswith("{")


def repair_surrogates(col: Column) -> Column:
    """Turn escapes of half a surrogate pair into the escape of U+FFFD."""
    high, low = r"\\u[dD][89abAB][0-9a-fA-F]{2}", r"\\u[dD][c-fC-F][0-9a-fA-F]{2}"
    start = r"(?<!\\)((?:\\\\)*)"
    fixed = F.regexp_replace(col, rf"{start}{high}(?!{low})", r"$1\\ufffd")
    fixed = F.regexp_replace(fixed, rf"(?<!{high}){start}{low}", r"$1\\ufffd")
    return F.when(col.contains("\\ud") | col.contains("\\uD"), fixed).otherwise(col)


def exact_names(col: Column, fields: list[str]) -> Column:
    """Names of ``fields`` in other cases, at any depth, written as in ``fields``.

    In a JSON text a quote without a backslash before it, a name, a quote and a colon are always the name of
    a member: a quote inside of a string has a backslash, and no colon follows a value. Texts without
    such names, nearly all, are only searched, once. Of members whose names then are equal the last counts,
    as of repeated ones. Escapes within a name are not undone.
    """
    exact = "|".join(fields)
    odd = rf'(?<!\\)"(?!(?:{exact})")(?iu:{exact})"[ \t\r\n]*:'
    renamed = col
    for name in fields:
        renamed = F.regexp_replace(
            renamed, rf'(?<!\\)"(?iu:{name})"(?=[ \t\r\n]*:)', f'"{name}"'
        )
    return F.when(col.rlike(odd), renamed).otherwise(col)


def is_blank(col: Column) -> Column:
    return F.ltrim(col, F.lit(JSON_SPACE)) == ""


def variant_kind(col: Column) -> Column:
    """Type name of a VARIANT field: null when it is absent, VOID when it is null."""
    return F.schema_of_variant(col)


def is_kind(kind: Column, wanted: str) -> Column:
    """True for the type itself, for null and for an absent field."""
    return kind.isNull() | kind.isin(wanted, "VOID")


def is_filled(kind: Column) -> Column:
    return F.coalesce(kind != "VOID", F.lit(False))


def is_number_kind(kind: Column) -> Column:
    return F.coalesce(kind.rlike("^(BIGINT|DECIMAL|DOUBLE|FLOAT)"), F.lit(False))


def is_scalar_kind(kind: Column) -> Column:
    return F.coalesce(~kind.rlike("^(OBJECT|ARRAY)"), F.lit(True))


def as_text(col: Column) -> Column:
    return F.try_variant_get(col, "$", "string")


def as_bigint(col: Column) -> Column:
    return F.try_variant_get(col, "$", "bigint")
