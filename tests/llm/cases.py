"""Small tables with the awkward rows that every operator has to take."""

from __future__ import annotations

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
LABELS = "doc_id long, quality int, toxic int"

PROSE = (
    "The river runs past the old mill, and in spring the children come down to throw stones. "
    "Nobody remembers who built the bridge. It has stood there, they say, since before the war. "
    "In the evening the lamps are lit one by one and the boats come home with what they caught. "
    "An old man sits by the water and mends his nets while the cat watches the gulls with care.\n"
)

ROWS = [
    (1, PROSE * 2, "en", "a", 1),
    (2, None, "en", "a", None),
    (3, "", "en", None, 0),
    (4, " \n\t ", None, "a", 4),
    (5, PROSE * 2, "en", "a", 1),
    (5, PROSE * 2, "en", "a", 1),
    (6, "one", "en", "a", 3),
    (7, "word " * 30_000, "en", "a", 150_000),
    (8, "é́ ü ß 日本 \U0001f600\r\nEnd\x1c x", "xx", "b", 5),
    (9, "###%%% | && $$$\n" * 40, "en", "b", 5),
    (None, PROSE, "en", "b", 5),
]


def documents(spark, rows=None):
    return spark.createDataFrame(ROWS if rows is None else rows, SCHEMA)


def clashing(table):
    """The table with columns of names that operators use for themselves."""
    names = ("row", "key", "node", "n_lines", "n_dropped", "n_removed", "part", "borrowed", "rate", "n_tokens", "_row", "_id")
    return table.selectExpr("*", *(f"'x' AS `{n}`" for n in names if n not in table.columns))


def texts(table):
    return {row["doc_id"]: row["text"] or "" for row in table.collect()}
