"""Secret scan: strong patterns, and weak candidates that are reported where their parts meet.

A scope is a paragraph of a text: what stands between blank lines. Within it three kinds of parts are
looked for: access identifiers, secrets and endpoints. Each by itself may be harmless (a host name, a
user name, a short password), so it is weak. The parts of a scope are joined by interval: a weak part
is reported if a part of a complementary kind begins in the same scope (and, where a ``reach`` is given, within
so many code points of it). Access keys and assignments of the strong patterns are such parts as well; a run of
hexadecimal digits alone is none, as commit ids and check sums are such runs too.

Both sides of that join lie in one text, so it needs no shuffle: the intervals of a row are sorted and
looked up in its task. A text with very many parts costs their number times its logarithm, and a row
holds only the spans found.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: The strong kinds, in the order in which spans at one place are listed.
ASSIGN = re.compile(
    r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
    re.IGNORECASE | re.ASCII,
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")
ASSIGN_CHARS, ACCESS_CHARS = 12, 18

#: Weak parts by role; group 1, where there is one, is what counts.
WEAK = {
    "identifier": re.compile(
        r"\b(?:user(?:name)?|login|account|client_?id|access_?key(?:_?id)?)[\"']?\x20*[:=]\x20*[\"']?"
        r"([A-Za-z0-9+/_.@-]{3,})",
        re.IGNORECASE | re.ASCII,
    ),
    "secret": re.compile(
        r"\b(?:password|passwd|pwd|pass|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?"
        r"([A-Za-z0-9+/_.=!@#$%^&*-]{4,})"
        # 40 characters among which are a digit, a small and a capital letter
        r"|(?-i:(?<![A-Za-z0-9+/=_-])(?=[A-Za-z/+]*[0-9])(?=[A-Z0-9/+]*[a-z])(?=[a-z0-9/+]*[A-Z])"
        r"([A-Za-z0-9+/]{40})(?![A-Za-z0-9+/_-]))",
        re.IGNORECASE | re.ASCII,
    ),
    "endpoint": re.compile(
        r"\b(?:https?|ftp|jdbc:[a-z]+|postgres(?:ql)?|mysql|mongodb|redis|amqp|s3)://[^\s\"'<>|]+"
        r"|\b(?:host|endpoint|server)[\"']?\x20*[:=]\x20*[\"']?[A-Za-z0-9.-]{3,}(?::[0-9]{2,5})?",
        re.IGNORECASE | re.ASCII,
    ),
}
#: What a part needs beside it.
COMPLEMENTS = {
    "identifier": ("secret",),
    "secret": ("identifier", "endpoint"),
    "endpoint": ("secret",),
}
_BLANK = re.compile(r"\n[\x20\t]*\n")
_HINTS = re.compile(r"[=:]|AKIA|[A-Za-z0-9+/]{40}")

KINDS = ("assign", "access", "hex", *(f"linked_{role}" for role in WEAK))


def strong_spans(text: str) -> list[tuple[int, int, int]]:
    """``(start, kind, end)`` of the strong patterns, by start and then kind."""
    spans = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_CHARS]
    spans += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= ACCESS_CHARS]
    spans += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(spans)


def linked_spans(
    text: str, strong: list[tuple[int, int, int]], reach: int | None = None
) -> list[tuple[int, int, int]]:
    """Weak parts with a complementary one in their scope, and within reach, as ``strong_spans``."""
    parts = {role: [m.span() for m in pattern.finditer(text)] for role, pattern in WEAK.items()}
    access = [(start, end) for start, kind, end in strong if kind == 1]
    hidden = [(start, end) for start, kind, end in strong if kind == 0]
    sides = {
        "identifier": sorted(parts["identifier"] + access),
        "secret": sorted(parts["secret"] + hidden),
        "endpoint": parts["endpoint"],
    }
    begins = {role: [start for start, _ in found] for role, found in sides.items()}
    cuts = [m.start() for m in _BLANK.finditer(text)]
    covered = {(start, end) for start, _, end in strong}
    out = []
    for kind, role in enumerate(WEAK, 3):
        for start, end in parts[role]:
            if (start, end) in covered:
                continue
            at = bisect_right(cuts, start)
            low = cuts[at - 1] if at else 0
            high = cuts[at] if at < len(cuts) else len(text)
            if reach is not None:
                low, high = max(start - reach, low), min(end + reach, high)
            for other in COMPLEMENTS[role]:
                n = bisect_left(begins[other], low)
                if n < len(begins[other]) and begins[other][n] < high:
                    out.append((start, kind, end))
                    break
    return out


def scan_secrets(documents: DataFrame, reach: int | None = None) -> DataFrame:
    """``doc_id``, the spans and their counts by kind for every row.

    ``spans`` is an array of ``(kind, start, end)`` by start, in code points, the end exclusive; a
    kind of ``KINDS`` that begins with ``linked_`` comes from the join. ``base`` has those of the strong
    patterns alone. Null and empty texts have no span, repeated rows equal ones, an empty table no row. Other columns
    are not looked at.
    """
    span = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])
    counts = ["n_assign", "n_access", "n_hex", "n_linked"]

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            base, every, numbers = [], [], []
            for value in batch.column("text"):
                text = value.as_py() or ""
                strong = strong_spans(text)
                linked = linked_spans(text, strong, reach) if _HINTS.search(text) else []
                kinds = [kind for _, kind, _ in strong]
                numbers.append([*(kinds.count(n) for n in range(3)), len(linked)])
                named = lambda found: [{"kind": KINDS[k], "start": s, "end": e} for s, k, e in found]
                base.append(named(strong))
                every.append(named(sorted(strong + linked)))
            columns = list(zip(*numbers, strict=True)) or [()] * 4
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    *(pa.array(c, pa.int64()) for c in columns),
                    pa.array(base, pa.list_(span)),
                    pa.array(every, pa.list_(span)),
                ],
                names=["doc_id", *counts, "base", "spans"],
            )

    spans = "array<struct<kind: string, start: long, end: long>>"
    schema = "doc_id long, " + ", ".join(f"{c} long" for c in counts) + f", base {spans}, spans {spans}"
    return documents.select(F.col("doc_id").cast("long"), "text").mapInArrow(make, schema)


def span_list(spans: str):
    """An array of spans as ``kind:start:end``, comma-joined."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
    )
