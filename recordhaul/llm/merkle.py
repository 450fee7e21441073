"""Document fingerprints: a Merkle tree over sections, paragraphs and clauses.

A leaf is a clause with the white space behind it; a paragraph is a line, a section a run of lines.
Each node's hash is made of its children's, so equal roots mean equal texts, equal branches need not be
entered, and differing ones lead to the edit. Where a section or a long clause ends is chosen by the
content just before it, so an insertion changes the branches around it and no others.

A fingerprint is text: the root, and for each section its hash, its paragraphs and their leaves with
their lengths in code points. Trees are made in the task that has the text; only the order of ``doc_id``, in
which a document meets the next one, takes a shuffle of the text.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordhaul.llm.ranges import with_followers

#: One in so many lines ends a section, besides blank lines.
SECTION_ONE_IN = 8
#: In a clause, one in so many words ends a leaf.
LEAF_ONE_IN = 8
#: A leaf has so many words at most.
LEAF_WORDS = 16

_CLAUSE = re.compile(r"[^.,;:!?]*[.,;:!?]*\s*")
_LINE = re.compile(r"[^\n]*\n|[^\n]+")
_WORD = re.compile(r"\S*\s*")


def _leaves(paragraph: str) -> Iterator[str]:
    for clause in _CLAUSE.findall(paragraph):
        if len(clause) <= 40:
            if clause:
                yield clause
            continue
        held = []
        for word in _WORD.findall(clause):
            held.append(word)
            ends = xxhash.xxh3_64_intdigest(word.strip()) % LEAF_ONE_IN == 0
            if ends or len(held) == LEAF_WORDS:
                yield "".join(held)
                held = []
        if last := "".join(held):
            yield last


def fingerprint(text: str | None) -> str:
    """The tree of a text as one string; a null text is an empty one, which has a root alone."""
    text = text or ""
    sections, paragraphs, digests = [], [], []
    top = []

    def close() -> None:
        digest = xxhash.xxh3_128_digest(b"".join(digests))
        top.append(digest)
        sections.append(digest.hex()[:16] + "[" + ";".join(paragraphs) + "]")
        paragraphs.clear()
        digests.clear()

    for line in _LINE.findall(text):
        leaves = [(xxhash.xxh3_128_digest(leaf), len(leaf)) for leaf in _leaves(line)]
        digest = xxhash.xxh3_128_digest(b"".join(d for d, _ in leaves))
        digests.append(digest)
        paragraphs.append(
            digest.hex()[:8] + "=" + ",".join(f"{d.hex()[:8]}{n:x}" for d, n in leaves)
        )
        if not line.strip() or digest[-1] % SECTION_ONE_IN == 0:
            close()
    if paragraphs:
        close()
    return "|".join([xxhash.xxh3_128_hexdigest(b"".join(top)), *sections])


def parse(print_: str) -> tuple[str, list[tuple[str, list[tuple[str, list[tuple[str, int]]]]]]]:
    """Root, and sections of paragraphs of leaves; each with its hash, leaves with their length."""
    root, *sections = print_.split("|")
    out = []
    for section in sections:
        digest, _, body = section.partition("[")
        paragraphs = []
        for paragraph in body[:-1].split(";"):
            name, _, leaves = paragraph.partition("=")
            pairs = [(x[:8], int(x[8:], 16)) for x in leaves.split(",") if x]
            paragraphs.append((name, pairs))
        out.append((digest, paragraphs))
    return root, out


def _unmatched(left: list, right: list) -> tuple[list, list]:
    """What is left of two lists of ``(hash, children)`` once equal hashes are paired off."""
    common = Counter(h for h, _ in left) & Counter(h for h, _ in right)
    out = []
    for side in (left, right):
        open_, rest = dict(common), []
        for node in side:
            if open_.get(node[0], 0):
                open_[node[0]] -= 1
            else:
                rest.append(node)
        out.append(rest)
    return out[0], out[1]


def likeness(one: str, other: str) -> float:
    """The share of code points in equal branches, of the longer text; 1 for equal fingerprints."""
    if one == other:
        return 1.0
    (_, a), (_, b) = parse(one), parse(other)
    length = lambda sections: sum(n for _, ps in sections for _, leaves in ps for _, n in leaves)
    total = max(length(a), length(b))
    a, b = _unmatched(a, b)
    a, b = _unmatched([p for _, ps in a for p in ps], [p for _, ps in b for p in ps])
    a, _ = _unmatched([x for _, xs in a for x in xs], [x for _, xs in b for x in xs])
    differing = sum(n for _, n in a)
    matched = length(parse(one)[1]) - differing
    return max(0.0, min(1.0, matched / total)) if total else 0.0


def edits(old: str, new: str) -> list[tuple[int, int]]:
    """Code points of the new text, as ``(start, end)``, in branches that the old one has not."""
    if old == new:
        return []
    a, b = parse(old)[1], parse(new)[1]
    known_sections = {h for h, _ in a}
    known_paragraphs = {h for _, ps in a for h, _ in ps}
    known = {h for _, ps in a for _, leaves in ps for h, _ in leaves}
    out: list[tuple[int, int]] = []
    at = 0
    for section, paragraphs in b:
        for paragraph, leaves in paragraphs:
            same = section in known_sections or paragraph in known_paragraphs
            for leaf, size in leaves:
                if not same and leaf not in known:
                    if out and out[-1][1] == at:
                        out[-1] = (out[-1][0], at + size)
                    else:
                        out.append((at, at + size))
                at += size
    return out


def edited_fingerprints(documents: DataFrame) -> DataFrame:
    """Fingerprints of every text, of an edited form, and their likeness.

    The edited form has the last quarter of the code points, rounded down, replaced by as many from
    the front of the next document's text, by ascending ``doc_id``; the first follows the last. Null
    texts are empty. Rows that share a ``doc_id`` follow each other by a hash of their text; rows without
    ``doc_id`` come first, and if all are so, the last one's next text is empty. Other columns are
    not looked at.
    """
    names = [
        "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
        "near_edited", "near_next",
    ]
    schema = (
        "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
        "edited_fingerprint string, near_edited double, near_next double"
    )
    layout = pa.schema(
        [("doc_id", pa.int64()), ("n_chars", pa.int64()), *((n, pa.string()) for n in names[2:5]),
         ("near_edited", pa.float64()), ("near_next", pa.float64())]
    )

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # part, doc_id, text and fingerprint of the row whose next one is awaited

        def row(next_text: str, next_print: str) -> dict:
            _, doc_id, text, own = held
            cut = len(text) // 4
            edited = text[: len(text) - cut] + next_text[:cut]
            changed = fingerprint(edited) if edited != text else own
            digest = hashlib.sha256(edited.encode()).hexdigest()
            near = (likeness(own, changed), likeness(own, next_print))
            return dict(zip(names, (doc_id, len(text), digest, own, changed, *near), strict=True))

        for batch in batches:
            out = []
            parts, flags = batch.column("part").to_pylist(), batch.column("borrowed").to_pylist()
            ids = batch.column("doc_id").to_pylist()
            for n, value in enumerate(batch.column("text")):
                text = value.as_py() or ""
                if flags[n] and (held is None or held[0] != parts[n]):
                    continue
                own = fingerprint(text)
                if held is not None:
                    same = held[0] == parts[n]
                    out.append(row(text if same else "", own if same else fingerprint("")))
                held = None if flags[n] else (parts[n], ids[n], text, own)
            yield pa.RecordBatch.from_pylist(out, schema=layout)
        if held is not None:
            yield pa.RecordBatch.from_pylist([row("", fingerprint(""))], schema=layout)

    source = documents.select(F.col("doc_id").cast("long"), "text")
    return with_followers(source, "doc_id", [F.xxhash64("text")]).mapInArrow(make, schema)
