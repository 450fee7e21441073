"""Line, near-duplicate and sentence-span de-duplication against brute force."""

from __future__ import annotations

import re
from collections import defaultdict

import pyarrow as pa
import pytest

from recordhaul.llm import minhash
from recordhaul.llm.line_dedup import drop_shared_lines
from recordhaul.llm.minhash import near_duplicates
from recordhaul.llm.sentence_spans import LONG, MIN_WORDS, PASSAGE, WINDOW, drop_repeated_spans
from recordhaul.llm.shingles import word_hashes
from tests.llm.cases import PROSE, clashing, documents, texts

SF = "/root/testdata/sf0.001"


def _links(sets, percent):
    parent = {k: k for k in sets}

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k

    keys = sorted(sets)
    for n, a in enumerate(keys):
        for b in keys[:n]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return {k: root(k) for k in keys}


def _shingles(text, size):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))
    if not words:
        return frozenset()
    width = min(size, len(words))
    return frozenset(tuple(words[n : n + width]) for n in range(len(words) - width + 1))


@pytest.mark.parametrize(("size", "percent"), [(3, 85), (5, 80)])
def test_near_duplicates_equal_brute_force(spark, size, percent):
    table = spark.read.parquet(f"{SF}/documents.parquet")
    sets = {k: _shingles(t, size) for k, t in texts(table).items()}
    expected = _links(sets, percent)
    found = {r["doc_id"]: r for r in near_duplicates(table, size, percent).collect()}
    assert {k: r["component_id"] for k, r in found.items()} == expected
    assert {k: r["n_shingles"] for k, r in found.items()} == {k: len(s) for k, s in sets.items()}
    assert all(r["kept"] == (k == expected[k]) for k, r in found.items())


def test_large_group_of_near_copies_in_blocks(spark, monkeypatch):
    words = [f"w{n}" for n in range(120)]
    rows = []
    for n in range(120):
        changed = list(words)
        for at in range(0, n % 9):
            changed[(7 * n + 13 * at) % 120] = f"x{n}_{at}"
        rows.append((n, " ".join(changed), "en", "s", 0))
    monkeypatch.setattr(minhash, "BLOCK", 16)
    table = documents(spark, rows)
    expected = _links({r[0]: _shingles(r[1], 3) for r in rows}, 85)
    found = {r["doc_id"]: r["component_id"] for r in near_duplicates(table, 3, 85).collect()}
    assert found == expected


def test_near_duplicates_take_awkward_rows(spark):
    rows = near_duplicates(clashing(documents(spark))).collect()
    of = defaultdict(list)
    for row in rows:
        of[row["doc_id"]].append(row)
    assert len(rows) == 11
    assert [r["component_id"] for r in of[5]] == [1, 1]
    assert not any(r["kept"] for r in of[5])
    assert of[2][0]["component_id"] == 2 and of[2][0]["n_shingles"] == 0 and of[2][0]["kept"]
    assert of[4][0]["kept"] and of[6][0]["n_shingles"] == 1 and of[7][0]["n_shingles"] == 1
    assert near_duplicates(documents(spark, [])).collect() == []


def test_line_dedup_takes_awkward_rows(spark):
    line = "A line of more than forty code points, that is shared."
    rows = [(n, f"  {line.upper() if n % 2 else line}\t\nown {n}\n{line}", "en", "s", 0) for n in range(5)]
    rows += [(9, None, "en", "s", 0), (10, "", "en", "s", 0), (None, f"{line}", "en", "s", 0)]
    rows += [rows[0]]
    out = drop_shared_lines(clashing(documents(spark, rows)))
    found = defaultdict(list)
    for r in out.collect():
        found[r["doc_id"]].append((r["text"], r["n_lines"], r["n_dropped"]))
    assert found[0] == [("own 0", 3, 2)] * 2
    assert found[4] == [(rows[4][1], 3, 0)]
    assert found[9] == found[10] == [("", 1, 0)]
    assert found[None] == [(line, 1, 0)]
    assert drop_shared_lines(documents(spark, [])).collect() == []


def test_lines_in_few_documents_stay(spark):
    line = "x" * 40
    rows = [(n % 4, f"{line}\n{line}", "en", "s", 0) for n in range(8)]
    assert {r["n_dropped"] for r in drop_shared_lines(documents(spark, rows)).collect()} == {0}
    short = [(n, "x" * 39, "en", "s", 0) for n in range(8)]
    assert {r["n_dropped"] for r in drop_shared_lines(documents(spark, short)).collect()} == {0}


def _spans(text):
    """Start, words and sentence of each piece, cut word by word."""
    out = []
    for number, match in enumerate(re.finditer(r"(?:[^.!?\n]|[.!?](?![\x20\x09-\x0D]|\Z))*(?:[.!?](?=[\x20\x09-\x0D]|\Z)|\n|\Z)", text)):
        found = list(re.finditer(r"[^\x20\x09-\x0D]+", match[0]))
        words = [re.sub("[A-Z]", lambda m: m[0].lower(), w[0]) for w in found]
        ends = {len(words) - 1}
        if len(words) > LONG:
            order = next(word_hashes(pa.array([" ".join(words)]))).tolist()
            for n in range(len(words) - WINDOW + 1):
                ends.add(min(range(n, n + WINDOW), key=lambda k: (order[k], -k)))
        begin = 0
        for end in sorted(ends) if words else ():
            out.append((match.start() + found[begin].start(), words[begin : end + 1], number, len(words)))
            begin = end + 1
    return out


def _runs(pieces):
    """Every shortest run from a piece, and every shortest one to a piece that none of those ends at."""
    def enough(a, b):
        words = sum(len(p[1]) for p in pieces[a : b + 1])
        return words >= MIN_WORDS and (pieces[a][2] != pieces[b][2] or pieces[a][3] > PASSAGE)

    size = range(len(pieces))
    ahead = [(a, b) for a in size if (b := next((b for b in size[a:] if enough(a, b)), None)) is not None]
    ends = {b for _, b in ahead}
    back = [(a, b) for b in size if b not in ends and (a := next((a for a in size[b::-1] if enough(a, b)), None)) is not None]
    return ahead + back


def test_repeated_spans_equal_brute_force(spark):
    table = spark.read.parquet(f"{SF}/documents.parquet").where("length(text) < 20000")
    every = texts(table)
    cut = {key: _spans(text) for key, text in every.items()}
    held = {key: [(tuple(w for p in found[a : b + 1] for w in p[1]), a, b) for a, b in _runs(found)] for key, found in cut.items()}
    first, count = {}, defaultdict(int)
    for key in sorted(every):
        for run, a, _ in sorted(held[key], key=lambda x: x[1]):
            first.setdefault(run, (key, a))
            count[run] += 1
    out = {r["doc_id"]: r for r in drop_repeated_spans(table).collect()}
    assert any(r["n_removed"] for r in out.values())
    for key, text in every.items():
        gone = {k for run, a, b in held[key] if first[run] != (key, a) for k in range(a, b + 1)}
        starts = [p[0] for p in cut[key]] + [len(text)]
        kept = text[: starts[0]] + "".join(text[starts[n] : starts[n + 1]] for n in range(len(starts) - 1) if n not in gone)
        assert (out[key]["n_removed"], out[key]["text"]) == (len(gone), kept)


def test_a_single_shared_sentence_stays(spark):
    for size in (17, 24):
        shared = " ".join(f"shared{n}" for n in range(size)) + "."
        rows = [(n, f"Document {n} begins. {shared} It ends {n}.", "en", "s", 0) for n in range(3)]
        assert {r["n_removed"] for r in drop_repeated_spans(documents(spark, rows)).collect()} == {0}
    shared = " ".join(f"shared{n}" for n in range(40)) + "."
    rows = [(n, f"Document {n} begins. {shared} It ends {n}.", "en", "s", 0) for n in range(3)]
    assert [r["n_removed"] > 0 for r in drop_repeated_spans(documents(spark, rows)).orderBy("doc_id").collect()] == [False, True, True]


def test_passage_goes_from_all_but_the_first(spark):
    lead = lambda n: f"Document {n} begins with words of its own, number {n}. "
    rows = [(n, lead(n) + PROSE + f"And {n} ends so.", "en", "s", 0) for n in range(6)]
    out = {r["doc_id"]: r["text"] for r in drop_repeated_spans(documents(spark, rows)).collect()}
    assert out[0] == rows[0][1]
    assert all(out[n] == lead(n) + f"And {n} ends so." for n in range(1, 6))


def test_passage_without_full_stops_goes_too(spark):
    passage = " ".join(f"word{n}" for n in range(80))
    rows = [(n, f"start {n} {passage} end {n}", "en", "s", 0) for n in range(2)]
    out = {r["doc_id"]: r["text"] for r in drop_repeated_spans(documents(spark, rows)).collect()}
    assert out[0] == rows[0][1]
    assert len(out[1].split()) < 40


def _shared_words(passage, before, after):
    """Words of the passage that two texts, which hold it, have in equal runs."""
    found = []
    for n in range(2):
        cut = _spans(f"{before[n]} {passage} {after[n]}")
        found.append((cut, {tuple(w for p in cut[a : b + 1] for w in p[1]): (a, b) for a, b in _runs(cut)}))
    (_, one), (cut, other) = found
    covered = {k for key, (a, b) in other.items() if key in one for k in range(a, b + 1)}
    return sum(len(cut[k][1]) for k in covered)


@pytest.mark.parametrize("distinct", [2, 3, 10, 1000])
@pytest.mark.parametrize("stops", [0, 5, 13, 18, 23])
def test_every_passage_of_51_words_is_found(distinct, stops):
    for trial in range(100):
        name = lambda n, k: f"{'abcd'[k]}{trial}x{n}"  # noqa: B023, E731
        passage = [name(n * n * 7 % 997 % distinct, 0) for n in range(51)]
        for n in range(trial % max(stops, 1), 51, stops or 99):
            passage[n] += "." if stops else ""
        # Texts of other words around it, so that it begins and ends in the middle of sentences.
        before = [" ".join(name(n, k) for n in range(trial % 19 + 5 * k)) for k in (1, 2)]
        after = [" ".join(name(n, k) for n in range(50, 50 + trial % 13 + 7 * k)) for k in (1, 2)]
        assert _shared_words(" ".join(passage), before, after) >= MIN_WORDS


def test_repeated_spans_take_awkward_rows(spark):
    out = drop_repeated_spans(clashing(documents(spark))).collect()
    found = defaultdict(list)
    for r in out:
        found[r["doc_id"]].append(r["text"])
    # The row without a doc_id comes first, so its passage goes from the others.
    assert found[None] == [PROSE] and found[1] == [""] and found[5] == ["", ""]
    assert found[2] == found[3] == [""] and found[6] == ["one"]
    assert drop_repeated_spans(documents(spark, [])).collect() == []
