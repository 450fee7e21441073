import json

import pytest
from pyspark.sql import functions as F

from recordhaul.operators import ingest
from recordhaul.plans import load_stream as streamed
from recordhaul.plans.load import load_directory


def now():
    return F.lit("2024-01-01 00:00:00").cast("timestamp")


def clean(spark, lines, **options):
    frame = spark.createDataFrame(
        [(n, bytearray(line if isinstance(line, bytes) else line.encode())) for n, line in enumerate(lines)],
        "n int, b binary",
    ).select("n", F.col("b").cast("string").alias("value"))
    rows = ingest.clean_records(ingest.parse_records(frame, **options), now()).orderBy("n").collect()
    return rows


@pytest.mark.parametrize(
    ("line", "reason"),
    [
        ('{"id":"a","content":"c"}', None),
        ('  {"content":"c"}\r', None),
        ('{"id":null,"content":"c"}', None),
        ('{"content":"c","extra":{"a":1,"a":2}}', None),
        ('{"content":"c","created_at":"2024-01-01T00:00:00.5+08:00","account_id":7}', None),
        ('{"content":"   "}', None),
        ('{"content":"","text":"t"}', None),
        ('{"content":"c","content":"d"}', None),
        ('{"id":1,"content":"c"}', "wrong_type"),
        ('{"content":5}', "wrong_type"),
        ('{"content":"c","text":[1]}', "wrong_type"),
        ('{"content":"c","title":{}}', "wrong_type"),
        ('{"content":"c","account_id":"1"}', "wrong_type"),
        ('{"content":"c","account_id":1.0}', "wrong_type"),
        ('{"content":"c","account_id":99999999999999999999}', "wrong_type"),
        ('{"content":"c","created_at":"2024-01-01"}', "wrong_type"),
        ('{"content":"c","updated_at":"2024-13-01T00:00:00Z"}', "wrong_type"),
        ('{"content":"c","updated_at":5}', "wrong_type"),
        ("[1]", "wrong_type"),
        ("5", "wrong_type"),
        ('"s"', "wrong_type"),
        ("null", "empty"),
        ("{}", "empty"),
        ('{"content":"","text":""}', "empty"),
        ('{"content":"\\u0000\\u0000"}', "empty"),
        ("", "malformed"),
        (" \t", "malformed"),
        ('{"content":"c"', "malformed"),
        ('{"content":"c"} x', "malformed"),
        ('{"content":"c"}{"content":"d"}', "malformed"),
        ("{'content':'c'}", "malformed"),
    ],
)
def test_reasons(spark, line, reason):
    assert clean(spark, [line])[0]["reason"] == reason


def test_derived_fields(spark):
    lines = [
        json.dumps({"id": "a", "content": "x" * 16, "title": "given", "account_id": 9}),
        json.dumps({"content": "", "text": "from text", "id": "b"}),
        json.dumps({"content": "a\x00" * 10}),
        json.dumps({"content": "😀" * 16}, ensure_ascii=True),
        b'{"content":"a\xff\xfeb \xef\xbf\xbd"}',
        r'{"content":"half \ud800 pair"}',
    ]
    rows = clean(spark, lines)
    assert [row["title"] for row in rows] == [
        "x" * 15, "from text", "a" * 8, "😀" * 15, "ab �", "half � pair",
    ]
    assert [row["content"] for row in rows] == [
        "x" * 16, "from text", "a" * 10, "😀" * 16, "ab �", "half � pair",
    ]
    assert [row["origin_id"] for row in rows] == ["a", "b", "", "", "", ""]
    assert {row["account_id"] for row in rows} == {1}
    assert {str(row["created_at"]) for row in rows} == {"2024-01-01 00:00:00"}


def test_too_long_lines_are_not_parsed(spark):
    rows = clean(spark, ['{"content":"c"}', '{"content":"' + "c" * 100 + '"}'], max_line_bytes=64)
    assert [row["reason"] for row in rows] == [None, "too_long"]


@pytest.fixture
def folder(tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    for name, count in (("a", 700), ("b", 50), ("c", 0)):
        lines = [json.dumps({"id": f"{name}{n}", "content": f"text {name} {n}"}) for n in range(count)]
        for place in range(0, count, 10):
            lines.insert(place, "broken")
        (source / f"{name}.jsonl").write_text("\n".join(lines))
    return tmp_path


def load(spark, folder, load_id="one", **options):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "3000")
    try:
        return load_directory(
            spark, str(folder / "in"), str(folder / "table"), str(folder / "done"), load_id, now(), **options
        )
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def loaded(spark, folder):
    return [
        (row["id"], row["origin_id"])
        for row in spark.read.parquet(str(folder / "table")).orderBy("id").collect()
    ]


def manifest(spark, folder):
    noted = spark.read.parquet(str(folder / "done")).filter("taken IS NULL").collect()
    return sorted(row["file"][-7:] for row in noted)


ALL = [f"a{n}" for n in range(700)] + [f"b{n}" for n in range(50)]


def test_load_numbers_rows_in_file_order(spark, folder):
    report = load(spark, folder, batch_size=300)
    assert loaded(spark, folder) == list(enumerate(ALL, 1))
    assert report.lines == 750 + 75
    assert report.refused == {"too_long": 0, "malformed": 75, "wrong_type": 0, "empty": 0}
    batches = {(row["file"][-7:], row["batch_no"]): row["rows"] for row in report.batches.collect()}
    assert batches == {
        ("a.jsonl", 0): 300, ("a.jsonl", 1): 300, ("a.jsonl", 2): 100, ("b.jsonl", 0): 50,
    }
    assert manifest(spark, folder) == ["a.jsonl", "b.jsonl", "c.jsonl"]


def test_second_load_takes_new_files_only(spark, folder):
    load(spark, folder)
    assert load(spark, folder, "two") is None
    (folder / "in" / "d.jsonl").write_text('{"id":"d0","content":"new"}\n')
    with pytest.raises(ValueError):  # would replace the rows of the first load
        load(spark, folder)
    load(spark, folder, "three")
    assert loaded(spark, folder)[-1] == (751, "d0")
    assert len(loaded(spark, folder)) == 751


def test_broken_off_load_is_replaced(spark, folder, monkeypatch):
    def crash(*_):
        raise OSError("lost")

    monkeypatch.setattr("recordhaul.plans.load.add_to_manifest", crash)
    with pytest.raises(OSError):
        load(spark, folder)
    monkeypatch.undo()
    first = loaded(spark, folder)
    load(spark, folder)
    assert loaded(spark, folder) == first == list(enumerate(ALL, 1))


@pytest.mark.parametrize("limit", [1, 700, 720, 5000])
def test_cap_cuts_in_file_order_and_keeps_the_manifest_honest(spark, folder, limit):
    report = load(spark, folder, max_rows=limit)
    assert report.left == max(0, 750 - limit)
    assert loaded(spark, folder) == list(enumerate(ALL, 1))[:limit]
    whole = [name for name, last in (("a.jsonl", 700), ("b.jsonl", 750)) if limit >= last]
    assert manifest(spark, folder) == [*whole, "c.jsonl"]


def test_capped_loads_go_on_where_the_last_one_ended(spark, folder):
    for load_id in ("one", "two", "three"):
        load(spark, folder, load_id, max_rows=300)
    assert loaded(spark, folder) == list(enumerate(ALL, 1))
    assert load(spark, folder, "four") is None


def test_manifest_without_markers_is_an_error(spark, folder):
    load(spark, folder)
    for marker in (folder / "done").glob("*/*_SUCCESS*"):
        marker.unlink()
    with pytest.raises(ValueError):
        load(spark, folder, "two")


def test_a_line_too_long_is_refused_alone(spark, folder):
    path = folder / "in" / "a.jsonl"
    lines = path.read_text().split("\n")
    lines.insert(400, json.dumps({"id": "long", "content": "x" * 5000}))
    path.write_text("\n".join(lines))
    report = load(spark, folder, max_line_bytes=4096)
    assert report.refused["too_long"] == 1
    assert loaded(spark, folder) == list(enumerate(ALL, 1))
    assert manifest(spark, folder) == ["a.jsonl", "b.jsonl", "c.jsonl"]
    assert load(spark, folder, "two") is None


def test_a_stream_of_files_loads_each_once_with_lasting_ids(spark, tmp_path):
    folder, table, marks = (str(tmp_path / name) for name in ("in", "out", "marks"))
    (tmp_path / "in").mkdir()

    def arrive(name, *values):
        (tmp_path / "in" / name).write_text("".join(f"{v}\n" for v in values))

    def run():
        streamed.load_stream(spark, folder, table, marks, max_files=1).awaitTermination()
        return {r["content"]: r["id"] for r in streamed.loaded(spark, table).collect()}

    arrive("a.jsonl", '{"content": "one"}', "{", '{"content": "two"}')
    arrive("skipped.txt", '{"content": "no"}')
    first = run()
    assert sorted(first.values()) == [1, 2] and first["one"] < first["two"]
    arrive("b.jsonl", "bad")
    arrive("c.jsonl", '{"content": "three"}', '{"content": ""}')
    assert run() == {**first, "three": 3} == run()
    batch = spark.createDataFrame([('{"content": "three"}', "c", 0)], "value string, file string, block_start long")
    last = max(int(p.name.split("=")[1]) for p in (tmp_path / "out").glob("load_id=*"))
    streamed.load_handler(table)(batch, last)  # a batch that is run again
    assert {r["content"]: r["id"] for r in streamed.loaded(spark, table).collect()} == {**first, "three": 3}
    refused = spark.read.parquet(f"{table}-refused").groupBy("reason").sum("rows").collect()
    assert ("malformed", 2) in {tuple(r) for r in refused}
    with pytest.raises(ValueError):
        streamed.loaded(spark, str(tmp_path / "none"))


@pytest.mark.parametrize(
    ("line", "origin_id", "content", "reason"),
    [
        ('{"ID":"a","Content":"c"}', "a", "c", None),
        ('{"iD" : "a","CONTENT"\t:"c"}', "a", "c", None),
        ('{"content":"c","Content":"d"}', "", "d", None),
        ('{"Content":"d","content":"c"}', "", "c", None),
        ('{"Text":"t","content":""}', "", "t", None),
        ('{"content":"say \\"Content\\": \\"ID\\":"}', "", 'say "Content": "ID":', None),
        ('{"content":"Content","title":"ID"}', "", "Content", None),
        ('{"content":"c","x\\"Content":"d"}', "", "c", None),
        ('{"content":"c","more":{"Content":5}}', "", "c", None),
        ('{"Content":5}', "", "", "wrong_type"),
        ('{"Account_ID":"1","content":"c"}', "", "c", "wrong_type"),
        ('{"Content":"c"} x', "", "c", "malformed"),
        ('{"con\u017ftent":"c"}', "", "", "empty"),
        ('{"Con\u0054ent":"c"}', "", "c", None),
        ('"Content":', "", "", "malformed"),
    ],
)
def test_names_in_any_case(spark, line, origin_id, content, reason):
    (row,) = clean(spark, [line])
    assert row["reason"] == reason
    if reason is None:
        assert (row["origin_id"], row["content"]) == (origin_id, content)
