import json
import random

from pyspark.sql import functions as F

from recordhaul.operators import changes, messages
from recordhaul.plans.full_load import full_load
from recordhaul.schemas import ARTICLE_MAPPING


def as_set(frame):
    return {tuple(row) for row in frame.collect()}


def log(spark, rows=300):
    random.seed(3)
    data = [
        ("hot" if n % 3 == 0 else f"k{random.randrange(20)}", n, f"v{n}" if n % 5 else None)
        for n in range(rows)
    ]
    random.shuffle(data)
    return spark.createDataFrame(data, "id string, n int, v string").repartition(4)


def test_upsert_keeps_the_last_row(spark):
    expected = {}
    for row in sorted(log(spark).collect(), key=lambda row: row["n"]):
        expected[row["id"]] = tuple(row)
    assert as_set(changes.upsert(None, log(spark), "id", ["n"])) == set(expected.values())


def test_upsert_depends_neither_on_batches_nor_on_replays(spark):
    whole = as_set(changes.upsert(None, log(spark), "id", ["n"]))
    state = None
    for low, high in ((0, 50), (200, 300), (50, 200), (50, 200), (0, 50)):
        batch = log(spark).filter(F.col("n").between(low, high - 1))
        state = changes.upsert(state, batch, "id", ["n"])
    assert as_set(state) == whole


def test_upsert_takes_new_columns(spark):
    target = spark.createDataFrame([(1, 1, "a")], "id int, n int, v string")
    change = spark.createDataFrame([(2, 2, "b")], "id int, n int, w string")
    assert as_set(changes.upsert(target, change, "id", ["n"])) == {(1, 1, "a", None), (2, 2, None, "b")}


def test_few_changes_leave_the_target_in_place(spark, tmp_path):
    wide = spark.range(5000).selectExpr("id", "0 AS n", "repeat('x', 20) AS wide")
    wide.write.parquet(str(tmp_path / "target"))
    target = spark.read.parquet(str(tmp_path / "target"))
    rows = [(7, 1, "new"), (9999, 1, "more"), (None, 1, "none")]
    spark.createDataFrame(rows, target.schema).write.parquet(str(tmp_path / "change"))
    change = spark.read.parquet(str(tmp_path / "change"))  # of a size that Spark knows
    made = changes.upsert(target, change, "id", ["n"])
    rows = {row["id"]: row["wide"] for row in made.collect()}
    assert len(rows) == 5002 and rows[7] == "new" and rows[9999] == "more" and rows[None] == "none"
    plan = made._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert plan.count("BroadcastHashJoin") == 2 and "SortMergeJoin" not in plan
    lost = changes.missing_keys(target, change, "id").collect()
    assert {row["id"] for row in lost} == {9999, None}


def test_merge_fields(spark):
    target = spark.createDataFrame([(1, "a", "x"), (2, "b", "y"), (3, "c", "z")], "id int, s string, t string")
    patch = spark.createDataFrame(
        [
            (1, 1, "A", None, None, ["s"]),
            (1, 2, None, None, 5, ["n", "t"]),
            (2, 1, "early", None, None, ["s"]),
            (2, 3, None, None, None, ["s"]),
            (2, 2, "late", None, None, ["s"]),
            (9, 1, "lost", None, None, ["s"]),
        ],
        "id int, at int, s string, t string, n int, present array<string>",
    )
    merged = changes.merge_fields(target, patch, "id", ["s", "t", "n"], ["at"])
    assert merged.columns == ["id", "s", "t", "n"]
    assert as_set(merged) == {(1, "A", None, 5), (2, None, "y", None), (3, "c", "z", None)}


def test_delete_and_missing(spark):
    target = spark.createDataFrame([(n,) for n in range(5)], "id int")
    keys = spark.createDataFrame([(1,), (1,), (3,), (8,), (8,)], "id int")
    assert as_set(changes.delete_keys(target, keys, "id")) == {(0,), (2,), (4,)}
    assert as_set(changes.missing_keys(target, keys, "id")) == {(8,)}


def test_conform(spark):
    frame = spark.createDataFrame(
        [
            ("1", "7", "o", "t", "c", "2024-01-01T00:00:00Z"),
            ("x", "7", "o", "t", "c", "2025-01-01 00:00:00"),
            (None, None, None, None, None, None),
        ],
        "id string, account_id string, origin_id string, title string, content string, created_at string",
    )
    typed = changes.conform_to_mapping(frame, ARTICLE_MAPPING)
    assert dict(typed.dtypes)["id"] == "bigint"
    assert [row["bad_fields"] for row in typed.collect()] == [[], ["id", "created_at"], []]


def message(**fields):
    return json.dumps(fields)


def decoded(spark, values, **options):
    frame = spark.createDataFrame(
        [("t", n % 3, n, value) for n, value in enumerate(values)],
        "topic string, partition int, offset long, value string",
    )
    return messages.decode_messages(frame, **options)


def test_decode_reasons(spark):
    cases = {
        message(id=1, title="t", account_id=2, created_at="2024-01-01T00:00:00.5Z"): None,
        message(id=9007199254740993): None,
        message(id=5.7): None,
        message(id=2, unknown={"a": 1}): None,
        message(id=3, created_at=1700000000000): None,
        message(id=4, title=5): None,
        message(id=4, title=None): None,
        message(title="t"): "no_id",
        message(id="5"): "no_id",
        message(id=None): "no_id",
        message(id=True): "no_id",
        message(id=6, created_at="2025-01-01 00:00:00"): "type",
        message(id=7, title={"a": 1}): "type",
        message(id=7, content=[1]): "type",
        message(id=8, account_id="many"): "type",
        "": "malformed",
        "[1]": "malformed",
        "5": "malformed",
        "null": "malformed",
        '{"id":1} x': "malformed",
        '{"id":1': "malformed",
    }
    rows = decoded(spark, list(cases)).orderBy("m_offset").collect()
    assert [row["reason"] for row in rows] == list(cases.values())
    assert [row["_id"] for row in rows[:4]] == ["1", "9007199254740993", "5", "2"]
    assert str(rows[4]["created_at"]) == "2023-11-14 22:13:20"
    assert rows[5]["title"] == "5"


def test_dead_letters_keep_the_message(spark):
    values = [message(id=1), '{"id": 1.0e0 , "id"', '  {"x":1}']
    documents, dead = messages.split_dead_letters(decoded(spark, values))
    assert [row["_id"] for row in documents.collect()] == ["1"]
    assert as_set(dead.select("offset", "value", "reason", "attempts")) == {
        (1, values[1], "malformed", 0),
        (2, values[2], "no_id", 0),
    }
    assert as_set(messages.dead_letter_messages(dead)) == {
        ("full_load_dlq", 1, None, values[1]),
        ("full_load_dlq", 2, None, values[2]),
    }


def test_generated_ids_are_stable(spark):
    values = [message(title="a"), message(title="a"), message(id=3, title="b"), message(id="x")]
    first = decoded(spark, values, need_key=False).orderBy("m_offset").collect()
    again = decoded(spark, values, need_key=False).orderBy("m_offset").collect()
    assert first == again
    assert len({row["_id"] for row in first[:3]}) == 3
    assert first[2]["_id"] == "3"
    assert [row["reason"] for row in first] == [None, None, None, "no_id"]


def test_message_partitions_and_next_offsets(spark):
    records = spark.range(100).select("id", F.lit("x").alias("title"))
    sent = messages.to_messages(records)
    assert {(row["partition"], int(row["key"]) % 3) for row in sent.collect()} == {(n, n) for n in range(3)}
    placed = sent.withColumn("offset", F.col("key").cast("bigint"))
    assert as_set(messages.next_offsets(placed)) == {
        ("full_load", 0, 100), ("full_load", 1, 98), ("full_load", 2, 99),
    }


def test_totals(spark):
    assert tuple(messages.sync_totals(decoded(spark, [message(id=1), "x", "y"])).first()) == (
        3, 1, 2, 33.33,
    )


def test_full_load_round_trip(spark):
    articles = spark.createDataFrame(
        [(n, f"o{n}", "títle", 'quo"te\n', 1, f"2024-01-01 00:00:00.{n:06d}") for n in range(50)],
        "id long, origin_id string, title string, content string, account_id int, created_at string",
    ).withColumn("created_at", F.col("created_at").cast("timestamp"))
    documents, dead = full_load(articles)
    assert dead.count() == 0
    rows = {row["id"]: row for row in documents.collect()}
    assert len(rows) == 50
    assert rows[7]["_id"] == "7"
    assert (rows[7]["title"], rows[7]["content"]) == ("títle", 'quo"te\n')
    assert rows[49]["created_at"].microsecond == 0


def test_next_offsets_count_every_message_of_a_partition(spark, tmp_path):
    import __spark_entry__ as entry

    rows = [(10, 3, "view"), (40, 0, "view"), (70, 6, "view"), (20, 4, "view"), (90, 3, None), (95, None, "view")]
    events = spark.createDataFrame(rows, "event_id long, user_id long, event_type string")
    events.write.parquet(f"{tmp_path}/events.parquet")
    found = entry.queries()["next_offsets"](spark, str(tmp_path))
    assert as_set(found) == {("view", 0, 3), ("view", 1, 1), (None, 0, 1), ("view", None, 1)}
