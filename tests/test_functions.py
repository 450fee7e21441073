import random

import pytest
from pyspark.sql import functions as F

from recordhaul.functions import jsonl, text, times

VALID = [
    '{"a":1}', "[1,2]", "1", '"x"', "null", "true", '{"a":1,"a":2}', "1e999", '"\\ud800"',
    ' {"a":1}\t', "-0", "{}", "[]", '{"a":{"b":[1,{"c":null}]}}', '"\\u0000"', "1.5e-3", '"\\/"',
    '"é"', "[[],{}]", "1E+2", "[" * 1500 + "]" * 1500, "1" * 1500,
]
INVALID = [
    '{"a":1} x', '{"a":1}{"b":2}', "{'a':1}", "NaN", "Infinity", "01", "-01", "+1", ".5", "1.",
    "[1,]", '{"a":1,}', "{a:1}", '"\t"', '"\\x"', "1],[2", '1},{"b":2', '1,"b":2', "1,2", "", "-",
    "tru", '"abc', "[1", '{"a"}', '{"a":}', "// c", "1 2", "1]", "1}", "],[", '},{"v":1', "/**/1",
    '1],"b":[2', "1]} x", '{"a":1}],[{"b":2}', '{"a":1},"w":{"b":2}', "   ", '"\\u12"',
]


def one(spark, expression, value, kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(expression(F.col("v"))).first()[0]


def many(spark, expression, values, kind="string"):
    rows = list(enumerate(values))
    frame = spark.createDataFrame(rows, f"n int, v {kind}")
    found = frame.select("n", expression(F.col("v")).alias("out")).collect()
    return [row["out"] for row in sorted(found)]


def test_strict_json(spark):
    assert many(spark, jsonl.is_strict_json, VALID) == [True] * len(VALID)
    assert many(spark, jsonl.is_strict_json, INVALID) == [False] * len(INVALID)


def test_strict_json_takes_very_long_strings(spark):
    value = spark.range(1).select(F.concat(F.lit('"'), F.repeat(F.lit("a"), 22 << 20), F.lit('"')))
    assert value.select(jsonl.is_strict_json(F.col(value.columns[0]))).first()[0]


def test_trim_strips_unicode_space_only(spark):
    space = text.WHITE_SPACE
    assert len(space) == 25
    values = [f"{space}a{space}b{space}", space, "​a", "", "x　", "\r\n", " "]
    assert many(spark, text.trim_space, values) == [
        f"a{space}b", "", "​a", "", "x", "", "",
    ]
    pattern = r"^\p{IsWhite_Space}+|\p{IsWhite_Space}+$"
    same = many(spark, lambda c: F.regexp_replace(c, pattern, ""), values)
    assert same == many(spark, text.trim_space, values)


def test_invalid_bytes_are_dropped_and_replacement_characters_kept(spark):
    random.seed(7)
    alphabet = [
        0x41, 0x30, 0x31, 0xEF, 0xBF, 0xBD, 0xB7, 0x90, 0xFF, 0xE2, 0x82, 0xAC, 0xF0, 0xED, 0xA0,
        0x80, 0xC3,
    ]
    cases = [
        b"A\xff\xfe\xef\xbf\xbdB\xed\xa0\x80z",
        "﷐0﷐1�".encode() + b"\xff\xe2\x82A",
        b"",
    ]
    cases += [bytes(random.choices(alphabet, k=random.randint(1, 30))) for _ in range(500)]
    found = many(
        spark,
        lambda c: text.drop_invalid_utf8(c.cast("string")),
        [bytearray(case) for case in cases],
        "binary",
    )
    assert found == [case.decode("utf-8", "ignore") for case in cases]


def test_title_counts_code_points(spark):
    values = ["", "a", "a" * 14, "a" * 15, "a" * 16, "😀" * 20, "中文" * 10]
    assert many(spark, text.title_of, values) == [value[:15] for value in values]


def test_first_non_empty(spark):
    frame = spark.createDataFrame(
        [("a", "b"), ("", "b"), (None, "b"), ("", None), ("", ""), (" ", "b")], "c string, t string"
    )
    found = frame.select(text.first_non_empty(F.col("c"), F.col("t"))).collect()
    assert [row[0] for row in found] == ["a", "b", "b", "", "", " "]


def test_tokens(spark):
    assert one(spark, text.tokens, "The cat, the CAT-2 naïve") == [
        "the", "cat", "the", "cat", "2", "naïve",
    ]
    assert one(spark, text.tokens, "数据导入 GO语言 x") == [
        "数", "据", "导", "入", "数据", "据导", "导入", "go", "语", "言", "语言", "x",
    ]
    assert one(spark, text.tokens, "字") == ["字"]
    assert one(spark, text.tokens, " .,") == []
    assert one(spark, text.tokens, None) == []


def test_surrogate_escapes(spark):
    u = "\\" + "u"  # the two characters that start an escape
    pair, bad = f"{u}d83d{u}de00", f"{u}fffd"
    cases = {
        f"a{u}d800b": f"a{bad}b",
        f"{u}dc00": bad,
        f"{u}dc00{u}dc00": bad + bad,
        pair: pair,
        f"{u}D800{pair}": bad + pair,
        f"{pair}{u}de00": pair + bad,
        f"\\{u}d800": f"\\{u}d800",
        "no escape": "no escape",
    }
    assert many(spark, jsonl.repair_surrogates, list(cases)) == list(cases.values())


@pytest.mark.parametrize(
    ("value", "expected"),
    [
        ("2024", "2024-01-01 00:00:00"),
        ("2024-05", "2024-05-01 00:00:00"),
        ("2024-05-06", "2024-05-06 00:00:00"),
        ("2024-05-06T", "2024-05-06 00:00:00"),
        ("2024-05-06T10", "2024-05-06 10:00:00"),
        ("2024-05-06T10Z", "2024-05-06 10:00:00"),
        ("2024-05-06T10:11", "2024-05-06 10:11:00"),
        ("2024-05-06T10:11Z", "2024-05-06 10:11:00"),
        ("2024-05-06T10:11:12.123456789Z", "2024-05-06 10:11:12.123456"),
        ("2024-05-06T10:11:12,5+08:00", "2024-05-06 02:11:12.5"),
        ("2024-05-06T10:11:12+0800", "2024-05-06 02:11:12"),
        ("2024-05-06T10:11+08", "2024-05-06 02:11:00"),
        ("1700000000000", "2023-11-14 22:13:20"),
        ("-1", "1969-12-31 23:59:59.999"),
        ("2025-01-01 00:00:00", None),
        ("2024-13-01", None),
        ("2024-02-30", None),
        ("x", None),
        ("", None),
        (None, None),
    ],
)
def test_dates(spark, value, expected):
    assert one(spark, lambda c: times.parse_date(c).cast("string"), value) == expected


def test_truncate_ms_goes_towards_the_past(spark):
    values = ["2024-01-01 00:00:00.123999", "1969-12-31 23:59:59.999999"]
    found = many(
        spark, lambda c: times.truncate_ms(c.cast("timestamp")).cast("string"), values
    )
    assert found == ["2024-01-01 00:00:00.123", "1969-12-31 23:59:59.999"]
