import hashlib
import json
from datetime import date

import pytest
from pyspark.sql import functions as F

from strata.functions import columns as c
from strata.functions.text import row_hash, summarize_text, title_words, two_decimals
from tests.conftest import PRODUCTION_COLUMNS, PRODUCTION_ROWS, text_frame


def one(spark, expression):
    return spark.range(1).select(expression.alias("v")).first().v


def test_blank_text_becomes_null_and_only_spaces_are_trimmed(spark):
    assert one(spark, c.blank_to_null(F.lit("  a "))) == "a"
    assert one(spark, c.blank_to_null(F.lit("   "))) is None
    assert one(spark, c.blank_to_null(F.lit("\t"))) == "\t"


def test_key_keeps_blank_and_member_names_unknown(spark):
    assert one(spark, c.normalize_key(F.lit(" ypf "))) == "YPF"
    assert one(spark, c.normalize_key(F.lit("  "))) == ""
    assert one(spark, c.unknown_member(F.lit(None))) == "SIN DATO"


def test_casts_raise_on_garbage(spark):
    assert one(spark, c.typed_cast(F.lit(" 12 "), "bigint")) == 12
    assert one(spark, c.typed_cast(F.lit(""), "int", 0)) == 0
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        one(spark, c.typed_cast(F.concat(F.lit("x"), F.col("id").cast("string")), "bigint"))


def test_month_and_calendar(spark):
    assert one(spark, c.month_start(F.lit("2024"), F.lit(" 2"))) == date(2024, 2, 1)
    with pytest.raises(Exception):
        one(spark, c.month_start(F.lit("2024"), (F.col("id") + 13).cast("string")))


@pytest.mark.parametrize(
    "parts, key",
    [
        ([135204], "098ff0b2271326889fd3bb4c0bde65ae"),
        (["YPF"], "f71fb5a5002d2eaa988f141345db9333"),
        (["Cañadon Seco"], "be12841aa83554bed947812c04750f63"),
        ([date(2024, 1, 1)], "f867f4b1ba30bf4bbed342c32b89110c"),
        ([135204, date(2024, 1, 1)], "d380c24726ecda32f67e2c2ca1018691"),
        ([None, "x"], hashlib.md5(b"_dbt_utils_surrogate_key_null_-x").hexdigest()),
    ],
)
def test_surrogate_keys(spark, parts, key):
    assert one(spark, c.surrogate_key(*[F.lit(p) for p in parts])) == key


def test_first_existing_looks_at_the_schema_only(spark):
    df = text_frame(spark, ["Area", "areayacimiento"], [("filled", "")])
    chosen = c.first_existing(df, ["areayacimiento", "area"], F.lit("none"))
    assert df.select(chosen.alias("v")).first().v == ""
    assert df.select(c.first_existing(df, ["AREA"], F.lit("none")).alias("v")).first().v == "filled"
    assert df.select(c.first_existing(df, ["other"], F.lit("none")).alias("v")).first().v == "none"


def test_row_hash_of_the_fixture_row(spark):
    df = text_frame(spark, PRODUCTION_COLUMNS, PRODUCTION_ROWS[:1])
    expected = "25f430a8b24f693df0058a87354d52c32d4463fbee1a8a1acca557c8ed6e75fb"
    assert df.select(row_hash(df.columns).alias("v")).first().v == expected


def test_row_hash_equals_the_json_module_on_awkward_cells(spark):
    cells = [
        "", "plain", "ñ \x7f", 'a","b":"c', "\\", '\\"', "\\u000B", "\\\\\x0b",
        *[chr(i) for i in range(32)],
    ]
    rows = [(a, cells[-i - 1]) for i, a in enumerate(cells)]
    df = text_frame(spark, ["b_1", "a"], rows)
    got = [r.v for r in df.select(row_hash(["b_1", "a"]).alias("v")).collect()]
    assert got == [
        hashlib.sha256(
            json.dumps({"b_1": b, "a": a}, ensure_ascii=False, sort_keys=True).encode()
        ).hexdigest()
        for b, a in rows
    ]


@pytest.mark.parametrize(
    "text, limit, summary",
    [
        (" a \n\t b ", 160, "a b"), ("  ", 160, "<empty>"), ("", 160, "<empty>"),
        ("x" * 160, 160, "x" * 160), ("x" * 161, 160, "x" * 157 + "..."), ("a  b", 10, "a b"),
        ("abcdef", 5, "ab..."),
    ],
)
def test_summaries(spark, text, limit, summary):
    assert one(spark, summarize_text(F.lit(text), limit)) == summary


@pytest.mark.parametrize("value", [0.125, 0.375, 1.005, 1.015, 2.675, 5.655, 1185.0, 1234567.895, 0.0])
def test_two_decimals_round_the_binary_value(spark, value):
    assert one(spark, two_decimals(F.lit(value))) == f"{value:.2f}"


def test_titles(spark):
    assert one(spark, title_words(F.lit("service_down"))) == "Service Down"
