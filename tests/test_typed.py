from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from caselake.functions import typed
from caselake.operators.columns import cast_columns, null_defaults
from caselake.plans.silver import age_group

BOTH = pytest.mark.parametrize("ansi", ["true", "false"], indirect=True)


@BOTH
def test_casts_give_null_instead_of_raising(spark, ansi):
    rows = [("42", "12.345"), (" 42 ", "1e3"), ("45.7", "x"), ("abc", ""), (None, None), ("99999999999", "1e30")]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, a string, m string")
    got = cast_columns(df, {"a": "int", "m": "decimal(18,2)"}).orderBy("i").collect()
    assert [r.a for r in got] == [42, 42, None, None, None, None]
    assert [r.m for r in got] == [Decimal("12.35"), Decimal("1000.00"), None, None, None, None]


@BOTH
def test_dates_are_strict(spark, ansi):
    texts = ["2024-01-31", "2024-13-01", "2024-02-30", "2024-1-5", "31/01/2024", "", None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, d string")
    got = [r.d for r in df.select("i", typed.parse_date(F.col("d")).alias("d")).orderBy("i").collect()]
    assert got == [dt.date(2024, 1, 31), None, None, None, None, None, None]


def test_dates_already_typed_pass_through(spark):
    df = spark.sql("SELECT DATE '2024-01-31' AS d, TIMESTAMP '2024-01-31 10:00:00' AS t")
    row = df.select(typed.parse_date(F.col("d")).alias("d"), typed.parse_date(F.col("t")).alias("t")).first()
    assert row.d == row.t == dt.date(2024, 1, 31)


def test_days_between_counts_signed_days(spark):
    df = spark.sql("SELECT DATE '2024-03-01' AS a, DATE '2024-02-28' AS b, CAST(NULL AS DATE) AS n")
    days = df.select(
        typed.days_between(F.col("b"), F.col("a")).alias("up"),
        typed.days_between(F.col("a"), F.col("b")).alias("down"),
        typed.days_between(F.col("n"), F.col("a")).alias("none"),
    )
    assert days.first().asDict() == {"up": 2, "down": -2, "none": None}
    assert dict(days.dtypes)["up"] == "int"


def test_age_groups_at_every_bound(spark):
    ages = [None, -1, 0, 17, 18, 34, 35, 59, 60, 120, 121]
    df = spark.createDataFrame([(i, a) for i, a in enumerate(ages)], "i int, age int")
    got = [r.g for r in df.select("i", age_group(F.col("age")).alias("g")).orderBy("i").collect()]
    assert got == ["Senior"] + ["Paediatric"] * 3 + ["Young Adult"] * 2 + ["Middle Aged"] * 2 + ["Senior"] * 3


def test_bucketize_needs_matching_labels(spark):
    with pytest.raises(ValueError):
        typed.bucketize(F.lit(1), [1, 2], ["a", "b"])


def test_null_defaults_leave_empty_text(spark):
    df = spark.createDataFrame([(None, "x"), ("", None)], "a string, b string")
    assert [tuple(r) for r in null_defaults(df, {"a": "A", "b": "B"}).collect()] == [("A", "x"), ("", "B")]
