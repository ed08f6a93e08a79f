from __future__ import annotations

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from caselake import constants as K
from caselake.operators import summary as S
from caselake.plans import gold
from checks import queries as Q

ROWS = [
    ("a", "x", 10, "100.00", "Abnormal"),
    ("a", "y", 20, "0.05", "Normal"),
    ("a", None, None, None, None),
    ("b", "x", 1, "2.005", "Abnormal"),
    (None, "x", 5, "7.00", "Abnormal"),
    (None, "y", 6, "8.00", "Pending"),
    (None, "y", 7, "9.00", "Pending"),
]


@pytest.fixture
def rows(spark):
    df = spark.createDataFrame(ROWS, "g string, v string, n int, m string, t string")
    return df.withColumn("m", F.col("m").cast("decimal(18,2)"))


MEASURES = (
    S.row_count("rows_seen"),
    S.mean("avg_n", "n", 1),
    S.largest("max_n", "n"),
    S.smallest("min_m", "m"),
    S.money_mean("avg_m", "m"),
    S.money_total("sum_m_total", "m"),
    S.match_count("abnormal", "t", "Abnormal"),
    S.match_pct("abnormal_pct", "t", "Abnormal"),
)


def by_key(df, *keys):
    return {tuple(r[k] for k in keys): tuple(r[c] for c in df.columns if c not in keys) for r in df.collect()}


def test_measures_skip_nulls_and_keep_the_null_group(rows):
    got = by_key(S.segment_summary(rows, ["g"], MEASURES), "g")
    D = Decimal
    assert got == {
        ("a",): (3, 15.0, 20, D("0.05"), D("50.03"), D("100.05"), 1, 33.33),
        ("b",): (1, 1.0, 1, D("2.01"), D("2.01"), D("2.01"), 1, 100.0),
        (None,): (3, 6.0, 7, D("7.00"), D("8.00"), D("24.00"), 1, 33.33),
    }


def test_measures_of_a_group_without_values_are_null(rows):
    empty = rows.filter("v IS NULL")
    assert by_key(S.segment_summary(empty, ["g"], MEASURES), "g") == {
        ("a",): (1, None, None, None, None, None, 0, 0.0)
    }


def test_summary_types(rows):
    types = dict(S.segment_summary(rows, ["g"], MEASURES).dtypes)
    assert types["rows_seen"] == "bigint" and types["avg_n"] == "double" and types["max_n"] == "int"
    assert types["avg_m"] == types["min_m"] == "decimal(18,2)" and types["sum_m_total"] == "decimal(28,2)"


def test_summary_from_cells_equals_the_direct_summary(rows):
    cells = S.segment_cells(rows, ["g", "v", "t"], MEASURES)
    assert by_key(S.summary_from_cells(cells, ["g"], MEASURES), "g") == by_key(
        S.segment_summary(rows, ["g"], MEASURES), "g"
    )


def test_money_mean_equals_sparks_rounded_average(spark):
    df = spark.range(5000).selectExpr("id % 37 AS g", "cast((id * 7919 % 100003) / 100 AS decimal(18,2)) AS m")
    mine = by_key(S.segment_summary(df, ["g"], [S.money_mean("a", "m")]), "g")
    theirs = by_key(df.groupBy("g").agg(F.round(F.avg("m"), 2).alias("a")), "g")
    assert mine == theirs


def test_mode_ties(spark):
    values = [("g", "p"), ("g", "q"), ("g", "p"), ("g", "q"), ("g", "r"), (None, "z"), (None, None)]
    df = spark.createDataFrame(values, "k string, v string")
    every = {tuple(r) for r in S.mode_per_group(df, ["k"], "v", "m").collect()}
    assert every == {("g", "p"), ("g", "q"), (None, "z"), (None, None)}
    first = {tuple(r) for r in S.mode_per_group(df, ["k"], "v", "m", ties="first").collect()}
    assert first == {("g", "p"), (None, None)}
    with pytest.raises(ValueError):
        S.mode_per_group(df, ["k"], "v", "m", ties="some")


def test_condition_summary_ties_and_null_condition(spark):
    rows = [("c", "p"), ("c", "q"), (None, "p"), (None, "q"), (None, "q")]
    df = spark.createDataFrame(rows, "medical_condition string, admission_type string").selectExpr(
        "*", "1 AS length_of_stay_days", "cast(2 AS decimal(18,2)) AS billing_amount", "'Abnormal' AS test_results"
    )

    def modes(mart):
        return sorted((r.medical_condition or "", r.total_patients, r[gold.MODE] or "") for r in mart.collect())

    assert modes(gold.condition_summary(df)) == [("", 3, ""), ("c", 2, "p"), ("c", 2, "q")]
    assert modes(gold.condition_summary(df, ties="first")) == [("", 3, ""), ("c", 2, "p")]


@pytest.mark.parametrize("ties", ["all", "first"])
def test_marts_from_cells_equal_the_direct_marts(spark, sf_dir, ties):
    base = Q._base(spark, sf_dir).cache()
    marts = gold.marts_from_cells(gold.mart_cells(base), ties)
    direct = {
        "condition_summary": gold.condition_summary(base, ties),
        "billing_summary": gold.billing_summary(base),
        "patient_demographics": gold.patient_demographics(base),
    }
    for name, mart in marts.items():
        keys = [*gold.MART_KEYS[name], gold.MODE] if name == "condition_summary" else gold.MART_KEYS[name]
        assert mart.dtypes == direct[name].dtypes
        assert by_key(mart, *keys) == by_key(direct[name], *keys)
    base.unpersist()


def test_roll_ups_weighted_and_not(spark):
    df = spark.createDataFrame(
        [("a", 1, 10.0), ("a", 3, 20.0), ("a", 5, None), ("b", 0, 4.0)], "k string, n int, v double"
    )
    plain = by_key(S.roll_up_mean(df, ["k"], "v", "m"), "k")
    weighted = by_key(S.roll_up_mean(df, ["k"], "v", "m", weight="n"), "k")
    assert plain == {("a",): (15.0,), ("b",): (4.0,)}
    assert weighted == {("a",): (17.5,), ("b",): (None,)}
    assert by_key(S.roll_up_sum(df, ["k"], "n", "t"), "k") == {("a",): (9,), ("b",): (0,)}


def test_top_rows_break_ties_and_put_null_last(spark):
    df = spark.createDataFrame([("b", 2), ("a", 2), ("c", None), ("d", 1)], "k string, v int")
    assert [r.k for r in S.top_rows(df, "v", ["k"], n=4).collect()] == ["a", "b", "d", "c"]
    assert S.top_rows(df, "v", ["k"]).first().k == "a"


def test_presented_orders(spark, sf_dir):
    mart = gold.presented(gold.patient_demographics(Q._base(spark, sf_dir)), "patient_demographics").collect()
    keys = [(r.age_group, r.gender, -r.total_patients) for r in mart]
    assert keys == sorted(keys)
    assert set(K.DEMOGRAPHIC_KEYS) <= set(mart[0].asDict())
