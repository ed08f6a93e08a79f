from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from caselake.operators import quality
from caselake.plans.silver import DQ_FLAGS, admission_rules
from caselake.sinks.tables import save_table

def flagged(spark, rows):
    df = spark.createDataFrame(rows, "i int, a int, b double, x string, y string, s int, n string").select(
        "i",
        F.col("a").alias("age"),
        F.col("b").cast("decimal(18,2)").alias("billing_amount"),
        F.to_date("x").alias("date_of_admission"),
        F.to_date("y").alias("discharge_date"),
        F.col("s").alias("length_of_stay_days"),
        F.col("n").alias("name_clean"),
    )
    return quality.with_flags(df, admission_rules())


def test_each_rule_true_false_and_null(spark):
    day, eve = "2024-01-02", "2024-01-01"
    rows = [
        (0, 0, 0.01, day, day, 0, "Bo"),
        (1, 120, 5.0, eve, day, 365, "Bob"),
        (2, -1, 0.0, day, eve, -1, "B"),
        (3, 121, -5.0, eve, day, 366, ""),
        (4, None, None, None, day, None, None),
        (5, 50, 5.0, day, None, 5, "Bob"),
    ]
    got = [tuple(r[f] for f in DQ_FLAGS) for r in flagged(spark, rows).orderBy("i").collect()]
    assert got == [
        (True,) * 6,
        (True,) * 6,
        (False,) * 6,
        (False, False, True, False, False, False),
        (None, None, None, None, False, False),
        (True, True, None, True, True, None),
    ]


def test_reports_count_null_as_failed_and_drop_nothing(spark):
    day, eve = "2024-01-02", "2024-01-01"
    rows = [
        (0, 10, 1.0, eve, day, 1, "Bob"),
        (1, None, 1.0, eve, day, 1, "Bob"),
        (2, 130, 1.0, eve, day, 1, "Bob"),
    ]
    df = flagged(spark, rows)
    lines = quality.flag_counts(df, DQ_FLAGS).collect()
    counts = {r.rule: (r.total, r.n_true, r.n_false, r.n_null) for r in lines}
    assert counts["dq_age_valid"] == (3, 1, 1, 1)
    assert counts["dq_passed"] == (3, 1, 1, 1)
    assert counts["dq_name_valid"] == (3, 3, 0, 0)
    report = {r.rule: r for r in quality.dq_report(df, DQ_FLAGS).collect()}
    passed = report["dq_passed"]
    assert (passed.total, passed.passed, passed.failed) == (3, 1, 2)
    assert (passed.passed_pct, passed.failed_pct) == (33.3, 66.7)
    assert tuple(quality.exclusion_report(df).first()) == (3, 1, 2)


@pytest.mark.parametrize("ansi", ["true", "false"], indirect=True)
def test_reports_of_an_empty_table(spark, ansi):
    df = flagged(spark, [])
    assert {tuple(r)[1:] for r in quality.dq_report(df, DQ_FLAGS).collect()} == {(0, 0, 0, 0.0, 0.0)}
    assert tuple(quality.exclusion_report(df).first()) == (0, 0, 0)
    assert tuple(quality.dedupe_report(df, ["i"]).first()) == (0, 0, 0)


def test_dedupe_keeps_the_first_batch_and_is_deterministic(spark):
    rows = [("h1", 2, "b"), ("h1", 1, "c"), ("h2", 1, "x"), (None, 1, "n"), (None, 2, "n"), ("h1", 1, "a")]
    df = spark.createDataFrame(rows, "h string, batch int, v string")
    first = {tuple(r) for r in quality.dedupe(df, ["h"], ["batch"]).collect()}
    assert {(h, b) for h, b, _ in first} == {("h1", 1), ("h2", 1), (None, 1)}
    shuffled = df.repartition(5, "v")
    assert {tuple(r) for r in quality.dedupe(shuffled, ["h"], ["batch"]).collect()} == first
    assert tuple(quality.dedupe_report(df, ["h"]).first()) == (6, 3, 3)


def test_dedupe_of_a_hot_key_shrinks_before_the_shuffle(spark):
    df = spark.range(0, 60_000, 1, 8).selectExpr("if(id % 3 = 0, 'hot', string(id)) AS h", "id AS v")
    unique = quality.dedupe(df, ["h"], ["v"])
    plan = unique._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
    assert unique.count() == 40_001
    assert unique.filter("h = 'hot'").first().v == 0


def stored(spark, database, df):
    save_table(df, f"{database}.rows")
    return spark.table(f"{database}.rows")


@pytest.mark.parametrize("listed", [1000, 3])
def test_dedupe_stored_agrees_with_dedupe(spark, database, listed):
    df = spark.range(0, 3000, 1, 6).selectExpr(
        "if(id % 3 = 0, 'hot', if(id % 100 = 1, null, string(id % 1000))) AS h",
        "if(id % 7 = 0, null, int(id % 5)) AS batch",
        "if(id % 2 = 0, null, '') AS v",
        "if(id % 2 = 0, '', null) AS w",
        "concat('file', id % 11) AS source",
    )
    rows = stored(spark, database, df)
    found = quality.dedupe_stored(rows, ["h"], ["batch"], listed=listed)
    assert found.columns == ["h", "batch", "v", "w", "source"]
    expected = quality.dedupe(df.orderBy(F.desc("source")).repartition(3), ["h"], ["batch"])
    assert sorted(map(repr, found.collect())) == sorted(map(repr, expected.collect()))


def test_dedupe_stored_keeps_one_of_equal_copies_and_shuffles_no_rows(spark, database):
    df = spark.range(0, 6000, 1, 6).selectExpr("if(id % 3 = 0, 'hot', string(id)) AS h", "repeat('x', 50) AS v")
    rows = stored(spark, database, df)
    found = quality.dedupe_stored(rows, ["h"])
    assert found.count() == 4001 and found.filter("h = 'hot'").count() == 1
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("BroadcastHashJoin") == 2 and "SortMergeJoin" not in plan
    assert plan.count("Exchange hashpartitioning") == 1 and "partial_min" in plan


def test_dedupe_stored_shuffles_no_rows_when_most_keys_repeat(spark, database):
    df = spark.range(0, 6000, 1, 6).selectExpr("if(id % 3 = 0, null, id % 1500) AS h", "repeat('x', 50) AS v", "id % 2 AS b")
    rows = stored(spark, database, df)
    found = quality.dedupe_stored(rows, ["h"], ["b"], listed=3)
    assert sorted(map(repr, found.collect())) == sorted(map(repr, quality.dedupe(df, ["h"], ["b"]).collect()))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan and "Window" not in plan


@pytest.mark.parametrize("bytes_", [quality.PLACES_BYTES, 0])
def test_dedupe_by_place_with_wanted_and_unwanted_keys(spark, database, monkeypatch, bytes_):
    # More rows than one bitmap covers, and a group of copies that holds a third of them.
    monkeypatch.setattr(quality, "PLACES_BYTES", bytes_)
    df = spark.range(0, 90_000, 1, 2).selectExpr("if(id % 3 = 0, 0L, id) AS h", "id AS v", "id % 5 AS b")
    rows, keys = stored(spark, database, df), {"k": F.col("h")}
    expected = quality.dedupe(df, ["h"], ["b"])
    found = quality.dedupe_by_place(rows, keys, ["b"])
    assert found.columns == ["h", "v", "b"] and found.count() == 60_001
    assert found.exceptAll(expected).isEmpty()
    small = spark.range(0, 100).select(F.col("id").alias("k"))
    only = quality.dedupe_by_place(rows, keys, ["b"], only=small)
    assert only.count() == 67 and only.exceptAll(expected.filter("h < 100")).isEmpty()
    others = quality.dedupe_by_place(rows, keys, ["b"], without=small)
    assert others.count() == 60_001 - 67 and others.filter("h < 100").isEmpty()


def test_dedupe_stored_without_repeats(spark, database):
    rows = stored(spark, database, spark.range(100).selectExpr("string(id) AS h"))
    assert quality.dedupe_stored(rows.filter("h < '5'"), ["h"]).count() == rows.filter("h < '5'").count()


def test_content_is_compared_as_a_multiset(spark):
    rows = [(1, "a", None), (2, "", None), (2, "", None), (3, None, "")]
    schema = "k int, a string, b string"
    df = spark.createDataFrame(rows, schema)

    def compare(others):
        return tuple(quality.same_content(df, spark.createDataFrame(others, schema)).first())

    assert compare(rows[::-1]) == (4, 4, True)
    assert compare(rows[:3]) == (4, 3, False)
    assert compare([rows[0], rows[1], rows[3], rows[3]]) == (4, 4, False)
    # NULL and '' are two values, and swapped values are noticed.
    assert compare([(1, "a", None), (2, "", None), (2, "", None), (3, "", None)]) == (4, 4, False)
    assert compare([(1, None, "a"), *rows[1:]]) == (4, 4, False)
    assert tuple(quality.same_content(df.limit(0), df.limit(0)).first()) == (0, 0, True)
    with pytest.raises(ValueError, match="columns differ"):
        quality.same_content(df, df.drop("b"))
