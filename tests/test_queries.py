"""Every query against its SQL."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry_point
from caselake.session import scratch_database
from caselake.sinks import tables
from checks import oracle, queries
from checks.compare import connect, difference

QUERIES, SQL = queries.queries(), oracle.oracle_sql()


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


def test_entry_point_has_every_query():
    assert set(QUERIES) <= set(entry_point.queries())
    assert SQL.items() <= entry_point.oracle_sql().items()


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_agrees_with_sql(spark, con, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    assert df.columns, name
    assert difference(df, con, SQL[name]) is None


def test_table_detail_query(spark, sf_dir):
    row = QUERIES["table_detail"](spark, sf_dir).first()
    assert row.num_rows == QUERIES["dedupe_report"](spark, sf_dir).first().records_after
    assert (row.has_files, row.has_bytes, row.in_database) == (True, True, True)



def test_entry(spark):
    df = entry_point.entry(spark)
    assert df.columns[0] == "medical_condition" and df.count() >= 5


def test_known_figures_at_sf001(spark):
    """Figures agreed on before this code was written."""
    sf_dir = "/root/testdata/sf0.01"
    counts = {r.rule: tuple(r)[-3:] for r in QUERIES["dq_three_valued_counts"](spark, sf_dir).collect()}
    assert counts == {
        "dq_age_valid": (13499, 1179, 322),
        "dq_billing_valid": (14776, 224, 0),
        "dq_dates_valid": (14046, 661, 293),
        "dq_length_of_stay_valid": (13751, 956, 293),
        "dq_name_valid": (14657, 343, 0),
        "dq_passed": (11900, 2553, 547),
    }
    assert tuple(QUERIES["dedupe_report"](spark, sf_dir).first()) == (15750, 15000, 750)
    mart = QUERIES["condition_summary"](spark, sf_dir).collect()
    assert [(r.medical_condition, r.total_patients, str(r.total_billing_amount)) for r in mart] == [
        ("MACHINERY", 2460, "628092938.18"),
        ("HOUSEHOLD", 2394, "602003177.04"),
        ("FURNITURE", 2367, "594983754.41"),
        ("BUILDING", 2356, "590792041.41"),
        ("AUTOMOBILE", 2323, "573640919.57"),
    ]
    assert (mart[0].abnormal_test_rate_pct, mart[0].most_common_admission_type) == (32.89, "3-MEDIUM")
