from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from caselake.functions.identity import record_hash
from caselake.operators.columns import LINEAGE, clean_column_names, clean_name, with_lineage
from caselake.sources.files import read_csv


@pytest.mark.parametrize(
    ("raw", "clean"),
    [
        ("  Patient Name ", "patient_name"),
        ("Billing Amount ($)", "billing_amount_"),
        ("Date\tof  Admission", "date_of_admission"),
        ("A-b.c", "abc"),
        ("_x", "_x"),
    ],
)
def test_clean_name(raw, clean):
    assert clean_name(raw) == clean


def test_colliding_or_empty_names_are_an_error(spark):
    for names in (["A b", "a_b"], ["a", "$$"]):
        with pytest.raises(ValueError):
            clean_column_names(spark.createDataFrame([(1, 2)], names))


def test_record_hash_collisions_and_their_safe_form(spark):
    rows = [("a||b", "c"), ("a", "b||c"), (None, ""), ("", None)]
    df = spark.createDataFrame(rows, "p string, q string")

    def distinct(safe):
        return df.select(record_hash(["p", "q"], safe).alias("h")).distinct().count()

    assert distinct(False) == 2
    assert distinct(True) == 4


def test_record_hash_is_sha256_of_the_joined_text(spark):
    import hashlib

    df = spark.createDataFrame([(7, None, "x")], "a int, b string, c string")
    assert df.select(record_hash(["a", "b", "c"])).first()[0] == hashlib.sha256(b"7||||x").hexdigest()


def test_lineage_of_a_file_scan(spark, tmp_path):
    (tmp_path / "feed.csv").write_text("Patient Name,Age\nbob,007\n")
    raw = clean_column_names(read_csv(spark, str(tmp_path)))
    row = with_lineage(raw, "b1", F.lit("2024-05-06 23:30:00").cast("timestamp")).first()
    assert tuple(row.asDict()) == ("patient_name", "age", *LINEAGE)
    assert row.age == 7 and row._batch_id == "b1"
    assert row._source_file.endswith("feed.csv")
    assert row._ingest_date == dt.date(2024, 5, 6)
    now = with_lineage(raw, "b2").first()
    assert now._ingested_at is not None and now._record_hash == row._record_hash


def test_csv_schemas(spark, tmp_path):
    (tmp_path / "feed.csv").write_text("code,amount,day,note\n007,1.50,2024-01-31,\n")
    assert read_csv(spark, str(tmp_path)).dtypes == [
        ("code", "int"),
        ("amount", "double"),
        ("day", "date"),
        ("note", "string"),
    ]
    text = read_csv(spark, str(tmp_path), "string").first()
    assert tuple(text) == ("007", "1.50", "2024-01-31", None)
    declared = read_csv(spark, str(tmp_path), "code string, amount decimal(18,2), day date, note string")
    assert declared.dtypes[1] == ("amount", "decimal(18,2)")
