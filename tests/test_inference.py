"""Types found while text is written."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from caselake.operators.inference import ColumnProfile, column_profile
from caselake.plans import medallion
from caselake.session import shared_dir
from caselake.sources.files import profiled, read_csv

COLUMNS = {
    "whole": (["1", "+5", None], "int"),
    "long": (["1", "3000000000", None], "bigint"),
    "huge": (["1", "-12345678901234567890", None], "decimal(20,0)"),
    "beyond": (["1" * 39, "2", None], "double"),
    "number": (["1", "2.5", "-1e3"], "double"),
    "limits": (["NaN", "-Infinity", ".5"], "double"),
    "day": (["2024-02-29", None, "1999-12-31"], "date"),
    "noday": (["2024-02-30", None, "1999-12-31"], "string"),
    "time": (["2024-02-29", "2024-02-29 10:11:12.5", "2024-02-29T10:11:12Z"], "timestamp"),
    "truth": (["true", "FALSE", None], "boolean"),
    "mixed": (["true", "1", None], "string"),
    "daynum": (["2024-02-29", "7", None], "string"),
    "zeros": (["0" * 30 + "7", "12", None], "int"),
    "infinite": (["Infinity", "+Inf", "1"], "double"),
    "slash": (["/1", "2", None], "string"),
    "nothing": ([None, None, None], "string"),
    "spaced": ([" 1", "2", None], "string"),
    "suffix": (["1d", "2", None], "string"),
    "a b(c)": (["x", None, None], "string"),
    "line": (["5\n", "2", None], "string"),
}


def table(spark, partitions=1):
    rows = list(zip(*(values for values, _ in COLUMNS.values())))
    return spark.createDataFrame(rows, ", ".join(f"`{c}` string" for c in COLUMNS)).repartition(partitions)


@pytest.mark.parametrize("partitions", [1, 3])
@pytest.mark.parametrize("ansi", ["true", "false"], indirect=True)
def test_types_do_not_depend_on_how_rows_are_dealt(spark, ansi, partitions):
    found = {r.column_name: r for r in column_profile(table(spark, partitions)).collect()}
    assert {c: r.data_type for c, r in found.items()} == {c: kind for c, (_, kind) in COLUMNS.items()}
    assert (found["a b(c)"].n_null, found["a b(c)"].n_rows, found["a b(c)"].longest) == (2, 3, 1)
    assert found["nothing"].longest is None


def test_an_empty_table(spark):
    rows = column_profile(table(spark).limit(0)).collect()
    assert {tuple(r)[1:] for r in rows} == {("string", 0, 0, None)}


@pytest.mark.parametrize(
    "kind, stored, fits",
    [
        ("int", "bigint", True),
        ("bigint", "int", False),
        ("int", "decimal(12,2)", True),
        ("int", "decimal(11,2)", False),
        ("decimal(20,0)", "decimal(22,2)", True),
        ("decimal(12,0)", "bigint", False),
        ("decimal(20,0)", "double", True),
        ("double", "decimal(38,2)", False),
        ("date", "timestamp", True),
        ("timestamp", "date", False),
        ("boolean", "int", False),
        ("string", "date", False),
        ("int", "string", True),
        ("int", "", False),
    ],
)
def test_what_fits_a_stored_type(kind, stored, fits):
    assert ColumnProfile("c", kind, 0, 2, 1).fits(stored) is fits
    assert ColumnProfile("c", kind, 2, 2, None).fits(stored)


def feed(tmp_path, name, text):
    folder = tmp_path / name
    folder.mkdir()
    (folder / f"{name}.csv").write_text(text)
    return str(folder)


def test_profiles_come_from_the_pass_that_writes(spark, tmp_path):
    uri = feed(tmp_path, "one", "code,day\n007,2024-01-31\n,2024-02-01\n")
    with profiled(read_csv(spark, uri, "string"), "file") as (stored, found):
        (tmp_path / "one" / "late.csv").write_text("code,day\nx,y\n")
        assert [tuple(r)[:2] for r in stored.orderBy("day").collect()] == [("007", "2024-01-31"), (None, "2024-02-01")]
        assert stored.filter(F.col("file").endswith("one.csv")).count() == 2
        plan = stored._jdf.queryExecution().toString().lower()
        assert "csv" not in plan.replace("one.csv", "")
    assert found == [ColumnProfile("code", "int", 1, 2, 3), ColumnProfile("day", "date", 0, 2, 10)]


def test_observed_types_are_those_of_a_second_scan(spark, database, tmp_path):
    uri = feed(tmp_path, "two", "A b,amount,day,note,at\n1,1.5,2024-01-31,,2024-01-31 10:00:00\n3000000000,2,2024-01-30,x,\n")
    root = medallion.Layout(bronze=database, root=shared_dir(spark))
    medallion.ingest(spark, uri, root, schema="observe", batch_id="1")
    observed = spark.table(root.raw_table)
    types, hashes = observed.dtypes, [r[0] for r in observed.select("_record_hash").orderBy("a_b").collect()]
    medallion.ingest(spark, uri, root, schema="infer", batch_id="1")
    inferred = spark.table(root.raw_table)
    assert types == inferred.dtypes
    assert hashes == [r[0] for r in inferred.select("_record_hash").orderBy("a_b").collect()]


def test_an_appended_batch_takes_the_tables_types_or_is_refused(spark, database, tmp_path):
    root = medallion.Layout(bronze=database, root=shared_dir(spark))
    first = feed(tmp_path, "a", "id,amount,day\n3000000000,1.5,2024-01-31\n")
    second = feed(tmp_path, "b", "id,amount,day\n7,2,\n")
    third = feed(tmp_path, "c", "id,amount,day\nseven,2,2024-01-31\n")
    medallion.ingest(spark, first, root, schema="observe", mode="append", batch_id="1")
    medallion.ingest(spark, second, root, schema="observe", mode="append", batch_id="2")
    with pytest.raises(ValueError, match="id: string into bigint"):
        medallion.ingest(spark, third, root, schema="observe", mode="append", batch_id="3")
    fourth = feed(tmp_path, "f", "id,amount,day,more\n7,2,2024-01-31,\n")
    with pytest.raises(ValueError, match="more: string into no column"):
        medallion.ingest(spark, fourth, root, schema="observe", mode="append", batch_id="4")
    rows = spark.table(root.raw_table).orderBy("id").collect()
    assert [(r.id, r.amount, str(r.day), r._batch_id) for r in rows] == [
        (7, 2.0, "None", "2"),
        (3000000000, 1.5, "2024-01-31", "1"),
    ]


def test_a_feed_with_a_column_named_like_lineage(spark, database, tmp_path):
    uri = feed(tmp_path, "d", "id,_source_file\n1,x\n")
    root = medallion.Layout(bronze=database, root=shared_dir(spark))
    medallion.ingest(spark, uri, root, schema="observe")
    assert spark.table(root.raw_table).first()._source_file.endswith("d.csv")


def test_the_stored_text_goes_after_the_block(spark, tmp_path):
    uri = feed(tmp_path, "e", "id\n1\n")
    with profiled(read_csv(spark, uri, "string"), "file") as (stored, _):
        path = stored.inputFiles()[0].rsplit("/", 1)[0]
        assert path.rsplit("/", 1)[1].startswith("stage-")
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(path)
