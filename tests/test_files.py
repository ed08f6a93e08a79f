"""Inventory, lease, and operators that replace single files of a table."""

from __future__ import annotations

import threading
import time
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from caselake.sinks import files, tables


def content(df):
    return sorted(map(repr, df.collect()))


def on_disk(spark, name):
    """Name, bytes and time of change of each file."""
    where = Path(files.table_location(spark, name).removeprefix("file:"))
    return {str(p): (p.read_bytes(), p.stat().st_mtime_ns) for p in where.rglob("*.parquet") if "_rewrite-" not in str(p)}


@pytest.fixture
def fifty(spark, database):
    """Fifty files of one hundred keys each."""
    name = f"{database}.fifty"
    tables.save_table(spark.range(0, 5000, 1, 50).selectExpr("id AS k", "id * 2 AS v", "id % 3 AS p"), name)
    return name


def updates(spark, *rows):
    return spark.createDataFrame(rows, "k bigint, v bigint, p bigint")


def test_one_key_replaces_one_file(spark, fifty):
    before = on_disk(spark, fifty)
    assert len(before) == 50
    tables.upsert(updates(spark, (42, -1, 0)), fifty, ["k"])
    after = on_disk(spark, fifty)
    assert len(before.items() & after.items()) == 49 and len(after) == 50
    assert spark.table(fifty).count() == 5000 and spark.table(fifty).filter("k = 42").first().v == -1


def test_new_keys_leave_all_files(spark, fifty):
    before = on_disk(spark, fifty)
    tables.upsert(updates(spark, (9000, 1, 1), (None, 2, 2)), fifty, ["k"], null_safe=True)
    after = on_disk(spark, fifty)
    assert before.items() <= after.items() and len(after) > 50
    tables.upsert(updates(spark, (9000, 3, 1), (None, 4, 2)), fifty, ["k"], null_safe=True)
    assert content(spark.table(fifty).filter("k IS NULL OR k > 5000").select("v")) == content(updates(spark, (0, 3, 0), (0, 4, 0)).select("v"))
    assert before.items() <= on_disk(spark, fifty).items()


def test_many_keys_rewrite_the_table(spark, fifty):
    where = files.table_location(spark, fifty)
    tables.upsert(spark.table(fifty).filter("k % 100 = 1").withColumn("v", F.lit(7).cast("bigint")), fifty, ["k"])
    assert files.table_location(spark, fifty) != where
    assert spark.table(fifty).filter("v = 7").count() == 50 and spark.table(fifty).count() == 5000


def test_a_failed_write_changes_nothing(spark, fifty):
    before, rows = on_disk(spark, fifty), content(spark.table(fifty))
    broken = spark.table(fifty).filter("k = 7").withColumn("v", F.expr("assert_true(k < 0)").cast("bigint"))
    with files.lease(spark, fifty) as held, pytest.raises(Exception, match="assert_true|USER_RAISED"):
        files.replace_files(broken, fifty, [], held)
    assert on_disk(spark, fifty) == before and content(spark.table(fifty)) == rows
    assert not [p for p in Path(files.table_location(spark, fifty).removeprefix("file:")).iterdir() if "_rewrite" in p.name]


def test_a_final_replacement_is_completed_by_the_next_writer(spark, fifty, monkeypatch):
    real = files.finish_rewrites

    def stop(spark, name):
        raise OSError("the driver is gone")

    monkeypatch.setattr(files, "finish_rewrites", stop)
    with pytest.raises(OSError, match="gone"):
        tables.upsert(updates(spark, (42, -1, 0)), fifty, ["k"])
    assert spark.table(fifty).filter("v = -1").count() == 0 and spark.table(fifty).count() == 5000
    monkeypatch.setattr(files, "finish_rewrites", real)
    tables.upsert(updates(spark, (43, -2, 0)), fifty, ["k"])
    assert sorted(r.k for r in spark.table(fifty).filter("v < 0").collect()) == [42, 43]
    assert spark.table(fifty).count() == 5000


def test_partitions_that_the_key_does_not_decide(spark, database):
    """A row may move to another partition, also a new one with an odd name."""
    name = f"{database}.t"
    df = spark.range(0, 400, 1, 4).selectExpr("id AS k", "id AS v", "concat('a b/', id % 5, '%') AS p")
    tables.save_table(df, name, partition_by=["p"])
    before = on_disk(spark, name)
    moved = spark.createDataFrame([(7, -1, "new: 1"), (8, -2, None)], "k bigint, v bigint, p string")
    tables.upsert(moved, name, ["k"])
    assert len(before.items() & on_disk(spark, name).items()) == 18
    expected = df.filter("k NOT IN (7, 8)").union(moved)
    assert content(spark.table(name).select("k", "v", "p")) == content(expected)


def test_compaction_replaces_small_files_only(spark, database):
    name = f"{database}.t"
    big = spark.range(0, 600_000, 1, 6).selectExpr("id", "uuid() AS x")
    tables.save_table(big, name)
    spark.range(0, 4, 1, 4).selectExpr("id", "'y' AS x").write.mode("append").saveAsTable(name)
    before, rows = on_disk(spark, name), spark.table(name).count()
    tables.compact_table(spark, name, file_bytes=2_000_000)
    after = on_disk(spark, name)
    assert len(before) == 10 and len(after) == 7 and len(before.items() & after.items()) == 6
    assert spark.table(name).count() == rows


def test_inventory_reads_no_rows(spark, fifty):
    listed = files.table_files(spark, fifty)
    assert listed.count() == 50 and listed.agg(F.sum("size")).first()[0] == sum(len(b) for b, _ in on_disk(spark, fifty).values())
    assert "parquet" not in listed._jdf.queryExecution().executedPlan().toString().split("Location")[0].lower().replace("binaryfile", "")
    plan = files.table_rows(spark, fifty)._jdf.queryExecution().toString()
    assert "PushedAggregation: [COUNT(*)]" in plan and files.table_rows(spark, fifty).first().rows == 5000


@pytest.mark.parametrize("columns", [["k"], ["p", "v"]])
def test_clustering_again_changes_nothing_and_an_append_little(spark, database, columns):
    name = f"{database}.t"
    df = spark.range(0, 40_000, 1, 8).selectExpr("id * 7919 % 40000 AS k", "id * 104729 % 1000 AS v", "id % 977 AS p")
    tables.save_table(df, name)
    tables.cluster_table(spark, name, columns, files=16)
    first = on_disk(spark, name)
    tables.cluster_table(spark, name, columns, files=16)
    assert on_disk(spark, name) == first and len(first) == 16
    more = spark.range(0, 200, 1, 2).selectExpr("100 + id % 50 AS k", "id % 45 AS v", "id % 47 AS p")
    more.write.mode("append").saveAsTable(name)
    tables.cluster_table(spark, name, columns, files=16)
    second = on_disk(spark, name)
    assert 8 <= len(first.items() & second.items()) < 16
    assert content(spark.table(name)) == content(df.union(more))
    tables.cluster_table(spark, name, columns, files=16)
    assert on_disk(spark, name) == second


def test_groups_between_files_that_stay(spark, database):
    """Two overlapping groups with a file between them: no new file reaches over it."""
    name = f"{database}.t"
    tables.save_table(spark.range(0, 3000, 1, 3).selectExpr("id AS k"), name)
    tables.cluster_table(spark, name, ["k"], files=6)
    first = on_disk(spark, name)
    for low in (10, 2900):
        spark.range(low, low + 20, 1, 1).selectExpr("id AS k").write.mode("append").saveAsTable(name)
    tables.cluster_table(spark, name, ["k"], files=6)
    assert len(first.items() & on_disk(spark, name).items()) == 4
    assert tables.overlapping_files(spark.table(name), F.col("k"), []).count() == 0


def test_writers_wait_for_each_other(spark, fifty):
    order = []

    def write(key):
        try:
            tables.upsert(updates(spark, (key, -key, 0)), fifty, ["k"])
            order.append(key)
        except Exception as error:
            order.append(str(error))

    threads = [threading.Thread(target=write, args=(key,)) for key in (1, 2, 3)]
    with files.lease(spark, fifty, owner="the test"):
        for t in threads:
            t.start()
        time.sleep(2)
        assert not order
    for t in threads:
        t.join()
    assert sorted(order) == [1, 2, 3]
    assert sorted(r.v for r in spark.table(fifty).filter("v < 0").collect()) == [-3, -2, -1]


def test_two_first_runs(spark, database):
    name = f"{database}.first"
    errors = []

    def write(key):
        try:
            tables.upsert(updates(spark, (key, key, 0)), name, ["k"])
        except Exception as error:
            errors.append(error)

    threads = [threading.Thread(target=write, args=(key,)) for key in (1, 2, 3)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert errors == []
    assert sorted(r.k for r in spark.table(name).collect()) == [1, 2, 3]


def test_a_lease_names_its_owner_and_expires(spark, fifty):
    def elsewhere(act):
        caught = []

        def run():
            try:
                act()
            except Exception as error:
                caught.append(error)

        t = threading.Thread(target=run)
        t.start()
        t.join()
        return caught

    def take(**how):
        with files.lease(spark, fifty, **how):
            pass

    with files.lease(spark, fifty, owner="nightly load"):
        (error,) = elsewhere(lambda: take(wait_seconds=0))
        assert isinstance(error, files.LeaseError) and "nightly load" in str(error)
    with files.lease(spark, fifty, owner="slow", seconds=0.1) as held:
        time.sleep(0.3)
        assert not elsewhere(lambda: take(wait_seconds=0))
        with pytest.raises(files.LeaseError, match="slow lost"):
            held.confirm()
