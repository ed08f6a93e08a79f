from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from caselake.sinks import tables


def content(df):
    return sorted(map(repr, df.select(*sorted(df.columns)).collect()))


def kv(spark, *rows):
    return spark.createDataFrame(rows, "k string, v int")


def pairs(spark, name):
    return sorted(((r.k or "", r.v) for r in spark.table(name).select("k", "v").collect()))


def files(spark, name):
    return tables.file_sizes(spark, name).count()


# ---- saving ---------------------------------------------------------------


def test_overwrite_replaces_rows_schema_and_partitioning(spark, database):
    name = f"{database}.t"
    tables.save_table(kv(spark, ("a", 1)), name)
    wide = spark.createDataFrame([("a", 1, "x"), (None, 2, "y")], "k string, n int, w string")
    tables.save_table(wide, name, partition_by=["k"])
    assert content(spark.table(name)) == content(wide)
    assert tables.partition_columns(spark, name) == ["k"]
    assert spark.table(name).filter("k IS NULL").first().w == "y"


def test_overwrite_may_read_its_own_table(spark, database):
    name = f"{database}.t"
    tables.save_table(kv(spark, ("a", 1), ("b", 2)), name)
    tables.save_table(spark.table(name).filter("v > 1"), name)
    assert pairs(spark, name) == [("b", 2)]


def test_a_failing_overwrite_leaves_the_table_as_it_was(spark, database):
    name = f"{database}.t"
    tables.save_table(kv(spark, ("a", 1)), name)
    broken = spark.table(name).withColumn("v", F.raise_error(F.lit("stop")).cast("int"))
    with pytest.raises(Exception, match="stop"):
        tables.save_table(broken, name)
    assert pairs(spark, name) == [("a", 1)]


def test_running_readers_keep_their_files_unless_told_otherwise(spark, database):
    name = f"{database}.t"
    tables.save_table(kv(spark, ("a", 1)), name)
    reader = spark.table(name)
    tables.save_table(kv(spark, ("a", 2)), name)
    assert reader.first().v == 1
    old = tables.table_location(spark, name)
    tables.save_table(kv(spark, ("a", 3)), name, keep_previous=False)
    assert pairs(spark, name) == [("a", 3)]
    path = spark._jvm.org.apache.hadoop.fs.Path(old)
    assert not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)


def test_append_matches_columns_by_name_and_keeps_partitions(spark, database):
    name = f"{database}.t"
    tables.save_table(kv(spark, ("a", 1)), name, mode="append", partition_by=["k"])
    tables.save_table(kv(spark, ("b", 2)).select("v", "k"), name, mode="append")
    assert pairs(spark, name) == [("a", 1), ("b", 2)]
    with pytest.raises(ValueError):
        tables.save_table(kv(spark, ("a", 1)), name, mode="ignore")


def test_rebalanced_write_has_few_files_and_splits_a_hot_partition(spark, database):
    df = spark.range(0, 300_000, 1, 8).selectExpr(
        "id", "sha2(string(id), 256) AS pad", "if(id % 3 > 0, 'hot', string(id % 5)) AS p"
    )
    loose, sized, split = (f"{database}.{n}" for n in ("loose", "sized", "split"))
    tables.save_table(df, loose, partition_by=["p"])
    tables.save_table(df, sized, partition_by=["p"], rebalance=True)
    tables.save_table(df, split, partition_by=["p"], rebalance=True, file_bytes=2 * 1024 * 1024)
    assert files(spark, loose) == 8 * 6
    assert files(spark, sized) == 6
    in_hot = tables.file_sizes(spark, split).filter("file_path LIKE '%p=hot%'").count()
    assert in_hot > 3
    assert spark.table(split).count() == 300_000
    assert spark.conf.get("spark.sql.adaptive.coalescePartitions.parallelismFirst") == "true"


# ---- upsert ---------------------------------------------------------------


def test_first_run_creates_the_table(spark, database):
    name = f"{database}.t"
    tables.upsert(kv(spark, ("a", 1), (None, 2)), name, ["k"])
    assert pairs(spark, name) == [("", 2), ("a", 1)]


def test_matched_new_and_vanished_keys(spark, database):
    name = f"{database}.t"
    tables.upsert(kv(spark, ("a", 1), ("b", 2)), name, ["k"])
    tables.upsert(kv(spark, ("b", 20), ("c", 30)).select("v", "k"), name, ["k"])
    assert pairs(spark, name) == [("a", 1), ("b", 20), ("c", 30)]
    tables.upsert(kv(spark, ("c", 31)), name, ["k"], delete_missing=True)
    assert pairs(spark, name) == [("c", 31)]


def test_null_keys_match_only_when_null_safe(spark, database):
    name = f"{database}.t"
    for value in (1, 2):
        tables.upsert(kv(spark, (None, value)), name, ["k"])
    assert pairs(spark, name) == [("", 1), ("", 2)]
    tables.upsert(kv(spark, (None, 3)), name, ["k"], null_safe=True)
    assert pairs(spark, name) == [("", 3)]


@pytest.mark.parametrize("null_safe", [True, False])
def test_upserting_twice_changes_nothing(spark, database, null_safe):
    name = f"{database}.t"
    tables.upsert(kv(spark, ("a", 1), ("b", 2)), name, ["k"], null_safe=null_safe)
    updates = [("b", 3), ("c", 4)] + ([(None, 5)] if null_safe else [])
    tables.upsert(kv(spark, *updates), name, ["k"], null_safe=null_safe)
    once = pairs(spark, name)
    tables.upsert(kv(spark, *updates), name, ["k"], null_safe=null_safe)
    assert pairs(spark, name) == once


def test_repeated_update_keys_are_an_error_and_write_nothing(spark, database):
    name = f"{database}.t"
    tables.upsert(kv(spark, ("a", 1)), name, ["k"])
    with pytest.raises(ValueError, match="'a'"):
        tables.upsert(kv(spark, ("a", 2), ("a", 3), ("z", 1)), name, ["k"])
    with pytest.raises(ValueError):
        tables.upsert(kv(spark, (None, 2), (None, 3)), name, ["k"], null_safe=True)
    assert pairs(spark, name) == [("a", 1)]
    tables.upsert(kv(spark, (None, 2), (None, 3)), name, ["k"])
    assert pairs(spark, name) == [("", 2), ("", 3), ("a", 1)]


def test_a_missing_column_is_an_error_and_types_follow_the_table(spark, database):
    name = f"{database}.t"
    tables.upsert(kv(spark, ("a", 1)), name, ["k"])
    with pytest.raises(Exception, match="v"):
        tables.upsert(kv(spark, ("a", 1)).drop("v"), name, ["k"])
    wider = spark.createDataFrame([("a", 7, "more")], "k string, v bigint, extra string")
    with pytest.raises(ValueError, match="extra"):
        tables.upsert(wider, name, ["k"])
    assert pairs(spark, name) == [("a", 1)]
    tables.upsert(wider, name, ["k"], drop_unknown=True)
    assert spark.table(name).dtypes == [("k", "string"), ("v", "int")]
    assert pairs(spark, name) == [("a", 7)]


def test_repeated_keys_are_refused_on_the_first_run_too(spark, database):
    with pytest.raises(ValueError, match="share one key"):
        tables.upsert(kv(spark, ("a", 1), ("a", 2)), f"{database}.t", ["k"])
    assert not spark.catalog.tableExists(f"{database}.t")


def test_partitioned_upserts_side_by_side_leave_other_partitions(spark, database):
    name, schema = f"{database}.t", "p string, k int, v int"
    tables.upsert(spark.range(400).selectExpr("string(id % 8) AS p", "int(id) AS k", "0 AS v"), name, ["p", "k"], partition_by=["p"])
    one, two = (spark.createDataFrame([(p, int(p), 1)], schema) for p in ("1", "2"))
    with ThreadPoolExecutor(2) as pool:
        list(pool.map(lambda rows: tables.upsert(rows, name, ["p", "k"]), (one, two)))
    assert spark.table(name).count() == 400 and spark.table(name).filter("v = 1").count() == 2
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").lower() == "static"


def test_a_failed_partition_write_keeps_the_new_rows(spark, database, monkeypatch):
    name = f"{database}.t"
    tables.upsert(spark.sql("SELECT 'p' AS p, 'a' AS k, 1 AS v"), name, ["p", "k"], partition_by=["p"])

    def fail(*args, **kwargs):
        raise OSError("full")

    monkeypatch.setattr("pyspark.sql.readwriter.DataFrameWriter.insertInto", fail)
    with pytest.raises(RuntimeError, match="kept in") as error:
        tables.upsert(spark.sql("SELECT 'p' AS p, 'b' AS k, 2 AS v"), name, ["p", "k"])
    kept = spark.read.parquet(str(error.value).rpartition(" ")[2])
    assert sorted(r.k for r in kept.collect()) == ["a", "b"]


def test_replaced_tables_are_removed_by_age(spark, database):
    name = f"{database}.t"
    for value in (1, 2, 3):
        tables.save_table(kv(spark, ("a", value)), name)
    assert tables.remove_replaced(spark, database) == []
    assert len(tables.remove_replaced(spark, database, min_age_hours=0)) == 2
    assert pairs(spark, name) == [("a", 3)] and tables.remove_replaced(spark, database, min_age_hours=0) == []


def test_only_changed_skips_the_write(spark, database):
    name = f"{database}.t"
    tables.upsert(kv(spark, ("a", 1), ("b", None)), name, ["k"])
    before = tables.table_location(spark, name)
    tables.upsert(kv(spark, ("a", 1), ("b", None)), name, ["k"], only_changed=True)
    assert tables.table_location(spark, name) == before
    tables.upsert(kv(spark, ("a", 1), ("b", 5)), name, ["k"], only_changed=True)
    assert pairs(spark, name) == [("a", 1), ("b", 5)]


def test_partitioned_upsert_rewrites_touched_partitions_only(spark, database):
    name = f"{database}.t"
    rows = [("p1", "a", 1), ("p1", "b", 2), ("p2", "a", 3), (None, "a", 4)]
    schema = "p string, k string, v int"
    tables.upsert(spark.createDataFrame(rows, schema), name, ["p", "k"], partition_by=["p"])
    untouched = {r.file_path for r in tables.file_sizes(spark, name).collect() if "p=p2" in r.file_path}
    update = [("p1", "b", 20), ("p3", "a", 5), (None, "a", 40)]
    tables.upsert(spark.createDataFrame(update, schema), name, ["p", "k"], null_safe=True)
    got = sorted((r.p or "", r.k, r.v) for r in spark.table(name).collect())
    assert got == [("", "a", 40), ("p1", "a", 1), ("p1", "b", 20), ("p2", "a", 3), ("p3", "a", 5)]
    now = {r.file_path for r in tables.file_sizes(spark, name).collect()}
    assert untouched and untouched <= now


def test_partitioned_upsert_beyond_the_listed_partitions(spark, database, monkeypatch):
    monkeypatch.setattr(tables, "LISTED_PARTITIONS", 2)
    name = f"{database}.t"
    old = spark.range(8).selectExpr("string(id) AS p", "'a' AS k", "int(id) AS v")
    tables.upsert(old, name, ["p", "k"], partition_by=["p"])
    tables.upsert(old.filter("v < 5").withColumn("v", F.col("v") + 100), name, ["p", "k"])
    assert sorted(r.v for r in spark.table(name).collect()) == [5, 6, 7, 100, 101, 102, 103, 104]


def test_merge_report_counts_every_outcome(spark):
    target = kv(spark, ("same", 1), ("old", 1), ("gone", 1), (None, 1))
    updates = kv(spark, ("same", 1), ("old", 2), ("new", 3), (None, 1))
    assert tuple(tables.merge_report(target, updates, ["k"]).first()) == (2, 1, 1, 2)
    assert tuple(tables.merge_report(target, updates, ["k"], null_safe=True).first()) == (1, 1, 2, 1)


# ---- layout ---------------------------------------------------------------


def grid(spark, rows=40_000, parts=16):
    return spark.range(0, rows, 1, parts).selectExpr(
        "id", "concat('a', id * 7919 % 40) AS a", "concat('b', id * 104729 % 41) AS b", "id % 3 AS p"
    )


def test_compaction_keeps_rows_and_reduces_files(spark, database):
    name = f"{database}.t"
    df = grid(spark)
    tables.save_table(df, name, partition_by=["p"])
    before = files(spark, name)
    tables.compact_table(spark, name)
    assert files(spark, name) == 3 < before == 48
    assert tables.partition_columns(spark, name) == ["p"]
    assert content(spark.table(name)) == content(df)


def test_compaction_leaves_well_filled_partitions_alone(spark, database):
    name = f"{database}.t"
    tables.save_table(grid(spark), name, partition_by=["p"], rebalance=True)
    grid(spark, 90, 6).filter("p = 2").select("id", "a", "b", "p").write.mode("append").partitionBy("p").saveAsTable(name)
    paths = tables.file_sizes(spark, name).withColumn("p", F.regexp_extract("file_path", "p=([0-9])", 1))
    before = {r.file_path for r in paths.filter("p <> 2").collect()}
    expected = content(spark.table(name))
    tables.compact_table(spark, name)
    after = paths.sparkSession.table(name).select("_metadata.file_path", "p").distinct().collect()
    assert {r.file_path for r in after if r.p != 2} == before and sum(r.p == 2 for r in after) == 1
    assert content(spark.table(name)) == expected


def test_more_files_make_finer_clusters():
    assert tables.z_bits(16, 2) == 6 and tables.z_bits(10_000, 2) == 9 and tables.z_bits(10**9, 2) == tables.MOST_BITS


def test_compaction_of_an_unpartitioned_table(spark, database):
    name = f"{database}.t"
    df = grid(spark)
    tables.save_table(df, name)
    tables.compact_table(spark, name, keep_previous=False)
    assert files(spark, name) == 1
    assert content(spark.table(name)) == content(df)


def files_per_value(spark, name, column):
    per = spark.table(name).groupBy(column).agg(F.countDistinct("_metadata.file_path").alias("n"))
    return per.agg(F.avg("n")).first()[0]


def test_clustering_by_one_and_by_two_columns(spark, database):
    name = f"{database}.t"
    df = grid(spark)
    tables.save_table(df, name)
    assert files_per_value(spark, name, "a") == files_per_value(spark, name, "b") == 16
    tables.cluster_table(spark, name, ["a"], files=16)
    assert content(spark.table(name)) == content(df)
    assert files_per_value(spark, name, "a") < 2 and files_per_value(spark, name, "b") > 12
    tables.cluster_table(spark, name, ["a", "b"], files=16)
    assert content(spark.table(name)) == content(df)
    assert files_per_value(spark, name, "a") < 9 and files_per_value(spark, name, "b") < 9


def test_clustering_spreads_a_hot_value_over_files(spark, database):
    name = f"{database}.t"
    df = spark.range(0, 60_000, 1, 4).selectExpr("if(id % 3 > 0, 'hot', string(id % 50)) AS a", "1 AS one")
    tables.save_table(df, name)
    tables.cluster_table(spark, name, ["a", "one"], files=12)
    largest = tables.file_sizes(spark, name).agg(F.max("rows")).first()[0]
    assert spark.table(name).count() == 60_000
    assert largest < 2 * 60_000 / 12


def test_clustering_deals_large_tables_to_more_files_than_asked_for(spark, database):
    name = f"{database}.t"
    df = spark.range(0, 20_000, 1, 4).selectExpr("id % 40 AS a", "id % 7 AS b", "uuid() AS u")
    tables.save_table(df, name)
    before = content(spark.table(name))
    tables.cluster_table(spark, name, ["a", "b"], files=2, file_bytes=tables.table_bytes(spark, name) // 8)
    sizes = tables.file_sizes(spark, name)
    assert 8 <= sizes.count() <= 10 and sizes.agg(F.max("rows")).first()[0] < 2 * 20_000 / 8
    assert content(spark.table(name)) == before


def test_clustering_with_nulls_other_types_and_partitions(spark, database):
    name = f"{database}.t"
    df = spark.range(0, 2000, 1, 4).selectExpr(
        "id % 2 AS p",
        "if(id % 10 = 0, null, date_add(DATE '2024-01-01', int(id % 90))) AS d",
        "cast(id % 17 AS decimal(10,2)) AS m",
        "cast(null AS string) AS nothing",
    )
    tables.save_table(df, name, partition_by=["p"])
    tables.cluster_table(spark, name, ["d", "m", "nothing"], files=6)
    assert content(spark.table(name)) == content(df)
    assert tables.partition_columns(spark, name) == ["p"]


def test_table_detail(spark, database):
    name = f"{database}.t"
    tables.save_table(grid(spark, 900, 2), name, partition_by=["p"])
    detail = tables.table_detail(spark, name).first()
    assert (detail.name, detail.format, detail.partition_columns) == (name, "parquet", ["p"])
    assert (detail.num_files, detail.num_rows) == (6, 900)
    assert detail.size_in_bytes > 0 and detail.location == tables.table_location(spark, name)
    tables.save_table(spark.table(name).limit(0), name)
    empty = tables.table_detail(spark, name).first()
    assert (empty.num_rows, empty.size_in_bytes, empty.partition_columns) == (0, 0, [])
