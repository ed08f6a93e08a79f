"""Writing parquet tables, and the operators that replace a table's content.

Every table is external, in a folder of its own below its database's
location. A replacement is written completely under a new name first; then two
metadata operations (drop the old entry, rename the new one) put it in place.
So the data is written once, a job that fails half-way leaves the old table
as it was, and readers that already run keep their files. The two metadata operations
are not one transaction: a query that starts between them does not find the
table. Writers of one table are kept apart by a lease (:mod:`caselake.sinks.files`).

An upsert or a clustering that changes few of a table's files replaces those
alone, in place.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from caselake.session import (
    folder_bytes,
    fresh_path,
    remove_old,
    remove_path,
    settings,
    shuffle_sized,
    staged,
)
from caselake.sinks.files import (
    GROUP,
    LEASES,
    Lease,
    finish_rewrites,
    lease,
    partition_columns,
    plain_paths,
    read_files,
    read_note,
    replace_files,
    table_files,
    table_location,
    table_rows,
    write_note,
)

FILE_BYTES = 128 * 1024 * 1024
# Up to this many touched partitions are listed as literals for static pruning.
LISTED_PARTITIONS = 1000
# Clustering: tasks that rows are dealt to, bits of a column's range number, rows drawn for each range.
MOST_RANGES, MOST_BITS, DRAWN_PER_RANGE = 20_000, 10, 40
# Up to this many files, and this share of a table's files, are replaced one by one; beyond that all of them are.
REPLACED_FILES, REPLACED_SHARE = 10_000, 0.5
# Where a table's folder says how its files were clustered.
CLUSTERING = "_clustering.json"


def _split(name: str) -> tuple[str, str]:
    database, _, table = name.rpartition(".")
    return database or "default", table


def table_bytes(spark: SparkSession, name: str) -> int:
    """Bytes of a table's files, from the file system: no file is opened."""
    return folder_bytes(spark, table_location(spark, name))


def _sized_for(file_bytes: int) -> dict[str, str]:
    return {"spark.sql.adaptive.advisoryPartitionSizeInBytes": str(file_bytes)}


def save_table(
    df: DataFrame,
    name: str,
    mode: str = "overwrite",
    partition_by: Sequence[str] = (),
    rebalance: bool = False,
    keep_previous: bool = True,
    file_bytes: int = FILE_BYTES,
    most_rows: int = 0,
) -> None:
    """Write ``df`` as table ``name``; overwriting also replaces schema and partitioning.

    ``df`` may read the table it replaces. ``rebalance`` adds one shuffle that
    gathers each partition value's rows into files of about ``file_bytes`` and
    splits the large ones over several tasks; without it every task writes a
    file for every partition value it sees. ``keep_previous=False`` deletes
    the replaced files, which breaks readers that still use them. A task
    starts a new file after ``most_rows`` rows, if given.
    """
    spark = df.sparkSession
    if rebalance:
        df = df.hint("rebalance", *partition_by)
    if mode not in ("overwrite", "append"):
        raise ValueError(f"mode must be 'overwrite' or 'append', not {mode!r}")
    with settings(spark, _sized_for(file_bytes) if rebalance else {}), lease(spark, name) as held:
        if mode == "append" and spark.catalog.tableExists(name):
            df.write.mode("append").partitionBy(*partition_columns(spark, name)).saveAsTable(name)
        else:
            _write_and_swap(df, name, partition_by, keep_previous, most_rows, held)


def _write_and_swap(
    df: DataFrame, name: str, partition_by: Sequence[str], keep_previous: bool, most_rows: int, held: Lease
) -> None:
    spark = df.sparkSession
    database, table = _split(name)
    fresh = f"{table}__{uuid.uuid4().hex}"
    root = spark.catalog.getDatabase(database).locationUri.rstrip("/")
    writer = df.write.format("parquet").option("path", f"{root}/{fresh}").option("maxRecordsPerFile", most_rows)
    writer.partitionBy(*partition_by).saveAsTable(f"{database}.{fresh}")
    held.confirm()
    replaced = table_location(spark, name) if spark.catalog.tableExists(name) else None
    spark.sql(f"DROP TABLE IF EXISTS {database}.{table}")
    spark.sql(f"ALTER TABLE {database}.{fresh} RENAME TO {database}.{table}")
    if replaced and not keep_previous:
        remove_path(spark, replaced)


def _same_key(left: str, right: str, keys: Sequence[str], null_safe: bool) -> Column:
    pairs = [(F.col(f"{left}.{k}"), F.col(f"{right}.{k}")) for k in keys]
    equal = [a.eqNullSafe(b) if null_safe else a == b for a, b in pairs]
    return reduce(lambda a, b: a & b, equal)


def merge_rows(
    target: DataFrame,
    updates: DataFrame,
    keys: Sequence[str],
    null_safe: bool = False,
    delete_missing: bool = False,
    drop_unknown: bool = False,
) -> DataFrame:
    """Target rows whose key is not in ``updates``, and all of ``updates``.

    With the default plain equality a NULL key matches nothing: the target's
    row stays and the update is added beside it.
    """
    updates = _aligned(updates, target, drop_unknown)
    if delete_missing:
        return updates
    matched = _same_key("t", "u", keys, null_safe)
    kept = target.alias("t").join(updates.select(*keys).alias("u"), matched, "left_anti")
    return kept.unionByName(updates)


def _aligned(updates: DataFrame, target: DataFrame, drop_unknown: bool = False) -> DataFrame:
    """``updates`` with the columns and types of ``target``; a column that it lacks is an error unless dropped."""
    unknown = [c for c in updates.columns if c not in target.columns]
    if unknown and not drop_unknown:
        raise ValueError(f"the table lacks the update columns {unknown}; drop_unknown=True leaves them out")
    return updates.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in target.schema])


def merge_report(
    target: DataFrame, updates: DataFrame, keys: Sequence[str], null_safe: bool = False
) -> DataFrame:
    """How many rows a merge inserts, updates, leaves unchanged and keeps unmatched."""
    updates = _aligned(updates, target)
    values = [c for c in target.columns if c not in keys]
    old = target.withColumn("__old", F.lit(True)).alias("t")
    new = updates.withColumn("__new", F.lit(True)).alias("u")
    both = old.join(new, _same_key("t", "u", keys, null_safe), "full_outer")
    same = reduce(
        lambda a, b: a & b,
        [F.col(f"t.{c}").eqNullSafe(F.col(f"u.{c}")) for c in values],
        F.lit(True),
    )
    was, comes = F.col("__old").isNotNull(), F.col("__new").isNotNull()
    return both.agg(
        F.count_if(comes & ~was).alias("inserted"),
        F.count_if(comes & was & ~same).alias("updated"),
        F.count_if(comes & was & same).alias("unchanged"),
        F.count_if(was & ~comes).alias("kept"),
    )


def _reject_repeated_keys(updates: DataFrame, keys: Sequence[str], null_safe: bool) -> None:
    # Under plain equality a NULL key matches no row, so repeating it is no conflict.
    rows = updates if null_safe else updates.dropna(subset=list(keys))
    repeated = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).filter("copies > 1")
    example = repeated.first()
    if example is not None:
        raise ValueError(f"several update rows share one key, for example {example.asDict()}")


def upsert(
    updates: DataFrame,
    name: str,
    keys: Sequence[str],
    null_safe: bool = False,
    delete_missing: bool = False,
    only_changed: bool = False,
    partition_by: Sequence[str] = (),
    keep_previous: bool = True,
    drop_unknown: bool = False,
) -> None:
    """Create table ``name`` from ``updates``, or merge them in by ``keys``.

    Matching rows are replaced whole, new keys are added, other rows stay
    (unless ``delete_missing``). Two update rows with one key are an error,
    raised before anything is written, on the first run too. So are columns
    that the table lacks, unless ``drop_unknown`` leaves them out.
    ``only_changed`` leaves out update rows that the table already holds, and
    writes nothing if none remains.

    Where the keys cover the table's partition columns, only the partitions
    that occur in ``updates`` are read and rewritten, and upserts of different
    partitions may run side by side. In other tables the files that hold a
    matched key are found by a scan of the key columns; if they are few, they
    alone are replaced and all others stay as they are. New keys come in files
    of their own. With ``delete_missing``, or if most files hold a matched
    key, the table is rewritten whole.
    """
    spark = updates.sparkSession
    how = (name, keys, null_safe, delete_missing, only_changed, keep_previous, drop_unknown)
    if spark.catalog.tableExists(name) and _covered(spark, name, keys) and not delete_missing:
        _upsert_existing(updates, *how)
        return
    with lease(spark, name):
        if spark.catalog.tableExists(name):
            _upsert_existing(updates, *how)
            return
        with staged(updates) as fixed:
            _reject_repeated_keys(fixed, keys, null_safe)
            save_table(fixed, name, partition_by=partition_by)


def _covered(spark: SparkSession, name: str, keys: Sequence[str]) -> bool:
    """Whether the keys decide a row's partition."""
    parts = partition_columns(spark, name)
    return bool(parts) and set(parts) <= set(keys)


def _upsert_existing(
    updates: DataFrame,
    name: str,
    keys: Sequence[str],
    null_safe: bool,
    delete_missing: bool,
    only_changed: bool,
    keep_previous: bool,
    drop_unknown: bool,
) -> None:
    target = updates.sparkSession.table(name)
    with staged(_aligned(updates, target, drop_unknown)) as fixed:
        _reject_repeated_keys(fixed, keys, null_safe)
        if not only_changed or delete_missing:
            _merge_into(fixed, target, name, keys, null_safe, delete_missing, keep_previous)
            return
        same = _same_key("u", "t", target.columns, True)
        with staged(fixed.alias("u").join(target.alias("t"), same, "left_anti")) as changed:
            if not changed.isEmpty():
                _merge_into(changed, target, name, keys, null_safe, False, keep_previous)


def _merge_into(
    fixed: DataFrame,
    target: DataFrame,
    name: str,
    keys: Sequence[str],
    null_safe: bool,
    delete_missing: bool,
    keep_previous: bool,
) -> None:
    spark = target.sparkSession
    parts = partition_columns(spark, name)
    if _covered(spark, name, keys) and not delete_missing:
        touched = _touched(target, fixed, parts)
        _overwrite_partitions(merge_rows(touched, fixed, keys, null_safe).select(*target.columns), name, parts)
        return
    with lease(spark, name) as held:
        finish_rewrites(spark, name)
        old = None if delete_missing else files_to_replace(_matched_files(target, fixed, keys, null_safe), name)
        if old is None:
            merged = merge_rows(target, fixed, keys, null_safe, delete_missing)
            save_table(merged, name, partition_by=parts, keep_previous=keep_previous)
        else:
            merged = merge_rows(read_files(spark, name, old), fixed, keys, null_safe)
            replace_files(merged.select(*target.columns), name, old, held)


def _matched_files(target: DataFrame, updates: DataFrame, keys: Sequence[str], null_safe: bool) -> DataFrame:
    """Column ``file_path``: the files of ``target`` with a key of ``updates``; reads the key columns only.

    The updates' range of the first key is pushed down to the scan, which
    skips files and row groups by their minima and maxima.
    """
    first = F.col(f"`{keys[0]}`")
    low, high = updates.agg(F.min(first), F.max(first)).first()
    near = F.lit(False) if low is None else first.between(F.lit(low), F.lit(high))
    near = near | first.isNull() if null_safe else near
    rows = target.filter(near).select(*keys, "_metadata.file_path")
    matched = rows.alias("t").join(updates.select(*keys).alias("u"), _same_key("t", "u", keys, null_safe), "left_semi")
    return matched.select("file_path").distinct()


def files_to_replace(found: DataFrame, name: str) -> list[str] | None:
    """The paths in ``found`` if they are few enough to be replaced one by one."""
    spark = found.sparkSession
    listed = [row[0] for row in found.limit(REPLACED_FILES + 1).collect()]
    if len(listed) > min(REPLACED_FILES, REPLACED_SHARE * table_files(spark, name).count()):
        return None
    return sorted(plain_paths(spark, listed))


def _overwrite_partitions(
    df: DataFrame, name: str, parts: Sequence[str], file_bytes: int = FILE_BYTES
) -> None:
    """Replace the partitions that occur in ``df`` and no others.

    The rows are written to the shared folder first, since ``df`` may read what
    it replaces. Which partitions go is a setting, so the write has a session
    of its own, whose settings no other thread can change. If the write fails,
    partitions may be half replaced; the written copy then stays and the error
    names it.
    """
    spark = df.sparkSession
    copy = fresh_path(spark, "stage")
    df.write.parquet(copy)
    own = spark.newSession()
    own.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    own.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", str(file_bytes))
    own.conf.set("spark.sql.adaptive.coalescePartitions.parallelismFirst", "false")
    own.conf.set("spark.sql.shuffle.partitions", spark.conf.get("spark.sql.shuffle.partitions"))
    try:
        rows = own.read.schema(df.schema).parquet(copy)
        rows.hint("rebalance", *parts).write.insertInto(name, overwrite=True)
    except Exception as error:
        raise RuntimeError(f"replacing partitions of {name} failed; their new rows are kept in {copy}") from error
    spark.catalog.refreshTable(name)
    remove_path(spark, copy)


def replace_partitions(df: DataFrame, name: str) -> None:
    """Replace the partitions of table ``name`` that occur in ``df``; columns go by name."""
    spark = df.sparkSession
    _overwrite_partitions(df.select(*spark.table(name).columns), name, partition_columns(spark, name))


def _touched(target: DataFrame, updates: DataFrame, parts: Sequence[str]) -> DataFrame:
    """Target rows in the partitions that occur in ``updates``."""
    values = updates.select(*parts).distinct()
    listed = values.limit(LISTED_PARTITIONS + 1).collect()
    if len(listed) > LISTED_PARTITIONS:
        matched = _same_key("t", "p", parts, True)
        return target.alias("t").join(values.alias("p"), matched, "left_semi")
    one_of = [
        reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.lit(row[c])) for c in parts]) for row in listed
    ]
    return target.filter(reduce(lambda a, b: a | b, one_of, F.lit(False)))


def remove_replaced(spark: SparkSession, database: str, min_age_hours: float = 24.0) -> list[str]:
    """Delete the folders of replaced tables below a database's location; returns what went.

    Folders of its tables, and folders younger than ``min_age_hours``, stay:
    a reader that started before a replacement still uses the old files, and a
    writer that has not put its table in place yet is new.
    """
    root = spark.catalog.getDatabase(database).locationUri
    live = [table_location(spark, f"{database}.{t.name}") for t in spark.catalog.listTables(database) if not t.isTemporary]
    return remove_old(spark, root, keep=[*live, f"{root.rstrip('/')}/{LEASES}"], min_age_hours=min_age_hours)


def _small_partitions(spark: SparkSession, name: str, parts: Sequence[str], file_bytes: int) -> DataFrame:
    """Partition values with several files of less than half of ``file_bytes`` on average, from file listings."""
    sized = table_files(spark, name).groupBy(*parts).agg(F.count(F.lit(1)).alias("files"), F.avg("size").alias("mean"))
    return sized.filter((F.col("files") > 1) & (F.col("mean") < file_bytes / 2)).select(*parts)


def compact_table(
    spark: SparkSession, name: str, file_bytes: int = FILE_BYTES, keep_previous: bool = True
) -> None:
    """Rewrite what has small files into files of about ``file_bytes``; rows and schema stay.

    Of a partitioned table only partitions with several small files are read
    and rewritten, the others keep their files. One read, one shuffle and (for
    partitions, which are replaced in place) one copy. The rebalance splits
    large partitions by measured size, so one huge value spreads over tasks.
    Of an unpartitioned table the files of less than half of ``file_bytes`` are
    replaced, all at once if they are most. What is small is told from file
    listings; no row is read for that.
    """
    # File size goes before parallelism here; elsewhere the shuffles ahead of
    # the write would lose their parallelism too.
    by_size = settings(spark, {"spark.sql.adaptive.coalescePartitions.parallelismFirst": "false"})
    parts = partition_columns(spark, name)
    table = spark.table(name)
    with by_size, shuffle_sized(spark, table_bytes(spark, name)), lease(spark, name) as held:
        finish_rewrites(spark, name)
        if parts:
            with staged(_small_partitions(spark, name, parts, file_bytes)) as small:
                if not small.isEmpty():
                    _overwrite_partitions(_touched(table, small, parts), name, parts, file_bytes)
            return
        small = table_files(spark, name).filter(F.col("size") < file_bytes / 2)
        count = small.count()
        if count < 2:
            return
        if count <= min(REPLACED_FILES, REPLACED_SHARE * table_files(spark, name).count()):
            old = sorted(row.path for row in small.collect())
            with settings(spark, _sized_for(file_bytes)):
                replace_files(read_files(spark, name, old), name, old, held)
        else:
            save_table(table, name, rebalance=True, keep_previous=keep_previous, file_bytes=file_bytes)


def file_sizes(spark: SparkSession, name: str) -> DataFrame:
    """Path, bytes and rows of each non-empty file, by a scan that reads no column; for a closer look at a layout."""
    source = spark.table(name).select("_metadata.file_path", "_metadata.file_size")
    return source.groupBy("file_path", "file_size").agg(F.count(F.lit(1)).alias("rows"))


def table_detail(spark: SparkSession, name: str) -> DataFrame:
    """One row: name, location, partition columns, files, bytes, rows; from listings and footers, without reading rows.

    The files of a table without rows count as none.
    """
    parts = F.array(*[F.lit(c) for c in partition_columns(spark, name)]).cast("array<string>")
    rows = table_rows(spark, name).first()["rows"] or 0
    size = F.coalesce(F.sum("size"), F.lit(0)).alias("size_in_bytes")
    listed = table_files(spark, name).filter(F.lit(rows > 0)).agg(F.count(F.lit(1)).alias("num_files"), size)
    return listed.select(
        F.lit(name).alias("name"),
        F.lit("parquet").alias("format"),
        F.lit(table_location(spark, name)).alias("location"),
        parts.alias("partition_columns"),
        "num_files",
        "size_in_bytes",
        F.lit(rows).cast("bigint").alias("num_rows"),
    )


def _range_bounds(df: DataFrame, columns: Sequence[str], ranges: int) -> dict[str, list]:
    """Upper bounds of about ``ranges`` ranges of each column, with about equally many values of a sample.

    One pass draws rows for all columns; as many reach the driver as the
    ranges ask for, however large the table. Works for any orderable type.
    """
    wanted = ranges * DRAWN_PER_RANGE
    share = min(1.0, 1.2 * wanted / max(1, df.count()))  # row counts come from the files' footers
    drawn = df.select(*columns).sample(share, seed=1).limit(2 * wanted).collect()
    bounds = {}
    for name in columns:
        values = sorted({r[name] for r in drawn if r[name] is not None and r[name] == r[name]})
        bounds[name] = values[:: max(1, len(values) // ranges)][1:]
    return bounds


def _range_of(column: Column, bounds: Sequence, kind: str) -> Column:
    """How many of the sorted ``bounds`` are at most ``column``, by binary search; 0 for NULL."""
    if not bounds:
        return F.lit(0).cast("bigint")
    held = F.array(*[F.lit(b).cast(kind) for b in bounds])
    steps = [1 << i for i in reversed(range(len(bounds).bit_length()))]
    return F.aggregate(
        F.array(*map(F.lit, steps)).cast("array<bigint>"),
        F.lit(0).cast("bigint"),
        lambda low, step: F.when(F.get(held, low + step - 1) <= column, low + step).otherwise(low),
    )


def _spread(number: Column, bits: int, stride: int, offset: int) -> Column:
    """The low ``bits`` of ``number``, ``stride`` places apart."""
    one = [F.shiftleft(F.shiftright(number, i).bitwiseAND(F.lit(1).cast("bigint")), i * stride + offset) for i in range(bits)]
    return reduce(lambda a, b: a.bitwiseOR(b), one)


def _z(df: DataFrame, columns: Sequence[str], bounds: dict[str, Sequence], bits: int) -> Column:
    kinds = dict(df.dtypes)
    z = F.lit(0).cast("bigint")
    for offset, name in enumerate(columns):
        number = _range_of(F.col(f"`{name}`"), bounds[name], kinds[name])
        z = z.bitwiseOR(_spread(number, bits, len(columns), offset))
    return z


def z_value(df: DataFrame, columns: Sequence[str], bits: int = 6) -> Column:
    """Bit-interleaved range numbers of ``columns``: near in all columns means near in value."""
    return _z(df, columns, _range_bounds(df, columns, 2**bits), bits)


def z_bits(files: int, columns: int) -> int:
    """Bits per column: some sixteen cells for each file, between 6 and ``MOST_BITS`` bits a column."""
    return max(6, min(MOST_BITS, -(-(files.bit_length() + 4) // columns)))


def cluster_table(
    spark: SparkSession,
    name: str,
    columns: Sequence[str],
    file_bytes: int = FILE_BYTES,
    files: int | None = None,
    keep_previous: bool = True,
) -> None:
    """Rewrite a table so that rows close in ``columns`` share files; rows stay.

    The first run, or one over other columns, rewrites everything. One column is range-partitioned and sorted as is;
    several go through :func:`z_value`, with more ranges the more files there are. The row's file
    position ends the range key: it lets rows with equal clustering values,
    however many, spread over several tasks, and it is the same when a lost
    task runs again. ``files`` is how many files the rows are dealt to at
    least; there are more where these would exceed ``file_bytes``. At most ``MOST_RANGES`` tasks share the rows, each of
    which writes several files in order if there are more. The table is read
    three times at most: for the bounds, by the range partitioner's sample, and
    for the write.

    The table's folder notes the columns and bounds. A later run over the same columns
    reads them only, finds the files whose ranges overlap, and replaces those
    (:func:`_cluster_overlapping`); it rewrites everything again once most files overlap or the
    table has outgrown the bounds.
    """
    with lease(spark, name) as held:
        finish_rewrites(spark, name)
        size = table_bytes(spark, name)
        wanted = max(1, -(-size // file_bytes), files or 1)
        bits = z_bits(wanted, len(columns))
        note = read_note(spark, f"{table_location(spark, name)}/{CLUSTERING}")
        known = note is not None and note["columns"] == list(columns) and note["bits"] == bits
        if known and _cluster_overlapping(spark, name, note, -(-size // wanted), held):
            return
        bounds = _cluster_whole(spark, name, columns, wanted, bits, keep_previous)
        text = {c: [None if b is None else str(b) for b in values] for c, values in bounds.items()}
        note = {"columns": list(columns), "bits": bits, "bounds": text}
        write_note(spark, f"{table_location(spark, name)}/{CLUSTERING}", note)


def _arranged(keyed: DataFrame, ranges: int, leading: Sequence[str], columns: Sequence[str]) -> DataFrame:
    ranged = keyed.repartitionByRange(ranges, *leading, "__place", "__position")
    return ranged.sortWithinPartitions(*leading, "__place", *columns)


def _position() -> Column:
    return F.xxhash64("_metadata.file_path", "_metadata.row_index")


def _cluster_whole(
    spark: SparkSession, name: str, columns: Sequence[str], files: int, bits: int, keep_previous: bool
) -> dict[str, Sequence]:
    """Rewrite all files; returns the bounds of the ranges of each column, if several make a place."""
    table = spark.table(name)
    parts = partition_columns(spark, name)
    # One column is its own place; a table of one file is sorted by the first.
    bounds = _range_bounds(table, columns, 2**bits) if len(columns) > 1 and files > 1 else {}
    place = _z(table, columns, bounds, bits) if bounds else F.col(columns[0])
    keyed = table.withColumns({"__place": place, "__position": _position()})
    arranged = _arranged(keyed, min(files, MOST_RANGES), parts, columns).select(*table.columns)
    limit = -(-table.count() // files) if files > MOST_RANGES else 0
    save_table(arranged, name, partition_by=parts, keep_previous=keep_previous, most_rows=limit)
    return bounds


def overlapping_files(table: DataFrame, place: Column, parts: Sequence[str]) -> DataFrame:
    """``file_path, file_size, group`` of the files whose range of ``place`` overlaps another one's in their partition.

    Ranges that only share an end do not overlap, so equal values may fill
    several files. Files that overlap directly or by way of others are of one ``group``.
    """
    each = table.select(*parts, place.alias("__place"), "_metadata.file_path", "_metadata.file_size")
    ranges = each.groupBy(*parts, "file_path", "file_size").agg(F.min("__place").alias("low"), F.max("__place").alias("high"))
    # As many rows as files.
    order = Window.partitionBy(*parts).orderBy(F.col("low").asc_nulls_first(), "high", "file_path")
    before = F.max("high").over(order.rowsBetween(Window.unboundedPreceding, -1))
    after = F.min("low").over(order.rowsBetween(1, Window.unboundedFollowing))
    apart = ranges.withColumns({"before": before, "after": after})
    apart = apart.withColumn("begins", F.coalesce(F.col("before") <= F.col("low"), F.lit(True)).cast("int"))
    numbered = apart.withColumn("group", F.sum("begins").over(order))
    overlaps = (F.col("begins") == 0) | F.coalesce(F.col("after") < F.col("high"), F.lit(False))
    return numbered.filter(overlaps).select("file_path", "file_size", "group")


def _cluster_overlapping(spark: SparkSession, name: str, note: dict, file_bytes: int, held: Lease) -> bool:
    """Replace the files that overlap by ones that do not; False if they are too many for that.

    A file holds rows of one group only, so no new file reaches over one that stayed.
    """
    table, columns = spark.table(name), note["columns"]
    parts = partition_columns(spark, name)

    def placed(df: DataFrame) -> Column:
        return _z(df, columns, note["bounds"], note["bits"]) if note["bounds"] else F.col(f"`{columns[0]}`")

    with staged(overlapping_files(table, placed(table), parts)) as found:
        old = files_to_replace(found.select("file_path"), name)
        if not old:
            return old is not None
        size = found.agg(F.sum("file_size")).first()[0]
        rows = read_files(spark, name, old)
        rows = rows.withColumns({"__place": placed(rows), "__position": _position(), "__file": F.col("_metadata.file_path")})
        # At most REPLACED_FILES rows.
        keyed = rows.join(F.broadcast(found.select(F.col("file_path").alias("__file"), F.col("group").alias(GROUP))), "__file")
        arranged = _arranged(keyed, max(1, -(-size // file_bytes)), [*parts, GROUP], columns)
        replace_files(arranged.select(*table.columns, GROUP), name, old, held, rebalance=False)
    return True
