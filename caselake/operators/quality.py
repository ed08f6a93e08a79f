"""Data-quality flags, reports and deduplication."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from caselake.session import size_in_bytes, stage

# Repeated keys up to this number and file size are broadcast with their survivor's place.
LISTED_KEYS = 200_000
LISTED_BYTES = 32 * 1024**2
# Bitmaps of kept places, one bit a row, are broadcast up to this file size; beyond that rows are shuffled to them.
PLACES_BYTES = 64 * 1024**2


def with_flags(df: DataFrame, rules: Mapping[str, Column], passed: str = "dq_passed") -> DataFrame:
    """One three-valued flag per rule, and their conjunction. No row is dropped."""
    flagged = df.withColumns(dict(rules))
    return flagged.withColumn(passed, reduce(lambda a, b: a & b, [F.col(r) for r in rules]))


def flag_counts(df: DataFrame, flags: Sequence[str]) -> DataFrame:
    """Per flag how often it is true, false and NULL: one pass, one row per flag."""
    counted = [F.count(F.lit(1)).alias("total")]
    for flag in flags:
        counted.append(F.count_if(F.col(flag)).alias(f"{flag}__true"))
        counted.append(F.count_if(~F.col(flag)).alias(f"{flag}__false"))
    lines = F.array(
        *[
            F.struct(
                F.lit(flag).alias("rule"),
                F.col(f"{flag}__true").alias("n_true"),
                F.col(f"{flag}__false").alias("n_false"),
                (F.col("total") - F.col(f"{flag}__true") - F.col(f"{flag}__false")).alias("n_null"),
            )
            for flag in flags
        ]
    )
    return df.agg(*counted).select("total", F.inline(lines))


def dq_report(df: DataFrame, flags: Sequence[str]) -> DataFrame:
    """Passed, failed and percentages per flag; a NULL flag counts as failed."""
    failed = F.col("total") - F.col("n_true")

    def percent(part: Column) -> Column:
        share = F.when(F.col("total") > 0, part / F.col("total") * 100)
        return F.round(F.coalesce(share, F.lit(0.0)), 1)

    return flag_counts(df, flags).select(
        "rule",
        "total",
        F.col("n_true").alias("passed"),
        failed.alias("failed"),
        percent(F.col("n_true")).alias("passed_pct"),
        percent(failed).alias("failed_pct"),
    )


def exclusion_report(df: DataFrame, passed: str = "dq_passed") -> DataFrame:
    """Rows in the layer, rows handed on, rows held back."""
    return df.agg(
        F.count(F.lit(1)).alias("total_records"),
        F.count_if(F.col(passed)).alias("kept_records"),
    ).withColumn("excluded_records", F.col("total_records") - F.col("kept_records"))


def content_order(columns: Sequence[str]) -> list[Column]:
    """Two hashes that order rows by content, whatever their place or the input's order.

    Hash functions skip NULL, so each column is followed by whether it is one.
    """
    told = [part for c in columns for part in (F.col(f"`{c}`"), F.col(f"`{c}`").isNull())]
    return [F.xxhash64(*told), F.xxhash64(F.lit(1), *told)]


def dedupe(df: DataFrame, keys: Sequence[str], order_by: Sequence[str] = ()) -> DataFrame:
    """Keep the first row per key, by ``order_by`` and then by row content.

    ``row_number() = 1`` gets a map-side group limit, so a key that holds a
    third of all rows leaves each map task as a single row. The content order
    makes the survivor the same in every run, every task retry and for every
    order of the input.
    """
    ordering = [F.col(c).asc_nulls_first() for c in order_by]
    first = Window.partitionBy(*keys).orderBy(*ordering, *content_order(df.columns))
    return df.withColumn("__nth", F.row_number().over(first)).filter("__nth = 1").drop("__nth")


def dedupe_stored(
    df: DataFrame, keys: Sequence[str], order_by: Sequence[str] = (), listed: int = LISTED_KEYS
) -> DataFrame:
    """:func:`dedupe` of parquet table rows that shuffles keys only, not rows; it keeps the same rows.

    A first pass reads the key columns and finds the keys that repeat. If they
    are few and small, the place (file and row) of each one's survivor is
    broadcast and a scan drops the other copies; the survivor is chosen by the
    order of :func:`dedupe`, the place only tells equal rows apart. Otherwise
    the rows go through :func:`dedupe_by_place`. ``df`` must come straight from
    a table scan. Keys are compared by 128 bits of hashes that tell NULL from
    a value.
    """
    short = dict(zip(("__key_one", "__key_two"), content_order(keys)))
    copies = df.select(*[c.alias(k) for k, c in short.items()]).groupBy(*short).agg(F.count(F.lit(1)).alias("__copies"))
    repeated = stage(copies.filter("__copies > 1").select(*short))
    if repeated.limit(listed + 1).count() > listed or size_in_bytes(repeated) > LISTED_BYTES:
        return dedupe_by_place(df, short, order_by)
    file, row = F.col("_metadata.file_path"), F.col("_metadata.row_index")
    one, two = content_order(df.columns)
    placed = df.withColumns({**short, "__one": one, "__two": two, "__file": file, "__row": row}).alias("d")
    same = reduce(lambda a, b: a & b, [F.col(f"d.{k}") == F.col(f"r.{k}") for k in short])
    place = F.struct(*order_by, "__one", "__two", "__file", "__row")
    survivors = (
        placed.join(F.broadcast(repeated.alias("r")), same, "left_semi")
        .groupBy(*short)
        .agg(F.min(place).alias("__first"))
        .select(*short, F.col("__first.__file").alias("__keep_file"), F.col("__first.__row").alias("__keep_row"))
    )
    marked = placed.join(F.broadcast(survivors.alias("r")), same, "left")
    kept = F.col("__keep_row").isNull() | (
        (F.col("__keep_file") == F.col("d.__file")) & (F.col("__keep_row") == F.col("d.__row"))
    )
    return marked.filter(kept).select(*[F.col(f"d.`{c}`") for c in df.columns])


def dedupe_by_place(
    df: DataFrame,
    keys: Mapping[str, Column],
    order_by: Sequence[str] = (),
    only: DataFrame | None = None,
    without: DataFrame | None = None,
) -> DataFrame:
    """:func:`dedupe` of parquet table rows for any number of repeated keys; it keeps the same rows.

    What is shuffled are keys, order columns, two content hashes and the place
    of each row; copies meet as partial minima first. The survivors' places
    become bitmaps, one bit a row, by which a second scan picks the rows. So
    the rows themselves are neither shuffled nor sorted, unless the bitmaps
    exceed ``PLACES_BYTES`` (some 500 million rows).

    ``only`` and ``without`` are frames of the columns ``keys``: keys that are
    looked for, and keys that are left out. A file is told by a 64-bit hash of
    its path. ``df`` must come straight from a table scan.
    """
    one, two = content_order(df.columns)
    file, row = F.xxhash64("_metadata.file_path"), F.col("_metadata.row_index")
    place = F.struct(*order_by, one.alias("__one"), two.alias("__two"), file.alias("__file"), row.alias("__row"))
    rows = df.select(*[column.alias(name) for name, column in keys.items()], place.alias("__place"))
    if only is not None:
        rows = rows.join(only, list(keys), "left_semi")
    first = rows.groupBy(*keys).agg(F.min("__place").alias("__first"))
    if without is not None:
        first = first.join(without, list(keys), "left_anti")
    number = F.col("__first.__row") + 1
    places = first.select(
        F.col("__first.__file").alias("__file"),
        F.bitmap_bucket_number(number).alias("__bucket"),
        F.bitmap_bit_position(number).alias("__bit"),
    )
    kept = stage(places.groupBy("__file", "__bucket").agg(F.bitmap_construct_agg("__bit").alias("__bits")))
    kept = F.broadcast(kept) if size_in_bytes(kept) <= PLACES_BYTES else kept
    here = {"__file": file, "__bucket": F.bitmap_bucket_number(row + 1), "__bit": F.bitmap_bit_position(row + 1).cast("int")}
    marked = df.withColumns(here).join(kept, ["__file", "__bucket"])
    byte = F.conv(F.hex(F.expr("substring(__bits, __bit div 8 + 1, 1)")), 16, 10).cast("int")
    bit = F.expr("shiftleft(1, __bit % 8)")
    return marked.filter(byte.bitwiseAND(bit) > 0).select(*[F.col(f"`{c}`") for c in df.columns])


def dedupe_report(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows before and after deduplication and the difference; shuffles only the keys."""
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies"))
    return per_key.agg(
        F.coalesce(F.sum("copies"), F.lit(0)).alias("records_before"),
        F.count(F.lit(1)).alias("records_after"),
    ).withColumn("duplicates_removed", F.col("records_before") - F.col("records_after"))


def content_fingerprint(df: DataFrame) -> DataFrame:
    """One row that tells two tables' contents apart, whatever the order of rows: ``n_rows, total, mixed``.

    Each row becomes 64-bit hashes that tell NULL from a value; ``total`` adds
    the one, ``mixed`` combines the other by exclusive or. Rows that repeat
    count each. One pass, and one row a task is shuffled.
    """
    one, two = content_order(sorted(df.columns))
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.coalesce(F.sum(one.cast("decimal(20,0)")), F.lit(0)).cast("decimal(38,0)").alias("total"),
        F.coalesce(F.bit_xor(two), F.lit(0)).alias("mixed"),
    )


def same_content(one: DataFrame, other: DataFrame) -> DataFrame:
    """``n_rows, n_rows_other, same``: whether two tables of the same columns and types hold the same rows."""
    if sorted(one.dtypes) != sorted(other.dtypes):
        raise ValueError(f"columns differ: {sorted(set(one.dtypes) ^ set(other.dtypes))}")
    sides = [content_fingerprint(df).withColumn("side", F.lit(i)) for i, df in enumerate((one, other))]

    def of(side: int, name: str) -> Column:
        return F.max(F.when(F.col("side") == side, F.col(name)))

    agree = [of(0, c) == of(1, c) for c in ("n_rows", "total", "mixed")]
    # One row of either side meets the other's in one task.
    return sides[0].union(sides[1]).agg(
        of(0, "n_rows").alias("n_rows"), of(1, "n_rows").alias("n_rows_other"), reduce(lambda x, y: x & y, agree).alias("same")
    )
