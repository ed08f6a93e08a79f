"""Running totals and neighbours in a global order, without a single task that sees all rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from caselake.session import stage


def in_ranges(df: DataFrame, order: Sequence[str], name: str = "part") -> DataFrame:
    """``df`` written in ranges of ``order``, numbered upwards in column ``name``.

    The ranges are written down with the rows, because range bounds come from
    a sample and a second evaluation could draw them otherwise. Rows that are
    equal in ``order`` are in one range, so end it with a unique column.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(parts, *[F.col(c).asc_nulls_first() for c in order])
    return stage(ranged.withColumn(name, F.spark_partition_id()))


def with_running_totals(df: DataFrame, order: Sequence[str], **totals: Column) -> DataFrame:
    """``df`` with, for each of ``totals``, its sum over all rows before (in ``order``).

    One window per range gives the sums inside it; what the ranges before it
    add up to is a table of one row per range. Rows equal in ``order`` get
    consecutive totals in no fixed order.
    """
    ranged = in_ranges(df.withColumns({f"__{k}": v for k, v in totals.items()}), order, "__part")
    per_part = ranged.groupBy("__part").agg(*[F.sum(f"__{k}").alias(f"__{k}_in") for k in totals])
    # As many rows as shuffle partitions, so one task and a broadcast are bounded.
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    bases = per_part.select("__part", *[F.coalesce(F.sum(f"__{k}_in").over(before), F.lit(0)).alias(f"__{k}_base") for k in totals])
    inside = Window.partitionBy("__part").orderBy(*[F.col(c).asc_nulls_first() for c in order])
    inside = inside.rowsBetween(Window.unboundedPreceding, -1)
    placed = ranged.join(F.broadcast(bases), "__part")
    sums = {k: F.col(f"__{k}_base") + F.coalesce(F.sum(f"__{k}").over(inside), F.lit(0)) for k in totals}
    return placed.select(*df.columns, *[v.alias(k) for k, v in sums.items()])
