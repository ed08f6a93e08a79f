"""Segment summaries built from mergeable measures, modes, roll-ups and top rows.

A measure is kept as mergeable parts (row counts, sums, non-NULL counts,
minima, maxima), so several summaries can be derived from one finest-grain
aggregate: the wide input is read once, and everything after works on the
small table of cells.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ROWS = "rows"


# Columns can only be built with a running session, so parts and measures, which
# are declared at import time, hold functions that build them.
Build = Callable[[], Column]


@dataclass(frozen=True)
class Part:
    name: str
    over_rows: Build
    over_parts: Build


@dataclass(frozen=True)
class Measure:
    name: str
    parts: tuple[Part, ...]
    value: Build


def _added(name: str, over_rows: Build) -> Part:
    return Part(name, over_rows, lambda: F.sum(name))


_ROWS = _added(ROWS, lambda: F.count(F.lit(1)))


def _sum_part(column: str) -> Part:
    return _added(f"sum_{column}", lambda: F.sum(column))


def _filled_part(column: str) -> Part:
    return _added(f"filled_{column}", lambda: F.count(column))


def _hits_part(column: str, value: str) -> Part:
    return _added(f"hits_{column}_{value}", lambda: F.count_if(F.col(column) == value))


def _ratio(part: Part, size: Part) -> Column:
    return F.when(F.col(size.name) > 0, F.col(part.name) / F.col(size.name))


def row_count(name: str) -> Measure:
    return Measure(name, (_ROWS,), lambda: F.col(ROWS))


def mean(name: str, column: str, digits: int) -> Measure:
    """Rounded average of an integer or floating column; NULLs do not count."""
    total, filled = _sum_part(column), _filled_part(column)
    return Measure(name, (total, filled), lambda: F.round(_ratio(total, filled), digits))


def money_mean(name: str, column: str) -> Measure:
    """Average of a decimal(18,2), taken at six places as Spark's ``avg`` does, rounded to two."""
    total, filled = _sum_part(column), _filled_part(column)

    def value() -> Column:
        return F.round(_ratio(total, filled).cast("decimal(22,6)"), 2).cast("decimal(18,2)")

    return Measure(name, (total, filled), value)


def money_total(name: str, column: str) -> Measure:
    """Exact decimal sum; 26 integer digits, so that it also holds for 10^13 rows."""
    total = _sum_part(column)
    return Measure(name, (total,), lambda: F.col(total.name).cast("decimal(28,2)"))


def smallest(name: str, column: str) -> Measure:
    part = f"min_{column}"
    return Measure(name, (Part(part, lambda: F.min(column), lambda: F.min(part)),), lambda: F.col(part))


def largest(name: str, column: str) -> Measure:
    part = f"max_{column}"
    return Measure(name, (Part(part, lambda: F.max(column), lambda: F.max(part)),), lambda: F.col(part))


def match_count(name: str, column: str, value: str) -> Measure:
    hits = _hits_part(column, value)
    return Measure(name, (hits,), lambda: F.col(hits.name))


def match_pct(name: str, column: str, value: str) -> Measure:
    """Share of rows with ``column = value`` in percent; NULL counts as no match."""
    hits = _hits_part(column, value)
    return Measure(name, (_ROWS, hits), lambda: F.round(F.col(hits.name) * 100.0 / F.col(ROWS), 2))


def _parts(measures: Sequence[Measure]) -> list[Part]:
    return list({part.name: part for m in measures for part in m.parts}.values())


def segment_cells(df: DataFrame, keys: Sequence[str], measures: Sequence[Measure]) -> DataFrame:
    """The parts of all measures per key: a partial and a final hash aggregate."""
    return df.groupBy(*keys).agg(*[p.over_rows().alias(p.name) for p in _parts(measures)])


def merge_cells(
    cells: DataFrame, keys: Sequence[str], measures: Sequence[Measure], *extra: Column
) -> DataFrame:
    """Coarser cells from finer ones; ``extra`` aggregates ride along."""
    merged = [p.over_parts().alias(p.name) for p in _parts(measures)]
    return cells.groupBy(*keys).agg(*merged, *extra)


def spread_cells(cells: DataFrame, keys: Sequence[str], measures: Sequence[Measure]) -> DataFrame:
    """Every cell with the parts of its whole key instead of its own, by a window."""
    whole = Window.partitionBy(*keys)
    return cells.withColumns({p.name: p.over_parts().over(whole) for p in _parts(measures)})


def finish(cells: DataFrame, keys: Sequence[str], measures: Sequence[Measure], *extra: Column) -> DataFrame:
    return cells.select(*keys, *[m.value().alias(m.name) for m in measures], *extra)


def segment_summary(df: DataFrame, keys: Sequence[str], measures: Sequence[Measure]) -> DataFrame:
    return finish(segment_cells(df, keys, measures), keys, measures)


def summary_from_cells(cells: DataFrame, keys: Sequence[str], measures: Sequence[Measure]) -> DataFrame:
    return finish(merge_cells(cells, keys, measures), keys, measures)


def most_frequent_struct(value: str, weight: str = ROWS) -> Column:
    """Aggregate whose minimum is the value with the largest weight, lowest value on ties."""
    return F.min(F.struct((-F.col(weight)).alias("order"), F.col(value).alias("value")))


def rank_by_weight(counts: DataFrame, keys: Sequence[str], weight: str, name: str = "rank") -> DataFrame:
    """``rank()`` within ``keys``, heaviest first; equal weights share a rank."""
    heaviest = Window.partitionBy(*keys).orderBy(F.col(weight).desc())
    return counts.withColumn(name, F.rank().over(heaviest))


def mode_from_counts(
    counts: DataFrame, keys: Sequence[str], value: str, weight: str, alias: str, ties: str = "all"
) -> DataFrame:
    """Most frequent ``value`` per key from (keys, value, weight) rows.

    ``ties="all"`` keeps every value that shares the top weight, ``"first"``
    the lowest of them. Both shrink on the map side: the first by a group
    limit under ``rank() = 1``, the second by a partial aggregate.
    """
    if ties == "all":
        top = rank_by_weight(counts, keys, weight, "__rank").filter("__rank = 1")
        return top.select(*keys, F.col(value).alias(alias))
    if ties == "first":
        best = counts.groupBy(*keys).agg(most_frequent_struct(value, weight).alias("__best"))
        return best.select(*keys, F.col("__best.value").alias(alias))
    raise ValueError(f"ties must be 'all' or 'first', not {ties!r}")


def mode_per_group(
    df: DataFrame, keys: Sequence[str], value: str, alias: str, ties: str = "all"
) -> DataFrame:
    counts = df.groupBy(*keys, value).agg(F.count(F.lit(1)).alias(ROWS))
    return mode_from_counts(counts, keys, value, ROWS, alias, ties)


def roll_up_sum(summary: DataFrame, keys: Sequence[str], column: str, alias: str) -> DataFrame:
    return summary.groupBy(*keys).agg(F.sum(column).alias(alias))


def roll_up_mean(
    summary: DataFrame, keys: Sequence[str], column: str, alias: str, digits: int = 2, weight: str | None = None
) -> DataFrame:
    """Average of segment averages; every segment counts once unless ``weight`` names its size.

    Values are taken to six places as decimals, also where they come as
    doubles: decimal sums do not depend on the order rows arrive in, so an
    exact half rounds the same way in every run.
    """
    value = F.col(column).cast("decimal(22,6)")
    if weight is None:
        average = F.avg(value)
    else:
        size = F.when(value.isNotNull(), F.col(weight))
        average = F.try_divide(F.sum(value * size), F.sum(size))
    exact = dict(summary.dtypes)[column].startswith("decimal")
    rounded = F.round(average, digits).cast(f"decimal(18,{digits})" if exact else "double")
    return summary.groupBy(*keys).agg(rounded.alias(alias))


def top_rows(df: DataFrame, by: str, tie_break: Sequence[str], n: int = 1) -> DataFrame:
    """The ``n`` rows with the largest ``by``, ties in ``tie_break`` order (no full sort)."""
    order = [F.col(by).desc_nulls_last(), *[F.col(c).asc_nulls_first() for c in tie_break]]
    return df.orderBy(*order).limit(n)
