"""Types of text columns, found by aggregation."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# What one value can be at the narrowest. A column's set of these is a bit mask, so partial results merge by OR, in any
# order and any number of times: a task that runs again changes no type.
INT, LONG, WHOLE, DOUBLE, DATE, TIMESTAMP, BOOLEAN, TEXT = (1 << i for i in range(8))
NUMERIC, TEMPORAL = INT | LONG | WHOLE | DOUBLE, DATE | TIMESTAMP

MOST_DIGITS = 38
_INTEGER = r"^[+-]?[0-9]+\z"
_NUMBER = r"^([+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?|[+-]Inf(inity)?)\z"
_DATE = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}\z"
_TIMESTAMP = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}[ T][0-9]{2}:[0-9]{2}:[0-9]{2}(\.[0-9]{1,9})?(Z|[+-][0-9]{2}:[0-9]{2})?\z"
# Digits that hold every value of a type.
_DIGITS = {"int": 10, "bigint": 19}


@dataclass(frozen=True)
class ColumnProfile:
    """The narrowest type that takes every value of a column, its nulls among all rows, and its longest text."""

    name: str
    type: str
    nulls: int
    rows: int
    longest: int | None

    def fits(self, stored: str) -> bool:
        """Whether a column of type ``stored`` takes every value; a column of nulls goes anywhere.

        Whole numbers fit ``double``, as one column of both would be ``double``.
        """
        if stored in (self.type, "string") or self.nulls == self.rows:
            return True
        if self.type == "date":
            return stored == "timestamp"
        digits, room = _whole_digits(self.type), _whole_digits(stored)
        if digits is None:
            return False
        whole_enough = room is not None and room >= digits and (stored not in _DIGITS or self.type in _DIGITS)
        return stored == "double" or whole_enough


def _whole_digits(kind: str) -> int | None:
    """Digits before the point that a type of exact numbers has; None for other types."""
    decimal = re.fullmatch(r"decimal\((\d+),(\d+)\)", kind)
    return int(decimal[1]) - int(decimal[2]) if decimal else _DIGITS.get(kind)


def _digits(text: Column) -> Column:
    return F.char_length(F.ltrim(text, F.lit("+-0")))


def _begins_like_a_number(text: Column) -> Column:
    """Whether the first character is a sign, a point or a digit (or ``,`` or ``/``): a byte comparison, no pattern."""
    return (text >= "+") & (text < ":")


def _kind(text: Column) -> Column:
    whole = (
        F.when(text.try_cast("int").isNotNull(), INT)
        .when(text.try_cast("bigint").isNotNull(), LONG)
        .when(_digits(text) <= MOST_DIGITS, WHOLE)
        .otherwise(DOUBLE)
    )
    figures = (
        F.when(text.rlike(_INTEGER), whole)
        .when(text.rlike(_NUMBER), DOUBLE)
        .when(text.rlike(_DATE) & text.try_cast("date").isNotNull(), DATE)
        .when(text.rlike(_TIMESTAMP) & text.try_cast("timestamp").isNotNull(), TIMESTAMP)
        .otherwise(TEXT)
    )
    return (
        F.when(text.isNull(), 0)
        .when(_begins_like_a_number(text), figures)
        .when(F.lower(text).isin("true", "false"), BOOLEAN)
        .when(text.isin("NaN", "Inf", "Infinity"), DOUBLE)
        .otherwise(TEXT)
    )


def _type(seen: Column, digits: Column) -> Column:
    """The type that takes all values of the kinds ``seen``; ``string`` if there are none."""

    def has(kinds: int) -> Column:
        return seen.bitwiseAND(F.lit(kinds)) != 0

    number = (
        F.when(has(DOUBLE), "double")
        .when(has(WHOLE), F.concat(F.lit("decimal("), digits.cast("string"), F.lit(",0)")))
        .when(has(LONG), "bigint")
        .otherwise("int")
    )
    return (
        F.when((seen == 0) | has(TEXT), "string")
        .when(~has(NUMERIC | TEMPORAL), "boolean")
        .when(has(NUMERIC) & ~has(TEMPORAL | BOOLEAN), number)
        .when(has(TEMPORAL) & ~has(NUMERIC | BOOLEAN), F.when(has(TIMESTAMP), "timestamp").otherwise("date"))
        .otherwise("string")
    )


def profile_measures(columns: Sequence[str]) -> list[Column]:
    """Aggregates over text columns for ``agg`` or ``observe``, each stated once; :func:`profile_rows` reads them."""
    measures = [F.count(F.lit(1)).alias("n_rows")]
    for i, name in enumerate(columns):
        text = F.col(f"`{name}`")
        # Only a whole number beyond bigint needs its digits counted, and it is longer than this.
        long_whole = (F.char_length(text) >= 19) & _begins_like_a_number(text) & text.rlike(_INTEGER)
        measures += [
            F.coalesce(F.bit_or(_kind(text)), F.lit(0)).alias(f"seen_{i}"),
            F.max(F.when(long_whole, _digits(text))).alias(f"digits_{i}"),
            F.count(text).alias(f"n_filled_{i}"),
            F.max(F.char_length(text)).alias(f"longest_{i}"),
        ]
    return measures


def profile_rows(measured: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``column_name, data_type, n_null, n_rows, longest`` per column, from one row of :func:`profile_measures`."""
    rows = [
        F.struct(
            F.lit(name).alias("column_name"),
            _type(F.col(f"seen_{i}"), F.col(f"digits_{i}")).alias("data_type"),
            (F.col("n_rows") - F.col(f"n_filled_{i}")).alias("n_null"),
            F.col("n_rows"),
            F.col(f"longest_{i}").cast("bigint").alias("longest"),
        )
        for i, name in enumerate(columns)
    ]
    return measured.select(F.inline(F.array(*rows)))


def profiles(spark: SparkSession, columns: Sequence[str], observed: Mapping[str, object]) -> list[ColumnProfile]:
    """The profiles of ``columns`` from the observed measures, on the driver: one row a column."""
    measures = ", ".join(f"{name} bigint" for name in observed)
    measured = spark.createDataFrame([tuple(observed.values())], measures)
    return [ColumnProfile(*row) for row in profile_rows(measured, columns).collect()]


def column_profile(df: DataFrame) -> DataFrame:
    """``column_name, data_type, n_null, n_rows, longest`` per text column of ``df``, in one aggregate.

    Types are those a CSV scan would infer: whole numbers ``int``, ``bigint``
    or ``decimal``, other numbers ``double``, ISO dates and timestamps, true
    and false; anything mixed, or without values, is ``string``. Numbers with
    a suffix or white space around them are text, as a cast back would not
    return them. An empty table has ``string`` columns without a longest text.
    """
    return profile_rows(df.agg(*profile_measures(df.columns)), df.columns)


def cast_to(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """``df`` with the columns of ``types``, in that order, cast; the rest follows as it is."""
    rest = [c for c in df.columns if c not in types]
    return df.select(*[F.col(f"`{c}`").try_cast(t).alias(c) for c, t in types.items()], *[f"`{c}`" for c in rest])
