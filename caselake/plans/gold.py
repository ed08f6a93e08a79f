"""The three marts and the questions asked of them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from caselake import constants as K
from caselake.operators import summary as S

ADMISSION_TYPE = "admission_type"
MODE = "most_common_admission_type"

CONDITION_MEASURES = (
    S.row_count("total_patients"),
    S.mean("avg_length_of_stay_days", "length_of_stay_days", 2),
    S.largest("max_length_of_stay_days", "length_of_stay_days"),
    S.money_mean("avg_billing_amount", "billing_amount"),
    S.money_total("total_billing_amount", "billing_amount"),
    S.match_pct("abnormal_test_rate_pct", "test_results", K.ABNORMAL),
)
BILLING_MEASURES = (
    S.row_count("total_patients"),
    S.money_total("total_billing_amount", "billing_amount"),
    S.money_mean("avg_billing_amount", "billing_amount"),
    S.smallest("min_billing_amount", "billing_amount"),
    S.largest("max_billing_amount", "billing_amount"),
)
DEMOGRAPHIC_MEASURES = (
    S.row_count("total_patients"),
    S.mean("avg_age", "age", 1),
    S.mean("avg_length_of_stay_days", "length_of_stay_days", 2),
    S.money_mean("avg_billing_amount", "billing_amount"),
    S.money_total("total_billing_amount", "billing_amount"),
    S.match_pct("abnormal_test_rate_pct", "test_results", K.ABNORMAL),
)
ALL_MEASURES = CONDITION_MEASURES + BILLING_MEASURES + DEMOGRAPHIC_MEASURES
CELL_KEYS = ("insurance_provider", "age_group", "gender", "medical_condition", ADMISSION_TYPE)


def gold_base(silver: DataFrame) -> DataFrame:
    """Rows whose composite flag is true; the filter reaches the parquet scan."""
    return silver.filter(F.col("dq_passed"))


def mart_cells(base: DataFrame, also: Sequence[str] = ()) -> DataFrame:
    """The finest grain any mart needs (and ``also`` columns to keep apart), from one pass over the base."""
    return S.segment_cells(base, [*CELL_KEYS, *also], ALL_MEASURES)


def condition_core(base: DataFrame) -> DataFrame:
    return S.segment_summary(base, K.CONDITION_KEYS, CONDITION_MEASURES)


def condition_summary(base: DataFrame, ties: str = "all") -> DataFrame:
    """Metrics and most common admission type per condition, reading the base once."""
    cells = S.segment_cells(base, [*K.CONDITION_KEYS, ADMISSION_TYPE], CONDITION_MEASURES)
    return _condition_marts(cells, ties)


def condition_summary_from_cells(cells: DataFrame, ties: str = "all") -> DataFrame:
    """Condition summary from cells of any finer grain."""
    keys = [*K.CONDITION_KEYS, ADMISSION_TYPE]
    return _condition_marts(S.merge_cells(cells, keys, CONDITION_MEASURES), ties)


def _condition_marts(cells: DataFrame, ties: str) -> DataFrame:
    """Condition summary from one cell per condition and admission type.

    ``ties="all"`` gives a condition one row per value that shares the top
    count, ``"first"`` the lowest value only. The NULL condition never has a
    most common type: the mode is looked up by equality, which NULL fails.
    """
    keys = list(K.CONDITION_KEYS)
    if ties == "first":
        best = S.most_frequent_struct(ADMISSION_TYPE).alias("__best")
        merged = S.merge_cells(cells, keys, CONDITION_MEASURES, best)
        known = F.when(F.col(keys[0]).isNotNull(), F.col("__best.value")).alias(MODE)
        return S.finish(merged, keys, CONDITION_MEASURES, known)
    # One window for the rank and the totals: the cells are read once.
    heaviest = Window.partitionBy(*keys).orderBy(F.desc(S.ROWS))
    ranked = cells.withColumns({"__rank": F.rank().over(heaviest), "__nth": F.row_number().over(heaviest)})
    known = F.col(keys[0]).isNotNull()
    top = S.spread_cells(ranked, keys, CONDITION_MEASURES).filter(
        (known & (F.col("__rank") == 1)) | (~known & (F.col("__nth") == 1))
    )
    return S.finish(top, keys, CONDITION_MEASURES, F.when(known, F.col(ADMISSION_TYPE)).alias(MODE))


def billing_summary(base: DataFrame) -> DataFrame:
    return S.segment_summary(base, K.BILLING_KEYS, BILLING_MEASURES)


def patient_demographics(base: DataFrame) -> DataFrame:
    return S.segment_summary(base, K.DEMOGRAPHIC_KEYS, DEMOGRAPHIC_MEASURES)


def marts_from_cells(cells: DataFrame, ties: str = "first") -> dict[str, DataFrame]:
    return {
        "condition_summary": condition_summary_from_cells(cells, ties),
        "billing_summary": S.summary_from_cells(cells, K.BILLING_KEYS, BILLING_MEASURES),
        "patient_demographics": S.summary_from_cells(cells, K.DEMOGRAPHIC_KEYS, DEMOGRAPHIC_MEASURES),
    }


# Key columns per mart, and the columns each mart's files are clustered by.
MART_KEYS = {
    "condition_summary": K.CONDITION_KEYS,
    "billing_summary": K.BILLING_KEYS,
    "patient_demographics": K.DEMOGRAPHIC_KEYS,
}
MART_CLUSTERING = {
    "condition_summary": ("medical_condition",),
    "billing_summary": ("insurance_provider", "medical_condition"),
    "patient_demographics": ("age_group", "gender"),
}


def presented(mart: DataFrame, name: str) -> DataFrame:
    """A mart in reading order; sorted for people only, never before a write."""
    order = {
        "condition_summary": [F.desc_nulls_last("total_patients")],
        "billing_summary": [F.desc_nulls_last("total_billing_amount")],
        "patient_demographics": [
            F.asc_nulls_first("age_group"),
            F.asc_nulls_first("gender"),
            F.desc_nulls_last("total_patients"),
        ],
    }
    return mart.orderBy(*order[name])


def condition_insight(mart: DataFrame, metric: str) -> DataFrame:
    return S.top_rows(mart.select("medical_condition", metric), metric, ["medical_condition"])


def top_total(mart: DataFrame, key: str, column: str, alias: str) -> DataFrame:
    return S.top_rows(S.roll_up_sum(mart, [key], column, alias), alias, [key])


def top_mean(mart: DataFrame, key: str, column: str, alias: str) -> DataFrame:
    """Top segment by the average of segment averages, each counted once."""
    return S.top_rows(S.roll_up_mean(mart, [key], column, alias), alias, [key])
