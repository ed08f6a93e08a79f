"""Raw admissions to the cleaned, typed, flagged silver layer."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caselake import constants as K
from caselake.functions import text, typed
from caselake.operators import quality
from caselake.operators.columns import cast_columns, null_defaults


def standardize_names(df: DataFrame) -> DataFrame:
    """Display name, name without titles, and its first, last and middle parts."""
    named = df.withColumn("name", text.display_name(F.col("name")))
    cleaned = named.withColumn("name_clean", text.strip_words(F.col("name")))
    tokens = text.name_tokens(F.col("name_clean"))
    return cleaned.withColumn("NameTokens", tokens).withColumns(
        {
            "FirstName": text.first_name(F.col("NameTokens")),
            "LastName": text.last_name(F.col("NameTokens")),
            "MiddleName": text.middle_name(F.col("NameTokens")),
        }
    )


def normalize_demographics(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "hospital": text.strip_special(F.col("hospital")),
            "gender": text.normalize_codes(F.col("gender"), K.GENDER_CODES),
            "blood_type": text.normalize_codes(F.col("blood_type")),
        }
    )


def enforce_types(df: DataFrame) -> DataFrame:
    dates = {c: typed.parse_date(F.col(c)) for c in K.SILVER_DATES}
    return cast_columns(df, K.SILVER_TYPES).withColumns(dates)


def age_group(age: Column) -> Column:
    return typed.bucketize(age, K.AGE_BOUNDS, K.AGE_LABELS)


def derive_features(df: DataFrame) -> DataFrame:
    stay = typed.days_between(F.col("date_of_admission"), F.col("discharge_date"))
    return df.withColumns({"length_of_stay_days": stay, "age_group": age_group(F.col("age"))})


def admission_rules() -> dict[str, Column]:
    """The five quality rules; NULL inputs give a NULL flag except for the name."""
    name = F.col("name_clean")
    return {
        "dq_age_valid": F.col("age").between(*K.AGE_RANGE),
        "dq_billing_valid": F.col("billing_amount") > 0,
        "dq_dates_valid": F.col("discharge_date") >= F.col("date_of_admission"),
        "dq_length_of_stay_valid": F.col("length_of_stay_days").between(*K.STAY_RANGE),
        "dq_name_valid": F.coalesce(F.length(name) > 1, F.lit(False)),
    }


# The flags, in order.
DQ_FLAGS = (
    "dq_age_valid",
    "dq_billing_valid",
    "dq_dates_valid",
    "dq_length_of_stay_valid",
    "dq_name_valid",
    "dq_passed",
)


# A record's copies are ranked by these; the first one stays.
FIRST_SEEN = ("_ingested_at", "_batch_id")


def clean(unique: DataFrame, keep_tokens: bool = False) -> DataFrame:
    """Everything after deduplication: projections only, no shuffle."""
    df = normalize_demographics(standardize_names(unique))
    df = null_defaults(derive_features(enforce_types(df)), K.NULL_DEFAULTS)
    df = quality.with_flags(df, admission_rules())
    return df if keep_tokens else df.drop("NameTokens")


def to_silver(bronze: DataFrame, keep_tokens: bool = False) -> DataFrame:
    """One shuffle (the deduplication, on raw columns), then projections."""
    return clean(quality.dedupe(bronze, ["_record_hash"], FIRST_SEEN), keep_tokens)
