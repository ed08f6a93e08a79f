"""Admissions derived from the order tables: the test input for every layer.

The order tables hold no admissions, so each order becomes one row of untidy
text as a raw feed would deliver it. See FIXTURES.md, section 4.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


# Declared, so that planning needs no job to read file footers.
_SCHEMAS = {
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "customer": "c_custkey bigint, c_nationkey int, c_mktsegment string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "region": "r_regionkey int, r_name string",
}


def _pick(number: Column, choices: dict[int, str | None], default: str | None) -> Column:
    picked = F.lit(default).cast("string")
    for value, text in choices.items():
        picked = F.when(number == value, F.lit(text).cast("string")).otherwise(picked)
    return picked


def admissions_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One admission per order. Nation and region are fixed small tables; the
    join with customers is left to the optimizer (broadcast by measured size,
    else sort-merge with skew splitting)."""
    orders, customer, nation, region = (
        spark.read.schema(columns).parquet(f"{sf_dir}/{table}.parquet") for table, columns in _SCHEMAS.items()
    )
    joined = (
        orders.join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
    )
    key, person = F.col("o_orderkey"), F.col("o_custkey")
    name = F.concat(
        F.lit("  "),
        _pick(person % 6, {0: "mr. ", 1: "DR ", 2: "(Mrs.) "}, ""),
        F.lower("c_mktsegment"),
        F.lit("  "),
        F.when(person % 3 == 0, F.concat("r_name", F.lit(" "))).otherwise(""),
        F.when(person % 5 == 0, "").otherwise(F.col("n_name")),
        _pick(person % 7, {0: " jr.", 1: " III"}, ""),
        F.lit(" "),
    )
    came_on = F.col("o_orderdate").cast("date")
    left_on = F.date_add(came_on, (key % 40 - 2).cast("int"))
    charge = F.col("o_totalprice").cast("decimal(18,2)")
    return joined.select(
        key.alias("admission_id"),
        F.when(person % 43 == 0, " Dr. ").otherwise(name).alias("name"),
        F.when(key % 97 == 0, "abc").when(key % 89 != 0, (person % 131 - 5).cast("string")).alias("age"),
        _pick(person % 7, {0: "M", 1: " male", 2: "F", 3: "Female ", 4: "", 6: "x"}, None).alias("gender"),
        _pick(person % 6, {0: " a+", 1: "O-", 2: "ab+ ", 3: "  ", 5: "B-"}, None).alias("blood_type"),
        F.col("c_mktsegment").alias("medical_condition"),
        came_on.cast("string").alias("date_of_admission"),
        F.when(key % 101 == 0, "2024-13-01")
        .when(key % 103 == 0, F.lit(None).cast("string"))
        .when(key % 50 == 0, "2099-01-01")
        .otherwise(left_on.cast("string"))
        .alias("discharge_date"),
        F.concat("n_name", F.lit(" & Co., #"), (person % 10).cast("string")).alias("hospital"),
        F.when(person % 11 != 0, F.col("r_name")).alias("insurance_provider"),
        F.when(key % 67 == 0, -charge).otherwise(charge).cast("string").alias("billing_amount"),
        (key % 500).cast("string").alias("room_number"),
        F.col("o_orderpriority").alias("admission_type"),
        F.when(key % 4 != 0, F.concat(F.lit("drug"), (key % 6).cast("string"))).alias("medication"),
        _pick_status().alias("test_results"),
    )


def _pick_status() -> Column:
    status = F.col("o_orderstatus")
    return F.when(status == "F", "Abnormal").when(status == "O", "Normal")


def admissions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The admissions with every twentieth delivered twice, as a re-sent batch would."""
    copies = F.when(F.col("admission_id") % 20 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return admissions_once(spark, sf_dir).withColumn("copy", F.explode(copies)).drop("copy")
