"""One Spark query per operator, over the admissions derived from the order tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import cache, reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from caselake import constants as K
from caselake.functions import text, typed
from caselake.functions.identity import record_hash
from caselake.operators import quality
from caselake.operators import summary as S
from caselake.operators.columns import cast_columns, clean_column_names, null_defaults, with_lineage
from caselake.operators.inference import column_profile
from caselake.plans import gold, medallion, silver
from caselake.plans.admissions import admissions
from caselake.session import fresh_path, scratch_database, shuffle_sized, stage
from caselake.sinks import tables
from caselake.sources.files import read_csv
from caselake.sources.tables import read_table
from checks.oracle import BATCH_ID, DATA_COLUMNS, FIRST_LOAD_BEFORE, INGESTED_AT, SOURCE

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}


# Rows in memory take several times the bytes of their files.
UNPACKED = 4


def query(fn: Query) -> Query:
    _QUERIES[fn.__name__] = fn
    return fn


# ---- inputs ---------------------------------------------------------------


def _ingested_at() -> Column:
    return F.lit(INGESTED_AT).cast("timestamp")


def _bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_lineage(admissions(spark, sf_dir), BATCH_ID, _ingested_at(), F.lit(SOURCE))


def _silver(spark: SparkSession, sf_dir: str, keep_tokens: bool = False) -> DataFrame:
    return silver.to_silver(_bronze(spark, sf_dir), keep_tokens)


def _base(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.gold_base(_silver(spark, sf_dir))


def _feed(spark: SparkSession, sf_dir: str) -> str:
    return _csv(admissions(spark, sf_dir))


def _csv(df: DataFrame) -> str:
    """``df`` as headed CSV files in the shared folder."""
    path = f"{fresh_path(df.sparkSession, 'stage-csv')}/feed"
    writer = df.write.option("header", True)
    writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
    return path


def _as_text(when: str) -> Column:
    return F.date_format(when, "yyyy-MM-dd HH:mm:ss")


# ---- sources --------------------------------------------------------------


@query
def scan_csv_infer(spark, sf_dir):
    return read_csv(spark, _feed(spark, sf_dir), schema="infer")


@query
def csv_profile(spark, sf_dir):
    return column_profile(read_csv(spark, _feed(spark, sf_dir), schema="string"))


@query
def scan_table(spark, sf_dir):
    name = f"{scratch_database(spark)}.admissions"
    tables.save_table(admissions(spark, sf_dir), name)
    return read_table(spark, name)


@query
def sql_projection(spark, sf_dir):
    name = f"{scratch_database(spark)}.admissions"
    tables.save_table(admissions(spark, sf_dir), name)
    return spark.sql(f"SELECT name, gender, blood_type FROM {name}")


@query
def ingest_metadata(spark, sf_dir):
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").withColumns(
        {
            "o_totalprice": F.col("o_totalprice").cast("decimal(18,2)"),
            "o_orderdate": F.date_format("o_orderdate", "yyyy-MM-dd"),
        }
    )
    lined = with_lineage(orders, BATCH_ID, _ingested_at())
    base_name = F.element_at(F.split("_source_file", "/"), -1)
    return lined.withColumns({"_source_file": base_name, "_ingested_at": _as_text("_ingested_at")})


@query
def clean_column_names_(spark, sf_dir):
    untidy = admissions(spark, sf_dir).select(
        F.col("admission_id").alias(" Admission ID "),
        F.col("name").alias("Patient  Name"),
        F.col("billing_amount").alias("Billing Amount ($)"),
        F.col("test_results").alias("Test Results"),
    )
    return clean_column_names(untidy)


_QUERIES["clean_column_names"] = _QUERIES.pop("clean_column_names_")


def _ingested(spark: SparkSession, sf_dir: str, schema: str) -> DataFrame:
    database = scratch_database(spark)
    layout = medallion.Layout(bronze=database)
    medallion.ingest(
        spark, _feed(spark, sf_dir), layout, schema=schema, batch_id=BATCH_ID, ingested_at=_ingested_at()
    )
    folder = F.element_at(F.split("_source_file", "/"), -2)
    raw = spark.table(layout.raw_table)
    return raw.withColumns({"_source_file": folder, "_ingested_at": _as_text("_ingested_at")})


@query
def bronze_ingest(spark, sf_dir):
    return _ingested(spark, sf_dir, "infer")


@query
def bronze_ingest_observed(spark, sf_dir):
    return _ingested(spark, sf_dir, "observe")


@query
def record_hash_(spark, sf_dir):
    return admissions(spark, sf_dir).select("admission_id", record_hash(DATA_COLUMNS).alias("record_hash"))


_QUERIES["record_hash"] = _QUERIES.pop("record_hash_")


# ---- projections ----------------------------------------------------------


@query
def project_alias(spark, sf_dir):
    return _silver(spark, sf_dir).select(
        F.col("admission_id").alias("id"),
        F.col("medical_condition").alias("condition"),
        F.col("billing_amount").alias("billed"),
    )


@query
def drop_columns(spark, sf_dir):
    return _silver(spark, sf_dir, keep_tokens=True).drop("NameTokens", "_ingested_at")


# ---- scalars --------------------------------------------------------------


def _scalar(**columns: Callable[[], Column]) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        made = [column().alias(name) for name, column in columns.items()]
        return admissions(spark, sf_dir).select("admission_id", *made)

    return run


_QUERIES.update(
    str_trim_upper=_scalar(blood_type=lambda: F.upper(F.trim("blood_type"))),
    str_initcap=_scalar(name=lambda: text.display_name(F.col("name"))),
    str_strip_special=_scalar(hospital=lambda: text.strip_special(F.col("hospital"))),
    str_concat_ws=_scalar(joined=lambda: F.concat_ws(" ", "medication", "test_results", "insurance_provider")),
    gender_code=_scalar(gender=lambda: text.normalize_codes(F.col("gender"), K.GENDER_CODES)),
    blood_type_code=_scalar(blood_type=lambda: text.normalize_codes(F.col("blood_type"))),
    parse_dates=_scalar(
        date_of_admission=lambda: typed.parse_date(F.col("date_of_admission")),
        discharge_date=lambda: typed.parse_date(F.col("discharge_date")),
    ),
    length_of_stay=_scalar(
        length_of_stay_days=lambda: typed.days_between(
            typed.parse_date(F.col("date_of_admission")), typed.parse_date(F.col("discharge_date"))
        )
    ),
    name_clean=_scalar(name_clean=lambda: text.strip_words(text.display_name(F.col("name")))),
)


@query
def null_defaults_(spark, sf_dir):
    defaults = {c: v for c, v in K.NULL_DEFAULTS.items() if c in DATA_COLUMNS}
    return null_defaults(admissions(spark, sf_dir).select("admission_id", *defaults), defaults)


_QUERIES["null_defaults"] = _QUERIES.pop("null_defaults_")


@query
def cast_types(spark, sf_dir):
    return cast_columns(admissions(spark, sf_dir).select("admission_id", *K.SILVER_TYPES), K.SILVER_TYPES)


@query
def age_group(spark, sf_dir):
    ages = cast_columns(admissions(spark, sf_dir).select("admission_id", "age"), {"age": "int"})
    return ages.withColumn("age_group", silver.age_group(F.col("age")))


# ---- names ----------------------------------------------------------------


@query
def name_tokens(spark, sf_dir):
    return _silver(spark, sf_dir, keep_tokens=True).select(
        "admission_id",
        F.array_join("NameTokens", "|").alias("tokens"),
        F.size("NameTokens").alias("token_count"),
    )


@query
def name_parts(spark, sf_dir):
    return _silver(spark, sf_dir).select("admission_id", "FirstName", "LastName", "MiddleName")


@query
def name_standardize(spark, sf_dir):
    return _silver(spark, sf_dir).select(
        "admission_id", "name", "name_clean", "FirstName", "LastName", "MiddleName"
    )


# ---- filters --------------------------------------------------------------


def _filtered(condition: Callable[[], Column], *columns: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _silver(spark, sf_dir).filter(condition()).select("admission_id", *columns)

    return run


_QUERIES.update(
    filter_dq_passed=_filtered(lambda: F.col("dq_passed"), "medical_condition"),
    filter_equality=_filtered(lambda: F.col("test_results") == K.ABNORMAL, "test_results"),
    filter_like=_filtered(lambda: F.col("name").like("%Build%"), "gender", "name"),
    filter_isin=_filtered(lambda: F.col("gender").isin("M", "F"), "gender"),
    filter_between=_filtered(lambda: F.col("age").between(*K.AGE_RANGE), "age"),
    filter_comparison=_filtered(
        lambda: (F.col("discharge_date") >= F.col("date_of_admission"))
        & (F.col("billing_amount") > 0)
        & (F.col("age") < 60),
        "billing_amount",
    ),
    filter_null_checks=_filtered(lambda: F.col("discharge_date").isNull() & F.col("age").isNotNull(), "age"),
)


# ---- quality --------------------------------------------------------------


@query
def dq_flags(spark, sf_dir):
    return _silver(spark, sf_dir).select("admission_id", *silver.DQ_FLAGS)


@query
def dq_report(spark, sf_dir):
    return quality.dq_report(_silver(spark, sf_dir), silver.DQ_FLAGS)


@query
def dq_three_valued_counts(spark, sf_dir):
    return quality.flag_counts(_silver(spark, sf_dir), silver.DQ_FLAGS)


@query
def dedupe_record_hash(spark, sf_dir):
    unique = quality.dedupe(_bronze(spark, sf_dir), ["_record_hash"], ["_ingested_at", "_batch_id"])
    return unique.drop("_ingested_at")


@query
def dedupe_stored(spark, sf_dir):
    name = f"{scratch_database(spark)}.bronze"
    tables.save_table(_bronze(spark, sf_dir), name)
    unique = quality.dedupe_stored(spark.table(name), ["_record_hash"], ["_ingested_at", "_batch_id"])
    return unique.drop("_ingested_at")


@query
def dedupe_same_survivors(spark, sf_dir):
    """Copies that differ outside the hash, and in NULL against '': both ways have to keep the same rows."""
    rows = _bronze(spark, sf_dir).withColumn("note", F.when(F.col("admission_id") % 2 == 0, F.lit("")))
    other = rows.withColumns(
        {"note": F.when(F.col("note").isNull(), F.lit("")), "_source_file": F.concat("_source_file", F.lit("2"))}
    )
    name = f"{scratch_database(spark)}.bronze"
    tables.save_table(rows.unionByName(other), name)
    keys = (["_record_hash"], ["_ingested_at", "_batch_id"])
    # The one row is computed here, while the shuffles of whole rows have the sizes for it.
    with shuffle_sized(spark, UNPACKED * tables.table_bytes(spark, name)):
        # Another order than the table's; the two notes would deal all rows to two tasks.
        plain = quality.dedupe(other.unionByName(rows).repartition("_record_hash"), *keys)
        by_place = quality.dedupe_stored(spark.table(name), *keys)
        both = plain.withColumn("how", F.lit(1)).unionByName(by_place.withColumn("how", F.lit(2)))
        per_row = both.groupBy(*quality.content_order(plain.columns)).agg(F.sum("how").alias("hows"))
        found = per_row.agg(
            F.count(F.lit(1)).alias("survivors"),
            F.count_if(F.col("hows") == 1).alias("only_plain"),
            F.count_if(F.col("hows") == 2).alias("only_stored"),
        )
        return stage(found)


@query
def dedupe_report(spark, sf_dir):
    return quality.dedupe_report(_bronze(spark, sf_dir), ["_record_hash"])


@query
def exclusion_report(spark, sf_dir):
    return quality.exclusion_report(_silver(spark, sf_dir))


# ---- aggregates -----------------------------------------------------------


@query
def count_rows(spark, sf_dir):
    return _base(spark, sf_dir).agg(F.count(F.lit(1)).alias("n_rows"))


@query
def condition_summary_core(spark, sf_dir):
    return gold.condition_core(_base(spark, sf_dir))


def _summary(keys: list[str], *measures: S.Measure) -> Query:
    return lambda spark, sf_dir: S.segment_summary(_base(spark, sf_dir), keys, measures)


_QUERIES.update(
    agg_avg_rounded=_summary(
        ["medical_condition"],
        S.mean("avg_age", "age", 1),
        S.money_mean("avg_billing_amount", "billing_amount"),
    ),
    agg_min_max=_summary(
        ["medical_condition"],
        S.smallest("min_billing_amount", "billing_amount"),
        S.largest("max_billing_amount", "billing_amount"),
        S.largest("max_length_of_stay_days", "length_of_stay_days"),
    ),
    agg_sum_decimal=_summary(["insurance_provider"], S.money_total("total_billing_amount", "billing_amount")),
    agg_conditional_count=_summary(
        ["medical_condition"], S.match_count("abnormal_results", "test_results", K.ABNORMAL)
    ),
    agg_abnormal_rate_pct=_summary(
        ["hospital"], S.match_pct("abnormal_test_rate_pct", "test_results", K.ABNORMAL)
    ),
)


@query
def rollup_sum_of_sums(spark, sf_dir):
    mart = gold.billing_summary(_base(spark, sf_dir))
    return S.roll_up_sum(mart, ["medical_condition"], "total_billing_amount", "condition_total")


@query
def rollup_avg_of_avgs(spark, sf_dir):
    mart = gold.billing_summary(_base(spark, sf_dir))
    return S.roll_up_mean(mart, ["age_group"], "avg_billing_amount", "avg_bill")


# ---- mode, window, join ---------------------------------------------------


@query
def mode_ties_all(spark, sf_dir):
    return S.mode_per_group(_base(spark, sf_dir), ["medical_condition"], "admission_type", gold.MODE)


@query
def mode_ties_first(spark, sf_dir):
    return S.mode_per_group(_base(spark, sf_dir), ["hospital"], "admission_type", gold.MODE, ties="first")


@query
def window_rank_by_count(spark, sf_dir):
    counted = S.row_count("admission_count")
    counts = S.segment_summary(_base(spark, sf_dir), ["medical_condition", "admission_type"], [counted])
    return S.rank_by_weight(counts, ["medical_condition"], "admission_count")


@query
def join_left_using(spark, sf_dir):
    """Group totals with the most common admission type among women, both from one staged count."""
    key, value, n = "medical_condition", "admission_type", S.row_count("total_patients")
    cells = stage(S.segment_cells(_base(spark, sf_dir), [key, "gender", value], [n]))
    women = S.merge_cells(cells.filter(F.col("gender") == "F"), [key, value], [n])
    modes = S.mode_from_counts(women, [key], value, S.ROWS, "female_admission_type")
    return S.summary_from_cells(cells, [key], [n]).join(modes, on=key, how="left")


def _tied(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The base twice with two admission types that trade places, so that they tie; some conditions NULL."""
    base = _base(spark, sf_dir).withColumn(
        "medical_condition", F.when(F.col("admission_id") % 5 > 0, F.col("medical_condition"))
    )
    odd = F.col("admission_type").isin("1-URGENT", "3-MEDIUM", "5-LOW")
    first = base.withColumn("admission_type", F.when(odd, F.lit("odd")).otherwise("even"))
    second = base.withColumn("admission_type", F.when(odd, F.lit("even")).otherwise("odd"))
    return first.unionByName(second)


@query
def mode_ties_tied(spark, sf_dir):
    return S.mode_per_group(_tied(spark, sf_dir), ["medical_condition"], "admission_type", gold.MODE)


@query
def condition_summary_tied(spark, sf_dir):
    return gold.condition_summary(_tied(spark, sf_dir))


@query
def record_hash_safe(spark, sf_dir):
    """How many hashes tell NULL from '' that the default hash does not; rows whose NULLs become ''."""
    columns = ["admission_id", "age", "gender", "blood_type"]
    rows = admissions(spark, sf_dir).select(*columns)
    filled = rows.select("admission_id", *[F.coalesce(c, F.lit("")).alias(c) for c in columns[1:]])
    both = rows.unionByName(filled)
    hashed = both.select(record_hash(columns).alias("plain"), record_hash(columns, safe=True).alias("safe"))
    return hashed.agg(F.countDistinct("plain").alias("plain_hashes"), F.countDistinct("safe").alias("safe_hashes"))


@query
def rollup_weighted_avg(spark, sf_dir):
    mart = gold.billing_summary(_base(spark, sf_dir))
    return S.roll_up_mean(mart, ["age_group"], "avg_billing_amount", "avg_bill", weight="total_patients")


# ---- sorts, limits --------------------------------------------------------


@query
def sort_desc(spark, sf_dir):
    return gold.presented(gold.billing_summary(_base(spark, sf_dir)), "billing_summary")


@query
def sort_multi_key(spark, sf_dir):
    return gold.presented(gold.patient_demographics(_base(spark, sf_dir)), "patient_demographics")


@query
def limit_ordered(spark, sf_dir):
    rows = _base(spark, sf_dir).select("admission_id", "name", "billing_amount")
    return S.top_rows(rows, "billing_amount", ["admission_id"], n=10)


# ---- marts ----------------------------------------------------------------


@query
def condition_summary(spark, sf_dir):
    return gold.presented(gold.condition_summary(_base(spark, sf_dir)), "condition_summary")


@query
def billing_summary(spark, sf_dir):
    return gold.billing_summary(_base(spark, sf_dir))


@query
def patient_demographics(spark, sf_dir):
    return gold.patient_demographics(_base(spark, sf_dir))


@query
def marts_from_cells(spark, sf_dir):
    return gold.marts_from_cells(gold.mart_cells(_base(spark, sf_dir)))["billing_summary"]


def _side_by_side(marts: dict[str, DataFrame]) -> DataFrame:
    """All marts as one table; columns that a mart lacks are NULL."""
    named = [mart.withColumn("mart", F.lit(name)) for name, mart in marts.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), named)


@query
def marts_from_cells_all(spark, sf_dir):
    return _side_by_side(gold.marts_from_cells(gold.mart_cells(_base(spark, sf_dir))))


# ---- insights -------------------------------------------------------------


def _condition_insight(metric: str) -> Query:
    return lambda spark, sf_dir: gold.condition_insight(
        gold.condition_summary(_base(spark, sf_dir)), metric
    )


def _insight(top: Callable[..., DataFrame], mart: Callable[[DataFrame], DataFrame], *names: str) -> Query:
    return lambda spark, sf_dir: top(mart(_base(spark, sf_dir)), *names)


_QUERIES.update(
    top1_condition_avg_billing=_condition_insight("avg_billing_amount"),
    top1_condition_avg_stay=_condition_insight("avg_length_of_stay_days"),
    top1_condition_abnormal=_condition_insight("abnormal_test_rate_pct"),
    top1_insurer_total=_insight(gold.top_total, gold.billing_summary, *K.INSURER_TOTAL),
    top1_age_group_avg_billing=_insight(gold.top_mean, gold.billing_summary, *K.AGE_GROUP_AVG_BILLING),
    top1_condition_total=_insight(gold.top_total, gold.billing_summary, *K.CONDITION_TOTAL),
    top1_age_group_patients=_insight(gold.top_total, gold.patient_demographics, *K.AGE_GROUP_PATIENTS),
    top1_gender_avg_billing=_insight(gold.top_mean, gold.patient_demographics, *K.GENDER_AVG_BILLING),
    top1_condition_abnormal_segments=_insight(gold.top_mean, gold.patient_demographics, *K.CONDITION_ABNORMAL),
)


# ---- sinks ----------------------------------------------------------------


@query
def sink_overwrite_roundtrip(spark, sf_dir):
    name = f"{scratch_database(spark)}.admissions"
    tables.save_table(_silver(spark, sf_dir).drop("_ingested_at"), name)
    return spark.table(name)


@query
def sink_schema_replace(spark, sf_dir):
    name = f"{scratch_database(spark)}.admissions"
    tables.save_table(admissions(spark, sf_dir), name)
    clean = _silver(spark, sf_dir).drop("_ingested_at")
    tables.save_table(clean, name, partition_by=K.SILVER_PARTITIONS, rebalance=True, keep_previous=False)
    return spark.table(name)


@query
def sink_partitioned_pruned(spark, sf_dir):
    name = f"{scratch_database(spark)}.admissions"
    tables.save_table(_silver(spark, sf_dir), name, partition_by=K.SILVER_PARTITIONS, rebalance=True)
    one = (F.col("_ingest_date") == F.lit(INGESTED_AT[:10]).cast("date")) & (
        F.col("medical_condition") == "BUILDING"
    )
    return spark.table(name).filter(one).select("admission_id", "hospital", "billing_amount")


@query
def validate_roundtrip(spark, sf_dir):
    name = f"{scratch_database(spark)}.condition_summary"
    tables.save_table(gold.condition_summary(_base(spark, sf_dir)), name)
    return spark.table(name).agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("total_patients").alias("patients")
    )


@query
def validate_content(spark, sf_dir):
    """The written table against its source, and against itself with two values swapped."""
    source = _silver(spark, sf_dir)
    name = f"{scratch_database(spark)}.admissions"
    tables.save_table(source, name)
    table = spark.table(name)
    swapped = table.withColumns({"FirstName": F.col("LastName"), "LastName": F.col("FirstName")})
    written = quality.same_content(source.select(*table.columns), table).withColumn("compared", F.lit("written"))
    return written.union(quality.same_content(table, swapped).withColumn("compared", F.lit("swapped")))


@query
def table_detail(spark, sf_dir):
    name = f"{scratch_database(spark)}.admissions"
    tables.save_table(_silver(spark, sf_dir), name, partition_by=K.SILVER_PARTITIONS, rebalance=True)
    detail = tables.table_detail(spark, name)
    return detail.select(
        "format",
        F.array_join("partition_columns", ",").alias("partition_columns"),
        "num_rows",
        (F.col("num_files") > 0).alias("has_files"),
        (F.col("size_in_bytes") > F.col("num_files")).alias("has_bytes"),
        F.col("location").contains(name.split(".")[0]).alias("in_database"),
    )


# ---- upserts --------------------------------------------------------------


def _first_load() -> Column:
    """Whether a row belongs to the first of two loads; every row belongs to one of them."""
    condition = F.col("medical_condition")
    early = F.col("date_of_admission") < F.lit(FIRST_LOAD_BEFORE).cast("date")
    return (condition == "BUILDING") | ((condition != "HOUSEHOLD") & early)


def _two_loads(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    base = _base(spark, sf_dir)
    return base.filter(_first_load()), base.filter(~_first_load())


def _upserted(mart: Callable[[DataFrame], DataFrame], keys, **options) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        name = f"{scratch_database(spark)}.mart"
        for load in _two_loads(spark, sf_dir):
            tables.upsert(mart(load), name, keys, **options)
        return spark.table(name)

    return run


def _condition_first(load: DataFrame) -> DataFrame:
    return gold.condition_summary(load, ties="first")


@query
def upsert_first_run(spark, sf_dir):
    name = f"{scratch_database(spark)}.condition_summary"
    tables.upsert(_condition_first(_base(spark, sf_dir)), name, K.CONDITION_KEYS)
    return spark.table(name)


_QUERIES.update(
    upsert_single_key=_upserted(_condition_first, K.CONDITION_KEYS),
    upsert_composite_key=_upserted(gold.billing_summary, K.BILLING_KEYS),
    upsert_partitioned=_upserted(
        gold.billing_summary, K.BILLING_KEYS, partition_by=["medical_condition"], only_changed=True
    ),
)


def _some_null(mart: Callable[[DataFrame], DataFrame]) -> Callable[[DataFrame], DataFrame]:
    return lambda load: mart(load.withColumn("gender", F.when(F.col("gender") != "UN", F.col("gender"))))


_QUERIES.update(
    upsert_null_safe=_upserted(_some_null(gold.patient_demographics), K.DEMOGRAPHIC_KEYS, null_safe=True),
    upsert_delete_missing=_upserted(gold.billing_summary, K.BILLING_KEYS, delete_missing=True),
)


@query
def upsert_report(spark, sf_dir):
    first, second = (gold.billing_summary(load) for load in _two_loads(spark, sf_dir))
    return tables.merge_report(first, second, K.BILLING_KEYS)


# ---- layout ---------------------------------------------------------------


@query
def compact_rows_preserved(spark, sf_dir):
    name = f"{scratch_database(spark)}.admissions"
    clean = _silver(spark, sf_dir).drop("_ingested_at")
    tables.save_table(clean, name, partition_by=K.SILVER_PARTITIONS)
    tables.compact_table(spark, name, keep_previous=False)
    return spark.table(name)


@query
def cluster_single_col(spark, sf_dir):
    name = f"{scratch_database(spark)}.condition_summary"
    tables.save_table(_condition_first(_base(spark, sf_dir)), name)
    tables.cluster_table(spark, name, ["medical_condition"], keep_previous=False)
    return spark.table(name)


@query
def cluster_zorder_two_cols(spark, sf_dir):
    name = f"{scratch_database(spark)}.admissions"
    tables.save_table(_silver(spark, sf_dir).drop("_ingested_at"), name)
    tables.cluster_table(spark, name, ["insurance_provider", "hospital"], files=8, keep_previous=False)
    return spark.table(name)


# ---- layers ---------------------------------------------------------------


@query
def medallion_end_to_end(spark, sf_dir):
    """A fresh run, then a second one that appends the same feed again."""
    database = scratch_database(spark)
    layout = medallion.Layout(bronze=database, silver=database, gold=database)
    feed = _feed(spark, sf_dir)
    for batch, mode in (("batch-1", "overwrite"), ("batch-2", "append")):
        medallion.refresh(
            spark, feed, layout, schema="string", mode=mode, batch_id=batch, ingested_at=_ingested_at()
        )
    return spark.table(layout.mart("condition_summary"))


@query
def medallion_incremental(spark, sf_dir):
    """Two loads by admission date, the second one sent twice; only new batches are refined."""
    database = scratch_database(spark)
    layout = medallion.Layout(bronze=database, silver=database, gold=database, keep_previous=False)
    early = F.col("date_of_admission") < FIRST_LOAD_BEFORE
    rows = admissions(spark, sf_dir)
    for batch, load in (("1", rows.filter(early)), ("2", rows.filter(~early)), ("3", rows.filter(~early))):
        medallion.refresh(
            spark,
            _csv(load),
            layout,
            cluster=False,
            incremental=True,
            schema="string",
            mode="append",
            batch_id=batch,
            ingested_at=_ingested_at(),
        )
    return spark.table(layout.mart("condition_summary"))


@query
def medallion_recovery(spark, sf_dir):
    """A batch that reached bronze only, then one that is refreshed: both are in all three marts."""
    database = scratch_database(spark)
    layout = medallion.Layout(bronze=database, silver=database, gold=database, keep_previous=False)
    day, rows = F.col("date_of_admission"), admissions(spark, sf_dir)
    loads = [rows.filter(day < FIRST_LOAD_BEFORE), rows.filter((day >= FIRST_LOAD_BEFORE) & (F.col("admission_id") % 2 == 0))]
    loads.append(rows.filter((day >= FIRST_LOAD_BEFORE) & (F.col("admission_id") % 2 > 0)))
    options = {"schema": "string", "mode": "append", "ingested_at": _ingested_at()}
    medallion.refresh(spark, _csv(loads[0]), layout, cluster=False, incremental=True, batch_id="1", **options)
    medallion.ingest(spark, _csv(loads[1]), layout, batch_id="2", **options)
    medallion.refresh(spark, _csv(loads[2]), layout, cluster=False, incremental=True, batch_id="3", **options)
    return _side_by_side({name: spark.table(layout.mart(name)) for name in gold.MART_KEYS})


@query
def medallion_withdrawal(spark, sf_dir):
    """Three overlapping batches, the first one, with rows of its own, withdrawn again: all three marts."""
    database = scratch_database(spark)
    layout = medallion.Layout(bronze=database, silver=database, gold=database, keep_previous=False)
    early, rows = F.col("date_of_admission") < FIRST_LOAD_BEFORE, admissions(spark, sf_dir)
    own = F.when(F.col("admission_id") % 5 == 0, "Elsewhere").otherwise(F.col("hospital"))
    first = rows.filter(F.col("admission_id") % 3 > 0).withColumn("hospital", own)
    options = {"schema": "string", "mode": "append", "ingested_at": _ingested_at(), "cluster": False}
    for batch, load in (("1", first), ("2", rows.filter(early)), ("3", rows.filter(~early))):
        medallion.refresh(spark, _csv(load), layout, incremental=True, batch_id=batch, **options)
    medallion.withdraw(spark, layout, ["1"], cluster=False)
    return _side_by_side({name: spark.table(layout.mart(name)) for name in gold.MART_KEYS})


@cache
def queries() -> dict[str, Query]:
    return dict(_QUERIES)
