"""For each query the SQL, runnable by DuckDB on the same tables, that gives the expected result."""

from __future__ import annotations

INGESTED_AT = "2024-06-01 08:30:00"
BATCH_ID = "batch-1"
SOURCE = "admissions"
FIRST_LOAD_BEFORE = "1998-01-01"

DATA_COLUMNS = (
    "admission_id name age gender blood_type medical_condition date_of_admission discharge_date hospital "
    "insurance_provider billing_amount room_number admission_type medication test_results"
).split()


def _hash(columns: list[str]) -> str:
    texts = ", ".join(f"coalesce(cast({c} AS varchar), '')" for c in columns)
    return f"sha256(concat_ws('||', {texts}))"


def _initcap(x: str) -> str:
    word = "lambda w: concat(upper(substr(w, 1, 1)), substr(w, 2))"
    return f"array_to_string(list_transform(string_split(lower(trim({x})), ' '), {word}), ' ')"


def _strip_titles(x: str) -> str:
    words = "'JR','SR','III','II','PHD','MR','MRS','MS','DR','NIECE','SON','DAUGHTER'"
    keep = f"lambda t: t <> '' AND upper(trim(t, '.,()')) NOT IN ({words})"
    return f"array_to_string(list_filter(string_split_regex({x}, '\\s+'), {keep}), ' ')"


# Spark rounds decimals and decimal forms of doubles half up; DuckDB's round() works on
# the binary double and may miss an exact half. So averages are stated in integers:
# floor((2 * scale * total + n) / (2 * n)) is total / n, rounded half up, in units of 1 / scale.
def _half_up(total: str, n: str, scale: int) -> str:
    return f"((2 * {scale} * cast({total} AS hugeint) + {n}) // (2 * {n}))"


def _average(column: str, digits: int) -> str:
    scale = 10**digits
    return f"cast({_half_up(f'sum({column})', f'count({column})', scale)} AS double) / {scale}"


def _money_average(column: str) -> str:
    cents = _half_up(f"(sum({column}) * 100)", f"count({column})", 1)
    return f"cast(cast({cents} AS decimal(18,0)) * cast(0.01 AS decimal(3,2)) AS decimal(18,2))"


def _percent(condition: str) -> str:
    return f"cast({_half_up(f'count(*) FILTER ({condition})', 'count(*)', 10000)} AS double) / 100"


ABNORMAL = "test_results = 'Abnormal'"

ADM_ONCE = """
adm_once AS (
  SELECT o_orderkey AS admission_id,
    CASE WHEN o_custkey % 43 = 0 THEN ' Dr. ' ELSE concat('  ',
      CASE o_custkey % 6 WHEN 0 THEN 'mr. ' WHEN 1 THEN 'DR ' WHEN 2 THEN '(Mrs.) ' ELSE '' END,
      lower(c_mktsegment), '  ',
      CASE WHEN o_custkey % 3 = 0 THEN concat(r_name, ' ') ELSE '' END,
      CASE WHEN o_custkey % 5 = 0 THEN '' ELSE n_name END,
      CASE o_custkey % 7 WHEN 0 THEN ' jr.' WHEN 1 THEN ' III' ELSE '' END, ' ') END AS name,
    CASE WHEN o_orderkey % 97 = 0 THEN 'abc' WHEN o_orderkey % 89 = 0 THEN NULL
      ELSE cast(o_custkey % 131 - 5 AS varchar) END AS age,
    CASE o_custkey % 7 WHEN 0 THEN 'M' WHEN 1 THEN ' male' WHEN 2 THEN 'F' WHEN 3 THEN 'Female '
      WHEN 4 THEN '' WHEN 6 THEN 'x' END AS gender,
    CASE o_custkey % 6 WHEN 0 THEN ' a+' WHEN 1 THEN 'O-' WHEN 2 THEN 'ab+ ' WHEN 3 THEN '  '
      WHEN 5 THEN 'B-' END AS blood_type,
    c_mktsegment AS medical_condition,
    strftime(o_orderdate, '%Y-%m-%d') AS date_of_admission,
    CASE WHEN o_orderkey % 101 = 0 THEN '2024-13-01' WHEN o_orderkey % 103 = 0 THEN NULL
      WHEN o_orderkey % 50 = 0 THEN '2099-01-01'
      ELSE strftime(o_orderdate + INTERVAL 1 DAY * (o_orderkey % 40 - 2), '%Y-%m-%d') END AS discharge_date,
    concat(n_name, ' & Co., #', cast(o_custkey % 10 AS varchar)) AS hospital,
    CASE WHEN o_custkey % 11 <> 0 THEN r_name END AS insurance_provider,
    cast(cast(CASE WHEN o_orderkey % 67 = 0 THEN -o_totalprice ELSE o_totalprice END AS decimal(18,2)) AS varchar)
      AS billing_amount,
    cast(o_orderkey % 500 AS varchar) AS room_number,
    o_orderpriority AS admission_type,
    CASE WHEN o_orderkey % 4 <> 0 THEN concat('drug', cast(o_orderkey % 6 AS varchar)) END AS medication,
    CASE o_orderstatus WHEN 'F' THEN 'Abnormal' WHEN 'O' THEN 'Normal' END AS test_results
  FROM orders JOIN customer ON o_custkey = c_custkey
    JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
)"""
ADM = """
adm AS (
  SELECT * EXCLUDE (copy) FROM (
    SELECT *, unnest(CASE WHEN admission_id % 20 = 0 THEN [1, 2] ELSE [1] END) AS copy FROM adm_once)
)"""
BRONZE = f"""
bronze AS (
  SELECT *, TIMESTAMP '{INGESTED_AT}' AS _ingested_at, DATE '{INGESTED_AT[:10]}' AS _ingest_date,
    '{SOURCE}' AS _source_file, '{BATCH_ID}' AS _batch_id, {_hash(DATA_COLUMNS)} AS _record_hash
  FROM adm
)"""
UNIQUE = """
uniq AS (
  SELECT * FROM bronze QUALIFY row_number() OVER (PARTITION BY _record_hash ORDER BY admission_id) = 1
)"""
SILVER = f"""
named AS (
  SELECT * REPLACE ({_initcap('name')} AS name,
      regexp_replace(hospital, '[^A-Za-z0-9 ]', '', 'g') AS hospital,
      CASE WHEN upper(trim(gender)) IN ('M', 'MALE') THEN 'M'
        WHEN upper(trim(gender)) IN ('F', 'FEMALE') THEN 'F' ELSE 'UN' END AS gender,
      CASE WHEN blood_type IS NULL OR trim(blood_type) = '' THEN 'UN' ELSE upper(trim(blood_type)) END AS blood_type,
      try_cast(age AS integer) AS age,
      try_cast(billing_amount AS decimal(18,2)) AS billing_amount,
      try_cast(room_number AS integer) AS room_number,
      try_cast(date_of_admission AS date) AS date_of_admission,
      try_cast(discharge_date AS date) AS discharge_date,
      coalesce(medication, 'Not Prescribed') AS medication,
      coalesce(test_results, 'Pending') AS test_results,
      coalesce(insurance_provider, 'Unknown') AS insurance_provider)
  FROM uniq
),
cleaned AS (
  SELECT *, {_strip_titles('name')} AS name_clean FROM named
),
tokens AS (
  SELECT *, string_split_regex(trim(name_clean), '\\s+') AS toks FROM cleaned
),
featured AS (
  SELECT * EXCLUDE (toks), toks[1] AS FirstName,
    CASE WHEN len(toks) >= 2 THEN toks[-1] END AS LastName,
    CASE WHEN len(toks) >= 3 THEN array_to_string(toks[2:-2], ' ') ELSE '' END AS MiddleName,
    cast(date_diff('day', date_of_admission, discharge_date) AS integer) AS length_of_stay_days,
    CASE WHEN age < 18 THEN 'Paediatric' WHEN age < 35 THEN 'Young Adult' WHEN age < 60 THEN 'Middle Aged'
      ELSE 'Senior' END AS age_group
  FROM tokens
),
flagged AS (
  SELECT *, age BETWEEN 0 AND 120 AS dq_age_valid, billing_amount > 0 AS dq_billing_valid,
    discharge_date >= date_of_admission AS dq_dates_valid,
    length_of_stay_days BETWEEN 0 AND 365 AS dq_length_of_stay_valid,
    name_clean IS NOT NULL AND length(name_clean) > 1 AS dq_name_valid
  FROM featured
),
silver AS (
  SELECT *, dq_age_valid AND dq_billing_valid AND dq_dates_valid AND dq_length_of_stay_valid AND dq_name_valid
    AS dq_passed
  FROM flagged
)"""
BASE = "base AS (SELECT * FROM silver WHERE dq_passed)"

_CONDITION_METRICS = f"""
  count(*) AS total_patients,
  {_average('length_of_stay_days', 2)} AS avg_length_of_stay_days,
  max(length_of_stay_days) AS max_length_of_stay_days,
  {_money_average('billing_amount')} AS avg_billing_amount,
  cast(sum(billing_amount) AS decimal(28,2)) AS total_billing_amount,
  {_percent(ABNORMAL)} AS abnormal_test_rate_pct"""


def condition_core(source: str) -> str:
    return f"SELECT medical_condition, {_CONDITION_METRICS} FROM {source} GROUP BY medical_condition"


def condition_mart(source: str, ties: str = "all") -> str:
    rank = "rank() OVER (PARTITION BY medical_condition ORDER BY n DESC)"
    if ties == "first":
        rank = "row_number() OVER (PARTITION BY medical_condition ORDER BY n DESC, admission_type NULLS FIRST)"
    return f"""
      SELECT m.*, t.admission_type AS most_common_admission_type
      FROM ({condition_core(source)}) m LEFT JOIN (
        SELECT medical_condition, admission_type FROM (
          SELECT medical_condition, admission_type, count(*) AS n FROM {source} GROUP BY ALL)
        QUALIFY {rank} = 1) t ON m.medical_condition = t.medical_condition"""


def billing_mart(source: str) -> str:
    return f"""
      SELECT insurance_provider, age_group, medical_condition, count(*) AS total_patients,
        cast(sum(billing_amount) AS decimal(28,2)) AS total_billing_amount,
        {_money_average('billing_amount')} AS avg_billing_amount,
        min(billing_amount) AS min_billing_amount, max(billing_amount) AS max_billing_amount
      FROM {source} GROUP BY insurance_provider, age_group, medical_condition"""


def demographics_mart(source: str) -> str:
    return f"""
      SELECT age_group, gender, medical_condition, count(*) AS total_patients, {_average('age', 1)} AS avg_age,
        {_average('length_of_stay_days', 2)} AS avg_length_of_stay_days,
        {_money_average('billing_amount')} AS avg_billing_amount,
        cast(sum(billing_amount) AS decimal(28,2)) AS total_billing_amount,
        {_percent(ABNORMAL)} AS abnormal_test_rate_pct
      FROM {source} GROUP BY age_group, gender, medical_condition"""


_STEPS = [ADM_ONCE, ADM, BRONZE, UNIQUE, SILVER, BASE]
_UP_TO = {"adm": 2, "bronze": 3, "uniq": 4, "silver": 5, "base": 6}


def over(level: str, select: str, *more: str) -> str:
    return "WITH " + ",".join([*_STEPS[: _UP_TO[level]], *more]) + "\n" + select


def _top(select: str, by: str, key: str) -> str:
    return f"SELECT * FROM ({select}) ORDER BY {by} DESC NULLS LAST, {key} ASC NULLS FIRST LIMIT 1"


def _profile(column: str) -> str:
    """One column of the CSV feed, where empty text is null; the feed has no decimals, timestamps or truth values."""
    text = f"nullif(cast({column} AS varchar), '')"
    whole = f"regexp_full_match({text}, '[+-]?[0-9]+')"
    number = f"regexp_full_match({text}, '[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?')"
    day = f"regexp_full_match({text}, '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}') AND try_cast({text} AS date) IS NOT NULL"
    return (
        f"SELECT '{column}' AS column_name, CASE WHEN count({text}) = 0 THEN 'string'"
        f" WHEN bool_and({whole} AND try_cast({text} AS integer) IS NOT NULL) THEN 'int'"
        f" WHEN bool_and({whole} AND try_cast({text} AS bigint) IS NOT NULL) THEN 'bigint'"
        f" WHEN bool_and({number}) THEN 'double' WHEN bool_and({day}) THEN 'date' ELSE 'string' END AS data_type,"
        f" count(*) - count({text}) AS n_null, count(*) AS n_rows, max(length({text})) AS longest FROM adm"
    )


def _flag_counts() -> str:
    flags = "dq_age_valid dq_billing_valid dq_dates_valid dq_length_of_stay_valid dq_name_valid dq_passed".split()
    one = (
        "SELECT '{0}' AS rule, count(*) AS total, count(*) FILTER ({0}) AS n_true,"
        " count(*) FILTER (NOT {0}) AS n_false, count(*) FILTER ({0} IS NULL) AS n_null FROM silver"
    )
    return " UNION ALL ".join(one.format(f) for f in flags)


# The two loads of the upsert queries: every row belongs to exactly one. BUILDING
# rows come only in the first, HOUSEHOLD rows only in the second.
_FIRST_LOAD = (
    "medical_condition = 'BUILDING' OR (medical_condition <> 'HOUSEHOLD' AND "
    f"date_of_admission < DATE '{FIRST_LOAD_BEFORE}')"
)
_LOADS = (
    f"first_load AS (SELECT * FROM base WHERE {_FIRST_LOAD})",
    f"second_load AS (SELECT * FROM base WHERE NOT ({_FIRST_LOAD}))",
)


def _merged(mart, keys: list[str]) -> str:
    same = " AND ".join(f"u.{k} = t.{k}" for k in keys)
    return over(
        "base",
        f"SELECT * FROM u UNION ALL BY NAME SELECT * FROM t WHERE NOT EXISTS (SELECT 1 FROM u WHERE {same})",
        *_LOADS,
        f"t AS ({mart('first_load')})",
        f"u AS ({mart('second_load')})",
    )


def _side_by_side(source: str) -> str:
    marts = {
        "condition_summary": condition_mart(source, "first"),
        "billing_summary": billing_mart(source),
        "patient_demographics": demographics_mart(source),
    }
    return " UNION ALL BY NAME ".join(f"SELECT *, '{name}' AS mart FROM ({sql})" for name, sql in marts.items())


_SOME = "(SELECT * REPLACE (CASE WHEN admission_id % 5 > 0 THEN medical_condition END AS medical_condition) FROM base)"
_ODD = "admission_type IN ('1-URGENT', '3-MEDIUM', '5-LOW')"
_TIED = (
    f"tied AS (SELECT * REPLACE (CASE WHEN {_ODD} THEN 'odd' ELSE 'even' END AS admission_type) FROM {_SOME} UNION ALL "
    f"SELECT * REPLACE (CASE WHEN {_ODD} THEN 'even' ELSE 'odd' END AS admission_type) FROM {_SOME})"
)
_GENDER = "CASE WHEN gender <> 'UN' THEN gender END AS gender"


def _null_safe_merged() -> str:
    keys = ("age_group", "gender", "medical_condition")
    same = " AND ".join(f"u.{k} IS NOT DISTINCT FROM t.{k}" for k in keys)
    return over(
        "base",
        f"SELECT * FROM u UNION ALL BY NAME SELECT * FROM t WHERE NOT EXISTS (SELECT 1 FROM u WHERE {same})",
        *_LOADS,
        *[
            f"{short} AS ({demographics_mart(f'(SELECT * REPLACE ({_GENDER}) FROM {load})')})"
            for short, load in (("t", "first_load"), ("u", "second_load"))
        ],
    )


def oracle_sql() -> dict[str, str]:
    adm = "SELECT {} FROM adm".format
    csv_types = {
        "date_of_admission": "cast(date_of_admission AS date)",
        "billing_amount": "cast(billing_amount AS double)",
        "room_number": "cast(room_number AS integer)",
        "admission_id": "cast(admission_id AS integer)",
        "gender": "nullif(gender, '')",
    }
    csv_read = ", ".join(f"{csv_types.get(c, c)} AS {c}" for c in DATA_COLUMNS)
    order_columns = (
        "SELECT o_orderkey, o_custkey, o_orderstatus, cast(o_totalprice AS decimal(18,2)) AS o_totalprice,"
        " strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate, o_orderpriority FROM orders"
    )
    order_names = "o_orderkey o_custkey o_orderstatus o_totalprice o_orderdate o_orderpriority".split()
    lineage = (
        f"'{INGESTED_AT}' AS _ingested_at, DATE '{INGESTED_AT[:10]}' AS _ingest_date, "
        f"'{BATCH_ID}' AS _batch_id"
    )
    condition = condition_mart("base")
    billing, demographics = billing_mart("base"), demographics_mart("base")
    counts = (
        "SELECT medical_condition, admission_type, count(*) AS admission_count FROM base "
        "GROUP BY medical_condition, admission_type"
    )
    bronze = over(
        "adm",
        f"SELECT *, {lineage}, 'feed' AS _source_file, {_hash(DATA_COLUMNS)} AS _record_hash "
        f"FROM (SELECT {csv_read} FROM adm)",
    )
    insight = "SELECT medical_condition, {0} FROM ({1})".format

    def roll_up(how: str, mart: str, key: str, column: str, alias: str) -> str:
        return f"SELECT {key}, {how.format(column)} AS {alias} FROM ({mart}) GROUP BY {key}"

    total, money = "cast(sum({}) AS bigint)", "cast(sum({}) AS decimal(38,2))"
    money_mean = _money_average("{0}")
    pct_mean = f"cast({_half_up('(sum(cast({0} AS decimal(18,2))) * 100)', 'count({0})', 1)} AS double) / 100"

    sql = {
        # sources
        "scan_csv_infer": over("adm", f"SELECT {csv_read} FROM adm"),
        "csv_profile": over("adm", " UNION ALL ".join(map(_profile, DATA_COLUMNS))),
        "scan_table": over("adm", adm("*")),
        "sql_projection": over("adm", adm("name, gender, blood_type")),
        "ingest_metadata": f"SELECT *, {lineage}, 'orders.parquet' AS _source_file, "
        f"{_hash(order_names)} AS _record_hash FROM ({order_columns})",
        "clean_column_names": over(
            "adm", adm("admission_id, name AS patient_name, billing_amount AS billing_amount_, test_results")
        ),
        "bronze_ingest": bronze,
        "bronze_ingest_observed": bronze,
        "record_hash": over("adm", adm(f"admission_id, {_hash(DATA_COLUMNS)} AS record_hash")),
        # projections
        "project_alias": over(
            "silver", "SELECT admission_id AS id, medical_condition AS condition, billing_amount AS billed FROM silver"
        ),
        "drop_columns": over("silver", "SELECT * EXCLUDE (_ingested_at) FROM silver"),
        # scalars
        "str_trim_upper": over("adm", adm("admission_id, upper(trim(blood_type)) AS blood_type")),
        "str_initcap": over("adm", adm(f"admission_id, {_initcap('name')} AS name")),
        "str_strip_special": over(
            "adm", adm("admission_id, regexp_replace(hospital, '[^A-Za-z0-9 ]', '', 'g') AS hospital")
        ),
        "str_concat_ws": over(
            "adm", adm("admission_id, concat_ws(' ', medication, test_results, insurance_provider) AS joined")
        ),
        "null_defaults": over(
            "adm",
            adm(
                "admission_id, coalesce(medication, 'Not Prescribed') AS medication, "
                "coalesce(test_results, 'Pending') AS test_results, "
                "coalesce(insurance_provider, 'Unknown') AS insurance_provider"
            ),
        ),
        "cast_types": over(
            "adm",
            adm(
                "admission_id, try_cast(age AS integer) AS age, "
                "try_cast(billing_amount AS decimal(18,2)) AS billing_amount, "
                "try_cast(room_number AS integer) AS room_number"
            ),
        ),
        "parse_dates": over(
            "adm",
            adm(
                "admission_id, try_cast(date_of_admission AS date) AS date_of_admission, "
                "try_cast(discharge_date AS date) AS discharge_date"
            ),
        ),
        "length_of_stay": over(
            "adm",
            adm(
                "admission_id, cast(date_diff('day', try_cast(date_of_admission AS date), "
                "try_cast(discharge_date AS date)) AS integer) AS length_of_stay_days"
            ),
        ),
        "age_group": over(
            "adm",
            "SELECT admission_id, age, CASE WHEN age < 18 THEN 'Paediatric' WHEN age < 35 THEN 'Young Adult' "
            "WHEN age < 60 THEN 'Middle Aged' ELSE 'Senior' END AS age_group "
            "FROM (SELECT admission_id, try_cast(age AS integer) AS age FROM adm)",
        ),
        "gender_code": over(
            "adm",
            adm(
                "admission_id, CASE WHEN upper(trim(gender)) IN ('M', 'MALE') THEN 'M' "
                "WHEN upper(trim(gender)) IN ('F', 'FEMALE') THEN 'F' ELSE 'UN' END AS gender"
            ),
        ),
        "blood_type_code": over(
            "adm",
            adm(
                "admission_id, CASE WHEN blood_type IS NULL OR trim(blood_type) = '' THEN 'UN' "
                "ELSE upper(trim(blood_type)) END AS blood_type"
            ),
        ),
        # names
        "name_clean": over("adm", adm(f"admission_id, {_strip_titles(_initcap('name'))} AS name_clean")),
        "name_tokens": over(
            "silver",
            "SELECT admission_id, array_to_string(toks, '|') AS tokens, cast(len(toks) AS integer) AS token_count "
            "FROM (SELECT admission_id, string_split_regex(trim(name_clean), '\\s+') AS toks FROM silver)",
        ),
        "name_parts": over("silver", "SELECT admission_id, FirstName, LastName, MiddleName FROM silver"),
        "name_standardize": over(
            "silver", "SELECT admission_id, name, name_clean, FirstName, LastName, MiddleName FROM silver"
        ),
        # filters
        "filter_dq_passed": over("silver", "SELECT admission_id, medical_condition FROM silver WHERE dq_passed"),
        "filter_equality": over(
            "silver", "SELECT admission_id, test_results FROM silver WHERE test_results = 'Abnormal'"
        ),
        "filter_like": over("silver", "SELECT admission_id, gender, name FROM silver WHERE name LIKE '%Build%'"),
        "filter_isin": over("silver", "SELECT admission_id, gender FROM silver WHERE gender IN ('M', 'F')"),
        "filter_between": over("silver", "SELECT admission_id, age FROM silver WHERE age BETWEEN 0 AND 120"),
        "filter_comparison": over(
            "silver",
            "SELECT admission_id, billing_amount FROM silver WHERE discharge_date >= date_of_admission "
            "AND billing_amount > 0 AND age < 60",
        ),
        "filter_null_checks": over(
            "silver", "SELECT admission_id, age FROM silver WHERE discharge_date IS NULL AND age IS NOT NULL"
        ),
        # quality
        "dq_flags": over(
            "silver",
            "SELECT admission_id, dq_age_valid, dq_billing_valid, dq_dates_valid, dq_length_of_stay_valid, "
            "dq_name_valid, dq_passed FROM silver",
        ),
        "dq_report": over(
            "silver",
            "SELECT rule, total, n_true AS passed, total - n_true AS failed, "
            "round(cast(n_true AS double) / total * 100, 1) AS passed_pct, "
            f"round(cast(total - n_true AS double) / total * 100, 1) AS failed_pct FROM ({_flag_counts()})",
        ),
        "dq_three_valued_counts": over("silver", _flag_counts()),
        "dedupe_record_hash": over("uniq", "SELECT * EXCLUDE (_ingested_at) FROM uniq"),
        "dedupe_stored": over("uniq", "SELECT * EXCLUDE (_ingested_at) FROM uniq"),
        "dedupe_report": over(
            "bronze",
            "SELECT count(*) AS records_before, count(DISTINCT _record_hash) AS records_after, "
            "count(*) - count(DISTINCT _record_hash) AS duplicates_removed FROM bronze",
        ),
        "exclusion_report": over(
            "silver",
            "SELECT count(*) AS total_records, count(*) FILTER (dq_passed) AS kept_records, "
            "count(*) - count(*) FILTER (dq_passed) AS excluded_records FROM silver",
        ),
        # aggregates
        "count_rows": over("base", "SELECT count(*) AS n_rows FROM base"),
        "condition_summary_core": over("base", condition_core("base")),
        "agg_avg_rounded": over(
            "base",
            f"SELECT medical_condition, {_average('age', 1)} AS avg_age, "
            f"{_money_average('billing_amount')} AS avg_billing_amount "
            "FROM base GROUP BY medical_condition",
        ),
        "agg_min_max": over(
            "base",
            "SELECT medical_condition, min(billing_amount) AS min_billing_amount, "
            "max(billing_amount) AS max_billing_amount, max(length_of_stay_days) AS max_length_of_stay_days "
            "FROM base GROUP BY medical_condition",
        ),
        "agg_sum_decimal": over(
            "base",
            "SELECT insurance_provider, cast(sum(billing_amount) AS decimal(28,2)) AS total_billing_amount "
            "FROM base GROUP BY insurance_provider",
        ),
        "agg_conditional_count": over(
            "base",
            "SELECT medical_condition, count(*) FILTER (test_results = 'Abnormal') AS abnormal_results "
            "FROM base GROUP BY medical_condition",
        ),
        "agg_abnormal_rate_pct": over(
            "base",
            f"SELECT hospital, {_percent(ABNORMAL)} AS abnormal_test_rate_pct FROM base GROUP BY hospital",
        ),
        "rollup_sum_of_sums": over(
            "base", roll_up(money, billing, "medical_condition", "total_billing_amount", "condition_total")
        ),
        "rollup_avg_of_avgs": over("base", roll_up(money_mean, billing, "age_group", "avg_billing_amount", "avg_bill")),
        # mode, window, join
        "mode_ties_all": over(
            "base",
            f"SELECT medical_condition, admission_type AS most_common_admission_type FROM ({counts}) "
            "QUALIFY rank() OVER (PARTITION BY medical_condition ORDER BY admission_count DESC) = 1",
        ),
        "mode_ties_first": over(
            "base",
            "SELECT hospital, admission_type AS most_common_admission_type FROM "
            "(SELECT hospital, admission_type, count(*) AS n FROM base GROUP BY ALL) QUALIFY row_number() OVER "
            "(PARTITION BY hospital ORDER BY n DESC, admission_type NULLS FIRST) = 1",
        ),
        "window_rank_by_count": over(
            "base",
            "SELECT *, cast(rank() OVER (PARTITION BY medical_condition ORDER BY admission_count DESC) AS integer) "
            f"AS rank FROM ({counts})",
        ),
        "join_left_using": over(
            "base",
            "SELECT c.medical_condition, c.total_patients, m.female_admission_type FROM "
            "(SELECT medical_condition, count(*) AS total_patients FROM base GROUP BY ALL) c LEFT JOIN "
            "(SELECT medical_condition, admission_type AS female_admission_type FROM "
            "(SELECT medical_condition, admission_type, count(*) AS n FROM base WHERE gender = 'F' GROUP BY ALL) "
            "QUALIFY rank() OVER (PARTITION BY medical_condition ORDER BY n DESC) = 1) m USING (medical_condition)",
        ),
        # sort, limit
        "sort_desc": over("base", f"{billing} ORDER BY total_billing_amount DESC NULLS LAST"),
        "sort_multi_key": over(
            "base", f"{demographics} ORDER BY age_group NULLS FIRST, gender NULLS FIRST, total_patients DESC NULLS LAST"
        ),
        "limit_ordered": over(
            "base",
            "SELECT admission_id, name, billing_amount FROM base ORDER BY billing_amount DESC, admission_id LIMIT 10",
        ),
        # marts
        "condition_summary": over("base", condition),
        "billing_summary": over("base", billing),
        "patient_demographics": over("base", demographics),
        "marts_from_cells": over("base", billing),
        # insights
        "top1_condition_avg_billing": over(
            "base", _top(insight("avg_billing_amount", condition), "avg_billing_amount", "medical_condition")
        ),
        "top1_condition_avg_stay": over(
            "base", _top(insight("avg_length_of_stay_days", condition), "avg_length_of_stay_days", "medical_condition")
        ),
        "top1_condition_abnormal": over(
            "base", _top(insight("abnormal_test_rate_pct", condition), "abnormal_test_rate_pct", "medical_condition")
        ),
        "top1_insurer_total": over(
            "base",
            _top(
                roll_up(money, billing, "insurance_provider", "total_billing_amount", "grand_total"),
                "grand_total",
                "insurance_provider",
            ),
        ),
        "top1_age_group_avg_billing": over(
            "base",
            _top(roll_up(money_mean, billing, "age_group", "avg_billing_amount", "avg_bill"), "avg_bill", "age_group"),
        ),
        "top1_condition_total": over(
            "base",
            _top(
                roll_up(money, billing, "medical_condition", "total_billing_amount", "condition_total"),
                "condition_total",
                "medical_condition",
            ),
        ),
        "top1_age_group_patients": over(
            "base", _top(roll_up(total, demographics, "age_group", "total_patients", "total"), "total", "age_group")
        ),
        "top1_gender_avg_billing": over(
            "base",
            _top(roll_up(money_mean, demographics, "gender", "avg_billing_amount", "avg_bill"), "avg_bill", "gender"),
        ),
        "top1_condition_abnormal_segments": over(
            "base",
            _top(
                roll_up(pct_mean, demographics, "medical_condition", "abnormal_test_rate_pct", "avg_abnormal"),
                "avg_abnormal",
                "medical_condition",
            ),
        ),
        # sinks
        "sink_overwrite_roundtrip": over("silver", "SELECT * EXCLUDE (_ingested_at) FROM silver"),
        "sink_schema_replace": over("silver", "SELECT * EXCLUDE (_ingested_at) FROM silver"),
        "sink_partitioned_pruned": over(
            "silver",
            "SELECT admission_id, hospital, billing_amount FROM silver "
            f"WHERE _ingest_date = DATE '{INGESTED_AT[:10]}' AND medical_condition = 'BUILDING'",
        ),
        "validate_roundtrip": over(
            "base", f"SELECT count(*) AS n_rows, cast(sum(total_patients) AS bigint) AS patients FROM ({condition})"
        ),
        # upsert
        "upsert_first_run": over("base", condition_mart("base", "first")),
        "upsert_single_key": _merged(lambda s: condition_mart(s, "first"), ["medical_condition"]),
        "upsert_composite_key": _merged(billing_mart, ["insurance_provider", "age_group", "medical_condition"]),
        "upsert_partitioned": _merged(billing_mart, ["insurance_provider", "age_group", "medical_condition"]),
        "upsert_report": over(
            "base",
            "SELECT count(*) FILTER (t.k IS NULL) AS inserted, "
            "count(*) FILTER (t.k IS NOT NULL AND u.k IS NOT NULL AND t.v IS DISTINCT FROM u.v) AS updated, "
            "count(*) FILTER (t.k IS NOT NULL AND u.k IS NOT NULL AND t.v IS NOT DISTINCT FROM u.v) AS unchanged, "
            "count(*) FILTER (u.k IS NULL) AS kept FROM "
            "(SELECT (insurance_provider, age_group, medical_condition) AS k, (total_patients, total_billing_amount, "
            "avg_billing_amount, min_billing_amount, max_billing_amount) AS v FROM t) t FULL JOIN "
            "(SELECT (insurance_provider, age_group, medical_condition) AS k, (total_patients, total_billing_amount, "
            "avg_billing_amount, min_billing_amount, max_billing_amount) AS v FROM u) u ON t.k = u.k",
            *_LOADS,
            f"t AS ({billing_mart('first_load')})",
            f"u AS ({billing_mart('second_load')})",
        ),
        # layout
        "compact_rows_preserved": over("silver", "SELECT * EXCLUDE (_ingested_at) FROM silver"),
        "cluster_single_col": over("base", condition_mart("base", "first")),
        "cluster_zorder_two_cols": over("silver", "SELECT * EXCLUDE (_ingested_at) FROM silver"),
        "upsert_null_safe": _null_safe_merged(),
        "upsert_delete_missing": over("base", billing_mart("second_load"), *_LOADS),
        "validate_content": over(
            "silver",
            "SELECT count(*) AS n_rows, count(*) AS n_rows_other, side = 'written' AS same, side AS compared "
            "FROM silver, (VALUES ('written'), ('swapped')) AS sides(side) GROUP BY side",
        ),
        "table_detail": over(
            "silver",
            "SELECT 'parquet' AS format, '_ingest_date,medical_condition' AS partition_columns, count(*) AS num_rows, "
            "true AS has_files, true AS has_bytes, true AS in_database FROM silver",
        ),
        "dedupe_same_survivors": over(
            "uniq",
            "SELECT count(*) AS survivors, cast(0 AS bigint) AS only_plain, cast(0 AS bigint) AS only_stored FROM uniq",
        ),
        "mode_ties_tied": over(
            "base",
            "SELECT medical_condition, admission_type AS most_common_admission_type FROM "
            "(SELECT medical_condition, admission_type, count(*) AS n FROM tied GROUP BY ALL) "
            "QUALIFY rank() OVER (PARTITION BY medical_condition ORDER BY n DESC) = 1",
            _TIED,
        ),
        "condition_summary_tied": over("base", condition_mart("tied"), _TIED),
        "record_hash_safe": over(
            "adm",
            "SELECT count(DISTINCT admission_id) AS plain_hashes, count(DISTINCT (admission_id, age, gender, blood_type))"
            " AS safe_hashes FROM (SELECT admission_id, age, gender, blood_type FROM adm UNION ALL SELECT admission_id, "
            "coalesce(age, ''), coalesce(gender, ''), coalesce(blood_type, '') FROM adm)",
        ),
        "rollup_weighted_avg": over(
            "base",
            "SELECT age_group, cast(cast("
            + _half_up("(sum(avg_billing_amount * total_patients) * 100)", "cast(sum(total_patients) AS hugeint)", 1)
            + " AS decimal(18,0)) * cast(0.01 AS decimal(3,2)) AS decimal(18,2)) AS avg_bill "
            f"FROM ({billing}) GROUP BY age_group",
        ),
        "marts_from_cells_all": over("base", _side_by_side("base")),
        "medallion_recovery": over("base", _side_by_side("base")),
        "medallion_withdrawal": over("base", _side_by_side("base")),
        # layers
        "medallion_end_to_end": over("base", condition_mart("base", "first")),
        "medallion_incremental": over("base", condition_mart("base", "first")),
    }
    return sql
