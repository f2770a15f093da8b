"""Queries: sources, cleaning, main-table features, history aggregates, feature matrix."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators import clean, features
from ..sources import catalog, fixtures
from ..sources.fixtures import TableSet
from .registry import register, rsql

CREDIT_VIEWS = ["application_train", "bureau", "bureau_balance", "previous_application",
                "installments_payments"]


def credit(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return fixtures.credit_tables(TableSet(spark, sf_dir))


def feature_matrix_df(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean (unique-key check: one key-only aggregation job, after which de-duplication
    is a no-op and is skipped) and build the matrix as one lazy plan."""
    t = credit(spark, sf_dir)
    t["application_train"] = clean.clean_application(t["application_train"], check_unique=True)
    return features.build_feature_matrix(t)


# ------------------------------------------------------------------ SQL building blocks
APP_COLS = ["SK_ID_CURR", "TARGET", "NAME_CONTRACT_TYPE", "CODE_GENDER", "NAME_INCOME_TYPE",
            "OCCUPATION_TYPE", "CNT_CHILDREN", "REGION_RATING_CLIENT", "FLAG_MOBIL",
            "AMT_INCOME_TOTAL", "AMT_CREDIT", "AMT_ANNUITY", "AMT_GOODS_PRICE", "DAYS_BIRTH",
            "DAYS_EMPLOYED", "DAYS_REGISTRATION", "EXT_SOURCE_1", "EXT_SOURCE_2", "EXT_SOURCE_3"]

SQL_APP_CLEAN = """
SELECT * REPLACE (
  CASE WHEN CODE_GENDER <> 'XNA' THEN CODE_GENDER END AS CODE_GENDER,
  CASE WHEN AMT_INCOME_TOTAL > 0 THEN AMT_INCOME_TOTAL END AS AMT_INCOME_TOTAL,
  CASE WHEN AMT_CREDIT > 0 THEN AMT_CREDIT END AS AMT_CREDIT,
  CASE WHEN AMT_ANNUITY > 0 THEN AMT_ANNUITY END AS AMT_ANNUITY,
  CASE WHEN AMT_GOODS_PRICE > 0 THEN AMT_GOODS_PRICE END AS AMT_GOODS_PRICE,
  CASE WHEN DAYS_EMPLOYED <> 365243 THEN DAYS_EMPLOYED END AS DAYS_EMPLOYED),
  CAST(coalesce(DAYS_EMPLOYED = 365243, false) AS INTEGER) AS DAYS_EMPLOYED_ANOMALY
FROM application_train"""

_N_EXT = "((EXT_SOURCE_1 IS NOT NULL)::INTEGER + (EXT_SOURCE_2 IS NOT NULL)::INTEGER + (EXT_SOURCE_3 IS NOT NULL)::INTEGER)"
_SUM_EXT = "(0.0::DOUBLE + coalesce(EXT_SOURCE_1, 0.0::DOUBLE) + coalesce(EXT_SOURCE_2, 0.0::DOUBLE) + coalesce(EXT_SOURCE_3, 0.0::DOUBLE))"
_MEAN_EXT = f"(CASE WHEN {_N_EXT} > 0 THEN {_SUM_EXT} / {_N_EXT} END)"
_SS_EXT = " + ".join(f"coalesce((EXT_SOURCE_{i} - {_MEAN_EXT}) * (EXT_SOURCE_{i} - {_MEAN_EXT}), 0.0::DOUBLE)"
                     for i in (1, 2, 3))

SQL_APP_FEAT0 = f"""
SELECT *,
  AMT_CREDIT / (AMT_INCOME_TOTAL + 1e-5) AS credit_income_ratio,
  AMT_ANNUITY / (AMT_INCOME_TOTAL + 1e-5) AS annuity_income_ratio,
  AMT_GOODS_PRICE / (AMT_CREDIT + 1e-5) AS goods_credit_ratio,
  AMT_ANNUITY / (AMT_CREDIT + 1e-5) AS annuity_credit_ratio,
  round_even(-CAST(DAYS_BIRTH AS DOUBLE) / 365.25::DOUBLE, 1) AS age_years,
  round_even(-DAYS_EMPLOYED / 365.25::DOUBLE, 1) AS employment_years,
  round_even(-DAYS_REGISTRATION / 365.25::DOUBLE, 1) AS registration_years,
  {_MEAN_EXT} AS external_score_mean,
  CASE WHEN {_N_EXT} > 1 THEN sqrt((0.0::DOUBLE + {_SS_EXT}) / ({_N_EXT} - 1)) END AS external_score_std,
  least(EXT_SOURCE_1, EXT_SOURCE_2, EXT_SOURCE_3) AS external_score_min,
  greatest(EXT_SOURCE_1, EXT_SOURCE_2, EXT_SOURCE_3) AS external_score_max
FROM app_clean"""

FEAT0_COLS = APP_COLS + ["DAYS_EMPLOYED_ANOMALY", "credit_income_ratio", "annuity_income_ratio",
                         "goods_credit_ratio", "annuity_credit_ratio", "age_years",
                         "employment_years", "registration_years", "external_score_mean",
                         "external_score_std", "external_score_min", "external_score_max"]
SQL_APP_FEAT = ("SELECT *, CAST(" + " + ".join(f"({c} IS NULL)::INTEGER" for c in FEAT0_COLS)
                + " AS BIGINT) AS missing_values_count FROM app_feat0")

SQL_BB_AGG = """
SELECT SK_ID_BUREAU, count(MONTHS_BALANCE) AS BB_MONTHS_COUNT,
  CAST(sum(CASE WHEN STATUS IN ('1','2','3','4','5') THEN 1 ELSE 0 END) AS BIGINT) AS BB_OVERDUE_MONTHS
FROM bureau_balance WHERE SK_ID_BUREAU IS NOT NULL GROUP BY SK_ID_BUREAU"""

SQL_BUREAU_AGG = """
SELECT b.SK_ID_CURR,
  count(b.SK_ID_BUREAU) AS BUREAU_COUNT,
  CAST(sum(CASE WHEN CREDIT_ACTIVE = 'Active' THEN 1 ELSE 0 END) AS BIGINT) AS BUREAU_ACTIVE_COUNT,
  CAST(sum(CASE WHEN CREDIT_ACTIVE = 'Closed' THEN 1 ELSE 0 END) AS BIGINT) AS BUREAU_CLOSED_COUNT,
  CAST(sum(CASE WHEN AMT_CREDIT_SUM_OVERDUE > 0 THEN 1 ELSE 0 END) AS BIGINT) AS BUREAU_OVERDUE_COUNT,
  avg(AMT_CREDIT_SUM) AS BUREAU_MEAN_AMT_CREDIT_SUM,
  CAST(coalesce(sum(AMT_CREDIT_SUM), 0) AS DOUBLE) AS BUREAU_SUM_AMT_CREDIT_SUM,
  max(AMT_CREDIT_SUM) AS BUREAU_MAX_AMT_CREDIT_SUM,
  avg(DAYS_CREDIT) AS BUREAU_MEAN_DAYS_CREDIT,
  min(DAYS_CREDIT) AS BUREAU_MIN_DAYS_CREDIT,
  count(DISTINCT CREDIT_TYPE) AS BUREAU_CREDIT_TYPE_NUNIQUE,
  CAST(coalesce(sum(BB_OVERDUE_MONTHS), 0) AS BIGINT) AS BUREAU_BB_OVERDUE_MONTHS_SUM,
  CAST(coalesce(sum(BB_MONTHS_COUNT), 0) AS BIGINT) AS BUREAU_BB_MONTHS_COUNT_SUM
FROM bureau b LEFT JOIN bb_agg m ON b.SK_ID_BUREAU = m.SK_ID_BUREAU
WHERE b.SK_ID_CURR IS NOT NULL GROUP BY b.SK_ID_CURR"""

SQL_PREV_AGG = """
SELECT SK_ID_CURR,
  count(SK_ID_PREV) AS PREV_COUNT,
  CAST(sum(CASE WHEN NAME_CONTRACT_STATUS = 'Approved' THEN 1 ELSE 0 END) AS BIGINT) AS PREV_APPROVED_COUNT,
  CAST(sum(CASE WHEN NAME_CONTRACT_STATUS = 'Refused' THEN 1 ELSE 0 END) AS BIGINT) AS PREV_REFUSED_COUNT,
  avg(AMT_CREDIT) AS PREV_MEAN_AMT_CREDIT,
  avg(AMT_ANNUITY) AS PREV_MEAN_AMT_ANNUITY,
  count(DISTINCT NAME_CONTRACT_TYPE) AS PREV_CONTRACT_TYPE_NUNIQUE,
  sum(CASE WHEN NAME_CONTRACT_STATUS = 'Approved' THEN 1 ELSE 0 END) / greatest(count(SK_ID_PREV), 1)::DOUBLE AS PREV_APPROVAL_RATE
FROM previous_application WHERE SK_ID_CURR IS NOT NULL GROUP BY SK_ID_CURR"""

SQL_INST_AGG = """
SELECT SK_ID_CURR,
  count(NUM_INSTALMENT_NUMBER) AS INST_COUNT,
  avg(DAYS_ENTRY_PAYMENT - DAYS_INSTALMENT) AS INST_PAYMENT_DELAY_MEAN,
  max(DAYS_ENTRY_PAYMENT - DAYS_INSTALMENT) AS INST_PAYMENT_DELAY_MAX,
  CAST(sum(CASE WHEN DAYS_ENTRY_PAYMENT - DAYS_INSTALMENT > 0 THEN 1 ELSE 0 END) AS BIGINT) AS INST_LATE_PAYMENT_COUNT,
  avg(AMT_INSTALMENT - AMT_PAYMENT) AS INST_PAYMENT_DIFF_MEAN,
  CAST(coalesce(sum(AMT_INSTALMENT - AMT_PAYMENT), 0) AS DOUBLE) AS INST_PAYMENT_DIFF_SUM,
  sum(CASE WHEN DAYS_ENTRY_PAYMENT - DAYS_INSTALMENT > 0 THEN 1 ELSE 0 END) / greatest(count(NUM_INSTALMENT_NUMBER), 1)::DOUBLE AS INST_LATE_PAYMENT_RATIO
FROM installments_payments WHERE SK_ID_CURR IS NOT NULL GROUP BY SK_ID_CURR"""

COUNT_COLS = ["BUREAU_COUNT", "BUREAU_ACTIVE_COUNT", "BUREAU_CLOSED_COUNT", "BUREAU_OVERDUE_COUNT",
              "PREV_COUNT", "PREV_APPROVED_COUNT", "PREV_REFUSED_COUNT", "INST_COUNT",
              "INST_LATE_PAYMENT_COUNT"]
SQL_MATRIX = ("SELECT * REPLACE (" + ", ".join(f"coalesce({c}, 0) AS {c}" for c in COUNT_COLS) + ")"
              " FROM app_feat LEFT JOIN bureau_agg USING (SK_ID_CURR)"
              " LEFT JOIN prev_agg USING (SK_ID_CURR) LEFT JOIN inst_agg USING (SK_ID_CURR)")

MATRIX_CTES = [("app_clean", SQL_APP_CLEAN), ("app_feat0", SQL_APP_FEAT0), ("app_feat", SQL_APP_FEAT),
               ("bb_agg", SQL_BB_AGG), ("bureau_agg", SQL_BUREAU_AGG), ("prev_agg", SQL_PREV_AGG),
               ("inst_agg", SQL_INST_AGG), ("feature_matrix", SQL_MATRIX)]

APP_DOUBLES = ["AMT_INCOME_TOTAL", "AMT_CREDIT", "AMT_ANNUITY", "AMT_GOODS_PRICE", "DAYS_EMPLOYED",
               "DAYS_REGISTRATION", "EXT_SOURCE_1", "EXT_SOURCE_2", "EXT_SOURCE_3"]
FEAT_DOUBLES = APP_DOUBLES + ["credit_income_ratio", "annuity_income_ratio", "goods_credit_ratio",
                              "annuity_credit_ratio", "age_years", "employment_years",
                              "registration_years", "external_score_mean", "external_score_std",
                              "external_score_min", "external_score_max"]
BUREAU_DOUBLES = ["BUREAU_MEAN_AMT_CREDIT_SUM", "BUREAU_SUM_AMT_CREDIT_SUM",
                  "BUREAU_MAX_AMT_CREDIT_SUM", "BUREAU_MEAN_DAYS_CREDIT"]
PREV_DOUBLES = ["PREV_MEAN_AMT_CREDIT", "PREV_MEAN_AMT_ANNUITY", "PREV_APPROVAL_RATE"]
INST_DOUBLES = ["INST_PAYMENT_DELAY_MEAN", "INST_PAYMENT_DELAY_MAX", "INST_PAYMENT_DIFF_MEAN",
                "INST_PAYMENT_DIFF_SUM", "INST_LATE_PAYMENT_RATIO"]
MATRIX_DOUBLES = FEAT_DOUBLES + BUREAU_DOUBLES + PREV_DOUBLES + INST_DOUBLES


# Column names and Spark types of the feature matrix (the oracle SQL needs them statically).
MATRIX_SCHEMA = [
    ("SK_ID_CURR", "bigint"), ("TARGET", "int"), ("NAME_CONTRACT_TYPE", "string"),
    ("CODE_GENDER", "string"), ("NAME_INCOME_TYPE", "string"), ("OCCUPATION_TYPE", "string"),
    ("CNT_CHILDREN", "int"), ("REGION_RATING_CLIENT", "int"), ("FLAG_MOBIL", "int"),
    ("AMT_INCOME_TOTAL", "double"), ("AMT_CREDIT", "double"), ("AMT_ANNUITY", "double"),
    ("AMT_GOODS_PRICE", "double"), ("DAYS_BIRTH", "int"), ("DAYS_EMPLOYED", "double"),
    ("DAYS_REGISTRATION", "double"), ("EXT_SOURCE_1", "double"), ("EXT_SOURCE_2", "double"),
    ("EXT_SOURCE_3", "double"), ("DAYS_EMPLOYED_ANOMALY", "int"), ("credit_income_ratio", "double"),
    ("annuity_income_ratio", "double"), ("goods_credit_ratio", "double"),
    ("annuity_credit_ratio", "double"), ("age_years", "double"), ("employment_years", "double"),
    ("registration_years", "double"), ("external_score_mean", "double"),
    ("external_score_std", "double"), ("external_score_min", "double"),
    ("external_score_max", "double"), ("missing_values_count", "bigint"),
    ("BUREAU_COUNT", "bigint"), ("BUREAU_ACTIVE_COUNT", "bigint"), ("BUREAU_CLOSED_COUNT", "bigint"),
    ("BUREAU_OVERDUE_COUNT", "bigint"), ("BUREAU_MEAN_AMT_CREDIT_SUM", "double"),
    ("BUREAU_SUM_AMT_CREDIT_SUM", "double"), ("BUREAU_MAX_AMT_CREDIT_SUM", "double"),
    ("BUREAU_MEAN_DAYS_CREDIT", "double"), ("BUREAU_MIN_DAYS_CREDIT", "int"),
    ("BUREAU_CREDIT_TYPE_NUNIQUE", "bigint"), ("BUREAU_BB_OVERDUE_MONTHS_SUM", "bigint"),
    ("BUREAU_BB_MONTHS_COUNT_SUM", "bigint"), ("PREV_COUNT", "bigint"),
    ("PREV_APPROVED_COUNT", "bigint"), ("PREV_REFUSED_COUNT", "bigint"),
    ("PREV_MEAN_AMT_CREDIT", "double"), ("PREV_MEAN_AMT_ANNUITY", "double"),
    ("PREV_CONTRACT_TYPE_NUNIQUE", "bigint"), ("PREV_APPROVAL_RATE", "double"),
    ("INST_COUNT", "bigint"), ("INST_PAYMENT_DELAY_MEAN", "double"),
    ("INST_PAYMENT_DELAY_MAX", "double"), ("INST_LATE_PAYMENT_COUNT", "bigint"),
    ("INST_PAYMENT_DIFF_MEAN", "double"), ("INST_PAYMENT_DIFF_SUM", "double"),
    ("INST_LATE_PAYMENT_RATIO", "double")]
MATRIX_NUMERIC = [c for c, t in MATRIX_SCHEMA if t != "string"]
APP_CLEAN_SCHEMA = MATRIX_SCHEMA[:20]


def matrix_sql(body: str, doubles: list[str], extra: list[tuple[str, str]] = ()) -> str:
    return rsql(body, doubles, views=CREDIT_VIEWS, ctes=MATRIX_CTES + list(extra))


# --------------------------------------------------------------------------------- queries
TABLE_SIZES_SQL = " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, count(*) AS n_rows, "
    f"CAST((SELECT count(*) FROM (DESCRIBE {t})) AS BIGINT) AS n_cols FROM {t}"
    for t in fixtures.DRIVER_TABLES)


@register("table_sizes", TABLE_SIZES_SQL)
def q_table_sizes(spark, sf_dir):
    """Rows x columns of every driver table."""
    t = TableSet(spark, sf_dir)
    return catalog.table_sizes({n: t[n] for n in fixtures.DRIVER_TABLES})


@register("clean_application", matrix_sql("SELECT * FROM app_clean", APP_DOUBLES))
def q_clean_application(spark, sf_dir):
    """Sentinel -> null + flag, invalid amounts -> null, placeholder category -> null."""
    return clean.clean_application(credit(spark, sf_dir)["application_train"], check_unique=False)


@register("application_features", matrix_sql("SELECT * FROM app_feat", FEAT_DOUBLES))
def q_application_features(spark, sf_dir):
    """Ratios, years, external-score statistics and the missing counter."""
    app = clean.clean_application(credit(spark, sf_dir)["application_train"], check_unique=False)
    return features.add_application_features(app)


@register("bureau_balance_by_credit", matrix_sql("SELECT * FROM bb_agg", []))
def q_bureau_balance(spark, sf_dir):
    """Monthly status condensed per credit."""
    return features.aggregate_bureau_balance(credit(spark, sf_dir)["bureau_balance"])


@register("bureau_by_entity", matrix_sql("SELECT * FROM bureau_agg", BUREAU_DOUBLES))
def q_bureau(spark, sf_dir):
    """Credit history per entity, with the nested monthly sums."""
    t = credit(spark, sf_dir)
    return features.aggregate_bureau(t["bureau"], t["bureau_balance"])


@register("previous_by_entity", matrix_sql("SELECT * FROM prev_agg", PREV_DOUBLES))
def q_previous(spark, sf_dir):
    """Earlier applications per entity."""
    return features.aggregate_previous(credit(spark, sf_dir)["previous_application"])


@register("installments_by_entity", matrix_sql("SELECT * FROM inst_agg", INST_DOUBLES))
def q_installments(spark, sf_dir):
    """Payment delay and shortfall per entity."""
    return features.aggregate_installments(credit(spark, sf_dir)["installments_payments"])


@register("feature_matrix", matrix_sql("SELECT * FROM feature_matrix", MATRIX_DOUBLES))
def q_feature_matrix(spark, sf_dir):
    """The flagship: cleaned main table + features, left-joined with three aggregates."""
    return feature_matrix_df(spark, sf_dir)


@register("history_columns", matrix_sql(
    "SELECT SK_ID_CURR, COLUMNS('^(BUREAU_|PREV_|INST_)') FROM feature_matrix",
    BUREAU_DOUBLES + PREV_DOUBLES + INST_DOUBLES))
def q_history_columns(spark, sf_dir):
    """Column selection by name pattern on the matrix."""
    return features.select_prefixed(feature_matrix_df(spark, sf_dir), keep=["SK_ID_CURR"])


@register("model_inputs", matrix_sql("SELECT * EXCLUDE (SK_ID_CURR, TARGET) FROM feature_matrix",
                                     MATRIX_DOUBLES))
def q_model_inputs(spark, sf_dir):
    """Feature columns without id and label."""
    from ..operators.prep import split_features_target
    x, _ = split_features_target(feature_matrix_df(spark, sf_dir))
    return x


@register("class_balance", matrix_sql(
    """SELECT count(*) AS n_total,
         CAST(sum(CASE WHEN TARGET = 0 THEN 1 ELSE 0 END) AS BIGINT) AS n_negative,
         CAST(sum(CASE WHEN TARGET = 1 THEN 1 ELSE 0 END) AS BIGINT) AS n_positive,
         avg(TARGET::DOUBLE) AS positive_rate,
         sum(CASE WHEN TARGET = 0 THEN 1 ELSE 0 END) / greatest(sum(CASE WHEN TARGET = 1 THEN 1 ELSE 0 END), 1)::DOUBLE AS imbalance_ratio
       FROM application_train""", ["positive_rate", "imbalance_ratio"]))
def q_class_balance(spark, sf_dir):
    """n, n0, n1, positive rate, imbalance ratio of the label."""
    return clean.class_balance_summary(credit(spark, sf_dir)["application_train"])


@register("sentinel_share", matrix_sql(
    """SELECT CAST(sum(CASE WHEN DAYS_EMPLOYED = 365243 THEN 1 ELSE 0 END) AS BIGINT) AS n_sentinel,
         avg(CASE WHEN DAYS_EMPLOYED = 365243 THEN 1.0 ELSE 0.0 END)::DOUBLE AS sentinel_share
       FROM application_train""", ["sentinel_share"]))
def q_sentinel_share(spark, sf_dir):
    """Count and share of the employment sentinel before cleaning."""
    return clean.sentinel_share(credit(spark, sf_dir)["application_train"])


@register("key_duplicates", rsql(
    """SELECT CAST(count(*) AS BIGINT) AS n_rows,
         CAST((SELECT count(*) FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem)) AS BIGINT) AS n_distinct_keys,
         CAST(count(*) - (SELECT count(*) FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem)) AS BIGINT) AS n_duplicates
       FROM lineitem""", []))
def q_key_duplicates(spark, sf_dir):
    """Rows, distinct keys and duplicates of (l_orderkey, l_linenumber)."""
    return clean.duplicate_report(TableSet(spark, sf_dir)["lineitem"], ["l_orderkey", "l_linenumber"])


LINE_REST = ["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
             "l_returnflag", "l_linestatus", "l_shipdate"]


@register("dedup_by_key", rsql(
    "SELECT DISTINCT ON (l_orderkey, l_linenumber) * FROM lineitem ORDER BY l_orderkey, l_linenumber, "
    + ", ".join(LINE_REST),
    ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]))
def q_dedup_by_key(spark, sf_dir):
    """Keep the first row per (l_orderkey, l_linenumber) in (other columns) order."""
    return clean.remove_exact_duplicates(TableSet(spark, sf_dir)["lineitem"],
                                         subset=["l_orderkey", "l_linenumber"])


@register("dedup_rows", rsql("SELECT DISTINCT * FROM lineitem",
                             ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]))
def q_dedup_rows(spark, sf_dir):
    """Whole-row duplicate removal."""
    return clean.remove_exact_duplicates(TableSet(spark, sf_dir)["lineitem"])
