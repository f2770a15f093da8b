"""Queries: profiles of the cleaned main table and of the feature matrix."""
from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import clean, profile
from .q_features import APP_CLEAN_SCHEMA, MATRIX_DOUBLES, MATRIX_NUMERIC, credit, feature_matrix_df, matrix_sql
from .registry import register

EDA_COLUMNS = ["AMT_INCOME_TOTAL", "AMT_CREDIT", "age_years", "credit_income_ratio",
               "external_score_mean", "INST_LATE_PAYMENT_RATIO"]

_SPARK_TYPE = {"bigint": "bigint", "int": "int", "double": "double", "string": "string"}


def _canon(c: str, t: str) -> str:
    if t == "double":
        return f"CAST(CASE WHEN {c} = 0 THEN 0.0::DOUBLE ELSE {c} END AS VARCHAR)"
    return f"CAST({c} AS VARCHAR)"


def _long_sql(table: str, schema) -> str:
    return " UNION ALL ".join(f"SELECT '{c}' AS column_name, {_canon(c, t)} AS value FROM {table}"
                              for c, t in schema)


QUALITY_SQL = matrix_sql(f"""
SELECT column_name,
  CASE column_name {' '.join(f"WHEN '{c}' THEN '{t}'" for c, t in APP_CLEAN_SCHEMA)} END AS dtype,
  round_even(sum(CASE WHEN value IS NULL THEN n ELSE 0 END) / sum(n) * 100.0, 2) AS missing_pct,
  count(value) AS n_unique,
  round_even(max(CASE WHEN value IS NOT NULL THEN n END) / sum(n) * 100.0, 2) AS top_share_pct
FROM vc GROUP BY column_name""", ["missing_pct", "top_share_pct"],
    extra=[("long_", _long_sql("app_clean", APP_CLEAN_SCHEMA)),
           ("vc", "SELECT column_name, value, count(*) AS n FROM long_ GROUP BY ALL")])


@register("quality_report", QUALITY_SQL)
def q_quality_report(spark, sf_dir):
    """dtype, missing %, distinct values, top-value share % per column."""
    app = clean.clean_application(credit(spark, sf_dir)["application_train"], check_unique=False)
    return profile.quality_report(app)


@register("constant_columns", matrix_sql(
    "SELECT column_name, max(n) / sum(n) AS top_share FROM vc GROUP BY column_name "
    "HAVING max(n) / sum(n) >= 0.999", ["top_share"],
    extra=[("long_", _long_sql("app_clean", APP_CLEAN_SCHEMA)),
           ("vc", "SELECT column_name, value, count(*) AS n FROM long_ GROUP BY ALL")]))
def q_constant_columns(spark, sf_dir):
    """Columns whose top value (null included) covers >= 99.9 % of rows."""
    app = clean.clean_application(credit(spark, sf_dir)["application_train"], check_unique=False)
    return profile.constant_columns(app)


_ALL_MATRIX = [c for c in MATRIX_NUMERIC] + ["NAME_CONTRACT_TYPE", "CODE_GENDER",
                                             "NAME_INCOME_TYPE", "OCCUPATION_TYPE"]
MISSING_SQL = matrix_sql(
    "SELECT * FROM (" + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, avg(CASE WHEN {c} IS NULL THEN 1.0 ELSE 0.0 END)::DOUBLE AS missing_share "
        f"FROM feature_matrix" for c in _ALL_MATRIX)
    + ") WHERE missing_share > 0 ORDER BY missing_share DESC, column_name LIMIT 20", ["missing_share"])


@register("missingness_ranking", MISSING_SQL)
def q_missingness(spark, sf_dir):
    """Top 20 columns of the matrix by missing share (> 0 only)."""
    return profile.missingness(feature_matrix_df(spark, sf_dir), top=20)


DESCRIBE_SQL = matrix_sql(" UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count({c}) AS count, avg({c}::DOUBLE) AS mean, "
    f"stddev_samp({c}::DOUBLE) AS std, min({c})::DOUBLE AS min, quantile_cont({c}::DOUBLE, 0.25) AS q25, "
    f"quantile_cont({c}::DOUBLE, 0.5) AS q50, quantile_cont({c}::DOUBLE, 0.75) AS q75, "
    f"max({c})::DOUBLE AS max FROM feature_matrix" for c in MATRIX_NUMERIC),
    ["mean", "std", "min", "q25", "q50", "q75", "max"])


@register("describe", DESCRIBE_SQL)
def q_describe(spark, sf_dir):
    """count, mean, std, min, exact quartiles, max of every numeric matrix column."""
    return profile.describe(feature_matrix_df(spark, sf_dir), MATRIX_NUMERIC)


def _hist_sql(c: str) -> str:
    rng = (f"(SELECT CASE WHEN lo = hi THEN lo - 0.5 ELSE lo END AS lo, "
           f"CASE WHEN lo = hi THEN hi + 0.5 ELSE hi END AS hi FROM "
           f"(SELECT min({c})::DOUBLE AS lo, max({c})::DOUBLE AS hi FROM feature_matrix))")
    step = "((r.hi - r.lo) / 40.0::DOUBLE)"
    b0 = f"CAST(least(greatest(floor(({c} - r.lo) * (40.0::DOUBLE / (r.hi - r.lo))), 0), 39) AS INTEGER)"
    b1 = f"(CASE WHEN {c} < r.lo + CAST({b0} AS DOUBLE) * {step} THEN {b0} - 1 ELSE {b0} END)"
    b2 = (f"(CASE WHEN {b1} < 39 AND {c} >= r.lo + CAST({b1} + 1 AS DOUBLE) * {step} "
          f"THEN {b1} + 1 ELSE {b1} END)")
    return (f"SELECT '{c}' AS column_name, g.bin, g.bin * {step} + r.lo AS bin_lo, "
            f"CASE WHEN g.bin = 39 THEN r.hi ELSE (g.bin + 1) * {step} + r.lo END AS bin_hi, "
            f"CAST(coalesce(cnt.n, 0) AS BIGINT) AS n "
            f"FROM {rng} r CROSS JOIN (SELECT CAST(range AS INTEGER) AS bin FROM range(40)) g "
            f"LEFT JOIN (SELECT {b2} AS bin, count(*) AS n FROM feature_matrix, {rng} r "
            f"WHERE {c} IS NOT NULL GROUP BY 1) cnt ON cnt.bin = g.bin")


@register("histogram", matrix_sql(" UNION ALL ".join(_hist_sql(c) for c in EDA_COLUMNS),
                                  ["bin_lo", "bin_hi"]))
def q_histogram(spark, sf_dir):
    """40-bin equal-width histograms of six key matrix columns."""
    return profile.histogram(feature_matrix_df(spark, sf_dir), EDA_COLUMNS, bins=40)


def _box_sql(c: str) -> str:
    return (f"SELECT '{c}' AS column_name, d.TARGET, q.q1, q.median, q.q3, "
            f"min(CASE WHEN d.x >= q.q1 - 1.5 * (q.q3 - q.q1) THEN d.x END) AS whisker_low, "
            f"max(CASE WHEN d.x <= q.q3 + 1.5 * (q.q3 - q.q1) THEN d.x END) AS whisker_high, "
            f"count(*) AS n "
            f"FROM (SELECT TARGET, {c}::DOUBLE AS x FROM feature_matrix WHERE {c} IS NOT NULL) d "
            f"JOIN (SELECT TARGET, quantile_cont({c}::DOUBLE, 0.25) AS q1, "
            f"quantile_cont({c}::DOUBLE, 0.5) AS median, quantile_cont({c}::DOUBLE, 0.75) AS q3 "
            f"FROM feature_matrix WHERE {c} IS NOT NULL GROUP BY TARGET) q ON d.TARGET = q.TARGET "
            f"GROUP BY d.TARGET, q.q1, q.median, q.q3")


@register("box_stats", matrix_sql(" UNION ALL ".join(_box_sql(c) for c in EDA_COLUMNS),
                                  ["q1", "median", "q3", "whisker_low", "whisker_high"]))
def q_box_stats(spark, sf_dir):
    """Quartiles and 1.5-IQR whiskers of six matrix columns per label."""
    return profile.box_stats(feature_matrix_df(spark, sf_dir), EDA_COLUMNS, by="TARGET")


_CORR_FEATURES = [c for c in MATRIX_NUMERIC if c != "TARGET"]
_TCORR = ("SELECT feature, abs(corr) AS abs_corr, corr FROM (" + " UNION ALL ".join(
    f"SELECT '{c}' AS feature, corr({c}::DOUBLE, TARGET::DOUBLE) AS corr FROM feature_matrix"
    for c in _CORR_FEATURES) + ") WHERE corr IS NOT NULL AND NOT isnan(corr)")


@register("target_correlations", matrix_sql(
    f"SELECT * FROM ({_TCORR}) ORDER BY abs_corr DESC, feature LIMIT 20", ["abs_corr", "corr"]))
def q_target_correlations(spark, sf_dir):
    """Top 20 numeric features by absolute Pearson correlation with the label."""
    return profile.target_correlations(feature_matrix_df(spark, sf_dir), "TARGET", top=20)


_LONG_NUM = " UNION ALL ".join(
    f"SELECT SK_ID_CURR AS rid, '{c}' AS col, {c}::DOUBLE AS v FROM feature_matrix" for c in MATRIX_NUMERIC)
CORR_MATRIX_SQL = matrix_sql("""
SELECT a.col AS col_a, b.col AS col_b,
  CASE WHEN isnan(corr(a.v, b.v)) THEN NULL ELSE corr(a.v, b.v) END AS corr
FROM lnum a JOIN lnum b ON a.rid = b.rid
WHERE a.col IN (SELECT feature FROM chosen) AND b.col IN (SELECT feature FROM chosen)
GROUP BY a.col, b.col""", ["corr"], extra=[
    ("tcorr", _TCORR),
    ("chosen", "SELECT 'TARGET' AS feature UNION ALL "
               "SELECT feature FROM (SELECT feature FROM tcorr ORDER BY abs_corr DESC, feature LIMIT 14)"),
    ("lnum", _LONG_NUM)])


@register("correlation_matrix", CORR_MATRIX_SQL)
def q_correlation_matrix(spark, sf_dir):
    """Pairwise-complete Pearson matrix of the label and its 14 strongest correlates."""
    return profile.correlation_matrix(feature_matrix_df(spark, sf_dir), target="TARGET", top=15)


@register("top_k_shortfall", matrix_sql(
    "SELECT SK_ID_CURR, INST_PAYMENT_DIFF_SUM FROM feature_matrix "
    "ORDER BY INST_PAYMENT_DIFF_SUM DESC, SK_ID_CURR LIMIT 10", ["INST_PAYMENT_DIFF_SUM"]))
def q_top_k(spark, sf_dir):
    """Top 10 entities by total payment shortfall (sort + limit, name tie-break)."""
    m = feature_matrix_df(spark, sf_dir).select("SK_ID_CURR", "INST_PAYMENT_DIFF_SUM")
    return profile.top_k(m, "INST_PAYMENT_DIFF_SUM", 10, tie_break=["SK_ID_CURR"])


@register("seeded_entity_sample", matrix_sql(
    "SELECT * FROM feature_matrix ORDER BY md5(SK_ID_CURR::VARCHAR || ':42'), SK_ID_CURR LIMIT 8", MATRIX_DOUBLES))
def q_seeded_sample(spark, sf_dir):
    """Eight entities chosen by a seeded hash (deterministic, exact size)."""
    return profile.seeded_sample(feature_matrix_df(spark, sf_dir), 8, "SK_ID_CURR", seed=42)


@register("dtype_histogram")
def q_dtype_histogram(spark, sf_dir):
    """Number of matrix columns per Spark type."""
    return profile.dtype_counts(feature_matrix_df(spark, sf_dir))


@register("label_counts", matrix_sql(
    "SELECT TARGET AS label, count(*) AS n, count(*) / sum(count(*)) OVER () AS share "
    "FROM application_train GROUP BY TARGET", ["share"]))
def q_label_counts(spark, sf_dir):
    """Value counts of the label with shares."""
    return clean.class_counts(credit(spark, sf_dir)["application_train"]).select(
        "label", "n", F.col("share").cast("double").alias("share"))
