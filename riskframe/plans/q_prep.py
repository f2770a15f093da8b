"""Queries: model preparation (split and fold sizes, imputation statistics, scaling,
one-hot, class weights, majority baseline)."""
from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import clean, prep
from .q_features import MATRIX_NUMERIC, credit, feature_matrix_df, matrix_sql
from .registry import register

_CC = "SELECT TARGET AS label, count(*) AS c FROM application_train GROUP BY 1"


def _split_ctes(n_test: str) -> list[tuple[str, str]]:
    """CTEs up to alloc_ (label, c, t): rows of a class and those on the test side."""
    return [("cc_", _CC), ("tot_", f"SELECT sum(c) AS n, CAST({n_test} AS BIGINT) AS n_test FROM cc_"), *_ALLOCATION]


_ALLOCATION = [
    ("tr_", "SELECT label, c, n, n_test, (n - n_test) * c / n AS cont, floor((n - n_test) * c / n) AS fl FROM cc_, tot_"),
    ("tr2_", "SELECT *, row_number() OVER (ORDER BY cont - fl DESC, label) AS rk, "
             "(n - n_test) - sum(fl) OVER () AS need FROM tr_"),
    ("tr3_", "SELECT label, c, n_test, c - (fl + CASE WHEN rk <= need THEN 1 ELSE 0 END) AS rest FROM tr2_"),
    ("te_", "SELECT *, n_test * rest / sum(rest) OVER () AS cont, floor(n_test * rest / sum(rest) OVER ()) AS fl FROM tr3_"),
    ("te2_", "SELECT *, row_number() OVER (ORDER BY cont - fl DESC, label) AS rk, "
             "n_test - sum(fl) OVER () AS need FROM te_"),
    ("alloc_", "SELECT label, c, CAST(fl + CASE WHEN rk <= need THEN 1 ELSE 0 END AS BIGINT) AS t FROM te2_"),
]
_SPLIT_CTES = _split_ctes("ceil(0.2 * sum(c))")


def _order_cte(seed: int) -> tuple[str, str]:
    """Rows with their rank in the seeded hash order of their class."""
    return ("ord_", "SELECT SK_ID_CURR, TARGET AS label, row_number() OVER (PARTITION BY TARGET ORDER BY "
                    f"md5(SK_ID_CURR::VARCHAR || ':{seed}'), SK_ID_CURR) AS rk FROM application_train")


@register("split_counts", matrix_sql(
    "SELECT label, false AS is_test, CAST(c - t AS BIGINT) AS n FROM alloc_ "
    "UNION ALL SELECT label, true, t FROM alloc_", [], extra=_SPLIT_CTES))
def q_split_counts(spark, sf_dir):
    """Rows per class on each side of the stratified 80/20 split."""
    app = credit(spark, sf_dir)["application_train"]
    s = prep.stratified_split(app, "TARGET", "SK_ID_CURR", 0.2, 42)
    return s.groupBy(F.col("TARGET").alias("label"), "is_test").agg(F.count(F.lit(1)).alias("n"))


@register("split_membership", matrix_sql(
    "SELECT SK_ID_CURR, o.label, rk <= t AS is_test FROM ord_ o JOIN alloc_ a ON o.label IS NOT DISTINCT FROM a.label",
    [], extra=[*_SPLIT_CTES, _order_cte(42)]))
def q_split_membership(spark, sf_dir):
    """The side of the stratified 80/20 split that each entity is on."""
    app = credit(spark, sf_dir)["application_train"]
    return prep.stratified_split(app, "TARGET", "SK_ID_CURR", 0.2, 42) \
        .select("SK_ID_CURR", F.col("TARGET").alias("label"), "is_test")


SUBSAMPLE_ROWS = 100


@register("subsample_membership", matrix_sql(
    "SELECT SK_ID_CURR, o.label FROM ord_ o JOIN alloc_ a ON o.label IS NOT DISTINCT FROM a.label WHERE rk <= t",
    [], extra=[*_split_ctes(str(SUBSAMPLE_ROWS)), _order_cte(42)]))
def q_subsample_membership(spark, sf_dir):
    """Entities of a stratified subsample of exactly ``SUBSAMPLE_ROWS`` rows (the operator's own limit)."""
    app = credit(spark, sf_dir)["application_train"]
    return prep.stratified_subsample(app, SUBSAMPLE_ROWS).select("SK_ID_CURR", F.col("TARGET").alias("label"))


_FOLD_CTES = [
    ("cc_", _CC),
    ("bounds_", "SELECT label, sum(c) OVER (ORDER BY label) - c AS lo, sum(c) OVER (ORDER BY label) AS hi FROM cc_"),
    ("f_", "SELECT CAST(range AS INTEGER) AS fold FROM range(5)"),
    ("first_", "SELECT fold, label, lo, hi, lo + (((fold - lo) % 5) + 5) % 5 AS first FROM bounds_, f_"),
]


@register("fold_counts", matrix_sql(
    "SELECT fold, label, CAST(CASE WHEN first < hi THEN (hi - 1 - first) // 5 + 1 ELSE 0 END AS BIGINT) AS n "
    "FROM first_ WHERE first < hi", [], extra=_FOLD_CTES))
def q_fold_counts(spark, sf_dir):
    """Rows per (fold, class) of the stratified 5-fold assignment."""
    app = credit(spark, sf_dir)["application_train"]
    f = prep.stratified_folds(app, 5, "TARGET", "SK_ID_CURR", 42)
    return f.groupBy("fold", F.col("TARGET").alias("label")).agg(F.count(F.lit(1)).alias("n"))


@register("fold_membership", matrix_sql(
    "SELECT SK_ID_CURR, label, CAST(sum(CASE WHEN rk > upto THEN 1 ELSE 0 END) AS INTEGER) AS fold FROM ord_ JOIN ("
    "SELECT fold, label, sum(CASE WHEN first < hi THEN (hi - 1 - first) // 5 + 1 ELSE 0 END) OVER (PARTITION BY label ORDER BY fold) AS upto "
    "FROM first_) USING (label) GROUP BY ALL", [], extra=[*_FOLD_CTES, _order_cte(43)]))
def q_fold_membership(spark, sf_dir):
    """The fold of each entity in the stratified 5-fold assignment."""
    app = credit(spark, sf_dir)["application_train"]
    return prep.stratified_folds(app, 5, "TARGET", "SK_ID_CURR", 42) \
        .select("SK_ID_CURR", F.col("TARGET").alias("label"), "fold")


@register("numeric_medians", matrix_sql(" UNION ALL ".join(
    f"SELECT '{c}' AS column_name, quantile_cont({c}::DOUBLE, 0.5) AS median FROM feature_matrix"
    for c in MATRIX_NUMERIC), ["median"]))
def q_numeric_medians(spark, sf_dir):
    """Exact median of every numeric matrix column (the imputation values)."""
    m = feature_matrix_df(spark, sf_dir)
    long = m.select(*[F.col(c).cast("double") for c in MATRIX_NUMERIC]) \
        .unpivot([], MATRIX_NUMERIC, "column_name", "value")
    from ..functions.ordered import exact_quantiles
    return exact_quantiles(long, "value", [0.5], by=["column_name"], names=["median"])


CATS = ["NAME_CONTRACT_TYPE", "CODE_GENDER", "NAME_INCOME_TYPE", "OCCUPATION_TYPE"]


@register("category_modes", matrix_sql(" UNION ALL ".join(
    f"SELECT * FROM (SELECT '{c}' AS column_name, {c} AS mode FROM app_clean WHERE {c} IS NOT NULL "
    f"GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1)" for c in CATS), []))
def q_category_modes(spark, sf_dir):
    """Most frequent value per categorical column (smallest value on ties)."""
    app = clean.clean_application(credit(spark, sf_dir)["application_train"], check_unique=False)
    return prep.column_modes(app, CATS)


SCALE_COLS = ["CNT_CHILDREN", "AMT_INCOME_TOTAL", "AMT_CREDIT", "AMT_ANNUITY", "AMT_GOODS_PRICE", "DAYS_BIRTH", "DAYS_EMPLOYED",
              "DAYS_REGISTRATION", "EXT_SOURCE_1", "EXT_SOURCE_2", "EXT_SOURCE_3"]


@register("standardized", matrix_sql(
    "SELECT SK_ID_CURR, " + ", ".join(
        f"(({c}::DOUBLE - avg({c}::DOUBLE) OVER ()) / coalesce(nullif(stddev_pop({c}::DOUBLE) OVER (), 0), 1)) AS {c}"
        for c in SCALE_COLS) + " FROM app_clean", SCALE_COLS))
def q_standardized(spark, sf_dir):
    """Population standardisation of every numeric main-table column (missing stays missing)."""
    app = clean.clean_application(credit(spark, sf_dir)["application_train"], check_unique=False)
    return prep.standardize(app.select("SK_ID_CURR", *SCALE_COLS), SCALE_COLS)


_SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]


@register("one_hot", matrix_sql(
    "SELECT SK_ID_CURR, NAME_INCOME_TYPE, " + ", ".join(
        f"CAST(coalesce(NAME_INCOME_TYPE = '{v}', false) AS INTEGER) AS NAME_INCOME_TYPE_{v}"
        for v in _SEGMENTS) + " FROM app_clean", []))
def q_one_hot(spark, sf_dir):
    """One 0/1 column per (sorted) category of the income-type column."""
    app = clean.clean_application(credit(spark, sf_dir)["application_train"], check_unique=False)
    return prep.one_hot_columns(app.select("SK_ID_CURR", "NAME_INCOME_TYPE"), "NAME_INCOME_TYPE")


@register("class_weights", matrix_sql(
    "SELECT TARGET AS label, count(*) AS n, sum(count(*)) OVER () / (count(*) OVER () * count(*)) AS weight "
    "FROM application_train GROUP BY TARGET", ["weight"]))
def q_class_weights(spark, sf_dir):
    """Balanced class weights n / (2 n_c)."""
    return prep.class_weight_table(credit(spark, sf_dir)["application_train"], "TARGET")


@register("baseline_scores", matrix_sql(
    "SELECT SK_ID_CURR, (SELECT CASE WHEN sum(TARGET) * 2 > count(*) THEN 1.0 ELSE 0.0 END "
    "FROM application_train)::DOUBLE AS p FROM application_train", ["p"]))
def q_baseline_scores(spark, sf_dir):
    """Majority-class baseline: the same 0/1 probability for every entity."""
    from ..operators.models import MajorityBaseline
    app = credit(spark, sf_dir)["application_train"]
    model = MajorityBaseline(label="TARGET").fit(app)
    return model.transform(app).select("SK_ID_CURR", "p")
