"""Applicant-grain features: main-table features and history aggregates.

Every history table is aggregated to one row per entity *before* it is joined, so the
left joins onto the main table can never multiply rows.  All aggregates of one table are
computed in a single ``groupBy().agg()``, but for those below; the nested monthly table is condensed per credit
first and joined onto the credits (two levels, two shuffles).  All aggregates are
algebraic or distinct counts, so Spark combines them map-side and a hot entity costs one
row per map task; distinct counts are aggregated beside the others.

Output names are explicit; a missing optional source column drops only its own feature.
"""
from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..functions.nulls import flag, mean_of_sum, sum_or_zero

ID = "SK_ID_CURR"
# Guard of divisions, days of a year, names of the external scores.
EPS = 1e-5
DAYS_PER_YEAR = 365.25
EXT_SOURCES = ["EXT_SOURCE_1", "EXT_SOURCE_2", "EXT_SOURCE_3"]
# Monthly status codes that mean "overdue".
OVERDUE_STATUSES = ["1", "2", "3", "4", "5"]
# Columns treated as sensitive or as proxies of sensitive attributes.
SENSITIVE_OR_PROXY_FEATURES = ["CODE_GENDER", "DAYS_BIRTH", "NAME_FAMILY_STATUS", "CNT_CHILDREN",
                               "NAME_HOUSING_TYPE", "REGION_RATING_CLIENT",
                               "REGION_RATING_CLIENT_W_CITY"]


def _q(c: str) -> Column:
    return F.col(f"`{c}`")


def _has(df: DataFrame, *cols: str) -> bool:
    return all(c in df.columns for c in cols)


# --------------------------------------------------------------------------- main table
def add_application_features(df: DataFrame, eps: float = EPS) -> DataFrame:
    """Ratios, years from day offsets, external-score statistics, missing counter.

    The missing counter counts nulls over *all* columns present at that point, including
    the derived ones (a missing annuity therefore counts three times).
    """
    new: list[Column] = []
    e = F.lit(eps)
    ratios = [("credit_income_ratio", "AMT_CREDIT", "AMT_INCOME_TOTAL"),
              ("annuity_income_ratio", "AMT_ANNUITY", "AMT_INCOME_TOTAL"),
              ("goods_credit_ratio", "AMT_GOODS_PRICE", "AMT_CREDIT"),
              ("annuity_credit_ratio", "AMT_ANNUITY", "AMT_CREDIT")]
    for name, a, b in ratios:
        if _has(df, a, b):
            new.append(F.try_divide(_q(a), _q(b) + e).alias(name))
    for name, src in [("age_years", "DAYS_BIRTH"), ("employment_years", "DAYS_EMPLOYED"),
                      ("registration_years", "DAYS_REGISTRATION")]:
        if src in df.columns:
            # half-even rounding, as the reference's rounding of floats
            new.append(F.bround(-_q(src).cast("double") / F.lit(DAYS_PER_YEAR), 1).alias(name))
    ext = [c for c in EXT_SOURCES if c in df.columns]
    if ext:
        new.extend(rowwise_stats([_q(c) for c in ext], "external_score"))
    out = df.select(*[_q(c) for c in df.columns], *new)
    n_missing = sum((_q(c).isNull().cast("int") for c in out.columns), F.lit(0))
    return out.withColumn("missing_values_count", n_missing.cast("bigint"))


def rowwise_stats(cols: list[Column], prefix: str) -> list[Column]:
    """Mean, sample std (null for < 2 values), min, max over the present values of a row."""
    n = sum((c.isNotNull().cast("int") for c in cols), F.lit(0))
    total = sum((F.coalesce(c, F.lit(0.0)) for c in cols), F.lit(0.0))
    mean = F.when(n > 0, total / n)
    ss = sum((F.coalesce((c - mean) * (c - mean), F.lit(0.0)) for c in cols), F.lit(0.0))
    std = F.when(n > 1, F.sqrt(ss / (n - 1)))
    if len(cols) == 1:   # least and greatest take two or more
        return [mean.alias(f"{prefix}_mean"), std.alias(f"{prefix}_std"),
                cols[0].alias(f"{prefix}_min"), cols[0].alias(f"{prefix}_max")]
    return [mean.alias(f"{prefix}_mean"), std.alias(f"{prefix}_std"),
            F.least(*cols).alias(f"{prefix}_min"), F.greatest(*cols).alias(f"{prefix}_max")]


# ------------------------------------------------------------------------ history tables
def aggregate_bureau_balance(bb: DataFrame, key: str = "SK_ID_BUREAU") -> DataFrame:
    """Per credit: months recorded (non-null) and months with an overdue status."""
    return bb.where(_q(key).isNotNull()).groupBy(key).agg(
        F.count("MONTHS_BALANCE").alias("BB_MONTHS_COUNT"),
        F.sum(flag(_q("STATUS").isin(OVERDUE_STATUSES))).cast("bigint").alias("BB_OVERDUE_MONTHS"))


def _with_distinct(out: DataFrame, df: DataFrame, key: str, of: str, name: str) -> DataFrame:
    """``out``, one row per key, with the number of distinct values of ``of`` in ``df``.  The
    distinct pairs are exchanged by themselves: in one aggregation, all other sums would be
    exchanged per pair first, then per key."""
    found = df.select(key, of).where(_q(of).isNotNull()).groupBy(key).agg(F.count_distinct(of).alias(name))
    return out.join(found, key, "left").withColumn(name, F.coalesce(name, F.lit(0)).cast("bigint"))


def aggregate_bureau(bureau: DataFrame, bureau_balance: DataFrame | None = None,
                     key: str = ID) -> DataFrame:
    """External credit history -> one row per entity (10 features, plus 2 nested sums).

    The monthly sums are brought to the entity with the two keys of a credit alone, so that
    the credits' other columns take no part in the join by credit.
    """
    df = bureau.where(_q(key).isNotNull())
    aggs: list[Column] = []
    if "SK_ID_BUREAU" in df.columns:
        aggs.append(F.count("SK_ID_BUREAU").alias("BUREAU_COUNT"))
    if "CREDIT_ACTIVE" in df.columns:
        aggs.append(F.sum(flag(_q("CREDIT_ACTIVE") == "Active")).cast("bigint").alias("BUREAU_ACTIVE_COUNT"))
        aggs.append(F.sum(flag(_q("CREDIT_ACTIVE") == "Closed")).cast("bigint").alias("BUREAU_CLOSED_COUNT"))
    overdue = (flag(_q("AMT_CREDIT_SUM_OVERDUE") > 0) if "AMT_CREDIT_SUM_OVERDUE" in df.columns
               else F.lit(0))
    aggs.append(F.sum(overdue).cast("bigint").alias("BUREAU_OVERDUE_COUNT"))
    if "AMT_CREDIT_SUM" in df.columns:
        a = _q("AMT_CREDIT_SUM")
        aggs += [mean_of_sum(a).alias("BUREAU_MEAN_AMT_CREDIT_SUM"),
                 sum_or_zero(a).cast("double").alias("BUREAU_SUM_AMT_CREDIT_SUM"),
                 F.max(a).alias("BUREAU_MAX_AMT_CREDIT_SUM")]
    if "DAYS_CREDIT" in df.columns:
        aggs += [F.avg("DAYS_CREDIT").alias("BUREAU_MEAN_DAYS_CREDIT"),
                 F.min("DAYS_CREDIT").alias("BUREAU_MIN_DAYS_CREDIT")]
    out = df.groupBy(key).agg(*aggs)
    if "CREDIT_TYPE" in df.columns:
        out = _with_distinct(out, df, key, "CREDIT_TYPE", "BUREAU_CREDIT_TYPE_NUNIQUE")
    if bureau_balance is None:
        return out
    sums = {"BUREAU_BB_OVERDUE_MONTHS_SUM": "BB_OVERDUE_MONTHS", "BUREAU_BB_MONTHS_COUNT_SUM": "BB_MONTHS_COUNT"}
    months = df.select(key, "SK_ID_BUREAU").join(aggregate_bureau_balance(bureau_balance), "SK_ID_BUREAU").groupBy(key).agg(
        *[F.sum(c).alias(name) for name, c in sums.items()])
    return out.join(months, key, "left").withColumns({name: F.coalesce(name, F.lit(0)).cast("bigint") for name in sums})


def aggregate_previous(previous: DataFrame, key: str = ID) -> DataFrame:
    """Earlier applications -> counts, approval/refusal, mean amounts, type diversity."""
    df = previous.where(_q(key).isNotNull())
    st = _q("NAME_CONTRACT_STATUS")
    aggs = [F.count("SK_ID_PREV").alias("PREV_COUNT"),
            F.sum(flag(st == "Approved")).cast("bigint").alias("PREV_APPROVED_COUNT"),
            F.sum(flag(st == "Refused")).cast("bigint").alias("PREV_REFUSED_COUNT")]
    if "AMT_CREDIT" in df.columns:
        aggs.append(F.avg("AMT_CREDIT").alias("PREV_MEAN_AMT_CREDIT"))
    if "AMT_ANNUITY" in df.columns:
        aggs.append(F.avg("AMT_ANNUITY").alias("PREV_MEAN_AMT_ANNUITY"))
    out = df.groupBy(key).agg(*aggs)
    if "NAME_CONTRACT_TYPE" in df.columns:
        out = _with_distinct(out, df, key, "NAME_CONTRACT_TYPE", "PREV_CONTRACT_TYPE_NUNIQUE")
    return out.withColumn(
        "PREV_APPROVAL_RATE",
        F.col("PREV_APPROVED_COUNT") / F.greatest(F.col("PREV_COUNT"), F.lit(1)).cast("double"))


def aggregate_installments(inst: DataFrame, key: str = ID) -> DataFrame:
    """Instalments -> delay (paid day - due day) and shortfall (due - paid) statistics."""
    df = inst.where(_q(key).isNotNull())
    delay = _q("DAYS_ENTRY_PAYMENT") - _q("DAYS_INSTALMENT")
    diff = _q("AMT_INSTALMENT") - _q("AMT_PAYMENT")
    return df.groupBy(key).agg(
        F.count("NUM_INSTALMENT_NUMBER").alias("INST_COUNT"),
        F.avg(delay).alias("INST_PAYMENT_DELAY_MEAN"),
        F.max(delay).alias("INST_PAYMENT_DELAY_MAX"),
        F.sum(flag(delay > 0)).cast("bigint").alias("INST_LATE_PAYMENT_COUNT"),
        mean_of_sum(diff).alias("INST_PAYMENT_DIFF_MEAN"),
        sum_or_zero(diff).cast("double").alias("INST_PAYMENT_DIFF_SUM"),
    ).withColumn("INST_LATE_PAYMENT_RATIO",
                 F.col("INST_LATE_PAYMENT_COUNT")
                 / F.greatest(F.col("INST_COUNT"), F.lit(1)).cast("double"))


# The columns that the history aggregates read.
HISTORY_SCHEMAS = {
    "bureau": "SK_ID_CURR long, SK_ID_BUREAU long, CREDIT_ACTIVE string, CREDIT_TYPE string, DAYS_CREDIT long, "
              "AMT_CREDIT_SUM double, AMT_CREDIT_SUM_OVERDUE double",
    "bureau_balance": "SK_ID_BUREAU long, MONTHS_BALANCE long, STATUS string",
    "previous_application": "SK_ID_CURR long, SK_ID_PREV long, NAME_CONTRACT_STATUS string, NAME_CONTRACT_TYPE string, "
                            "AMT_CREDIT double, AMT_ANNUITY double",
    "installments_payments": "SK_ID_CURR long, SK_ID_PREV long, NUM_INSTALMENT_NUMBER long, DAYS_INSTALMENT double, "
                             "DAYS_ENTRY_PAYMENT double, AMT_INSTALMENT double, AMT_PAYMENT double",
}


def with_empty_history(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """``tables`` with an empty table for each absent history, so that the matrix has the same
    columns whatever tables there are: counts 0, all else null.  Where only the monthly table
    is absent, its sums are 0 for entities with credits."""
    spark = tables["application_train"].sparkSession
    return {name: spark.createDataFrame([], ddl) for name, ddl in HISTORY_SCHEMAS.items()} | tables


# ----------------------------------------------------------------------------- assembly
def fill_count_columns(df: DataFrame) -> DataFrame:
    """Missing -> 0 on columns whose name ends with ``_COUNT`` (case-sensitive)."""
    cols = [c for c in df.columns if c.endswith("_COUNT")]
    return df.fillna(0, subset=cols) if cols else df


def build_feature_matrix(tables: dict[str, DataFrame], key: str = ID, static_columns: bool = False) -> DataFrame:
    """Main features left-joined with the three history aggregates; one lazy plan.

    The features of an absent history are absent, or, with ``static_columns``, there without
    values (``with_empty_history``).

    Each aggregate is already hash-partitioned on the key by its own ``groupBy``, so the
    three sort-merge joins reuse that partitioning and only the main table is shuffled.
    """
    if static_columns:
        tables = with_empty_history(tables)
    app = add_application_features(tables["application_train"])
    if "bureau" in tables:
        app = app.join(aggregate_bureau(tables["bureau"], tables.get("bureau_balance"), key), key, "left")
    if "previous_application" in tables:
        app = app.join(aggregate_previous(tables["previous_application"], key), key, "left")
    if "installments_payments" in tables:
        app = app.join(aggregate_installments(tables["installments_payments"], key), key, "left")
    return fill_count_columns(app)


def assert_no_row_explosion(before: DataFrame, after: DataFrame, key: str = ID) -> None:
    """Check job: rows after the joins must equal the distinct keys before them."""
    check_row_count(before.select(key).distinct().count(), after.count())


def check_row_count(n_keys: int, n_rows: int) -> None:
    """Raise unless there is one row per key."""
    if n_rows != n_keys:
        raise AssertionError(f"row explosion: {n_rows} rows instead of {n_keys}")


def watch_rows(df: DataFrame, name: str = "matrix") -> tuple[DataFrame, Observation]:
    """``df`` that counts its rows while the first action on it runs, and where to read the
    count: the guard of a matrix that is written needs no job of its own on the matrix.  The
    count is exact where no exchange follows (tasks of the writing stage count once each)."""
    seen = Observation(name)
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen


def select_prefixed(df: DataFrame, pattern: str = r"^(BUREAU_|PREV_|INST_)",
                    keep: list[str] | None = None) -> DataFrame:
    """Columns whose name matches a regular expression (plus ``keep`` columns first)."""
    rx = re.compile(pattern)
    keep = keep or []
    return df.select(*[_q(c) for c in keep], *[_q(c) for c in df.columns if rx.search(c) and c not in keep])


def leakage_and_ethics_review(df: DataFrame, target: str = "TARGET",
                              sensitive: list[str] = SENSITIVE_OR_PROXY_FEATURES) -> DataFrame:
    """(column, category) for sensitive/proxy columns and label-named leakage candidates."""
    rows = [(c, "sensitive_or_proxy") for c in sensitive if c in df.columns]
    rows += [(c, "leakage_candidate") for c in df.columns if "TARGET" in c.upper() and c != target]
    return df.sparkSession.createDataFrame(rows, "column string, category string")
