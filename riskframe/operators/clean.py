"""Deterministic cleaning of the main table (no statistics learned from the data).

All functions return lazy plans except the explicit checks (``assert_unique_id``), which
run one aggregation job.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.nulls import flag

# The employment-days sentinel, its flag column, the amount columns that
# must be positive, and the placeholder category that means "missing".
DAYS_EMPLOYED_SENTINEL = 365243
SENTINEL_FLAG = "DAYS_EMPLOYED_ANOMALY"
POSITIVE_AMOUNTS = ["AMT_INCOME_TOTAL", "AMT_CREDIT", "AMT_ANNUITY", "AMT_GOODS_PRICE"]
CATEGORY_PLACEHOLDERS = {"CODE_GENDER": "XNA"}
ID_COLUMN, TARGET = "SK_ID_CURR", "TARGET"


def _q(c: str):
    return F.col(f"`{c}`")


def duplicate_report(df: DataFrame, key_cols: list[str]) -> DataFrame:
    """One row: rows, distinct keys (a missing key counts as one value), duplicate rows.

    Partial aggregation per key, so a hot key costs one row per map task.
    """
    per_key = df.groupBy(*key_cols).agg(F.count(F.lit(1)).alias("_n"))
    return per_key.agg(
        F.sum("_n").cast("bigint").alias("n_rows"),
        F.count(F.lit(1)).cast("bigint").alias("n_distinct_keys"),
        F.sum(F.col("_n") - 1).cast("bigint").alias("n_duplicates"))


def assert_unique_id(df: DataFrame, id_col: str = ID_COLUMN) -> None:
    """Raise ValueError if the id repeats (one job); no-op if the column is absent."""
    if id_col not in df.columns:
        return
    row = duplicate_report(df, [id_col]).first()
    if row and row["n_duplicates"]:
        raise ValueError(f"id '{id_col}' is not unique: {row['n_duplicates']} duplicates")


def remove_exact_duplicates(df: DataFrame, subset: list[str] | None = None,
                            order_by: list[str] | None = None) -> DataFrame:
    """Drop duplicate rows (whole row) or rows repeating ``subset``, keeping the first.

    "First" is the row with the smallest ``order_by`` values (default: all other columns),
    because Spark has no file order.  Implemented as a ``min_by`` aggregation, which is
    combined map-side, so a key holding a large share of the rows is not a hot task.
    """
    if not subset:
        return df.dropDuplicates()
    rest = [c for c in df.columns if c not in subset]
    if not rest:
        return df.dropDuplicates(subset)
    order = order_by or rest
    kept = df.groupBy(*[_q(c) for c in subset]).agg(
        F.min_by(F.struct(*[_q(c) for c in rest]), F.struct(*[_q(c) for c in order])).alias("_row"))
    return kept.select(*[F.col(f"`{c}`") if c in subset else F.col(f"_row.`{c}`").alias(c)
                         for c in df.columns])


def fix_days_employed(df: DataFrame, col: str = "DAYS_EMPLOYED",
                      sentinel: float = DAYS_EMPLOYED_SENTINEL,
                      flag_col: str = SENTINEL_FLAG) -> DataFrame:
    """Sentinel -> null in place, plus a 0/1 indicator column appended at the end."""
    if col not in df.columns:
        return df
    is_sentinel = _q(col) == F.lit(sentinel)
    out = [F.when(~is_sentinel | _q(col).isNull(), _q(col)).alias(c) if c == col else _q(c)
           for c in df.columns if c != flag_col]
    return df.select(*out, flag(is_sentinel).alias(flag_col))


def fix_invalid_values(df: DataFrame, positive_cols: list[str] = POSITIVE_AMOUNTS,
                       placeholders: dict[str, str] = CATEGORY_PLACEHOLDERS) -> DataFrame:
    """Amounts <= 0 -> null; placeholder categories -> null; missing stays missing."""
    out = []
    for c in df.columns:
        if c in positive_cols:
            out.append(F.when(_q(c) > 0, _q(c)).alias(c))
        elif c in placeholders:
            out.append(F.when(_q(c) != F.lit(placeholders[c]), _q(c)).alias(c))
        else:
            out.append(_q(c))
    return df.select(*out)


def clean_application(df: DataFrame, id_col: str = ID_COLUMN, check_unique: bool = True) -> DataFrame:
    """Unique-id check (one job), key de-duplication, sentinel fix, invalid values."""
    if check_unique:
        assert_unique_id(df, id_col)      # after this passes, key de-duplication is a no-op
    elif id_col in df.columns:
        df = remove_exact_duplicates(df, subset=[id_col])
    return fix_invalid_values(fix_days_employed(df))


def class_balance_summary(df: DataFrame, target: str = TARGET) -> DataFrame:
    """One row: n, n0, n1, positive rate, n0 / max(n1, 1)."""
    y = _q(target)
    n0 = F.sum(flag(y == 0)).cast("bigint")
    n1 = F.sum(flag(y == 1)).cast("bigint")
    return df.agg(F.count(F.lit(1)).alias("n_total"), n0.alias("n_negative"),
                  n1.alias("n_positive"), F.avg(y.cast("double")).alias("positive_rate")) \
        .withColumn("imbalance_ratio",
                    F.col("n_negative") / F.greatest(F.col("n_positive"), F.lit(1)).cast("double"))


def class_counts(df: DataFrame, target: str = TARGET) -> DataFrame:
    """Value counts of the label with their share of all rows."""
    return df.groupBy(_q(target).alias("label")).agg(F.count(F.lit(1)).alias("n")) \
        .withColumn("share", F.col("n") / F.sum("n").over(_all()))


def _all():
    from pyspark.sql import Window
    return Window.partitionBy()


def sentinel_share(df: DataFrame, col: str = "DAYS_EMPLOYED",
                   sentinel: float = DAYS_EMPLOYED_SENTINEL) -> DataFrame:
    """Count and share of rows holding the sentinel (before cleaning)."""
    hit = flag(_q(col) == F.lit(sentinel))
    return df.agg(F.sum(hit).cast("bigint").alias("n_sentinel"),
                  F.avg(hit.cast("double")).alias("sentinel_share"))
