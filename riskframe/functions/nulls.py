"""Null-model helpers.

The reference has a single missing marker that aggregates skip and comparisons treat as
false.  Spark has null and NaN, and NaN compares greater than everything.  The rules here:

* ``nan_to_null`` at every source, so NaN never reaches an aggregate;
* ``sum_or_zero`` where an all-missing group must sum to 0;
* ``flag`` where a comparison on a missing value must count as 0;
* ``safe_div`` where a zero divisor must give null instead of an ANSI error.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_FLOATS = (T.DoubleType, T.FloatType)


def nan_to_null(df: DataFrame) -> DataFrame:
    """Replace NaN by null in every floating-point column (one projection, no job)."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, _FLOATS):
            c = F.when(~F.isnan(c), c).alias(f.name)
        cols.append(c)
    return df.select(*cols)


def flag(cond: Column) -> Column:
    """0/1 integer of a predicate; a missing operand gives 0."""
    return F.coalesce(cond.cast("int"), F.lit(0))


def sum_or_zero(c: Column | str) -> Column:
    """Sum that is 0 (not null) for a group without present values."""
    return F.coalesce(F.sum(c), F.lit(0))


def mean_of_sum(c: Column | str) -> Column:
    """Mean of doubles that shares its sum with a ``sum`` of the same column: a partial row
    carries that sum once."""
    return F.try_divide(F.sum(c), F.count(c))


def safe_div(a: Column, b: Column) -> Column:
    """a / b, null when b is 0 or missing."""
    return F.try_divide(a, b)


def round_doubles(df: DataFrame, digits: int = 4) -> DataFrame:
    """Round every double column for display and oracle comparison (final step only).

    The value is first fixed to 10 decimals, so a value that is a decimal tie (x.xxxx5) but
    stored a hair below it as a double rounds up, as it does in the SQL oracle.
    """
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, _FLOATS):
            dec = F.round(c.cast("double").try_cast("decimal(38,10)"), digits).cast("double")
            c = F.coalesce(dec, F.round(c.cast("double"), digits)).alias(f.name)
        cols.append(c)
    return df.select(*cols)
