"""Registry of named queries and their DuckDB oracle SQL.

A query is ``fn(spark, sf_dir) -> DataFrame`` over the driver tables of one scale factor.
Its oracle is an SQL string over the same tables (pre-registered views), or nothing for
model-dependent results that SQL cannot express.  Double columns are rounded to 4 digits
on both sides as the very last step.
"""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..functions.nulls import round_doubles
from ..sources.fixtures import sql_with

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None, rounded: bool = True):
    def deco(fn: QueryFn) -> QueryFn:
        if rounded:
            def wrapped(spark: SparkSession, sf_dir: str, _fn=fn) -> DataFrame:
                return round_doubles(_fn(spark, sf_dir), 4)
            wrapped.__name__ = fn.__name__
            wrapped.__doc__ = fn.__doc__
            QUERIES[name] = wrapped
        else:
            QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def rsql(body: str, double_cols: list[str], views: list[str] = (), ctes: list[tuple[str, str]] = ()) -> str:
    """Oracle SQL: the fixture views + extra CTEs, then ``body`` with doubles rounded.

    Rounding goes through a 10-digit decimal, so both engines round the decimal value
    half away from zero.
    """
    inner = body.strip()
    if double_cols:
        rep = ", ".join(f"CAST(round(CAST({c} AS DECIMAL(38,10)), 4) AS DOUBLE) AS {c}"
                        for c in double_cols)
        inner = f"SELECT * REPLACE ({rep}) FROM ({inner}) AS q_"
    extra = ",\n".join(f"{n} AS ({s.strip()})" for n, s in ctes)
    if views:
        with_part = sql_with(list(views), "")
        with_part = with_part.rstrip()
        if extra:
            with_part += ",\n" + extra
        return f"{with_part}\n{inner}"
    if extra:
        return f"WITH {extra}\n{inner}"
    return inner


def load_all() -> None:
    """Import every query module (each registers on import)."""
    from . import q_features, q_profile, q_metrics, q_prep, q_models  # noqa: F401
