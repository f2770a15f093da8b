"""Physical-plan checks: the shapes that do not survive scale.

* a Cartesian product or nested-loop join (pairs of rows);
* Python evaluation nodes in a plan meant to stay on the JVM;
* a window whose exchange moves raw rows into a single partition.

Windows over small derived tables (bucket offsets, a handful of thresholds) are fine and
are recognised by the caller passing ``allow_single_partition=True``.
"""
from __future__ import annotations

import contextlib
import io

from pyspark.sql import DataFrame

BAD_JOINS = ("CartesianProduct", "BroadcastNestedLoopJoin")
PYTHON_NODES = ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas",
                "PythonUDF")


def physical_plan(df: DataFrame) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    return buf.getvalue()


def plan_problems(df: DataFrame, allow_python: bool = False,
                  allow_single_partition: bool = False) -> list[str]:
    plan = physical_plan(df)
    problems = [f"pair join: {n}" for n in BAD_JOINS if n in plan]
    if not allow_python:
        problems += [f"python node: {n}" for n in PYTHON_NODES if n in plan]
    if not allow_single_partition and "SinglePartition" in plan:
        problems.append("single-partition exchange")
    return problems


def assert_scalable(df: DataFrame, **kw) -> None:
    problems = plan_problems(df, **kw)
    if problems:
        raise AssertionError("; ".join(problems))
