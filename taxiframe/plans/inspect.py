"""Physical-plan checks used by the tests (no exchange in the staging chain,
top-k as TakeOrderedAndProject, no Python node outside the zip reader)."""

from __future__ import annotations

from pyspark.sql import DataFrame


def physical_plan(df: DataFrame) -> str:
    """The executed plan as text (AQE's final plan when it has run)."""
    return df._jdf.queryExecution().executedPlan().toString()


def count_nodes(df: DataFrame, name: str) -> int:
    return physical_plan(df).count(name)


def has_exchange(df: DataFrame) -> bool:
    return "Exchange" in physical_plan(df)


def has_python(df: DataFrame) -> bool:
    plan = physical_plan(df)
    return any(n in plan for n in ("BatchEvalPython", "ArrowEvalPython", "MapInPandas",
                                   "FlatMapGroupsInPandas", "PythonUDF"))
