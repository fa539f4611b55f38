from __future__ import annotations

from pyspark.sql import DataFrame


def plan_of(df: DataFrame) -> str:
    """The physical plan; the final one if the rows were already computed."""
    return df._jdf.queryExecution().executedPlan().toString()


def rows(df: DataFrame) -> list[tuple]:
    """Rows in an order of their own, for comparing contents."""
    return sorted((tuple(row) for row in df.collect()), key=repr)
