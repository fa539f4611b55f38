"""Data-quality counts: every rule of an entity in one aggregate."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidemart.sources.schemas import LAYERS


def _counts(rules: Mapping[str, str]) -> list:
    return [F.expr(f"count_if({rule}) AS {name}") for name, rule in rules.items()]


def count_invalid(assessed: DataFrame, entity: str, rules: Mapping[str, str]) -> DataFrame:
    """``entity, rule, invalid_rows`` for SQL conditions that mark a row as invalid."""
    counts = assessed.agg(*_counts(rules))
    pairs = ", ".join(f"'{name}', {name}" for name in rules)
    return counts.selectExpr(
        f"'{entity}' AS entity", f"stack({len(rules)}, {pairs}) AS (rule, invalid_rows)"
    )


def observe_invalid(
    assessed: DataFrame, entity: str, rules: Mapping[str, str]
) -> tuple[DataFrame, Observation]:
    """Count the same rules while the rows pass by on their way to a sink."""
    observation = Observation(f"{entity} quality")
    return assessed.observe(observation, *_counts(rules)), observation


def observed_quality(spark: SparkSession, observations: Mapping[str, Observation]) -> DataFrame:
    """Quality rows of finished writes: one per rule."""
    rows = [
        (entity, rule, invalid)
        for entity, observation in observations.items()
        for rule, invalid in observation.get.items()
    ]
    return spark.createDataFrame(rows, LAYERS["silver"]["quality"])
