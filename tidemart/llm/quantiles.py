"""Exact quantiles per group, the same for any number of rows and any layout."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemart.sources.staging import Staging

FINENESS = 1000


def exact_quantiles(
    rows: DataFrame, group: str, columns: list[str], shares: list[float], staging: Staging
) -> DataFrame:
    """``group`` and, for each of ``columns``, the array ``q_<column>``: per share the least value
    that at least so many of the group's values do not exceed. Nulls are left out.

    Equal values are counted first. Counts of bins (thousandths of the unit) tell which bin holds a
    rank; only the values of those bins are then put in order. So a task orders the bins of a
    group, whose number is bounded by the values' range, or the distinct values of one bin.
    """
    pairs = ", ".join(f"'{name}', {name}" for name in columns)
    values = rows.selectExpr(f"{group} AS grp", f"stack({len(columns)}, {pairs}) AS (name, value)")
    values = values.where("value IS NOT NULL").groupBy("grp", "name", "value").agg(F.count("*").alias("n"))
    values = staging.settle(values.withColumn("bin", F.floor(F.col("value") * FINENESS)), "values")
    bins = values.groupBy("grp", "name", "bin").agg(F.sum("n").alias("n"))
    whole = Window.partitionBy("grp", "name")
    bins = bins.withColumn("total", F.sum("n").over(whole))
    bins = bins.withColumn("upto", F.sum("n").over(whole.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)))
    ranks = F.array(*[F.greatest(F.ceil(F.col("total") * share), F.lit(1)) for share in shares])
    held = bins.select("grp", "name", "bin", (F.col("upto") - F.col("n")).alias("before"), "upto", F.posexplode(ranks))
    held = held.toDF("grp", "name", "bin", "before", "upto", "at", "rank").where("before < rank AND rank <= upto")
    held = held.select("grp", "name", "bin", "at", (F.col("rank") - F.col("before")).alias("rank"))
    same = [F.col("v.grp").eqNullSafe(F.col("h.grp")), F.col("v.name") == F.col("h.name"), F.col("v.bin") == F.col("h.bin")]
    inside = values.alias("v").join(held.alias("h"), same).select("v.*", "h.at", "h.rank")
    order = Window.partitionBy("grp", "name", "bin", "at").orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    inside = inside.withColumn("upto", F.sum("n").over(order)).where("upto >= rank")
    found = inside.groupBy("grp", "name", "at").agg(F.min("value").alias("value"))
    arrays = [
        F.transform(
            F.sort_array(F.collect_list(F.when(F.col("name") == name, F.struct("at", "value")))),
            lambda pair: pair["value"],
        ).alias(f"q_{name}")
        for name in columns
    ]
    return found.groupBy(F.col("grp").alias(group)).agg(*arrays)
