"""Dense surrogate numbers 1..N over a total order, without a one-task sort."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemart.sources.staging import Staging

_TIE = "_tie"
_PLACE = "_place"

# Layout of monotonically_increasing_id: partition number above 33 bits of row number.
_ROW_BITS = 33
_ROW_MASK = (1 << _ROW_BITS) - 1


def dense_index(df: DataFrame, order: list[str], name: str, staging: Staging) -> DataFrame:
    """Add ``name``: the 1-based position of each row in ascending order, NULLs first.

    ``order`` leads; every other column follows it, so that the numbers depend on the
    rows alone. Equal rows are interchangeable, and a tie number lets the range shuffle
    cut even a group of copies that holds a large part of the table.

    1. Settle the rows with their tie number: the sampling and the shuffle of step 2 then
       see the same rows, and a retried task cannot renumber them.
    2. Range-shuffle, sort each range and settle it with its partition and row number.
    3. Count rows per range, add up the counts over the few ranges and join them back.
    """
    columns = [*order, *[column for column in df.columns if column not in order]]
    tied = staging.settle(
        df.selectExpr("*", f"monotonically_increasing_id() AS {_TIE}"), f"{name}-rows"
    )

    total_order = [F.expr(column).asc_nulls_first() for column in [*columns, _TIE]]
    placed = staging.settle(
        tied.repartitionByRange(*total_order)
        .sortWithinPartitions(*total_order)
        .selectExpr(*df.columns, f"monotonically_increasing_id() AS {_PLACE}"),
        f"{name}-ranges",
    )

    starts = (
        placed.groupBy(F.expr(f"shiftright({_PLACE}, {_ROW_BITS})").alias("start_range"))
        .agg(F.count("*").alias("range_rows"))
        .selectExpr(
            "start_range",
            "coalesce(sum(range_rows) OVER (ORDER BY start_range"
            " ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS range_start",
        )
    )
    # One row per range, at most spark.sql.shuffle.partitions of them: safe to broadcast.
    return placed.join(
        F.broadcast(starts), F.expr(f"shiftright({_PLACE}, {_ROW_BITS}) = start_range")
    ).selectExpr(*df.columns, f"range_start + ({_PLACE} & {_ROW_MASK}L) + 1 AS `{name}`")


def extend_index(
    df: DataFrame, last: DataFrame, key: list[str], order: list[str], name: str, staging: Staging
) -> DataFrame:
    """Add ``name`` to ``df`` so that rows known from ``last`` keep the number they have there.

    ``key`` tells what a row is; of rows with the same key, the first by ``order`` and then by
    every other column keeps the lowest number, the next one the next. Rows that ``last`` lacks
    follow its highest number in ascending order. Numbers of rows that are gone stay unused, unless
    they were the highest.

    Rows are matched by key and place within the key, so a key that holds a large part of
    the table is spread like any other.
    """
    columns, rank, last_rank = df.columns, f"{name}-rank", f"{name}-last"
    ranked = _within_key(dense_index(df, [*key, *order], rank, staging), rank, key)
    last_key = [f"_last_{column}" for column in key]
    known = last.select(
        *[F.expr(column).alias(mine) for column, mine in zip(key, last_key)], F.expr(name).alias(_NUMBER)
    )
    known = _within_key(dense_index(known, [*last_key, _NUMBER], last_rank, staging), last_rank, last_key)
    known = known.withColumnRenamed(_NTH, f"_last{_NTH}")
    same = [F.expr(f"{column} <=> {mine}") for column, mine in zip(key, last_key)]
    joined = ranked.join(known, [*same, F.expr(f"{_NTH} = _last{_NTH}")], "left")
    joined = staging.settle(joined.select(*columns, F.expr(_NUMBER).alias(name)), f"{name}-known")
    new = joined.where(f"{name} IS NULL").drop(name)
    numbered = dense_index(new, [*key, *order], name, staging)
    highest = last.agg(F.max(name)).first()[0] or 0
    numbered = numbered.withColumn(name, F.expr(f"{name} + {highest}L"))
    return joined.where(f"{name} IS NOT NULL").unionByName(numbered)


_NTH, _NUMBER = "_nth", "_number"


def _within_key(ranked: DataFrame, rank: str, key: list[str]) -> DataFrame:
    """``_nth``, the place of each row within its key, for ranks in an order that the key leads."""
    of = [f"_of_{column}" for column in key]
    first = ranked.groupBy(*[F.expr(column).alias(mine) for column, mine in zip(key, of)]).agg(
        F.min(f"`{rank}`").alias("_first")
    )
    same = [F.expr(f"{column} <=> {mine}") for column, mine in zip(key, of)]
    placed = ranked.join(first, same, "inner")
    return placed.withColumn(_NTH, F.expr(f"`{rank}` - _first")).drop(rank, "_first", *of)
