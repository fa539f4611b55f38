from __future__ import annotations

import random

import pytest

from helpers import plan_of, rows
from tidemart.operators.dense_index import dense_index
from tidemart.sources.staging import Staging


def numbered(df, order):
    return dense_index(df, order, "n", Staging(df.sparkSession))


@pytest.fixture
def uncoalesced(spark):
    """Keep every range, so that small data still spans many of them."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def brute_force(values, order):
    """Numbers by a plain sort: NULL first, leading columns first."""
    width = len(values[0])
    columns = [*order, *[i for i in range(width) if i not in order]]
    key = lambda row: [(row[i] is not None, row[i] if row[i] is not None else 0) for i in columns]
    return sorted((*row, n) for n, row in enumerate(sorted(values, key=key), 1))


def test_equals_a_plain_sort(spark, uncoalesced):
    random.seed(7)
    values = [(i, random.randrange(400), random.randrange(5)) for i in range(5_000)]
    df = spark.createDataFrame(values, "a int, b int, c int").repartition(6)
    got = numbered(df, ["b", "c"])
    assert sorted(tuple(row) for row in got.collect()) == brute_force(values, [1, 2])


def test_nulls_come_first(spark):
    df = spark.createDataFrame([(2,), (None,), (1,)], "a int")
    assert rows(numbered(df, ["a"])) == [(1, 2), (2, 3), (None, 1)]


def test_copies_are_cut_over_ranges(spark, uncoalesced):
    """A third of all rows are the same; no range may hold them all."""
    df = spark.range(9_000).selectExpr("IF(id < 3000, -1, id) AS a").repartition(6)
    got = numbered(df, ["a"])
    assert sorted(row.n for row in got.collect()) == list(range(1, 9_001))
    assert got.where("a = -1").selectExpr("min(n)", "max(n)").first() == (1, 3_000)
    placed = [path for path in got.inputFiles() if "n-ranges" in path]
    files = spark.read.parquet(*placed).where("a = -1").selectExpr("input_file_name() AS f")
    assert files.distinct().count() >= 2


def test_empty_table(spark):
    assert numbered(spark.createDataFrame([], "a int"), ["a"]).collect() == []


def test_numbers_stay_the_same_when_read_again(spark):
    df = spark.range(500).selectExpr("id % 7 AS a", "id AS b").repartition(5)
    got = numbered(df, ["a"])
    assert rows(got) == rows(got) == rows(numbered(df.repartition(3), ["a"]))


def test_no_rows_meet_in_one_task(spark, uncoalesced):
    got = numbered(spark.range(1000).toDF("a"), ["a"])
    plan = plan_of(got)
    # The only single-task step adds up one count per range.
    assert plan.count("SinglePartition") == 1
    assert "range_rows" in plan.split("SinglePartition")[0]
