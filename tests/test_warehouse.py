from __future__ import annotations

import datetime as dt

import duckdb
import pytest

import __spark_entry__ as entry_points
import oracles
from compare import difference, duck
from helpers import plan_of, rows
from landing import WIDE, export, landing_lines
from tidemart import Warehouse, run
from tidemart.plans import silver
from tidemart.sources.raw import with_lineage
from tidemart.sources.schemas import LAYERS, RAW_SOURCES

DAY = dt.date(2026, 1, 1)


@pytest.fixture(scope="module")
def manifest(spark, sf_dir, tmp_path_factory):
    return export(landing_lines(spark, sf_dir), str(tmp_path_factory.mktemp("landing")))


def contents(warehouse):
    return {
        (layer, table): rows(warehouse.read(layer, table))
        for layer, tables in LAYERS.items()
        for table in tables
    }


def test_run_and_rerun(spark, manifest, tmp_path):
    root = str(tmp_path / "warehouse")
    first = {name: rows(df) for name, df in run(spark, manifest, root, DAY, DAY, entities=WIDE).items()}
    warehouse = Warehouse(spark, root, DAY, DAY, entities=WIDE)
    before = contents(warehouse)
    again = {name: rows(df) for name, df in run(spark, manifest, root, DAY, DAY, entities=WIDE).items()}
    assert again == first
    assert contents(warehouse) == before

    # Expected sizes of this scale, from an independent count.
    size = {key: len(value) for key, value in before.items()}
    assert size["bronze", "sales_details"] == 6000
    assert size["silver", "sales_details"] == 5939
    assert size["silver", "product_info"] == 196
    assert size["silver", "customer_info"] == 147
    assert size["gold", "gold_fact_sales"] == 6991
    assert size["silver", "quality"] == 24
    for table, number in (("gold_dim_customer", "unique_number_customer"), ("gold_dim_product", "unique_number")):
        numbers = [row[0] for row in warehouse.read("gold", table).select(number).collect()]
        assert sorted(numbers) == list(range(1, len(numbers) + 1))


@pytest.mark.parametrize("scale, facts", [("sf0.001", 6991), ("sf0.01", 70708)])
def test_facts_grow_with_the_sales(spark, scale, facts):
    counts = entry_points.q15_gold_counts(spark, f"/root/testdata/{scale}").collect()
    assert {row.table_name: row.rows for row in counts}["gold_fact_sales"] == facts


def test_manifest_must_be_complete(spark, tmp_path):
    with pytest.raises(ValueError, match="lacks sources"):
        Warehouse(spark, str(tmp_path)).ingest({RAW_SOURCES[0]: "/nowhere"})


@pytest.fixture(scope="module")
def connection(sf_dir):
    return duck(sf_dir)


@pytest.mark.parametrize("name", entry_points.warehouse_queries())
def test_query_equals_oracle(spark, sf_dir, connection, name):
    df = entry_points.warehouse_queries()[name](spark, sf_dir)
    assert difference(df, connection, entry_points.oracle_sql()[name]) is None
    plan = plan_of(df)
    for unwanted in ("Python", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert unwanted not in plan


def test_every_query_has_an_oracle():
    assert set(entry_points.warehouse_queries()) <= set(entry_points.oracle_sql())


def test_large_keys_stay_apart(spark, tmp_path):
    """Beyond the widths in use so far, in both engines."""
    orders = spark.range(32).selectExpr(
        "1048560L + id AS o_orderkey", "89990L + id AS o_custkey", "DATE '1995-01-01' AS o_orderdate"
    )
    lines = spark.range(32).selectExpr(
        "1048560L + id AS l_orderkey", "99990L + id AS l_partkey", "DATE '1995-02-01' AS l_shipdate",
        "2.0D AS l_quantity", "20.0D AS l_extendedprice", "1 AS l_linenumber",
    )
    orders.write.parquet(str(tmp_path / "orders.parquet"))
    lines.write.parquet(str(tmp_path / "lineitem.parquet"))
    raw = landing_lines(spark, str(tmp_path), ["sales_details"])["sales_details"]
    silver_rows = silver.clean(with_lineage(raw, "sales_details"), WIDE["sales_details"]).collect()
    assert len({row.sls_ord_num for row in silver_rows}) == 32
    assert len({row.sls_prd_key for row in silver_rows}) == 28  # four share a key with another
    assert len({row.sls_cust_id for row in silver_rows} - {None}) >= 30
    other = duckdb.connect()
    for name in ("orders", "lineitem"):
        other.execute(f"CREATE VIEW {name} AS FROM read_parquet('{tmp_path}/{name}.parquet/*.parquet')")
    sql = oracles.TABLES["land_sales_details"]
    assert sorted(other.execute(sql).fetchall()) == rows(raw)


def test_entry(spark):
    assert entry_points.entry(spark).columns == ["customer_country", "revenue"]
