from __future__ import annotations

import dataclasses
import datetime as dt
import os
from pathlib import Path

import pytest

from helpers import plan_of, rows
from landing import WIDE, landing_lines
from tidemart.operators.quality import observe_invalid, observed_quality
from tidemart.plans import silver
from tidemart.plans.silver import ENTITIES
from tidemart.sources.raw import raw_lines, with_lineage

AS_OF = dt.date(2026, 1, 1)
DAY = dt.date.fromisoformat


def bronze_of(spark, table, *lines):
    df = spark.createDataFrame([(line,) for line in lines], "rawdata string")
    return with_lineage(df, ENTITIES[table].source, AS_OF)


def cleaned(spark, table, *lines):
    return rows(silver.clean(bronze_of(spark, table, *lines), ENTITIES[table], AS_OF))


def test_customer(spark):
    got = cleaned(
        spark,
        "customer_info",
        "11000,AW00011000, Mia,Berg ,F,S,2025-10-06",
        "11001,aw00011001,,,f ,s,2025-1-5,extra",
        "11002,AW00011002,Eve,Li,M,M",
        "11003,BAD,Eve,Li,M,M,2025-10-06",
        None,
        "",
    )
    assert got == rows_of(
        (11000, "AW00011000", "Mia Berg", "Single", "Female", DAY("2025-10-06")),
        (11001, "AW00011001", None, "Single", "Female", None),
    )


def rows_of(*values):
    return sorted(values, key=repr)


def test_field_positions_can_be_swapped(spark):
    entity = ENTITIES["customer_info"]
    positions = {**entity.positions, "raw_gender": 5, "raw_marital": 4}
    swapped = dataclasses.replace(entity, positions=positions)
    line = "1,AW00000001,A,B,S,F,2025-10-06"
    row = silver.clean(bronze_of(spark, "customer_info", line), swapped).first()
    assert (row.customer_martial_cleaned, row.customer_gender_cleaned) == ("Single", "Female")


def test_birth(spark):
    got = cleaned(
        spark,
        "customer_birth",
        "NASAW00011000,1971-10-06,Male",
        "nasaw00011001,1971/10/06,n/a",
        "AW00011002,1971-10-06,Male",
        "NASAW00011003,1971-10-06",
    )
    assert got == rows_of(
        ("AW00011000", DAY("1971-10-06"), "Male", 54), ("AW00011001", None, None, None)
    )


def test_location(spark):
    got = cleaned(spark, "customer_location", "AW-00011000,US", "AW-00011001,Spain,", "AW00011002,US", "AW-1")
    assert got == rows_of(("AW00011000", "United States"), ("AW00011001", None))


def test_category(spark):
    got = cleaned(spark, "category_products", "AC_BR,Accessories,Bike Racks,Yes", "AC_XX,,,maybe", "AC-BR,a,b,No", "AC_YY,a,b")
    assert got == rows_of(("AC_BR", "Accessories", "Bike Racks", "Yes"), ("AC_XX", None, None, None))


def test_product(spark):
    got = cleaned(
        spark,
        "product_info",
        "212,AC-HE-HL-U509-R,Sport-100 Helmet- Red,12,S ,2011-07-01,2007-12-28",
        "213,CO-RF,,abc,,2011-02-30",
        "1234,CO-RF-X,a,1,M,2011-07-01,",
        "215,CO-RF-X,a,1,M",
    )
    assert got == rows_of(
        ("212", "AC_HE", "HL-U509-R", "Sport-100 Helmet- Red", 12.0, "Other Sales", DAY("2011-07-01")),
        ("213", "CO_RF", "", "N/A", 0.0, "N/A", None),
    )


def test_sale(spark):
    got = cleaned(
        spark,
        "sales_details",
        "SO43697,BK-R93R-62,21768,20101229,20110105,20110110,3578,1,3578",
        "SO43698,BK,123,32154,,0,101,2,50",
        "so43699,BK-1,21768,20101229,20110105,20110110,1,1,1",
        "SO43700,BK-1,21768,20101229,20110105,20110110,1,1",
    )
    assert got == rows_of(
        ("SO43697", "BK-R93R-62", 21768, DAY("2010-12-29"), None, DAY("2011-01-10"), 3578.0, 1.0, 3578.0),
        ("SO43698", "N/A", None, None, "bad_length", None, 100.0, 2.0, 50.0),
    )


def test_unusual_white_space_is_trimmed(spark):
    got = cleaned(spark, "customer_location", "　AW-00011000 , France\t", "\x1fAW-00011001\x1c,DE")
    assert got == rows_of(("AW00011000", "France"), ("AW00011001", "Germany"))


@pytest.fixture(scope="module")
def landing(spark, sf_dir):
    return {name: with_lineage(df, name, AS_OF) for name, df in landing_lines(spark, sf_dir).items()}


def test_observed_counts_equal_counted_ones(spark, landing):
    observations = {}
    for name, entity in WIDE.items():
        assessed = silver.assess(landing[entity.source], entity, AS_OF)
        observed, observations[name] = observe_invalid(assessed, name, entity.rules)
        silver.keep_valid(observed, entity).write.format("noop").mode("overwrite").save()
    counted = silver.quality(landing, WIDE, AS_OF)
    assert rows(observed_quality(spark, observations)) == rows(counted)
    assert counted.count() == 24


def test_counts_include_rows_that_are_dropped(spark):
    bronze = {entity.source: bronze_of(spark, entity.table, "") for entity in ENTITIES.values()}
    bronze["sales_details"] = bronze_of(
        spark, "sales_details", "x,PK9,ABCDE,2010,,20131399,1,1,1", "SO43697,BK-1,123,,,0,1,1,1", "x"
    )
    counts = {
        (row.entity, row.rule): row.invalid_rows
        for row in silver.quality(bronze, ENTITIES, AS_OF).collect()
    }
    sales = {rule: n for (entity, rule), n in counts.items() if entity == "sales_details"}
    assert sales == {
        "order_number": 1,
        "sold_product_key": 1,
        "buyer_id": 1,
        "order_date": 0,
        "due_date": 1,
        "buyer_id_not_numeric": 1,
    }
    assert sum(counts.values()) == sum(sales.values())


@pytest.mark.parametrize("table", ENTITIES)
def test_plan_is_narrow_and_splits_once(spark, tmp_path, table):
    path = str(tmp_path / table)
    bronze_of(spark, table, "a,b").write.parquet(path)
    plan = plan_of(silver.clean(spark.read.parquet(path), ENTITIES[table], AS_OF))
    assert plan.count("split(") == 1
    assert "Exchange" not in plan and "Python" not in plan
    assert "ReadSchema: struct<rawdata:string>" in plan
    assert "PushedFilters: [IsNotNull(rawdata)]" in plan


# Point this at a folder with the product and category exports to check their totals.
SAMPLES = os.environ.get("SAMPLE_EXPORTS_DIR", "")


def sample(spark, columns, table):
    for path in sorted(Path(SAMPLES).rglob("*.[cC][sS][vV]")) if SAMPLES else []:
        with open(path, encoding="utf-8") as lines:
            if lines.readline().strip().lower() == columns:
                return with_lineage(raw_lines(spark, str(path)), ENTITIES[table].source, AS_OF)
    return pytest.skip("SAMPLE_EXPORTS_DIR does not hold this export")


def test_sample_exports(spark):
    from tidemart.plans.gold import product_rows

    product_lines = sample(
        spark, "prd_id,prd_key,prd_nm,prd_cost,prd_line,prd_start_dt,prd_end_dt", "product_info"
    )
    category_lines = sample(spark, "id,cat,subcat,maintenance", "category_products")
    products = silver.clean(product_lines, ENTITIES["product_info"])
    categories = silver.clean(category_lines, ENTITIES["category_products"])
    count = lambda df, column: {row[0]: row[1] for row in df.groupBy(column).count().collect()}
    assert (products.count(), categories.count()) == (397, 37)
    assert count(categories, "customer_category_maintance1") == {"Yes": 20, "No": 17}
    assert count(products, "product_line") == {
        "Road": 162, "Mountain": 112, "Other Sales": 54, "Touring": 52, "N/A": 17,
    }
    versions = products.groupBy("prod_key").count().groupBy("count").agg({"*": "count"})
    assert {row[0]: row[1] for row in versions.collect()} == {1: 218, 2: 52, 3: 25}
    totals = product_rows(products, categories).groupBy("category")
    assert {
        row.category: (row.n, row.cost)
        for row in totals.agg({"*": "count", "product_cost": "sum"})
        .toDF("category", "n", "cost")
        .collect()
    } == {
        "Components": (182, 56371),
        "Bikes": (125, 113359),
        "Clothing": (48, 1153),
        "Accessories": (35, 460),
        "N/A": (7, 200),
    }
