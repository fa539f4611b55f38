from __future__ import annotations

import collections
import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from helpers import plan_of, rows
from tidemart.plans import direct, gold, reports
from tidemart.sources.schemas import LAYERS
from tidemart.sources.staging import Staging

DAY = dt.date.fromisoformat


def table(spark, layer, name, *values):
    return spark.createDataFrame(list(values), LAYERS[layer][name])


def test_customer_rows(spark):
    customers = table(
        spark, "silver", "customer_info",
        (1, "AW1", "A", "Single", None, None),
        (2, "AW2", "B", None, "Male", None),
        (3, "AW3", None, None, None, None),
    )
    births = table(
        spark, "silver", "customer_birth",
        ("AW1", DAY("1990-01-01"), "Female", 36),
        ("AW2", None, "Female", None),
        ("AW2", None, None, None),
        ("AW9", None, None, None),
    )
    locations = table(
        spark, "silver", "customer_location", ("AW1", "France"), ("AW2", None), ("AW8", "Canada")
    )
    got = rows(gold.customer_rows(customers, births, locations))
    assert got == sorted(
        [
            ("AW1", 1, "A", "Single", "Female", None, DAY("1990-01-01"), 36, "France"),
            ("AW2", 2, "B", None, "Male", None, None, None, "Unknown"),
            ("AW2", 2, "B", None, "Male", None, None, None, "Unknown"),
            ("AW3", 3, None, None, None, None, None, None, None),
        ],
        key=repr,
    )


def test_product_rows_keep_matched_nulls(spark):
    products = table(
        spark, "silver", "product_info",
        ("210", "AC_BR", "K1", "n", 1.0, "Road", None),
        ("211", "AC_XX", "K2", "n", 1.0, "Road", None),
    )
    categories = table(spark, "silver", "category_products", ("AC_BR", None, "Racks", None))
    got = rows(gold.product_rows(products, categories).select("category", "sub_category", "maintance"))
    assert got == [("N/A", "N/A", "N/A"), (None, "Racks", None)]


def star(spark):
    products = table(
        spark, "gold", "gold_dim_product",
        *[("1", key, "n", "c", "a", "b", "Yes", 1.0, "Road", None, n)
          for n, key in enumerate(["K1", "K1", "K2", "N/A"], 1)],
    )
    customers = table(
        spark, "gold", "gold_dim_customer",
        ("AW1", 10001, "Ann", None, "Female", None, None, 30, "France", 1),
        ("AW2", None, "Bob", None, None, None, None, None, None, 2),
        ("AW3", None, None, None, "Male", None, None, None, "Unknown", 3),
    )
    sales = table(
        spark, "silver", "sales_details",
        ("SO00001", "K1", 10001, DAY("2011-01-05"), None, None, 10.0, 1.0, 10.0),
        ("SO00002", "K2", None, DAY("2012-01-09"), None, None, 40.0, 2.0, 20.0),
        ("SO00003", "N/A", 10009, None, "missing", None, 5.0, 1.0, 5.0),
        ("SO00004", "K9", 10001, DAY("2012-03-01"), None, None, 7.0, 1.0, 7.0),
    )
    return sales, products, customers


def test_fact_matches_null_ids(spark):
    fact = gold.fact_sales(*star(spark), null_keys="match").select(
        "order_number", "product_unique_num", "customer_unique_num"
    )
    assert rows(fact) == [
        ("SO00001", 1, 1),
        ("SO00001", 2, 1),
        ("SO00002", 3, 2),
        ("SO00002", 3, 3),
        ("SO00003", 4, None),
        ("SO00004", None, 1),
    ]


def test_fact_can_leave_null_ids_alone(spark):
    fact = gold.fact_sales(*star(spark), null_keys="unmatched")
    assert [row.customer_unique_num for row in fact.where("order_number = 'SO00002'").collect()] == [None]
    with pytest.raises(ValueError, match="null_keys"):
        gold.fact_sales(*star(spark), null_keys="perhaps")


def test_reports(spark):
    sales, products, customers = star(spark)
    fact = gold.fact_sales(sales, products, customers, "match")
    assert rows(reports.revenue_by_country(fact, customers)) == sorted(
        [("France", 27.0), (None, 20.0), ("Unknown", 20.0), ("N/A", 5.0)], key=repr
    )
    assert rows(reports.revenue_by_country(fact, customers, "sales_amount"))[1] == ("N/A", 5.0)
    assert [tuple(row) for row in reports.monthly_trend(fact).collect()] == [
        ("January", 60.0, 4, 1),
        ("March", 7.0, 1, 3),
    ]
    assert reports.undated_rows(fact).first()[0] == 1
    ranking = [tuple(row) for row in reports.customer_ranking(fact, customers).collect()]
    assert ranking == [
        ("1", "France", "Female", 27.0, 3, 9.0),
        ("2", None, None, 20.0, 1, 20.0),
        ("3", "Unknown", "Male", 20.0, 1, 20.0),
        ("N/A", "N/A", "N/A", 5.0, 1, 5.0),
    ]
    top = reports.customer_ranking(fact, customers, top=2)
    assert [tuple(row) for row in top.collect()] == ranking[:2]
    assert rows(reports.sales_with_customer(fact, customers)) == sorted(
        [
            ("1", "Ann", "Female", "30", "France", 10.0),
            ("1", "Ann", "Female", "30", "France", 10.0),
            ("1", "Ann", "Female", "30", "France", 7.0),
            ("2", "Bob", None, None, None, 20.0),
            ("3", None, "Male", None, "Unknown", 20.0),
            ("N/A", "N/A", "N/A", "N/A", "N/A", 5.0),
        ],
        key=repr,
    )
    with pytest.raises(ValueError, match="measure"):
        reports.monthly_trend(fact, "quantity")


@pytest.mark.parametrize("null_keys", ["match", "unmatched"])
@pytest.mark.parametrize("measure", ["price", "sales_amount"])
def test_direct_reports_equal_those_of_the_fact(spark, null_keys, measure):
    random.seed(11)
    some = lambda *values: random.choice(values)
    sales = table(
        spark, "silver", "sales_details",
        *[(f"SO{n:05}", some("K1", "K2", "K3", "N/A"), some(1, 2, 3, None),
           some(None, DAY("2011-01-05"), DAY("2012-01-05"), DAY("2012-07-05")), None, None,
           float(n), 1.0, some(float(n % 7), None)) for n in range(300)],
    )
    products = table(
        spark, "gold", "gold_dim_product",
        *[("1", some("K1", "K2", "N/A"), "n", "c", "a", "b", "Yes", 1.0, "Road", None, n)
          for n in range(1, 9)],
    )
    customers = table(
        spark, "gold", "gold_dim_customer",
        *[("AW1", some(1, 2, None, 9), "Ann", None, some("Male", None), None, None, 30,
           some("France", "Unknown", None), n) for n in range(1, 9)],
    )
    fact = gold.fact_sales(sales, products, customers, null_keys)
    inputs = (sales, products, customers)
    assert direct.fact_size(*inputs, null_keys).first().rows == fact.count()
    assert rows(direct.revenue_by_country(*inputs, null_keys, measure)) == rows(
        reports.revenue_by_country(fact, customers, measure)
    )
    assert (
        direct.monthly_trend(*inputs, null_keys, measure).collect()
        == reports.monthly_trend(fact, measure).collect()
    )
    assert (
        direct.customer_ranking(*inputs, None, null_keys, measure).collect()
        == reports.customer_ranking(fact, customers, None, measure).collect()
    )
    assert (
        direct.customer_ranking(*inputs, 3, null_keys, measure).collect()
        == reports.customer_ranking(fact, customers, 3, measure).collect()
    )


def test_totals_agree(spark):
    sales, products, customers = star(spark)
    fact = gold.fact_sales(sales, products, customers)
    by_country = sum(row.revenue for row in reports.revenue_by_country(fact, customers).collect())
    by_month = sum(row.total_sales for row in reports.monthly_trend(fact).collect())
    undated = fact.where("order_date IS NULL").selectExpr("sum(price)").first()[0]
    assert by_country == by_month + undated


def test_join_summary_counts_what_the_joins_make(spark):
    sales, products, customers = star(spark)
    assert rows(direct.join_summary(sales, products, customers, "match")) == [
        ("sales to customer", 5, 4, 1, 6),
        ("sales to product", 4, 3, 1, 5),
    ]
    assert gold.fact_sales(sales, products, customers, "match").count() == 6
    assert rows(direct.join_summary(sales, products, customers, "unmatched")) == [
        ("sales to customer", 5, 3, 2, 5),
        ("sales to product", 4, 2, 2, 5),
    ]
    assert rows(direct.join_summary(sales.limit(0), products, customers))[0][1:] == (0, 0, 0, 0)


def test_dimensions_number_every_row(spark):
    silver = {
        "customer_info": table(spark, "silver", "customer_info", *[(n, f"AW{n:08}", None, None, None, None) for n in (3, 1, 2)]),
        "customer_birth": table(spark, "silver", "customer_birth"),
        "customer_location": table(spark, "silver", "customer_location"),
        "product_info": table(spark, "silver", "product_info", ("2", "c", "K", "n", 1.0, "Road", None), ("1", "c", "K", "n", 1.0, "Road", None)),
        "category_products": table(spark, "silver", "category_products"),
    }
    customers, products = gold.dimensions(silver, Staging(spark))
    assert rows(customers.select("customer_id", "unique_number_customer")) == [(1, 1), (2, 2), (3, 3)]
    assert rows(products.select("product_id", "unique_number")) == [("1", 1), ("2", 2)]
    assert rows(gold.table_counts({"a": customers, "b": products})) == [("a", 3), ("b", 2)]


@pytest.fixture
def shuffled_joins(spark):
    """Joins as on large data: no broadcast, and hot partitions split from a few kB on."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20000",
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "20000",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "30000",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield
    for key in settings:
        spark.conf.unset(key)


def test_hot_product_and_hot_customer_are_split(spark, tmp_path, shuffled_joins):
    """One product, one customer and the missing id each hold a third of all sales."""
    random.seed(3)
    sales = spark.range(60_000, numPartitions=12).selectExpr(
        "concat('SO', lpad(id, 5, '0')) AS sls_ord_num",
        "IF(id % 3 = 0, 'K0', concat('K', id % 400)) AS sls_prd_key",
        "CASE id % 3 WHEN 1 THEN NULL WHEN 2 THEN 10007 ELSE 10000 + id % 900 END AS sls_cust_id",
        "DATE '2011-01-05' AS sls_order_date",
        "CAST(NULL AS STRING) AS order_date_issue",
        "CAST(NULL AS DATE) AS sls_due_date",
        "1D AS sales_sls_price",
        "1D AS sales_quantity",
        "CAST(id % 10 AS DOUBLE) AS sales_price",
    )
    products = spark.range(400).selectExpr("concat('K', id) AS prod_key", "id + 1 AS unique_number")
    customers = spark.range(700).selectExpr(
        "IF(id < 2, NULL, id + 10000) AS customer_id",
        "id + 1 AS unique_number_customer",
        "concat('C', id % 9) AS country",
        "'x' AS gender",
    )
    fact = gold.fact_sales(sales, products, customers, "match")
    path = str(tmp_path / "fact")
    fact.write.parquet(path)
    fact.collect()
    plan = plan_of(fact)
    assert "skew=true" in plan
    assert "BroadcastNestedLoopJoin" not in plan and "CartesianProduct" not in plan

    # Brute force over plain Python values.
    numbers = collections.defaultdict(list)
    for row in customers.collect():
        numbers[row.customer_id].append(row.unique_number_customer)
    wanted = collections.Counter()
    for row in sales.select("sls_prd_key", "sls_cust_id", "sales_price").collect():
        for customer in numbers.get(row.sls_cust_id, [None]):
            wanted[(int(row.sls_prd_key[1:]) + 1, customer, row.sales_price)] += 1
    got = collections.Counter(
        (row.product_unique_num, row.customer_unique_num, row.price)
        for row in spark.read.parquet(path).collect()
    )
    assert got == wanted

    direct_report = direct.revenue_by_country(sales, products, customers, "match")
    direct_rows = rows(direct_report)
    assert "skew=true" in plan_of(direct_report)
    ranking = direct.customer_ranking(sales, products, customers, None, "match")
    ranking_rows = ranking.collect()
    assert "skew=true" in plan_of(ranking) and "ReusedExchange" in plan_of(ranking)
    assert ranking_rows == reports.customer_ranking(spark.read.parquet(path), customers).collect()

    report = reports.revenue_by_country(spark.read.parquet(path), customers)
    assert rows(report) == direct_rows
    country = {row.unique_number_customer: row.country for row in customers.collect()}
    totals = collections.Counter()
    for (_, customer, price), n in wanted.items():
        totals[country.get(customer, "N/A")] += n * price
    assert {row.customer_country: row.revenue for row in report.collect()} == dict(totals)


def test_hot_customer_key_is_split(spark, shuffled_joins):
    """Both joins of the customer dimension split, whatever comes after them."""
    customers = spark.range(40_000, numPartitions=12).selectExpr(
        "id AS customer_id_cleaned",
        "IF(id % 3 = 0, 'AW0', concat('AW', id)) AS customer_key_cleaned",
        "concat('name of ', id) AS customer_name_cleaned",
        "'Single' AS customer_martial_cleaned",
        "CAST(NULL AS STRING) AS customer_gender_cleaned",
        "DATE '2020-01-01' AS customer_date",
    )
    births = spark.range(0, 40_000, 2).selectExpr(
        "concat('AW', id) AS customer_key", "DATE '1990-01-01' AS birth_date",
        "'Male' AS gender", "36 AS age",
    )
    locations = spark.range(0, 40_000, 5).selectExpr(
        "concat('AW', id) AS customer_location_key", "'France' AS customer_location_state"
    )
    df = gold.customer_rows(customers, births, locations)
    got = df.collect()
    assert plan_of(df).count("skew=true") >= 1
    grouped = df.groupBy("country").agg(F.max("customer_name"), F.max("customer_id"))
    grouped.collect()
    assert plan_of(grouped).count("skew=true") >= 1
    wanted = collections.Counter()
    for number in range(40_000):
        key = 0 if number % 3 == 0 else number
        wanted[(number, key % 2 == 0, key % 5 == 0)] += 1
    assert wanted == collections.Counter(
        (row.customer_id, row.age is not None, row.country is not None) for row in got
    )


def test_missing_keys_meet_nothing_by_default(spark):
    sales = table(
        spark, "silver", "sales_details",
        *[(f"SO{n:05d}", "N/A", None, None, None, None, 1.0, 1.0, 1.0) for n in range(50)],
    )
    products = table(
        spark, "gold", "gold_dim_product",
        *[("1", "N/A", "n", "c", "a", "b", "Yes", 1.0, "Road", None, n) for n in range(1, 9)],
    )
    customers = table(
        spark, "gold", "gold_dim_customer",
        *[("AW1", None, "Ann", None, None, None, None, 30, "France", n) for n in range(1, 9)],
    )
    fact = gold.fact_sales(sales, products, customers)
    assert fact.count() == direct.fact_size(sales, products, customers).first().rows == 50
    assert fact.where("product_unique_num IS NULL AND customer_unique_num IS NULL").count() == 50
    assert gold.fact_sales(sales, products, customers, "match").count() == 50 * 8 * 8


def test_report_plans(spark, tmp_path):
    sales, products, customers = star(spark)
    fact_path, customer_path = str(tmp_path / "fact"), str(tmp_path / "customer")
    gold.fact_sales(sales, products, customers).write.parquet(fact_path)
    customers.write.parquet(customer_path)
    fact, customers = spark.read.parquet(fact_path), spark.read.parquet(customer_path)

    country = plan_of(reports.revenue_by_country(fact, customers))
    assert "ReadSchema: struct<customer_unique_num:bigint,price:double>" in country
    assert "ReadSchema: struct<country:string,unique_number_customer:bigint>" in country
    # The fact is combined before it meets the dimension.
    assert country.index("Join") < country.index("partial_sum(coalesce(price")

    monthly = plan_of(reports.monthly_trend(fact))
    assert "PushedFilters: [IsNotNull(order_date)]" in monthly
    assert "partial_sum" in monthly

    top = plan_of(reports.customer_ranking(fact, customers, top=5))
    assert "TakeOrderedAndProject(limit=5" in top
