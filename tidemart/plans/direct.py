"""The reports straight from silver sales, without the fact rows.

The fact holds one row for every product version and every customer that a sale meets. With
``null_keys="match"`` sales without a key times products or customers without one grow with
the square of the data. The reports only add such rows up. Here each sale carries the number of fact rows it stands for
and is added up before it meets any customer, so that the work stays in proportion to the
tables. Results equal those of :mod:`tidemart.plans.reports` over the fact.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemart.operators.joins import NullKeys, fan_out, key_equality, left_join, with_real_key
from tidemart.plans.reports import (
    Measure,
    country_report,
    month_report,
    ranking_report,
    value_of,
)


def _measured(sales: DataFrame, measure: Measure) -> DataFrame:
    renamed = sales.selectExpr(
        "sls_prd_key", "sls_cust_id", "sls_order_date", "sales_price AS price",
        "sales_sls_price AS sales_amount",
    )
    return renamed.selectExpr(
        "sls_prd_key", "sls_cust_id", "sls_order_date", f"{value_of(measure)} AS value"
    )


def _by_product(sales: DataFrame, products: DataFrame, null_keys: NullKeys) -> DataFrame:
    products = with_real_key(products, "prod_key", null_keys)
    return fan_out(sales, products, "sls_prd_key", "prod_key", "unmatched")


def _buyer_totals(
    sales: DataFrame, products: DataFrame, measure: Measure, null_keys: NullKeys
) -> DataFrame:
    """Sales and fact rows per customer id, one row for the missing id."""
    return (
        _by_product(_measured(sales, measure), products, null_keys)
        .groupBy("sls_cust_id")
        .agg(F.expr("sum(value * row_weight) AS sales"), F.expr("sum(row_weight) AS orders"))
    )


def revenue_by_country(
    sales: DataFrame,
    products: DataFrame,
    customers: DataFrame,
    null_keys: NullKeys = "unmatched",
    measure: Measure = "price",
) -> DataFrame:
    """``customers`` need their id and country, no surrogate numbers. They are counted per
    id and country first: many customers without id become a few rows."""
    counted = customers.groupBy("customer_id", "country").agg(
        F.expr("count(*) AS unique_number_customer")
    )
    same_buyer = key_equality("sls_cust_id", "customer_id", null_keys)
    attributed = left_join(_buyer_totals(sales, products, measure, null_keys), counted, same_buyer)
    return country_report(
        attributed.selectExpr(
            "unique_number_customer",
            "country",
            "sales * coalesce(unique_number_customer, 1) AS sales",
        )
    )


def customer_ranking(
    sales: DataFrame,
    products: DataFrame,
    customers: DataFrame,
    top: int | None = None,
    null_keys: NullKeys = "unmatched",
    measure: Measure = "price",
) -> DataFrame:
    """``customers`` are the numbered dimension. Ids that no customer has share one row.

    Known and unknown ids go separate ways over the same shuffled totals: an inner join
    lets adaptive execution split an id that very many customers share.
    """
    totals = _buyer_totals(sales, products, measure, null_keys)
    known = customers.select("customer_id", "unique_number_customer", "country", "gender")
    same_buyer = F.expr(key_equality("sls_cust_id", "customer_id", null_keys))
    columns = ["unique_number_customer", "country", "gender", "sales", "orders"]
    of_known = totals.join(known, same_buyer, "inner").select(*columns)
    of_unknown = (
        totals.join(known.select("customer_id").distinct(), same_buyer, "left_anti")
        .selectExpr(
            "CAST(NULL AS BIGINT) AS unique_number_customer",
            "CAST(NULL AS STRING) AS country",
            "CAST(NULL AS STRING) AS gender",
            "sum(sales) AS sales",
            "sum(orders) AS orders",
        )
        .where("orders IS NOT NULL")
    )
    return ranking_report(of_known.unionByName(of_unknown), top)


def monthly_trend(
    sales: DataFrame,
    products: DataFrame,
    customers: DataFrame,
    null_keys: NullKeys = "unmatched",
    measure: Measure = "price",
) -> DataFrame:
    """``customers`` need their id only. Sales are added up per month and customer id
    before the number of customers with that id multiplies them."""
    dated = _measured(sales, measure).where("sls_order_date IS NOT NULL")
    monthly = (
        _by_product(dated, products, null_keys)
        .groupBy(F.expr("month(sls_order_date)").alias("month_num"), "sls_cust_id")
        .agg(F.expr("sum(value * row_weight) AS value"), F.expr("sum(row_weight) AS row_weight"))
    )
    counted = fan_out(monthly, customers, "sls_cust_id", "customer_id", null_keys, hot=False)
    return month_report(
        counted.groupBy("month_num").agg(
            F.expr("sum(value * copies) AS sales"),
            F.expr("sum(row_weight) AS orders"),
        )
    )


def fact_size(
    sales: DataFrame, products: DataFrame, customers: DataFrame, null_keys: NullKeys = "unmatched"
) -> DataFrame:
    """Number of fact rows, as ``rows``."""
    weighted = _by_product(sales.select("sls_prd_key", "sls_cust_id"), products, null_keys)
    per_buyer = weighted.groupBy("sls_cust_id").agg(F.expr("sum(row_weight) AS row_weight"))
    counted = fan_out(per_buyer, customers, "sls_cust_id", "customer_id", null_keys, hot=False)
    return counted.selectExpr("coalesce(sum(row_weight), 0) AS rows")


def join_summary(
    sales: DataFrame, products: DataFrame, customers: DataFrame, null_keys: NullKeys = "unmatched"
) -> DataFrame:
    """Rows entering each join of the fact, with and without a partner, and leaving it."""
    per_buyer = (
        _by_product(sales.select("sls_prd_key", "sls_cust_id"), products, null_keys)
        .groupBy("sls_cust_id")
        .agg(
            F.expr("sum(left_rows) AS sold"),
            F.expr("sum(IF(matched, left_rows, 0)) AS sold_matched"),
            F.expr("sum(row_weight) AS row_weight"),
        )
    )
    counted = fan_out(per_buyer, customers, "sls_cust_id", "customer_id", null_keys, hot=False)
    sums = counted.selectExpr(
        "coalesce(sum(sold), 0) AS sold",
        "coalesce(sum(sold_matched), 0) AS sold_matched",
        "coalesce(sum(left_rows), 0) AS bought",
        "coalesce(sum(IF(matched, left_rows, 0)), 0) AS bought_matched",
        "coalesce(sum(row_weight), 0) AS made",
    )
    return sums.selectExpr(
        """stack(2,
            'sales to product', sold, sold_matched, sold - sold_matched, bought,
            'sales to customer', bought, bought_matched, bought - bought_matched, made
        ) AS (join_name, left_rows, matched_rows, unmatched_rows, output_rows)"""
    )
