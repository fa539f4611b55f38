"""Reports over the sales fact and the customer dimension."""

from __future__ import annotations

from typing import Literal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemart.functions.dates import month_label
from tidemart.functions.numbers import cents
from tidemart.functions.text import NOT_AVAILABLE, literal, or_not_available
from tidemart.operators.joins import left_join

# The reports add up unit prices unless told to use line amounts.
Measure = Literal["price", "sales_amount"]


def value_of(measure: Measure) -> str:
    if measure not in ("price", "sales_amount"):
        raise ValueError(f"measure must be 'price' or 'sales_amount', not {measure!r}")
    return f"coalesce({measure}, 0D)"


def _number_text(number: str) -> str:
    return f"coalesce(CAST({number} AS STRING), {literal(NOT_AVAILABLE)})"


def _of_customer(name: str) -> str:
    return or_not_available(name, "unique_number_customer IS NOT NULL")


def _with_customer(facts: DataFrame, customers: DataFrame, *columns: str) -> DataFrame:
    """Attach customer columns by surrogate number. Facts without one meet nobody."""
    dimension = customers.select("unique_number_customer", *columns)
    return left_join(facts, dimension, "customer_unique_num = unique_number_customer")


def sales_with_customer(fact: DataFrame, customers: DataFrame) -> DataFrame:
    """One row per fact row with the profile of its customer; ``'N/A'`` without customer."""
    return _with_customer(fact, customers, "customer_name", "gender", "age", "country").selectExpr(
        f"{_number_text('customer_unique_num')} AS customer_unique_NUM",
        f"{_of_customer('customer_name')} AS customer_name",
        f"{_of_customer('gender')} AS customer_gender",
        f"{_of_customer('age')} AS customer_age",
        f"{_of_customer('country')} AS customer_country",
        "price AS sales_price",
    )


def per_customer(fact: DataFrame, measure: Measure) -> DataFrame:
    """Sales and row count per surrogate number: combined map-side, and small enough that
    the customer join that follows moves one row per customer instead of every fact."""
    return fact.groupBy("customer_unique_num").agg(
        F.expr(f"sum({value_of(measure)}) AS sales"), F.expr("count(*) AS orders")
    )


def country_report(totals: DataFrame) -> DataFrame:
    """Totals with ``unique_number_customer`` and ``country`` to sales per country."""
    return totals.groupBy(F.expr(_of_customer("country")).alias("customer_country")).agg(
        F.expr("sum(sales) AS revenue")
    )


def month_report(totals: DataFrame) -> DataFrame:
    """Totals per ``month_num`` to the monthly trend."""
    return totals.selectExpr(
        f"{month_label('month_num')} AS month",
        f"{cents('sales')} AS total_sales",
        "orders AS total_orders",
        "month_num",
    ).orderBy("month_num")


def ranking_report(totals: DataFrame, top: int | None) -> DataFrame:
    """One row of totals per ``unique_number_customer`` to the ranking of customers."""
    ranked = totals.selectExpr(
        "unique_number_customer",
        f"{_number_text('unique_number_customer')} AS customer_id",
        f"{_of_customer('country')} AS country",
        f"{_of_customer('gender')} AS gender",
        f"{cents('sales')} AS Total_sales",
        "orders AS Total_orders",
        f"{cents('sales / orders')} AS avg_order_value",
    ).orderBy(F.desc("Total_sales"), F.asc_nulls_last("unique_number_customer"))
    if top is not None:
        ranked = ranked.limit(top)
    return ranked.drop("unique_number_customer")


def country_of_totals(totals: DataFrame, customers: DataFrame) -> DataFrame:
    """``sales`` per ``customer_unique_num`` to sales per country."""
    return country_report(_with_customer(totals, customers, "country"))


def ranking_of_totals(totals: DataFrame, customers: DataFrame, top: int | None) -> DataFrame:
    """``sales`` and ``orders`` per ``customer_unique_num`` to the ranking of customers."""
    return ranking_report(totals_with_customer(totals, customers), top)


def totals_with_customer(totals: DataFrame, customers: DataFrame) -> DataFrame:
    return _with_customer(totals, customers, "country", "gender")


def revenue_by_country(
    fact: DataFrame, customers: DataFrame, measure: Measure = "price"
) -> DataFrame:
    """Sales per country. NULL (no location), ``'Unknown'`` (location without a listed
    country) and ``'N/A'`` (no customer) stay three groups."""
    return country_of_totals(per_customer(fact, measure), customers)


def monthly_trend(fact: DataFrame, measure: Measure = "price") -> DataFrame:
    """Sales and fact rows per calendar month, years merged, in calendar order.

    Rows without an order date are left out; see :func:`undated_rows`.
    """
    dated = fact.where("order_date IS NOT NULL")
    return month_report(
        dated.groupBy(F.expr("month(order_date)").alias("month_num")).agg(
            F.expr(f"sum({value_of(measure)}) AS sales"), F.expr("count(*) AS orders")
        )
    )


def undated_rows(fact: DataFrame) -> DataFrame:
    """How many fact rows the monthly trend leaves out."""
    return fact.selectExpr("count_if(order_date IS NULL) AS undated_rows")


def customer_ranking(
    fact: DataFrame,
    customers: DataFrame,
    top: int | None = None,
    measure: Measure = "price",
) -> DataFrame:
    """Customers by total sales, highest first, or only the ``top`` ones of them.

    ``customer_id`` is the surrogate number; sales without customer share one row. Equal
    totals are ranked by surrogate number.
    """
    return ranking_of_totals(per_customer(fact, measure), customers, top)
