"""The sales fact without its pairs: each sale once, with the number of partners it has.

Where missing keys meet each other, as in the source system, sales without a key times products
or customers without one grow with the square of the data. A sale's partners depend on its
keys alone, so they are not written out: a sale names its two classes, and a class's members are
the dimension rows with that key. Sums and counts come from the links; rows are made on demand.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemart.operators.joins import NullKeys, fan_out, key_equality, left_join, with_real_key
from tidemart.plans import reports

LINKS = """order_number string, product_class string, customer_class bigint, order_date date,
    order_shipping_date date, sales_amount double, sales_quantity double, price double,
    product_links bigint, customer_links bigint"""

# A sale without a partner is one row of the fact.
_PRODUCTS, _CUSTOMERS = "greatest(product_links, 1)", "greatest(customer_links, 1)"


def fact_links(
    sales: DataFrame, products: DataFrame, customers: DataFrame, null_keys: NullKeys = "match"
) -> DataFrame:
    """One row per sale (:data:`LINKS`): its class keys and how many partners each class has."""
    ordered = sales.where("sls_ord_num IS NOT NULL")
    real = with_real_key(products, "prod_key", null_keys)
    linked = fan_out(ordered, real, "sls_prd_key", "prod_key", "unmatched")
    linked = linked.withColumn("product_links", F.expr("IF(matched, copies, 0L)"))
    linked = linked.drop("matched", "copies", "left_rows", "row_weight")
    linked = fan_out(linked, customers, "sls_cust_id", "customer_id", null_keys)
    return linked.selectExpr(
        "sls_ord_num AS order_number",
        "sls_prd_key AS product_class",
        "sls_cust_id AS customer_class",
        "sls_order_date AS order_date",
        "sls_due_date AS order_shipping_date",
        "sales_sls_price AS sales_amount",
        "sales_quantity",
        "sales_price AS price",
        "product_links",
        "IF(matched, copies, 0L) AS customer_links",
    )


@dataclass(frozen=True)
class FactorisedFact:
    """``links`` (see :func:`fact_links`) with the numbered dimensions it was made from."""

    links: DataFrame
    products: DataFrame
    customers: DataFrame
    null_keys: NullKeys = "match"

    def _product_members(self) -> DataFrame:
        real = with_real_key(self.products, "prod_key", self.null_keys)
        return real.selectExpr("prod_key", "unique_number AS product_unique_num")

    def _customer_members(self) -> DataFrame:
        return self.customers.selectExpr("customer_id", "unique_number_customer AS customer_unique_num")

    def rows(self) -> DataFrame:
        """The fact itself; as many rows as :meth:`size` says."""
        with_product = left_join(self.links, self._product_members(), "product_class = prod_key")
        same = key_equality("customer_class", "customer_id", self.null_keys)
        return left_join(with_product, self._customer_members(), same).select(
            "order_number", "customer_unique_num", "product_unique_num", "order_date",
            "order_shipping_date", "sales_amount", "sales_quantity", "price",
        )

    def size(self) -> DataFrame:
        """Number of fact rows, as ``rows``."""
        return self.links.selectExpr(f"coalesce(sum({_PRODUCTS} * {_CUSTOMERS}), 0) AS rows")

    @staticmethod
    def _sums(weight: str) -> list:
        return [
            F.expr(f"sum({weight}) AS fact_rows"),
            F.expr(f"sum(coalesce(price, 0D) * {weight}) AS price"),
            F.expr(f"sum(coalesce(sales_amount, 0D) * {weight}) AS sales_amount"),
            F.expr(f"sum(coalesce(sales_quantity, 0D) * {weight}) AS sales_quantity"),
        ]

    @staticmethod
    def _merged(rows: DataFrame, number: str) -> DataFrame:
        """Classes without a member share the row of no number."""
        sums = [F.sum(name).alias(name) for name in ("fact_rows", "price", "sales_amount", "sales_quantity")]
        return rows.groupBy(number).agg(*sums)

    def by_customer(self) -> DataFrame:
        """``customer_unique_num``, ``fact_rows`` and summed measures. Sales are added up per class
        first; then every member of a class has the class's sums."""
        classes = self.links.groupBy("customer_class").agg(*self._sums(_PRODUCTS))
        same = key_equality("customer_class", "customer_id", self.null_keys)
        members = left_join(classes, self._customer_members(), same)
        return self._merged(members, "customer_unique_num")

    def by_product(self) -> DataFrame:
        """``product_unique_num``, ``fact_rows`` and summed measures."""
        classes = self.links.groupBy("product_class").agg(*self._sums(_CUSTOMERS))
        members = left_join(classes, self._product_members(), "product_class = prod_key")
        return self._merged(members, "product_unique_num")

    def _per_customer(self, measure: reports.Measure) -> DataFrame:
        reports.value_of(measure)  # checks the name
        return self.by_customer().selectExpr("customer_unique_num", f"{measure} AS sales", "fact_rows AS orders")

    def revenue_by_country(self, measure: reports.Measure = "price") -> DataFrame:
        return reports.country_of_totals(self._per_customer(measure), self.customers)

    def customer_ranking(self, top: int | None = None, measure: reports.Measure = "price") -> DataFrame:
        return reports.ranking_of_totals(self._per_customer(measure), self.customers, top)

    def monthly_trend(self, measure: reports.Measure = "price") -> DataFrame:
        weight = f"{_PRODUCTS} * {_CUSTOMERS}"
        dated = self.links.where("order_date IS NOT NULL")
        return reports.month_report(
            dated.groupBy(F.expr("month(order_date)").alias("month_num")).agg(
                F.expr(f"sum({reports.value_of(measure)} * {weight}) AS sales"),
                F.expr(f"sum({weight}) AS orders"),
            )
        )
