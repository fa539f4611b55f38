"""Gold layer: customer and product dimensions and the sales fact."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame

from tidemart.functions.customers import country_of_location, preferred_gender
from tidemart.functions.text import or_not_available
from tidemart.operators.dense_index import dense_index, extend_index
from tidemart.operators.joins import NullKeys, key_equality, left_join, with_real_key
from tidemart.operators.side_by_side import side_by_side
from tidemart.sources.staging import Staging


def customer_rows(customers: DataFrame, births: DataFrame, locations: DataFrame) -> DataFrame:
    """Customers with birth and location attached. Copies on any side multiply.

    The keys are never NULL, so the second equality means the same as the first. It is
    partitioned by other expressions: each join has a shuffle of its own, in which adaptive
    execution can split a hot key.
    """
    with_birth = left_join(customers, _born(births), "customer_key_cleaned = birth_key")
    located = left_join(with_birth, locations, "customer_key_cleaned <=> customer_location_key")
    return _customer_columns(located)


def bucket_rows(customers: DataFrame, births: DataFrame, locations: DataFrame) -> DataFrame:
    """The same from tables that are stored by their keys and hold no hot one: both joins are
    on the keys as they are, so neither needs a shuffle."""
    with_birth = left_join(customers, _born(births), "customer_key_cleaned = birth_key")
    located = left_join(with_birth, locations, "customer_key_cleaned = customer_location_key")
    return _customer_columns(located)


def _born(births: DataFrame) -> DataFrame:
    return births.selectExpr(
        "customer_key AS birth_key", "birth_date", "gender AS birth_gender", "age"
    )


def _customer_columns(located: DataFrame) -> DataFrame:
    return located.selectExpr(
        "customer_key_cleaned AS customer_key",
        "customer_id_cleaned AS customer_id",
        "customer_name_cleaned AS customer_name",
        "customer_martial_cleaned AS marital_status",
        f"{preferred_gender('customer_gender_cleaned', 'birth_gender')} AS gender",
        "customer_date AS customer_since",
        "birth_date",
        "age",
        f"{country_of_location('customer_location_key', 'customer_location_state')} AS country",
    )


def product_rows(products: DataFrame, categories: DataFrame) -> DataFrame:
    """Every version of every product with its category attached."""
    matched = "customer_product_key1 IS NOT NULL"
    return left_join(products, categories, "cat_id = customer_product_key1").selectExpr(
        "product_id",
        "prod_key",
        "product_nm",
        "cat_id AS product_key",
        f"{or_not_available('customer_category1', matched)} AS category",
        f"{or_not_available('customer_sub_category1', matched)} AS sub_category",
        f"{or_not_available('customer_category_maintance1', matched)} AS maintance",
        "product_cost",
        "product_line",
        "product_start_date",
    )


def dim_customer(
    customers: DataFrame,
    births: DataFrame,
    locations: DataFrame,
    staging: Staging,
    last: DataFrame | None = None,
) -> DataFrame:
    """Numbered customers. Those that ``last``, the dimension of the load before, knows by key
    keep their numbers; without it numbers follow the order of the keys."""
    rows = customer_rows(customers, births, locations)
    if last is None:
        return dense_index(rows, ["customer_key"], "unique_number_customer", staging)
    return extend_index(rows, last, ["customer_key"], [], "unique_number_customer", staging)


def dim_product(
    products: DataFrame, categories: DataFrame, staging: Staging, last: DataFrame | None = None
) -> DataFrame:
    """Numbered product versions. Those that ``last`` knows by key, start and id keep their
    numbers."""
    rows = product_rows(products, categories)
    order = ["prod_key", "product_start_date", "product_id"]
    if last is None:
        return dense_index(rows, order, "unique_number", staging)
    return extend_index(rows, last, order, [], "unique_number", staging)


Dimensions = tuple[DataFrame, DataFrame]


def dimensions(
    silver: Mapping[str, DataFrame], staging: Staging, last: Dimensions | None = None
) -> Dimensions:
    """Customer and product dimension of the silver tables, built side by side; ``last`` are
    those of the load before, whose numbers are kept."""
    last_customers, last_products = last or (None, None)

    def customers() -> DataFrame:
        return dim_customer(
            silver["customer_info"],
            silver["customer_birth"],
            silver["customer_location"],
            staging,
            last_customers,
        )

    def products() -> DataFrame:
        tables = silver["product_info"], silver["category_products"]
        return dim_product(*tables, staging, last_products)

    customer, product = side_by_side(staging.spark, lambda build: build(), [customers, products])
    return customer, product


def fact_sales(
    sales: DataFrame, products: DataFrame, customers: DataFrame, null_keys: NullKeys = "unmatched"
) -> DataFrame:
    """Sales with the surrogate numbers of their product and customer.

    A sale meets every version of its product. A sale whose product key is not available, or
    whose customer id is missing, has no partner. With ``null_keys="match"`` it meets every
    product or customer that lacks the key as well, as many pairs as the product of both.
    A NULL surrogate means no partner. The due date is published as ``order_shipping_date``.
    """
    product = with_real_key(products, "prod_key", null_keys).selectExpr(
        "prod_key", "unique_number AS product_unique_num"
    )
    customer = customers.selectExpr(
        "customer_id", "unique_number_customer AS customer_unique_num"
    )
    ordered = sales.where("sls_ord_num IS NOT NULL")
    with_product = left_join(ordered, product, "sls_prd_key = prod_key")
    same_buyer = key_equality("sls_cust_id", "customer_id", null_keys)
    return left_join(with_product, customer, same_buyer).selectExpr(
        "sls_ord_num AS order_number",
        "customer_unique_num",
        "product_unique_num",
        "sls_order_date AS order_date",
        "sls_due_date AS order_shipping_date",
        "sales_sls_price AS sales_amount",
        "sales_quantity",
        "sales_price AS price",
    )


def table_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows per table."""
    counts = [
        table.selectExpr(f"'{name}' AS table_name", "count(*) AS rows")
        for name, table in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)
