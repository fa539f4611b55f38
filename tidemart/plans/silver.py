"""Silver layer: bronze lines to typed, standardised tables and quality counts."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field
from functools import partial, reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemart.functions import catalog, customers, dates, numbers, sales
from tidemart.functions.text import PLAIN_LINE, fields_of, filled, has_fields, matches, trimmed
from tidemart.operators.quality import count_invalid
from tidemart.sources.schemas import columns_of


@dataclass(frozen=True)
class Entity:
    """How one bronze source becomes one silver table.

    ``positions`` places the raw fields (0-based) and ``arity`` is the least number of
    fields of a usable line; both can be swapped with ``dataclasses.replace`` for exports
    laid out in another order. ``keep`` and ``rules`` are SQL conditions over raw fields
    and cleaned columns; ``rules`` count rows before ``keep`` drops any.
    """

    table: str
    source: str
    arity: int
    positions: Mapping[str, int]
    clean: Callable[[DataFrame, str], DataFrame]
    keep: str
    rules: Mapping[str, str] = field(default_factory=dict)


def split_fields(bronze: DataFrame, entity: Entity) -> DataFrame:
    """Trimmed raw fields of the lines that have enough of them.

    Every comma separates; there is no quoting. Further fields are ignored. ``stack``
    makes one row of one row, and keeps later filters from being pushed below the split:
    they would split every line again for each condition.
    """
    parts = bronze.where("rawdata IS NOT NULL").selectExpr(
        f"stack(1, {fields_of('rawdata')}, {matches('rawdata', PLAIN_LINE)}) AS (parts, plain)"
    )
    return parts.where(has_fields('parts', entity.arity)).selectExpr(
        *[
            f"{trimmed(f'get(parts, {position})', 'plain')} AS {name}"
            for name, position in entity.positions.items()
        ]
    )


def assess(bronze: DataFrame, entity: Entity, as_of: dt.date | None = None) -> DataFrame:
    """Raw fields and cleaned columns of every usable line, before any key filter."""
    day = "current_date()" if as_of is None else f"DATE '{as_of.isoformat()}'"
    return entity.clean(split_fields(bronze, entity), day)


def keep_valid(assessed: DataFrame, entity: Entity) -> DataFrame:
    """The silver table: cleaned columns of the rows with a valid key."""
    return assessed.where(entity.keep).select(*columns_of("silver", entity.table))


def clean(bronze: DataFrame, entity: Entity, as_of: dt.date | None = None) -> DataFrame:
    return keep_valid(assess(bronze, entity, as_of), entity)


def quality(
    bronze: Mapping[str, DataFrame], entities: Mapping[str, Entity], as_of: dt.date | None = None
) -> DataFrame:
    """Exact counts of every rule of every entity, one aggregate per entity."""
    counts = [
        count_invalid(assess(bronze[entity.source], entity, as_of), entity.table, entity.rules)
        for entity in entities.values()
    ]
    return reduce(DataFrame.unionByName, counts)


def arity_summary(
    bronze: Mapping[str, DataFrame], entities: Mapping[str, Entity]
) -> DataFrame:
    """Lines per entity, and how many have enough fields."""
    counts = [
        bronze[entity.source].agg(
            F.lit(entity.table).alias("entity"),
            F.count("*").alias("raw_rows"),
            F.count_if(F.expr(has_fields(fields_of("rawdata"), entity.arity))).alias("usable_rows"),
        )
        for entity in entities.values()
    ]
    return reduce(DataFrame.unionByName, counts)


def _customer(fields: DataFrame, as_of: str, digits: int) -> DataFrame:
    return fields.selectExpr(
        "*",
        f"{numbers.digits_only('raw_id')} AS customer_id_cleaned",
        f"{customers.customer_key('raw_key', digits)} AS customer_key_cleaned",
        f"{customers.full_name('raw_first', 'raw_last')} AS customer_name_cleaned",
        f"{customers.marital_status('raw_marital')} AS customer_martial_cleaned",
        f"{customers.gender_of_letter('raw_gender')} AS customer_gender_cleaned",
        f"{dates.dashed_date('raw_created')} AS customer_date",
    )


def _birth(fields: DataFrame, as_of: str, digits: int) -> DataFrame:
    return fields.selectExpr(
        "*",
        f"{customers.customer_key_of_birth('raw_key', digits)} AS customer_key",
        f"{dates.dashed_date('raw_birth')} AS birth_date",
        f"{customers.gender_of_word('raw_gender')} AS gender",
    ).selectExpr("*", f"{dates.completed_years('birth_date', as_of)} AS age")


def _location(fields: DataFrame, as_of: str, digits: int) -> DataFrame:
    return fields.selectExpr(
        "*",
        f"{customers.customer_key_of_location('raw_key', digits)} AS customer_location_key",
        f"{customers.country_name('raw_country')} AS customer_location_state",
    )


def _category(fields: DataFrame, as_of: str) -> DataFrame:
    return fields.selectExpr(
        "*",
        f"{catalog.category_key('raw_key')} AS customer_product_key1",
        f"{filled('raw_category')} AS customer_category1",
        f"{filled('raw_sub_category')} AS customer_sub_category1",
        f"{catalog.maintenance_flag('raw_flag')} AS customer_category_maintance1",
    )


def _product(fields: DataFrame, as_of: str) -> DataFrame:
    return fields.selectExpr(
        "*",
        f"{catalog.product_id('raw_id')} AS product_id",
        f"{catalog.category_of_composite('raw_composite')} AS cat_id",
        f"{catalog.product_key_of_composite('raw_composite')} AS prod_key",
        f"{catalog.product_name('raw_name')} AS product_nm",
        f"{numbers.number('raw_cost')} AS given_cost",
        f"{catalog.product_cost('raw_cost')} AS product_cost",
        f"{catalog.product_line('raw_line')} AS product_line",
        f"{dates.dashed_date('raw_start')} AS product_start_date",
    )


def _sale(fields: DataFrame, as_of: str, order_length: int, id_length: int) -> DataFrame:
    typed = fields.selectExpr(
        "*",
        f"{sales.order_number('raw_order', order_length)} AS sls_ord_num",
        f"{sales.sold_product_key('raw_product')} AS sls_prd_key",
        f"{sales.buyer_id('raw_customer', id_length)} AS sls_cust_id",
        f"{dates.compact_date('raw_ordered')} AS sls_order_date",
        f"{dates.compact_date('raw_due')} AS sls_due_date",
        f"{numbers.number('raw_amount')} AS sales_sls_price",
        f"{numbers.number('raw_quantity')} AS sales_quantity",
        f"{numbers.number('raw_price')} AS sales_price",
    ).selectExpr(
        "*", f"{dates.compact_date_issue('raw_ordered', 'sls_order_date')} AS order_date_issue"
    )
    return sales.reconcile_amounts(typed, "sales_sls_price", "sales_quantity", "sales_price")


def entities(
    order_number_length: int = sales.ORDER_NUMBER_LENGTH,
    customer_id_length: int = sales.CUSTOMER_ID_LENGTH,
    customer_key_digits: int = customers.KEY_DIGITS,
) -> dict[str, Entity]:
    """The entities by table, for exports whose keys have these lengths."""
    every = (
        Entity(
            table="customer_info",
            source="customer_info",
            arity=7,
            positions={
                "raw_id": 0,
                "raw_key": 1,
                "raw_first": 2,
                "raw_last": 3,
                "raw_gender": 4,
                "raw_marital": 5,
                "raw_created": 6,
            },
            clean=partial(_customer, digits=customer_key_digits),
            keep="customer_key_cleaned IS NOT NULL",
            rules={"customer_name": "customer_name_cleaned IS NULL"},
        ),
        Entity(
            table="customer_birth",
            source="customer_birth_date",
            arity=3,
            positions={"raw_key": 0, "raw_birth": 1, "raw_gender": 2},
            clean=partial(_birth, digits=customer_key_digits),
            keep="customer_key IS NOT NULL",
            rules={
                "birth_key": "customer_key IS NULL",
                "birth_date": "birth_date IS NULL",
                "birth_gender": "gender IS NULL",
                "age": "age IS NULL",
            },
        ),
        Entity(
            table="customer_location",
            source="customer_location",
            arity=2,
            positions={"raw_key": 0, "raw_country": 1},
            clean=partial(_location, digits=customer_key_digits),
            keep="customer_location_key IS NOT NULL",
            rules={
                "location_key": "customer_location_key IS NULL",
                "location_country": "customer_location_state IS NULL",
            },
        ),
        Entity(
            table="category_products",
            source="category_products",
            arity=4,
            positions={"raw_key": 0, "raw_category": 1, "raw_sub_category": 2, "raw_flag": 3},
            clean=_category,
            keep="customer_product_key1 IS NOT NULL",
            rules={
                "category_key": "customer_product_key1 IS NULL",
                "category": "customer_category1 IS NULL",
                "sub_category": "customer_sub_category1 IS NULL",
                "maintenance": "customer_category_maintance1 IS NULL",
            },
        ),
        Entity(
            table="product_info",
            source="product_info",
            arity=6,
            positions={
                "raw_id": 0,
                "raw_composite": 1,
                "raw_name": 2,
                "raw_cost": 3,
                "raw_line": 4,
                "raw_start": 5,
            },
            clean=_product,
            keep="product_id <> 'N/A'",
            rules={
                "product_id": "length(raw_id) <> 3",
                "category_id": "raw_composite = ''",
                "product_key": "raw_composite = ''",
                "product_name": "raw_name = ''",
                "product_cost": "given_cost IS NULL OR given_cost < 0",
                # A blank line code reads 'N/A' as well, but is no error.
                "product_line": "raw_line <> '' AND product_line = 'N/A'",
                "product_start_date": "product_start_date IS NULL",
            },
        ),
        Entity(
            table="sales_details",
            source="sales_details",
            arity=9,
            # Field 4 is not used.
            positions={
                "raw_order": 0,
                "raw_product": 1,
                "raw_customer": 2,
                "raw_ordered": 3,
                "raw_due": 5,
                "raw_amount": 6,
                "raw_quantity": 7,
                "raw_price": 8,
            },
            clean=partial(_sale, order_length=order_number_length, id_length=customer_id_length),
            keep="sls_ord_num <> 'N/A'",
            rules={
                "order_number": "sls_ord_num = 'N/A'",
                "sold_product_key": "sls_prd_key = 'N/A'",
                "buyer_id": f"length(raw_customer) <> {customer_id_length}",
                # Dates that are empty or of another length are not errors here.
                "order_date": "length(raw_ordered) = 8 AND sls_order_date IS NULL",
                "due_date": "length(raw_due) = 8 AND sls_due_date IS NULL",
                "buyer_id_not_numeric": f"length(raw_customer) = {customer_id_length}"
                    " AND sls_cust_id IS NULL",
            },
        ),
    )
    return {entity.table: entity for entity in every}


ENTITIES = entities()
