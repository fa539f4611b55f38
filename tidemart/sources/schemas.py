"""Names, columns and types of every table. Fixed values."""

from __future__ import annotations

from pyspark.sql.types import StructType

RAW_SOURCES = (
    "customer_info",
    "product_info",
    "sales_details",
    "customer_birth_date",
    "customer_location",
    "category_products",
)

_BRONZE = "rawdata string, path_name string, load_date date"

_SILVER = {
    "customer_info": """
        customer_id_cleaned bigint, customer_key_cleaned string, customer_name_cleaned string,
        customer_martial_cleaned string, customer_gender_cleaned string, customer_date date""",
    "customer_birth": "customer_key string, birth_date date, gender string, age int",
    "customer_location": "customer_location_key string, customer_location_state string",
    "category_products": """
        customer_product_key1 string, customer_category1 string,
        customer_sub_category1 string, customer_category_maintance1 string""",
    "product_info": """
        product_id string, cat_id string, prod_key string, product_nm string,
        product_cost double, product_line string, product_start_date date""",
    "sales_details": """
        sls_ord_num string, sls_prd_key string, sls_cust_id bigint, sls_order_date date,
        order_date_issue string, sls_due_date date, sales_sls_price double,
        sales_quantity double, sales_price double""",
    "quality": "entity string, rule string, invalid_rows bigint",
}

_GOLD = {
    "gold_dim_customer": """
        customer_key string, customer_id bigint, customer_name string, marital_status string,
        gender string, customer_since date, birth_date date, age int, country string,
        unique_number_customer bigint""",
    "gold_dim_product": """
        product_id string, prod_key string, product_nm string, product_key string,
        category string, sub_category string, maintance string, product_cost double,
        product_line string, product_start_date date, unique_number bigint""",
    "gold_fact_sales": """
        order_number string, customer_unique_num bigint, product_unique_num bigint,
        order_date date, order_shipping_date date, sales_amount double,
        sales_quantity double, price double""",
}

LAYERS = {
    "bronze": {name: _BRONZE for name in RAW_SOURCES}
    | {"manifest": "path_name string, rows bigint, sample_line string"},
    "silver": _SILVER,
    "gold": _GOLD,
}


def columns_of(layer: str, table: str) -> list[str]:
    return StructType.fromDDL(LAYERS[layer][table]).fieldNames()
