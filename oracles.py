"""The same questions in DuckDB SQL, written from the rules and not from the Spark code."""

from __future__ import annotations

LOAD_DATE = "2026-01-01"
AS_OF = "2026-01-01"

# printf rounds the exact binary value, ties to even, where round would go by x * 100.
#
# Each table expression is named after the layer and table it stands for. A query pulls in
# the ones it names, with those they name in turn.
TABLES: dict[str, str] = {}

TABLES["land_customer_info"] = """
SELECT CASE WHEN k % 211 = 3 THEN 'x,y,z' ELSE
    (CASE WHEN k % 701 = 7 THEN 'X' || k ELSE CAST(k + 10000 AS VARCHAR) END) || ',' ||
    (CASE WHEN k % 97 = 5 THEN 'BAD' || k WHEN k % 4 = 1 THEN 'aw' || id ELSE 'AW' || id END) || ',' ||
    (CASE WHEN k % 31 = 0 THEN '' ELSE ' First' || (k % 100) || ' ' END) || ',' ||
    (CASE WHEN k % 31 = 0 OR k % 29 = 0 THEN '' ELSE 'Last' || (k % 77) END) || ',' ||
    (CASE k % 5 WHEN 0 THEN 'M' WHEN 1 THEN 'f' WHEN 2 THEN 'F ' WHEN 3 THEN '' ELSE 'x' END) || ',' ||
    (CASE k % 3 WHEN 0 THEN 'M' WHEN 1 THEN 's' ELSE '' END) || ',' ||
    (CASE k % 41 WHEN 0 THEN '2025-02-30' WHEN 1 THEN '2025-1-5' WHEN 2 THEN ''
        ELSE strftime(DATE '2020-01-01' + CAST(k % 1500 AS INTEGER), '%Y-%m-%d') END)
    END AS rawdata
FROM (SELECT c_custkey AS k, printf('%012d', c_custkey + 10000) AS id FROM customer)
"""

TABLES["land_customer_birth_date"] = """
SELECT CASE WHEN k % 199 = 1 THEN 'NASAW' || id ELSE
    (CASE WHEN k % 43 = 2 THEN 'AW' || id WHEN k % 47 = 1 THEN '' ELSE 'NASAW' || id END) || ',' ||
    (CASE k % 37 WHEN 0 THEN '' WHEN 1 THEN '1980-13-01' WHEN 2 THEN '80-01-01'
        ELSE strftime(DATE '1950-01-01' + CAST((k * 37) % 20000 AS INTEGER), '%Y-%m-%d') END) || ',' ||
    (CASE k % 4 WHEN 0 THEN 'Male' WHEN 1 THEN 'female' WHEN 2 THEN '' ELSE 'n/a' END)
    END AS rawdata
FROM (SELECT c_custkey AS k, printf('%012d', c_custkey + 10000) AS id FROM customer)
WHERE k % 6 <> 5
"""

TABLES["land_customer_location"] = """
SELECT (CASE k % 59 WHEN 3 THEN 'AW' || id WHEN 4 THEN '' ELSE 'AW-' || id END) || ',' ||
    (CASE c_nationkey % 11 WHEN 0 THEN 'US' WHEN 1 THEN 'USA' WHEN 2 THEN 'United States'
        WHEN 3 THEN 'United Kingdom' WHEN 4 THEN 'Australia' WHEN 5 THEN 'Canada'
        WHEN 6 THEN 'France' WHEN 7 THEN 'Germany' WHEN 8 THEN 'DE' WHEN 9 THEN ''
        ELSE 'Atlantis' END) AS rawdata
FROM (SELECT c_custkey AS k, c_nationkey,
        printf('%012d', c_custkey + 10000) AS id FROM customer)
WHERE k % 8 <> 7
"""

TABLES["land_category_products"] = """
SELECT DISTINCT
    (CASE WHEN n = 3 THEN 'BR-03' ELSE 'BR_' || printf('%02d', n) END) || ',' ||
    (CASE WHEN n = 5 THEN '' ELSE 'Category ' || (n % 4) END) || ',' ||
    (CASE WHEN n = 6 THEN '' ELSE 'Sub ' || n END) || ',' ||
    (CASE n % 3 WHEN 0 THEN 'Yes' WHEN 1 THEN 'No' ELSE 'maybe' END) AS rawdata
FROM (SELECT CAST(substr(p_brand, 7) AS INTEGER) AS n FROM part) WHERE n < 24
"""

TABLES["land_product_info"] = """
SELECT CASE WHEN p % 89 = 0 THEN 'a,b,c,d,e' ELSE
    (CASE WHEN p % 101 = 0 THEN '1234' ELSE CAST(100 + p % 900 AS VARCHAR) END) || ',' ||
    (CASE WHEN p % 103 = 0 THEN '' ELSE 'BR-' || printf('%02d', n) || '-' || pk END) || ',' ||
    (CASE WHEN p % 61 = 0 THEN '' ELSE p_name END) || ',' ||
    (CASE p % 67 WHEN 0 THEN '' WHEN 1 THEN '-3' WHEN 2 THEN 'abc'
        ELSE CAST(CAST(floor(p_retailprice) AS BIGINT) AS VARCHAR) END) || ',' ||
    (CASE p % 7 WHEN 0 THEN 'M ' WHEN 1 THEN 'r' WHEN 2 THEN 'S' WHEN 3 THEN 'T'
        WHEN 4 THEN '' WHEN 5 THEN 'Z' ELSE 'R ' END) || ',' ||
    (CASE p % 71 WHEN 0 THEN '' WHEN 1 THEN '2012-02-30'
        ELSE strftime(DATE '2011-01-01' + CAST(p % 900 AS INTEGER), '%Y-%m-%d') END) ||
    (CASE WHEN p % 83 = 0 THEN '' ELSE ',' END)
    END AS rawdata
FROM (SELECT p_partkey AS p, p_name, p_retailprice, CAST(substr(p_brand, 7) AS INTEGER) AS n,
        'PK-' || printf('%05d', CASE WHEN p_partkey % 10 = 1 THEN p_partkey - 1 ELSE p_partkey END)
            AS pk
      FROM part)
"""

TABLES["land_sales_details"] = """
SELECT
    (CASE lo % 331 WHEN 1 THEN 'SX' || number WHEN 2 THEN 'so' || number WHEN 3 THEN 'SO-12-4'
        ELSE 'SO' || number END) || ',' ||
    (CASE WHEN lp % 173 = 9 THEN 'PK9' ELSE pk END) || ',' ||
    (CASE lo % 499 WHEN 3 THEN '123' WHEN 4 THEN 'ABCDEFGHIJKL'
        ELSE printf('%012d', o_custkey + 10000) END) || ',' ||
    (CASE lo % 211 WHEN 1 THEN '' WHEN 2 THEN '2010' WHEN 3 THEN '20130231'
        ELSE strftime(CAST(o_orderdate AS DATE), '%Y%m%d') END) || ',' ||
    strftime(CAST(l_shipdate AS DATE), '%Y%m%d') || ',' ||
    (CASE lo % 223 WHEN 1 THEN '' WHEN 2 THEN '0' WHEN 3 THEN '20131399'
        ELSE strftime(CAST(l_shipdate AS DATE) + 7, '%Y%m%d') END) || ',' ||
    (CASE WHEN lp % 131 IN (1, 2, 3) THEN CAST(pr * q AS VARCHAR)
        WHEN lp % 137 = 1 THEN '' WHEN lp % 137 = 2 THEN '-5'
        WHEN lp % 137 = 3 THEN CAST(pr * q + 1 AS VARCHAR)
        ELSE CAST(pr * q AS VARCHAR) END) || ',' ||
    (CASE lp % 127 WHEN 1 THEN '' WHEN 2 THEN '0' WHEN 3 THEN '-2' WHEN 4 THEN 'abc'
        ELSE CAST(q AS VARCHAR) END) || ',' ||
    (CASE lp % 131 WHEN 1 THEN '' WHEN 2 THEN '-' || pr WHEN 3 THEN '0'
        ELSE CAST(pr AS VARCHAR) END) AS rawdata
FROM (SELECT l_orderkey AS lo, l_partkey AS lp, l_shipdate, o_custkey, o_orderdate,
        printf('%016X', l_orderkey) AS number,
        CAST(floor(l_extendedprice / l_quantity) AS BIGINT) AS pr,
        CAST(l_quantity AS BIGINT) AS q,
        'PK-' || printf('%05d', CASE WHEN l_partkey % 10 = 1 THEN l_partkey - 1 ELSE l_partkey END)
            AS pk
      FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
"""


def _fields(source: str, arity: int, names: dict[str, int]) -> str:
    fields = ", ".join(f"trim(f[{position + 1}]) AS {name}" for name, position in names.items())
    return f"""SELECT {fields}
FROM (SELECT string_split(rawdata, ',') AS f FROM land_{source}) WHERE len(f) >= {arity}"""


_ISO = r"'[0-9]{4}-[0-9]{2}-[0-9]{2}'"
_NUMBER = r"'[+-]?([0-9]+([.][0-9]*)?|[.][0-9]+)([eE][+-]?[0-9]+)?'"


def _iso(column: str) -> str:
    return (
        f"CASE WHEN regexp_full_match({column}, {_ISO}) "
        f"THEN CAST(try_strptime({column}, '%Y-%m-%d') AS DATE) END"
    )


def _compact(column: str) -> str:
    return (
        f"CASE WHEN regexp_full_match({column}, '[0-9]{{8}}') "
        f"THEN CAST(try_strptime({column}, '%Y%m%d') AS DATE) END"
    )


def _number(column: str) -> str:
    return f"CASE WHEN regexp_full_match({column}, {_NUMBER}) THEN TRY_CAST({column} AS DOUBLE) END"


TABLES["all_customer_info"] = f"""
SELECT *,
    CASE WHEN regexp_full_match(id, '[0-9]+') THEN TRY_CAST(id AS BIGINT) END AS customer_id_cleaned,
    CASE WHEN regexp_full_match(upper(key), 'AW[0-9]{{12}}') THEN upper(key) END AS customer_key_cleaned,
    CASE WHEN first = '' AND last = '' THEN NULL WHEN first = '' THEN last
        WHEN last = '' THEN first ELSE first || ' ' || last END AS customer_name_cleaned,
    CASE WHEN marital IN ('M', 'm') THEN 'Married' WHEN marital IN ('S', 's') THEN 'Single' END
        AS customer_martial_cleaned,
    CASE WHEN gender IN ('M', 'm') THEN 'Male' WHEN gender IN ('F', 'f') THEN 'Female' END
        AS customer_gender_cleaned,
    {_iso("created")} AS customer_date
FROM ({_fields("customer_info", 7, {"id": 0, "key": 1, "first": 2, "last": 3, "gender": 4, "marital": 5, "created": 6})})
"""
TABLES["silver_customer_info"] = """
SELECT customer_id_cleaned, customer_key_cleaned, customer_name_cleaned,
    customer_martial_cleaned, customer_gender_cleaned, customer_date
FROM all_customer_info WHERE customer_key_cleaned IS NOT NULL
"""

TABLES["all_customer_birth"] = f"""
SELECT customer_key, birth_date, gender,
    CAST(year(DATE '{AS_OF}') - year(birth_date)
        - CASE WHEN strftime(DATE '{AS_OF}', '%m%d') < strftime(birth_date, '%m%d')
            THEN 1 ELSE 0 END AS INTEGER) AS age
FROM (SELECT
        CASE WHEN regexp_full_match(upper(key), 'NASAW[0-9]{{12}}') THEN substr(upper(key), 4) END
            AS customer_key,
        {_iso("born")} AS birth_date,
        CASE lower(word) WHEN 'male' THEN 'Male' WHEN 'female' THEN 'Female' END AS gender
    FROM ({_fields("customer_birth_date", 3, {"key": 0, "born": 1, "word": 2})}))
"""
TABLES["silver_customer_birth"] = "SELECT * FROM all_customer_birth WHERE customer_key IS NOT NULL"

TABLES["all_customer_location"] = f"""
SELECT
    CASE WHEN regexp_full_match(upper(key), 'AW-[0-9]{{12}}') THEN 'AW' || substr(key, 4) END
        AS customer_location_key,
    CASE WHEN country IN ('US', 'USA', 'United States') THEN 'United States'
        WHEN country IN ('DE', 'Germany') THEN 'Germany'
        WHEN country IN ('United Kingdom', 'Australia', 'Canada', 'France') THEN country END
        AS customer_location_state
FROM ({_fields("customer_location", 2, {"key": 0, "country": 1})})
"""
TABLES["silver_customer_location"] = (
    "SELECT * FROM all_customer_location WHERE customer_location_key IS NOT NULL"
)

TABLES["all_category_products"] = f"""
SELECT CASE WHEN key LIKE '__^___' ESCAPE '^' THEN key END AS customer_product_key1,
    nullif(cat, '') AS customer_category1,
    nullif(sub, '') AS customer_sub_category1,
    CASE WHEN flag IN ('Yes', 'No') THEN flag END AS customer_category_maintance1
FROM ({_fields("category_products", 4, {"key": 0, "cat": 1, "sub": 2, "flag": 3})})
"""
TABLES["silver_category_products"] = (
    "SELECT * FROM all_category_products WHERE customer_product_key1 IS NOT NULL"
)

TABLES["all_product_info"] = f"""
SELECT *,
    CASE WHEN length(id) = 3 THEN id ELSE 'N/A' END AS product_id,
    CASE WHEN composite = '' THEN 'N/A' ELSE replace(left(composite, 5), '-', '_') END AS cat_id,
    CASE WHEN composite = '' THEN 'N/A' ELSE substr(composite, 7) END AS prod_key,
    CASE WHEN nm = '' THEN 'N/A' ELSE nm END AS product_nm,
    {_number("cost")} AS given_cost,
    greatest(coalesce({_number("cost")}, 0), 0) AS product_cost,
    CASE upper(line) WHEN 'M' THEN 'Mountain' WHEN 'R' THEN 'Road' WHEN 'S' THEN 'Other Sales'
        WHEN 'T' THEN 'Touring' ELSE 'N/A' END AS product_line,
    {_iso("start")} AS product_start_date
FROM ({_fields("product_info", 6, {"id": 0, "composite": 1, "nm": 2, "cost": 3, "line": 4, "start": 5})})
"""
TABLES["silver_product_info"] = """
SELECT product_id, cat_id, prod_key, product_nm, product_cost, product_line, product_start_date
FROM all_product_info WHERE product_id <> 'N/A'
"""

TABLES["all_sales_details"] = f"""
SELECT *, CASE WHEN printf('%.2f', amount1) <> printf('%.2f', q * unit) THEN q * unit ELSE amount1 END
    AS total
FROM (SELECT *, CASE WHEN p0 > 0 THEN p0 ELSE amount1 / q END AS unit
    FROM (SELECT *,
            CASE WHEN q0 > 0 THEN q0 ELSE 1.0::DOUBLE END AS q,
            CASE WHEN a0 >= 0 THEN a0 ELSE 0.0::DOUBLE END AS amount1
        FROM (SELECT *,
                {_number("amount")} AS a0, {_number("quantity")} AS q0, {_number("price")} AS p0,
                {_compact("ordered")} AS order_day, {_compact("due")} AS due_day,
                CASE WHEN regexp_full_match(num, 'SO[0-9A-Za-z]{{16}}') THEN num ELSE 'N/A' END
                    AS order_no,
                CASE WHEN length(product) > 2 AND product[3] = '-' THEN product ELSE 'N/A' END
                    AS product_no,
                CASE WHEN length(buyer) = 12 THEN TRY_CAST(buyer AS BIGINT) END AS buyer_no
            FROM ({_fields("sales_details", 9, {"num": 0, "product": 1, "buyer": 2, "ordered": 3, "due": 5, "amount": 6, "quantity": 7, "price": 8})}))))
"""
TABLES["silver_sales_details"] = """
SELECT order_no AS sls_ord_num, product_no AS sls_prd_key, buyer_no AS sls_cust_id,
    order_day AS sls_order_date,
    CASE WHEN ordered = '' THEN 'missing' WHEN length(ordered) <> 8 THEN 'bad_length'
        WHEN order_day IS NULL THEN 'bad_date' END AS order_date_issue,
    due_day AS sls_due_date, total AS sales_sls_price, q AS sales_quantity, unit AS sales_price
FROM all_sales_details WHERE order_no <> 'N/A'
"""

TABLES["gold_dim_customer"] = """
SELECT *, row_number() OVER (ORDER BY customer_key, customer_id NULLS FIRST,
    customer_name NULLS FIRST, marital_status NULLS FIRST, gender NULLS FIRST,
    customer_since NULLS FIRST, birth_date NULLS FIRST, age NULLS FIRST, country NULLS FIRST)
    AS unique_number_customer
FROM (SELECT c.customer_key_cleaned AS customer_key, c.customer_id_cleaned AS customer_id,
        c.customer_name_cleaned AS customer_name, c.customer_martial_cleaned AS marital_status,
        coalesce(c.customer_gender_cleaned, b.gender) AS gender, c.customer_date AS customer_since,
        b.birth_date, b.age,
        CASE WHEN l.customer_location_key IS NULL THEN NULL
            ELSE coalesce(l.customer_location_state, 'Unknown') END AS country
    FROM silver_customer_info c
    LEFT JOIN silver_customer_birth b ON c.customer_key_cleaned = b.customer_key
    LEFT JOIN silver_customer_location l ON c.customer_key_cleaned = l.customer_location_key)
"""

TABLES["gold_dim_product"] = """
SELECT *, row_number() OVER (ORDER BY prod_key, product_start_date NULLS FIRST, product_id,
    product_nm, product_key, category NULLS FIRST, sub_category NULLS FIRST,
    maintance NULLS FIRST, product_cost, product_line) AS unique_number
FROM (SELECT p.product_id, p.prod_key, p.product_nm, p.cat_id AS product_key,
        CASE WHEN c.customer_product_key1 IS NULL THEN 'N/A' ELSE c.customer_category1 END AS category,
        CASE WHEN c.customer_product_key1 IS NULL THEN 'N/A' ELSE c.customer_sub_category1 END
            AS sub_category,
        CASE WHEN c.customer_product_key1 IS NULL THEN 'N/A'
            ELSE c.customer_category_maintance1 END AS maintance,
        p.product_cost, p.product_line, p.product_start_date
    FROM silver_product_info p
    LEFT JOIN silver_category_products c ON p.cat_id = c.customer_product_key1)
"""

TABLES["gold_fact_sales"] = """
SELECT s.sls_ord_num AS order_number, c.unique_number_customer AS customer_unique_num,
    p.unique_number AS product_unique_num, s.sls_order_date AS order_date,
    s.sls_due_date AS order_shipping_date, s.sales_sls_price AS sales_amount,
    s.sales_quantity, s.sales_price AS price
FROM silver_sales_details s
LEFT JOIN gold_dim_product p ON s.sls_prd_key = p.prod_key AND p.prod_key <> 'N/A'
LEFT JOIN gold_dim_customer c ON s.sls_cust_id = c.customer_id
"""

TABLES["match_fact"] = """
SELECT c.unique_number_customer AS customer_unique_num, p.unique_number AS product_unique_num,
    s.sls_order_date AS order_date, s.sales_sls_price AS sales_amount, s.sales_quantity,
    s.sales_price AS price, c.country, c.unique_number_customer IS NOT NULL AS known
FROM silver_sales_details s
LEFT JOIN gold_dim_product p ON s.sls_prd_key = p.prod_key
LEFT JOIN gold_dim_customer c ON s.sls_cust_id IS NOT DISTINCT FROM c.customer_id
"""

TABLES["export_sales_details"] = """
SELECT rawdata FROM land_sales_details
UNION ALL
SELECT CASE length(rawdata) % 11 WHEN 0 THEN '' WHEN 1 THEN '   ' WHEN 2 THEN '"' || rawdata || '""'
    WHEN 3 THEN chr(0) || rawdata ELSE rawdata || chr(1) || ',x' END
FROM land_sales_details WHERE length(rawdata) % 11 < 5
"""

TABLES["sales_customer"] = """
SELECT f.customer_unique_num, f.price, c.customer_id, c.unique_number_customer IS NOT NULL AS known,
    CASE WHEN known THEN c.customer_name ELSE 'N/A' END AS name,
    CASE WHEN known THEN c.gender ELSE 'N/A' END AS gender,
    CASE WHEN known THEN CAST(c.age AS VARCHAR) ELSE 'N/A' END AS age,
    CASE WHEN known THEN c.country ELSE 'N/A' END AS country
FROM gold_fact_sales f
LEFT JOIN gold_dim_customer c ON f.customer_unique_num = c.unique_number_customer
"""

TABLES["ranked_customers"] = """
SELECT coalesce(CAST(customer_unique_num AS VARCHAR), 'N/A') AS customer_id,
    any_value(country) AS country, any_value(gender) AS gender,
    CAST(printf('%.2f', sum(price)) AS DOUBLE) AS Total_sales, count(*) AS Total_orders,
    CAST(printf('%.2f', sum(price) / count(*)) AS DOUBLE) AS avg_order_value,
    row_number() OVER (ORDER BY CAST(printf('%.2f', sum(price)) AS DOUBLE) DESC, customer_unique_num NULLS LAST) AS place
FROM sales_customer GROUP BY customer_unique_num
"""


def _query(sql: str) -> str:
    """Put the table expressions a query needs in front of it, dependencies first."""
    needed: list[str] = []

    def collect(text: str) -> None:
        for name, body in TABLES.items():
            if name in text and name not in needed:
                collect(body)
                needed.append(name)

    collect(sql)
    tables = ",\n".join(f"{name} AS ({TABLES[name].strip()})" for name in needed)
    return f"WITH {tables}\n{sql.strip()}"


_SOURCES = (
    "customer_info",
    "product_info",
    "sales_details",
    "customer_birth_date",
    "customer_location",
    "category_products",
)
_ARITIES = (
    ("customer_info", "customer_info", 7),
    ("customer_birth", "customer_birth_date", 3),
    ("customer_location", "customer_location", 2),
    ("category_products", "category_products", 4),
    ("product_info", "product_info", 6),
    ("sales_details", "sales_details", 9),
)
_RULES = (
    ("customer_info", "customer_name", "first = '' AND last = ''"),
    ("customer_birth", "birth_key", "customer_key IS NULL"),
    ("customer_birth", "birth_date", "birth_date IS NULL"),
    ("customer_birth", "birth_gender", "gender IS NULL"),
    ("customer_birth", "age", "birth_date IS NULL"),
    ("customer_location", "location_key", "customer_location_key IS NULL"),
    ("customer_location", "location_country", "customer_location_state IS NULL"),
    ("category_products", "category_key", "customer_product_key1 IS NULL"),
    ("category_products", "category", "customer_category1 IS NULL"),
    ("category_products", "sub_category", "customer_sub_category1 IS NULL"),
    ("category_products", "maintenance", "customer_category_maintance1 IS NULL"),
    ("product_info", "product_id", "length(id) <> 3"),
    ("product_info", "category_id", "composite = ''"),
    ("product_info", "product_key", "composite = ''"),
    ("product_info", "product_name", "nm = ''"),
    ("product_info", "product_cost", "given_cost IS NULL OR given_cost < 0"),
    ("product_info", "product_line", "upper(line) NOT IN ('', 'M', 'R', 'S', 'T')"),
    ("product_info", "product_start_date", "product_start_date IS NULL"),
    ("sales_details", "order_number", "order_no = 'N/A'"),
    ("sales_details", "sold_product_key", "product_no = 'N/A'"),
    ("sales_details", "buyer_id", "length(buyer) <> 12"),
    ("sales_details", "order_date", "length(ordered) = 8 AND order_day IS NULL"),
    ("sales_details", "due_date", "length(due) = 8 AND due_day IS NULL"),
    ("sales_details", "buyer_id_not_numeric", "length(buyer) = 12 AND buyer_no IS NULL"),
)

_FACT_ORDER = ", ".join(
    f"{column} NULLS FIRST"
    for column in (
        "order_number",
        "product_unique_num",
        "customer_unique_num",
        "order_date",
        "order_shipping_date",
        "sales_amount",
        "sales_quantity",
        "price",
    )
)

_COUNTRY_REPORT = """
SELECT country AS customer_country, sum(price) AS revenue FROM sales_customer GROUP BY country
"""

_QUERIES: dict[str, str] = {
    "q01_bronze_envelope": f"""
SELECT rawdata, 'sales_details' AS path_name, DATE '{LOAD_DATE}' AS load_date
FROM export_sales_details""",
    "q02_bronze_manifest": " UNION ALL ".join(
        f"SELECT '{name}' AS path_name, count(*) AS rows, min(rawdata) AS sample_line "
        f"FROM {'export' if name == 'sales_details' else 'land'}_{name}"
        for name in _SOURCES
    ),
    "q03_split_guard": " UNION ALL ".join(
        f"SELECT '{entity}' AS entity, count(*) AS raw_rows, "
        f"count(*) FILTER (len(string_split(rawdata, ',')) >= {arity}) AS usable_rows "
        f"FROM land_{source}"
        for entity, source, arity in _ARITIES
    ),
    "q04_silver_customer": "SELECT * FROM silver_customer_info",
    "q05_silver_birth": "SELECT * FROM silver_customer_birth",
    "q06_silver_location": "SELECT * FROM silver_customer_location",
    "q07_silver_category": "SELECT * FROM silver_category_products",
    "q08_silver_product": "SELECT * FROM silver_product_info",
    "q09_silver_sales": "SELECT * FROM silver_sales_details",
    "q10_quality": " UNION ALL ".join(
        f"SELECT '{entity}' AS entity, '{rule}' AS rule, "
        f"count(*) FILTER ({condition}) AS invalid_rows FROM all_{entity}"
        for entity, rule, condition in _RULES
    ),
    "q11_dim_customer": "SELECT * FROM gold_dim_customer",
    "q12_dim_product": "SELECT * FROM gold_dim_product",
    "q13_join_cardinality": " UNION ALL ".join(
        f"""
SELECT '{null_keys}' AS null_keys, 'sales to product' AS join_name, count(*) AS left_rows,
    count(*) FILTER (versions > 0) AS matched_rows, count(*) FILTER (versions = 0) AS unmatched_rows,
    sum(greatest(versions, 1))::BIGINT AS output_rows
FROM (SELECT (SELECT count(*) FROM gold_dim_product p WHERE s.sls_prd_key = p.prod_key {real})
        AS versions FROM silver_sales_details s)
UNION ALL
SELECT '{null_keys}', 'sales to customer', count(*), count(*) FILTER (buyers > 0),
    count(*) FILTER (buyers = 0), sum(greatest(buyers, 1))::BIGINT
FROM (SELECT (SELECT count(*) FROM gold_dim_customer c WHERE c.customer_id {same} s.sls_cust_id)
        AS buyers
    FROM silver_sales_details s
    LEFT JOIN gold_dim_product p ON s.sls_prd_key = p.prod_key {real})"""
        for null_keys, real, same in (
            ("unmatched", "AND p.prod_key <> 'N/A'", "="),
            ("match", "", "IS NOT DISTINCT FROM"),
        )
    ),
    "q14_fact_sales": "SELECT * FROM gold_fact_sales",
    "q15_gold_counts": " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, count(*) AS rows FROM {name}"
        for name in ("gold_dim_customer", "gold_dim_product", "gold_fact_sales")
    ),
    "q16_sales_customer": """
SELECT coalesce(CAST(customer_unique_num AS VARCHAR), 'N/A') AS customer_unique_NUM,
    name AS customer_name, gender AS customer_gender, age AS customer_age,
    country AS customer_country, price AS sales_price
FROM sales_customer""",
    "q17_revenue_by_country": _COUNTRY_REPORT,
    "q18_monthly_trend": """
SELECT monthname(make_date(2000, month_num, 1)) AS month, total_sales, total_orders, month_num
FROM (SELECT CAST(month(order_date) AS INTEGER) AS month_num,
        CAST(printf('%.2f', sum(price)) AS DOUBLE) AS total_sales,
        count(*) AS total_orders
    FROM gold_fact_sales WHERE order_date IS NOT NULL GROUP BY 1)""",
    "q19_customer_sales": "SELECT * EXCLUDE (place) FROM ranked_customers",
    "q20_top_customers": "SELECT * EXCLUDE (place) FROM ranked_customers WHERE place <= 5",
    "q21_layered_roundtrip": _COUNTRY_REPORT,
    "q22_preview": f"SELECT * FROM gold_fact_sales ORDER BY {_FACT_ORDER} LIMIT 10",
    "q23_tolerant_decode": """
SELECT count(*) FILTER (good) AS accepted, count(*) FILTER (NOT good) AS rejected
FROM (SELECT coalesce(json_valid(value) AND value LIKE '{%', false) AS good
    FROM (SELECT CASE (l_orderkey + l_linenumber) % 11
        WHEN 1 THEN record[:-2] WHEN 2 THEN '{' || record WHEN 3 THEN '' WHEN 4 THEN record || record
        WHEN 5 THEN record || ' xyz' WHEN 6 THEN record || ',' || record
        WHEN 7 THEN '[' || record || ']' WHEN 8 THEN replace(record, '"', '''') ELSE record END
        AS value
    FROM (SELECT l_orderkey, l_linenumber,
            '{"order":' || l_orderkey || ',"line":' || l_linenumber || ',"flag":"' ||
            l_returnflag || '"}' AS record
        FROM lineitem)))""",
    "q27_line_amounts": """
SELECT CASE WHEN known THEN c.country ELSE 'N/A' END AS customer_country, sum(sales_amount) AS revenue
FROM (SELECT f.*, c.country, c.unique_number_customer IS NOT NULL AS known FROM gold_fact_sales f
    LEFT JOIN gold_dim_customer c ON f.customer_unique_num = c.unique_number_customer) c
GROUP BY 1""",
}

_DAMAGED = """
SELECT CASE (l_orderkey + l_linenumber) % 11
    WHEN 1 THEN record[:-2] WHEN 2 THEN '{' || record WHEN 3 THEN '' WHEN 4 THEN record || record
    WHEN 5 THEN record || ' xyz' WHEN 6 THEN record || ',' || record
    WHEN 7 THEN '[' || record || ']' WHEN 8 THEN replace(record, '"', '''') ELSE record END AS value
FROM (SELECT l_orderkey, l_linenumber, '{"order":' || l_orderkey || ',"line":' || l_linenumber ||
    ',"flag":"' || l_returnflag || '"}' AS record FROM lineitem)"""


def _key_rejects(entity: str, source: str, arity: int) -> str:
    """Lines with too few fields, or without a valid key."""
    key = {
        "customer_info": "NOT regexp_full_match(upper(trim(f[2])), 'AW[0-9]{12}')",
        "customer_birth": "NOT regexp_full_match(upper(trim(f[1])), 'NASAW[0-9]{12}')",
        "customer_location": "NOT regexp_full_match(upper(trim(f[1])), 'AW-[0-9]{12}')",
        "category_products": "NOT (length(trim(f[1])) = 5 AND trim(f[1])[3] = '_')",
        "product_info": "length(trim(f[1])) <> 3",
        "sales_details": "NOT regexp_full_match(trim(f[1]), 'SO[0-9A-Za-z]{16}')",
    }[entity]
    return f"""SELECT '{entity}' AS table_name, '{source}' AS path_name, DATE '{LOAD_DATE}' AS load_date,
    CASE WHEN len(f) < {arity} THEN 'too few fields' ELSE 'invalid key' END AS reason, rawdata
FROM (SELECT rawdata, string_split(rawdata, ',') AS f FROM land_{source})
WHERE len(f) < {arity} OR {key}"""


_TOTALS = """SELECT {number}, count(*) AS fact_rows, sum(price) AS price, sum(sales_amount) AS sales_amount,
    sum(sales_quantity) AS sales_quantity
FROM match_fact GROUP BY {number}"""

_QUERIES |= {
    "q28_ingest_manifest": _QUERIES["q02_bronze_manifest"],
    "q29_strict_decode": """
SELECT l_orderkey AS "order", l_linenumber AS line, l_returnflag AS flag FROM lineitem""",
    "q30_rejected_records": f"""
SELECT value, CASE WHEN trim(value) = '' THEN 'empty'
    WHEN json_valid('[' || value || ']') AND value LIKE '{{%' THEN 'not one object'
    ELSE 'unreadable' END AS reason
FROM ({_DAMAGED}) WHERE NOT (json_valid(value) AND value LIKE '{{%')""",
    "q31_rejected_lines": " UNION ALL ".join(_key_rejects(*row) for row in _ARITIES),
    "q32_stored_quality": _QUERIES["q10_quality"],
    "q33_match_by_customer": _TOTALS.format(number="customer_unique_num"),
    "q34_match_by_product": _TOTALS.format(number="product_unique_num"),
    "q35_match_monthly": """
SELECT monthname(make_date(2000, month_num, 1)) AS month, total_sales, total_orders, month_num
FROM (SELECT CAST(month(order_date) AS INTEGER) AS month_num,
        CAST(printf('%.2f', sum(price)) AS DOUBLE) AS total_sales, count(*) AS total_orders
    FROM match_fact WHERE order_date IS NOT NULL GROUP BY 1)""",
    "q36_match_country": """
SELECT CASE WHEN known THEN country ELSE 'N/A' END AS customer_country, sum(price) AS revenue
FROM match_fact GROUP BY 1""",
    "q38_bucketed_ranking": _QUERIES["q19_customer_sales"],
    "q39_bucketed_customers": "SELECT * EXCLUDE (unique_number_customer) FROM gold_dim_customer",
    "q37_second_load": """
SELECT * EXCLUDE (unique_number_customer, early), row_number() OVER (
        ORDER BY CASE WHEN early THEN 0 ELSE 1 END, unique_number_customer) AS unique_number_customer
FROM (SELECT *, coalesce(customer_since < DATE '2022-01-01', false) AS early FROM gold_dim_customer)""",
}

_QUERIES |= {
    "q24_stored_monthly": _QUERIES["q18_monthly_trend"],
    "q25_stored_top_customers": _QUERIES["q20_top_customers"],
    "q26_stored_counts": _QUERIES["q15_gold_counts"]
    + " UNION ALL SELECT 'undated_facts', count(*) FROM gold_fact_sales WHERE order_date IS NULL",
}


def oracle_sql() -> dict[str, str]:
    return {
        name: _query(sql) if any(table in sql for table in TABLES) else sql.strip()
        for name, sql in _QUERIES.items()
    }
