"""Entry points of the warehouse queries over a folder of order tables."""

from __future__ import annotations

import datetime as dt
import os
import sys
import warnings
from collections.abc import Callable

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402

import oracles  # noqa: E402
from landing import WIDE, export, landing_lines, with_odd_lines  # noqa: E402
from tidemart.operators.side_by_side import side_by_side  # noqa: E402
from tidemart.plans import direct, gold, reports, silver  # noqa: E402
from tidemart.plans.bucketed import BucketedLayers  # noqa: E402
from tidemart.plans.factorised import FactorisedFact, fact_links  # noqa: E402
from tidemart.plans.routing import RoutedTables  # noqa: E402
from tidemart.plans.warehouse import Warehouse  # noqa: E402
from tidemart.sources.raw import read_manifest, read_source, source_summary, with_lineage  # noqa: E402
from tidemart.sources.schemas import RAW_SOURCES, columns_of  # noqa: E402
from tidemart.sources.staging import Staging  # noqa: E402
from tidemart.sources.tables import preview  # noqa: E402
from tidemart.sources.text_records import (  # noqa: E402
    decode_strict,
    decode_summary,
    read_records,
    route_records,
)
from tidemart.sources.versions import VersionedTable  # noqa: E402

# The operators for training data and their pipeline may be taken out of the library, and need
# modules that the rest does without. The queries of the warehouse stand in any case.
try:
    from tidemart.llm.registry import ORACLES as LLM_ORACLES, QUERIES as LLM_QUERIES
except ImportError as missing:
    if missing.name not in ("tidemart.llm", "tidemart.llm.registry"):
        warnings.warn(f"no operators for training data: {missing}", stacklevel=1)
    LLM_ORACLES, LLM_QUERIES = {}, {}
try:
    import corpus_pipeline
except ImportError as missing:
    if missing.name != "corpus_pipeline" and not (missing.name or "").startswith("tidemart.llm"):
        warnings.warn(f"no corpus pipeline: {missing}", stacklevel=1)
    corpus_pipeline = None

LOAD_DATE = dt.date.fromisoformat(oracles.LOAD_DATE)
AS_OF = dt.date.fromisoformat(oracles.AS_OF)


def _bronze(spark: SparkSession, sf_dir: str, *sources: str) -> dict[str, DataFrame]:
    lines = landing_lines(spark, sf_dir, sources or RAW_SOURCES)
    return {name: with_lineage(df, name, LOAD_DATE) for name, df in lines.items()}


def _silver(spark: SparkSession, sf_dir: str, *names: str) -> dict[str, DataFrame]:
    entities = [WIDE[name] for name in names or WIDE]
    bronze = _bronze(spark, sf_dir, *[entity.source for entity in entities])
    return {
        entity.table: silver.clean(bronze[entity.source], entity, AS_OF) for entity in entities
    }


def _star(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Customer dimension, product dimension and fact."""
    tables = _silver(spark, sf_dir)
    customers, products = gold.dimensions(tables, Staging(spark))
    return customers, products, gold.fact_sales(tables["sales_details"], products, customers)


def _unnumbered(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Sales, and the dimensions without surrogate numbers, where those are not needed."""
    tables = _silver(spark, sf_dir)
    return (
        tables["sales_details"],
        gold.product_rows(tables["product_info"], tables["category_products"]),
        gold.customer_rows(
            tables["customer_info"], tables["customer_birth"], tables["customer_location"]
        ),
    )


def q01_bronze_envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = landing_lines(spark, sf_dir, ["sales_details"])
    lines["sales_details"] = with_odd_lines(lines["sales_details"])
    manifest = export(lines, f"{Staging(spark).path}/landing")
    return read_source(spark, "sales_details", manifest["sales_details"], LOAD_DATE)


def q02_bronze_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = landing_lines(spark, sf_dir)
    lines["sales_details"] = with_odd_lines(lines["sales_details"])
    manifest = export(lines, f"{Staging(spark).path}/landing")
    return source_summary(read_manifest(spark, manifest, LOAD_DATE))


def q03_split_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.arity_summary(_bronze(spark, sf_dir), WIDE)


def _silver_query(table: str) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: _silver(spark, sf_dir, table)[table]


def q10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.quality(_bronze(spark, sf_dir), WIDE, AS_OF)


def q11_dim_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = _silver(spark, sf_dir, "customer_info", "customer_birth", "customer_location")
    return gold.dim_customer(*tables.values(), Staging(spark))


def q12_dim_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = _silver(spark, sf_dir, "product_info", "category_products")
    return gold.dim_product(*tables.values(), Staging(spark))


def q13_join_cardinality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both ways of treating missing keys, from weights: no pair is built."""
    tables = _unnumbered(spark, sf_dir)
    summaries = [
        direct.join_summary(*tables, null_keys).selectExpr(f"'{null_keys}' AS null_keys", "*")
        for null_keys in ("unmatched", "match")
    ]
    return summaries[0].unionByName(summaries[1])


def q14_fact_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _star(spark, sf_dir)[2]


def q15_gold_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    sales, products, customers = _unnumbered(spark, sf_dir)
    counts = gold.table_counts({"gold_dim_customer": customers, "gold_dim_product": products})
    fact = direct.fact_size(sales, products, customers)
    return counts.unionByName(fact.selectExpr("'gold_fact_sales' AS table_name", "rows"))


def q16_sales_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers, _, fact = _star(spark, sf_dir)
    return reports.sales_with_customer(fact, customers)


def q17_revenue_by_country(spark: SparkSession, sf_dir: str) -> DataFrame:
    return direct.revenue_by_country(*_unnumbered(spark, sf_dir))


def q18_monthly_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    return direct.monthly_trend(*_unnumbered(spark, sf_dir))


def q19_customer_sales(spark: SparkSession, sf_dir: str, top: int | None = None) -> DataFrame:
    tables = _silver(spark, sf_dir)
    products = gold.product_rows(tables["product_info"], tables["category_products"])
    customers = gold.dim_customer(
        tables["customer_info"],
        tables["customer_birth"],
        tables["customer_location"],
        Staging(spark),
    )
    return direct.customer_ranking(tables["sales_details"], products, customers, top)


def q20_top_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return q19_customer_sales(spark, sf_dir, top=5)


def _stored(spark: SparkSession, sf_dir: str) -> Warehouse:
    """A warehouse with every layer written."""
    root = Staging(spark).path
    manifest = export(landing_lines(spark, sf_dir), f"{root}/landing")
    warehouse = Warehouse(spark, root, as_of=AS_OF, load_date=LOAD_DATE, entities=WIDE)
    warehouse.ingest(manifest)
    warehouse.refine()
    warehouse.model()
    return warehouse


def q21_layered_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The country report over the fact, after every layer was written and read back."""
    return _stored(spark, sf_dir).reports()["revenue_by_country"]


def q24_stored_monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stored(spark, sf_dir).reports()["monthly_trend"]


def q25_stored_top_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stored(spark, sf_dir).reports()["top_customers"]


def q26_stored_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the gold tables as stored, and the stored fact's rows without a date."""
    warehouse = _stored(spark, sf_dir)
    names = ("gold_dim_customer", "gold_dim_product", "gold_fact_sales")
    tables = {name: warehouse.read("gold", name) for name in names}
    tables["undated_facts"] = tables["gold_fact_sales"].where("order_date IS NULL")
    return gold.table_counts(tables)


def q27_line_amounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The country report over line amounts instead of unit prices."""
    return direct.revenue_by_country(*_unnumbered(spark, sf_dir), measure="sales_amount")


def q22_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    order = ["order_number", "product_unique_num", "customer_unique_num"]
    order += [name for name in columns_of("gold", "gold_fact_sales") if name not in order]
    return preview(_star(spark, sf_dir)[2], 10, *order)


_RECORD = """format_string('{"order":%d,"line":%d,"flag":"%s"}',
    l_orderkey, l_linenumber, l_returnflag) AS record"""
_RECORD_FIELDS = "order bigint, line int, flag string"


def _json_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as JSON text, some of it cut short, doubled, followed by other text, in
    brackets, in single quotes or empty."""
    damaged = """CASE (l_orderkey + l_linenumber) % 11
        WHEN 1 THEN left(record, length(record) - 1) WHEN 2 THEN concat('{', record)
        WHEN 3 THEN '' WHEN 4 THEN concat(record, record) WHEN 5 THEN concat(record, ' xyz')
        WHEN 6 THEN concat(record, ',', record) WHEN 7 THEN concat('[', record, ']')
        WHEN 8 THEN translate(record, '"', "'") ELSE record END AS value"""
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    return lines.selectExpr("l_orderkey", "l_linenumber", _RECORD).selectExpr(damaged)


def q23_tolerant_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decode_summary(_json_records(spark, sf_dir), _RECORD_FIELDS)


def q28_ingest_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the bronze step notes of each source while it writes the lines."""
    lines = landing_lines(spark, sf_dir)
    lines["sales_details"] = with_odd_lines(lines["sales_details"])
    root = Staging(spark).path
    manifest = export(lines, f"{root}/landing")
    return Warehouse(spark, root, load_date=LOAD_DATE).ingest(manifest)


def q29_strict_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines written as text records and read back, all of them or none."""
    folder = f"{Staging(spark).path}/records"
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    lines.selectExpr(_RECORD).write.text(folder)
    records = read_records(spark, folder)
    return decode_strict(records, _RECORD_FIELDS, place=("file", "block", "row"))


def q30_rejected_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The reject table of a write that routes records to two tables in one pass."""
    routed = route_records(_json_records(spark, sf_dir), _RECORD_FIELDS)
    table = VersionedTable(spark, f"{Staging(spark).path}/records")
    table.replace(routed, "outcome")
    return table.read(routed.schema).where("outcome = 'rejected'").select("value", "reason")


def _routed(spark: SparkSession, sf_dir: str) -> RoutedTables:
    """Silver rows and rejected lines of all sources, each written by one job."""
    tables = RoutedTables(spark, Staging(spark).path, WIDE)
    bronze = _bronze(spark, sf_dir)
    side_by_side(
        spark, lambda entity: tables.write(bronze[entity.source], entity, AS_OF), WIDE.values()
    )
    return tables


def q31_rejected_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _routed(spark, sf_dir).rejected()


def q32_stored_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quality counts from the marks in the stored files."""
    return _routed(spark, sf_dir).quality()


def _factorised(spark: SparkSession, sf_dir: str) -> FactorisedFact:
    """The fact in which missing keys meet each other, without its pairs."""
    tables, staging = _silver(spark, sf_dir), Staging(spark)
    customers, products = gold.dimensions(tables, staging)
    links = fact_links(tables["sales_details"], products, customers, "match")
    return FactorisedFact(links, products, customers, "match")


def q33_match_by_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _factorised(spark, sf_dir).by_customer()


def q34_match_by_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _factorised(spark, sf_dir).by_product()


def q35_match_monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return direct.monthly_trend(*_unnumbered(spark, sf_dir), null_keys="match")


def q36_match_country(spark: SparkSession, sf_dir: str) -> DataFrame:
    return direct.revenue_by_country(*_unnumbered(spark, sf_dir), null_keys="match")


def q37_second_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The customer dimension of a second load, which brings the customers since 2022."""
    names = ("customer_info", "customer_birth", "customer_location")
    tables, staging = _silver(spark, sf_dir, *names), Staging(spark)
    early = tables["customer_info"].where("customer_date < DATE '2022-01-01'")
    last = gold.dim_customer(early, tables["customer_birth"], tables["customer_location"], staging)
    last = staging.settle(last, "last")
    return gold.dim_customer(*tables.values(), Staging(spark), last)


def _bucketed(spark: SparkSession, sf_dir: str) -> BucketedLayers:
    """The fact and its customers as stored by customer number."""
    customers, _, fact = _star(spark, sf_dir)
    staging = Staging(spark)
    tables = {"gold_dim_customer": customers, "gold_fact_sales": fact}
    stored = {name: staging.settle(table, name) for name, table in tables.items()}
    layers = BucketedLayers(spark, staging.path, buckets=8)
    side_by_side(spark, lambda item: layers.store("gold", *item), stored.items())
    return layers


def q38_bucketed_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All customers ranked, from tables that need no shuffle to be joined and summed."""
    return _bucketed(spark, sf_dir).customer_ranking()


def q39_bucketed_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers with birth and location, joined bucket by bucket."""
    names = ("customer_info", "customer_birth", "customer_location")
    tables, staging = _silver(spark, sf_dir, *names), Staging(spark)
    layers = BucketedLayers(spark, staging.path, buckets=8)
    stored = [(name, staging.settle(tables[name], name)) for name in names]
    side_by_side(spark, lambda item: layers.store("silver", *item), stored)
    return layers.customer_rows()


def entry(spark: SparkSession) -> DataFrame:
    """Revenue by country, from raw lines to the report."""
    return q17_revenue_by_country(spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    pipeline = {"pipeline": corpus_pipeline.run} if corpus_pipeline else {}
    return warehouse_queries() | LLM_QUERIES | pipeline


def warehouse_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "q01_bronze_envelope": q01_bronze_envelope,
        "q02_bronze_manifest": q02_bronze_manifest,
        "q03_split_guard": q03_split_guard,
        "q04_silver_customer": _silver_query("customer_info"),
        "q05_silver_birth": _silver_query("customer_birth"),
        "q06_silver_location": _silver_query("customer_location"),
        "q07_silver_category": _silver_query("category_products"),
        "q08_silver_product": _silver_query("product_info"),
        "q09_silver_sales": _silver_query("sales_details"),
        "q10_quality": q10_quality,
        "q11_dim_customer": q11_dim_customer,
        "q12_dim_product": q12_dim_product,
        "q13_join_cardinality": q13_join_cardinality,
        "q14_fact_sales": q14_fact_sales,
        "q15_gold_counts": q15_gold_counts,
        "q16_sales_customer": q16_sales_customer,
        "q17_revenue_by_country": q17_revenue_by_country,
        "q18_monthly_trend": q18_monthly_trend,
        "q19_customer_sales": q19_customer_sales,
        "q20_top_customers": q20_top_customers,
        "q21_layered_roundtrip": q21_layered_roundtrip,
        "q22_preview": q22_preview,
        "q23_tolerant_decode": q23_tolerant_decode,
        "q24_stored_monthly": q24_stored_monthly,
        "q25_stored_top_customers": q25_stored_top_customers,
        "q26_stored_counts": q26_stored_counts,
        "q27_line_amounts": q27_line_amounts,
        "q28_ingest_manifest": q28_ingest_manifest,
        "q29_strict_decode": q29_strict_decode,
        "q30_rejected_records": q30_rejected_records,
        "q31_rejected_lines": q31_rejected_lines,
        "q32_stored_quality": q32_stored_quality,
        "q33_match_by_customer": q33_match_by_customer,
        "q34_match_by_product": q34_match_by_product,
        "q35_match_monthly": q35_match_monthly,
        "q36_match_country": q36_match_country,
        "q37_second_load": q37_second_load,
        "q38_bucketed_ranking": q38_bucketed_ranking,
        "q39_bucketed_customers": q39_bucketed_customers,
    }


def oracle_sql() -> dict[str, str]:
    whole = corpus_pipeline.ORACLE_SQL if corpus_pipeline else None
    return oracles.oracle_sql() | LLM_ORACLES | ({"pipeline": whole} if whole else {})
