"""The whole run: exports to bronze, silver, gold and reports under one root."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidemart.operators.joins import NullKeys
from tidemart.operators.quality import observe_invalid, observed_quality
from tidemart.operators.side_by_side import side_by_side
from tidemart.plans import gold, reports
from tidemart.plans.factorised import LINKS, FactorisedFact, fact_links
from tidemart.plans.routing import RoutedTables
from tidemart.plans.silver import ENTITIES, Entity, assess, keep_valid
from tidemart.sources.raw import read_manifest
from tidemart.sources.schemas import LAYERS, RAW_SOURCES
from tidemart.sources.staging import Staging
from tidemart.sources.tables import read_table, table_path, write_table
from tidemart.sources.versions import VersionedTable


@dataclass
class Warehouse:
    """Parquet layers under ``root``. Each step reads the layer before it from disk. Tables are
    replaced whole or not at all (:class:`tidemart.sources.versions.VersionedTable`).

    ``keep_rejects`` stores the lines that silver leaves out beside its rows, and its quality
    counts as marks in the same files. With ``null_keys="match"`` the fact is stored without
    pairs (:mod:`tidemart.plans.factorised`), and its rows are made when they are read. With
    ``keep_numbers`` dimension rows that were there at the last run have the numbers of then.
    """

    spark: SparkSession
    root: str
    as_of: dt.date | None = None
    load_date: dt.date | None = None
    null_keys: NullKeys = "unmatched"
    entities: Mapping[str, Entity] = field(default_factory=lambda: ENTITIES)
    keep_rejects: bool = False
    keep_numbers: bool = False

    def read(self, layer: str, table: str) -> DataFrame:
        if layer == "silver" and self.keep_rejects:
            return self._routed.quality() if table == "quality" else self._routed.accepted(table)
        if table == "gold_fact_sales" and self._has_links_only():
            return self.factorised().rows()
        return read_table(self.spark, self.root, layer, table)

    def _has_links_only(self) -> bool:
        """Is the fact stored without pairs? A root that was modelled both ways has both forms,
        and ``null_keys`` tells which one is meant."""
        if self.null_keys == "match":
            return True
        stored = VersionedTable(self.spark, table_path(self.root, "gold", "gold_fact_sales"))
        return not stored.versions() and bool(self._links.versions())

    @property
    def _routed(self) -> RoutedTables:
        return RoutedTables(self.spark, self.root, self.entities)

    @property
    def _links(self) -> VersionedTable:
        return VersionedTable(self.spark, f"{self.root.rstrip('/')}/gold/gold_fact_links")

    def _write_all(self, layer: str, tables: Mapping[str, DataFrame]) -> None:
        side_by_side(
            self.spark,
            lambda item: write_table(item[1], self.root, layer, item[0]),
            tables.items(),
        )

    def ingest(self, manifest: Mapping[str, str]) -> DataFrame:
        """Bronze: capture every export of ``{source name: path}`` as it is. Returns the stored
        manifest, rows and smallest line per source, which are noted while the lines are
        written."""
        missing = set(RAW_SOURCES) - set(manifest)
        if missing:
            raise ValueError(f"manifest lacks sources: {sorted(missing)}")
        noted = {name: Observation(f"{name} lines") for name in manifest}
        lines = read_manifest(self.spark, manifest, self.load_date)
        lines = {
            name: df.observe(
                noted[name], F.count("*").alias("rows"), F.min("rawdata").alias("sample_line")
            )
            for name, df in lines.items()
        }
        self._write_all("bronze", lines)
        found = [(name, seen.get["rows"], seen.get["sample_line"]) for name, seen in noted.items()]
        table = self.spark.createDataFrame(found, LAYERS["bronze"]["manifest"])
        write_table(table.coalesce(1), self.root, "bronze", "manifest")
        return self.read("bronze", "manifest")

    def refine(self) -> None:
        """Silver: six clean tables; the quality counts are taken in the same pass."""
        if self.keep_rejects:
            side_by_side(self.spark, self._route, self.entities.values())
            return
        tables: dict[str, DataFrame] = {}
        observations: dict[str, Observation] = {}
        for name, entity in self.entities.items():
            assessed = assess(self.read("bronze", entity.source), entity, self.as_of)
            observed, observations[name] = observe_invalid(assessed, name, entity.rules)
            tables[name] = keep_valid(observed, entity)
        self._write_all("silver", tables)
        write_table(
            observed_quality(self.spark, observations).coalesce(1), self.root, "silver", "quality"
        )

    def _route(self, entity: Entity) -> None:
        self._routed.write(self.read("bronze", entity.source), entity, self.as_of)

    def rejects(self) -> DataFrame:
        """Every line that silver left out, with its reason (needs ``keep_rejects``)."""
        return self._routed.rejected()

    def model(self) -> None:
        """Gold: both dimensions, then the fact from the dimensions as stored."""
        silver = {name: self.read("silver", name) for name in self.entities}
        staging = Staging(self.spark)
        try:
            customers, products = gold.dimensions(silver, staging, self._last_dimensions())
            self._write_all("gold", {"gold_dim_customer": customers, "gold_dim_product": products})
        finally:
            staging.drop()
        sales = silver["sales_details"]
        products = self.read("gold", "gold_dim_product")
        customers = self.read("gold", "gold_dim_customer")
        if self.null_keys == "match":
            self._links.replace(fact_links(sales, products, customers, self.null_keys))
        else:
            fact = gold.fact_sales(sales, products, customers, self.null_keys)
            write_table(fact, self.root, "gold", "gold_fact_sales")

    def _last_dimensions(self) -> gold.Dimensions | None:
        names = ("gold_dim_customer", "gold_dim_product")
        there = all(
            VersionedTable(self.spark, table_path(self.root, "gold", name)).versions() for name in names
        )
        if not (self.keep_numbers and there):
            return None
        return tuple(self.read("gold", name) for name in names)

    def factorised(self) -> FactorisedFact:
        """The stored fact without pairs, as ``null_keys="match"`` leaves it."""
        dimensions = self.read("gold", "gold_dim_product"), self.read("gold", "gold_dim_customer")
        return FactorisedFact(self._links.read(LINKS), *dimensions, "match")

    def reports(self, top: int = 5, measure: reports.Measure = "price") -> dict[str, DataFrame]:
        """The reports as DataFrames over the stored gold tables."""
        if self.null_keys == "match":
            fact = self.factorised()
            return {
                "revenue_by_country": fact.revenue_by_country(measure),
                "monthly_trend": fact.monthly_trend(measure),
                "top_customers": fact.customer_ranking(top, measure),
            }
        fact = self.read("gold", "gold_fact_sales")
        customers = self.read("gold", "gold_dim_customer")
        return {
            "revenue_by_country": reports.revenue_by_country(fact, customers, measure),
            "monthly_trend": reports.monthly_trend(fact, measure),
            "top_customers": reports.customer_ranking(fact, customers, top, measure),
        }


def run(
    spark: SparkSession,
    manifest: Mapping[str, str],
    root: str,
    as_of: dt.date | None = None,
    load_date: dt.date | None = None,
    null_keys: NullKeys = "unmatched",
    entities: Mapping[str, Entity] = ENTITIES,
) -> dict[str, DataFrame]:
    """Ingest, refine, model and report in one go."""
    warehouse = Warehouse(spark, root, as_of, load_date, null_keys, entities)
    warehouse.ingest(manifest)
    warehouse.refine()
    warehouse.model()
    return warehouse.reports()
