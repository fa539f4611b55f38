"""Gold and silver tables stored by their join keys, and the work that then needs no shuffle."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from tidemart.plans import gold, reports
from tidemart.sources.buckets import BucketedTable
from tidemart.sources.schemas import LAYERS

_KEYS = {
    ("silver", "customer_info"): "customer_key_cleaned",
    ("silver", "customer_birth"): "customer_key",
    ("silver", "customer_location"): "customer_location_key",
    ("gold", "gold_dim_customer"): "unique_number_customer",
    ("gold", "gold_fact_sales"): "customer_unique_num",
}


@dataclass(frozen=True)
class BucketedLayers:
    """The tables that are joined by customer, under ``<root>/bucketed``, with one number of
    buckets for all of them."""

    spark: SparkSession
    root: str
    buckets: int

    def _table(self, layer: str, table: str) -> BucketedTable:
        path = f"{self.root.rstrip('/')}/bucketed/{layer}_{table}"
        return BucketedTable(self.spark, path, _KEYS[layer, table], self.buckets)

    def store(self, layer: str, table: str, rows: DataFrame) -> None:
        self._table(layer, table).replace(rows, unique=table == "gold_dim_customer")

    def read(self, layer: str, table: str) -> DataFrame:
        return self._table(layer, table).read(LAYERS[layer][table])

    def _parts(self, layer: str, table: str) -> tuple[DataFrame, DataFrame]:
        schema, stored = LAYERS[layer][table], self._table(layer, table)
        return stored.even(schema), stored.heavy(schema)

    def customer_rows(self) -> DataFrame:
        """Customers with birth and location (:func:`gold.customer_rows`). Keys that are heavy in
        any of the tables are few and meet the rows of all parts; all others meet in their
        buckets."""
        even, heavy = zip(*(self._parts("silver", name) for name in _SILVER))
        hot = heavy[0].select(_KEYS["silver", _SILVER[0]])
        for name, rows in zip(_SILVER[1:], heavy[1:]):
            hot = hot.union(rows.select(_KEYS["silver", name]))
        hot = hot.toDF("hot").where("hot IS NOT NULL").distinct()

        def apart(rows: DataFrame, name: str, how: str) -> DataFrame:
            # At most 2 * buckets keys a table are heavy.
            return rows.join(hot.hint("broadcast"), rows[_KEYS["silver", name]] == hot["hot"], how)

        bucketed = gold.bucket_rows(*(apart(rows, name, "left_anti") for rows, name in zip(even, _SILVER)))
        of_hot = [
            apart(a, name, "left_semi").unionByName(b.where(f"{_KEYS['silver', name]} IS NOT NULL"))
            for a, b, name in zip(even, heavy, _SILVER)
        ]
        return bucketed.unionByName(gold.customer_rows(*of_hot))

    def per_customer(self, measure: reports.Measure = "price") -> DataFrame:
        """``customer_unique_num``, ``sales`` and ``orders``. Sums of even keys stay in their
        buckets; of heavy ones, a row per key and task is shuffled."""
        even, heavy = self._parts("gold", "gold_fact_sales")
        return reports.per_customer(even, measure).unionByName(reports.per_customer(heavy, measure))

    def customer_ranking(self, top: int | None = None, measure: reports.Measure = "price") -> DataFrame:
        """The ranking of customers: the one shuffle of rows is the one that sorts it."""
        even, heavy = self._parts("gold", "gold_fact_sales")
        customers, few = self._parts("gold", "gold_dim_customer")
        of_even = reports.totals_with_customer(reports.per_customer(even, measure), customers)
        of_heavy = reports.totals_with_customer(
            reports.per_customer(heavy, measure), customers.unionByName(few)
        )
        return reports.ranking_report(of_even.unionByName(of_heavy), top)


_SILVER = ("customer_info", "customer_birth", "customer_location")
