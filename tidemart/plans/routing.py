"""Silver rows and rejected lines in one pass, with the marks that quality counts are made of."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.functions.text import PLAIN_LINE, fields_of, has_fields, matches, trimmed
from tidemart.plans.silver import Entity
from tidemart.sources.schemas import LAYERS, columns_of
from tidemart.sources.versions import VersionedTable

LINEAGE = "rawdata string, path_name string, load_date date"


def route(bronze: DataFrame, entity: Entity, as_of: dt.date | None = None) -> DataFrame:
    """Every bronze line once, for a write partitioned by ``outcome``.

    ``accepted`` rows hold the silver columns. ``rejected`` ones hold the line and the first
    ``reason`` that applies: ``no line`` (NULL), ``too few fields``, ``invalid key``. ``issues``
    has a bit for each quality rule that a line with enough fields breaks, in the order of the
    entity's rules, whatever becomes of it; it is stored beside the rows in the same
    files, so the counts last as long as they do.
    """
    day = "current_date()" if as_of is None else f"DATE '{as_of.isoformat()}'"
    lineage = ["rawdata", "path_name", "load_date"]
    parts = bronze.selectExpr(
        *lineage,
        f"stack(1, {fields_of('rawdata')}, {matches('rawdata', PLAIN_LINE)}) AS (parts, plain)",
    )
    fields = parts.selectExpr(
        *lineage,
        f"coalesce({has_fields('parts', entity.arity)}, false) AS usable",
        *[
            f"{trimmed(f'get(parts, {position})', 'plain')} AS {name}"
            for name, position in entity.positions.items()
        ],
    )
    bits = [
        f"IF(usable AND coalesce({rule}, false), {1 << bit}L, 0L)"
        for bit, rule in enumerate(entity.rules.values())
    ]
    assessed = entity.clean(fields, day).selectExpr(
        "*",
        f"""CASE WHEN rawdata IS NULL THEN 'no line' WHEN NOT usable THEN 'too few fields'
            WHEN NOT coalesce({entity.keep}, false) THEN 'invalid key' END AS reason""",
        f"{' + '.join(bits) or '0L'} AS issues",
    )
    return assessed.selectExpr(
        *[f"IF(reason IS NULL, {name}, NULL) AS {name}" for name in columns_of("silver", entity.table)],
        *[f"IF(reason IS NOT NULL, {name}, NULL) AS {name}" for name in lineage],
        "reason",
        "issues",
        "IF(reason IS NULL, 'accepted', 'rejected') AS outcome",
    )


class RoutedTables:
    """One table per entity under ``<root>/routed``: a folder of silver rows and one of rejected
    lines, written by one job from one scan."""

    def __init__(self, spark: SparkSession, root: str, entities: Mapping[str, Entity]):
        self.spark, self.root, self.entities = spark, root.rstrip("/"), entities

    def _table(self, name: str) -> VersionedTable:
        return VersionedTable(self.spark, f"{self.root}/routed/{name}")

    def _read(self, name: str) -> DataFrame:
        silver = LAYERS["silver"][name]
        return self._table(name).read(f"{silver}, {LINEAGE}, reason string, issues bigint, outcome string")

    def write(self, bronze: DataFrame, entity: Entity, as_of: dt.date | None = None) -> None:
        self._table(entity.table).replace(route(bronze, entity, as_of), "outcome")

    def accepted(self, name: str) -> DataFrame:
        return self._read(name).where("outcome = 'accepted'").select(*columns_of("silver", name))

    def rejected(self) -> DataFrame:
        """``table_name``, ``path_name``, ``load_date``, ``reason`` and ``rawdata`` of every line
        that no silver table has."""
        return reduce(
            DataFrame.unionByName,
            [
                self._read(name)
                .where("outcome = 'rejected'")
                .selectExpr(f"'{name}' AS table_name", "path_name", "load_date", "reason", "rawdata")
                for name in self.entities
            ],
        )

    def quality(self, per_file: bool = False) -> DataFrame:
        """``entity, rule, invalid_rows`` from the stored marks, one narrow column; ``per_file``
        keeps the counts of each data file apart, as ``file``."""
        counts = []
        for name, entity in self.entities.items():
            marks = self._read(name).selectExpr("issues", "_metadata.file_name AS file")
            sums = marks.groupBy(*["file"] * per_file).agg(
                *[
                    F.expr(f"count_if(issues & {1 << bit}L <> 0) AS {rule}")
                    for bit, rule in enumerate(entity.rules)
                ]
            )
            pairs = ", ".join(f"'{rule}', {rule}" for rule in entity.rules)
            counts.append(
                sums.selectExpr(
                    *["file"] * per_file,
                    f"'{name}' AS entity",
                    f"stack({len(entity.rules)}, {pairs}) AS (rule, invalid_rows)",
                )
            )
        return reduce(DataFrame.unionByName, counts)
