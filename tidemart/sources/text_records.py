"""Decoding of JSON text records: tolerant, strict, or with the rejected ones kept."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, StringType, StructField, StructType

from tidemart.sources.raw import placed_lines

_CORRUPT = "_corrupt_record"
# No record can hold a mark that it cannot know.
_MARK = f"_end_{uuid.uuid4().hex}"

#: Where a record is: its file, the byte at which its split begins, and its row in that split.
PLACE = "file string, block bigint, row bigint"


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """``value`` and place (:data:`PLACE`) of every line of text files. Of very many files,
    rows are counted from the begin of the task that read several."""
    lines = placed_lines(spark, path)
    return lines.selectExpr("rawdata AS value", "file", "block", f"id & {(1 << 33) - 1}L AS row")


def _parsed(records: DataFrame, schema: str, column: str) -> tuple[DataFrame, Column]:
    """The records' columns with ``_parsed``, and whether a record was accepted.

    The parser stops at the end of the first value. In a list with a mark behind it, text that
    is not one object alone breaks the list or moves the mark, so one parse tells both what is
    in a record and whether anything follows it. ``explode`` of one row keeps filters from
    being pushed below the parse, which would then run again for each of them.
    """
    element = StructType([*StructType.fromDDL(schema).fields, StructField(_MARK, BooleanType())])
    target = StructType([StructField("list", ArrayType(element)), StructField(_CORRUPT, StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT, "allowSingleQuotes": "false"}
    listed = F.concat(F.lit('{"list":['), F.col(column), F.lit(f',{{"{_MARK}":true}}]}}'))
    parsed = records.select("*", F.explode(F.array(F.from_json(listed, target, options))).alias("_parsed"))
    found = F.col("_parsed.list")
    alone = (F.size(found) == 2) & F.get(found, F.lit(1))[_MARK] & F.get(found, F.lit(0)).isNotNull()
    return parsed, F.coalesce(alone & F.col(f"_parsed.{_CORRUPT}").isNull(), F.lit(False))


def _fields(schema: str) -> list[Column]:
    record = F.get(F.col("_parsed.list"), F.lit(0))
    return [record[name].alias(name) for name in StructType.fromDDL(schema).fieldNames()]


def decode_records(records: DataFrame, schema: str, column: str = "value") -> DataFrame:
    """Typed rows of the records that can be read; the others are dropped."""
    parsed, accepted = _parsed(records.select(column), schema, column)
    return parsed.where(accepted).select(*_fields(schema))


def decode_summary(records: DataFrame, schema: str, column: str = "value") -> DataFrame:
    """How many records :func:`decode_records` keeps and drops."""
    parsed, accepted = _parsed(records.select(column), schema, column)
    return parsed.agg(F.count_if(accepted).alias("accepted"), F.count_if(~accepted).alias("rejected"))


def decode_strict(
    records: DataFrame, schema: str, column: str = "value", place: tuple[str, ...] = ()
) -> DataFrame:
    """Typed rows of all records. A record that cannot be read stops the job; the message holds
    the ``place`` columns and how the record begins, also if no column of the rows is used."""
    parsed, accepted = _parsed(records.select(column, *place), schema, column)
    where = [F.concat(F.lit(f"{name} "), F.coalesce(F.col(name).cast("string"), F.lit("?"))) for name in place]
    excerpt = F.coalesce(F.substring(column, 1, 200), F.lit("NULL"))
    message = F.concat_ws(", ", F.lit("record cannot be decoded"), *where)
    checked = F.when(accepted, F.lit(True)).otherwise(F.raise_error(F.concat(message, F.lit(": "), excerpt)))
    return parsed.where(checked).select(*_fields(schema))


def route_records(
    records: DataFrame, schema: str, column: str = "value", place: tuple[str, ...] = ()
) -> DataFrame:
    """Every record once, for a write partitioned by ``outcome``: ``accepted`` rows hold the typed
    fields, ``rejected`` ones the record, why it was rejected (``reason``) and its ``place``."""
    parsed, accepted = _parsed(records.select(column, *place), schema, column)
    broken = F.col(f"_parsed.{_CORRUPT}").isNotNull()
    reason = (
        F.when(accepted, F.lit(None))
        .when(F.coalesce(F.trim(column), F.lit("")) == "", F.lit("empty"))
        .when(broken & F.col("_parsed.list").isNull(), F.lit("unreadable"))
        .when(broken, F.lit("wrong type"))
        .otherwise(F.lit("not one object"))
    )
    rejected = [F.when(~accepted, F.col(name)).alias(name) for name in (column, *place)]
    fields = [F.when(accepted, value).alias(name) for value, name in zip(_fields(schema), StructType.fromDDL(schema).fieldNames())]
    outcome = F.when(accepted, F.lit("accepted")).otherwise(F.lit("rejected"))
    return parsed.select(*fields, *rejected, reason.alias("reason"), outcome.alias("outcome"))
