"""Left joins used by the gold layer."""

from __future__ import annotations

from typing import Literal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemart.functions.text import NOT_AVAILABLE, literal

NullKeys = Literal["match", "unmatched"]


def key_equality(left: str, right: str, null_keys: NullKeys) -> str:
    """Equality that lets NULL keys meet each other, or lets them meet nothing."""
    if null_keys not in ("match", "unmatched"):
        raise ValueError(f"null_keys must be 'match' or 'unmatched', not {null_keys!r}")
    return f"{left} {'<=>' if null_keys == 'match' else '='} {right}"


def with_real_key(right: DataFrame, key: str, null_keys: NullKeys) -> DataFrame:
    """Rows that a join may find by a key that says ``'N/A'`` when there is none."""
    return right if null_keys == "match" else right.where(f"{key} <> {literal(NOT_AVAILABLE)}")


def left_join(left: DataFrame, right: DataFrame, condition: str) -> DataFrame:
    return left.join(right, F.expr(condition), "left")


def fan_out(
    left: DataFrame,
    right: DataFrame,
    left_key: str,
    right_key: str,
    null_keys: NullKeys,
    hot: bool = True,
) -> DataFrame:
    """Left rows with ``row_weight``: how many rows a left join on the keys makes of each.

    The right side shrinks to one row per key first, so no pair of rows is ever built.
    A ``row_weight`` that the left rows already carry is multiplied, which chains joins;
    ``left_rows`` keeps it as it was and ``copies`` is this join's own factor.

    With ``hot`` left keys both ways of treating NULL keys use the null-safe join. Its keys are
    not those the counting was partitioned by, so both sides are shuffled for the join
    itself, and adaptive execution can split a hot left key. Left rows that were summed by
    their key before are few a key, and keep the partitioning that they have.
    """
    carried = "row_weight" if "row_weight" in left.columns else "1L"
    kept = [column for column in left.columns if column != "row_weight"]
    matching = right if null_keys == "match" else right.where(f"{right_key} IS NOT NULL")
    partners = matching.groupBy(F.expr(right_key).alias("partner_key")).agg(
        F.count("*").alias("partners")
    )
    equality = key_equality(left_key, "partner_key", "match" if hot else null_keys)
    return left_join(left, partners, equality).selectExpr(
        *kept,
        f"{carried} AS left_rows",
        "partners IS NOT NULL AS matched",
        "coalesce(partners, 1) AS copies",
        f"{carried} * coalesce(partners, 1) AS row_weight",
    )
