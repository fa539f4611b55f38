"""Rules for sales records. Inputs are already trimmed."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tidemart.functions.numbers import cents
from tidemart.functions.text import NOT_AVAILABLE, literal, matches

# Order numbers are case-sensitive; they and customer ids have a fixed length.
ORDER_NUMBER_LENGTH = 7
CUSTOMER_ID_LENGTH = 5

_NONE = literal(NOT_AVAILABLE)


def order_number(text: str, length: int = ORDER_NUMBER_LENGTH) -> str:
    """``SO`` and letters or digits, else ``'N/A'``."""
    pattern = rf"\ASO[0-9A-Za-z]{{{length - 2}}}\z"
    return f"CASE WHEN {matches(text, pattern)} THEN {text} ELSE {_NONE} END"


def sold_product_key(text: str) -> str:
    """Any text whose third character is a dash, else ``'N/A'``."""
    return f"CASE WHEN substr({text}, 3, 1) = '-' THEN {text} ELSE {_NONE} END"


def buyer_id(text: str, length: int = CUSTOMER_ID_LENGTH) -> str:
    """BIGINT of a customer id of so many characters, else NULL."""
    return f"CASE WHEN length({text}) = {length} THEN try_cast({text} AS BIGINT) END"


def reconcile_amounts(df: DataFrame, amount: str, quantity: str, price: str) -> DataFrame:
    """Make line amount, quantity and unit price agree; replaces the three columns.

    Quantity is settled first, since the others lean on it: missing or not positive
    becomes 1. A missing or negative amount becomes 0. A missing or not positive price is
    amount over quantity. An amount that then differs from quantity times price, to the
    cent, gives way. Quantity is never 0, so the division is safe.
    """
    others = [f"`{name}`" for name in df.columns if name not in (amount, quantity, price)]
    settled = df.selectExpr(
        *others,
        f"IF({quantity} > 0, {quantity}, 1D) AS {quantity}",
        f"IF({amount} >= 0, {amount}, 0D) AS {amount}",
        price,
    )
    priced = settled.selectExpr(
        *others, quantity, amount, f"IF({price} > 0, {price}, {amount} / {quantity}) AS {price}"
    )
    product = f"{quantity} * {price}"
    # Rounding is dear and equal numbers round alike, so only unequal ones are rounded.
    apart = f"{amount} <> {product} AND {cents(amount)} <> {cents(product)}"
    return priced.selectExpr(
        *others,
        f"IF({apart}, {product}, {amount}) AS {amount}",
        quantity,
        price,
    )
