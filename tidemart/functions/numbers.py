"""Rules for numeric text."""

from __future__ import annotations

from tidemart.functions.text import matches

# Fixed patterns: plain decimal notation keeps out NaN, infinities and Java suffixes such
# as "1d", all of which a bare cast to double would take.
DECIMAL = r"\A[+-]?(?:[0-9]+(?:[.][0-9]*)?|[.][0-9]+)(?:[eE][+-]?[0-9]+)?\z"
DIGITS = r"\A[0-9]+\z"


def number(text: str) -> str:
    """Double, or NULL when the text is not a finite number."""
    value = f"try_cast({text} AS DOUBLE)"
    finite = f"{matches(text, DECIMAL)} AND abs({value}) < double('Infinity')"
    return f"CASE WHEN {finite} THEN {value} END"


def digits_only(text: str) -> str:
    """BIGINT of a text made only of ASCII digits, else NULL."""
    return f"CASE WHEN {matches(text, DIGITS)} THEN try_cast({text} AS BIGINT) END"


def cents(value: str) -> str:
    """Two decimals, rounded from the exact binary value with ties to even.

    ``round`` goes by the shortest decimal text of a double instead and turns 4700.525,
    which is stored as slightly less, into 4700.53.
    """
    return f"try_cast(format_number({value}, '0.00') AS DOUBLE)"
