"""Rules for product and category records. Inputs are already trimmed."""

from __future__ import annotations

from tidemart.functions.numbers import number
from tidemart.functions.text import NOT_AVAILABLE, filled, literal, recode

# Product line codes and maintenance flags.
LINE_LABELS = {"M": "Mountain", "R": "Road", "S": "Other Sales", "T": "Touring"}
MAINTENANCE_FLAGS = {"Yes": "Yes", "No": "No"}

# A composite product key is a 5-character category, a dash and the rest.
PRODUCT_ID_LENGTH = 3
CATEGORY_LENGTH = 5
PRODUCT_KEY_START = 7

_NONE = literal(NOT_AVAILABLE)


def category_key(text: str) -> str:
    """Five characters with an underscore in the middle, else NULL."""
    shaped = f"length({text}) = {CATEGORY_LENGTH} AND substr({text}, 3, 1) = '_'"
    return f"CASE WHEN {shaped} THEN {text} END"


def maintenance_flag(text: str) -> str:
    return recode(text, MAINTENANCE_FLAGS)


def product_id(text: str) -> str:
    return f"CASE WHEN length({text}) = {PRODUCT_ID_LENGTH} THEN {text} ELSE {_NONE} END"


def category_of_composite(text: str) -> str:
    """Category part of a composite key, spelled with an underscore."""
    part = f"replace(left({text}, {CATEGORY_LENGTH}), '-', '_')"
    return f"CASE WHEN {text} = '' THEN {_NONE} ELSE {part} END"


def product_key_of_composite(text: str) -> str:
    """Product part of a composite key; empty when the key ends before it."""
    return f"CASE WHEN {text} = '' THEN {_NONE} ELSE substr({text}, {PRODUCT_KEY_START}) END"


def product_name(text: str) -> str:
    return f"coalesce({filled(text)}, {_NONE})"


def product_cost(text: str) -> str:
    """Cost, with 0 for anything that is not a number of at least 0."""
    return f"coalesce(greatest({number(text)}, 0D), 0D)"


def product_line(code: str) -> str:
    return recode(f"upper({code})", LINE_LABELS, NOT_AVAILABLE)
