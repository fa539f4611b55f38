"""Rules for customer, birth and location records. Inputs are already trimmed."""

from __future__ import annotations

from collections.abc import Mapping

from tidemart.functions.text import UNKNOWN, filled, literal, matches, recode

# Source codes and the labels they stand for.
MARITAL_LABELS = {"M": "Married", "S": "Single"}
GENDER_LETTERS = {"M": "Male", "F": "Female"}
GENDER_WORDS = {"male": "Male", "female": "Female"}
COUNTRY_NAMES = {
    "US": "United States",
    "USA": "United States",
    "United States": "United States",
    "United Kingdom": "United Kingdom",
    "Australia": "Australia",
    "Canada": "Canada",
    "France": "France",
    "Germany": "Germany",
    "DE": "Germany",
}

# How the three spellings of a customer key begin, and their digits.
CUSTOMER_KEY, BIRTH_KEY, LOCATION_KEY = "AW", "NASAW", "AW-"
KEY_DIGITS = 8


def _spelled(key: str, start: str, digits: int) -> str:
    return matches(key, rf"\A{start}[0-9]{{{digits}}}\z")


def customer_key(text: str, digits: int = KEY_DIGITS) -> str:
    """``AW`` and so many digits, upper-cased, else NULL."""
    key = f"upper({text})"
    return f"CASE WHEN {_spelled(key, CUSTOMER_KEY, digits)} THEN {key} END"


def customer_key_of_birth(text: str, digits: int = KEY_DIGITS) -> str:
    """Customer key carried by a ``NASAW…`` key, else NULL."""
    key = f"upper({text})"
    return f"CASE WHEN {_spelled(key, BIRTH_KEY, digits)} THEN substr({key}, 4) END"


def customer_key_of_location(text: str, digits: int = KEY_DIGITS) -> str:
    """Customer key carried by an ``AW-…`` key, else NULL."""
    key = f"upper({text})"
    return f"CASE WHEN {_spelled(key, LOCATION_KEY, digits)} THEN replace({key}, '-', '') END"


def full_name(first: str, last: str) -> str:
    """Both names, either one alone, or NULL when both are empty."""
    return filled(f"concat_ws(' ', {filled(first)}, {filled(last)})")


def marital_status(code: str) -> str:
    return recode(f"upper({code})", MARITAL_LABELS)


def gender_of_letter(code: str) -> str:
    return recode(f"upper({code})", GENDER_LETTERS)


def gender_of_word(word: str) -> str:
    return recode(f"lower({word})", GENDER_WORDS)


def country_name(text: str, names: Mapping[str, str] = COUNTRY_NAMES) -> str:
    """Standard country name; case matters and unlisted countries become NULL."""
    return recode(text, names)


def preferred_gender(first_choice: str, second_choice: str) -> str:
    return f"coalesce({first_choice}, {second_choice})"


def country_of_location(location_key: str, country: str) -> str:
    """NULL without a location row, ``'Unknown'`` for a row without a listed country."""
    return f"CASE WHEN {location_key} IS NOT NULL THEN coalesce({country}, {literal(UNKNOWN)}) END"
