"""Rules shared by every text field."""

from __future__ import annotations

from collections.abc import Mapping

NOT_AVAILABLE = "N/A"
UNKNOWN = "Unknown"

# Every character Unicode text handling treats as white space.
WHITE_SPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def literal(text: str) -> str:
    """SQL string literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def matches(text: str, pattern: str) -> str:
    """Does the text match the regular expression?"""
    return f"({text}) RLIKE r'{pattern}'"


# Fixed pattern: a line whose only white space, if any, is the blank.
PLAIN_LINE = r"\A[ -~]*\z"


def trimmed(text: str, plain: str) -> str:
    """Strip white space of any kind. A ``plain`` text takes the short way: there a
    ``trim``, which strips blanks alone, does the same at a fraction of the cost."""
    return f"IF({plain}, trim({text}), btrim({text}, {literal(WHITE_SPACE)}))"


def filled(text: str) -> str:
    """NULL when the text is empty."""
    return f"nullif({text}, '')"


def recode(code: str, labels: Mapping[str, str], default: str | None = None) -> str:
    """Replace each known code by its label; anything else becomes ``default``."""
    cases = " ".join(f"WHEN {literal(value)} THEN {literal(label)}" for value, label in labels.items())
    other = "" if default is None else f" ELSE {literal(default)}"
    return f"CASE {code} {cases}{other} END"


def fields_of(line: str) -> str:
    """Every comma separates; there is no quoting."""
    return f"split({line}, ',')"


def has_fields(parts: str, arity: int) -> str:
    return f"size({parts}) >= {arity}"


def or_not_available(value: str, matched: str) -> str:
    """``'N/A'`` for a row without a join partner; a partner's own NULL stays NULL."""
    return f"CASE WHEN {matched} THEN CAST({value} AS STRING) ELSE {literal(NOT_AVAILABLE)} END"
