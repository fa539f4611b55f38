"""Rules for calendar dates."""

from __future__ import annotations

from tidemart.functions.text import NOT_AVAILABLE, literal, matches

# Fixed patterns. Year 0000 is no calendar year. The cast that follows each pattern
# returns NULL for days that do not exist.
DASHED = r"\A(?!0000)[0-9]{4}-[0-9]{2}-[0-9]{2}\z"
COMPACT = r"\A(?!0000)[0-9]{8}\z"

# English month names in calendar order, so that no locale matters.
MONTHS = (
    "January", "February", "March", "April", "May", "June",
    "July", "August", "September", "October", "November", "December",
)


def dashed_date(text: str) -> str:
    """DATE of ``YYYY-MM-DD``, else NULL."""
    return f"CASE WHEN {matches(text, DASHED)} THEN try_cast({text} AS DATE) END"


def compact_date(text: str) -> str:
    """DATE of ``YYYYMMDD``, else NULL."""
    dashed = f"concat_ws('-', left({text}, 4), substr({text}, 5, 2), substr({text}, 7, 2))"
    return f"CASE WHEN {matches(text, COMPACT)} THEN try_cast({dashed} AS DATE) END"


def compact_date_issue(text: str, day: str) -> str:
    """Why :func:`compact_date` of the text gave no ``day``: ``missing``, ``bad_length``
    or ``bad_date``."""
    return (
        f"CASE WHEN {text} = '' THEN 'missing' WHEN length({text}) <> 8 THEN 'bad_length' "
        f"WHEN {day} IS NULL THEN 'bad_date' END"
    )


def completed_years(birth: str, as_of: str) -> str:
    """Whole years lived on ``as_of``; a 29 February birthday counts from 1 March."""
    early = (
        f"month({as_of}) * 100 + day({as_of}) < month({birth}) * 100 + day({birth})"
    )
    return f"year({as_of}) - year({birth}) - CAST({early} AS INT)"


def month_label(month: str) -> str:
    """English name of a month number 1 to 12."""
    return f"elt({month}, {', '.join(literal(name) for name in MONTHS)})"


def date_text(day: str, issue: str | None = None) -> str:
    """Text form of a cleaned date: NULL dates read ``'N/A'``.

    With the ``issue`` column of an order date, a wrong-length source value stays NULL.
    """
    text = f"coalesce(CAST({day} AS STRING), {literal(NOT_AVAILABLE)})"
    if issue is None:
        return text
    return f"CASE WHEN {issue} <=> 'bad_length' THEN NULL ELSE {text} END"
