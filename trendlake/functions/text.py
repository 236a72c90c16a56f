"""Text expressions: title cleaning, labels, regex capture, display formats."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# These patterns define the cleaned-title and path-key contracts.
URL_PATTERN = r"http[s]?://\S+"
SPACE_RUN_PATTERN = r"\s+"
NON_ASCII_PATTERN = r"[^\x00-\x7F]+"
ELLIPSIS = "..."


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_urls(c: str | Column) -> Column:
    """Remove ``http(s)://`` tokens."""
    return F.regexp_replace(_c(c), URL_PATTERN, "")


def collapse_spaces(c: str | Column) -> Column:
    """Each whitespace run becomes one space; edges are not trimmed."""
    return F.regexp_replace(_c(c), SPACE_RUN_PATTERN, " ")


def clean_title(c: str | Column) -> Column:
    """Lower-case, strip URLs, collapse whitespace (in that order)."""
    return collapse_spaces(strip_urls(F.lower(_c(c))))


def regex_capture(c: str | Column, pattern: str, group: int = 1) -> Column:
    """Capture group, ``''`` when the pattern does not match."""
    return F.regexp_extract(_c(c), pattern, group)


def ascii_only(c: str | Column) -> Column:
    """Drop non-ASCII runs; null becomes ``''``."""
    return F.coalesce(F.regexp_replace(_c(c), NON_ASCII_PATTERN, ""), F.lit(""))


def short_label(c: str | Column, n: int = 40) -> Column:
    """ASCII-only first ``n`` characters followed by ``...`` (always appended)."""
    return F.concat(F.substring(ascii_only(c), 1, n), F.lit(ELLIPSIS))


def prefix(c: str | Column, n: int) -> Column:
    """First ``n`` characters, no ellipsis."""
    return F.substring(_c(c), 1, n)


def percent_string(c: str | Column, digits: int = 2) -> Column:
    """Probability -> ``'97.5%'`` (rounded, no zero padding)."""
    return F.concat(F.round(_c(c) * 100, digits).cast("string"), F.lit("%"))


def yes_no(c: str | Column) -> Column:
    """1.0 -> Yes, 0.0 -> No, anything else -> null."""
    x = _c(c)
    return F.when(x == 1.0, F.lit("Yes")).when(x == 0.0, F.lit("No"))


def null_label(c: str | Column, label: str = "None") -> Column:
    """X11: null category rendered as a string."""
    return F.coalesce(_c(c).cast("string"), F.lit(label))
