"""Date/time expressions.  ANSI mode stays on; parsing uses the ``try_`` forms."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_timestamp(c: str | Column) -> Column:
    """ISO-8601 string -> timestamp, null when malformed."""
    return F.try_to_timestamp(_c(c))


def parse_date(c: str | Column, fmt: str | None = None) -> Column:
    """string/timestamp -> date, null when malformed (``''`` included)."""
    x = _c(c)
    return F.try_to_date(x, fmt) if fmt else F.try_to_date(x.cast("string"))


def date_parts(ts: str | Column, prefix: str = "published") -> dict[str, Column]:
    """``{prefix}_date/_hour/_year/_week`` (ISO week, int)."""
    t = _c(ts)
    return {
        f"{prefix}_date": F.to_date(t),
        f"{prefix}_hour": F.hour(t),
        f"{prefix}_year": F.year(t),
        f"{prefix}_week": F.weekofyear(t).cast("int"),
    }


def day_diff(end: str | Column, start: str | Column) -> Column:
    """Whole days from ``start`` to ``end`` (int)."""
    return F.datediff(_c(end), _c(start))


def days_before(d: str | Column, n: int) -> Column:
    """``d - n days``."""
    return F.date_sub(_c(d), n)
