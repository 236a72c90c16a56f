"""Numeric expressions: guarded ratios, logs, infinities, probability extraction."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def guarded_ratio(num: str | Column, den: str | Column) -> Column:
    """``num / den`` when ``den > 0``, else null (negative den too)."""
    d = _c(den)
    return F.when(d > 0, _c(num).cast("double") / d)


def log1p(c: str | Column) -> Column:
    """``ln(1 + x)`` as double; null for x <= -1."""
    return F.log1p(_c(c).cast("double"))


def inf_to_null(c: str | Column) -> Column:
    """P20: +/-Infinity -> null, other values (NaN included) unchanged."""
    x = _c(c)
    return F.when(x.isin(float("inf"), float("-inf")), F.lit(None)).otherwise(x)


def row_max(*cols: str | Column) -> Column:
    """Row-wise max; nulls skipped, null only when all are null."""
    return F.greatest(*[_c(c) for c in cols])


def prob_of_class(vector_col: str | Column, cls: int = 1) -> Column:
    """Element ``cls`` of a probability vector; null when the vector is shorter."""
    from pyspark.ml.functions import vector_to_array

    return F.get(vector_to_array(_c(vector_col)), cls)
