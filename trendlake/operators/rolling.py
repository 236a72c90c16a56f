"""E02 (W02): rolling aggregates over the last k calendar days, for days with gaps.

A frame reaches back by days, not by rows, so a missing day counts as nothing.  Rows are
first summed by key and day (partial sums before the shuffle); a long series is split
into stretches of days, and the days that a stretch's first frames reach back to are
sent along from the one before, so no window holds more than a stretch.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

EPOCH = "1970-01-01"


def rolling(df: DataFrame, keys: Sequence[str], date_col: str, measures: Sequence[str], days: Sequence[int] = (1, 7),
            stretch_days: int = 64) -> DataFrame:
    """``keys, date_col`` and, for each measure and k of ``days``, ``<measure>_sum_<k>d`` and
    ``<measure>_mean_<k>d`` (over the rows of these days with a value), and ``days_<k>d``, the days that have rows.

    One row per key and day that has rows. Null measures count as absent (a sum of none is
    null); rows without a date are left out; null keys form a series.
    """
    reach = max(days) - 1
    if not 0 <= reach < stretch_days:
        raise ValueError("a frame must be shorter than a stretch")
    daily = df.where(F.col(date_col).isNotNull()).groupBy(*keys, F.col(date_col).cast("date").alias(date_col)).agg(
        *[F.sum(m).alias(f"_s_{m}") for m in measures], *[F.count(m).alias(f"_n_{m}") for m in measures])
    day = F.datediff(date_col, F.lit(EPOCH).cast("date"))
    own = F.floor(F.col("_day") / stretch_days)
    ahead = F.when(F.pmod(F.col("_day"), F.lit(stretch_days)) >= stretch_days - reach, own + 1)  # a later stretch reaches back to it
    placed = daily.withColumn("_day", day).withColumn("_own", own).withColumn("_stretch", F.explode(F.array_compact(F.array(own, ahead))))
    w = {k: Window.partitionBy(*keys, "_stretch").orderBy("_day").rangeBetween(-(k - 1), 0) for k in days}
    out = {}
    for k in days:
        for m in measures:
            total, n = F.sum(f"_s_{m}").over(w[k]), F.sum(f"_n_{m}").over(w[k])
            out[f"{m}_sum_{k}d"] = total
            out[f"{m}_mean_{k}d"] = F.try_divide(total.cast("double"), n.cast("double"))
        out[f"days_{k}d"] = F.count(F.lit(1)).over(w[k])
    return placed.select("*", *[c.alias(n) for n, c in out.items()]).where(F.col("_stretch") == F.col("_own")).select(*keys, date_col, *out)
