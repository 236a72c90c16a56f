"""E09 (A09): daily summary tables that are merged by day, without a second look at the rows.

Sums and counts merge exactly.  Distinct counts and quantiles are kept as sketches:
HyperLogLog with 2^12 registers (relative standard error 1.04 / 64 = 1.6 %; three of them
are ``DISTINCT_BOUND``) and KLL with k = 200 (normalised rank error 1.65 % for a
two-sided interval at 99 %, ``RANK_BOUND``).  A merged sketch keeps its bound.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

REGISTERS_LOG2, KLL_K = 12, 200
DISTINCT_BOUND, RANK_BOUND = 3 * 1.04 / 2 ** (REGISTERS_LOG2 / 2), 0.0165


def daily_summary(df: DataFrame, keys: Sequence[str], item_col: str, value_col: str) -> DataFrame:
    """A row per key: ``n_rows, total, least, greatest, items_sketch, values_sketch``. The keys include
    the day, so a day's partition is written (and rewritten) by itself. Sketches are partial
    aggregates: a hot key ships one per task. Nulls count in ``n_rows`` only."""
    value = F.col(value_col).cast("bigint")
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum(value).alias("total"), F.min(value).alias("least"), F.max(value).alias("greatest"),
        F.hll_sketch_agg(F.col(item_col).cast("string"), F.lit(REGISTERS_LOG2)).alias("items_sketch"),
        F.kll_sketch_agg_bigint(value, F.lit(KLL_K)).alias("values_sketch"))


def merge_summaries(table: DataFrame, keys: Sequence[str], quantiles: Sequence[float] = (0.5,)) -> DataFrame:
    """Daily rows merged to coarser ``keys`` (a month, a region, everything): exact ``n_rows, total, least,
    greatest``, ``distinct_items`` and ``q<percent>`` from the sketches."""
    merged = table.groupBy(*keys).agg(
        F.sum("n_rows").alias("n_rows"), F.sum("total").alias("total"), F.min("least").alias("least"), F.max("greatest").alias("greatest"),
        F.hll_sketch_estimate(F.hll_union_agg("items_sketch")).alias("distinct_items"), F.kll_merge_agg_bigint("values_sketch", F.lit(KLL_K)).alias("_values"))
    return merged.select(*keys, "n_rows", "total", "least", "greatest", "distinct_items",
                         *[F.kll_sketch_get_quantile_bigint("_values", F.lit(q)).alias(f"q{round(q * 100)}") for q in quantiles])
