"""E10 (M09): drift of features against a reference slice, by population stability.

The bins are quantiles of the reference, fixed once and kept with the model; each later
slice is counted in the same bins in one pass over all features.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A share below this counts as this, so an empty bin has a finite part.
FLOOR = 1e-4


def fit_edges(reference: DataFrame, features: Sequence[str], bins: int = 10, accuracy: int = 10_000) -> dict[str, list[float]]:
    """Inner edges of quantile bins (rank error 1 / accuracy); equal edges are one, a feature
    without values has none. One row comes to the driver."""
    at = [k / bins for k in range(1, bins)]
    finite = {c: F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double")) for c in features}
    row = reference.agg(*[F.percentile_approx(finite[c], at, accuracy).alias(c) for c in features]).first()
    return {c: sorted(set(row[c] or [])) for c in features}


def bin_counts(df: DataFrame, edges: Mapping[str, Sequence[float]]) -> DataFrame:
    """``feature, bin, n``: bin k holds the values above k edges; nulls and NaN are bin -1."""
    bins = []
    for c, es in edges.items():
        v = F.col(c).cast("double")
        k = F.lit(0)
        for e in es:
            k = k + (v > F.lit(float(e))).cast("int")
        bins.append(F.struct(F.lit(c).alias("feature"), F.when(v.isNull() | F.isnan(v), F.lit(-1)).otherwise(k).alias("bin")))
    return df.select(F.explode(F.array(*bins)).alias("b")).groupBy("b.feature", "b.bin").agg(F.count(F.lit(1)).alias("n"))


def stability(reference: DataFrame, current: DataFrame, edges: Mapping[str, Sequence[float]]) -> DataFrame:
    """``feature, psi, n_reference, n_current``. The counts of both sides are a few rows per feature;
    a side without rows gives null."""
    both = bin_counts(reference, edges).select("feature", "bin", F.col("n").alias("r"), F.lit(0).cast("long").alias("c")).unionByName(
        bin_counts(current, edges).select("feature", "bin", F.lit(0).cast("long").alias("r"), F.col("n").alias("c")))
    counts = both.groupBy("feature", "bin").agg(F.sum("r").alias("r"), F.sum("c").alias("c"))
    totals = counts.groupBy("feature").agg(F.sum("r").alias("n_reference"), F.sum("c").alias("n_current"))

    def share(n, total):
        return F.greatest(F.try_divide(F.col(n).cast("double"), F.col(total).cast("double")), F.lit(FLOOR))

    r, c = share("r", "n_reference"), share("c", "n_current")
    part = F.when((F.col("n_reference") > 0) & (F.col("n_current") > 0), (c - r) * F.ln(c / r))
    return counts.join(totals, "feature").groupBy("feature").agg(
        F.sum(part).alias("psi"), F.first("n_reference").alias("n_reference"), F.first("n_current").alias("n_current"))
