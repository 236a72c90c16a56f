"""E07 (M07, M08): curves and errors of scored rows, without collecting them.

Rows are counted by distinct score first.  Cumulative counts then go over stretches of
scores with quantile borders: a window inside each stretch, and one over the few hundred
stretches' sums, so neither many rows nor one frequent score gathers in a task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

STRETCHES = 256


def threshold_counts(scored: DataFrame, score_col: str, label_col: str) -> DataFrame:
    """``threshold, positives, negatives, tp, fp, n_positive, n_negative`` per distinct score: rows with
    it, and rows with at least it, of either label. Rows without score or label are left out."""
    by_score = scored.where(F.col(score_col).isNotNull() & F.col(label_col).isNotNull()) \
        .groupBy(F.col(score_col).cast("double").alias("threshold")).agg(
            F.sum((F.col(label_col) > 0).cast("long")).alias("positives"), F.sum((F.col(label_col) <= 0).cast("long")).alias("negatives"))
    borders = by_score.agg(F.percentile_approx("threshold", [k / STRETCHES for k in range(1, STRETCHES)], 10_000).alias("b")).first()["b"] or []
    known = F.array(*[F.lit(b) for b in sorted(set(borders))]).cast("array<double>")  # a row of STRETCHES numbers
    placed = by_score.withColumn("_stretch", F.size(F.filter(known, lambda b: b < F.col("threshold"))))
    above = Window.orderBy(F.desc("_stretch")).rowsBetween(Window.unboundedPreceding, -1)  # STRETCHES rows
    whole = Window.partitionBy()
    sums = placed.groupBy("_stretch").agg(F.sum("positives").alias("p"), F.sum("negatives").alias("n")).select(
        "_stretch", F.coalesce(F.sum("p").over(above), F.lit(0)).alias("_p"), F.coalesce(F.sum("n").over(above), F.lit(0)).alias("_n"),
        F.sum("p").over(whole).alias("n_positive"), F.sum("n").over(whole).alias("n_negative"))
    down = Window.partitionBy("_stretch").orderBy(F.desc("threshold"))
    return placed.join(sums, "_stretch").select(
        "threshold", "positives", "negatives", (F.col("_p") + F.sum("positives").over(down)).alias("tp"),
        (F.col("_n") + F.sum("negatives").over(down)).alias("fp"), "n_positive", "n_negative")


def precision_recall(scored: DataFrame, score_col: str, label_col: str) -> DataFrame:
    """``threshold, tp, fp, precision, recall, false_positive_rate`` for every distinct score as the threshold."""
    c = threshold_counts(scored, score_col, label_col)
    return c.select("threshold", "tp", "fp", (F.col("tp") / (F.col("tp") + F.col("fp"))).alias("precision"),
                    F.try_divide(F.col("tp"), F.col("n_positive")).alias("recall"), F.try_divide(F.col("fp"), F.col("n_negative")).alias("false_positive_rate"))


def ranking_metrics(scored: DataFrame, score_col: str, label_col: str) -> DataFrame:
    """One row ``auc, average_precision, n_positive, n_negative``: the exact share of pairs in the
    right order (ties count half) and the mean precision at positives; null for one label only."""
    c = threshold_counts(scored, score_col, label_col)
    ordered = F.sum(F.col("negatives") * (F.col("tp") - F.col("positives") / 2))
    ap = F.sum(F.col("positives") * F.col("tp") / (F.col("tp") + F.col("fp")))
    return c.agg(ordered.alias("o"), ap.alias("a"), F.max("n_positive").alias("n_positive"), F.max("n_negative").alias("n_negative")).select(
        F.try_divide(F.col("o"), F.col("n_positive") * F.col("n_negative")).alias("auc"),
        F.try_divide(F.col("a"), F.col("n_positive")).alias("average_precision"), "n_positive", "n_negative")


def calibration(scored: DataFrame, score_col: str, label_col: str, bins: int = 10) -> DataFrame:
    """``bin, n, mean_score, positive_share, gap`` of equal ranges of a score in [0, 1]; the mean of
    ``gap`` weighted by ``n`` is the expected calibration error."""
    k = F.least(F.floor(F.col(score_col) * bins), F.lit(bins - 1)).cast("int")
    return scored.where(F.col(score_col).isNotNull() & F.col(label_col).isNotNull()).groupBy(k.alias("bin")).agg(
        F.count(F.lit(1)).alias("n"), F.avg(score_col).alias("mean_score"), F.avg((F.col(label_col) > 0).cast("double")).alias("positive_share")
    ).withColumn("gap", F.abs(F.col("mean_score") - F.col("positive_share")))


def regression_error(scored: DataFrame, prediction_col: str, label_col: str) -> DataFrame:
    """One row ``rmse, mae, n`` from the rows themselves."""
    d = F.col(prediction_col) - F.col(label_col)
    return scored.agg(F.sqrt(F.avg(d * d)).alias("rmse"), F.avg(F.abs(d)).alias("mae"), F.count(d).alias("n"))
