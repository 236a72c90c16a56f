"""Snapshot features and next-day labels (lags, velocities, ratios, logs, labels).

Plan shape: one exchange on ``(region, video_id)`` feeds a single Window
node computing all lag/lead columns; the sentiment join reuses that
partitioning when ``spark.sql.requireAllClusterKeysForCoPartition=false``
(``session.FEATURE_CONF``, set around the feature job) or is broadcast by AQE when the aggregate is
small at runtime.  Window groups are bounded: curation keeps at most one
snapshot per ``(region, video_id, day)``, so a group holds at most one row per
day of history no matter how large the data grows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trendlake.functions.dates import day_diff

# The columns of the sentiment contract and their fill.
SERIES_KEYS = ("region", "video_id")
SENTIMENT_KEYS = ("video_id", "region", "ingest_date")
SENTIMENT_FILL = {
    "avg_comment_sent_pos": 0.0,
    "avg_comment_sent_neg": 0.0,
    "avg_comment_sent_neu": 0.0,
    "avg_comment_sent_mix": 0.0,
    "net_comment_sentiment": 0.0,
    "comment_count_scored": 0,
}


def series_window(order: str = "ingest_date") -> Window:
    return Window.partitionBy(*SERIES_KEYS).orderBy(order)


def with_ingest_date(trending: DataFrame) -> DataFrame:
    """Curated trending -> the snapshot frame keyed by ``ingest_date`` (F02 applied)."""
    df = trending
    if "ingest_date" not in df.columns:
        df = df.withColumn("ingest_date", F.to_date("trending_date"))
    return df.dropna(subset=["video_id", "region", "ingest_date"])


def add_lag_lead(df: DataFrame) -> DataFrame:
    """K01 (W02 + W03): previous counts/date and next views/date per series."""
    w = series_window()
    return df.withColumns(
        {
            "prev_view_count": F.lag("view_count").over(w),
            "prev_like_count": F.lag("like_count").over(w),
            "prev_comment_count": F.lag("comment_count").over(w),
            "prev_ingest_date": F.lag("ingest_date").over(w),
            "next_view_count": F.lead("view_count").over(w),
            "next_ingest_date": F.lead("ingest_date").over(w),
        }
    )


def add_delta_days(df: DataFrame) -> DataFrame:
    """Days since the previous snapshot, 1 for the first one."""
    return df.withColumn(
        "delta_days",
        F.when(F.col("prev_ingest_date").isNotNull(), day_diff("ingest_date", "prev_ingest_date"))
        .otherwise(F.lit(1)),
    )


def _ratio(num: Column, den: Column) -> Column:
    return F.try_divide(num.cast("double"), den.cast("double"))


def add_engagement(df: DataFrame) -> DataFrame:
    """K03-K13 in one projection.  Division by zero yields null (ANSI stays on)."""
    v, l, c = F.col("view_count"), F.col("like_count"), F.col("comment_count")
    pv, pl, pc = F.col("prev_view_count"), F.col("prev_like_count"), F.col("prev_comment_count")
    one = F.lit(1.0)
    return df.withColumns(
        {
            "view_velocity": _ratio(v - pv, F.col("delta_days")),
            "like_velocity": (l - pl).cast("double"),
            "comment_velocity": (c - pc).cast("double"),
            "view_growth_ratio": _ratio(v, pv + one),
            "like_growth_ratio": _ratio(l, pl + one),
            "comment_growth_ratio": _ratio(c, pc + one),
            "like_view_ratio": _ratio(l, v + one),
            "comment_view_ratio": _ratio(c, v + one),
            "engagement_per_view": _ratio(l + c, v + one),
            "video_age_days": day_diff("ingest_date", F.to_date("published_at")).cast("double"),
            "log_view_count": F.log1p(v.cast("double")),
            "log_like_count": F.log1p(l.cast("double")),
            "log_comment_count": F.log1p(c.cast("double")),
        }
    )


def add_labels(df: DataFrame) -> DataFrame:
    """K14 + K15: next-day log views, growth label and stay-trending label."""
    out = df.withColumn("log_next_view_count", F.log1p(F.col("next_view_count").cast("double")))
    return out.withColumns(
        {
            "log_view_growth_next": F.col("log_next_view_count") - F.col("log_view_count"),
            "stay_trending_next": F.when(F.col("next_ingest_date").isNotNull(), F.lit(1.0))
            .otherwise(F.lit(0.0))
            .cast("double"),
        }
    )


def join_sentiment(
    df: DataFrame, sentiment: DataFrame, keys: Sequence[str] = SENTIMENT_KEYS
) -> DataFrame:
    """J01 + P13: left join the per-day sentiment aggregate; missing scores -> 0.

    ``has_sentiment`` records whether a sentiment row existed (Q10), since the
    zero fill is otherwise indistinguishable from a real all-zero aggregate.
    """
    cols = [c for c in SENTIMENT_FILL if c in sentiment.columns]
    right = sentiment.select(*keys, *cols).withColumn("has_sentiment", F.lit(True))
    out = df.join(right, list(keys), "left")
    return out.fillna({c: SENTIMENT_FILL[c] for c in cols}).fillna({"has_sentiment": False})


def latest_date(df: DataFrame, col: str = "ingest_date") -> Column:
    """F07 + A03: the global max as a scalar subquery (no driver round trip)."""
    return df.select(F.max(col)).scalar()


#: Regions are countries or markets; a map of more says that the key is not a region.
MAX_REGIONS = 10_000


def region_max(source: DataFrame, col: str = "ingest_date") -> Column:
    """Each row's own region's latest date, from one scalar subquery holding a map. No
    shuffle of the rows that are compared: a region may hold a third of them."""
    per = source.where(F.col("region").isNotNull()).groupBy("region").agg(F.max(col).alias("m"))
    whole = per.agg(F.when(F.count(F.lit(1)) <= MAX_REGIONS, F.map_from_entries(F.collect_list(F.struct("region", "m"))))
                    .otherwise(F.raise_error(F.lit(f"more than {MAX_REGIONS} regions"))).alias("by_region"))
    return F.try_element_at(whole.scalar(), F.col("region"))


def keep_latest(df: DataFrame, source: DataFrame | None = None, by: str = "global") -> DataFrame:
    """Rows of the latest snapshot date — globally (reference) or per region (Q8).

    The max is taken from ``source`` (default ``df``); pass the scan the
    features came from so the subquery reads one column instead of
    recomputing the windowed lineage.
    """
    src = source if source is not None else df
    if by == "global":
        return df.filter(F.col("ingest_date") == latest_date(src))
    if by == "region":
        return df.filter(F.col("ingest_date") == region_max(src))
    raise ValueError(f"unknown latest_by {by!r}")


def keep_matured(df: DataFrame, source: DataFrame | None = None) -> DataFrame:
    """Rows older than their region's latest snapshot: labels have seen a later day (Q4/Q7)."""
    return df.filter(F.col("ingest_date") < region_max(source if source is not None else df))


def keep_renewed(df: DataFrame, days: Sequence[str] | None = None) -> DataFrame:
    """Whole ``(region, ingest_date)`` partitions that a run for ``days`` changes: those
    days, the previous snapshot of every series seen then (its labels mature, however
    long the gap), and the next one (its lags change, when a day is landed late).
    ``days`` None: the latest day.

    ``df`` has its lags and leads. The list of partitions is distinct dates per region.
    """
    day = F.col("ingest_date").isin(*[F.lit(d).cast("date") for d in days]) if days is not None else F.col("ingest_date") == latest_date(df)
    touched = df.where(day).select("region", F.explode(F.array_compact(F.array(
        "ingest_date", "prev_ingest_date", "next_ingest_date"))).alias("ingest_date")).distinct()
    return df.join(touched, ["region", "ingest_date"], "left_semi")


def build_features(
    trending: DataFrame,
    sentiment: DataFrame | None = None,
    output: str = "all",
    latest_by: str = "global",
    days: Sequence[str] | None = None,
) -> DataFrame:
    """Jobs 4/4b: labeled feature rows.

    ``output``: ``"all"`` (backfill), ``"latest"`` (the daily slice: rows of
    the latest date, whose labels are necessarily empty — Q4), ``"renewed"``
    (the partitions that a run for ``days`` changes, see ``keep_renewed``) or
    ``"matured"`` (rows whose region has a later snapshot).  The slice is
    applied after the window (history is needed) but before the sentiment
    join, so the join only touches the output rows.
    """
    snaps = with_ingest_date(trending)
    feats = add_labels(add_engagement(add_delta_days(add_lag_lead(snaps))))
    if output == "latest":
        feats = keep_latest(feats, snaps.select("region", "ingest_date"), latest_by)
    elif output == "renewed":
        feats = keep_renewed(feats, days)
    elif output == "matured":
        feats = keep_matured(feats, snaps.select("region", "ingest_date"))
    elif output != "all":
        raise ValueError(f"unknown output {output!r}")
    if sentiment is not None:
        feats = join_sentiment(feats, sentiment)
    return feats
