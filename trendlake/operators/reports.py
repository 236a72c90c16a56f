"""Report operators: top-N, trending x comments, sentiment dashboards, summaries.

Top-N reports are ``orderBy(...).limit(n)`` which Spark plans as
``TakeOrderedAndProject``: each task keeps its own top ``n`` and only those
reach the final merge, so the cost is one scan regardless of data size.
Every ordering carries a unique tie-breaker so a limit is deterministic.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trendlake.functions.numeric import guarded_ratio
from trendlake.functions.text import null_label, percent_string, prefix, yes_no

# Fixed values of the data contract, as are the output names of the reports below.
TOP_COLUMNS = (
    "video_id", "title", "channel_id", "region", "trending_date", "view_count", "like_count", "comment_count",
)


def top_n(df: DataFrame, n: int, order: Sequence[Column], cols: Sequence[str] | None = None) -> DataFrame:
    """The first ``n`` rows by ``order`` (a total order)."""
    out = df.orderBy(*order)
    if cols:
        out = out.select(*cols)
    return out.limit(n)


def top_videos(df: DataFrame, n: int = 200) -> DataFrame:
    """Most viewed snapshots (non-null views), dashboard columns."""
    return top_n(
        df.filter(F.col("view_count").isNotNull()),
        n,
        [F.col("view_count").desc(), F.col("region"), F.col("trending_date"), F.col("video_id")],
        TOP_COLUMNS,
    )


def top_videos_by_region(
    df: DataFrame,
    region: str | None = None,
    top_n_rows: int = 20,
    as_of: _dt.date | str | Column | None = None,
) -> DataFrame:
    """O02 (F04 + F06 + F03 + O01): top videos of one day, optionally one region.

    ``as_of`` replaces ``current_date()`` so the report is reproducible; pass
    ``F.current_date()`` for the live dashboard.  Both predicates are on the
    table's partition columns, so they prune directories at the scan.
    """
    out = df
    if region is not None:
        out = out.filter(F.col("region") == F.lit(region))
    if as_of is not None:
        day = as_of if isinstance(as_of, Column) else F.lit(as_of).cast("date")
        out = out.filter(F.col("trending_date") == day)
    return top_videos(out, top_n_rows)


def top_per_group(df: DataFrame, keys: Sequence[str], n: int, order: Sequence[Column]) -> DataFrame:
    """Top ``n`` rows per group (row_number <= n -> partial ``WindowGroupLimit``)."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(w)).filter(F.col("_rank") <= n).drop("_rank")


# ---- trending x comments report (SQL reports, DataFrame form) ---------------

def comments_per_video(comments: DataFrame, keys: Sequence[str] = ("region", "date", "video_id")) -> DataFrame:
    """Comment count and mean comment likes per video and day."""
    return comments.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("comment_count"),
        F.avg("like_count").alias("avg_comment_likes"),
    )


def trending_report(
    trending_items: DataFrame,
    comment_rows: DataFrame,
    region: str,
    date: str,
    order_by: str = "views",
    n: int = 20,
) -> DataFrame:
    """J02 + J05 + P12 + F05 + O03/O04: trending rows of one region/day with
    their comment activity, top ``n`` by ``views`` or ``comment_count``.

    The region/date predicate is applied to both inputs before the aggregate
    and the join (Catalyst would push it there anyway), so only one
    partition's rows are aggregated and joined.
    """
    keys = ["region", "date", "video_id"]
    t = trending_items.filter((F.col("region") == region) & (F.col("date") == F.lit(date).cast("date")))
    c = comment_rows.filter((F.col("region") == region) & (F.col("date") == F.lit(date).cast("date")))
    cf = comments_per_video(c, keys)
    out = t.join(cf, keys, "left").select(
        "region", "date", "video_id", "title", "channel", "video_published_at", "views", "video_likes",
        F.coalesce(F.col("comment_count"), F.lit(0)).alias("comment_count"),
        F.coalesce(F.col("avg_comment_likes"), F.lit(0.0)).alias("avg_comment_likes"),
    )
    first = F.col(order_by).desc()
    return top_n(out, n, [first, F.col("video_id")])


def harvest_summary(trending_docs: DataFrame, comments: DataFrame) -> DataFrame:
    """Per region — trending items, distinct videos with an id, comments landed.

    ``comments`` has a row per comment; they are counted, not gathered.
    """
    items = trending_docs.select("region", F.explode("items").alias("i")).groupBy("region").agg(
        F.count(F.lit(1)).alias("trending_item_count"),
        F.count_distinct(F.col("i.id")).alias("video_count"),
    )
    landed = comments.groupBy("region").agg(F.count(F.lit(1)).alias("total_comments"))
    return items.join(landed, "region", "full").select(
        "region",
        F.coalesce("trending_item_count", F.lit(0)).alias("trending_item_count"),
        F.coalesce("video_count", F.lit(0)).alias("video_count"),
        F.coalesce("total_comments", F.lit(0)).alias("total_comments"),
    )


# ---- sentiment dashboards --------------------------------------------------

def top_with_sentiment(
    top: DataFrame, sentiment_labeled: DataFrame, keys: Sequence[str] = ("video_id", "region", "trending_date")
) -> DataFrame:
    """Top videos left-joined to labeled sentiment (its ``ingest_date`` is
    matched to the snapshot's ``trending_date``).

    ``keys=("video_id",)`` reproduces the dashboard's join, which fans out over
    every region/day of a video (Q9); the default matches one snapshot.
    """
    s = sentiment_labeled.withColumnRenamed("ingest_date", "trending_date").select(
        *keys, "max_comment_sentiment", "dominant_sentiment", "comment_count_scored"
    )
    return top.join(s, list(keys), "left").select(
        "video_id", *[k for k in keys if k != "video_id"], "title", "view_count", "like_count", "comment_count",
        "max_comment_sentiment", "dominant_sentiment", "comment_count_scored",
    )


def ranked(df: DataFrame, *order: Column) -> DataFrame:
    """A small report sorted, with its 1-based ``rank``; for results of a few rows
    (one per label), since one task sorts them."""
    return df.withColumn("rank", F.row_number().over(Window.orderBy(*order))).orderBy("rank")


def sentiment_counts(df: DataFrame, distinct: bool = False) -> DataFrame:
    """A05/A06 + X11: videos per dominant label (rows, or distinct video ids)."""
    agg = F.count_distinct("video_id") if distinct else F.count(F.lit(1))
    per = df.groupBy(null_label("dominant_sentiment").alias("dominant_sentiment")).agg(
        agg.alias("total_trending_videos")
    )
    return ranked(per, F.col("total_trending_videos").desc(), F.col("dominant_sentiment"))


def sentiment_means(df: DataFrame) -> DataFrame:
    """A08 + K18 + P19: mean views, like ratio and comment/view ratio per label."""
    m = df.withColumns(
        {
            "like_ratio": guarded_ratio("like_count", "view_count"),
            "comment_view_ratio": guarded_ratio("comment_count", "view_count"),
        }
    )
    per = m.groupBy(null_label("dominant_sentiment").alias("dominant_sentiment")).agg(
        F.avg("view_count").alias("avg_view_count"),
        F.avg("like_ratio").alias("avg_like_ratio"),
        F.avg("comment_view_ratio").alias("avg_comment_view_ratio"),
    )
    return ranked(per, F.col("avg_view_count").desc(), F.col("dominant_sentiment"))


# ---- predictions report ----------------------------------------------------

def latest_rows(df: DataFrame, col: str = "ingest_date") -> DataFrame:
    """J04 + A03: rows of the latest date via a scalar subquery (one row, no collect)."""
    return df.filter(F.col(col) == df.select(F.max(col)).scalar())


def prediction_report(predictions: DataFrame, n: int = 20, title_chars: int = 40) -> DataFrame:
    """M15 (J04 + O05 + X07 + X09 + X10): latest day's top ``n`` by stay probability."""
    latest = latest_rows(predictions)
    top = top_n(
        latest,
        n,
        [F.col("prob_stay_trending_next").desc(), F.col("region"), F.col("video_id")],
        ["region", "video_id", "title", "view_count", "prob_stay_trending_next", "pred_stay_trending_next"],
    )
    return top.withColumns(
        {
            "prob_percentage": percent_string("prob_stay_trending_next"),
            "stay_trending": yes_no("pred_stay_trending_next"),
            "short_title": prefix("title", title_chars),
        }
    )
