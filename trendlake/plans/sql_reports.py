"""The trending report and the prediction panel as SQL text.

The statements run over whatever temp views or tables carry the names they are
given. Region, day and row count are bound as named parameters, so the values
cannot inject SQL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from trendlake.sources import testdata as td
from trendlake.sources.tables import register_views, run_sql

# The output columns are fixed values of the report's contract.
# One day of one region is cut out of each input before anything else; comments are
# summed per video next to the day they belong to, and only then meet the videos.
TRENDING_REPORT = """
SELECT v.region, v.date, v.id AS video_id, v.snippet.title, v.snippet.channelTitle AS channel,
       v.snippet.publishedAt AS video_published_at,
       TRY_CAST(v.statistics.viewCount AS BIGINT) AS views,
       TRY_CAST(v.statistics.likeCount AS BIGINT) AS video_likes,
       NVL(activity.n, 0) AS comment_count,
       NVL(activity.mean_likes, 0D) AS avg_comment_likes
FROM (
  SELECT region, date, INLINE(items)
  FROM raw_trending
  WHERE region = :region AND date = DATE(:day)
) v
LEFT JOIN (
  SELECT said.videoId, COUNT(*) AS n, AVG(said.likeCount) AS mean_likes
  FROM (SELECT INLINE(comments) FROM raw_comments WHERE region = :region AND date = DATE(:day)) said
  GROUP BY said.videoId
) activity ON activity.videoId = v.id
ORDER BY {rank_by} DESC, video_id
LIMIT :n
"""

RANK_BY = ("views", "comment_count")

PREDICTION_PANEL = """
SELECT region, video_id, title, view_count, prob_stay_trending_next, pred_stay_trending_next,
       CONCAT(CAST(ROUND(prob_stay_trending_next * 100, 2) AS STRING), '%') AS prob_percentage,
       CASE pred_stay_trending_next WHEN 1 THEN 'Yes' WHEN 0 THEN 'No' END AS stay_trending,
       LEFT(title, 40) AS short_title
FROM {predictions}
WHERE ingest_date = (SELECT MAX(ingest_date) FROM {predictions})
ORDER BY prob_stay_trending_next DESC, region, video_id
LIMIT :n
"""


def report_sql(spark: SparkSession, region: str, day: str, order_by: str = "views", n: int = 20) -> DataFrame:
    """The report over the views ``raw_trending`` and ``raw_comments``."""
    if order_by not in RANK_BY:
        raise ValueError(f"order_by must be one of {RANK_BY}")
    return run_sql(spark, TRENDING_REPORT.format(rank_by=order_by), {"region": region, "day": day, "n": n})


def prediction_panel_sql(spark: SparkSession, predictions: DataFrame, n: int = 20, view: str = "predictions_panel") -> DataFrame:
    """The prediction panel over a registered view of the predictions table."""
    register_views(spark, **{view: predictions})
    return run_sql(spark, PREDICTION_PANEL.format(predictions=view), {"n": n})


def run_report(spark: SparkSession, sf_dir: str, region: str, day: str, order_by: str = "views") -> DataFrame:
    register_views(
        spark, raw_trending=td.trending_docs(spark, sf_dir, day), raw_comments=td.comment_records(spark, sf_dir, day)
    )
    return report_sql(spark, region, day, order_by)


__all__ = ["TRENDING_REPORT", "PREDICTION_PANEL", "report_sql", "prediction_panel_sql", "run_report"]
