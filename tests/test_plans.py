"""Plan-shape tests: the physical plans Catalyst picks for our operators."""

import datetime as dt
import os

from pyspark.sql import functions as F

from trendlake.operators import features as ft
from trendlake.operators import reports as rp
from trendlake.operators import sentiment as st
from trendlake.operators.curate import dedup
from trendlake.sources.tables import read_table, write_partitioned


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _snaps(spark):
    rows = [(r, f"v{v}", dt.date(2024, 1, d), v * d, v, d, dt.datetime(2023, 12, 1))
            for r in ("US", "CA") for v in range(5) for d in range(1, 6)]
    return spark.createDataFrame(rows, "region string, video_id string, ingest_date date, view_count bigint, "
                                       "like_count bigint, comment_count bigint, published_at timestamp")


def test_region_day_filter_prunes_partitions(spark, tmp_dir):
    path = os.path.join(tmp_dir, "t")
    snaps = _snaps(spark).withColumn("trending_date", F.col("ingest_date")).withColumn("title", F.lit("x")) \
        .withColumn("channel_id", F.lit("c"))
    write_partitioned(snaps.drop("ingest_date"), path, ["region", "trending_date"])
    top = rp.top_videos_by_region(read_table(spark, path), "US", 3, "2024-01-05")
    plan = _plan(top)
    assert "PartitionFilters: [isnotnull(region" in plan and "(trending_date" in plan
    assert "TakeOrderedAndProject" in plan
    assert [r.region for r in top.collect()] == ["US"] * 3


def test_report_of_today(spark):
    snaps = _snaps(spark).withColumn("title", F.lit("x")).withColumn("channel_id", F.lit("c"))
    today = snaps.withColumn("trending_date", F.when(F.col("ingest_date") == "2024-01-05", F.current_date()).otherwise(F.col("ingest_date")))
    assert rp.top_videos_by_region(today, "CA", 50, F.current_date()).count() == 5


def test_dedup_uses_partial_window_group_limit(spark):
    plan = _plan(dedup(_snaps(spark), ("region", "video_id")))
    assert plan.count("WindowGroupLimit") >= 2  # partial before the exchange, final after


def test_lag_lead_in_one_window_and_one_exchange(spark):
    plan = _plan(ft.add_lag_lead(_snaps(spark)))
    assert plan.count("Window [") == 1
    assert plan.count("Exchange hashpartitioning") == 1


def test_latest_slice_is_a_scalar_subquery(spark):
    plan = _plan(ft.build_features(_snaps(spark), output="latest"))
    assert "Subquery" in plan


def test_native_scorer_stays_in_the_jvm(spark):
    df = spark.createDataFrame([("good bad",)], "comment_text string")
    plan = _plan(st.score_lexicon(df, "comment_text", ("good",), ("bad",)))
    assert "ArrowEvalPython" not in plan and "BatchEvalPython" not in plan


def test_sentiment_aggregate_is_partial(spark):
    df = spark.createDataFrame([("v", "US", dt.date(2024, 1, 1), "good")] * 3,
                               "video_id string, region string, ingest_date date, comment_text string")
    plan = _plan(st.aggregate_sentiment(st.score_lexicon(df, "comment_text", ("good",), ())))
    assert "partial_avg" in plan and "partial_count" in plan


def test_no_shuffle_on_region(spark):
    """A region may hold a third of the rows: its latest date comes from a scalar map."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for plan in (_plan(ft.keep_matured(_snaps(spark))), _plan(ft.keep_latest(_snaps(spark), by="region"))):
            above = plan.split("Subquery")[0]
            assert "Exchange" not in above and "Join" not in above
        got = ft.keep_matured(_snaps(spark)).agg(F.max("ingest_date")).first()[0]
        assert got == dt.date(2024, 1, 4)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


SF = "/root/testdata/sf0.001"


def test_pages_need_no_window(spark):
    from trendlake.plans.queries import QUERIES

    for name in ("flatten_comments_outer", "flatten_threads", "landing_summary", "json_comments_roundtrip"):
        assert "Window" not in _plan(QUERIES[name](spark, SF)), name


def test_report_month_reaches_the_orders_scan(spark):
    from trendlake.plans.queries import QUERIES

    plan = _plan(QUERIES["report_top_by_views"](spark, SF))
    assert "GreaterThanOrEqual(o_orderdate" in plan and "LessThan(o_orderdate" in plan


def test_time_split_scores_the_texts_once(spark):
    from trendlake.plans.queries import QUERIES

    plan = _plan(QUERIES["time_split"](spark, SF))
    assert plan.count("text:string") <= 1


def test_landing_read_of_one_day_prunes_directories(spark, tmp_dir):
    from trendlake.sources.landing import landed_days, read_trending_docs, write_landing_json

    docs = spark.createDataFrame([(r, d) for r in ("US", "CA") for d in ("2024-01-01", "2024-01-02")], "region string, date string") \
        .withColumn("items", F.array(F.struct(F.lit("v").alias("id"))))
    write_landing_json(docs, tmp_dir)
    one = read_trending_docs(spark, tmp_dir, regions=["US"], days=["2024-01-02"])
    plan = _plan(one)
    filters = plan[plan.index("PartitionFilters"):].split("]")[0]
    assert "region" in filters and "date" in filters
    assert one.count() == 1 and landed_days(spark, tmp_dir) == ["2024-01-01", "2024-01-02"]
