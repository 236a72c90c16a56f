import datetime as dt

import pytest
from pyspark.sql import functions as F

from trendlake.operators import features as ft

D = dt.date


def _snaps(spark):
    rows = [
        ("US", "a", D(2024, 1, 1), 100, 10, 1, dt.datetime(2023, 12, 30, 5)),
        ("US", "a", D(2024, 1, 4), 400, None, 3, dt.datetime(2023, 12, 30, 5)),  # gap of 3 days, null likes
        ("US", "a", D(2024, 1, 5), 500, 20, 3, dt.datetime(2023, 12, 30, 5)),
        ("US", "b", D(2024, 1, 5), 7, 1, 0, dt.datetime(2024, 1, 5, 1)),  # single snapshot
        ("CA", "a", D(2024, 1, 3), 50, 5, 5, dt.datetime(2023, 12, 30, 5)),  # region lags behind
    ]
    return spark.createDataFrame(
        rows, "region string, video_id string, ingest_date date, view_count bigint, like_count bigint, "
              "comment_count bigint, published_at timestamp",
    )


def test_lag_lead_and_delta_days(spark):
    f = {(r.region, r.video_id, r.ingest_date): r for r in ft.build_features(_snaps(spark)).collect()}
    mid = f[("US", "a", D(2024, 1, 4))]
    assert (mid.prev_view_count, mid.next_view_count, mid.delta_days) == (100, 500, 3)
    assert mid.view_velocity == pytest.approx(100.0)
    assert mid.like_velocity is None and mid.like_growth_ratio is None
    assert mid.view_growth_ratio == pytest.approx(400 / 101)
    assert mid.video_age_days == 5.0
    first = f[("US", "a", D(2024, 1, 1))]
    assert first.delta_days == 1 and first.prev_view_count is None and first.view_velocity is None
    single = f[("US", "b", D(2024, 1, 5))]
    assert single.stay_trending_next == 0.0 and single.log_view_growth_next is None


def test_label_is_next_rows_value(spark):
    rows = sorted(ft.build_features(_snaps(spark)).filter("region='US' and video_id='a'").collect(),
                  key=lambda r: r.ingest_date)
    for cur, nxt in zip(rows, rows[1:]):
        assert cur.next_view_count == nxt.view_count and cur.stay_trending_next == 1.0
        assert cur.log_view_growth_next == pytest.approx(nxt.log_view_count - cur.log_view_count)


def test_daily_slice_equals_backfill_filtered(spark):
    snaps = _snaps(spark)
    daily = ft.build_features(snaps, output="latest").drop("trending_date")
    full = ft.build_features(snaps, output="all")
    back = full.filter(F.col("ingest_date") == full.agg(F.max("ingest_date")).first()[0])
    assert sorted(daily.collect()) == sorted(back.select(*daily.columns).collect())
    by_region = ft.build_features(snaps, output="latest", latest_by="region")
    assert {(r.region, r.ingest_date) for r in by_region.collect()} == {("US", D(2024, 1, 5)), ("CA", D(2024, 1, 3))}


def test_matured_excludes_each_regions_latest(spark):
    m = ft.build_features(_snaps(spark), output="matured").collect()
    assert {(r.region, r.ingest_date) for r in m} == {("US", D(2024, 1, 1)), ("US", D(2024, 1, 4))}


def test_sentiment_join_fills_zero_and_flags(spark):
    sent = spark.createDataFrame(
        [("a", "US", D(2024, 1, 4), 0.5, 0.1, 0.3, 0.1, 0.4, 2)],
        "video_id string, region string, ingest_date date, avg_comment_sent_pos double, "
        "avg_comment_sent_neg double, avg_comment_sent_neu double, avg_comment_sent_mix double, "
        "net_comment_sentiment double, comment_count_scored long",
    )
    f = ft.build_features(_snaps(spark), sent)
    rows = {(r.region, r.video_id, r.ingest_date): r for r in f.collect()}
    assert rows[("US", "a", D(2024, 1, 4))].has_sentiment and rows[("US", "a", D(2024, 1, 4))].comment_count_scored == 2
    other = rows[("US", "b", D(2024, 1, 5))]
    assert not other.has_sentiment and other.avg_comment_sent_pos == 0.0 and other.comment_count_scored == 0
