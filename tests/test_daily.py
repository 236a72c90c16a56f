"""The job chain end to end on a small landing zone, and rerun idempotency."""

import os
from dataclasses import replace

from trendlake.config import JobConfig, parse_regions
from trendlake.plans import daily
from trendlake.sources.tables import read_table
from tests.test_curate import _land
from tests.test_flatten import _item

SMALL = {"regression": {"max_iter": 3, "max_depth": 2}, "classification": {"max_iter": 5}}


def _landing(root, days=range(1, 7)):
    for day in days:
        date = f"2024-01-0{day}"
        for region in ("US", "CA"):
            vids = [v for v in range(8) if (v + day) % 4 != 0 and (v < 6 or day <= 2)]  # v6, v7 stop trending
            items = [_item(f"{region}{v}", views=str(100 * day + v), likes=str(v + day), comments=str(day))
                     for v in vids]
            _land(root, "trending", region, date, "t.json", {"items": items})
            recs = [{"videoId": f"{region}{v}", "comments": [
                {"videoId": f"{region}{v}", "authorDisplayName": "a",
                 "textDisplay": "great video" if v % 2 else "bad bad", "publishedAt": "p", "likeCount": v}]}
                for v in vids]
            _land(root, "comments", region, date, "c.json", recs)


def _config(root, name):
    return JobConfig(raw_root=os.path.join(root, "raw"), curated_root=os.path.join(root, name, "curated"),
                     model_root=os.path.join(root, name, "models"))


def test_daily_runs_from_an_empty_lake_equal_the_backfill(spark, tmp_dir):
    """Days with gaps in every series are landed one at a time; after each, the feature table
    equals a backfill's, labels included, and training starts by itself."""
    grown = _config(tmp_dir, "daily")
    for day in range(1, 7):
        _landing(grown.raw_root, [day])
        metrics = daily.run_daily(spark, grown, **SMALL)
        whole = _config(tmp_dir, f"backfill{day}")
        daily.curate_trending_job(spark, whole)
        daily.curate_comments_job(spark, whole)
        daily.sentiment_job(spark, whole)
        daily.features_job(spark, whole, output="all")
        got, want = (read_table(spark, c.curated(daily.FEATURES)) for c in (grown, whole))
        cols = sorted(want.columns)
        assert sorted(map(repr, got.select(cols).collect())) == sorted(map(repr, want.select(cols).collect())), day
    assert metrics["regression"]["n_train"] > 0 and "skipped" not in metrics["classification"]
    assert read_table(spark, grown.curated(daily.PREDICTIONS)).count() > 0


def _counts(spark, cfg):
    return {t: read_table(spark, cfg.curated(t)).count()
            for t in (daily.TRENDING, daily.COMMENTS, daily.SENTIMENT, daily.FEATURES, daily.PREDICTIONS)}


def test_config_from_the_environment():
    cfg = JobConfig.from_env({"RAW_PATH": "/r", "CURATED_PATH": "/c", "REGIONS": "US, CA", "DAYS": "2024-01-01"})
    assert (cfg.raw_trending, cfg.curated("t"), cfg.regions, cfg.days) == ("/r/trending", "/c/t", ("US", "CA"), ("2024-01-01",))
    assert JobConfig.from_env({"RAW_PATH": "/r", "CURATED_PATH": "/c"}).days is None


def test_runs_keep_to_their_regions_and_days(spark, tmp_dir):
    cfg = _config(tmp_dir, "scoped")
    _landing(cfg.raw_root)
    daily.run_daily(spark, replace(cfg, regions=("CA",), days=("2024-01-02",)), train=False)
    keys = read_table(spark, cfg.curated(daily.FEATURES)).select("region", "ingest_date").distinct().collect()
    assert [(r.region, str(r.ingest_date)) for r in keys] == [("CA", "2024-01-02")]


def test_parse_regions():
    assert parse_regions(" US, ,CA ,") == ("US", "CA")


def test_backfill_then_daily_is_idempotent(spark, tmp_dir):
    raw = os.path.join(tmp_dir, "raw")
    _landing(raw)
    cfg = JobConfig(raw_root=raw, curated_root=os.path.join(tmp_dir, "curated"),
                    model_root=os.path.join(tmp_dir, "models"))
    metrics = daily.run_backfill(spark, cfg, **SMALL)
    assert metrics["regression"]["metric"] == "rmse" and metrics["classification"]["n_train"] > 0
    first = _counts(spark, cfg)
    assert first[daily.TRENDING] == first[daily.FEATURES] == first[daily.COMMENTS]
    assert first[daily.PREDICTIONS] == 10  # the latest day: 5 videos x 2 regions
    daily.run_daily(spark, cfg, train=False)
    assert _counts(spark, cfg) == first
    report = daily.predictions_report(spark, cfg).collect()
    assert len(report) == 10 and all(r.prob_percentage.endswith("%") for r in report)
