"""Daily features by as-of lookup equal those of windows over the whole history."""

import datetime as dt
import random

from pyspark.sql import functions as F

from trendlake.operators import features as ft
from trendlake.operators import series as sr
from trendlake.plans import daily
from trendlake.sources.tables import read_table, write_partitioned
from tests.test_daily import SMALL, _config, _landing

SCHEMA = "region string, video_id string, ingest_date date, view_count long, like_count long, comment_count long, published_at timestamp"


def day(k):
    return dt.date(2024, 1, 1) + dt.timedelta(days=k)


def history(seed, days=12, series=14):
    rng = random.Random(seed)
    return {k: [("ABC"[v % 3], f"v{v}", day(k), rng.randrange(1000), rng.choice([None, 5]), v, dt.datetime(2024, 1, 1))
                for v in range(series) if rng.random() < 0.5] for k in range(days)}


def expected(spark, rows):
    snaps = spark.createDataFrame(rows, SCHEMA)
    return ft.build_features(snaps, None)


def same(got, want):
    cols = sorted(want.columns)
    return sorted(map(repr, got.select(cols).collect())) == sorted(map(repr, want.select(cols).collect()))


def test_days_in_any_order_again_and_withdrawn_give_the_windows_result(spark, tmp_path):
    trend, feats, index = (str(tmp_path / n) for n in ("trend", "feats", "index"))
    landed, versions = {}, history(1)
    changed = history(2)
    runs = [([0], versions), ([2, 3], versions), ([7], versions), ([5], versions), ([1], versions), ([7], changed), ([4, 9, 11], versions), ([5, 2], changed), ([8], changed)]
    for k, (days, source) in enumerate(runs):
        landed |= {d: source[d] for d in days}
        write_partitioned(spark.createDataFrame([r for d in days for r in source[d]], SCHEMA), trend, ["region", "ingest_date"])
        for d in days:  # a region without rows on a day that landed again has no partition left
            for region in set("ABC") - {r[0] for r in source[d]}:
                import shutil
                shutil.rmtree(f"{trend}/region={region}/ingest_date={day(d)}", ignore_errors=True)
        sr.renew_features(read_table(spark, trend), None, feats, index, [str(day(d)) for d in days])
        if k in (2, 4, 5, 7, 8):
            got = read_table(spark, feats)
            assert same(got, expected(spark, [r for rows in landed.values() for r in rows])), k
    assert len(sr._versions(spark, index)) == 2  # older ones are removed


def test_a_run_reads_only_the_days_beside_its_own(spark, tmp_path):
    rows = [("US", f"v{v}", day(k), k, 1, 1, dt.datetime(2024, 1, 1)) for k in range(30) for v in range(3)]
    write_partitioned(spark.createDataFrame(rows, SCHEMA), str(tmp_path / "t"), ["region", "ingest_date"])
    snaps = read_table(spark, str(tmp_path / "t"))
    index = sr.series_index(snaps.where(F.col("ingest_date") != F.lit(str(day(20)))))
    merged = sr.merge_index(index, snaps.where(F.col("ingest_date") == F.lit(str(day(20)))), [str(day(20))]).checkpoint()
    feats = sr.renewed_rows(snaps, sr.neighbours(merged), None)
    assert sorted(r[0] for r in feats.select("ingest_date").distinct().collect()) == [day(19), day(20), day(21)]
    plan = feats._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "2024-01-" in plan or "ingest_date" in plan.split("PartitionFilters")[1]
    read = {f.split("ingest_date=")[1][:10] for f in snaps.where(sr._partitions(sr.neighbours(merged), "needed")).inputFiles()}
    files = {f.split("ingest_date=")[1][:10] for f in snaps.where(sr._partitions(sr.neighbours(merged), "needed")).select(F.input_file_name()).distinct().toPandas().iloc[:, 0]}
    assert files == {str(day(k)) for k in range(18, 23)} and read >= files


def test_index_keeps_to_the_runs_regions(spark):
    index = spark.createDataFrame([("US", "a", [day(1), day(2)]), ("CA", "a", [day(1), day(2)])], "region string, video_id string, days array<date>")
    arrived = spark.createDataFrame([("US", "b", day(2))], "region string, video_id string, ingest_date date")
    got = {(r.region, r.video_id): (r.days, r.changed) for r in sr.merge_index(index, arrived, [str(day(2))], ["US"]).collect()}
    assert got == {("US", "a"): ([day(1)], [day(2)]), ("US", "b"): ([day(2)], [day(2)]), ("CA", "a"): ([day(1), day(2)], [])}


def test_missed_days_are_caught_up(spark, tmp_dir):
    cfg, whole = _config(tmp_dir, "missed"), _config(tmp_dir, "whole")
    _landing(cfg.raw_root, [1])
    daily.run_daily(spark, cfg, train=False)
    _landing(cfg.raw_root, [2, 3, 4])  # the scheduler was down on two of these days
    assert daily.pending_days(spark, cfg) == ["2024-01-02", "2024-01-03", "2024-01-04"]
    daily.run_daily(spark, cfg, train=False)
    assert daily.pending_days(spark, cfg) == []
    daily.run_backfill(spark, whole, **SMALL)
    for t in (daily.TRENDING, daily.COMMENTS, daily.SENTIMENT, daily.FEATURES):
        got, want = read_table(spark, cfg.curated(t)), read_table(spark, whole.curated(t))
        cols = sorted(set(want.columns) - {"source_file"})
        assert sorted(map(repr, got.select(cols).collect())) == sorted(map(repr, want.select(cols).collect())), t
    assert same(sr.read_index(spark, cfg.curated(daily.INDEX)), sr.read_index(spark, whole.curated(daily.INDEX)))


def test_renewed_rows_broadcast_no_exploded_days(spark, tmp_path):
    """The rows of a day list are as many as the history's: no driver may hold them (F1)."""
    rows = [(f"R{v % 2}", f"v{v}", day(k), k, 1, 1, dt.datetime(2024, 1, 1)) for k in range(20) for v in range(30)]
    snaps = spark.createDataFrame(rows, SCHEMA)
    run = [str(day(k)) for k in range(5, 20)]
    of_run = F.col("ingest_date").isin(*[F.lit(d).cast("date") for d in run])
    sr.merge_index(sr.series_index(snaps.where(~of_run)), snaps.where(of_run), run).write.parquet(str(tmp_path / "m"))
    series = sr.neighbours(spark.read.parquet(str(tmp_path / "m")))
    feats = sr.renewed_rows(snaps, series, None)
    plan = feats._jdf.queryExecution().executedPlan().toString()
    assert "Broadcast" not in plan and "Generate" not in plan
    want = ft.build_features(snaps, None).where(F.col("ingest_date") >= F.lit(str(day(4))).cast("date"))
    assert same(feats, want)
    others = sr._on_days(snaps, series, F.array_union("changed", "renew"), "left_anti")
    assert {r[0] for r in others.select("ingest_date").distinct().collect()} == {day(k) for k in range(4)}
