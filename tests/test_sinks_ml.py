import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from trendlake.functions.numeric import inf_to_null
from trendlake.operators import features as ft
from trendlake.operators import ml
from trendlake.sources.tables import read_table, write_partitioned


def _df(spark):
    return spark.createDataFrame(
        [("US", dt.date(2024, 1, 1), 1), ("US", dt.date(2024, 1, 2), 2), ("CA", dt.date(2024, 1, 2), 3)],
        "region string, ingest_date date, v int",
    )


def test_dynamic_overwrite_is_idempotent(spark, tmp_dir):
    path = os.path.join(tmp_dir, "t")
    write_partitioned(_df(spark), path, ["region", "ingest_date"])
    write_partitioned(_df(spark), path, ["region", "ingest_date"])
    assert read_table(spark, path).count() == 3
    day2 = _df(spark).filter("ingest_date = '2024-01-02'").withColumn("v", F.lit(9))
    write_partitioned(day2, path, ["region", "ingest_date"])  # replaces only that day
    assert sorted(r.v for r in read_table(spark, path).collect()) == [1, 9, 9]


def test_append_duplicates_and_static_replaces(spark, tmp_dir):
    path = os.path.join(tmp_dir, "a")
    write_partitioned(_df(spark), path, ["region", "ingest_date"], mode="append")
    write_partitioned(_df(spark), path, ["region", "ingest_date"], mode="append")
    assert read_table(spark, path).count() == 6
    write_partitioned(_df(spark).limit(1), path, ["region", "ingest_date"], mode="static")
    assert read_table(spark, path).count() == 1


def test_inf_to_null(spark):
    df = spark.createDataFrame([(float("inf"),), (float("-inf"),), (1.5,), (None,)], "x double")
    assert [r.y for r in df.select(inf_to_null("x").alias("y")).collect()] == [None, None, 1.5, None]


def test_hash_split_is_stable(spark):
    df = spark.range(2000).withColumn("k", F.col("id").cast("string"))
    a = df.select("k", ml.hash_split_column(["k"]).alias("s"))
    b = df.repartition(7).select("k", ml.hash_split_column(["k"]).alias("s"))
    assert sorted(a.collect()) == sorted(b.collect())
    frac = a.filter("s = 'train'").count() / 2000
    assert 0.75 < frac < 0.85


def test_time_split_uses_four_dates(spark):
    days = [dt.date(2024, 1, d) for d in range(1, 11)]
    df = spark.createDataFrame([("r", "v", d) for d in days], "region string, video_id string, ingest_date date")
    out = {r.ingest_date: r.s for r in df.select("ingest_date", ml.time_split_column(df).alias("s")).collect()}
    assert [d.day for d in days if out[d] == "test"] == [7, 8, 9, 10]
    few = df.filter("ingest_date <= '2024-01-03'")  # no switch to another split behind the caller's back
    assert {r.s for r in few.select(ml.split_column(few).alias("s")).collect()} == {"test"}
    assert {r.s for r in few.select(ml.split_column(few, "hash").alias("s")).collect()} <= {"train", "test"}


def test_training_says_what_is_missing(spark):
    days = [dt.date(2024, 1, d) for d in range(1, 5)]
    snaps = spark.createDataFrame([("US", "v", d, 1, 1, 1, dt.datetime(2023, 12, 1)) for d in days],
                                  "region string, video_id string, ingest_date date, view_count bigint, "
                                  "like_count bigint, comment_count bigint, published_at timestamp")
    with pytest.raises(ValueError, match="leaves 0 rows to train"):
        ml.train_and_evaluate(ft.build_features(snaps), "regression")
    with pytest.raises(ValueError, match="no labelled rows"):
        ml.train_regressor(ft.build_features(snaps.limit(1)))


def test_two_class_guard(spark):
    df = spark.createDataFrame([(1.0,), (1.0,)], "stay_trending_next double")
    with pytest.raises(ValueError):
        ml.require_two_classes(df)


def test_train_and_score_invariants(spark):
    rows = []
    for v in range(12):
        for d in range(1, 9):
            if (v + d) % 5 == 0:
                continue
            rows.append(("US" if v % 2 else "CA", f"v{v}", dt.date(2024, 1, d), 100 * d + v, 10 + v, d,
                         dt.datetime(2023, 12, 1)))
    snaps = spark.createDataFrame(rows, "region string, video_id string, ingest_date date, view_count bigint, "
                                        "like_count bigint, comment_count bigint, published_at timestamp")
    labeled = ft.build_features(snaps)
    reg = ml.train_regressor(labeled, max_iter=3, max_depth=2)
    cls = ml.train_classifier(labeled, max_iter=5)
    pred = ml.score(ft.keep_latest(labeled), reg, cls).collect()
    assert pred
    for r in pred:
        assert r.pred_view_count_next == pytest.approx(
            __import__("math").expm1(r.log_view_count + r.pred_log_view_growth_next), rel=1e-12)
        assert 0.0 <= r.prob_stay_trending_next <= 1.0 and r.pred_stay_trending_next in (0.0, 1.0)


def test_training_reads_its_rows_a_few_times_only(spark):
    rows = [("US" if v % 2 else "CA", f"v{v}", dt.date(2024, 1, d), 100 * d + v * v, 10 + v, d, dt.datetime(2023, 12, 1))
            for v in range(12) for d in range(1, 10) if (v + d) % 5 and (v % 3 or d < 5)]
    snaps = spark.createDataFrame(rows, "region string, video_id string, ingest_date date, view_count bigint, "
                                        "like_count bigint, comment_count bigint, published_at timestamp")
    labeled = ft.build_features(snaps).checkpoint(eager=True)
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            read.add(len(b))
            yield b

    for task, kw in (("regression", {"max_iter": 2, "max_depth": 2}), ("classification", {"max_iter": 3})):
        before = read.value
        model, info = ml.train_and_evaluate(labeled.mapInPandas(counted, labeled.schema), task, **kw)
        assert read.value - before <= 4 * labeled.count()  # the rows and the latest dates, not once for each stage
        frame, label = ml.task_frame(labeled, task)
        train, test = ml.split(frame, ml.split_column(frame))
        used = ml.usable_features(train, ml.NUMERIC_FEATURES)
        pipe, score = (ml.regression_pipeline, ml.rmse) if task == "regression" else (ml.classification_pipeline, ml.auc)
        assert info["value"] == pytest.approx(score(pipe(used, **kw).fit(train), test), rel=1e-9)
        assert (info["n_train"], info["n_test"], info["features"]) == (train.count(), test.count(), ",".join(used))


def test_latest_day_is_that_of_all_events(spark, tmp_dir):
    from trendlake.sources import testdata as td

    at = [("click", 1, dt.datetime(2024, 1, 1, 23)), (None, 2, dt.datetime(2024, 1, 3, 1)), ("view", None, dt.datetime(2024, 1, 2)), ("view", 3, None)]
    spark.createDataFrame([(*r, 1.0, '{"k": 1}') for r in at], "event_type string, user_id bigint, ts timestamp, value double, props string"
                          ).write.parquet(os.path.join(tmp_dir, "events.parquet"))
    days = td.snapshot_days(spark, tmp_dir)
    assert days.agg(F.max("ingest_date")).first() == td.snapshots(spark, tmp_dir).agg(F.max("ingest_date")).first()
    assert "Exchange" not in days._jdf.queryExecution().executedPlan().toString()
