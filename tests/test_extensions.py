"""Rolling frames, summaries, drift, curves, catalog tables and the deduplicating stream."""

import datetime as dt
import json
import os
import random
import shutil

import pytest
from pyspark.sql import functions as F

from trendlake.operators import drift, evaluation, rolling, summaries
from trendlake.operators.sentiment import score_lexicon, score_lexicon_join
from trendlake.sources.catalog import add_partition, refresh_partitions, register_table
from trendlake.session import session_conf
from trendlake.sources.landing import read_comment_records
from trendlake.operators.curate import curate_comments
from trendlake.sources.tables import read_table, write_partitioned
from trendlake.streaming import dedup


def day(k):
    return dt.date(2024, 1, 1) + dt.timedelta(days=k)


def test_rolling_frames_reach_over_gaps_and_stretches(spark):
    rng = random.Random(1)
    rows = [(k, day(d), rng.choice([None, rng.randrange(50)])) for k in ("a", "b", None) for d in rng.sample(range(-40, 60), 45) for _ in range(rng.randint(1, 3))]
    df = spark.createDataFrame(rows + [("a", None, 5)], "k string, d date, x long")
    for stretch in (7, 10, 500):
        got = {(r.k, r.d): r for r in rolling.rolling(df, ["k"], "d", ["x"], (1, 3, 7), stretch).collect()}
        assert set(got) == {(k, d) for k, d, _ in rows}
        for (k, d), r in got.items():
            for n in (1, 3, 7):
                frame = [(d2, x) for k2, d2, x in rows if k2 == k and 0 <= (d - d2).days < n]
                xs = [x for _, x in frame if x is not None]
                assert r[f"x_sum_{n}d"] == (sum(xs) if xs else None) and r[f"days_{n}d"] == len({f[0] for f in frame})
                assert r[f"x_mean_{n}d"] == (pytest.approx(sum(xs) / len(xs)) if xs else None)
    with pytest.raises(ValueError):
        rolling.rolling(df, ["k"], "d", ["x"], (7,), 6)


def test_merged_summaries_equal_those_made_at_once(spark):
    df = spark.range(60_000).select(F.expr("id % 3").alias("g"), F.expr("id % 30").alias("d"), F.expr("cast(id * 7919 % 20000 as string)").alias("item"),
                                    F.when(F.col("id") % 11 > 0, F.expr("id * 31 % 100003")).alias("v"))
    daily = summaries.daily_summary(df, ["g", "d"], "item", "v").checkpoint()
    exact = {r.g: r for r in df.groupBy("g").agg(F.count(F.lit(1)).alias("n"), F.sum("v").alias("t"), F.min("v").alias("lo"), F.max("v").alias("hi"),
                                                 F.count_distinct("item").alias("c"), F.sort_array(F.collect_list("v")).alias("vs")).collect()}
    at_once = {r.g: r for r in summaries.merge_summaries(summaries.daily_summary(df, ["g"], "item", "v"), ["g"], (0.1, 0.5, 0.9)).collect()}
    for r in summaries.merge_summaries(daily, ["g"], (0.1, 0.5, 0.9)).collect():
        e, o = exact[r.g], at_once[r.g]
        assert (r.n_rows, r.total, r.least, r.greatest) == (e.n, e.t, e.lo, e.hi) == (o.n_rows, o.total, o.least, o.greatest)
        for x in (r, o):
            assert abs(x.distinct_items - e.c) <= summaries.DISTINCT_BOUND * e.c
            for q, v in ((0.1, x.q10), (0.5, x.q50), (0.9, x.q90)):
                assert abs(sum(y <= v for y in e.vs) / len(e.vs) - q) <= summaries.RANK_BOUND


def test_drift_is_small_for_the_same_and_large_for_other_data(spark):
    df = spark.range(20_000).select(F.expr("cast(id * 7919 % 10007 as double)").alias("x"), F.when(F.col("id") % 4 > 0, F.col("id") % 5).alias("y"),
                                    F.lit(None).cast("double").alias("z"))
    edges = drift.fit_edges(df, ["x", "y", "z"])
    assert len(edges["x"]) == 9 and edges["z"] == [] and len(edges["y"]) <= 5
    counts = {r.bin: r.n for r in drift.bin_counts(df, {"x": edges["x"]}).collect()}
    assert max(abs(n - 2000) for n in counts.values()) < 20  # quantile bins are even
    same = {r.feature: r.psi for r in drift.stability(df, df, edges).collect()}
    assert all(abs(v) < 1e-12 for v in same.values())
    moved = {r.feature: r for r in drift.stability(df, df.withColumn("x", F.col("x") + 3000).withColumn("y", F.lit(None).cast("long")), edges).collect()}
    assert moved["x"].psi > 0.25 < moved["y"].psi and moved["z"].psi == 0 and moved["x"].n_current == 20_000
    assert {r.psi for r in drift.stability(df, df.limit(0), edges).collect()} == {None}


def test_curves_are_those_of_sorted_rows(spark, monkeypatch):
    rng = random.Random(4)
    rows = [(rng.choice([0.5, round(rng.random(), 3)]), float(rng.random() < 0.3)) for _ in range(3000)] + [(None, 1.0), (0.2, None)]
    df = spark.createDataFrame(rows, "s double, y double").repartition(5)
    known = [r for r in rows if None not in r]
    pos, neg = sum(y > 0 for _, y in known), sum(y <= 0 for _, y in known)
    monkeypatch.setattr(evaluation, "STRETCHES", 16)
    got = evaluation.precision_recall(df, "s", "y").collect()
    assert len(got) == len({s for s, _ in known})
    for r in got:
        tp, fp = (sum(1 for s, y in known if s >= r.threshold and (y > 0) == want) for want in (True, False))
        assert (r.tp, r.fp) == (tp, fp) and r.precision == tp / (tp + fp) and r.recall == tp / pos and r.false_positive_rate == fp / neg
    m = evaluation.ranking_metrics(df, "s", "y").first()
    pairs = sum((a > b) + 0.5 * (a == b) for a, y in known if y > 0 for b, z in known if z <= 0)
    assert m.auc == pytest.approx(pairs / (pos * neg)) and (m.n_positive, m.n_negative) == (pos, neg)
    cal = {r.bin: r for r in evaluation.calibration(df, "s", "y").collect()}
    assert sum(r.n for r in cal.values()) == len(known) and cal[5].positive_share == pytest.approx(
        sum(y for s, y in known if 0.5 <= s < 0.6) / sum(0.5 <= s < 0.6 for s, _ in known))
    one = evaluation.ranking_metrics(df.where("y > 0"), "s", "y").first()
    assert one.auc is None and one.average_precision == 1
    e = evaluation.regression_error(df.where("s is not null"), "s", "y").first()
    assert e.rmse == pytest.approx((sum((s - y) ** 2 for s, y in known) / len(known)) ** 0.5) and e.n == len(known)


def test_catalog_tables_prune_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = [(r, day(k), k) for r in ("US", "CA") for k in range(5)]
    df = spark.createDataFrame(rows, "region string, ingest_date date, n int")
    write_partitioned(df.where("n < 4"), path, ["region", "ingest_date"])
    name = "catalog_" + tmp_path.name.replace("-", "_")
    register_table(spark, name, path, df.schema, ["region", "ingest_date"])
    q = f"SELECT * FROM {name} WHERE region = 'US' AND ingest_date = DATE '2024-01-02'"
    plan = spark.sql(q)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "region" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert spark.sql(q).collect()[0].n == 1 and len(spark.sql(q).inputFiles()) == 1
    write_partitioned(df.where("n = 4"), path, ["region", "ingest_date"])
    assert spark.sql(f"SELECT count(*) FROM {name}").first()[0] == 8  # not entered yet
    add_partition(spark, name, region="US", ingest_date="2024-01-05")
    assert spark.sql(f"SELECT count(*) FROM {name}").first()[0] == 9
    shutil.rmtree(f"{path}/region=CA/ingest_date=2024-01-01")
    refresh_partitions(spark, name)
    assert spark.sql(f"SELECT count(*) FROM {name}").first()[0] == 9  # one entered, one gone
    spark.sql(f"DROP TABLE {name}")


def _land_comments(root, name, region, date, comments):
    folder = os.path.join(root, f"region={region}", f"date={date}")
    os.makedirs(folder, exist_ok=True)
    recs = [{"videoId": v, "comments": [{"videoId": v, "authorDisplayName": a, "textDisplay": t, "publishedAt": p, "likeCount": n}]} for v, a, t, p, n in comments]
    with open(os.path.join(folder, name), "w") as f:
        f.write("\n".join(map(json.dumps, recs)))


def test_replayed_landing_is_written_once(spark, tmp_path):
    landing, sink, ckpt = (str(tmp_path / n) for n in ("landing", "sink", "ckpt"))
    rng = random.Random(6)

    def comment(k, d):
        return (f"v{k % 7}", f"a{k}", f"text {k}", f"2024-01-{d:02d}T0{k % 10}:00:00Z", rng.randrange(9))

    seen = {d: [comment(k, d) for k in range(20 * d, 20 * d + 20)] for d in range(1, 9)}
    for d in (1, 2, 4):
        _land_comments(landing, "a.json", "US", day(d - 1), seen[d] + (seen[d - 1] if d - 1 in seen else []))
    query = dedup.dedup_comments_stream(spark, landing, sink, ckpt, "5 days", max_files_per_trigger=1)
    assert dedup.drain(query, 120) == 0
    _land_comments(landing, "late.json", "US", day(2), seen[3] + seen[2])   # a day late, and a day again, after a stop
    _land_comments(landing, "b.json", "CA", day(4), seen[5] + seen[4] + [("v1", "x", "no time", "p", 1), ("v1", "x", None, None, 1)])
    assert dedup.drain(dedup.dedup_comments_stream(spark, landing, sink, ckpt, "5 days"), 120) == 0
    got = read_table(spark, sink)
    want = dedup.unique_comments(curate_comments(read_comment_records(spark, landing)))
    cols = sorted(want.columns)
    assert sorted(map(repr, got.select(cols).collect())) == sorted(map(repr, want.select(cols).collect()))
    _land_comments(landing, "next.json", "US", day(20), [("v1", "n", "newest", "2024-01-25T00:00:00Z", 1)])
    assert dedup.drain(dedup.dedup_comments_stream(spark, landing, sink, ckpt, "5 days"), 120) == 0
    _land_comments(landing, "old.json", "US", day(21), [("v1", "o", "old", "2024-01-02T00:00:00Z", 1)])
    with pytest.raises(RuntimeError, match="1 rows landed later"):
        dedup.drain(dedup.dedup_comments_stream(spark, landing, sink, ckpt, "5 days"), 120)


def test_the_streams_keys_are_not_kept_in_the_heap(spark, tmp_path, monkeypatch):
    provider = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(provider)

    def run(name):
        query = dedup.dedup_comments_stream(spark, str(tmp_path / "landing"), str(tmp_path / f"sink_{name}"), str(tmp_path / f"ckpt_{name}"), "5 days")
        assert dedup.drain(query, 120) == 0 and spark.conf.get(provider) == before
        return [op for p in query.recentProgress for op in p["stateOperators"]]

    def land(name, ids):
        _land_comments(str(tmp_path / "landing"), name, "US", day(0), [(f"v{k}", f"a{k}", "t", "2024-01-01T00:00:00Z", 1) for k in ids])

    land("a.json", range(50))
    assert sum(op["customMetrics"].get("rocksdbPutCount", 0) for op in run("new")) == 50
    with monkeypatch.context() as m:
        m.setattr(dedup, "STATE_CONF", {})
        assert not any("rocksdbPutCount" in op["customMetrics"] for op in run("old"))
    land("b.json", range(40, 60))
    assert sum(op["numRowsUpdated"] for op in run("new")) == 10
    assert sum(op["numRowsUpdated"] for op in run("old")) == 10  # a checkpoint from before goes on
    for name in ("new", "old"):
        assert sorted(r.video_id for r in read_table(spark, str(tmp_path / f"sink_{name}")).collect()) == sorted(f"v{k}" for k in range(60))


def test_a_streams_stores_are_as_many_as_the_cores_keep_busy(spark):
    parts = "spark.sql.shuffle.partitions"
    most = max(32, 4 * spark.sparkContext.defaultParallelism)
    for given, want in ((3, 3), (most, most), (5000, most)):
        with session_conf(spark, {parts: str(given)}):
            assert dedup.state_conf(spark)[parts] == str(want) and spark.conf.get(parts) == str(given)


def test_lexicon_join_gives_the_native_scores_without_other_tokens(spark):
    df = spark.createDataFrame([(1, "good GOOD bad x"), (2, None), (3, ""), (4, "x y z"), (5, "bad,bad;good")], "id int, comment_text string")
    lexicon = spark.createDataFrame([("good", 1), ("bad", -1), ("good", 1), ("unused", 1)], "word string, polarity int")
    want = score_lexicon(df, "comment_text", ["good"], ["bad"]).select("id", "sentiment_pos", "sentiment_neg", "sentiment_neu", "sentiment_mix", "scored_ok")
    got = score_lexicon_join(df, ["id"], lexicon)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_sweeps_learn_from_the_past_only_and_choose_alike(spark):
    from pyspark.ml.regression import LinearRegression

    from trendlake.operators import sweep

    rng = random.Random(9)
    rows = [("US", day(k), float(x), 2.0 * x + rng.random()) for k in range(10) for x in range(8)]
    df = spark.createDataFrame(rows, "region string, ingest_date date, log_view_count double, log_view_growth_next double")
    edges = sweep.fold_edges(df, 2)
    assert edges == [day(5), day(7), None]
    grid = {"strong": LinearRegression(regParam=50.0), "none": LinearRegression(regParam=0.0), "again": LinearRegression(regParam=0.0)}
    found, best = sweep.sweep(df, "regression", grid, folds=2, features=["log_view_count"])
    got = {(r.setting, r.fold): (r.n_train, r.n_test, r.value) for r in found.collect()}
    assert {k: v[:2] for k, v in got.items()} == {(n, f): x for n in grid for f, x in ((0, (40, 16)), (1, (56, 24)))}
    assert best == "none" and got["none", 0] == got["again", 0] and got["none", 1][2] < 0.4 < got["strong", 1][2]
    with pytest.raises(ValueError, match="folds"):
        sweep.fold_edges(df, 9)


def test_topics_keep_the_vocabulary_bounds(spark):
    from pyspark.ml.functions import vector_to_array

    from trendlake.operators import topics

    texts = ["cat dog cat the", "dog cat the", "ship boat the", "boat ship Ship the", None, "", "rare the"]
    df = spark.createDataFrame([(t,) for t in texts * 4], "comment_text string")
    how = topics.Settings(min_docs=8, max_share=0.5, terms=3, topics=2, steps=20)
    assert [tuple(r) for r in topics.vocabulary(df, settings=how).collect()] == [("cat", 12, 8), ("ship", 12, 8), ("boat", 8, 8)]
    model, vectors, massed = topics.fit_topics(df, settings=how)
    mass = [r.m for r in massed.where("comment_text like '%the' and comment_text not like 'rare%'").select(vector_to_array("topic_mass").alias("m")).collect()]
    assert len(mass) == 16 and all(abs(sum(m) - 1) < 1e-9 for m in mass)
    again = topics.fit_topics(df, settings=how)[0]
    first, second = (topics.topic_terms(m, vectors, 3).orderBy("topic", "rank").collect() for m in (model, again))
    assert [(r.topic, r.term, round(r.weight, 9)) for r in first] == [(r.topic, r.term, round(r.weight, 9)) for r in second]
    with pytest.raises(ValueError, match="no term"):
        topics.fit_topics(df.limit(0), settings=how)


def test_a_long_comments_terms_are_counted_once_each(spark):
    """The old count looked at all of a comment's terms for each of them, which took minutes here (F2)."""
    import time
    from collections import Counter

    from trendlake.operators import topics

    words = ["".join(chr(97 + (i // 26 ** k) % 26) for k in range(4)) for i in range(20_000)]
    texts = [" ".join(words + words[k * 1000:] + words[:k]) for k in range(6)] + ["none", "", None, "aaab aaab"] * 3
    n, docs = Counter(), Counter()
    for t in texts:
        found = (t or "").split()
        n.update(found), docs.update(set(found))
    how = topics.Settings(min_docs=6, max_share=0.6, terms=500)
    started = time.monotonic()
    got = [tuple(r) for r in topics.vocabulary(spark.createDataFrame([(t,) for t in texts], "comment_text string"), settings=how).collect()]
    assert time.monotonic() - started < 60
    fit = [(w, n[w], docs[w]) for w in n if 6 <= docs[w] <= 0.6 * len(texts)]
    assert got == sorted(fit, key=lambda x: (-x[1], x[0]))[:500]


def test_a_sweep_looks_at_its_source_once(spark):
    """The snapshots' windows were computed again for every look at the labels."""
    from pyspark.ml.regression import LinearRegression

    from trendlake.operators import sweep

    seen = spark.sparkContext.accumulator(0)

    @F.udf("double")
    def counted(x):
        seen.add(1)
        return x

    rows = [("US", day(k), float(x), 2.0 * x) for k in range(8) for x in range(5)]
    df = spark.createDataFrame(rows, "region string, ingest_date date, log_view_count double, y double").withColumn("log_view_growth_next", counted("y")).drop("y")
    found, best = sweep.sweep(df, "regression", {"a": LinearRegression(), "b": LinearRegression(regParam=1.0)}, folds=2, features=["log_view_count"])
    assert {(r.setting, r.fold): (r.n_train, r.n_test) for r in found.collect()} == {(n, f): (20 + 10 * f, 10) for n in "ab" for f in (0, 1)}
    assert best == "a" and seen.value <= 2 * len(rows)  # a filter and a projection may each ask for the label
