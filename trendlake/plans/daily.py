"""The job chain: raw landing zone -> curated -> sentiment -> features -> models -> predictions.

Each step reads its inputs from storage and writes its output with dynamic
partition overwrite, so any step can be rerun for a day without duplicating
or dropping rows (the original comments and predictions sinks appended or
replaced the whole table).  ``run_daily`` reads the landed days only that no run has
finished yet (a ledger keeps these), and rewrites the feature partitions that they
change: the days themselves and those of the neighbouring snapshots, found in the
index of series (``operators.series``).  ``run_backfill`` rebuilds everything; day by
day both give the same tables.  Nothing is collected to the driver except model
metrics and directory names.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trendlake.config import JobConfig
from trendlake.operators import features as ft
from trendlake.operators import ml
from trendlake.operators import sentiment as st
from trendlake.operators import series as sr
from trendlake.operators.curate import curate_comments, curate_trending, require
from trendlake.session import FEATURE_CONF, apply_defaults, session_conf, shared_dir
from trendlake.sources.landing import landed_partitions, read_comment_records, read_trending_docs
from trendlake.sources.models import load_model, save_model
from trendlake.sources.tables import read_table, write_partitioned

TRENDING, COMMENTS, SENTIMENT, FEATURES, PREDICTIONS = (
    "trending", "comments", "comments_sentiment", "labeled_features", "predictions",
)
INDEX, LEDGER = "series_index", "run_ledger"
REG_MODEL, CLS_MODEL = "gbt_reg_view_growth", "logreg_stay_trending"


def curate_trending_job(spark: SparkSession, cfg: JobConfig) -> None:
    """Job 1."""
    raw = read_trending_docs(spark, cfg.raw_trending, regions=cfg.regions, days=cfg.days)
    write_partitioned(curate_trending(raw, cfg.dedup_keys), cfg.curated(TRENDING), ["region", "trending_date"])


def curate_comments_job(spark: SparkSession, cfg: JobConfig) -> None:
    """Job 2 (dynamic overwrite instead of append: reruns are idempotent)."""
    raw = read_comment_records(spark, cfg.raw_comments, regions=cfg.regions, days=cfg.days)
    write_partitioned(curate_comments(raw), cfg.curated(COMMENTS), ["region", "ingest_date"])


def _of_days(df: DataFrame, cfg: JobConfig) -> DataFrame:
    """The partitions of the run's days and regions."""
    if cfg.days is not None:
        df = df.where(F.col("ingest_date").isin(*[F.lit(d).cast("date") for d in cfg.days]))
    return df if cfg.regions is None else df.where(F.col("region").isin(*cfg.regions))


def sentiment_job(spark: SparkSession, cfg: JobConfig, batch_fn: st.BatchScorer | None = None,
                  positive=st.DEFAULT_POSITIVE, negative=st.DEFAULT_NEGATIVE, max_fallback_share: float = 0.05) -> None:
    """Job 3: score the run's curated comments (native lexicon, or ``batch_fn`` via Arrow
    batches) and aggregate per video and day. A scorer that fails on more than
    ``max_fallback_share`` of the comments fails the job."""
    comments = _of_days(require(read_table(spark, cfg.curated(COMMENTS)), ["comment_text"]), cfg)
    keys = ["video_id", "region", "ingest_date"]
    if batch_fn is None:
        scored = st.aggregate_sentiment(st.score_lexicon(comments, "comment_text", positive, negative))
    else:
        scored = st.aggregate_sentiment(st.score_batches(comments, "comment_text", keys, batch_fn)).checkpoint(eager=True)
        st.require_scored(scored, max_fallback_share)
    write_partitioned(scored, cfg.curated(SENTIMENT), ["region", "ingest_date"])


def features_job(spark: SparkSession, cfg: JobConfig, output: str = "renewed") -> None:
    """Jobs 4/4b: ``output="renewed"`` (daily: all that the run's days change, the latest day by
    default) or ``"all"`` (backfill, which also makes the index of series anew). The run's
    regions hold here too: partitions of others are left as they are."""
    trending = read_table(spark, cfg.curated(TRENDING))
    sentiment = read_table(spark, cfg.curated(SENTIMENT))
    with session_conf(spark, FEATURE_CONF):
        if output == "renewed":
            days = cfg.days or (str(trending.agg(F.max("trending_date")).first()[0]),)
            sr.renew_features(trending, sentiment, cfg.curated(FEATURES), cfg.curated(INDEX), days, cfg.regions)
            return
        scoped = trending if cfg.regions is None else trending.where(F.col("region").isin(*cfg.regions))
        feats = ft.build_features(scoped, sentiment, output=output, days=cfg.days)
        write_partitioned(feats, cfg.curated(FEATURES), ["region", "ingest_date"])
        sr.write_index(sr.series_index(ft.with_ingest_date(trending)), cfg.curated(INDEX))


def train_job(spark: SparkSession, cfg: JobConfig, **train_kw) -> dict:
    """Job 5: fit, evaluate and save both models; returns the metrics.  A model without
    enough labelled days yet is left out, and its entry says why."""
    shared_dir(spark)
    labeled = read_table(spark, cfg.curated(FEATURES))
    out = {}
    for task, name in (("regression", REG_MODEL), ("classification", CLS_MODEL)):
        try:
            model, info = ml.train_and_evaluate(labeled, task, **train_kw.get(task, {}))
        except ValueError as why:  # raised before a fit: too few days, rows or classes
            out[task] = {"task": task, "skipped": str(why)}
        else:
            save_model(model, cfg.model(name))
            out[task] = info
    return out


def _model_exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def predict_job(spark: SparkSession, cfg: JobConfig) -> bool:
    """Job 6: score the latest feature slice; dynamic overwrite keeps older days. Returns
    False, and writes nothing, while either model has not been trained yet."""
    if not all(_model_exists(spark, cfg.model(m)) for m in (REG_MODEL, CLS_MODEL)):
        return False
    labeled = read_table(spark, cfg.curated(FEATURES))
    latest = ft.keep_latest(labeled, labeled.select("region", "ingest_date"))
    preds = ml.score(latest, load_model(cfg.model(REG_MODEL)), load_model(cfg.model(CLS_MODEL)))
    write_partitioned(preds, cfg.curated(PREDICTIONS), ["region", "ingest_date"])
    return True


def _landed(spark: SparkSession, cfg: JobConfig) -> list[tuple[str, str, str]]:
    return [(kind, region, day) for kind, root in ((TRENDING, cfg.raw_trending), (COMMENTS, cfg.raw_comments))
            for region, day in landed_partitions(spark, root, cfg.regions)]


def pending_days(spark: SparkSession, cfg: JobConfig) -> list[str]:
    """Landed days of the run's regions that no run has finished, ascending: what a scheduler that
    missed some days has to catch up with."""
    known = set()
    if sr.table_exists(spark, cfg.curated(LEDGER)):
        known = {tuple(r) for r in read_table(spark, cfg.curated(LEDGER)).select("kind", "region", F.col("day").cast("string")).distinct().collect()}
    return sorted({day for kind, region, day in _landed(spark, cfg) if (kind, region, day) not in known})


def _finish(spark: SparkSession, cfg: JobConfig, landed: list[tuple[str, str, str]]) -> None:
    """Enter a run's directories in the ledger. ``landed`` was listed before the run read them."""
    days = None if cfg.days is None else set(cfg.days)
    done = [x for x in landed if days is None or x[2] in days]
    if done:
        spark.createDataFrame(done, "kind string, region string, day string").coalesce(1).write.mode("append").partitionBy("kind").parquet(cfg.curated(LEDGER))


def run_daily(spark: SparkSession, cfg: JobConfig, train: bool = True, **train_kw) -> dict:
    """Entry point A: the six jobs, from an empty lake on, for the days of ``cfg``; by default for
    every landed day that no run has finished, and the latest landed one. A late day may
    be run at any time; a day that landed again is named in ``cfg.days``."""
    apply_defaults(spark)
    landed = _landed(spark, cfg)
    if cfg.days is None:
        latest = sorted(day for kind, _, day in landed if kind == TRENDING)[-1:]
        cfg = replace(cfg, days=tuple(sorted({*pending_days(spark, cfg), *latest})))
    if not cfg.days:
        return {}
    curate_trending_job(spark, cfg)
    curate_comments_job(spark, cfg)
    sentiment_job(spark, cfg)
    features_job(spark, cfg, output="renewed")
    metrics = train_job(spark, cfg, **train_kw) if train else {}
    predict_job(spark, cfg)
    _finish(spark, cfg, landed)
    return metrics


def run_backfill(spark: SparkSession, cfg: JobConfig, **train_kw) -> dict:
    """Rebuild every layer from the whole landing zone (features for all days)."""
    apply_defaults(spark)
    landed = _landed(spark, cfg)
    curate_trending_job(spark, cfg)
    curate_comments_job(spark, cfg)
    sentiment_job(spark, cfg)
    features_job(spark, cfg, output="all")
    metrics = train_job(spark, cfg, **train_kw)
    predict_job(spark, cfg)
    _finish(spark, cfg, landed)
    return metrics


def predictions_report(spark: SparkSession, cfg: JobConfig, n: int = 20) -> DataFrame:
    """The dashboard's prediction panel over the predictions table."""
    from trendlake.operators.reports import prediction_report

    return prediction_report(read_table(spark, cfg.curated(PREDICTIONS)), n)


__all__ = [
    "run_daily", "run_backfill", "pending_days", "curate_trending_job", "curate_comments_job", "sentiment_job",
    "features_job", "train_job", "predict_job", "predictions_report",
]
