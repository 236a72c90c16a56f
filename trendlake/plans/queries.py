"""Driver query catalog: one Spark plan per operator group, over the supplied tables.

Each query takes ``(spark, sf_dir)`` and returns a DataFrame built from the
tables under ``sf_dir`` (via ``trendlake.sources.testdata``), so its work
grows with the data.  Column names match the SQL twins in
``trendlake.plans.oracle``.  Doubles that come out of sums/averages/logs are
rounded to ``DIGITS`` in both twins so that floating-point association order
cannot make equal results compare unequal.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from trendlake.operators import drift, rolling, summaries
from trendlake.operators import evaluation as ev
from trendlake.operators import features as ft
from trendlake.operators import flatten as fl
from trendlake.operators import ml
from trendlake.operators import reports as rp
from trendlake.operators import sentiment as st
from trendlake.session import FEATURE_CONF, apply_defaults, keep, session_conf
from trendlake.sources import testdata as td

DIGITS = 6
REPORT_REGION = "ASIA"
REPORT_DATE = "1997-05-01"

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(name: str):
    """Register a query; whoever calls it, it runs with trendlake's settings and in UTC
    (hour and date parts follow the session's time zone, Q16)."""

    def deco(fn: Query) -> Query:
        @wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            apply_defaults(spark)
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return fn(spark, sf_dir)

        QUERIES[name] = run
        return fn

    return deco


def _r(c, digits: int = DIGITS):
    return F.round(F.col(c) if isinstance(c, str) else c, digits)


# ---- nested report (entry point B) ------------------------------------------

def _report_inputs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    keep = ("region", "date")
    # the month is cut out of the orders' scan; the report's own predicate is on the derived date
    docs = fl.explode_items(td.trending_docs(spark, sf_dir, REPORT_DATE), keep=keep)
    flat = fl.cast_counts(fl.flatten_item(docs.withColumn("channel", F.col("item.snippet.channelTitle")), (*keep, "channel")))
    items = flat.drop("comment_count").withColumnsRenamed({"published_at_raw": "video_published_at", "view_count": "views", "like_count": "video_likes"})
    comments = fl.flatten_comments(td.comment_records(spark, sf_dir, REPORT_DATE), keep=keep, outer=False)
    return items, comments


def _report(spark: SparkSession, sf_dir: str, order_by: str) -> DataFrame:
    items, comments = _report_inputs(spark, sf_dir)
    out = rp.trending_report(items, comments, REPORT_REGION, REPORT_DATE, order_by=order_by)
    return out.withColumn("avg_comment_likes", _r("avg_comment_likes"))


@query("report_top_by_views")
def report_top_by_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P01 P04 P05 A02 J02 J05 P12 F05 O03."""
    return _report(spark, sf_dir, "views")


@query("report_top_by_comments")
def report_top_by_comments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O04 + the report above."""
    return _report(spark, sf_dir, "comment_count")


# ---- SQL-text reports (S06 S07 P04 P07) ----------------------------------------

@query("report_top_by_views_sql")
def report_top_by_views_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report as SQL text over temp views (LATERAL VIEW explode, case-insensitive fields)."""
    from trendlake.plans import sql_reports

    out = sql_reports.run_report(spark, sf_dir, REPORT_REGION, REPORT_DATE, "views")
    return out.withColumn("avg_comment_likes", _r("avg_comment_likes"))


@query("report_top_by_comments_sql")
def report_top_by_comments_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    from trendlake.plans import sql_reports

    out = sql_reports.run_report(spark, sf_dir, REPORT_REGION, REPORT_DATE, "comment_count")
    return out.withColumn("avg_comment_likes", _r("avg_comment_likes"))


# ---- flatten / unnest ------------------------------------------------------------

@query("flatten_items")
def flatten_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every trending item as a typed flat row."""
    docs = td.trending_docs(spark, sf_dir)
    return fl.flatten_trending(docs, keep=("region", "date")).withColumn("tags", F.array_join("tags", "|"))


@query("flatten_comments_outer")
def flatten_comments_outer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """explode_outer keeps videos without comments; inner id falls back."""
    recs = td.comment_records(spark, sf_dir)
    return fl.flatten_comments(recs, keep=("region", "date"), outer=True)


@query("flatten_threads")
def flatten_threads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Comment-thread pages -> comment rows."""
    return fl.flatten_threads(td.thread_pages(spark, sf_dir))


@query("flatten_flat_json")
def flatten_flat_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first version's flat records (camelCase) -> snake_case typed rows."""
    return fl.flatten_flat_json(flatten_flat_json_src(spark, sf_dir))


@query("cap_list_per_key")
def cap_list_per_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 3 turns of every conversation, in turn order."""
    conv = td.table(spark, sf_dir, "conversations").filter(F.col("text").isNotNull())
    return fl.cap_per_key(conv, ["conv_id"], [F.col("turn")], 3).select("conv_id", "pos", "turn", "role", "text")


@query("cap_list_array")
def cap_list_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    """of each video keep the first 5 landed comments that have an id. A page can hold no
    more than its first 5 of them, so pages are cut before videos are brought together."""
    recs = td.comment_records(spark, sf_dir, with_page=True)
    capped = recs.select("region", "date", "videoId", "page", F.posexplode(fl.cap_list("comments", 5, "videoId")).alias("at", "x"))
    return fl.cap_per_key(capped, ["region", "date", "videoId"], ["page", "at"], 5).select(
        "region",
        "date",
        F.col("videoId").alias("video_id"),
        "pos",
        F.col("x.authorDisplayName").alias("author_display_name"),
        F.col("x.likeCount").alias("like_count"),
    )


@query("landing_summary")
def landing_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-region harvest summary of the landed documents."""
    return rp.harvest_summary(td.trending_docs(spark, sf_dir), td.comment_lines(spark, sf_dir))


@query("path_partition_keys")
def path_partition_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Regex captures on URL paths (``''`` when absent)."""
    from trendlake.functions.text import regex_capture

    pages = td.table(spark, sf_dir, "pages")
    return pages.select(
        "page_id",
        regex_capture("url", r"://([^/]+)/").alias("host"),
        regex_capture("url", r"/([a-z]{2})/").alias("lang"),
        regex_capture("url", r"/([0-9]+)").alias("doc"),
        regex_capture("url", r"page=([^&#]+)").alias("page"),
    )


# ---- curation -------------------------------------------------------------------

def _event_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = td.table(spark, sf_dir, "events")
    return e.select(
        "event_id",
        F.col("event_type").alias("region"),
        F.to_date("ts").alias("trending_date"),
        F.col("user_id").cast("string").alias("video_id"),
        F.round(F.col("value") * 100).cast("bigint").alias("view_count"),
        F.get_json_object("props", "$.k").try_cast("bigint").alias("like_count"),
    )


@query("dedup_latest_key")
def dedup_latest_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W01 F08 (reference keys): one row per video across regions and days."""
    from trendlake.operators.curate import REFERENCE_KEYS, dedup

    return dedup(_event_items(spark, sf_dir), REFERENCE_KEYS, tiebreak=[F.col("event_id")])


@query("dedup_snapshot_key")
def dedup_snapshot_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per (region, day, video)."""
    from trendlake.operators.curate import SNAPSHOT_KEYS, dedup

    return dedup(_event_items(spark, sf_dir), SNAPSHOT_KEYS, tiebreak=[F.col("event_id")])


@query("required_fields")
def required_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers joined to their orders; rows missing required fields dropped."""
    from trendlake.operators.curate import require

    c = td.table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")
    o = td.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    j = c.join(o, c.c_custkey == o.o_custkey, "left").drop("o_custkey")
    return require(j, ["c_name", "o_orderkey", "o_totalprice"])


@query("date_features")
def date_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ISO-8601 text -> timestamp -> date/hour/year/ISO week; bad text -> null."""
    from trendlake.functions.dates import date_parts, parse_timestamp

    o = td.table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.date_format("o_orderdate", td.ISO_TS).alias("published_at_raw"),
        F.col("o_orderpriority").alias("junk"),
    )
    ts = o.withColumn("published_at", parse_timestamp("published_at_raw"))
    return ts.select(
        "o_orderkey",
        *[c.alias(n) for n, c in date_parts("published_at", "published").items()],
        parse_timestamp("junk").isNull().alias("junk_is_null"),
    )


@query("title_clean")
def title_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Page title + its URL -> lower case, URL removed, spaces collapsed."""
    from trendlake.functions.text import clean_title

    p = td.table(spark, sf_dir, "pages")
    title = F.concat(
        F.regexp_extract("html", r"<title>(.*?)</title>", 1), F.lit("  "), F.col("url"), F.lit(" \t End")
    )
    return p.select("page_id", title.alias("title")).withColumn("title_clean", clean_title("title"))


@query("ascii_label")
def ascii_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole text stripped of non-ASCII; 40-char ASCII label with ellipsis."""
    from trendlake.functions.text import ascii_only, short_label

    d = td.table(spark, sf_dir, "documents")
    return d.select("doc_id", ascii_only("text").alias("ascii_text"), short_label("text", 40).alias("short_title"))


@query("short_label")
def short_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    """20-character name prefix for chart axes."""
    from trendlake.functions.text import prefix

    p = td.table(spark, sf_dir, "part")
    return p.select("p_partkey", "p_name", prefix("p_name", 20).alias("short_title"))


# ---- features and labels ----------------------------------------------------------


# The test lexicon.  The supplied documents are invented prose,
# so common function words stand in for sentiment words; every scoring
# branch (positive, negative, mixed, no hit) occurs in the data.
FIXTURE_POSITIVE = ("the", "and", "in")
FIXTURE_NEGATIVE = ("of", "by", "on")
AS_OF = "2024-01-30"
SERIES = ("region", "video_id", "ingest_date")


def _features(spark: SparkSession, sf_dir: str, output: str = "all", latest_by: str = "global", sentiment=None):
    return ft.build_features(td.snapshots(spark, sf_dir), sentiment, output=output, latest_by=latest_by)


@query("lag_lead_features")
def lag_lead_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """previous/next snapshot values and day gaps."""
    return _features(spark, sf_dir).select(
        *SERIES, "prev_view_count", "prev_like_count", "prev_comment_count", "prev_ingest_date",
        "next_view_count", "next_ingest_date", "delta_days",
    )


@query("engagement_features")
def engagement_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Velocities, growth and engagement ratios, age, log counts."""
    return _features(spark, sf_dir).select(
        *SERIES, "view_velocity", "like_velocity", "comment_velocity", "view_growth_ratio",
        "like_growth_ratio", "comment_growth_ratio", "like_view_ratio", "comment_view_ratio",
        "engagement_per_view", "video_age_days",
        _r("log_view_count").alias("log_view_count"),
        _r("log_like_count").alias("log_like_count"),
        _r("log_comment_count").alias("log_comment_count"),
    )


def _label_cols():
    return [
        _r("log_next_view_count").alias("log_next_view_count"),
        _r("log_view_growth_next").alias("log_view_growth_next"),
        "stay_trending_next",
    ]


@query("next_day_labels")
def next_day_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Next-day log views, growth label, stay-trending label (full backfill)."""
    return _features(spark, sf_dir).select(*SERIES, *_label_cols())


@query("features_latest")
def features_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The daily slice — rows of the global latest date (labels empty by construction)."""
    return _features(spark, sf_dir, "latest").select(
        *SERIES, "view_count", "prev_view_count", "delta_days", "view_velocity", *_label_cols()
    )


@query("features_latest_by_region")
def features_latest_by_region(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q8: the daily slice with each region's own latest date."""
    return _features(spark, sf_dir, "latest", latest_by="region").select(
        *SERIES, "view_count", "prev_view_count", "delta_days", *_label_cols()
    )


@query("features_matured")
def features_matured(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q4/Q7: rows older than their region's latest date (labels have seen a later day)."""
    return _features(spark, sf_dir, "matured").select(*SERIES, "view_count", "next_view_count", *_label_cols())


# ---- sentiment --------------------------------------------------------------------

def _scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = td.comment_rows(spark, sf_dir)
    return st.score_lexicon(rows, "comment_text", FIXTURE_POSITIVE, FIXTURE_NEGATIVE)


def _sentiment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return st.aggregate_sentiment(_scored(spark, sf_dir))


SCORE_COLS = ("sentiment_pos", "sentiment_neg", "sentiment_neu", "sentiment_mix")
AVG_COLS = (
    "avg_comment_sent_pos", "avg_comment_sent_neg", "avg_comment_sent_neu", "avg_comment_sent_mix",
    "net_comment_sentiment",
)


@query("sentiment_score_lexicon")
def sentiment_score_lexicon(spark: SparkSession, sf_dir: str) -> DataFrame:
    """U01 (native): lexicon scores of every whole comment text."""
    return _scored(spark, sf_dir).select("doc_id", *SERIES, *SCORE_COLS)


@query("sentiment_score_pandas")
def sentiment_score_pandas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """U01 + S12 (pluggable): the same scores through Arrow batches (mapInPandas)."""
    rows = td.comment_rows(spark, sf_dir)
    fn = st.lexicon_batch_scorer(FIXTURE_POSITIVE, FIXTURE_NEGATIVE)
    return st.score_batches(rows, "comment_text", ["doc_id", *SERIES], fn)


@query("sentiment_score_join")
def sentiment_score_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """U01 for a lexicon table of any size: the same scores from tokens joined to words."""
    words = [(w, 1) for w in FIXTURE_POSITIVE] + [(w, -1) for w in FIXTURE_NEGATIVE]
    lexicon = spark.createDataFrame(words, "word string, polarity int")
    return st.score_lexicon_join(td.comment_rows(spark, sf_dir), ["doc_id", *SERIES], lexicon)


@query("sentiment_fallback")
def sentiment_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A scorer that fails on texts with a table bar; the failures are counted."""
    good = st.lexicon_batch_scorer(FIXTURE_POSITIVE, FIXTURE_NEGATIVE)

    def failing(texts):
        if texts.str.contains("|", regex=False).any():
            raise ValueError("no tables, please")
        return good(texts)

    scored = st.score_batches(td.comment_rows(spark, sf_dir), "comment_text", ["lang", "source"], failing)
    agg = st.aggregate_sentiment(scored, keys=("lang", "source"))
    return agg.select("lang", "source", "comment_count_scored", "fallback_count", _r("avg_comment_sent_neu").alias("avg_comment_sent_neu"))


@query("sentiment_aggregate")
def sentiment_aggregate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-snapshot score means, net sentiment and scored-comment count."""
    agg = _sentiment(spark, sf_dir)
    return agg.select(*SERIES, *[_r(c).alias(c) for c in AVG_COLS], "comment_count_scored")


@query("sentiment_by_source")
def sentiment_by_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A01 over wider groups (language, source): averaging over many comments."""
    agg = st.aggregate_sentiment(_scored(spark, sf_dir), keys=("lang", "source"))
    return agg.select("lang", "source", *[_r(c).alias(c) for c in AVG_COLS], "comment_count_scored")


@query("dominant_sentiment")
def dominant_sentiment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dominant label per snapshot (ordered tie-break, 'unknown' if all null)."""
    lab = st.dominant_sentiment(_sentiment(spark, sf_dir))
    return lab.select(*SERIES, "dominant_sentiment", _r("net_comment_sentiment").alias("net_comment_sentiment"))


@query("features_with_sentiment")
def features_with_sentiment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every snapshot's features left-joined to its sentiment; gaps filled with 0."""
    f = _features(spark, sf_dir, "all", sentiment=_sentiment(spark, sf_dir))
    return f.select(
        *SERIES, "view_count", *[_r(c).alias(c) for c in AVG_COLS], "comment_count_scored", "has_sentiment"
    )


# ---- dashboards ---------------------------------------------------------------------

def _top_with_sentiment(spark: SparkSession, sf_dir: str, keys=("video_id", "region", "trending_date")):
    top = rp.top_videos(td.snapshots(spark, sf_dir), 200)
    return rp.top_with_sentiment(top, st.sentiment_for_dashboard(_sentiment(spark, sf_dir)), keys)


@query("top_videos")
def top_videos(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 200 most viewed snapshots."""
    return rp.top_videos(td.snapshots(spark, sf_dir), 200)


@query("top_with_sentiment")
def top_with_sentiment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J03 O01 (snapshot keys): top-200 snapshots with their sentiment label."""
    return _top_with_sentiment(spark, sf_dir).withColumn(
        "max_comment_sentiment", _r("max_comment_sentiment")
    )


@query("top_with_sentiment_video_key")
def top_with_sentiment_video_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J03 with the dashboard's video-only key: fans out over a video's regions/days (Q9)."""
    return _top_with_sentiment(spark, sf_dir, ("video_id",)).withColumn(
        "max_comment_sentiment", _r("max_comment_sentiment")
    )


@query("sentiment_counts")
def sentiment_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Top snapshots per dominant label (null label shown as 'None'), sorted."""
    return rp.sentiment_counts(_top_with_sentiment(spark, sf_dir))


@query("sentiment_distinct")
def sentiment_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct top videos per dominant label, sorted."""
    return rp.sentiment_counts(_top_with_sentiment(spark, sf_dir), distinct=True)


@query("sentiment_means")
def sentiment_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean views / like ratio / comment-view ratio per label, sorted."""
    m = rp.sentiment_means(_top_with_sentiment(spark, sf_dir))
    means = ("avg_view_count", "avg_like_ratio", "avg_comment_view_ratio")
    return m.select("dominant_sentiment", *[_r(c).alias(c) for c in means], "rank")


@query("top_n_by_region")
def top_n_by_region(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Top 20 of one region on the as-of day."""
    return rp.top_videos_by_region(td.snapshots(spark, sf_dir), "view", 20, AS_OF)


@query("top_n_today")
def top_n_today(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O02 with no region filter."""
    return rp.top_videos_by_region(td.snapshots(spark, sf_dir), None, 20, AS_OF)


@query("top_n_per_region")
def top_n_per_region(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O02 for every region and day at once: top 5 per (region, day)."""
    snap = td.snapshots(spark, sf_dir)
    return rp.top_per_group(
        snap, ["region", "trending_date"], 5, [F.col("view_count").desc(), F.col("video_id")]
    ).select(*rp.TOP_COLUMNS)


@query("latest_join")
def latest_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the latest snapshot date (scalar subquery, no driver collect)."""
    return rp.latest_rows(td.snapshots(spark, sf_dir)).select(*SERIES, "view_count")


@query("distinct_days")
def distinct_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row count and distinct snapshot days."""
    return td.snapshots(spark, sf_dir).agg(
        F.count(F.lit(1)).alias("row_count"), F.count_distinct("ingest_date").alias("distinct_days")
    )


@query("label_balance")
def label_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per stay-trending label."""
    return _features(spark, sf_dir).groupBy("stay_trending_next").agg(F.count(F.lit(1)).alias("count"))


@query("region_day_counts")
def region_day_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Snapshot rows per region (the backfill's per-region log)."""
    return td.snapshots(spark, sf_dir).groupBy("region").agg(F.count(F.lit(1)).alias("count"))


# ---- training-set preparation and splits ---------------------------------------------



def _labeled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _features(spark, sf_dir, "all", sentiment=_sentiment(spark, sf_dir))


@query("inf_to_null")
def inf_to_null_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P20: +/-Infinity become null before training (infinities injected where a
    neighbour snapshot is missing)."""
    from trendlake.functions.numeric import inf_to_null

    f = _features(spark, sf_dir)
    g = (
        F.when(F.col("prev_view_count").isNull(), F.lit(float("inf")))
        .when(F.col("next_view_count").isNull(), F.lit(float("-inf")))
        .otherwise(F.col("view_growth_ratio"))
    )
    return f.select(*SERIES, inf_to_null(g).alias("growth_clean"), inf_to_null(g).isNull().alias("was_infinite"))


@query("training_frame")
def training_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cleaned regression training rows (label present)."""
    t = ml.regression_frame(_labeled(spark, sf_dir))
    return t.select(*SERIES, _r("log_view_growth_next").alias("log_view_growth_next"), "like_view_ratio",
                    "comment_count_scored")


@query("time_split")
def time_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """test = the last 3 days back from the max date (4 dates), train before."""
    t = ml.regression_frame(_labeled(spark, sf_dir))
    dates = _features(spark, sf_dir).where(F.col(ml.REG_LABEL).isNotNull())  # no text is scored for the maximum
    return t.select(*SERIES, ml.time_split_column(t, dates=dates).alias("split"))


@query("hash_split")
def hash_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """80/20 split by a hash of the row key (stable under repartitioning): the hash mode."""
    t = ml.regression_frame(_labeled(spark, sf_dir))
    return t.select(*SERIES, ml.split_column(t, "hash").alias("split"))


# ---- models ---------------------------------------------------------------------------

def _metrics_frame(spark: SparkSession, info: dict) -> DataFrame:
    return spark.createDataFrame([info], "task string, label string, metric string, value double, "
                                         "split string, n_train long, n_test long, features string")


def _evaluated(spark: SparkSession, sf_dir: str, task: str) -> DataFrame:
    """The evaluation's counts and settings, and whether its value is the one that the scored test
    rows give again: the root of the mean square in SQL, or the share of pairs in order. (SQL
    cannot fit the model, but can tell which rows it is fitted and tested on.)"""
    labeled = _checkpointed_labels(spark, sf_dir)
    model, info = ml.train_and_evaluate(labeled, task)
    scored = ml.scored_test_rows(labeled, task, model).checkpoint(eager=True)
    if task == "regression":
        again = spark.sql("SELECT sqrt(avg(power(score - label, 2))) AS again FROM {scored}", scored=scored)
    else:
        again = ev.ranking_metrics(scored, "score", "label").select(F.col("auc").alias("again"))
    return _metrics_frame(spark, info).crossJoin(again).select(
        "task", "label", "metric", "split", "n_train", "n_test", "features", (F.abs(F.col("value") - F.col("again")) <= 1e-9 * (1 + F.abs("again"))).alias("value_ok"))


@query("train_eval_regression")
def train_eval_regression(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Boosted trees on the growth label, RMSE on the time split's test days."""
    return _evaluated(spark, sf_dir, "regression")


@query("train_eval_classification")
def train_eval_classification(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Logistic regression on stay-trending (matured rows), ROC-AUC."""
    return _evaluated(spark, sf_dir, "classification")


def _checkpointed_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The labeled features, materialised once in the shared checkpoint folder:
    both fits and the scoring read it instead of recomputing the window, the
    scoring of every comment and the join (a lost executor re-reads files)."""
    from trendlake.session import shared_dir

    shared_dir(spark)
    return _labeled(spark, sf_dir).checkpoint(eager=True)


def _predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The latest day scored by the evaluated models, those of the splits' train sides."""
    labeled = _checkpointed_labels(spark, sf_dir)
    reg, _ = ml.train_and_evaluate(labeled, "regression")
    cls, _ = ml.train_and_evaluate(labeled, "classification")
    return ml.score(ft.keep_latest(labeled, td.snapshot_days(spark, sf_dir)), reg, cls)


@query("predict_next_day")
def predict_next_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Next-day growth, views and stay probability for the latest day. The
    fitted numbers have no SQL twin; what must hold between them is checked per row."""
    p = _predictions(spark, sf_dir)
    near = F.abs(F.col("pred_view_count_next") - F.expm1(F.col("log_view_count") + F.col("pred_log_view_growth_next")))
    prob = F.col("prob_stay_trending_next")
    return p.select(
        *SERIES, "view_count", "like_count", "comment_count", _r("log_view_count").alias("log_view_count"),
        (near <= 1e-6 * (1 + F.abs("pred_view_count_next"))).alias("views_follow_growth"),
        prob.between(0.0, 1.0).alias("is_probability"),
        (F.col("pred_stay_trending_next") == (prob > 0.5).cast("double")).alias("label_follows_probability"))


@query("prediction_report")
def prediction_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M15 O05 X07 X09 X10 on real predictions: the first 20 by stay probability, as the
    DataFrame report and as the SQL panel; per rank what must hold."""
    from trendlake.plans.sql_reports import prediction_panel_sql

    predictions = _predictions(spark, sf_dir).checkpoint(eager=True)
    order = Window.orderBy(F.col("prob_stay_trending_next").desc(), "region", "video_id")
    report = rp.prediction_report(predictions)
    first = report.select("*", F.row_number().over(order).alias("rank"))
    panel = prediction_panel_sql(spark, predictions).select(
        F.struct(*[F.col(c) for c in report.columns]).alias("panel"), F.row_number().over(order).alias("rank"))
    return first.join(panel, "rank").select(
        "rank", F.to_json(F.struct(*[F.col(c) for c in report.columns])).eqNullSafe(F.to_json("panel")).alias("panel_agrees"),
        F.col("prob_percentage").endswith("%").alias("is_percentage"),
        (F.col("stay_trending") == F.when(F.col("prob_stay_trending_next") > 0.5, "Yes").otherwise("No")).alias("answer_follows"),
        F.col("title").startswith(F.col("short_title")).alias("title_is_cut"))


@query("probability_display")
def probability_display(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O05 X07 X09 X10 J04 by value, on a probability made of the snapshot's own counts."""
    p = (F.col("view_count") % 997) / F.lit(997.0)
    snap = td.snapshots(spark, sf_dir).withColumn("prob_stay_trending_next", p).withColumn(
        "pred_stay_trending_next", (F.col("prob_stay_trending_next") > 0.5).cast("double"))
    report = rp.prediction_report(snap, 20, title_chars=8)
    return report.withColumn("prob_stay_trending_next", _r("prob_stay_trending_next"))


@query("model_roundtrip")
def model_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Save the regression pipeline to the shared folder, load it, score: the loaded
    model answers as the saved one."""
    from trendlake.session import scratch_path
    from trendlake.sources.models import load_model, save_model

    labeled = _checkpointed_labels(spark, sf_dir)
    path = scratch_path(spark, "model")
    saved, _ = ml.train_and_evaluate(labeled, "regression")
    save_model(saved, path)
    latest = ft.keep_latest(labeled, td.snapshot_days(spark, sf_dir))
    features = ml.NUMERIC_FEATURES
    rows = latest.select(*SERIES, *[F.col(c).cast("double") for c in features])
    here = saved.transform(rows).select(*SERIES, F.col("prediction").alias("here"))
    loaded = load_model(path).transform(rows).select(*SERIES, F.col("prediction").alias("there"))
    return here.join(loaded, list(SERIES)).select(*SERIES, (F.col("here") == F.col("there")).alias("same_prediction"))


# ---- curves, drift, rolling and summaries -------------------------------------------------

def _constructed_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Matured snapshots with a score that SQL can give too; the label is whether the series goes on."""
    return _features(spark, sf_dir, "matured").select(
        *SERIES, (F.expr("cast(view_count % 997 as double)") / 997.0).alias("score"), F.col("stay_trending_next").alias("label"))


@query("precision_recall_curve")
def precision_recall_curve(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Precision, recall and false positive rate at every distinct score."""
    c = ev.precision_recall(_constructed_scores(spark, sf_dir), "score", "label")
    return c.select(_r("threshold").alias("threshold"), "tp", "fp", *[_r(x).alias(x) for x in ("precision", "recall", "false_positive_rate")])


@query("ranking_metrics")
def ranking_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Area under the ROC curve and average precision, exact."""
    m = ev.ranking_metrics(_constructed_scores(spark, sf_dir), "score", "label")
    return m.select(_r("auc").alias("auc"), _r("average_precision").alias("average_precision"), "n_positive", "n_negative")


@query("calibration_bins")
def calibration_bins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean score against the share of positives in ten ranges of the score."""
    c = ev.calibration(_constructed_scores(spark, sf_dir), "score", "label")
    return c.select("bin", "n", *[_r(x).alias(x) for x in ("mean_score", "positive_share", "gap")])


@query("rolling_days")
def rolling_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Views of the last day and the last seven days of every series, over gaps; stretches
    of nine days, so that series are split."""
    out = rolling.rolling(td.snapshots(spark, sf_dir), ["region", "video_id"], "ingest_date", ["view_count"], (1, 7), stretch_days=9)
    return out.withColumn("view_count_mean_7d", _r("view_count_mean_7d")).drop("view_count_mean_1d", "days_1d")


@query("rolling_days_by_region")
def rolling_days_by_region(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E02 on hot keys: seven-day sums of whole regions, from sums by region and day."""
    out = rolling.rolling(td.snapshots(spark, sf_dir), ["region"], "ingest_date", ["view_count", "like_count"], (7,), stretch_days=16)
    return out.drop("view_count_mean_7d", "like_count_mean_7d")


@query("summary_merge")
def summary_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily summaries written by day, one day written again, merged by region from the table
    alone; sums by value, sketches by their stated bounds against the rows."""
    from trendlake.session import scratch_path
    from trendlake.sources.tables import read_table, write_partitioned

    snaps = td.snapshots(spark, sf_dir).checkpoint(eager=True)
    path = scratch_path(spark, "summaries")
    for part in (F.col("ingest_date") <= F.lit(AS_OF).cast("date"), F.col("ingest_date") >= F.lit(AS_OF).cast("date")):
        write_partitioned(summaries.daily_summary(snaps.where(part), ["region", "ingest_date"], "video_id", "view_count"), path, ["ingest_date"])
    merged = summaries.merge_summaries(read_table(spark, path), ["region"])
    exact = snaps.join(merged.select("region", "q50"), "region").groupBy("region").agg(
        F.count_distinct("video_id").alias("d"), F.avg((F.col("view_count") < F.col("q50")).cast("double")).alias("below"),
        F.avg((F.col("view_count") <= F.col("q50")).cast("double")).alias("upto"))
    return merged.join(exact, "region").select(
        "region", "n_rows", "total", "least", "greatest",
        (F.abs(F.col("distinct_items") - F.col("d")) <= F.greatest(F.lit(1.0), F.col("d") * summaries.DISTINCT_BOUND)).alias("distinct_in_bound"),
        ((F.col("below") <= 0.5 + summaries.RANK_BOUND) & (F.col("upto") >= 0.5 - summaries.RANK_BOUND)).alias("median_in_bound"))


#: Fixed bins of the drift report, as kept with a model (``drift.fit_edges`` makes them from a reference).
DRIFT_EDGES = {"view_count": [2000.0, 5000.0, 10000.0, 20000.0, 40000.0], "like_count": [20.0, 50.0, 100.0], "comment_count": [1.0, 2.0, 3.0, 5.0]}


@query("drift_psi")
def drift_psi(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Population stability of three features, the first half of the days against the rest."""
    snaps = td.snapshots(spark, sf_dir)
    middle = F.lit("2024-01-16").cast("date")
    out = drift.stability(snaps.where(F.col("ingest_date") < middle), snaps.where(F.col("ingest_date") >= middle), DRIFT_EDGES)
    return out.withColumn("psi", _r("psi"))


@query("catalog_table_sql")
def catalog_table_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Snapshots as a partitioned table of the session's catalog, entered partition by
    partition, and a report in SQL whose day and region prune directories."""
    from uuid import uuid4

    from trendlake.session import scratch_path
    from trendlake.sources.catalog import register_table
    from trendlake.sources.tables import run_sql, write_partitioned

    path, name = scratch_path(spark, "catalog-table"), f"snapshots_{uuid4().hex[:12]}"
    snaps = td.snapshots(spark, sf_dir).select(*SNAP_OUT)
    write_partitioned(snaps, path, ["region", "ingest_date"])
    register_table(spark, name, path, snaps.schema, ["region", "ingest_date"])
    return run_sql(spark, f"""
        SELECT region, ingest_date, count(*) AS videos, sum(view_count) AS views, max(title) AS last_title FROM {name}
        WHERE region IN ('view', 'click') AND ingest_date BETWEEN DATE '2024-01-05' AND DATE '2024-01-09' GROUP BY region, ingest_date""")


@query("comments_stream_dedup")
def comments_stream_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A landing read as a stream in three runs from one checkpoint: two years, then months that
    land late and months that land again, then a last part; every comment once. (Ship dates, the
    comments' times, go over all years, and so does the delay.)"""
    from trendlake.session import scratch_path
    from trendlake.sources.landing import write_landing_json
    from trendlake.sources.tables import read_table
    from trendlake.streaming.dedup import dedup_comments_stream, drain

    landing, sink, checkpoint = (scratch_path(spark, f"stream-dedup-{x}") for x in ("landing", "sink", "checkpoint"))
    recs = keep(td.comment_records(spark, sf_dir), "stream-dedup-records")
    d, late = F.col("date"), F.col("date").isin(*[F.lit(x).cast("date") for x in ("1995-06-01", "1996-03-01")])
    first = (F.year(d) <= 1996) & ~late
    again = F.year(d) == 1996
    for k, part in enumerate((first, late | again, F.year(d) > 1996)):
        write_landing_json(recs.where(part), landing, mode="append")
        drain(dedup_comments_stream(spark, landing, sink, checkpoint, delay="3000 days"))
    out = read_table(spark, sink)
    return out.groupBy("region", F.trunc(F.to_date("event_time"), "month").alias("month")).agg(
        F.count(F.lit(1)).alias("comments"), F.count_distinct("video_id").alias("videos"))


@query("comment_topics")
def comment_topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The vocabulary that topics are learned from, with its counts, and whether the fitted masses are
    distributions: those of every comment over topics, and of every topic over terms."""
    from trendlake.operators import topics

    how = topics.Settings(steps=5)
    rows = td.comment_rows(spark, sf_dir)
    model, vectors, massed = topics.fit_topics(rows, settings=how)
    whole = F.abs(F.aggregate(vector_to_array("topic_mass"), F.lit(0.0), lambda a, x: a + x) - 1)
    words = topics.topic_terms(model, vectors, how.terms).groupBy("topic").agg(F.abs(F.sum("weight") - 1).alias("off"))
    ok = massed.agg(F.max(F.when(F.size(topics.terms_of(F.col("comment_text"))) > 0, whole)).alias("a")).crossJoin(words.agg(F.max("off").alias("b")))
    terms = topics.vocabulary(rows, settings=how)
    return terms.crossJoin(ok.select(((F.coalesce("a", F.lit(0.0)) < 1e-6) | (F.abs(F.col("a") - 1) < 1e-6)).alias("comments_ok"), (F.col("b") < 1e-6).alias("topics_ok")))


@query("sweep_folds")
def sweep_folds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two settings of the classifier over two time-ordered folds: the folds' rows, and whether a value
    is an area."""
    from pyspark.ml.classification import LogisticRegression

    from trendlake.operators.sweep import sweep

    grid = {f"reg={r}": LogisticRegression(maxIter=10, regParam=r) for r in (0.0, 0.1)}
    rows, best = sweep(_features(spark, sf_dir, "all"), "classification", grid, folds=2, features=ml.NUMERIC_FEATURES[:7])
    return rows.select("setting", "fold", "n_train", "n_test", F.coalesce(F.col("value").between(0.0, 1.0), F.lit(True)).alias("value_ok"),
                       F.lit(best in grid).alias("best_is_of_the_grid"))


@query("bounded_report")
def bounded_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The panel of a given day as the dashboard takes it: its columns are checked, a bounded
    number of rows comes to the driver, and these are shown."""
    from trendlake.sources.tables import assert_schema, bounded_to_pandas

    top = rp.top_videos_by_region(td.snapshots(spark, sf_dir), None, 20, "2024-01-09")
    assert_schema(top, rp.TOP_COLUMNS)
    return spark.createDataFrame(bounded_to_pandas(top, 20), top.schema)


# ---- sinks and landing round trips ------------------------------------------------------

SNAP_OUT = ("region", "video_id", "ingest_date", "trending_date", "view_count", "like_count", "comment_count",
            "title", "channel_id")


def _write_snap(spark: SparkSession, sf_dir: str, modes: tuple[str, ...], name: str) -> DataFrame:
    from trendlake.session import scratch_path
    from trendlake.sources.tables import read_table, write_partitioned

    snap = td.snapshots(spark, sf_dir)
    path = scratch_path(spark, name)
    for mode in modes:
        src = ft.keep_latest(snap) if mode == "static-latest" else snap
        write_partitioned(src, path, ["region", "ingest_date"], mode.split("-")[0])
    return read_table(spark, path).select(*SNAP_OUT)


@query("sink_roundtrip_dynamic")
def sink_roundtrip_dynamic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dynamic partition overwrite, run twice — the table is unchanged."""
    return _write_snap(spark, sf_dir, ("dynamic", "dynamic"), "sink-dynamic")


@query("sink_append")
def sink_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Append, run twice — every row twice (why the daily jobs do not append)."""
    return _write_snap(spark, sf_dir, ("append", "append"), "sink-append")


@query("sink_static")
def sink_static(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Static overwrite with one day's rows replaces the whole table."""
    return _write_snap(spark, sf_dir, ("dynamic", "static-latest"), "sink-static")


@query("json_landing_roundtrip")
def json_landing_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S01 S08 S09 S10 S21 + job 1: land trending documents as JSON under
    region=/date=, read them back, curate (dedup, dates, cleaned title)."""
    from trendlake.operators.curate import curate_trending
    from trendlake.session import scratch_path
    from trendlake.sources.landing import read_trending_docs, write_landing_json

    path = scratch_path(spark, "landing-trending")
    write_landing_json(td.trending_docs(spark, sf_dir).drop("page"), path)
    cur = curate_trending(read_trending_docs(spark, path))
    return cur.drop("source_file").withColumns(
        {"tags": F.array_join("tags", "|"), "published_at": F.date_format("published_at", "yyyy-MM-dd HH:mm:ss")}
    )


@query("json_comments_roundtrip")
def json_comments_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S02 S03 S09 S10 S21 + job 2: land comment records, read back, curate."""
    from trendlake.operators.curate import curate_comments
    from trendlake.session import scratch_path
    from trendlake.sources.landing import read_comment_records, write_landing_json

    path = scratch_path(spark, "landing-comments")
    write_landing_json(td.comment_records(spark, sf_dir), path)
    return curate_comments(read_comment_records(spark, path))


@query("flat_json_roundtrip")
def flat_json_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flat JSON lines written and read back by the first version's reader."""
    from trendlake.session import scratch_path
    from trendlake.sources.landing import read_flat_json

    path = scratch_path(spark, "landing-flat")
    flatten_flat_json_src(spark, sf_dir).write.json(path)
    return fl.flatten_flat_json(read_flat_json(spark, path))


@query("landing_one_day")
def landing_one_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One region and month of the landed documents, by directory pruning."""
    from trendlake.session import scratch_path
    from trendlake.sources.landing import read_trending_docs, write_landing_json

    path = scratch_path(spark, "landing-days")
    write_landing_json(td.trending_docs(spark, sf_dir).drop("page"), path)
    one = read_trending_docs(spark, path, regions=[REPORT_REGION], days=[REPORT_DATE])
    return fl.flatten_trending(one).select("video_id", "title", "view_count", "like_count", "comment_count")


def _put(spark: SparkSession, path: str, data: bytes) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    out = target.getFileSystem(spark._jsc.hadoopConfiguration()).create(target)
    out.write(bytearray(data))
    out.close()


@query("landing_quarantine")
def landing_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A landing of every order as gzip JSON, and one record per nation in a whole and in a
    damaged file of each codec and as plain text: what is kept and what is set aside, by codec.

    The damaged files are cut short by 12 bytes, so the plain one loses its last record.
    """
    import bz2
    import gzip

    import zstandard

    from trendlake.schemas import RAW_FLAT
    from trendlake.session import scratch_path
    from trendlake.sources.quarantine import landing_report, read_with_quarantine

    path = scratch_path(spark, "landing-quarantine")
    flatten_flat_json_src(spark, sf_dir).write.option("compression", "gzip").json(f"{path}/day=1")
    nations = td.table(spark, sf_dir, "nation").select(F.to_json(F.struct(F.col("n_name").alias("videoId")))).collect()  # 25 rows
    text = "".join(f"{r[0]}\n" for r in nations).encode()
    packed = {"gz": gzip.compress(text), "bz2": bz2.compress(text), "zst": zstandard.compress(text), "json": text}
    for name, data in packed.items():
        _put(spark, f"{path}/day=2/whole.{name}", data)
        _put(spark, f"{path}/day=3/short.{name}", data[:-12])
    _put(spark, f"{path}/day=3/unknown.lz4", text)
    _put(spark, f"{path}/day=3/noname", text)
    rows, quarantine = read_with_quarantine(spark, path, RAW_FLAT)
    by_codec = F.regexp_extract("file", r"\.([^./]+)$", 1).alias("codec")
    return landing_report(rows, quarantine).groupBy(by_codec).agg(
        F.sum("kept").alias("kept"), F.sum("malformed").alias("malformed"), F.sum(F.col("damaged").cast("long")).alias("damaged_files"))


@query("features_daily_chain")
def features_daily_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The daily feature job from an empty table: a first run over missed days, runs for
    single days, a day that lands late, one that lands again, and a last run over the
    rest; each looks up its series' neighbours in the index. It gives the backfill's labels."""
    from trendlake.operators.series import renew_features
    from trendlake.session import scratch_path
    from trendlake.sources.tables import read_table, write_partitioned

    source, path, index = (scratch_path(spark, f"daily-{name}") for name in ("snapshots", "features", "index"))
    snaps = td.snapshots(spark, sf_dir).checkpoint(eager=True)
    days = [str(r[0]) for r in snaps.select("ingest_date").distinct().orderBy("ingest_date").collect()]  # one row per day
    runs = [days[:4] + days[5:9], days[9:10], days[4:5], days[9:10], days[10:]]
    for run in filter(None, runs):
        write_partitioned(snaps.where(F.col("ingest_date").isin(*[F.lit(d).cast("date") for d in run])), source, ["region", "ingest_date"])
        renew_features(read_table(spark, source), None, path, index, run)
    return read_table(spark, path).select(*SERIES, "view_count", "prev_view_count", "delta_days", "next_view_count", *_label_cols())


def flatten_flat_json_src(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = td.trending_docs(spark, sf_dir)
    return fl.explode_items(docs, keep=("region",)).select(
        F.col("item.id").alias("videoId"),
        F.col("item.snippet.title").alias("title"),
        F.col("item.snippet.channelTitle").alias("channelTitle"),
        F.col("item.snippet.categoryId").alias("categoryId"),
        F.col("item.snippet.publishedAt").alias("publishedAt"),
        F.col("region").alias("regionCode"),
        F.col("item.statistics.viewCount").alias("viewCount"),
        F.col("item.statistics.likeCount").alias("likeCount"),
        F.col("item.statistics.commentCount").alias("commentCount"),
    )


@query("stream_curate_comments")
def stream_curate_comments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The comment curation as an availableNow stream into an exactly-once file sink."""
    from trendlake.session import scratch_path
    from trendlake.sources.landing import write_landing_json
    from trendlake.sources.tables import read_table
    from trendlake.streaming.ingest import curate_comments_stream, run_until_drained

    landing = scratch_path(spark, "stream-landing")
    write_landing_json(td.comment_records(spark, sf_dir), landing)
    sink, ckpt = scratch_path(spark, "stream-sink"), scratch_path(spark, "stream-ckpt")
    run_until_drained(curate_comments_stream(spark, landing, sink, ckpt))
    return read_table(spark, sink).select(
        "video_id", "author_display_name", "comment_text", "like_count", "published_at", "region", "ingest_date"
    )
