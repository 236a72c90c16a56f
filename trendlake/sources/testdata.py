"""Domain frames derived from the supplied tables (``<sf_dir>/<name>.parquet``).

The supplied tables are flat TPC-H-style data; these functions re-shape them
into the reference's data model so every operator runs on real, scaling
input:

- ``snapshots``: curated trending snapshots from ``events``
  (region = event_type, video = user_id, day = date of ts).
- ``trending_docs`` / ``comment_records`` / ``thread_pages``: the nested raw
  landing documents from ``orders`` (+ customer/nation/region) and
  ``lineitem``.  Arrays are bounded by construction (``PAGE_SIZE`` elements,
  like one API page), so no record grows with the data.
- ``comment_rows``: curated comments from ``documents``, keyed onto the
  snapshot keys.

Each function has an SQL twin in ``trendlake.plans.oracle`` used by the
correctness check.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)

# Fixed values of the fixture mapping.
PAGE_SIZE = 50
COMMENT_REGIONS = ("click", "error", "purchase", "signup", "view")
COMMENT_BASE_DATE = "2024-01-01"
COMMENT_DAYS = 30
ISO_TS = "yyyy-MM-dd'T'HH:mm:ss'Z'"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# ---- snapshots -------------------------------------------------------------

def snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One snapshot per (region, video_id, day): views = sum of round(value*100),
    likes = sum of props.k, comments = event count; a video is "published" at its
    first event in the region."""
    e = table(spark, sf_dir, "events")
    daily = (
        e.select(
            F.col("event_type").alias("region"),
            F.col("user_id").cast("string").alias("video_id"),
            F.to_date("ts").alias("ingest_date"),
            "ts",
            F.round(F.col("value") * 100).cast("bigint").alias("v"),
            F.get_json_object("props", "$.k").try_cast("bigint").alias("k"),
            F.expr("user_id div 10").alias("ch"),
        )
        .groupBy("region", "video_id", "ingest_date")
        .agg(
            F.sum("v").alias("view_count"),
            F.sum("k").alias("like_count"),
            F.count(F.lit(1)).alias("comment_count"),
            F.min("ts").alias("first_ts"),
            F.max("ch").alias("ch"),
        )
    )
    series = Window.partitionBy("region", "video_id")
    return daily.select(
        "region",
        "video_id",
        "ingest_date",
        F.col("ingest_date").alias("trending_date"),
        "view_count",
        "like_count",
        "comment_count",
        F.min("first_ts").over(series).alias("published_at"),
        F.concat(F.lit("Video "), F.col("video_id")).alias("title"),
        F.concat(F.lit("ch"), F.col("ch").cast("string")).alias("channel_id"),
    )


def snapshot_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``ingest_date`` of every event: the days of ``snapshots``, without a shuffle."""
    return table(spark, sf_dir, "events").select(F.to_date("ts").alias("ingest_date"))


# ---- nested landing documents ---------------------------------------------

def order_dims(spark: SparkSession, sf_dir: str, month: str | None = None) -> DataFrame:
    """orders + customer + nation + region -> (order, region name, month).

    ``month`` (its first day) restricts to one month by a range on ``o_orderdate``,
    which the scan can push down; a predicate on the derived ``date`` cannot be.
    """
    o = table(spark, sf_dir, "orders")
    if month is not None:
        first = F.lit(month).cast("date").cast(o.schema["o_orderdate"].dataType)
        after = F.add_months(F.lit(month).cast("date"), 1).cast(o.schema["o_orderdate"].dataType)
        o = o.where((F.col("o_orderdate") >= first) & (F.col("o_orderdate") < after))
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    r = table(spark, sf_dir, "region").select("r_regionkey", F.col("r_name").alias("region"))
    return (
        o.join(c, o.o_custkey == c.c_custkey)
        .join(n, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(r, F.col("n_regionkey") == F.col("r_regionkey"))
        .withColumn("date", F.trunc(F.col("o_orderdate").cast("date"), "month"))
    )


def _item(o: DataFrame) -> Column:
    price = F.col("o_totalprice")
    return F.struct(
        F.col("o_orderkey").cast("string").alias("id"),
        F.struct(
            F.col("o_custkey").cast("string").alias("channelId"),
            F.col("c_name").alias("channelTitle"),
            F.col("o_orderpriority").alias("categoryId"),
            # every seventh title holds a link, which curation removes
            F.concat_ws(" ", F.lit("Order"), F.col("o_orderkey").cast("string"),
                        F.when(F.col("o_orderkey") % 7 == 0, F.lit("HTTPS://t.example/A?b=1")), F.col("o_orderpriority")).alias("title"),
            F.concat_ws(" ", F.lit("status"), F.col("o_orderstatus")).alias("description"),
            F.array(F.col("o_orderstatus"), F.col("o_orderpriority")).alias("tags"),
            F.lit("en").alias("defaultLanguage"),
            F.date_format("o_orderdate", ISO_TS).alias("publishedAt"),
        ).alias("snippet"),
        F.struct(
            F.round(price).cast("bigint").cast("string").alias("viewCount"),
            F.when(F.col("o_orderstatus") != "P", F.floor(price / 100).cast("bigint").cast("string"))
            .alias("likeCount"),
            F.round(price / 1000).cast("bigint").cast("string").alias("commentCount"),
        ).alias("statistics"),
        F.struct(
            F.lit("PT4M13S").alias("duration"),
            F.lit("2d").alias("dimension"),
            F.lit("hd").alias("definition"),
            F.lit("false").alias("caption"),
        ).alias("contentDetails"),
    )


def trending_docs(spark: SparkSession, sf_dir: str, month: str | None = None) -> DataFrame:
    """Raw trending documents ``(region, date, page, items[])``, at most PAGE_SIZE items each."""
    d = order_dims(spark, sf_dir, month)
    return (
        d.select("region", "date", F.expr(f"o_orderkey div {PAGE_SIZE}").alias("page"), _item(d).alias("item"))
        .groupBy("region", "date", "page")
        .agg(F.collect_list("item").alias("items"))
    )


def _comment_struct() -> Column:
    return F.struct(
        F.col("l_orderkey").cast("string").alias("videoId"),
        F.concat(F.lit("supplier-"), F.col("l_suppkey").cast("string")).alias("authorDisplayName"),
        F.concat_ws(" ", F.lit("line"), F.col("l_returnflag"), F.col("l_linestatus")).alias("textDisplay"),
        F.date_format("l_shipdate", ISO_TS).alias("publishedAt"),
        F.col("l_quantity").cast("bigint").alias("likeCount"),
    )


#: A line's page comes from its own number, so no order's lines are ranked by one task.
_PAGE = f"cast((l_linenumber - 1) div {PAGE_SIZE} as int)"


def _paged(lines: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """``keys, page, comments[]``: lines collected by page and ordered inside it."""
    order = F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_shipdate")
    kept = F.when(F.col("l_orderkey").isNotNull(), F.struct(order.alias("o"), _comment_struct().alias("c")))  # collect_list skips nulls
    return lines.withColumn("page", F.expr(_PAGE)).groupBy(*keys, "page").agg(F.sort_array(F.collect_list(kept)).alias("cs")).select(
        *keys, F.coalesce("page", F.lit(0)).alias("page"), F.transform("cs", lambda x: x["c"]).alias("comments"))


def comment_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``region, date, videoId`` per landed comment, without building records."""
    d = order_dims(spark, sf_dir).select("o_orderkey", "region", "date")
    li = table(spark, sf_dir, "lineitem").select("l_orderkey")
    return d.join(li, d.o_orderkey == li.l_orderkey).select("region", "date", F.col("o_orderkey").cast("string").alias("videoId"))


def comment_records(spark: SparkSession, sf_dir: str, month: str | None = None, with_page: bool = False) -> DataFrame:
    """Raw comment records ``(region, date, videoId, comments[])``, at most PAGE_SIZE
    comments each; orders without lines keep an empty list (comments disabled)."""
    d = order_dims(spark, sf_dir, month).select("o_orderkey", "region", "date")
    li = table(spark, sf_dir, "lineitem")
    pages = _paged(d.join(li, d.o_orderkey == li.l_orderkey, "left"), ("region", "date", "o_orderkey"))
    return pages.select("region", "date", F.col("o_orderkey").cast("string").alias("videoId"), *(["page"] if with_page else []), "comments")


def thread_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Comment-thread API pages ``(videoId, items[].snippet.topLevelComment.snippet)``."""
    pages = _paged(table(spark, sf_dir, "lineitem"), ("l_orderkey",))
    items = F.transform(
        "comments",
        lambda c: F.struct(
            F.struct(
                F.struct(
                    F.struct(
                        c["authorDisplayName"].alias("authorDisplayName"),
                        c["textDisplay"].alias("textDisplay"),
                        c["publishedAt"].alias("publishedAt"),
                        c["likeCount"].alias("likeCount"),
                    ).alias("snippet")
                ).alias("topLevelComment")
            ).alias("snippet")
        ),
    )
    return pages.select(F.col("l_orderkey").cast("string").alias("videoId"), items.alias("items"))


# ---- curated comments from documents ---------------------------------------

def comment_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Curated comments keyed onto snapshot keys (region, video_id, ingest_date)."""
    d = table(spark, sf_dir, "documents")
    regions = F.array(*[F.lit(r) for r in COMMENT_REGIONS])
    return d.select(
        F.col("doc_id"),
        F.element_at(regions, (F.expr(f"doc_id div 10") % len(COMMENT_REGIONS) + 1).cast("int")).alias("region"),
        (F.col("doc_id") % 10).cast("string").alias("video_id"),
        F.date_add(F.lit(COMMENT_BASE_DATE).cast("date"), F.expr(f"cast((doc_id div 50) % {COMMENT_DAYS} as int)"))
        .alias("ingest_date"),
        F.col("source").alias("author_display_name"),
        F.col("text").alias("comment_text"),
        F.col("n_chars").alias("like_count"),
        F.col("lang"),
        F.col("source"),
    )
