"""The daily features by as-of lookup in a compact index of each series' days.

The index holds one row per series, ``region, video_id, days`` (the sorted dates it was
seen on: four bytes a day).  It tells, without a look at any snapshot, which snapshot
came before and after a day of a series, also for a day that lands late or again.  So a
run for some days reads the partitions of these days, of their neighbours and of the
neighbours' neighbours only, and rewrites the first two; no window goes over the whole
history.  The index is written as a new version beside the old one, after the
features: a run that breaks off can be repeated.
"""

from __future__ import annotations

from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trendlake.operators.features import (
    SERIES_KEYS, add_delta_days, add_engagement, add_labels, add_lag_lead, join_sentiment, with_ingest_date,
)
from trendlake.session import scratch_path
from trendlake.sources.tables import read_table, write_partitioned

SNAPSHOT = (*SERIES_KEYS, "ingest_date")
NO_DAYS = "cast(array() as array<date>)"


def series_index(snapshots: DataFrame) -> DataFrame:
    """``region, video_id, days`` of snapshots with an ``ingest_date``."""
    return snapshots.groupBy(*SERIES_KEYS).agg(F.array_sort(F.collect_set("ingest_date")).alias("days"))


def merge_index(index: DataFrame, arrived: DataFrame, days: Sequence[str], regions: Sequence[str] | None = None) -> DataFrame:
    """``region, video_id, days, changed``: the index with ``days`` replaced by what ``arrived``
    (in ``regions`` only, if given), and those of ``days`` on which a series is or was seen.
    A series without any day left keeps its row until the next run, for its neighbours."""
    run = F.array(*[F.lit(d).cast("date") for d in days])
    empty = F.expr(NO_DAYS)
    now = series_index(arrived).withColumnRenamed("days", "now")
    old, new = F.coalesce("days", empty), F.coalesce("now", empty)
    of_run = F.array_intersect(old, run)
    if regions is not None:
        of_run = F.when(F.col("region").isin(*regions), of_run).otherwise(empty)
    return index.join(now, list(SERIES_KEYS), "full_outer").select(
        *SERIES_KEYS, F.array_sort(F.array_union(F.array_except(old, of_run), new)).alias("days"),
        F.array_sort(F.array_union(of_run, new)).alias("changed")).where((F.size("days") > 0) | (F.size("changed") > 0))


def neighbours(merged: DataFrame) -> DataFrame:
    """``region, video_id, changed, renew, needed`` of the series that changed: the days whose rows
    the change touches (the changed ones, and the one before and after each), and the
    days whose snapshots these rows are made of (the same, and one more on either side)."""
    around = "array_compact(flatten(transform({0}, d -> array(array_max(filter(days, x -> x < d)), array_min(filter(days, x -> x > d))))))"
    return merged.where(F.size("changed") > 0) \
        .withColumn("renew", F.expr(f"array_intersect(array_union(changed, {around.format('changed')}), days)")) \
        .withColumn("needed", F.expr(f"array_union(renew, {around.format('renew')})")).select(*SERIES_KEYS, "changed", "renew", "needed")


def _partitions(series: DataFrame, days: str | Column) -> Column:
    """A predicate on ``region`` and ``ingest_date`` that holds for the series' partitions. What
    comes to the driver is a list of directory names: distinct days by region."""
    per = series.select("region", F.explode(days).alias("d")).groupBy("region").agg(F.sort_array(F.collect_set("d")).alias("ds")).collect()
    out = F.lit(False)
    for r in per:
        if r["ds"]:
            out = out | (F.col("region").eqNullSafe(F.lit(r["region"])) & F.col("ingest_date").isin(*r["ds"]))
    return out


def _on_days(rows: DataFrame, series: DataFrame, days: str | Column, how: str = "left_semi") -> DataFrame:
    """``rows`` of the series on ``days`` (a semi join), or all others (an anti join). The days stay
    one array a series, and the join is never a broadcast: the size that Spark expects of compressed
    arrays says little of their rows, which are as many as the history's."""
    per = series.select(*[F.col(k).alias(f"_{k}") for k in SERIES_KEYS], F.expr(days) if isinstance(days, str) else days)
    per = per.toDF(*per.columns[:-1], "_days").hint("merge")
    same = [F.col(k) == F.col(f"_{k}") for k in SERIES_KEYS]
    return rows.join(per, [*same, F.array_contains("_days", F.col("ingest_date"))], how)


def renewed_rows(snapshots: DataFrame, series: DataFrame, sentiment: DataFrame | None) -> DataFrame:
    """The feature rows of the days to renew, from the needed snapshots alone. Between two needed
    days of a series that follow each other in its history there is no third, so the
    windows, which go over these few rows, find the true neighbours of every renewed row."""
    needed = _on_days(snapshots.where(_partitions(series, "needed")), series, "needed")
    feats = add_labels(add_engagement(add_delta_days(add_lag_lead(needed))))
    feats = _on_days(feats, series, "renew")
    if sentiment is not None:
        feats = join_sentiment(feats, sentiment.where(_partitions(series, "renew")))
    return feats


# ---- versions of the index ----------------------------------------------------------------

def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def _versions(spark: SparkSession, path: str) -> list[int]:
    """Whole versions of the index, ascending."""
    fs, done = _fs(spark, f"{path}/version=*/_SUCCESS")
    return sorted(int(s.getPath().getParent().getName().removeprefix("version=")) for s in fs.globStatus(done) or ())


def table_exists(spark: SparkSession, path: str) -> bool:
    """Whether a partitioned table has any partition."""
    fs, parts = _fs(spark, f"{path}/*=*")
    return bool(fs.globStatus(parts))


def _drop_partitions(spark: SparkSession, path: str, gone: set[tuple[str, str]]) -> None:
    """An overwrite of partitions leaves those alone that have no rows any more."""
    if gone:
        fs, parts = _fs(spark, f"{path}/region=*/ingest_date=*")
        for status in fs.globStatus(parts) or ():
            p = status.getPath()
            if (unquote(p.getParent().getName().removeprefix("region=")), p.getName().removeprefix("ingest_date=")) in gone:
                fs.delete(p, True)


def write_index(index: DataFrame, path: str) -> None:
    """The next version; all but it and the one before are removed."""
    spark = index.sparkSession
    known = _versions(spark, path)
    k = known[-1] + 1 if known else 0
    index.write.mode("overwrite").parquet(f"{path}/version={k}")
    for old in known[:-1]:
        fs, p = _fs(spark, f"{path}/version={old}")
        fs.delete(p, True)


def read_index(spark: SparkSession, path: str) -> DataFrame | None:
    known = _versions(spark, path)
    return spark.read.schema("region string, video_id string, days array<date>").parquet(f"{path}/version={known[-1]}") if known else None


def renew_features(trending: DataFrame, sentiment: DataFrame | None, features_path: str, index_path: str,
                   days: Sequence[str], regions: Sequence[str] | None = None) -> None:
    """Bring the feature table up to date for snapshots of ``days`` that landed, landed again or
    late. Rows of other series in the rewritten partitions are carried over.

    Without an index (a first run, or a table from before it) one is made from the days that
    ``trending`` holds beside these.
    """
    spark = trending.sparkSession
    snaps = with_ingest_date(trending)
    if regions is not None:
        snaps = snaps.where(F.col("region").isin(*regions))
    of_run = F.col("ingest_date").isin(*[F.lit(d).cast("date") for d in days])
    index = read_index(spark, index_path)
    if index is None:
        index = series_index(with_ingest_date(trending).where(~of_run))
    merged_path = scratch_path(spark, "series-index")
    merge_index(index, snaps.where(of_run).select(*SNAPSHOT), days, regions).write.parquet(merged_path)
    merged = spark.read.parquet(merged_path)
    series = neighbours(merged)
    feats = renewed_rows(snaps, series, sentiment)
    if table_exists(spark, features_path):
        touched = F.array_union("changed", "renew")
        old = read_table(spark, features_path).where(_partitions(series, touched))
        carried = _on_days(old, series, touched, "left_anti")
        feats = feats.unionByName(carried.select(*feats.columns))
    # the table that is rewritten is also read: first whole to the scratch folder
    staged_path = scratch_path(spark, "renewed-features")
    feats.write.parquet(staged_path)
    staged = spark.read.schema(feats.schema).parquet(staged_path)
    write_partitioned(staged, features_path, ["region", "ingest_date"])
    partition = ["region", "ingest_date"]
    emptied = series.select("region", F.explode("changed").alias("ingest_date")).distinct().join(staged.select(*partition).distinct(), partition, "left_anti")
    _drop_partitions(spark, features_path, {(r[0], str(r[1])) for r in emptied.collect()})  # days withdrawn from whole regions
    write_index(merged.where(F.size("days") > 0).select(*SERIES_KEYS, "days"), index_path)
