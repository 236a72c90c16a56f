"""E01 (S02): comments from a landing that is replayed, each written once.

The landing repeats comments: a video that trends for days has its comments fetched
every day, and a day may land late or again.  The stream remembers a comment's key for
as long as the watermark trails its time by ``delay``, so the state is bounded; the state
is kept in the checkpoint, so a stopped run goes on as if it had not stopped.  A long
``delay`` remembers every comment, so the keys are on the executors' disks while a run
lasts (``STATE_CONF``) and not in their heaps.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from trendlake.functions.dates import parse_timestamp
from trendlake.operators.curate import curate_comments
from trendlake.session import session_conf
from trendlake.streaming.ingest import comment_stream, run_until_drained

COMMENT_KEY = ("region", "video_id", "author_display_name", "published_at", "comment_text")

# For this stream's state only: sorted files on the executor's disk instead of maps in its heap; all
# stores of an executor share the memory below. The progress's ``numRowsTotal`` is not kept (0): it costs a
# look-up for each write. A checkpoint goes on with the kind of store it began with.
_STORE = "spark.sql.streaming.stateStore"
STATE_CONF = {
    f"{_STORE}.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    f"{_STORE}.rocksdb.boundedMemoryUsage": "true",
    f"{_STORE}.rocksdb.maxMemoryUsageMB": "256",
    f"{_STORE}.rocksdb.trackTotalNumberOfRows": "false",
}
# Each store takes about a MB of its executor outside that bound and writes files of its own in each batch;
# as it lies on disk it may be large, so a stream begins with this many for each core and with LEAST_STORES.
STORES_PER_CORE, LEAST_STORES = 4, 32


def state_conf(spark: SparkSession) -> dict[str, str]:
    """``STATE_CONF``, and not more stores than the cluster's cores keep busy."""
    most, parts = max(LEAST_STORES, STORES_PER_CORE * spark.sparkContext.defaultParallelism), "spark.sql.shuffle.partitions"
    return STATE_CONF | {parts: str(min(int(spark.conf.get(parts)), most))}


def keyed_comments(curated: DataFrame) -> DataFrame:
    """The columns that make a comment, and its time: when it was published, or the day it
    landed if that cannot be read. Comments without text are no comments."""
    time = F.coalesce(parse_timestamp("published_at"), F.col("ingest_date").cast("timestamp"))
    return curated.where(F.col("comment_text").isNotNull()).select(*COMMENT_KEY, time.alias("event_time"))


def unique_comments(curated: DataFrame) -> DataFrame:
    """The batch twin: one row per comment."""
    return keyed_comments(curated).dropDuplicates(list(COMMENT_KEY))


def dedup_comments_stream(spark: SparkSession, landing: str, sink: str, checkpoint: str, delay: str,
                          max_files_per_trigger: int = 1000) -> StreamingQuery:
    """Start a run over what has landed since the last one (raw JSON -> Parquet by region). ``delay``
    bounds how late a comment may land after the newest comment before it."""
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "100000")  # late rows are counted over the whole run
    rows = keyed_comments(curate_comments(comment_stream(spark, landing, max_files_per_trigger)))
    once = rows.withWatermark("event_time", delay).dropDuplicatesWithinWatermark(list(COMMENT_KEY))
    with session_conf(spark, state_conf(spark)):  # a query takes the settings with it when it starts
        return (
            once.writeStream.format("parquet").option("checkpointLocation", checkpoint).partitionBy("region")
            .outputMode("append").trigger(availableNow=True).start(sink)
        )


def rows_too_late(query: StreamingQuery) -> int:
    """Rows of the run that came after the watermark and were left out."""
    return sum(int(op["numRowsDroppedByWatermark"]) for p in query.recentProgress for op in p["stateOperators"])


def drain(query: StreamingQuery, timeout_s: float | None = None, allow_late: bool = False) -> int:
    """Wait for the run's end; rows that were too late raise unless they are allowed, and are counted."""
    run_until_drained(query, timeout_s)
    late = rows_too_late(query)
    if late and not allow_late:
        raise RuntimeError(f"{late} rows landed later than the watermark allows; choose a longer delay and a new checkpoint")
    return late
