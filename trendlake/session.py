"""Session construction and the shared scratch folder.

Cluster jobs must not write to a machine-local temporary folder: any
intermediate output (lineage cuts, sink round trips, saved models in tests)
goes under the shared folder named by ``spark.checkpoint.dir``.  We read that
setting from the session and only invent one when it is unset (local tests).
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings every trendlake job relies on.  AQE re-plans joins/partition counts
# from runtime statistics and splits skewed join partitions; UTC keeps
# hour()/to_date() independent of the machine's zone.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}

# For the feature job only: the snapshot window is partitioned by (region,
# video_id) and the sentiment join adds ingest_date; co-partitioning on a subset
# of the join keys lets the join reuse the window's exchange instead of
# re-shuffling the big side.  Groups are bounded: dedup guarantees at most one
# snapshot per (region, video_id, day).  Other joins may have coarse, skewed keys,
# so it is never set for a whole session.
FEATURE_CONF = {"spark.sql.requireAllClusterKeysForCoPartition": "false"}


def build_session(
    master: str | None = None,
    app_name: str = "trendlake",
    shuffle_partitions: int | None = None,
    extra_conf: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or reuse) a session with trendlake's defaults.

    On a cluster pass ``master=None`` and let spark-submit decide; size
    ``shuffle_partitions`` so one shuffle partition stays ~128-256 MB.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    conf["spark.ui.enabled"] = "false"
    conf["spark.ui.showConsoleProgress"] = "false"
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def apply_defaults(spark: SparkSession) -> None:
    """Set trendlake's defaults on an existing session where they are unset."""
    for k, v in DEFAULT_CONF.items():
        if spark.conf.get(k, None) in (None, ""):
            spark.conf.set(k, v)


@contextmanager
def session_conf(spark: SparkSession, conf: dict[str, str]) -> Iterator[None]:
    """Settings for the plans made inside the block; the session gets its own back."""
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def shared_dir(spark: SparkSession) -> str:
    """The cluster-shared scratch root (``spark.checkpoint.dir``).

    ``spark.checkpoint.dir`` is a core setting, fixed when the session starts;
    when it is unset in local mode (tests), create a folder and register it as the
    SparkContext checkpoint directory, so ``DataFrame.checkpoint()`` and ML
    ``checkpointInterval`` work and later calls find it again.  On a cluster an
    unset folder is an error: a folder of the driver's machine would be lost.
    """
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not root:
        if not re.match(r"local(\[|$)", sc.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        root = tempfile.mkdtemp(prefix="trendlake-ckpt-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(root)
    return root


def _own_dir(spark: SparkSession) -> str:
    """This application's part of the shared folder; others that run beside it have theirs."""
    return os.path.join(shared_dir(spark), "trendlake", spark.sparkContext.applicationId)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique sub-path of the shared folder for one run of one step."""
    return os.path.join(_own_dir(spark), f"{name}-{uuid.uuid4().hex[:12]}")


def keep(df: DataFrame, name: str) -> DataFrame:
    """``df``, computed once and written to the shared folder as Parquet: what reads it reads the
    columns that it needs only, whereas a checkpoint is read in whole rows."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release_scratch(spark: SparkSession) -> None:
    """Delete what this application's steps have written under the shared folder, once their
    results have been consumed."""
    path = spark._jvm.org.apache.hadoop.fs.Path(_own_dir(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
