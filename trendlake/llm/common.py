"""Helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trendlake.session import apply_defaults, scratch_path

#: Text handled at once inside a task; a longer single text forms its own piece.
CHUNK_BYTES = 2 << 20


def prepare(spark: SparkSession) -> None:
    """Session settings for tables of whole texts."""
    apply_defaults(spark)
    # texts cross to Python in small batches; the default of 10,000 rows is meant for narrow rows
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cut(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back.

    This ends the lineage at replicated storage, so a lost executor never
    forces iterative work to start over.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def held_out(doc_id: Column | str) -> Column:
    """True for the evaluation fold: crc32 of the id's text mod 4 is 2 (null id: false)."""
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(c.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def row_key(*cols: str) -> Column:
    """A 64-bit key of a row's id and content; repeated equal rows share it."""
    return F.xxhash64(*[F.col(c) for c in cols])


def pieces(lengths, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Consecutive index ranges whose lengths sum to about ``limit``."""
    start = total = 0
    for i, n in enumerate(lengths):
        if i > start and total + n > limit:
            yield start, i
            start, total = i, 0
        total += int(n)
    if start < len(lengths):
        yield start, len(lengths)


def labelled_sample(docs: DataFrame, labels: DataFrame, label_col: str, limit: int, *, id_col: str, text_col: str) -> DataFrame:
    """``id, text, label`` of at most ``limit`` labelled documents outside the held-out fold.

    The choice is by a hash of the id, so it is the same in every run; the list of
    chosen ids has a fixed bound and may be broadcast.
    """
    chosen = labels.where(F.col(label_col).isNotNull() & F.col("doc_id").isNotNull()) \
        .groupBy(F.col("doc_id").alias("_id")).agg(F.max(label_col).cast("int").alias("label")) \
        .where(~held_out("_id")).orderBy(F.xxhash64("_id"), "_id").limit(limit)
    return docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")) \
        .join(F.broadcast(chosen), "_id")
