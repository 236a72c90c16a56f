"""The corpus pipeline: toxicity, line dedup, near duplicates, decontamination, mixing.

Each stage is a function of (spark, docs, sf_dir); its result is written as Parquet
and read again as the next one's documents. All but the last return the columns of
``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trendlake.llm import curriculum, decontam, jaccard_join, line_align, toxicity
from trendlake.llm.common import cut, prepare, table

TOXIC_FROM = 0.3


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose restored text scores below the threshold; null and empty texts stay."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    scored = toxicity.score(docs, model, score_col="__toxicity__")
    return scored.where(F.col("__toxicity__") < TOXIC_FROM).drop("__toxicity__")


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that earlier ones hold; a document of which nothing is
    left was a copy and goes. ``n_chars`` follows the text."""
    prepare(spark)
    done = line_align.dedup_lines(docs)
    lost = F.col("removed_words") > 0
    return done.where(~lost | (F.col("left_words") > 0)) \
        .withColumn("n_chars", F.when(lost, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars"))) \
        .select(*docs.columns)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that shares 5-word shingles at a similarity of 0.75."""
    prepare(spark)
    return jaccard_join.one_of_each(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of a benchmark item."""
    return decontam.without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The training stream: a row per use of a document, sorted by training position, with the
    columns of documents and the mix's ``size, source_size, target, taken, epoch, position``."""
    prepare(spark)
    stream = curriculum.training_stream(curriculum.plan_mix(docs, carry=tuple(docs.columns)))
    return stream.select(*[F.col(f"doc_{c}").alias(c) for c in docs.columns], "size", "source_size", "target", "taken", "epoch", "position")


STAGES = [
    ("toxicity", toxicity_stage),
    ("line_dedup", line_dedup_stage),
    ("near_duplicates", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("mixing", mixing_stage),
]

#: Learned scores and alignments cannot be expressed in SQL; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = cut(stage(spark, docs, sf_dir), f"pipeline-{k}-{name}")
    return docs
