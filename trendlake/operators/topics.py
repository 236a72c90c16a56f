"""Topics of comments, from a vocabulary with document-frequency bounds and online LDA."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.clustering import LDA, LDAModel
from pyspark.ml.feature import CountVectorizerModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trendlake.session import shared_dir

# Fixed value: a term of a comment, once A-Z are lower-cased.
TERM = "[a-z]{3,}"


@dataclass(frozen=True)
class Settings:
    min_docs: int = 5         # documents that hold a term, at least
    max_share: float = 0.5    # of all documents, at most
    terms: int = 200          # of the vocabulary, at most: the most frequent ones
    topics: int = 5
    steps: int = 10
    seed: int = 42


def terms_of(text: Column) -> Column:
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.regexp_extract_all(F.translate(F.coalesce(text, F.lit("")), upper, upper.lower()), F.lit(TERM), F.lit(0))


def vocabulary(df: DataFrame, text_col: str = "comment_text", settings: Settings = Settings()) -> DataFrame:
    """``term, n, docs``: occurrences and documents of the vocabulary's terms. A document's terms are
    sorted inside its row, so that the first of equal ones is known by the term before it, and every
    occurrence is looked at once; a task sums a term's counts before the shuffle."""
    total = df.count()
    rows = df.select(F.sort_array(terms_of(F.col(text_col))).alias("t"))
    before = F.concat(F.array(F.lit("")), F.slice("t", 1, F.greatest(F.size("t") - 1, F.lit(0))))  # no term is empty
    each = rows.where(F.size("t") > 0).select(F.inline(F.arrays_zip(F.col("t").alias("term"), before.alias("before"))))
    counted = each.groupBy("term").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("term") != F.col("before")).alias("docs"))
    fit = counted.where((F.col("docs") >= settings.min_docs) & (F.col("docs") <= total * settings.max_share))
    return fit.orderBy(F.desc("n"), "term").limit(settings.terms)


def fit_topics(df: DataFrame, text_col: str = "comment_text", settings: Settings = Settings()) -> tuple[LDAModel, CountVectorizerModel, DataFrame]:
    """The topic model, the vectoriser, and ``df`` with ``topic_mass`` (a comment's share of each topic).
    The vocabulary (at most ``settings.terms`` words) comes to the driver; the optimiser sees a
    sample of the vectors per step and keeps its state in the checkpoint folder."""
    spark = df.sparkSession
    shared_dir(spark)
    words = [r["term"] for r in vocabulary(df, text_col, settings).collect()]
    if not words:
        raise ValueError("no term keeps the bounds of the vocabulary")
    vectors = CountVectorizerModel.from_vocabulary(words, inputCol="_terms", outputCol="_counts")
    counted = vectors.transform(df.withColumn("_terms", terms_of(F.col(text_col)))).drop("_terms").checkpoint(eager=True)
    lda = LDA(k=settings.topics, maxIter=settings.steps, seed=settings.seed, optimizer="online", featuresCol="_counts",
              topicDistributionCol="topic_mass", checkpointInterval=5)
    model = lda.fit(counted.select("_counts"))
    return model, vectors, model.transform(counted).drop("_counts")


def topic_terms(model: LDAModel, vectors: CountVectorizerModel, best: int = 10) -> DataFrame:
    """``topic, rank, term, weight``: a topic's heaviest terms; all weights of a topic sum to 1."""
    spark = model.describeTopics(1).sparkSession
    words = spark.createDataFrame(list(enumerate(vectors.vocabulary)), "i int, term string")
    rows = model.describeTopics(best).select("topic", F.posexplode(F.arrays_zip("termIndices", "termWeights")).alias("rank", "z"))
    return rows.select("topic", (F.col("rank") + 1).alias("rank"), F.col("z.termIndices").alias("i"), F.col("z.termWeights").alias("weight")).join(
        words, "i").select("topic", "rank", "term", "weight")
