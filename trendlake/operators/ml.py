"""Training, evaluation and batch scoring (Spark ML).

- Training frames are cleaned in one projection (cast, +/-Inf -> null) and
  filtered on label availability.
- Splits are columns computed lazily: the time split compares to a scalar
  subquery of the max date; the hash split hashes the row key, so it is stable
  under repartitioning and task retries (``randomSplit`` is not).  The caller
  names the split; a split with an empty side is an error, never a silent switch.
- Regression and classification get separate training frames (Q7): the
  regression label exists only where a next snapshot exists, which would make
  the stay-trending label constant.
- Boosting checkpoints its intermediate RDDs every ``checkpoint_interval``
  iterations into the shared ``spark.checkpoint.dir`` so a lost executor does
  not replay the whole boosting lineage.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.evaluation import BinaryClassificationEvaluator, RegressionEvaluator
from pyspark.ml.feature import Imputer, StringIndexer, VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from trendlake.functions.dates import days_before
from trendlake.functions.numeric import inf_to_null, prob_of_class
from trendlake.operators.features import keep_matured
from trendlake.schemas import PREDICTION_COLUMNS
from trendlake.session import shared_dir

# The model's feature list (M09).  Velocities and growth ratios
# are excluded, as in the original training job.
NUMERIC_FEATURES = (
    "log_view_count", "log_like_count", "log_comment_count",
    "like_view_ratio", "comment_view_ratio", "engagement_per_view", "video_age_days",
    "avg_comment_sent_pos", "avg_comment_sent_neg", "avg_comment_sent_neu", "avg_comment_sent_mix",
    "net_comment_sentiment", "comment_count_scored",
)
REG_LABEL = "log_view_growth_next"
CLS_LABEL = "stay_trending_next"
CATEGORY = "region"
ROW_KEYS = ("region", "video_id", "ingest_date")
CATEGORY_INDEX = "region_idx"


# ---- cleaning and splits ---------------------------------------------------------

def clean_training(df: DataFrame, features: Sequence[str], label: str) -> DataFrame:
    """M10 (P17 + P20 + F09): features and label as double with infinities nulled;
    rows without a label dropped, and rows without sentiment where it was not filled in."""
    wanted = [c for c in (*features, label) if c in df.columns]
    cleaned = df.withColumns({c: inf_to_null(F.col(c).cast("double")) for c in wanted})
    if "avg_comment_sent_pos" in cleaned.columns and "has_sentiment" not in cleaned.columns:
        cleaned = cleaned.filter(F.col("avg_comment_sent_pos").isNotNull())
    return cleaned.filter(F.col(label).isNotNull())


def usable_features(df: DataFrame, features: Sequence[str]) -> list[str]:
    """Q13: features with at least one non-null value (a median of nothing cannot be
    imputed).  One aggregate job; one row returns to the driver."""
    present = [c for c in features if c in df.columns]
    row = df.agg(F.count(F.lit(1)).alias("_rows"), *[F.count(F.col(c)).alias(c) for c in present]).first()
    if not row["_rows"]:
        raise ValueError("no labelled rows to train on")
    used = [c for c in present if row[c] > 0]
    if not used:
        raise ValueError(f"no feature has a value in any of {row['_rows']} rows: {', '.join(features)}")
    return used


def time_split_column(df: DataFrame, days_back: int = 3, dates: DataFrame | None = None) -> Column:
    """``'test'`` for rows on or after ``max(ingest_date) - days_back`` (so
    ``days_back + 1`` dates), ``'train'`` before.

    The maximum is a scalar subquery over ``dates``: pass the labelled snapshots without
    the sentiment join, so that the subquery does not score the texts again.
    """
    last = (df if dates is None else dates).select(F.max("ingest_date")).scalar()
    return F.when(F.col("ingest_date") >= days_before(last, days_back), F.lit("test")).otherwise(F.lit("train"))


def hash_split_column(keys: Sequence[str], train_frac: float = 0.8, seed: int = 42) -> Column:
    """Deterministic ``train``/``test`` assignment from the first digits of an md5 of
    the row key, which any engine computes alike."""
    text = F.concat_ws("|", F.lit(str(seed)), *[F.col(k).cast("string") for k in keys])
    bucket = F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint") % 10_000
    return F.when(bucket < int(train_frac * 10_000), F.lit("train")).otherwise(F.lit("test"))


def split_column(df: DataFrame, mode: str = "time", dates: DataFrame | None = None) -> Column:
    """The caller's choice of split: ``"time"`` (R02) or ``"hash"`` of the row key."""
    if mode == "time":
        return time_split_column(df, dates=dates)
    if mode == "hash":
        return hash_split_column(ROW_KEYS)
    raise ValueError(f"unknown split mode {mode!r}")


def split(df: DataFrame, split_col: Column) -> tuple[DataFrame, DataFrame]:
    tagged = df.withColumn("_split", split_col)
    return (tagged.filter(F.col("_split") == "train").drop("_split"),
            tagged.filter(F.col("_split") == "test").drop("_split"))


# ---- pipelines -------------------------------------------------------------------

def _prep_stages(features: Sequence[str]):
    return [
        StringIndexer(inputCol=CATEGORY, outputCol=CATEGORY_INDEX, handleInvalid="keep"),  # M01
        Imputer(inputCols=list(features), outputCols=list(features), strategy="median"),  # M02
        VectorAssembler(inputCols=[*features, CATEGORY_INDEX], outputCol="features", handleInvalid="keep"),  # M03
    ]


def regression_pipeline(features: Sequence[str], label: str = REG_LABEL, max_iter: int = 50, max_depth: int = 5,
                        seed: int = 42, checkpoint_interval: int = 10) -> Pipeline:
    """M04 + M06: boosted trees on the growth label."""
    gbt = GBTRegressor(labelCol=label, featuresCol="features", maxIter=max_iter, maxDepth=max_depth, seed=seed,
                       checkpointInterval=checkpoint_interval)
    return Pipeline(stages=[*_prep_stages(features), gbt])


def classification_pipeline(features: Sequence[str], label: str = CLS_LABEL, max_iter: int = 50) -> Pipeline:
    """M05 + M06: logistic regression on the stay-trending label."""
    lr = LogisticRegression(labelCol=label, featuresCol="features", maxIter=max_iter)
    return Pipeline(stages=[*_prep_stages(features), lr])


def fit_regression(pipeline: Pipeline, rows: DataFrame) -> PipelineModel:
    """The pipeline's model, as its ``fit`` gives it. The trees look at their rows four times before
    they keep them; the vectors are made once for that, on the executors' disks, which leaves
    the memory to the trees."""
    *prep, trees = pipeline.getStages()
    prepared = Pipeline(stages=prep).fit(rows)
    vectors = prepared.transform(rows).select(trees.getFeaturesCol(), trees.getLabelCol()).persist(StorageLevel.DISK_ONLY)
    try:
        return PipelineModel([*prepared.stages, trees.fit(vectors)])
    finally:
        vectors.unpersist()


def rmse(model: PipelineModel, test: DataFrame, label: str = REG_LABEL) -> float:
    """M07."""
    return RegressionEvaluator(labelCol=label, predictionCol="prediction", metricName="rmse").evaluate(
        model.transform(test)
    )


def auc(model: PipelineModel, test: DataFrame, label: str = CLS_LABEL) -> float:
    """M08; over all distinct scores (``numBins`` 0), not over a thousand bins of them."""
    ev = BinaryClassificationEvaluator(labelCol=label, rawPredictionCol="rawPrediction", metricName="areaUnderROC", numBins=0)
    return ev.evaluate(model.transform(test))


def require_two_classes(df: DataFrame, label: str = CLS_LABEL) -> None:
    """Q11: a one-class frame yields length-1 probability vectors; refuse it early."""
    n = df.agg(F.count_distinct(label).alias("n")).first()["n"]
    if n < 2:
        raise ValueError(f"{label} has {n} distinct value(s); need both classes to train")


def regression_frame(labeled: DataFrame, features: Sequence[str] = NUMERIC_FEATURES) -> DataFrame:
    return clean_training(labeled, features, REG_LABEL)


def classification_frame(labeled: DataFrame, features: Sequence[str] = NUMERIC_FEATURES) -> DataFrame:
    """Rows older than their region's latest date: both label values are real (Q7)."""
    return clean_training(keep_matured(labeled), features, CLS_LABEL)


def train_regressor(labeled: DataFrame, features: Sequence[str] = NUMERIC_FEATURES, **kw) -> PipelineModel:
    shared_dir(labeled.sparkSession)
    frame = regression_frame(labeled, features)
    used = usable_features(frame, features)
    return fit_regression(regression_pipeline(used, **kw), frame)


def train_classifier(labeled: DataFrame, features: Sequence[str] = NUMERIC_FEATURES, **kw) -> PipelineModel:
    frame = classification_frame(labeled, features)
    require_two_classes(frame)
    used = usable_features(frame, features)
    return classification_pipeline(used, **kw).fit(frame)


def task_frame(labeled: DataFrame, task: str, features: Sequence[str] = NUMERIC_FEATURES) -> tuple[DataFrame, str]:
    """A task's rows and its label."""
    if task == "regression":
        return regression_frame(labeled, features), REG_LABEL
    if task == "classification":
        return classification_frame(labeled, features), CLS_LABEL
    raise ValueError(task)


def scored_test_rows(labeled: DataFrame, task: str, model: PipelineModel, mode: str = "time") -> DataFrame:
    """``label, score`` of the rows that ``train_and_evaluate`` tests on: the prediction, or the
    probability of the label 1."""
    frame, label = task_frame(labeled, task)
    _, test = split(frame, split_column(frame, mode))
    out = model.transform(_drop_generated(test))
    score = F.col("prediction") if task == "regression" else prob_of_class("probability", 1)
    return out.select(F.col(label).alias("label"), score.alias("score"))


def train_and_evaluate(labeled: DataFrame, task: str, features: Sequence[str] = NUMERIC_FEATURES,
                       mode: str = "time", **kw) -> tuple[PipelineModel, dict]:
    """Job 5: fit on the split's train side, evaluate on its test side.

    The task's columns and the split are computed once and kept on the executors' disks until
    the end: the counts, each stage of the fit and the evaluation read them there.
    """
    spark = labeled.sparkSession
    shared_dir(spark)
    frame, label = task_frame(labeled, task, features)
    wanted = dict.fromkeys(c for c in (CATEGORY, label, *features) if c in frame.columns)
    tagged = frame.withColumn("_split", split_column(frame, mode)).select(*wanted, "_split").persist(StorageLevel.DISK_ONLY)
    try:
        sides = {r["_split"]: r["count"] for r in tagged.groupBy("_split").count().collect()}
        n_train, n_test = sides.get("train", 0), sides.get("test", 0)
        if not n_train or not n_test:
            raise ValueError(f"the {mode} split of {task} leaves {n_train} rows to train on and {n_test} to test; "
                             "land more days or choose mode='hash'")
        train, test = split(tagged, F.col("_split"))
        used = usable_features(train, features)
        if task == "regression":
            model = fit_regression(regression_pipeline(used, **kw), train)
            metric_name, value = "rmse", rmse(model, test)
        else:
            require_two_classes(train)
            model = classification_pipeline(used, **kw).fit(train)
            metric_name, value = "areaUnderROC", auc(model, test)
    finally:
        tagged.unpersist()
    return model, {
        "task": task, "label": label, "metric": metric_name, "value": float(value), "split": mode,
        "n_train": n_train, "n_test": n_test, "features": ",".join(used),
    }


# ---- scoring ---------------------------------------------------------------------

def _drop_generated(df: DataFrame) -> DataFrame:
    """Columns a pipeline creates itself."""
    return df.drop(CATEGORY_INDEX, "features", "rawPrediction", "probability")


def score(rows: DataFrame, reg_model: PipelineModel, cls_model: PipelineModel) -> DataFrame:
    """M11-M14 (N03, V01, P10, P14): growth, next views and stay probability."""
    reg = reg_model.transform(_drop_generated(rows)).withColumnRenamed("prediction", "pred_log_view_growth_next")
    reg = reg.withColumn("pred_log_view_count_next", F.col("log_view_count") + F.col("pred_log_view_growth_next"))
    reg = reg.withColumn("pred_view_count_next", F.expm1("pred_log_view_count_next"))
    cls = cls_model.transform(_drop_generated(reg)).withColumnRenamed("prediction", "pred_stay_trending_next")
    cls = cls.withColumn("prob_stay_trending_next", prob_of_class("probability", 1))
    return cls.select(*[c for c in PREDICTION_COLUMNS if c in cls.columns])
