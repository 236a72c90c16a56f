"""E08 (M04, M05): settings compared over time-ordered folds, fitted on one table of vectors."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml import Pipeline
from pyspark.ml.base import Estimator
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.ml.functions import vector_to_array

from trendlake.operators import evaluation, ml
from trendlake.session import keep, shared_dir


def fold_edges(frame: DataFrame, folds: int, first_share: float = 0.5) -> list:
    """The first test day of each fold, and None at the end: the days after the first ``first_share`` of
    all days, in ``folds`` even parts. A row per day comes to the driver."""
    days = [r[0] for r in frame.select("ingest_date").where(F.col("ingest_date").isNotNull()).distinct().orderBy("ingest_date").collect()]
    start = int(len(days) * first_share)
    if folds < 1 or start < 1 or len(days) - start < folds:
        raise ValueError(f"{len(days)} days do not make {folds} folds after the first {first_share:.0%}")
    return [days[start + k * (len(days) - start) // folds] for k in range(folds)] + [None]


def fold_sides(edges: Sequence, k: int) -> tuple[Column, Column]:
    """Fold ``k`` learns from all days before its own, and is tested on its own: never on the past."""
    day = F.col("ingest_date")
    test = day >= F.lit(edges[k])
    return day < F.lit(edges[k]), test if edges[k + 1] is None else test & (day < F.lit(edges[k + 1]))


def sweep(labeled: DataFrame, task: str, estimators: Mapping[str, Estimator], folds: int = 3,
          features: Sequence[str] = ml.NUMERIC_FEATURES) -> tuple[DataFrame, str]:
    """``(rows, best)``: ``setting, fold, n_train, n_test, value`` for every named estimator and fold, and the
    name with the best mean (least RMSE or greatest AUC; the first of equals).

    The preparation is learned from the first fold's training days only; the task's columns and then
    all vectors are made once and written, and every fit reads them.
    """
    shared_dir(labeled.sparkSession)
    frame, label = ml.task_frame(labeled, task, features)
    frame = keep(frame.select(*dict.fromkeys(c for c in (*ml.ROW_KEYS, label, *features) if c in frame.columns)), "sweep-rows")
    edges = fold_edges(frame, folds)
    early, _ = fold_sides(edges, 0)
    used = ml.usable_features(frame.where(early), features)
    prep = Pipeline(stages=ml._prep_stages(used)).fit(frame.where(early))
    vectors = keep(prep.transform(frame).select("ingest_date", F.col(label).alias("label"), "features"), "sweep-vectors")
    n_train = [vectors.where(fold_sides(edges, k)[0]).count() for k in range(folds)]
    rows = []
    for name, estimator in estimators.items():
        for k in range(folds):
            train, test = (vectors.where(side) for side in fold_sides(edges, k))
            model = estimator.copy({estimator.labelCol: "label", estimator.featuresCol: "features"}).fit(train)
            out = model.transform(test)
            if task == "regression":
                m = evaluation.regression_error(out, "prediction", "label").first()
                value, n_test = m["rmse"], m["n"]
            else:
                m = evaluation.ranking_metrics(out.withColumn("_p", vector_to_array("probability")[1]), "_p", "label").first()
                value, n_test = m["auc"], (m["n_positive"] or 0) + (m["n_negative"] or 0)
            rows.append((name, k, n_train[k], n_test, value))
    mean = {n: [r[4] for r in rows if r[0] == n and r[4] is not None] for n in estimators}
    sign = 1 if task == "regression" else -1
    scored = {n: sign * sum(v) / len(v) for n, v in mean.items() if v}
    if not scored:
        raise ValueError("no fold has test rows of both kinds")
    return labeled.sparkSession.createDataFrame(rows, "setting string, fold int, n_train long, n_test long, value double"), min(scored, key=scored.get)
