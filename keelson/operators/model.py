"""Training, scoring, evaluation and model selection with MLlib.

L1: binary logistic regression with an L2 penalty of strength C = 1 on the
sum of log-losses, i.e. MLlib's ``regParam = 1 / (C * n)`` on the mean loss,
no internal standardisation, unpenalised intercept.
L2: scoring adds the probability of the positive class as a double column.
L3: area under the ROC curve over all distinct scores (no binning).
L4/L5: cross-validated selection over a user grid with folds taken from the
row hash (``assign_folds``), so the folds are the same at any partition
count; metrics come back as a frame, the best model as a fitted pipeline.
L6: pipelines are saved and loaded with MLlib's own writer.

All fitting is distributed by MLlib (tree-aggregated gradients); the driver
holds coefficients and one metric per candidate.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from multiprocessing.pool import ThreadPool

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import ParamGridBuilder
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from keelson.operators.split import assign_folds

FEATURES = "features"
LABEL = "__label"
SCORE = "score"


# Relative change of the loss at which the optimiser stops.
TOLERANCE = 1e-6


def _estimator(features: Sequence[str], reg_param: float, max_iter: int = 100, tol: float = TOLERANCE) -> Pipeline:
    assembler = VectorAssembler(inputCols=list(features), outputCol=FEATURES, handleInvalid="error")
    lr = LogisticRegression(featuresCol=FEATURES, labelCol=LABEL, regParam=reg_param, elasticNetParam=0.0,
                            standardization=False, fitIntercept=True, maxIter=max_iter, tol=tol)
    return Pipeline(stages=[assembler, lr])


def _with_label(df: DataFrame, label: str) -> DataFrame:
    return df.withColumn(LABEL, F.col(label).cast("double"))


def fit_logreg(df: DataFrame, features: Sequence[str], label: str, C: float = 1.0,
               max_iter: int = 100, checked: tuple[int, int] | None = None,
               tol: float = TOLERANCE) -> PipelineModel:
    """L1: fit on every row of ``df``; missing values are an error (impute first).

    ``checked`` = (rows, label classes) when a previous pass already counted
    them; otherwise one aggregate counts them here.
    """
    if checked is None:
        row = df.agg(F.count(F.lit(1)).alias("n"), F.count_distinct(F.col(label)).alias("k")).first()
        checked = (row["n"], row["k"])
    n, classes = checked
    if n == 0:
        raise ValueError("no training rows")
    if classes < 2:
        raise ValueError(f"label {label} has fewer than two classes")
    if classes > 2:
        raise ValueError(f"label {label} has {classes} classes; the regression is binary")
    return _estimator(features, 1.0 / (C * n), max_iter, tol).fit(_with_label(df, label))


def coefficients(model: PipelineModel, features: Sequence[str]) -> list[tuple[str, float]]:
    lr = model.stages[-1]
    return list(zip(features, lr.coefficients.toArray().tolist())) + [("(intercept)", float(lr.intercept))]


def coefficient_frame(spark: SparkSession, model: PipelineModel, features: Sequence[str]) -> DataFrame:
    """Coefficients and intercept as a frame (one row per feature; driver-held numbers)."""
    schema = StructType([StructField("feature", StringType()), StructField("coefficient", DoubleType())])
    return spark.createDataFrame(coefficients(model, features), schema)


def score(model: PipelineModel, df: DataFrame, keep: Sequence[str] | None = None,
          score_col: str = SCORE) -> DataFrame:
    """L2: probability of the positive class for every row."""
    out = model.transform(df).withColumn(score_col, vector_to_array(F.col("probability"))[1])
    cols = list(keep) if keep is not None else list(df.columns)
    return out.select(*cols, score_col)


def area_under_roc(scored: DataFrame, label: str, score_col: str = SCORE) -> float:
    """L3: exact AUC (ties count one half), evaluated distributed by MLlib."""
    ev = BinaryClassificationEvaluator(rawPredictionCol=score_col, labelCol=LABEL,
                                       metricName="areaUnderROC", numBins=0)
    return ev.evaluate(_with_label(scored.select(label, F.col(score_col).cast("double").alias(score_col)), label))


def cross_validate(df: DataFrame, features: Sequence[str], label: str, key: str | Sequence[str],
                   grid: Sequence[Mapping[str, float]], folds: int = 5, seed: int = 42,
                   parallelism: int = 2, tol: float = TOLERANCE) -> tuple[PipelineModel, DataFrame]:
    """Pick the grid point with the best mean AUC over hashed folds.

    ``grid`` entries set ``regParam`` and/or ``maxIter`` of the regression.
    Returns the best model refitted on all rows and a metrics frame
    (candidate, reg_param, max_iter, mean_auc, best).
    """
    if not grid:
        raise ValueError("empty grid")
    data = assign_folds(_with_label(df, label), key, folds, seed, "__fold").select(*features, LABEL, "__fold")
    pipe = _estimator(features, 0.0, tol=tol)
    lr = pipe.getStages()[-1]
    builder = ParamGridBuilder()
    maps = []
    for point in grid:
        pm = builder.build()[0].copy()
        pm[lr.regParam] = float(point.get("regParam", 0.0))
        pm[lr.maxIter] = int(point.get("maxIter", 100))
        maps.append(pm)
    ev = BinaryClassificationEvaluator(rawPredictionCol="rawPrediction", labelCol=LABEL,
                                       metricName="areaUnderROC", numBins=0)
    # The folds are read and hashed once; every fit and every evaluation filters the kept columns.
    data = data.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        held = {r["__fold"]: r["n"] for r in data.groupBy("__fold").agg(F.count(F.lit(1)).alias("n")).collect()}
        for i in range(folds):
            for side, n in (("training", sum(held.values()) - held.get(i, 0)), ("validation", held.get(i, 0))):
                if not n:
                    raise ValueError(f"The {side} data at fold {i} is empty.")

        def fold_metric(job: tuple[int, int]) -> float:
            fold, i = job
            fitted = pipe.fit(data.where(F.col("__fold") != F.lit(fold)), maps[i])
            return ev.evaluate(fitted.transform(data.where(F.col("__fold") == F.lit(fold))))

        with ThreadPool(parallelism) as pool:
            jobs = [(fold, i) for fold in range(folds) for i in range(len(maps))]
            found = dict(zip(jobs, pool.map(inheritable_thread_target(df.sparkSession)(fold_metric), jobs, chunksize=1)))
        means = [sum(found[fold, i] for fold in range(folds)) / folds for i in range(len(maps))]
        best = max(range(len(maps)), key=lambda i: means[i])
        best_model = pipe.fit(data, maps[best])
    finally:
        data.unpersist()
    rows = [(i, float(maps[i][lr.regParam]), int(maps[i][lr.maxIter]), means[i], i == best)
            for i in range(len(maps))]
    spark = df.sparkSession
    metrics = spark.createDataFrame(rows, "candidate int, reg_param double, max_iter int, mean_auc double, best boolean")
    return best_model, metrics


def save_model(model: PipelineModel, path: str) -> str:
    """L6."""
    model.write().overwrite().save(path)
    return path


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
