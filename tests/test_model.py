import numpy as np
import pytest
from pyspark.sql import functions as F

from keelson.operators import model
from keelson.session import scratch_dir


def _newton(X, y, C=1.0, iters=50):
    n, d = X.shape
    A = np.hstack([np.ones((n, 1)), X])
    theta = np.zeros(d + 1)
    pen = np.full(d + 1, 1.0 / C)
    pen[0] = 0.0
    for _ in range(iters):
        p = 1 / (1 + np.exp(-A @ theta))
        g = A.T @ (p - y) + pen * theta
        H = (A * (p * (1 - p))[:, None]).T @ A + np.diag(pen)
        theta -= np.linalg.solve(H, g)
    return theta


def _frame(spark, n=400):
    rng = np.random.default_rng(7)
    X = rng.normal(size=(n, 2))
    y = (X @ np.array([1.5, -2.0]) + 0.3 + rng.normal(size=n) > 0).astype(int)
    rows = [(i, float(a), float(b), int(t)) for i, ((a, b), t) in enumerate(zip(X, y))]
    return spark.createDataFrame(rows, "k int, a double, b double, y int"), X, y


def test_logreg_matches_newton_solution(spark):
    df, X, y = _frame(spark)
    fitted = model.fit_logreg(df, ["a", "b"], "y")
    got = dict(model.coefficients(fitted, ["a", "b"]))
    b0, w1, w2 = _newton(X, y.astype(float))
    assert got["a"] == pytest.approx(w1, abs=1e-4)
    assert got["b"] == pytest.approx(w2, abs=1e-4)
    assert got["(intercept)"] == pytest.approx(b0, abs=1e-4)


def test_auc_equals_rank_formula_and_model_round_trips(spark):
    df, _, _ = _frame(spark)
    fitted = model.fit_logreg(df, ["a", "b"], "y")
    scored = model.score(fitted, df, keep=["k", "y"]).toPandas()
    ranks = scored["score"].rank(method="average")
    n1 = int((scored["y"] == 1).sum())
    n0 = len(scored) - n1
    want = (ranks[scored["y"] == 1].sum() - n1 * (n1 + 1) / 2) / (n1 * n0)
    got = model.area_under_roc(model.score(fitted, df, keep=["y"]), "y")
    assert got == pytest.approx(want, abs=1e-12)
    path = model.save_model(fitted, scratch_dir(spark, "lr"))
    again = model.score(model.load_model(path), df, keep=["k"]).toPandas().sort_values("k")
    assert np.allclose(again["score"].to_numpy(), scored.sort_values("k")["score"].to_numpy())


def test_one_class_label_is_refused(spark):
    df = spark.range(10).select(F.col("id").cast("double").alias("a"), F.lit(1).alias("y"))
    with pytest.raises(ValueError):
        model.fit_logreg(df, ["a"], "y")


def test_cross_validation_picks_best_candidate(spark):
    df, _, _ = _frame(spark)
    best, metrics = model.cross_validate(df, ["a", "b"], "y", "k", [{"regParam": 0.0025}, {"regParam": 50.0}])
    rows = metrics.orderBy("candidate").collect()
    assert len(rows) == 2 and sum(r.best for r in rows) == 1
    assert rows[0].mean_auc >= rows[1].mean_auc - 1e-9 or rows[1].best


def test_three_classes_are_refused(spark):
    df = spark.createDataFrame([(float(i), i % 3) for i in range(30)], "x double, y int")
    with pytest.raises(ValueError, match="binary"):
        model.fit_logreg(df, ["x"], "y")


def test_cross_validation_reads_its_input_once_and_agrees_with_mllib(spark):
    from pyspark.ml.evaluation import BinaryClassificationEvaluator
    from pyspark.ml.tuning import CrossValidator

    df, _, _ = _frame(spark)
    df = spark.createDataFrame(df.collect(), df.schema)
    seen = spark.sparkContext.accumulator(0)

    def value(x):
        seen.add(1)
        return x

    read = df.withColumn("a", F.udf(value, "double")("a"))
    kept = spark.sparkContext._jsc.getPersistentRDDs().size()
    best, metrics = model.cross_validate(read, ["a", "b"], "y", "k", [{"regParam": 0.01}, {"regParam": 5.0}])
    assert seen.value == 400 and spark.sparkContext._jsc.getPersistentRDDs().size() == kept
    data = model.assign_folds(model._with_label(df, "y"), "k", 5, 42, "__fold")
    pipe = model._estimator(["a", "b"], 0.0)
    ev = BinaryClassificationEvaluator(rawPredictionCol="rawPrediction", labelCol=model.LABEL, numBins=0)
    maps = [{pipe.getStages()[-1].regParam: r} for r in (0.01, 5.0)]
    want = CrossValidator(estimator=pipe, estimatorParamMaps=maps, evaluator=ev, foldCol="__fold", numFolds=5).fit(data)
    assert [r.mean_auc for r in metrics.orderBy("candidate").collect()] == pytest.approx(want.avgMetrics, abs=1e-9)
    assert model.coefficients(best, ["a", "b"]) == [(n, pytest.approx(v, abs=1e-6)) for n, v in model.coefficients(want.bestModel, ["a", "b"])]


def test_an_empty_fold_is_refused(spark):
    df = spark.createDataFrame([(1, float(i), i % 2) for i in range(20)], "k int, a double, y int")
    with pytest.raises(ValueError, match="is empty"):
        model.cross_validate(df, ["a"], "y", "k", [{"regParam": 0.1}])
