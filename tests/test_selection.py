import numpy as np
import pytest
from pyspark.sql import functions as F

from keelson.operators import model, selection
from keelson.operators.auc import auc_per_class, grouped_auc, weighted_auc
from keelson.operators.split import assign_folds
from keelson.session import scratch_dir


def _rows(n=400, seed=7):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 2)) * [1.0, 50.0] + [0.0, 1000.0]
    y = (1.5 * x[:, 0] - 0.04 * (x[:, 1] - 1000) + rng.normal(size=n) > 0).astype(int)
    return [(i, float(a), float(b), int(t)) for i, ((a, b), t) in enumerate(zip(x, y))]


SCHEMA = "k int, a double, b double, y int"


def _scaled(x, train, scaling="both"):
    lo, hi, mu, sd = train.min(0), train.max(0), train.mean(0), train.std(0)
    parts = {"minmax": (x - lo) / (hi - lo), "standard": (x - mu) / sd, "none": x}
    return np.hstack([parts["minmax"], parts["standard"]]) if scaling == "both" else parts[scaling]


def _newton(z, y, lam, penalize_intercept):
    a = np.hstack([np.ones((len(z), 1)), z])
    pen = np.full(a.shape[1], lam)
    pen[0] = lam if penalize_intercept else 0.0
    beta = np.zeros(a.shape[1])
    for _ in range(60):
        p = 1 / (1 + np.exp(-a @ beta))
        beta -= np.linalg.solve((a * (p * (1 - p))[:, None]).T @ a + np.diag(pen), a.T @ (p - y) + pen * beta)
    return beta


def _auc(score, y):
    wins = (score[y == 1][:, None] > score[y == 0][None, :]).sum() + 0.5 * (score[y == 1][:, None] == score[y == 0][None, :]).sum()
    return wins / ((y == 1).sum() * (y == 0).sum())


@pytest.mark.parametrize("scaling", ["both", "minmax", "standard", "none"])
@pytest.mark.parametrize("penalize", [True, False])
def test_fit_equals_newton_steps(spark, scaling, penalize):
    rows = _rows()
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    x, y = np.array([r[1:3] for r in rows]), np.array([r[3] for r in rows])
    got = selection.fit_linear(df, ["a", "b"], "y", C=2.0, scaling=scaling, penalize_intercept=penalize)
    want = _newton(_scaled(x, x, scaling), y, 0.5, penalize)
    assert [n for n, _ in got.coefficients()] == selection.scaled_names(["a", "b"], scaling) + ["(intercept)"]
    assert [got.intercept, *got.weights] == pytest.approx(want.tolist(), rel=1e-6, abs=1e-6)
    score = {r.k: r.score for r in got.score(df, ["k"]).collect()}
    eta = want[0] + _scaled(x, x, scaling) @ want[1:]
    assert [score[i] for i in range(len(x))] == pytest.approx((1 / (1 + np.exp(-eta))).tolist(), abs=1e-7)


def test_free_intercept_equals_mllib(spark):
    df = spark.createDataFrame(_rows(), SCHEMA)
    stats = df.agg(F.avg("a"), F.stddev_pop("a"), F.avg("b"), F.stddev_pop("b")).first()
    std = df.select("y", ((F.col("a") - stats[0]) / stats[1]).alias("a"), ((F.col("b") - stats[2]) / stats[3]).alias("b"))
    want = dict(model.coefficients(model.fit_logreg(std, ["a", "b"], "y", tol=1e-12), ["a", "b"]))
    got = dict(selection.fit_linear(df, ["a", "b"], "y", scaling="standard", penalize_intercept=False).coefficients())
    assert [got["std_a"], got["std_b"], got["(intercept)"]] == pytest.approx([want["a"], want["b"], want["(intercept)"]], abs=1e-5)


def test_selection_equals_one_fit_at_a_time_with_scalers_inside_the_folds(spark):
    rows = _rows(300, 3)
    rows[5] = (5, 1e4, 1000.0, 0)                       # an outlier: folds that judge it must not scale by it
    df = spark.createDataFrame(rows, SCHEMA)
    fold = {r.k: r.f for r in assign_folds(df, "k", 4, 42, "f").select("k", "f").collect()}
    fold = np.array([fold[i] for i in range(len(rows))])
    x, y = np.array([r[1:3] for r in rows]), np.array([r[3] for r in rows])
    grid = [{"C": 1.0}, {"C": 1e-4}, {"regParam": 0.1}]
    best, metrics = selection.select_model(df.repartition(5), ["a", "b"], "y", "k", grid, folds=4)
    got = metrics.orderBy("candidate").collect()
    want = []
    for g in grid:
        areas = []
        for f in range(4):
            learn, judge = fold != f, fold == f
            lam = g["regParam"] * learn.sum() if "regParam" in g else 1 / g["C"]
            beta = _newton(_scaled(x[learn], x[learn]), y[learn], lam, True)
            areas.append(_auc(np.round(beta[0] + _scaled(x[judge], x[learn]) @ beta[1:], 8), y[judge]))
        want.append(np.mean(areas))
    assert [r.mean_auc for r in got] == pytest.approx(want, abs=1e-9)
    top = int(np.argmax(want))
    assert [r.best for r in got] == [c == top for c in range(3)]
    assert [r.c for r in got] == [1.0, 1e-4, None] and [r.reg_param for r in got] == [None, None, 0.1]
    lam = grid[top]["regParam"] * len(x) if "regParam" in grid[top] else 1 / grid[top]["C"]
    assert [best.intercept, *best.weights] == pytest.approx(_newton(_scaled(x, x), y, lam, True).tolist(), rel=1e-5, abs=1e-6)


def test_model_round_trip_and_refusals(spark):
    df = spark.createDataFrame(_rows(60), SCHEMA)
    fitted = selection.fit_linear(df, ["a", "b"], "y")
    path = selection.save_linear(spark, fitted, scratch_dir(spark, "linear"))
    assert selection.load_linear(spark, path) == fitted
    for bad, words in ((df.withColumn("y", F.lit(1)), "two classes"), (df.withColumn("y", F.col("k")), "two classes"),
                       (df.withColumn("a", F.when(F.col("k") == 3, None).otherwise(F.col("a"))), "missing"),
                       (df.withColumn("b", F.lit(float("nan"))), "missing"), (df.limit(0), "no training rows")):
        with pytest.raises(ValueError, match=words):
            selection.fit_linear(bad, ["a", "b"], "y")
    with pytest.raises(ValueError, match="empty grid"):
        selection.select_model(df, ["a"], "y", "k", [])
    with pytest.raises(ValueError, match="scaling"):
        selection.fit_linear(df, ["a"], "y", scaling="odd")
    constant = selection.fit_linear(df.withColumn("b", F.lit(4.0)), ["a", "b"], "y")
    assert dict(constant.coefficients())["mm_b"] == 0 == dict(constant.coefficients())["std_b"]


def _score_rows(n, seed, classes=3):
    rng = np.random.default_rng(seed)
    return [(int(rng.integers(0, 2)), int(rng.integers(0, classes)), *[float(np.round(v, 1)) for v in rng.normal(size=classes)]) for _ in range(n)]


@pytest.mark.parametrize("max_cells", [1_000_000, 7])
def test_grouped_auc_equals_all_pairs(spark, max_cells):
    rows = _score_rows(500, 1) + [(9, 1, 0.5, 0.0, 0.0)] * 3 + [(None, c, s, 0.0, 0.0) for c, s in ((0, 0.3), (1, 0.3), (1, 0.1))]
    df = spark.createDataFrame(rows, "g int, c int, s0 double, s1 double, s2 double")
    got = {r.g: r for r in grouped_auc(df, ["g"], "s0", F.col("c") == 1, max_cells).collect()}
    for g in (0, 1, None):
        mine = [(r[2], r[1] == 1) for r in rows if r[0] == g]
        s, y = np.array([m[0] for m in mine]), np.array([int(m[1]) for m in mine])
        assert got[g].auc == pytest.approx(_auc(s, y), abs=1e-12) and got[g].n_pos == y.sum()
    assert got[9].auc is None and len(got) == 4
    assert grouped_auc(df.limit(0), ["g"], "s0", F.col("c") == 1).collect() == []
    gaps = df.withColumn("s0", F.when(F.col("c") == 2, F.lit(None)).otherwise(F.col("s0")))
    whole = grouped_auc(gaps, [], "s0", F.col("c") == 1, max_cells).first()
    assert whole.n_pos + whole.n_neg == sum(r[1] != 2 for r in rows)


@pytest.mark.parametrize("max_cells", [1_000_000, 5])
def test_weighted_auc_of_three_and_two_classes(spark, max_cells):
    rows = _score_rows(400, 2)
    df = spark.createDataFrame(rows, "g int, c int, s0 double, s1 double, s2 double")
    label = np.array([r[1] for r in rows])
    parts = [_auc(np.array([r[2 + c] for r in rows]), (label == c).astype(int)) for c in range(3)]
    shares = [(label == c).mean() for c in range(3)]
    got = weighted_auc(df, "c", {0: "s0", 1: "s1", 2: "s2"}, max_cells).first()[0]
    assert got == pytest.approx(sum(p * s for p, s in zip(parts, shares)), abs=1e-12)
    assert {r["class"]: r["share"] for r in auc_per_class(df, "c", {0: "s0", 1: "s1", 2: "s2"}, max_cells).collect()} == \
        pytest.approx({str(c): s for c, s in enumerate(shares)})
    two = df.filter("c < 2").withColumn("p", 1 / (1 + F.exp(-F.col("s0")))).withColumn("q", 1 - F.col("p"))
    plain = model.area_under_roc(two, "c", "p")
    assert weighted_auc(two, "c", {1: "p", 0: "q"}, max_cells).first()[0] == pytest.approx(plain, abs=1e-12)
    with pytest.raises(ValueError):
        weighted_auc(df, "c", {0: "s0"})
