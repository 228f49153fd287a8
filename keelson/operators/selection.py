"""Logistic fits of many (fold, candidate) models at once.

Scaling is affine, so every model's linear predictor is one over the raw features,
and gradient and Hessian with respect to a model's scaled features follow
from sums over raw features. One Newton step of all models is therefore one
aggregate: each task adds up, for every model, the gradient and the Hessian over
the rows of the other folds; Spark adds the tasks' sums, and the driver
solves systems as small as the number of features. The scalers of a model see the rows
it learns from and no others: their statistics are merged from one aggregate by fold.

The objective is the reference's: the sum of log-losses plus half the squared weights over
C. Its solver treats the intercept as the weight of a constant column and penalises
it too; ``penalize_intercept=False`` leaves the intercept free (MLlib's choice). C is
the same for every fold, whatever its rows; a candidate may give ``regParam`` (the
penalty on the mean loss) instead.

Missing feature values are an error (impute first), as are a label with other than two
classes and an empty training side.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keelson.operators.auc import grouped_auc
from keelson.operators.split import assign_folds
from keelson.session import scratch_dir

SCALINGS = ("both", "minmax", "standard", "none")
# Newton steps end when the next one can lower the loss by no more than this; that one
# is still taken, and leaves an error of the order of its square.
TOLERANCE, MAX_STEPS = 1e-10, 60
ALL = -1


@dataclass(frozen=True)
class LinearModel:
    """A fitted regression: weights over scaled features and, folded into one, over raw ones."""

    features: tuple[str, ...]
    names: tuple[str, ...]
    weights: tuple[float, ...]
    intercept: float
    raw_weights: tuple[float, ...]
    raw_intercept: float

    def coefficients(self) -> list[tuple[str, float]]:
        return [*zip(self.names, self.weights), ("(intercept)", self.intercept)]

    def score(self, df: DataFrame, keep: Sequence[str], score_col: str = "score") -> DataFrame:
        """L2: probability of the positive class; a projection, null where a feature is null."""
        eta = F.lit(self.raw_intercept)
        for c, w in zip(self.features, self.raw_weights):
            eta = eta + F.lit(w) * F.col(c).cast("double")
        return df.select(*keep, (F.lit(1.0) / (F.lit(1.0) + F.exp(-eta))).alias(score_col))


def coefficient_frame(spark: SparkSession, model: LinearModel) -> DataFrame:
    return spark.createDataFrame(model.coefficients(), "feature string, coefficient double")


_MODEL_ROW = ("features array<string>, names array<string>, weights array<double>, intercept double, "
              "raw_weights array<double>, raw_intercept double")


def save_linear(spark: SparkSession, model: LinearModel, path: str) -> str:
    """The model as a one-row table."""
    row = tuple(list(v) if isinstance(v, tuple) else v for v in vars(model).values())
    spark.createDataFrame([row], _MODEL_ROW).write.mode("overwrite").parquet(path)
    return path


def load_linear(spark: SparkSession, path: str) -> LinearModel:
    row = spark.read.parquet(path).select(*vars(LinearModel)["__dataclass_fields__"]).first()
    return LinearModel(*[tuple(v) if isinstance(v, list) else v for v in row])


# --- scaler moments by fold ----------------------------------------------------

def _fold_moments(data: DataFrame, features: Sequence[str]) -> dict[int, dict]:
    """Per fold: rows, positives, and count, extremes, mean and squared deviations of every feature."""
    aggs = [F.count(F.lit(1)).alias("n"), F.sum("y").alias("pos")]
    for k, _ in enumerate(features):
        x = F.col(f"x{k}")
        aggs += [F.count(F.when(~F.isnan(x), x)).alias(f"n{k}"), F.min(x).alias(f"lo{k}"), F.max(x).alias(f"hi{k}"),
                 F.avg(x).alias(f"mu{k}"), F.var_pop(x).alias(f"var{k}")]
    out = {}
    for r in data.groupBy("fold").agg(*aggs).collect():
        missing = [c for k, c in enumerate(features) if r[f"n{k}"] != r["n"]]
        if missing:
            raise ValueError(f"missing values in {missing}; impute them first")
        pick = lambda name: np.array([r[f"{name}{k}"] for k in range(len(features))], dtype=float)
        out[r["fold"]] = {"n": r["n"], "pos": r["pos"], "lo": pick("lo"), "hi": pick("hi"), "mu": pick("mu"), "ss": pick("var") * r["n"]}
    return out


def _together(parts: Sequence[dict]) -> dict:
    """Moments of the rows of all ``parts``."""
    if not parts:
        return {"n": 0, "pos": 0.0}
    n = sum(p["n"] for p in parts)
    mu = sum(p["n"] * p["mu"] for p in parts) / n
    return {"n": n, "pos": sum(p["pos"] for p in parts), "lo": np.min([p["lo"] for p in parts], axis=0),
            "hi": np.max([p["hi"] for p in parts], axis=0), "mu": mu,
            "ss": sum(p["ss"] + p["n"] * (p["mu"] - mu) ** 2 for p in parts)}


def _scaling(stats: dict, scaling: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Scaled feature j is a[j] * x[source[j]] + b[j]; a constant column scales to 0."""
    k = len(stats["lo"])
    a, b = [], []
    if scaling in ("both", "minmax"):
        span = stats["hi"] - stats["lo"]
        inv = np.divide(1.0, span, out=np.zeros(k), where=span > 0)
        a.append(inv), b.append(-stats["lo"] * inv)
    if scaling in ("both", "standard"):
        std = np.sqrt(stats["ss"] / stats["n"])
        inv = np.divide(1.0, std, out=np.zeros(k), where=std > 0)
        a.append(inv), b.append(-stats["mu"] * inv)
    if scaling == "none":
        a.append(np.ones(k)), b.append(np.zeros(k))
    return np.concatenate(a), np.concatenate(b), np.tile(np.arange(k), len(a))


def scaled_names(features: Sequence[str], scaling: str) -> list[str]:
    prefixes = {"both": ("mm_", "std_"), "minmax": ("mm_",), "standard": ("std_",), "none": ("",)}[scaling]
    return [f"{p}{c}" for p in prefixes for c in features]


# --- Newton steps ----------------------------------------------------------------

def _step_sums(theta: np.ndarray, out_fold: np.ndarray, centre: np.ndarray, spread: np.ndarray):
    """Sums of one step over a task's rows: loss, gradient and Hessian of every model, one after another."""
    models, p = theta.shape
    first, second = np.triu_indices(p)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        loss, grad, hess = np.zeros(models), np.zeros((models, p)), np.zeros((models, len(first)))
        for batch in batches:
            for lo in range(0, batch.num_rows, 8192):
                part = batch.slice(lo, 8192)
                x = np.empty((part.num_rows, p))
                x[:, 0] = 1
                for k in range(p - 1):
                    x[:, k + 1] = (part.column(f"x{k}").to_numpy() - centre[k]) / spread[k]
                y = part.column("y").to_numpy()[:, None]
                learns = part.column("fold").to_numpy()[:, None] != out_fold[None, :]
                eta = x @ theta.T
                prob = 1 / (1 + np.exp(-np.clip(eta, -700, 700)))
                loss += ((np.logaddexp(0, eta) - y * eta) * learns).sum(axis=0)
                grad += ((prob - y) * learns).T @ x
                hess += (prob * (1 - prob) * learns).T @ (x[:, first] * x[:, second])
        flat = np.concatenate([loss, grad.ravel(), hess.ravel()])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(flat))), pa.array(flat)], ["cell", "v"])
    return run


def _sums(data: DataFrame, theta: np.ndarray, out_fold: np.ndarray, centre: np.ndarray, spread: np.ndarray):
    models, p = theta.shape
    size = models * (1 + p + p * (p + 1) // 2)
    got = (data.mapInArrow(_step_sums(theta, out_fold, centre, spread), "cell long, v double")
           .groupBy("cell").agg(F.sum("v").alias("v"))).toArrow()
    flat = np.zeros(size)
    flat[got.column("cell").to_numpy()] = got.column("v").to_numpy()
    hess = np.zeros((models, p, p))
    first, second = np.triu_indices(p)
    hess[:, first, second] = hess[:, second, first] = flat[models * (1 + p):].reshape(models, -1)
    return flat[:models], flat[models:models * (1 + p)].reshape(models, p), hess


def _fit_all(data: DataFrame, jobs: Sequence[dict], centre: np.ndarray, spread: np.ndarray, penalize_intercept: bool) -> list[np.ndarray]:
    """Weights (intercept first) of every job, by Newton steps that all jobs share."""
    out_fold = np.array([j["fold"] for j in jobs])
    maps, keep = [], []
    for j in jobs:
        a, b, source = j["scaling"]
        t = np.zeros((len(a) + 1, len(centre) + 1))
        t[0, 0] = 1
        t[np.arange(1, len(a) + 1), source + 1] = a * spread[source]
        t[1:, 0] = a * centre[source] + b
        maps.append(t)
        mask = np.ones(len(a) + 1)
        mask[0] = float(penalize_intercept)
        keep.append(mask * j["penalty"])
    beta = [np.zeros(len(m)) for m in keep]
    before, best = [np.inf] * len(jobs), [b.copy() for b in beta]
    done = [False] * len(jobs)
    for _ in range(MAX_STEPS):
        theta = np.stack([t.T @ b for t, b in zip(maps, beta)])
        loss, grad, hess = _sums(data, theta, out_fold, centre, spread)
        for m, t in enumerate(maps):
            if done[m]:
                continue
            value = loss[m] + 0.5 * float(keep[m] @ (beta[m] ** 2))
            if value > before[m] * (1 + 1e-9) + 1e-12:
                beta[m] = (beta[m] + best[m]) / 2      # overshot: halve the step
                done[m] = np.abs(beta[m] - best[m]).max() == 0
                continue
            before[m], best[m] = value, beta[m]
            g = t @ grad[m] + keep[m] * beta[m]
            seen = t @ hess[m] @ t.T
            h = seen + np.diag(keep[m])
            # A constant column moves nothing; left in, the solver's rounding would give it a weight.
            live = seen.any(axis=1) | (g != 0)
            step = np.zeros(len(g))
            step[live] = np.linalg.lstsq(h[np.ix_(live, live)], g[live], rcond=None)[0]
            beta[m] = beta[m] - step
            done[m] = float(g @ step) / 2 <= TOLERANCE * max(1.0, 1e-6 * value)
        if all(done):
            break
    return beta


def _model(features: Sequence[str], scaling: str, job: dict, beta: np.ndarray) -> LinearModel:
    a, b, source = job["scaling"]
    raw = np.bincount(source, weights=beta[1:] * a, minlength=len(features))
    return LinearModel(tuple(features), tuple(scaled_names(features, scaling)), tuple(beta[1:].tolist()), float(beta[0]),
                       tuple(raw.tolist()), float(beta[0] + (beta[1:] * b).sum()))


def _written(df: DataFrame, features: Sequence[str], label: str) -> DataFrame:
    """The columns the steps read, once, in the shared folder."""
    cols = [F.col(c).cast("double").alias(f"x{k}") for k, c in enumerate(features)]
    path = scratch_dir(df.sparkSession, "selection")
    out = df.select(*cols, F.col(label).cast("double").alias("y"), F.col("__fold").alias("fold"))
    out.write.parquet(path)
    return df.sparkSession.read.schema("".join(f"x{k} double, " for k in range(len(features))) + "y double, fold int").parquet(path)


def _checked(data: DataFrame, features: Sequence[str], label: str, scaling: str) -> dict[int, dict]:
    if scaling not in SCALINGS:
        raise ValueError(f"scaling must be one of {SCALINGS}")
    odd = data.filter("y is null or y not in (0, 1)").limit(1).count()
    if odd:
        raise ValueError(f"label {label} holds other values than two classes (false/true, 0/1)")
    return _fold_moments(data, features)


def _job(fold: int, candidate: Mapping[str, float], moments: dict[int, dict], scaling: str, label: str) -> dict:
    stats = _together([m for f, m in moments.items() if f != fold])
    if not stats["n"]:
        raise ValueError("no training rows" if fold == ALL else f"no training rows outside fold {fold}")
    if stats["pos"] in (0, stats["n"]):
        raise ValueError(f"label {label} has fewer than two classes")
    penalty = float(candidate["regParam"]) * stats["n"] if "regParam" in candidate else 1.0 / float(candidate.get("C", 1.0))
    return {"fold": fold, "penalty": penalty, "scaling": _scaling(stats, scaling)}


def _conditioning(moments: dict[int, dict]) -> tuple[np.ndarray, np.ndarray]:
    """Centre and spread of all rows: only for the arithmetic, no weight depends on them."""
    stats = _together(list(moments.values()))
    std = np.sqrt(stats["ss"] / stats["n"])
    return stats["mu"], np.where(std > 0, std, 1.0)


def fit_linear(df: DataFrame, features: Sequence[str], label: str, C: float = 1.0, scaling: str = "both",
               penalize_intercept: bool = True) -> LinearModel:
    """L1: one regression on every row of ``df``, scalers fitted on the same rows."""
    data = _written(df.withColumn("__fold", F.lit(0)), features, label)
    moments = _checked(data, features, label, scaling)
    job = _job(ALL, {"C": C}, moments, scaling, label)
    beta = _fit_all(data, [job], *_conditioning(moments), penalize_intercept)
    return _model(features, scaling, job, beta[0])


def _judged(fitted: np.ndarray, folds: Sequence[int], candidates: int):
    """Scores of every row by the candidates' models that did not learn from its fold."""
    place = {f: k for k, f in enumerate(folds)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, p = batch.num_rows, fitted.shape[2]
            x = np.stack([np.ones(n), *[batch.column(f"x{k}").to_numpy() for k in range(p - 1)]], axis=1)
            mine = fitted[[place[f] for f in batch.column("fold").to_numpy().tolist()]] if n else fitted[:0]
            eta = np.einsum("np,ncp->nc", x, mine)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(batch.column("fold").to_numpy(), candidates)), pa.array(np.tile(np.arange(candidates, dtype=np.int32), n)),
                 pa.array(eta.ravel()), pa.array(np.repeat(batch.column("y").to_numpy() > 0, candidates))], ["fold", "candidate", "eta", "own"])
    return run


# Scores that differ less than this (rounding of sums) count as tied.
TIE_DIGITS = 10


def select_model(df: DataFrame, features: Sequence[str], label: str, key: str | Sequence[str],
                 grid: Sequence[Mapping[str, float]], folds: int = 5, seed: int = 42, scaling: str = "both",
                 penalize_intercept: bool = True) -> tuple[LinearModel, DataFrame]:
    """The grid point with the best mean AUC over hashed folds, refitted on all rows.

    Returns the model and a frame (candidate, c, reg_param, mean_auc, best); ties go to the first
    candidate, and a fold without both classes has no area and is left out of the mean.
    """
    if not grid:
        raise ValueError("empty grid")
    data = _written(assign_folds(df, key, folds, seed, "__fold"), features, label)
    moments = _checked(data, features, label, scaling)
    places = [*sorted(moments), ALL]
    jobs = [_job(f, c, moments, scaling, label) for f in places for c in grid]
    betas = _fit_all(data, jobs, *_conditioning(moments), penalize_intercept)
    models = [_model(features, scaling, j, b) for j, b in zip(jobs, betas)]
    lines = np.array([[m.raw_intercept, *m.raw_weights] for m in models]).reshape(len(places), len(grid), -1)
    judged = data.mapInArrow(_judged(lines, places, len(grid)), "fold int, candidate int, eta double, own boolean")
    areas = grouped_auc(judged, ["fold", "candidate"], F.round("eta", TIE_DIGITS), "own", largest=max(m["n"] for m in moments.values()))
    means = {r["candidate"]: r["a"] for r in areas.groupBy("candidate").agg(F.avg("auc").alias("a")).collect()}
    best = max(range(len(grid)), key=lambda c: (means.get(c) if means.get(c) is not None else -1.0, -c))
    rows = [(c, None if "regParam" in g else float(g.get("C", 1.0)), float(g["regParam"]) if "regParam" in g else None, means.get(c), c == best)
            for c, g in enumerate(grid)]
    metrics = df.sparkSession.createDataFrame(rows, "candidate int, c double, reg_param double, mean_auc double, best boolean")
    return models[len(moments) * len(grid) + best], metrics
