"""Operator 13: whitening of embeddings by an incremental eigendecomposition.

Entries become integers x = floor(64 * c) + 1,000,000; the fit list holds each
distinct x once. A task keeps the spectrum (eigenvalues and vectors) of the
scatter of its rows about their mean and updates it by centred rank-one terms:
each solves the secular equation for the new eigenvalues between the old ones,
after deflation (negligible components, equal eigenvalues), and rebuilds the vectors
from the solved roots so that they stay orthogonal. Rows enter in blocks through
the rows of the block's triangular factor, which have the same scatter: a block
costs as many rank-one terms as there are dimensions, and one for the shift of the
mean. Spectra of tasks are merged in a tree, ``FAN`` at a time, by the same
rank-one terms, one for each eigenpair and one for the difference of the means.
At last one pass over the fit list projects its centred rows on the merged basis, and
the eigenvectors of that small projected covariance turn the basis into the
components (Rayleigh-Ritz).

Defined results: rows whose vector is null, empty, or holds null or non-finite
entries are dropped, and so are rows with an entry beyond 2^40 in size (x would
leave what sums hold exactly) and rows whose length is not the commonest one (the
longest of equally common ones): one covariance has one dimension. Repeated
vectors count once in the fit and are whitened each. Components whose
eigenvalue is not above ``RANK_EPS`` of the largest have no direction in the data
and are not returned, so a single distinct vector gives no rows; an empty table gives
none. ``deviation`` is null where it would not fit 64 bits. Extra columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keelson.llm.common import stash

SCALE, SHIFT = 64, 1_000_000
COMPONENTS = 16
BLOCK, FAN = 4096, 16
RANK_EPS = 1e-12
LARGEST = float(1 << 40)
_EPS = np.finfo(np.float64).eps


# --- rank-one update of a spectrum ---------------------------------------------------

def secular_roots(d: np.ndarray, z: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues of diag(d) + z z', d rising and z without zeros, and all differences root - d.

    Each root lies between two poles; it is held as an offset from the nearer one
    and found by bisection of the offset's logarithm, so that differences keep
    their relative accuracy however close the root is to the pole.
    """
    n = len(d)
    total = float(z @ z)
    gap = np.append(np.diff(d), total)
    far = d[:, None] - d[None, :]                    # pole j seen from pole i, as d_i - d_j

    def value(origin: np.ndarray, offset: np.ndarray) -> np.ndarray:
        return 1 - (z * z / (far[origin] + offset[:, None])).sum(axis=1)

    place = np.arange(n)
    left = value(place, gap / 2) > 0
    left[-1] = True
    origin = np.where(left, place, place + 1)
    sign = np.where(left, 1.0, -1.0)
    high = np.where(place == n - 1, gap, gap / 2)
    low = high * 1e-45
    for _ in range(64):
        mid = np.sqrt(low) * np.sqrt(high)
        # The function rises from the left pole to the right one.
        beyond = (value(origin, sign * mid) > 0) == left
        high, low = np.where(beyond, mid, high), np.where(beyond, low, mid)
    offset = sign * np.sqrt(low) * np.sqrt(high)
    return d[origin] + offset, far[origin] + offset[:, None]


def rank_one(values: np.ndarray, vectors: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Spectrum of V diag(values) V' + y y'; ``values`` rise."""
    z = vectors.T @ y
    size = max(float(np.abs(values).max(initial=0)), float(z @ z))
    if size == 0:
        return values, vectors
    values, vectors, z = values.copy(), vectors.copy(), z.copy()
    # Equal eigenvalues: a rotation of their vectors leaves one component of z.
    last = 0
    for k in range(1, len(values)):
        if values[k] - values[last] <= 8 * _EPS * size:
            r = float(np.hypot(z[last], z[k]))
            if r > 0:
                c, s = z[k] / r, z[last] / r
                a, b = vectors[:, last].copy(), vectors[:, k].copy()
                vectors[:, last], vectors[:, k] = c * a - s * b, s * a + c * b
                z[last], z[k] = 0.0, r
        last = k
    live = np.flatnonzero(z * z > 8 * _EPS * size * _EPS)
    if len(live):
        d = values[live]
        roots, apart = secular_roots(d, z[live])
        # Components for which the solved roots are exact (Loewner's formula).
        pole = np.arange(len(live))
        above = pole[:, None] >= pole[None, :]
        # Root i pairs with pole i below its column's pole, with the next pole from there on.
        beside = np.where(above, np.append(d[1:], 0.0)[:, None], d[:, None]) - d[None, :]
        beside[-1] = 1.0
        z_new = np.sqrt(np.prod(apart / beside, axis=0))
        z_new *= np.where(z[live] < 0, -1.0, 1.0)
        turn = z_new[None, :] / -apart
        turn /= np.linalg.norm(turn, axis=1, keepdims=True)
        vectors[:, live] = vectors[:, live] @ turn.T
        values[live] = roots
    order = np.argsort(values, kind="stable")
    return values[order], vectors[:, order]


def merge(a: dict, b: dict) -> dict:
    """Spectrum of the rows of ``a`` and ``b`` together, by successive rank-one terms."""
    if not a["n"] or not b["n"]:
        return a if a["n"] else b
    if (a["values"] > 0).sum() < (b["values"] > 0).sum():
        a, b = b, a
    values, vectors = a["values"], a["vectors"]
    for k in np.flatnonzero(b["values"] > 0):
        values, vectors = rank_one(values, vectors, np.sqrt(b["values"][k]) * b["vectors"][:, k])
    n = a["n"] + b["n"]
    # Difference of the means from exact sums: (S_b n_a - S_a n_b) / (n_a n_b).
    apart = np.array([float(int(p) * a["n"] - int(q) * b["n"]) / (a["n"] * b["n"]) for p, q in zip(b["sums"], a["sums"])])
    values, vectors = rank_one(values, vectors, apart * np.sqrt(a["n"] / n * b["n"]))
    return {"n": n, "sums": a["sums"] + b["sums"], "values": values, "vectors": vectors}


def add_block(state: dict, x: np.ndarray) -> dict:
    """``state`` with the rows of ``x`` (integers) added."""
    sums = x.sum(axis=0)
    # Centred before multiplying: whole numbers less the mean's whole part, then its fraction.
    whole, rest = np.divmod(sums, len(x))
    y = (x - whole).astype(np.float64) - rest / len(x)
    if len(y) > y.shape[1]:
        y = np.linalg.qr(y, mode="r")
    values, vectors = np.zeros(x.shape[1]), np.eye(x.shape[1])
    if state["n"]:
        values, vectors = state["values"], state["vectors"]
    for row in y:
        values, vectors = rank_one(values, vectors, row)
    mine = {"n": len(x), "sums": sums, "values": values, "vectors": vectors}
    if not state["n"]:
        return mine
    n, m = state["n"], len(x)
    apart = np.array([float(int(p) * n - int(q) * m) / (n * m) for p, q in zip(sums, state["sums"])])
    values, vectors = rank_one(values, vectors, apart * np.sqrt(n / (n + m) * m))
    return {"n": n + m, "sums": state["sums"] + sums, "values": values, "vectors": vectors}


# --- the job -----------------------------------------------------------------------

_STATE = "n long, sums array<long>, values array<double>, vectors array<double>"


def _to_rows(states: list[dict]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([s["n"] for s in states], pa.int64()), pa.array([s["sums"].tolist() for s in states], pa.list_(pa.int64())),
         pa.array([s["values"].tolist() for s in states], pa.list_(pa.float64())),
         pa.array([s["vectors"].ravel().tolist() for s in states], pa.list_(pa.float64()))], ["n", "sums", "values", "vectors"])


def _from_rows(rows) -> Iterator[dict]:
    for n, sums, values, vectors in zip(*(rows.column(c).to_pylist() for c in ("n", "sums", "values", "vectors"))):
        d = len(values)
        yield {"n": n, "sums": np.array(sums, dtype=np.int64), "values": np.array(values), "vectors": np.array(vectors).reshape(d, d)}


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy().reshape(len(column), -1)


def _spectra(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    state = {"n": 0}
    for batch in batches:
        x = _matrix(batch.column(0)) if batch.num_rows else np.zeros((0, 0))
        for lo in range(0, len(x), BLOCK):
            state = add_block(state, x[lo:lo + BLOCK])
    if state["n"]:
        yield _to_rows([state])


def _merge_group(table: pa.Table) -> pa.Table:
    total = {"n": 0}
    for state in _from_rows(table):
        total = merge(total, state)
    return pa.Table.from_batches([_to_rows([total])])


def spectrum(fit_list: DataFrame) -> dict | None:
    """Spectrum of the scatter of all rows of column ``x``; None without rows."""
    states = stash(fit_list.select("x").mapInArrow(_spectra, _STATE), "spectra")
    while (count := states.count()) > FAN:
        groups = -(-count // FAN)
        # Any dealing into groups of about FAN will do: sums are exact and spectra merge in any order.
        dealt = states.withColumn("part", F.pmod(F.xxhash64("n", "sums"), F.lit(groups)))
        merged = dealt.groupBy("part").applyInArrow(lambda t: _merge_group(t.drop_columns(["part"])), _STATE)
        states = stash(merged, "spectra")
    total = {"n": 0}
    for state in _from_rows(states.toArrow()):
        total = merge(total, state)
    return total if total["n"] else None


def _centred(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    whole, rest = np.divmod(sums, n)
    return (x - whole).astype(np.float64) - rest / n


def _products(n: int, sums: np.ndarray, basis: np.ndarray):
    """Per task: the upper triangle of the summed outer products of projected rows, and their sums."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = basis.shape[1]
        total = np.zeros((k + 1, k))
        for batch in batches:
            if batch.num_rows:
                p = _centred(_matrix(batch.column(0)), n, sums) @ basis
                total[:k] += p.T @ p
                total[k] += p.sum(axis=0)
        row, col = np.triu_indices(k)
        row, col = np.append(row, np.full(k, k)), np.append(col, np.arange(k))
        yield pa.RecordBatch.from_arrays([pa.array(row * k + col), pa.array(total[row, col])], ["cell", "v"])
    return run


def projected_covariance(fit_list: DataFrame, n: int, sums: np.ndarray, basis: np.ndarray) -> np.ndarray:
    """Covariance over the fit list of its rows less the mean, projected on ``basis``."""
    k = basis.shape[1]
    got = (fit_list.select("x").mapInArrow(_products(n, sums, basis), "cell long, v double")
           .groupBy("cell").agg(F.sum("v").alias("v"))).toArrow()
    total = np.zeros((k + 1) * k)
    total[got.column("cell").to_numpy()] = got.column("v").to_numpy()
    total = total.reshape(k + 1, k) / n
    upper = np.triu(total[:k])
    return upper + np.triu(upper, 1).T - np.outer(total[k], total[k])


def integer_vectors(table: DataFrame, vector: str = "embedding", key: str = "vec_id") -> DataFrame:
    """``vec_id`` and ``x`` of the rows that take part; see the module text for which."""
    rows = table.select(F.col(key).alias("vec_id"), F.col(vector).cast("array<double>").alias("c"))
    # In SQL order NaN is the largest double, so one bound turns it away with the infinities.
    rows = rows.filter("c is not null and size(c) > 0 and not exists(c, v -> v is null or abs(v) > %r)" % LARGEST)
    common = rows.groupBy(F.size("c").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    length = common["d"] if common else 0
    return rows.filter(F.size("c") == length).select(
        "vec_id", F.expr(f"transform(c, v -> cast(floor({SCALE} * v) as long) + {SHIFT}L)").alias("x"))


def fit(fit_list: DataFrame, components: int = COMPONENTS) -> dict | None:
    """Mean, components and eigenvalues of a list of distinct integer vectors ``x``."""
    state = spectrum(fit_list)
    if state is None:
        return None
    n, sums = state["n"], state["sums"]
    basis = np.linalg.qr(state["vectors"])[0]
    values, turn = np.linalg.eigh(projected_covariance(fit_list, n, sums, basis))
    order = np.argsort(-values, kind="stable")
    values, vectors = values[order], basis @ turn[:, order]
    trace = float(values.sum())
    keep = np.flatnonzero(values[:components] > RANK_EPS * max(float(values[0]), 0))
    model = {"n": n, "sums": sums, "values": values[keep], "vectors": vectors[:, keep], "trace": trace, "error": 0.0}
    if len(keep):
        whitener = model["vectors"] / np.sqrt(model["values"])
        cov = projected_covariance(fit_list, n, sums, whitener)
        model["error"] = float(np.abs(cov - np.eye(len(keep))).max())
    return model


def _whiten(model: dict):
    n, sums = model["n"], model["sums"]
    whitener = model["vectors"] / np.sqrt(model["values"])
    explained = model["values"] / model["trace"]
    k = len(explained)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, BLOCK):
                part = batch.slice(lo, BLOCK)
                m = part.num_rows
                x = _matrix(part.column("x"))
                # (n*x - S)^2 summed, in 64 bits where it fits.
                near = _centred(x, n, sums)
                fits = (near * near).sum(axis=1) * float(n) ** 2 < 2.0 ** 62
                deviation = np.zeros(m, dtype=np.int64)
                whole, rest = np.divmod(sums, n)
                exact = n * (x[fits] - whole) - rest
                deviation[fits] = (exact * exact).sum(axis=1)
                deviation = np.repeat(deviation, k)
                yield pa.RecordBatch.from_arrays(
                    [part.column("vec_id").take(pa.array(np.repeat(np.arange(m), k))), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                     pa.array(np.full(m * k, n)), pa.array(deviation, mask=np.repeat(~fits, k)), pa.array((near @ whitener).ravel()),
                     pa.array(np.tile(explained, m)), pa.array(np.full(m * k, model["error"]))],
                    ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])
    return run


def whiten(table: DataFrame, vector: str = "embedding", key: str = "vec_id", components: int = COMPONENTS) -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error`` of every row that takes part."""
    rows = integer_vectors(table, vector, key)
    fit_list = stash(rows.select("x").distinct(), "fit-list")
    model = fit(fit_list, components)
    id_type = table.schema[key].dataType.simpleString()
    layout = (f"vec_id {id_type}, component int, n long, deviation long, whitened double, explained double, identity_error double")
    if model is None or not len(model["values"]):
        return table.sparkSession.createDataFrame([], layout)
    return rows.mapInArrow(_whiten(model), layout)
