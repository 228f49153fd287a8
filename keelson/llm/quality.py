"""Operator 5: quality classifier on random-indexing word vectors.

Words are hashed into a fixed number of entries, and so are their shapes
(capitals, digits, punctuation, length). Every entry has a fixed sparse
random index vector; its context vector is the sum of the index vectors of its
neighbours in the whole corpus, counted in integers by every task and
summed by Spark, so the result does not depend on partitions. A document is the
mean and spread of its words' context vectors. A network with one hidden layer,
trained in numpy on a bounded sample of labelled documents, scores it, and a
temperature fitted on a part of the sample it did not train on calibrates the
probability.

Learned from: the texts of all documents (context vectors, no labels) and the
labels of at most ``SAMPLE`` rows that are not held out, the ones with the
smallest id hash. Defined results: null and empty texts are documents without
words, scored from their (zero) vector; without labels of both kinds every
score is the sample's share of label 1 (0.5 without any); a null id is not held
out and teaches nothing; of labels repeated for an id the lowest counts; repeated rows
are scored alike; texts of any length are read whole; extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from keelson.llm.common import held_out, mix64, row_chunks, sorted_features, span_hashes, stash, text_buffers, word_spans

WORDS, SHAPES, DIM, NONZERO, WINDOW = 4096, 480, 32, 2, 2
SAMPLE = 8000
HIDDEN, EPOCHS, BATCH, RATE = 24, 40, 128, 0.01
THRESHOLD = 0.3


def index_vectors() -> tuple[np.ndarray, np.ndarray]:
    """Places and signs of the random index vectors of all entries."""
    n = WORDS + SHAPES
    h = mix64(np.arange(1, n * NONZERO + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)).reshape(n, NONZERO)
    return (h % np.uint64(DIM)).astype(np.int64), np.where(h >> np.uint64(63), 1.0, -1.0)


def entries(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word entry and shape entry of every word of the rows, and the rows' bounds."""
    starts, ends, bounds = word_spans(raw, offsets)
    word = (span_hashes(raw, starts, ends, lower=False) % np.uint64(WORDS)).astype(np.int64)
    lo = int(offsets[0])
    data = raw[lo:int(offsets[-1])]
    kind = {"upper": (data >= 65) & (data <= 90), "lower": (data >= 97) & (data <= 122),
            "digit": (data >= 48) & (data <= 57), "high": data >= 128}
    count = {}
    for name, mask in kind.items():
        total = np.concatenate([[0], np.cumsum(mask, dtype=np.int32)])
        count[name] = total[ends - lo] - total[starts - lo]
    size = ends - starts
    marks = size - sum(count.values())
    shape = np.minimum(count["upper"], 2)
    for digit, base in ((count["lower"] > 0, 2), (count["digit"] > 0, 2), (np.minimum(marks, 3), 4),
                        (np.digitize(size, [2, 4, 8, 16]), 5), (count["high"] > 0, 2)):
        shape = shape * base + digit
    return word, shape.astype(np.int64) + WORDS, bounds


def _contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pd.DataFrame]:
    place, sign = index_vectors()
    total = np.zeros((WORDS + SHAPES) * DIM)
    count = np.zeros(WORDS + SHAPES, dtype=np.int64)
    for batch in batches:
        raw, offsets = text_buffers(batch.column(0))
        for lo, hi in row_chunks(offsets):
            word, shape, bounds = entries(raw, offsets[lo:hi + 1])
            row = np.repeat(np.arange(hi - lo), np.diff(bounds))
            for item in (word, shape):
                count += np.bincount(item, minlength=len(count))
                for step in range(1, WINDOW + 1):
                    near = row[step:] == row[:-step]
                    a, b = item[:-step][near], item[step:][near]
                    for x, y in ((a, b), (b, a)):
                        for k in range(NONZERO):
                            total += np.bincount(x * DIM + place[y, k], weights=sign[y, k], minlength=len(total))
    table = total.reshape(-1, DIM).astype(np.int64)
    used = np.flatnonzero(count)
    yield pa.RecordBatch.from_arrays(
        [pa.array(used), pa.array(count[used]), *[pa.array(table[used, k].copy()) for k in range(DIM)]],
        ["entry", "n", *[f"c{k}" for k in range(DIM)]])


def context_vectors(docs: DataFrame) -> np.ndarray:
    """Centred unit context vectors of all entries; fixed size, whatever the corpus."""
    cols = [f"c{k}" for k in range(DIM)]
    sums = (docs.select("text").mapInArrow(_contexts, "entry long, n long, " + ", ".join(f"{c} long" for c in cols))
            .groupBy("entry").agg(F.sum("n").alias("n"), *[F.sum(c).alias(c) for c in cols])).toArrow().to_pandas()
    out = np.zeros((WORDS + SHAPES, DIM), dtype=np.float32)
    if len(sums):
        sums = sums.sort_values("entry")
        entry, n = sums["entry"].to_numpy(), sums["n"].to_numpy(np.float64)
        mean = sums[cols].to_numpy(np.float64) / n[:, None]
        for part in (entry < WORDS, entry >= WORDS):
            if part.any():
                v = mean[part] - np.average(mean[part], axis=0, weights=n[part])
                out[entry[part]] = v / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-12)
    return out


def pooled(raw: np.ndarray, offsets: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Mean and spread of the word and shape vectors, and log length, per row."""
    word, shape, bounds = entries(raw, offsets)
    n = np.diff(bounds)
    out = np.zeros((len(n), 4 * DIM + 1))
    full = n > 0
    if full.any():
        at, size = bounds[:-1][full], n[full][:, None]
        for k, item in enumerate((word, shape)):
            vec = table[item]
            mean = np.add.reduceat(vec, at, axis=0, dtype=np.float64) / size
            square = np.add.reduceat(vec * vec, at, axis=0, dtype=np.float64) / size
            out[full, 2 * k * DIM:(2 * k + 1) * DIM] = mean
            out[full, (2 * k + 1) * DIM:(2 * k + 2) * DIM] = np.sqrt(np.maximum(square - mean * mean, 0))
        out[full, -1] = np.log1p(n[full])
    return out


# --- network -----------------------------------------------------------------

def _forward(net: dict, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    hidden = np.tanh((x - net["mean"]) / net["scale"] @ net["w1"] + net["b1"])
    return hidden, hidden @ net["w2"] + net["b2"]


def fit_network(x: np.ndarray, y: np.ndarray, seed: int = 0) -> dict:
    """One hidden layer, trained by Adam on logistic loss, with a fitted temperature."""
    if not len(y) or y.min() == y.max():
        return {"constant": float(y.mean()) if len(y) else 0.5}
    rng = np.random.default_rng(seed)
    order = rng.permutation(len(y))
    cut = max(1, len(y) // 5)
    calib, train = order[:cut], order[cut:]
    net = {"mean": x[train].mean(axis=0), "scale": x[train].std(axis=0) + 1e-3,
           "w1": rng.normal(0, 1 / np.sqrt(x.shape[1]), (x.shape[1], HIDDEN)), "b1": np.zeros(HIDDEN),
           "w2": rng.normal(0, 1 / np.sqrt(HIDDEN), HIDDEN), "b2": np.zeros(1)}
    names = ("w1", "b1", "w2", "b2")
    m = {k: np.zeros_like(net[k]) for k in names}
    v = {k: np.zeros_like(net[k]) for k in names}
    step = 0
    for _ in range(EPOCHS):
        for at in np.array_split(rng.permutation(train), max(1, len(train) // BATCH)):
            hidden, logit = _forward(net, x[at])
            d = (1 / (1 + np.exp(-np.clip(logit, -30, 30))) - y[at]) / len(at)
            back = np.outer(d, net["w2"]) * (1 - hidden * hidden)
            grad = {"w1": ((x[at] - net["mean"]) / net["scale"]).T @ back + 1e-4 * net["w1"], "b1": back.sum(axis=0),
                    "w2": hidden.T @ d + 1e-4 * net["w2"], "b2": np.array([d.sum()])}
            step += 1
            for k in names:
                m[k] = 0.9 * m[k] + 0.1 * grad[k]
                v[k] = 0.999 * v[k] + 0.001 * grad[k] ** 2
                net[k] = net[k] - RATE * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(v[k] / (1 - 0.999 ** step)) + 1e-8)
    logit = _forward(net, x[calib])[1]
    temps = np.geomspace(0.25, 8, 61)
    loss = [np.logaddexp(0, np.where(y[calib] > 0, -1, 1) * logit / t).mean() for t in temps]
    net["temperature"] = float(temps[int(np.argmin(loss))])
    return net


def predict(net: dict, x: np.ndarray) -> np.ndarray:
    if "constant" in net:
        return np.full(len(x), net["constant"])
    return 1 / (1 + np.exp(-np.clip(_forward(net, x)[1] / net["temperature"], -30, 30)))


def _vectors(table: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, offsets = text_buffers(batch.column("text"))
            for lo, hi in row_chunks(offsets):
                x = pooled(raw, offsets[lo:hi + 1], table).astype(np.float32)
                at = np.arange(0, x.size + 1, x.shape[1], dtype=np.int32)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(lo, hi - lo), batch.column("quality").slice(lo, hi - lo),
                     pa.ListArray.from_arrays(pa.array(at), pa.array(x.ravel()))], ["doc_id", "quality", "x"])
    return run


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> tuple[np.ndarray, dict]:
    """Context vectors and network; see the module text for what is learned from."""
    table = context_vectors(docs)
    known = (labels.select("doc_id", F.col("quality").cast("int").alias("quality"))
             .filter(~held_out()).filter("doc_id is not null and quality in (0, 1)")
             .groupBy("doc_id").agg(F.min("quality").alias("quality"))
             .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample))
    # At most ``sample`` rows of two numbers: small enough to send everywhere.
    rows = docs.select("doc_id", "text").join(F.broadcast(stash(known, "quality-sample")), "doc_id")
    id_type = docs.schema["doc_id"].dataType.simpleString()
    data = rows.select("doc_id", "text", "quality").mapInArrow(
        _vectors(table), f"doc_id {id_type}, quality int, x array<float>").orderBy("doc_id", F.xxhash64("x")).limit(2 * sample).toArrow()
    x, order = sorted_features(data, 4 * DIM + 1)
    return table, fit_network(x.astype(np.float64), data.column("quality").to_numpy().astype(np.float64)[order])


def _score(table: np.ndarray, net: dict):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, offsets = text_buffers(batch.column("text"))
            out = np.zeros(batch.num_rows)
            for lo, hi in row_chunks(offsets):
                out[lo:hi] = predict(net, pooled(raw, offsets[lo:hi + 1], table))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out)], [*batch.schema.names, "__score"])
    return run


def score(docs: DataFrame, labels: DataFrame, keep: list[str], sample: int = SAMPLE) -> DataFrame:
    """The columns ``keep`` of every document (``text`` is needed) and ``__score``, a name ``keep`` may not hold."""
    if "__score" in keep:
        raise ValueError("__score is the name of the result")
    table, net = fit(docs, labels, sample)
    cols = docs.select(*[F.col(f"`{c}`") for c in dict.fromkeys([*keep, "text"])])
    schema = StructType([*cols.schema.fields, StructField("__score", DoubleType())])
    return cols.mapInArrow(_score(table, net), schema).select(*[F.col(f"`{c}`") for c in keep], "__score")


def classify(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every document."""
    out = score(docs, labels, ["doc_id"]).withColumnRenamed("__score", "score")
    return out.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
