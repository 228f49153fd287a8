"""Operator 7: hierarchical language identification.

Features are the shares of hashed byte n-grams (n = 1, 2, 3) of the text with
ASCII letters lower-cased. A first set of linear one-versus-one support vector
machines picks the language family; a second set, trained within each family,
separates its languages. A text's margins are sums of per-n-gram weights, so
whole texts of any length are scored in one pass over their bytes.

Learned from: text and language of documents that are not held out, at most
about ``SAMPLE`` in all, shared equally by the languages (rows are chosen by
id hash). Defined results: ``und`` with score 0 for a null text or one without
a letter, and for all if nothing can be learned; languages without a family in
``FAMILIES`` are families of their own; a null id is not held out and teaches
nothing; repeated rows are scored alike; texts of any length are read whole; extra
columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from keelson.llm.common import CHUNK_BYTES, held_out, row_chunks, sorted_features, stash, text_buffers

BUCKETS, ORDERS = 2048, (1, 2, 3)
SAMPLE = 2000
STEPS, PENALTY = 300, 1e-4
UNKNOWN = "und"

# Families of languages by ISO 639-1 code.
FAMILIES = {
    "germanic": ("af", "da", "de", "en", "is", "nl", "no", "sv"),
    "romance": ("ca", "es", "fr", "gl", "it", "pt", "ro"),
    "slavic": ("be", "bg", "cs", "hr", "mk", "pl", "ru", "sk", "sl", "sr", "uk"),
    "uralic": ("et", "fi", "hu"),
    "turkic": ("az", "kk", "tr", "uz"),
    "indic": ("bn", "gu", "hi", "mr", "ne", "pa"),
}
_FAMILY = {code: name for name, codes in FAMILIES.items() for code in codes}

_LOWER = np.arange(256, dtype=np.uint32)
_LOWER[65:91] += 32


def family(lang: str) -> str:
    return _FAMILY.get(lang, f"={lang}")


def ngram_buckets(raw: np.ndarray, lo: int, hi: int, n: int) -> np.ndarray:
    """Bucket of the ``n`` bytes that start at each place of ``raw[lo:hi]``."""
    data = _LOWER[raw[lo:hi]]
    code = np.full(len(data), n, dtype=np.uint32)
    for k in range(n):
        shifted = data if k == 0 else np.concatenate([data[k:], np.zeros(min(k, len(data)), np.uint32)])
        code = (code ^ shifted) * np.uint32(0x01000193)
    code ^= code >> np.uint32(15)
    return ((code * np.uint32(0x9E3779B1)) >> np.uint32(21)).astype(np.int64)


def _row_ngrams(raw: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(buckets, row) of all n-grams that lie within a row."""
    lo, hi = int(offsets[0]), int(offsets[-1])
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    for n in ORDERS:
        bucket = ngram_buckets(raw, lo, hi, n)
        inside = np.ones(len(row), dtype=bool)
        if n > 1:
            inside[-(n - 1):] = False
            inside[:-(n - 1)] = row[n - 1:] == row[:-(n - 1)]
        yield bucket, np.where(inside, row, -1)


def shares(raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Share of each bucket among a row's n-grams."""
    rows = len(offsets) - 1
    out = np.zeros(rows * BUCKETS)
    for bucket, row in _row_ngrams(raw, offsets):
        ok = row >= 0
        out += np.bincount(row[ok] * BUCKETS + bucket[ok], minlength=len(out))
    out = out.reshape(rows, BUCKETS)
    return out / np.maximum(out.sum(axis=1, keepdims=True), 1)


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        raw, offsets = text_buffers(batch.column("text"))
        for lo, hi in row_chunks(offsets, CHUNK_BYTES):
            for a in range(lo, hi, 256):
                b = min(a + 256, hi)
                x = shares(raw, offsets[a:b + 1]).astype(np.float32)
                at = np.arange(0, x.size + 1, BUCKETS, dtype=np.int32)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(a, b - a), batch.column("lang").slice(a, b - a),
                     pa.ListArray.from_arrays(pa.array(at), pa.array(x.ravel()))], ["doc_id", "lang", "x"])


def svm(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, float]:
    """Linear support vector machine: squared hinge loss, accelerated gradient steps.

    Both classes count the same, whatever their numbers of rows.
    """
    weight = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y < 0).sum()))
    w, b = np.zeros(x.shape[1]), 0.0
    pw, pb = w, b
    bound = 2 * float((weight * (np.einsum("ij,ij->i", x, x) + 1)).sum()) + PENALTY
    for t in range(STEPS):
        mw, mb = w + t / (t + 3) * (w - pw), b + t / (t + 3) * (b - pb)
        slack = weight * np.maximum(0, 1 - y * (x @ mw.astype(x.dtype) + mb)) * y
        pw, pb = w, b
        w = mw + (2 * (slack.astype(x.dtype) @ x) - PENALTY * mw) / bound
        b = mb + 2 * slack.sum() / bound
    return w, float(b)


def fit_machines(x: np.ndarray, langs: np.ndarray) -> dict:
    """All machines: pairs of families, then pairs of languages of one family."""
    names = sorted(set(langs))
    # The sample stays in 32 bits and is scaled in place: the driver holds it once.
    scale = ((x.std(axis=0) if len(x) else np.zeros(x.shape[1])) + 1e-5).astype(x.dtype)
    x /= scale
    fam = np.array([family(g) for g in langs])
    machines = []
    for level, labels in (("family", fam), ("lang", langs)):
        for p, q in combinations(sorted(set(labels)), 2):
            if level == "lang" and family(p) != family(q):
                continue
            rows = (labels == p) | (labels == q)
            w, b = svm(x[rows], np.where(labels[rows] == p, 1.0, -1.0))
            machines.append((level, p, q, w / scale, b))
    return {"langs": names, "pairs": [m[:3] for m in machines],
            "w": np.stack([m[3] for m in machines], axis=1) if machines else np.zeros((BUCKETS, 0)),
            "b": np.array([m[4] for m in machines])}


def margins(raw: np.ndarray, offsets: np.ndarray, model: dict) -> np.ndarray:
    """Signed margin of every machine per row."""
    rows = len(offsets) - 1
    total, count = np.zeros((rows, len(model["b"]))), np.zeros(rows)
    for bucket, row in _row_ngrams(raw, offsets):
        ok = row >= 0
        row, bucket = row[ok], bucket[ok]
        n = np.bincount(row, minlength=rows)
        count += n
        full = n > 0
        if full.any():
            at = (np.cumsum(n) - n)[full]
            total[full] += np.add.reduceat(model["w"][bucket], at, axis=0)
    return total / np.maximum(count, 1)[:, None] + model["b"]


def _pick(names: list[str], pairs: list[tuple[int, str, str]], margin: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Winner of one-versus-one votes (ties by summed margin) and its least margin."""
    place = {n: k for k, n in enumerate(names)}
    votes, summed = np.zeros((len(margin), len(names))), np.zeros((len(margin), len(names)))
    for k, p, q in pairs:
        m = margin[:, k]
        votes[:, place[p]] += m >= 0
        votes[:, place[q]] += m < 0
        summed[:, place[p]] += np.tanh(m)
        summed[:, place[q]] -= np.tanh(m)
    best = (votes + summed / (2 * len(names) + 1)).argmax(axis=1)
    least = np.full(len(margin), np.inf)
    for k, p, q in pairs:
        for name, sign in ((p, 1), (q, -1)):
            mine = best == place[name]
            least[mine] = np.minimum(least[mine], sign * margin[mine, k])
    return best, least


def decide(margin: np.ndarray, model: dict) -> tuple[np.ndarray, np.ndarray]:
    """Language and score per row from the margins."""
    fams = sorted({family(g) for g in model["langs"]})
    at = lambda level: [(k, p, q) for k, (v, p, q) in enumerate(model["pairs"]) if v == level]
    best, least = _pick(fams, at("family"), margin)
    sure = 1 / (1 + np.exp(-np.clip(3 * least, -30, 30)))
    lang = np.empty(len(margin), dtype=object)
    for k, fam in enumerate(fams):
        rows = np.flatnonzero(best == k)
        mine = [g for g in model["langs"] if family(g) == fam]
        inner, low = _pick(mine, [m for m in at("lang") if family(m[1]) == fam], margin[rows])
        lang[rows] = np.array(mine, dtype=object)[inner]
        sure[rows] *= 1 / (1 + np.exp(-np.clip(3 * low, -30, 30)))
    return lang, sure


def fit(docs: DataFrame, sample: int = SAMPLE) -> dict:
    known = docs.select("doc_id", "text", "lang").filter(~held_out()).filter(
        "doc_id is not null and lang is not null and text is not null")
    counts = stash(known.filter("length(lang) > 0").groupBy("lang").agg(F.count(F.lit(1)).alias("n")), "lang-counts")
    kinds = counts.count()
    if not kinds:
        return fit_machines(np.zeros((0, BUCKETS), np.float32), np.zeros(0, dtype=object))
    # Each language's rows with the smallest hashes, by a threshold on the hash.
    each = max(1, sample // kinds)
    share = F.pmod(F.xxhash64(F.lit("lang"), "doc_id"), F.lit(1_000_003)) / F.lit(1_000_003)
    chosen = known.join(counts, "lang").filter(share < F.lit(float(each)) / F.col("n"))
    id_type = docs.schema["doc_id"].dataType.simpleString()
    data = chosen.select("doc_id", "lang", "text").mapInArrow(
        _features, f"doc_id {id_type}, lang string, x array<float>").orderBy("doc_id", "lang", F.xxhash64("x")).limit(2 * sample).toArrow()
    langs = np.array(data.column("lang").to_pylist(), dtype=object)
    x, order = sorted_features(data, BUCKETS)
    del data
    return fit_machines(x, langs[order])


def _predict(model: dict):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        limit = max(1 << 16, CHUNK_BYTES // max(1, len(model["b"]) // 4))
        for batch in batches:
            raw, offsets = text_buffers(batch.column("text"))
            letters = batch.column("__letters").to_numpy(zero_copy_only=False)
            lang = np.full(batch.num_rows, UNKNOWN, dtype=object)
            score = np.zeros(batch.num_rows)
            for lo, hi in row_chunks(offsets, limit):
                if model["langs"]:
                    lang[lo:hi], score[lo:hi] = decide(margins(raw, offsets[lo:hi + 1], model), model)
            lang[~letters], score[~letters] = UNKNOWN, 0.0
            keep = [c for c in batch.schema.names if c != "__letters"]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in keep], pa.array(lang, pa.string()), pa.array(score)], [*keep, "__lang", "__score"])
    return run


def predict(docs: DataFrame, keep: list[str], model: dict) -> DataFrame:
    """The columns ``keep`` of every document with ``__lang`` and ``__score``.

    ``keep`` may not hold these two names or ``__letters``.
    """
    if {"__lang", "__score", "__letters"} & set(keep):
        raise ValueError("__lang, __score and __letters are names of the operator's own")
    cols = docs.select(*[F.col(f"`{c}`") for c in dict.fromkeys([*keep, "text"])])
    schema = StructType([*cols.schema.fields, StructField("__lang", StringType()), StructField("__score", DoubleType())])
    letters = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    return cols.withColumn("__letters", letters).mapInArrow(_predict(model), schema).select(
        *[F.col(f"`{c}`") for c in keep], "__lang", "__score")


def identify(docs: DataFrame) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` of every document."""
    out = predict(docs, ["doc_id"], fit(docs))
    return out.select("doc_id", held_out().alias("held_out"), F.col("__lang").alias("lang_pred"), F.col("__score").alias("score"))
