"""Operator 11: toxic passages by maximum-scoring segments.

Tokens are runs of ASCII letters and digits and of bytes above 127, ASCII
letters lower-cased. A token has three keys: its first four and five bytes and
the whole token, so that an inflected form shares keys with its stem. A key counts
once a document. Keys that go with one class (likelihood ratio at least
``LEAST_RATIO``, most telling first, at most ``KEYS``) score by their log-odds
between toxic and other documents under a Dirichlet prior proportional to
the key's share in the whole corpus. A token counts for and scores by its longest
such key, so that a stem is judged by what its known words leave; all other
tokens share one class with a (negative) score of its own.

A linear scan finds all maximal scoring segments of a document, each a passage
that no extension or cut improves. The segments of clean documents, scored by
a model that did not learn from them, give the rate and the scale of the
extreme-value distribution of chance segments. A document's evidence is the least
chance of its best one, two, three ... segments together, and a logistic curve
over that evidence, fitted on scores from outside each row's fold, gives
the probability.

Learned from: word counts of all documents (the prior, no labels) and the labels
of at most ``SAMPLE`` ids that are not held out, those with the smallest id
hash; copies and most near copies of one text count once for each class. Defined results: null and empty texts have
no segment and get the score of no evidence; without labels of both kinds every
score is the sample's share of label 1 (0.5 without any); a null id is
not held out and teaches nothing; of labels repeated for an id the highest counts;
repeated rows are scored alike; whole texts are read, of any length; extra columns
are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keelson.llm.common import held_out, mix64, row_chunks, shingle_hashes, span_hashes, stash, text_buffers

STEMS = (4, 5)
SAMPLE, KEYS = 8000, 20_000
LEAST_RATIO, PRIOR_SHARE = 20.0, 0.1
RATE_PRIOR = 20.0
RUN = 5
MOST_SEGMENTS = 8
ALPHA = 0.01
THRESHOLD = 0.5

_TOKEN = np.zeros(256, dtype=bool)
_TOKEN[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True

PASSAGE = "struct<start:long,end:long,score:double,expected:double>"


def tokens(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of every token and the rows' bounds among them."""
    lo, hi = int(offsets[0]), int(offsets[-1])
    if lo == hi:
        empty = np.zeros(0, np.int64)
        return empty, empty, np.zeros(len(offsets), np.int64)
    inside = _TOKEN[raw[lo:hi]]
    first = np.zeros(hi - lo + 1, dtype=bool)
    first[offsets - lo] = True
    before = np.concatenate([[False], inside[:-1]])
    after = np.concatenate([inside[1:], [False]])
    starts = np.flatnonzero(inside & (~before | first[:-1])) + lo
    ends = np.flatnonzero(inside & (~after | first[1:])) + lo + 1
    return starts, ends, np.searchsorted(starts, offsets, side="left")


def keys(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit keys of every token, one row per token: its stems and the whole."""
    out = np.empty((len(starts), len(STEMS) + 1), dtype=np.int64)
    for k, size in enumerate((*STEMS, None)):
        cut = ends if size is None else np.minimum(ends, starts + size)
        out[:, k] = mix64(span_hashes(raw, starts, cut) + np.uint64(k)).view(np.int64)
    return out


class Lookup:
    """Place of a key in a sorted list; a small bitmap turns most others away."""

    def __init__(self, known: np.ndarray):
        self.known = known
        self.map = np.zeros(1 << 18, dtype=bool)
        self.map[known & 0x3FFFF] = True

    def __call__(self, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Flat indices into ``key`` of the known ones, and their places in the list."""
        flat = key.ravel()
        at = np.flatnonzero(self.map[flat & 0x3FFFF])
        place = np.searchsorted(self.known, flat[at])
        place[place == len(self.known)] = 0
        hit = self.known[place] == flat[at] if len(self.known) else np.zeros(0, dtype=bool)
        return at[hit], place[hit]


# --- learning ------------------------------------------------------------------

def _digests(raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each row's whole bytes."""
    return span_hashes(raw, offsets[:-1], offsets[1:], lower=False) if len(raw) else np.zeros(len(offsets) - 1, np.uint64)


def _sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Smallest hash of a row's runs of ``RUN`` tokens, the same for most near copies."""
    for batch in batches:
        raw, offsets = text_buffers(batch.column("text"))
        for lo, hi in row_chunks(offsets):
            part = offsets[lo:hi + 1]
            starts, ends, bounds = tokens(raw, part)
            runs, at = shingle_hashes(span_hashes(raw, starts, ends), bounds - bounds[0], RUN)
            sketch = np.zeros(hi - lo, np.uint64)
            full = np.diff(at) > 0
            if full.any():
                sketch[full] = np.minimum.reduceat(runs, at[:-1][full])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").slice(lo, hi - lo), batch.column("toxic").slice(lo, hi - lo),
                 pa.array(sketch.view(np.int64)), pa.array(_digests(raw, part).view(np.int64))], ["doc_id", "toxic", "sketch", "digest"])


def _with_digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        raw, offsets = text_buffers(batch.column("text"))
        digest = np.concatenate([np.zeros(0, np.uint64), *[_digests(raw, offsets[lo:hi + 1]) for lo, hi in row_chunks(offsets)]])
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(digest.view(np.int64)), batch.column("text")],
                                         ["doc_id", "digest", "text"])


def _sample_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents that hold each key, by class and fold (slot = class * 2 + fold)."""
    for batch in batches:
        raw, offsets = text_buffers(batch.column("text"))
        slot = batch.column("slot").to_numpy()
        for lo, hi in row_chunks(offsets):
            starts, ends, bounds = tokens(raw, offsets[lo:hi + 1])
            key = keys(raw, starts, ends)
            row = np.repeat(np.arange(hi - lo), np.diff(bounds))
            names, code = np.unique(key.ravel(), return_inverse=True)
            if not len(names):
                continue
            once = np.unique(np.repeat(row, key.shape[1]) * len(names) + code)
            table = np.stack([np.bincount((once % len(names))[slot[lo:hi][once // len(names)] == s], minlength=len(names))
                              for s in range(4)])
            yield pa.RecordBatch.from_arrays([pa.array(names), *[pa.array(t) for t in table]], ["key", "n0", "n1", "n2", "n3"])


def _longest_counts(find: Lookup):
    """Documents in which each known key is the longest known one of a token, by slot."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = len(find.known)
        total = np.zeros((4, size), dtype=np.int64)
        for batch in batches:
            raw, offsets = text_buffers(batch.column("text"))
            slot = batch.column("slot").to_numpy()
            for lo, hi in row_chunks(offsets):
                starts, ends, bounds = tokens(raw, offsets[lo:hi + 1])
                key = keys(raw, starts, ends)
                row = np.repeat(np.arange(hi - lo), np.diff(bounds))
                at, place = find(key)
                last = np.full(len(key), -1)
                last[at // key.shape[1]] = place  # flat order: a later column is a longer key
                once = np.unique((row * size + last)[last >= 0])
                total += np.bincount(slot[lo:hi][once // size] * size + once % size, minlength=total.size).reshape(total.shape)
        slot, place = np.nonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(slot), pa.array(place), pa.array(total[slot, place])], ["slot", "place", "n"])
    return run


def _likelihood_ratio(toxic: F.Column, clean: F.Column, n_toxic: int, n_clean: int) -> F.Column:
    """Twice the log-likelihood gained by a rate of its own for each class (0 for equal rates)."""
    def part(n: F.Column, of: int) -> F.Column:
        expected = (toxic + clean) * (of / max(n_toxic + n_clean, 1))
        return F.when(n > 0, n * F.log(n / expected)).otherwise(0.0)
    return 2 * (part(toxic, n_toxic) + part(clean, n_clean))


def _corpus_counts(find: Lookup):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(find.known) + 1, dtype=np.int64)
        for batch in batches:
            raw, offsets = text_buffers(batch.column(0))
            for lo, hi in row_chunks(offsets):
                starts, ends, _ = tokens(raw, offsets[lo:hi + 1])
                total[:-1] += np.bincount(find(keys(raw, starts, ends))[1], minlength=len(find.known))
                total[-1] += len(starts)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total))), pa.array(total)], ["place", "n"])
    return run


def corpus_share(docs: DataFrame, known: np.ndarray) -> np.ndarray:
    """Share of every known key among the tokens of all documents."""
    got = (docs.select("text").mapInArrow(_corpus_counts(Lookup(known)), "place long, n long")
           .groupBy("place").agg(F.sum("n").alias("n")).toArrow())
    total = np.zeros(len(known) + 1)
    total[got.column("place").to_numpy()] = got.column("n").to_numpy()
    return total[:-1] / max(total[-1], 1)


def log_odds(toxic: np.ndarray, clean: np.ndarray, mass: tuple[float, float], docs: tuple[int, int],
             share: np.ndarray) -> tuple[np.ndarray, float]:
    """Score of every known key (0 where it does not tell) and the score of all other tokens.

    ``mass`` is the number of (document, token) pairs of either class, ``docs``
    their documents; the Dirichlet prior weighs ``PRIOR_SHARE`` of the smaller mass.
    """
    prior_mass = PRIOR_SHARE * max(min(mass), 1.0)
    prior = prior_mass * share + 1e-6
    rate = [(count + prior) / (m + prior_mass) for count, m in ((toxic, mass[0]), (clean, mass[1]))]
    expected = [(toxic + clean) * d / max(sum(docs), 1) for d in docs]
    ratio = 2 * sum(np.where(n > 0, n * np.log(np.maximum(n, 1) / np.maximum(e, 1e-12)), 0) for n, e in zip((toxic, clean), expected))
    tells = (ratio >= LEAST_RATIO) & (toxic + clean > 0)
    table = np.where(tells, np.log(rate[0]) - np.log(rate[1]), 0.0)
    # What is left of each class's mass once the telling keys took theirs.
    rest = [max(1 - min(float(r[tells].sum()), 0.9), 0.1) for r in rate]
    return table, min(float(np.log(rest[0] / rest[1])), -0.01)


def token_scores(key: np.ndarray, find: Lookup, odds: tuple[np.ndarray, float]) -> np.ndarray:
    """Score of every token: that of its longest key that tells."""
    found = np.zeros(key.shape)
    at, place = find(key)
    found.ravel()[at] = odds[0][place]
    best = np.full(len(key), odds[1])
    for k in range(key.shape[1]):
        best = np.where(found[:, k] != 0, found[:, k], best)
    return best


# --- segments ------------------------------------------------------------------

def segments(score: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring segments as (first, end, score), left to right, in linear time.

    Only runs of positive scores can start a segment. Each candidate keeps the sum
    before it and the sum up to its end; a new run joins those earlier candidates
    over which the joint segment scores more than both.
    """
    positive = score > 0
    if not positive.any():
        return []
    total = np.concatenate([[0.0], np.cumsum(score)])
    edge = np.diff(np.concatenate([[0], positive.astype(np.int8), [0]]))
    first, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    stack: list[tuple[int, int, float, float, int]] = []
    for a, b in zip(first.tolist(), end.tolist()):
        before, upto = float(total[a]), float(total[b])
        while True:
            # The last candidate that starts from a lower sum; ``back`` skips those known not to.
            j = len(stack) - 1
            while j >= 0 and stack[j][2] >= before:
                j = stack[j][4]
            if j < 0 or stack[j][3] >= upto:
                stack.append((a, b, before, upto, j))
                break
            a, before = stack[j][0], stack[j][2]
            del stack[j:]
    return [(a, b, upto - before) for a, b, before, upto, _ in stack]


def evidence(scores: list[float], n_tokens: int, chance: tuple[float, float]) -> float:
    """-log of the least chance of the best r segments together, over r.

    ``chance`` is (rate a token, scale): chance segments of at least s number
    rate * tokens * exp(-scale * s). The sum of r normalised scores exceeds t
    with a chance of about exp(-t) t^(r-1) / (r! (r-1)!).
    """
    rate, scale = chance
    best, total, fact = 0.0, 0.0, 0.0
    for r, s in enumerate(sorted(scores, reverse=True)[:MOST_SEGMENTS], 1):
        total += scale * s - np.log(max(rate * n_tokens, 1e-12))
        fact += np.log(r) + (np.log(r - 1) if r > 1 else 0.0)
        if total > 0:
            best = max(best, total - (r - 1) * np.log(max(total, 1.0)) + fact - np.log(MOST_SEGMENTS))
    return float(min(best, 700.0))


def _sample_segments(find: Lookup, models: list[tuple[np.ndarray, float]]):
    """Segment scores of the sample's rows, each by the model that did not learn from its fold."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, offsets = text_buffers(batch.column("text"))
            slot = batch.column("slot").to_numpy()
            size, found = [], []
            for lo, hi in row_chunks(offsets):
                starts, ends, bounds = tokens(raw, offsets[lo:hi + 1])
                key = keys(raw, starts, ends)
                for r in range(hi - lo):
                    mine = token_scores(key[bounds[r]:bounds[r + 1]], find, models[slot[lo + r] % 2])
                    size.append(len(mine))
                    found.append([s for _, _, s in segments(mine)])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("slot"), pa.array(size, pa.int64()), pa.array(found, pa.list_(pa.float64()))],
                ["doc_id", "slot", "size", "scores"])
    return run


def fit_chance(sizes: list[int], found: list[list[float]]) -> tuple[float, float]:
    """Rate and scale of chance segments, from the segments of clean rows.

    The scale of log-odds scores is 1 in theory; that counts as ``RATE_PRIOR`` segments.
    """
    n, total = sum(map(len, found)), sum(map(sum, found))
    return (n + 1) / (sum(sizes) + 1), (n + RATE_PRIOR) / (total + RATE_PRIOR)


def fit_curve(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Intercept and slope (not below 0) of a logistic curve, by ridged Newton steps."""
    beta, design = np.zeros(2), np.stack([np.ones(len(x)), x], axis=1)
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        hess = (design * (p * (1 - p))[:, None]).T @ design + 1e-2 * np.eye(2)
        step = np.linalg.solve(hess, design.T @ (y - p) - 1e-2 * beta)
        beta = beta + np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-9:
            break
    return float(beta[0]), float(max(beta[1], 0.0))


def _bend(x):
    """Evidence on the scale of the curve: steep near none, flat far out."""
    return np.log1p(np.asarray(x, dtype=np.float64))


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> dict:
    """Log-odds, chance of segments and curve; see the module text for what is learned from."""
    known = (labels.select("doc_id", F.col("toxic").cast("int").alias("toxic"))
             .filter(~held_out()).filter("doc_id is not null and toxic in (0, 1)")
             .groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
             .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample))
    # At most ``sample`` rows of two numbers: small enough to send everywhere.
    known = stash(known, "toxic-sample")
    texts = docs.select("doc_id", "text").join(F.broadcast(known), "doc_id")
    # Copies and near copies of one text teach once for each class (by the lowest id), and share a fold.
    id_type = docs.schema["doc_id"].dataType.simpleString()
    sketched = texts.mapInArrow(_sketches, f"doc_id {id_type}, toxic int, sketch long, digest long")
    chosen = stash(sketched.groupBy("sketch", "toxic").agg(F.min(F.struct("doc_id", "digest")).alias("one")).select(
        "one.doc_id", "one.digest", (F.col("toxic") * 2 + F.pmod("sketch", F.lit(2))).cast("int").alias("slot")), "toxic-chosen")
    sizes = {r["slot"]: r["n"] for r in chosen.groupBy("slot").agg(F.count(F.lit(1)).alias("n")).collect()}
    toxic, clean = (sizes.get(2 * k, 0) + sizes.get(2 * k + 1, 0) for k in (1, 0))
    if not toxic or not clean:
        return {"constant": toxic / (toxic + clean) if toxic + clean else 0.5}
    rows = stash(texts.mapInArrow(_with_digest, f"doc_id {id_type}, digest long, text string")
                 .join(F.broadcast(chosen), ["doc_id", "digest"])
                 .groupBy("doc_id", "digest").agg(F.min("slot").alias("slot"), F.min("text").alias("text")), "toxic-texts")
    counts = stash(rows.select("text", "slot").mapInArrow(_sample_counts, "key long, n0 long, n1 long, n2 long, n3 long")
                   .groupBy("key").agg(*[F.sum(f"n{k}").alias(f"n{k}") for k in range(4)]), "toxic-counts")
    mass = np.array(counts.agg(*[F.coalesce(F.sum(f"n{k}"), F.lit(0)) for k in range(4)]).first(), dtype=float) / (len(STEMS) + 1)
    size_of = [sizes.get(k, 0) for k in range(4)]
    # Keys that tell by the whole sample or by one of its folds.
    parts = [((2, 3), (0, 1)), ((2,), (0,)), ((3,), (1,))]
    ratios = [_likelihood_ratio(sum(F.col(f"n{k}") for k in t), sum(F.col(f"n{k}") for k in c),
                                sum(size_of[k] for k in t), sum(size_of[k] for k in c)) for t, c in parts]
    telling = (counts.withColumn("ratio", F.greatest(*ratios)).filter(F.col("ratio") >= LEAST_RATIO)
               .orderBy(F.desc("ratio"), "key").limit(KEYS).orderBy("key").toArrow())
    known = telling.column("key").to_numpy()
    find = Lookup(known)
    count = np.zeros((4, len(known)))
    if len(known):
        got = (rows.select("text", "slot").mapInArrow(_longest_counts(find), "slot long, place long, n long")
               .groupBy("slot", "place").agg(F.sum("n").alias("n")).toArrow())
        count[got.column("slot").to_numpy(), got.column("place").to_numpy()] = got.column("n").to_numpy()
    share = corpus_share(docs, known)

    def odds(t: tuple, c: tuple) -> tuple[np.ndarray, float]:
        t, c = list(t), list(c)
        return log_odds(count[t].sum(axis=0), count[c].sum(axis=0), (mass[t].sum(), mass[c].sum()),
                        (sum(size_of[k] for k in t), sum(size_of[k] for k in c)), share)

    # A row of fold f is scored by what the other fold teaches.
    other = [odds(*parts[2]), odds(*parts[1])]
    scored = rows.select("doc_id", "slot", "text").mapInArrow(
        _sample_segments(find, other), f"doc_id {id_type}, slot int, size long, scores array<double>").toArrow()
    y = (scored.column("slot").to_numpy() >= 2).astype(float)
    size, found = scored.column("size").to_pylist(), scored.column("scores").to_pylist()
    calm = [k for k in range(len(y)) if y[k] == 0]
    chance = fit_chance([size[k] for k in calm], [found[k] for k in calm])
    x = np.array([evidence(f, n, chance) for f, n in zip(found, size)])
    order = np.lexsort((y, x))
    return {"find": find, "odds": odds(*parts[0]), "chance": chance, "curve": fit_curve(_bend(x[order]), y[order])}


# --- scoring -------------------------------------------------------------------

def probability(model: dict, x: np.ndarray) -> np.ndarray:
    a, b = model["curve"]
    return 1 / (1 + np.exp(-np.clip(a + b * _bend(x), -30, 30)))


def _score(model: dict, spans: bool):
    find = model.get("find")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, offsets = text_buffers(batch.column("text"))
            x, passages = np.zeros(batch.num_rows), []
            for lo, hi in row_chunks(offsets):
                if "constant" in model:
                    passages += [[]] * (hi - lo)
                    continue
                part = offsets[lo:hi + 1]
                starts, ends, bounds = tokens(raw, part)
                score = token_scores(keys(raw, starts, ends), find, model["odds"])
                # Code points before each byte, for spans in characters.
                chars = np.concatenate([[0], np.cumsum((raw[part[0]:part[-1]] & 0xC0) != 0x80)]) if spans else None
                hits = np.unique(np.searchsorted(bounds, np.flatnonzero(score > 0), side="right") - 1)
                mine_of = [[] for _ in range(hi - lo)]
                for r in hits.tolist():
                    a, b = int(bounds[r]), int(bounds[r + 1])
                    found = segments(score[a:b])
                    x[lo + r] = evidence([s for _, _, s in found], b - a, model["chance"])
                    if spans:
                        rate, scale = model["chance"]
                        base = chars[part[r] - part[0]]
                        for i, j, s in found:
                            expected = rate * (b - a) * float(np.exp(-scale * s))
                            if expected <= ALPHA:
                                mine_of[r].append((int(chars[starts[a + i] - part[0]] - base),
                                                   int(chars[ends[a + j - 1] - part[0]] - base), s, expected))
                passages += mine_of
            value = np.full(batch.num_rows, model["constant"]) if "constant" in model else probability(model, x)
            out = [pa.array(value)]
            if spans:
                kind = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64()), ("expected", pa.float64())])
                out.append(pa.array([[dict(zip(("start", "end", "score", "expected"), p)) for p in m] for m in passages], pa.list_(kind)))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("text"), *out],
                                             ["doc_id", "text", "score", *(["passages"] if spans else [])])
    return run


def score(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, spans: bool = True) -> DataFrame:
    """``doc_id``, ``text``, ``score`` and, with ``spans``, the significant ``passages`` of every document.

    A passage is (start, end, score, expected): code points of the text, the
    segment's score and how many such segments chance makes in a text of this length.
    """
    model = fit(docs, labels, sample)
    cols = docs.select("doc_id", "text")
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in cols.schema)
    extra = f", passages array<{PASSAGE}>" if spans else ""
    return cols.mapInArrow(_score(model, spans), f"{fields}, score double{extra}")


def passages(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """One row per significant passage: ``doc_id, start, end, score, expected, passage``."""
    found = score(docs, labels, sample).select("doc_id", "text", F.explode("passages").alias("p"))
    return found.select("doc_id", "p.start", "p.end", "p.score", "p.expected",
                        F.expr("substring(text, cast(p.start + 1 as int), cast(p.end - p.start as int))").alias("passage"))


def classify(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id, held_out, score, predicted, n_passages`` of every document."""
    out = score(docs, labels)
    return out.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"),
                      F.size("passages").cast("long").alias("n_passages"))
