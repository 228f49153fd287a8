import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from keelson.llm import toxicity
from keelson.llm.common import read, text_buffers
from tests.conftest import SF_ORACLE
from tests.llm.helpers import awkward_docs
from tests.llm.test_classifiers import held


def brute_segments(score):
    """The best segment (shortest, then leftmost), then the same on both of its sides."""
    def best(lo, hi):
        found = None
        for a in range(lo, hi):
            total = 0
            for b in range(a, hi):
                total += score[b]
                if total > 0 and (found is None or (total, -(b + 1 - a)) > (found[2], -(found[1] - found[0]))):
                    found = (a, b + 1, total)
        if found is None:
            return []
        return best(lo, found[0]) + [found] + best(found[1], hi)
    return best(0, len(score))


def test_segments_are_all_maximal_ones():
    rng = random.Random(5)
    for n in range(1, 40):
        for _ in range(12):
            # Distinct powers of two over one scale keep sums without ties.
            score = [rng.choice([-1, -1, 1]) * (rng.random() + 0.1) for _ in range(n)]
            got = toxicity.segments(np.array(score))
            assert [g[:2] for g in got] == [w[:2] for w in brute_segments(score)]
            assert [g[2] for g in got] == pytest.approx([w[2] for w in brute_segments(score)])
    assert toxicity.segments(np.zeros(0)) == [] and toxicity.segments(np.array([-1.0, 0.0])) == []


def test_lookup_and_keys():
    raw, offsets = text_buffers(pa.array(["Idiot, idiots;", None, "a é漢 x1"]))
    starts, ends, bounds = toxicity.tokens(raw, offsets)
    assert bounds.tolist() == [0, 2, 2, 5]
    key = toxicity.keys(raw, starts, ends)
    assert (key[0, :2] == key[1, :2]).all() and key[0, 2] != key[1, 2]
    find = toxicity.Lookup(np.sort(key[0]))
    at, place = find(key)
    assert sorted(at.tolist()) == [0, 1, 2, 3, 4] and (find.known[place] == key.ravel()[at]).all()
    assert len(toxicity.Lookup(np.zeros(0, np.int64))(key)[0]) == 0


def test_chance_and_curve():
    assert toxicity.fit_chance([], []) == (1.0, 1.0)
    rate, scale = toxicity.fit_chance([1000] * 10, [[0.5]] * 10)
    assert 0 < rate < 0.01 and scale > 1
    few, many = toxicity.evidence([6.0], 100, (1e-4, 1.0)), toxicity.evidence([6.0] * 3, 100, (1e-4, 1.0))
    assert 0 < few < many and toxicity.evidence([], 100, (1e-4, 1.0)) == 0
    a, b = toxicity.fit_curve(np.array([0.0] * 50 + [3.0] * 50), np.array([0.0] * 50 + [1.0] * 50))
    assert b > 0 and a < 0


def test_toxicity_on_held_out_rows(spark):
    docs, labels = read(spark, SF_ORACLE, "documents"), read(spark, SF_ORACLE, "labels")
    truth = {r.doc_id: r.toxic for r in labels.collect()}
    rows = toxicity.classify(docs, labels).collect()
    assert len(rows) == 1000
    assert all(r.held_out == held(r.doc_id) and r.predicted == int(r.score >= 0.5) and 0 <= r.score <= 1 for r in rows)
    test = [r for r in rows if r.held_out and r.doc_id in truth]
    assert np.mean([r.predicted == truth[r.doc_id] for r in test]) >= 0.95
    assert np.mean([r.predicted for r in test if truth[r.doc_id] == 0]) <= 0.01


def test_toxicity_ignores_held_out_labels_and_partitions(spark):
    docs, labels = read(spark, SF_ORACLE, "documents"), read(spark, SF_ORACLE, "labels")
    flip = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    flipped = labels.withColumn("toxic", F.when(flip, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a = {r.doc_id: r.score for r in toxicity.classify(docs, labels).collect()}
    b = {r.doc_id: r.score for r in toxicity.classify(docs.repartition(5), flipped).collect()}
    assert a == pytest.approx(b, abs=1e-6)


def test_passages_are_the_toxic_words(spark):
    rng = random.Random(3)
    calm = lambda n: " ".join(f"é{rng.choice('abcdefgh')}{rng.randrange(60)}" for _ in range(n))
    clean = [(k, calm(40), 0) for k in range(300)]
    toxic = [(1000 + k, calm(20) + " vile vilest vileness " + calm(20), 1) for k in range(120)]
    docs = spark.createDataFrame([(i, t) for i, t, _ in clean + toxic], "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1, x) for i, _, x in clean + toxic], "doc_id long, quality int, toxic int")
    rows = toxicity.passages(docs, labels).collect()
    assert {r.doc_id for r in rows} == {i for i, _, _ in toxic}
    assert {r.passage for r in rows if held(r.doc_id)} == {"vile vilest vileness"}
    texts = {i: t for i, t, _ in toxic}
    assert all(texts[r.doc_id][r.start:r.end] == r.passage and r.expected <= toxicity.ALPHA for r in rows)


def test_toxicity_awkward_rows(spark):
    docs = awkward_docs(spark)
    labels = spark.createDataFrame([(i, 0, i % 2) for i in range(12)] * 2 + [(None, 1, 0), (3, 1, None)], "doc_id long, quality int, toxic int")
    rows = toxicity.classify(docs, labels).collect()
    assert len(rows) == docs.count() and all(0 <= r.score <= 1 for r in rows)
    assert len({r.score for r in rows if r.doc_id in (1, 2, 3)}) == 1
    assert {r.score for r in toxicity.classify(docs, labels.limit(0)).collect()} == {0.5}
    assert {r.score for r in toxicity.classify(docs, labels.withColumn("toxic", F.lit(1))).collect()} == {1.0}
    assert toxicity.classify(docs.limit(0), labels).collect() == []
    clashing = docs.withColumn("passages", F.lit(1)).withColumn("__score", F.lit(2)).withColumn("slot", F.lit(3)).withColumn("toxic", F.lit(9))
    assert sorted(r.score for r in toxicity.classify(clashing, labels.withColumn("text", F.lit("x"))).collect()) == sorted(r.score for r in rows)
