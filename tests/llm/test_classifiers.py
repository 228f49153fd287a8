import zlib

import numpy as np
import pytest

from keelson.llm import language, quality
from keelson.llm.common import read
from tests.conftest import SF_ORACLE
from tests.llm.helpers import awkward_docs


def held(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 5 == 0


def test_quality_on_held_out_rows(spark):
    labels = {r.doc_id: r.quality for r in read(spark, SF_ORACLE, "labels").collect()}
    rows = quality.classify(read(spark, SF_ORACLE, "documents"), read(spark, SF_ORACLE, "labels")).collect()
    assert len(rows) == 1000
    assert all(r.held_out == held(r.doc_id) and r.predicted == int(r.score >= 0.3) and 0 <= r.score <= 1 for r in rows)
    test = [r for r in rows if r.held_out and r.doc_id in labels]
    assert np.mean([r.predicted == labels[r.doc_id] for r in test]) >= 0.95
    assert np.mean([r.predicted for r in test if labels[r.doc_id] == 1]) >= 0.98


def test_quality_ignores_held_out_labels_and_partitions(spark):
    docs, labels = (read(spark, SF_ORACLE, t) for t in ("documents", "labels"))
    from pyspark.sql import functions as F
    flipped = labels.withColumn("quality", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, 1 - F.col("quality"))
                                .otherwise(F.col("quality")))
    a = {r.doc_id: r.score for r in quality.classify(docs, labels).collect()}
    b = {r.doc_id: r.score for r in quality.classify(docs.repartition(5), flipped).collect()}
    assert a == pytest.approx(b, abs=1e-6)


def test_quality_awkward_rows(spark):
    docs = awkward_docs(spark)
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(12)] * 2 + [(None, 1, 0), (3, None, 0)], "doc_id long, quality int, toxic int")
    rows = quality.classify(docs, labels).collect()
    assert len(rows) == docs.count() and all(0 <= r.score <= 1 for r in rows)
    none = quality.classify(docs, labels.limit(0)).collect()
    assert {r.score for r in none} == {0.5}
    assert quality.classify(docs.limit(0), labels).collect() == []


def test_languages_on_held_out_rows(spark):
    docs = read(spark, SF_ORACLE, "documents")
    truth = {r.doc_id: r.lang for r in docs.select("doc_id", "lang").collect()}
    rows = language.identify(docs).collect()
    assert len(rows) == 1000 and all(r.held_out == held(r.doc_id) and 0 <= r.score <= 1 for r in rows)
    test = [r for r in rows if r.held_out]
    assert np.mean([r.lang_pred == truth[r.doc_id] for r in test]) >= 0.98


def test_language_awkward_rows(spark):
    docs = awkward_docs(spark)
    rows = language.identify(docs).collect()
    assert len(rows) == docs.count()
    learned = {r.lang for r in docs.collect() if r.lang}
    for r in rows:
        assert r.lang_pred in learned | {"und"} and 0 <= r.score <= 1
    assert {r.lang_pred for r in rows if r.doc_id in (1, 2, 3, 12)} == {"und"}
    assert {r.lang_pred for r in language.identify(docs.withColumn("lang", docs.kept.substr(5, 1))).collect()} == {"und"}
    assert language.identify(docs.limit(0)).collect() == []


def test_svm_separates_and_families_nest():
    rng = np.random.default_rng(0)
    x = np.vstack([rng.normal(1, 0.3, (50, 5)), rng.normal(-1, 0.3, (5, 5))])
    y = np.array([1.0] * 50 + [-1.0] * 5)
    w, b = language.svm(x, y)
    assert (np.sign(x @ w + b) == y).all()
    model = language.fit_machines(rng.random((40, language.BUCKETS)), np.array(["en", "de", "fr", "xx"] * 10, dtype=object))
    pairs = {m for m in model["pairs"]}
    assert ("lang", "de", "en") in pairs and not any(m[0] == "lang" and "fr" in m for m in pairs)


def test_temperature_and_constant_network():
    assert quality.fit_network(np.zeros((0, 3)), np.zeros(0)) == {"constant": 0.5}
    assert quality.fit_network(np.ones((4, 3)), np.ones(4)) == {"constant": 1.0}
    rng = np.random.default_rng(0)
    x = rng.normal(size=(400, 6))
    y = (x[:, 0] + 0.3 * rng.normal(size=400) > 0).astype(float)
    net = quality.fit_network(x, y)
    p = quality.predict(net, x)
    assert np.mean((p > 0.5) == y) > 0.9 and 0.25 <= net["temperature"] <= 8
