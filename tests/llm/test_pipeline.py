import os

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from keelson.llm import queries
from keelson.llm.common import read, stash
from tests.conftest import SF_ORACLE, SF_SMALL
from tests.llm.helpers import awkward_docs, near_components


def test_every_stage_on_its_own_input(spark):
    docs = read(spark, SF_SMALL, "documents")
    columns, kept = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stash(stage(spark, docs, SF_SMALL), f"test-{name}")
        assert out.columns == columns
        kept[name], docs = (docs.collect(), out.collect()), out
    labels = {r.doc_id: r.quality for r in read(spark, SF_SMALL, "labels").collect()}
    stayed = {r.doc_id for r in kept["quality"][1]}
    clean = [r.doc_id for r in kept["quality"][0] if labels.get(r.doc_id) == 1]
    assert sum(i in stayed for i in clean) >= 0.97 * len(clean)
    assert len(kept["language"][1]) >= 0.99 * len(kept["language"][0])
    before, after = kept["dedup"]
    want = near_components({r.doc_id: r.text for r in before}, n=5)
    assert sorted(r.doc_id for r in after) == sorted({want[r.doc_id] for r in before})
    before, after = kept["mix"]
    assert {r.doc_id for r in after} <= {r.doc_id for r in before}
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF_SMALL).collect()
    assert sorted(r.doc_id for r in packed if r.piece == 0) == sorted(r.doc_id for r in after)


def test_stages_take_awkward_and_empty_tables(spark):
    for docs in (awkward_docs(spark), awkward_docs(spark).limit(0)):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, SF_SMALL)
            out.count()
            assert name == "pack" or out.columns == docs.columns


def test_extra_columns_of_any_name_are_carried(spark):
    docs = read(spark, SF_SMALL, "documents").limit(60)
    names = ["__size", "__total", "__key", "__row", "__score", "__lang", "__letters", "__text", "__id", "__hash", "row", "a.b", "quality", "kept"]
    more = docs.select("*", *[F.concat(F.lit("mine "), F.col("doc_id")).alias(n) for n in names])
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, more, SF_SMALL)
        assert out.columns == more.columns
        rows = out.collect()
        assert rows and all(r[n] == f"mine {r.doc_id}" for r in rows for n in names), name
        plain = sorted(r.doc_id for r in stage(spark, docs, SF_SMALL).collect())
        assert sorted(r.doc_id for r in rows) == plain, name
    assert corpus_pipeline.STAGES[-1][1](spark, more, SF_SMALL).count() > 0


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_sql_twin(spark, name):
    con = duckdb.connect()
    for t in ("pages", "embeddings", "documents"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{os.path.join(SF_ORACLE, t)}.parquet'")
    want = con.execute(queries.ORACLE[name]).df()
    got = queries.QUERIES[name](spark, SF_ORACLE).toPandas()
    assert sorted(got.columns) == sorted(want.columns)
    rows = lambda df: sorted(map(tuple, df[sorted(want.columns)].astype(str).values.tolist()))
    assert rows(got) == rows(want)
