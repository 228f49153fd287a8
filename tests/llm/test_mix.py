from collections import defaultdict

import pytest

from keelson.llm import mix_sources
from keelson.llm.common import read
from tests.conftest import SF_SMALL
from tests.llm.helpers import WORD, awkward_docs


def targets_by_hand(sizes, weights=(3, 1, 2), share=1.5, most=2.0):
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    target, free = {}, dict(sizes)
    budget = share * sum(sizes.values())
    while free:
        left = budget - sum(target.values())
        total = sum(weight[s] for s in free)
        over = [s for s in free if left * weight[s] / total > most * sizes[s]]
        if not over:
            target |= {s: left * weight[s] / total for s in free}
            break
        for s in over:
            target[s] = most * free.pop(s)
    return target


def check(rows, docs, slack=None):
    sizes, taken, by = defaultdict(int), defaultdict(int), {}
    assert sorted((r.doc_id, r.size) for r in rows if r.doc_id is not None) == sorted(
        (d.doc_id, len(WORD.findall(d.text or ""))) for d in docs if d.doc_id is not None)
    for r in rows:
        sizes[r.source] += r.size
        taken[r.source] += r.taken
        by[r.source] = r
        assert 0 <= r.taken <= 2 * r.size and (r.size == 0 or r.taken % r.size == 0)
    want = targets_by_hand(dict(sizes))
    for s, r in by.items():
        assert r.source_size == sizes[s]
        assert r.target == pytest.approx(want[s])
        largest = max(x.size for x in rows if x.source == s)
        assert abs(taken[s] - r.target) <= (largest if slack is None else max(1, slack * r.target))
        if r.target >= sizes[s]:
            assert all(x.taken >= x.size for x in rows if x.source == s)


def test_awkward_rows(spark):
    docs = awkward_docs(spark)
    check(mix_sources.mix(docs).collect(), docs.collect())


def test_real_documents_near_target_and_stable(spark):
    docs = read(spark, SF_SMALL, "documents")
    rows = mix_sources.mix(docs).collect()
    check(rows, docs.collect())
    again = mix_sources.mix(docs.repartition(7)).collect()
    assert sorted((r.doc_id, r.taken) for r in rows) == sorted((r.doc_id, r.taken) for r in again)


def test_one_hot_id_is_split(spark):
    docs = spark.createDataFrame([(7, "a", "x y z")] * 300 + [(8, "b", "p q")] * 100, "doc_id long, source string, text string")
    rows = mix_sources.mix(docs).collect()
    check(rows, docs.collect(), slack=0.01)


def test_documents_appear_as_often_as_taken(spark):
    docs = awkward_docs(spark)
    out = mix_sources.mix_documents(docs)
    assert out.columns == docs.columns
    want = defaultdict(int)
    for r in mix_sources.mix(docs).collect():
        want[r.doc_id, r.source, r.size] += r.copies
    got = defaultdict(int)
    for r in out.collect():
        got[r.doc_id, r.source, len(WORD.findall(r.text or ""))] += 1
    assert got == {k: n for k, n in want.items() if n}


def test_empty_table_and_bad_cap(spark):
    empty = awkward_docs(spark).limit(0)
    assert mix_sources.mix(empty).count() == 0
    assert mix_sources.mix_documents(empty).count() == 0
    with pytest.raises(ValueError):
        mix_sources.mix(empty, most=3)


@pytest.mark.parametrize("share", [0.1, 0.5, 0.95, 1.5])
def test_no_row_left_out_brings_a_source_nearer(spark, share):
    """Skewed sources: many short rows beside a long one, one document alone, rows in powers of two."""
    docs = [(i, s, "w " * n) for s, sizes in {"a": [1] * 100 + [200], "b": [100], "c": [2 ** k for k in range(9)], "d": [200] + [1] * 100,
                                              "e": [7] * 40 + [500, 900], None: [3]}.items() for i, n in enumerate(sizes)]
    rows = mix_sources.mix(spark.createDataFrame(docs, "doc_id long, source string, text string"), weights=(1,), share=share).collect()
    for s in {r.source for r in rows}:
        of = [r for r in rows if r.source == s]
        assert all(r.copies in (0, 1, 2) for r in of)
        base, gap = int(of[0].target >= of[0].source_size), of[0].target - sum(r.taken for r in of)
        assert all(abs(gap - r.size) >= abs(gap) for r in of if r.copies == base), (s, gap)
        if base:
            assert all(r.copies >= 1 for r in of)
