import numpy as np
import pyarrow as pa

from keelson.llm import minhash_dedup
from keelson.llm.common import read, shingle_hashes
from tests.conftest import SF_SMALL
from tests.llm.helpers import awkward_docs, near_components, sentence, shingle_set


def run(docs):
    return minhash_dedup.near_duplicates(docs, shingle=4).collect()


def test_against_brute_force(spark):
    docs = read(spark, SF_SMALL, "documents")
    texts = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
    want = near_components(texts)
    rows = run(docs)
    assert len(rows) == len(texts)
    for r in rows:
        assert (r.n_shingles, r.component_id) == (len(shingle_set(texts[r.doc_id])), want[r.doc_id])
        assert r.kept == (r.doc_id == r.component_id)


def test_awkward_rows(spark):
    docs = awkward_docs(spark)
    texts = {r.doc_id: r.text for r in docs.collect() if r.doc_id is not None}
    want = near_components(texts)
    rows = run(docs)
    assert len(rows) == docs.count()
    named = [r for r in rows if r.doc_id is not None]
    assert all(r.component_id == want[r.doc_id] and r.n_shingles == len(shingle_set(texts[r.doc_id])) for r in named)
    assert want[8] == 7 and want[10] == 9 and want[5] == 4 and want[16] == 16
    assert all(r.kept for r in rows if r.doc_id is None)


def test_chain_of_near_copies_is_one_component_without_all_pairs(spark):
    base = sentence(11, 120).split()
    texts = {}
    for k in range(150):
        words = list(base)
        for j in range(k % 30):
            words[(4 * j + 3) % 120] = f"edit{k}y{j}" if j > 8 else f"edit{j}"
        texts[k] = " ".join(words)
    want = near_components(texts)
    rows = run(spark.createDataFrame(list(texts.items()), "doc_id long, text string"))
    assert {r.doc_id: r.component_id for r in rows} == want


def test_one_document_of_each_group_stays(spark):
    docs = awkward_docs(spark)
    out = minhash_dedup.drop_duplicates(docs)
    assert out.columns == docs.columns
    ids = [r.doc_id for r in out.collect()]
    assert sorted(i for i in ids if i is not None) == [0, 1, 2, 3, 4, 7, 9, 11, 12, 13, 14, 16]
    assert ids.count(None) == 2


def test_empty_table(spark):
    assert run(awkward_docs(spark).limit(0)) == []


def test_intersections_match_sets():
    rng = np.random.default_rng(0)
    left = [np.unique(rng.integers(0, 9000, n)) for n in (0, 5, 6000, 40)]
    right = [np.unique(rng.integers(0, 9000, n)) for n in (3, 5000, 0)]
    got = minhash_dedup.intersections(pa.array(left, pa.list_(pa.int64())), pa.array(right, pa.list_(pa.int64())))
    assert got.tolist() == [[len(np.intersect1d(a, b)) for b in right] for a in left]


def test_chunks_of_few_words():
    for n in (4, 5):
        for total in range(1, n + 2):
            words = np.arange(1, total + 1, dtype=np.uint64)
            one, bounds = shingle_hashes(words, np.array([0, total]), n)
            assert bounds.tolist() == [0, max(1, total - n + 1)] and len(set(one.tolist())) == len(one)
            # The same row in a chunk with others gives the same hashes.
            more, at = shingle_hashes(np.concatenate([words, np.arange(50, 60, dtype=np.uint64)]), np.array([0, total, total + 10]), n)
            assert more[:at[1]].tolist() == one.tolist()


def test_short_documents_alone_in_their_table(spark):
    for text in ("one two", "one", "one two three"):
        assert [(r.n_shingles, r.kept) for r in run(spark.createDataFrame([(1, text)], "doc_id long, text string"))] == [(1, True)]


def test_sets_are_named_by_full_hashes(spark):
    # Two texts without a common word whose shingles agree in 40 bits of their hashes.
    texts = ["q1681327 r11769289 s11 t560442", "q2604151 r18229057 s4 t868050"]
    rows = run(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    assert [(r.n_shingles, r.kept) for r in rows] == [(1, True), (1, True)]
    # Equal small sets of other texts are two classes that link.
    again = ["a b c d a b c d a", "b c d a b c d a b", "A b c d a b c d a"]
    rows = run(spark.createDataFrame(list(enumerate(again)), "doc_id long, text string"))
    assert {r.component_id for r in rows} == {0}


def test_order_and_distinct_shingles():
    rng = np.random.default_rng(4)
    row = np.repeat(np.arange(5), 40)
    for hashes in (rng.integers(0, 2**63, 200).astype(np.uint64), rng.integers(0, 9, 200).astype(np.uint64)):
        order = minhash_dedup._order(row, hashes, 5)
        pairs = list(zip(row[order].tolist(), hashes[order].tolist()))
        seen = set()
        for before, pair in zip([None, *pairs], pairs):
            assert pair == before or pair not in seen     # equal pairs lie together
            seen.add(pair)
        assert row[order].tolist() == sorted(row.tolist())
