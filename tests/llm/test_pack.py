import zlib

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from keelson.llm import pack
from keelson.llm.common import read
from tests.conftest import SF_SMALL
from tests.llm.helpers import awkward_docs

PATH = public_tokenizers.path("byte_bpe_50k.json")
WHOLE = Tokenizer.from_file(PATH)
WHOLE.encode_special_tokens = True
ENCODER = pack.Encoder(PATH)


def ids(text):
    return WHOLE.encode(text or "", add_special_tokens=False).ids + [0]


def expected(docs, length):
    out = []
    for r in docs:
        tokens = ids(r.text)
        start, end, k = 0, len(tokens) % length or length, 0
        while start < len(tokens):
            out.append((r.doc_id, k, start, end - start, zlib.crc32(np.array(tokens[start:end], "<u4").tobytes())))
            start, end, k = end, end + length, k + 1
    return out


def check(rows, docs, length):
    key = lambda t: tuple((x is None, x) for x in t)
    assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows), key=key) == sorted(expected(docs, length), key=key)
    at = {}
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == at.get(r.sequence_id, 0)
        at[r.sequence_id] = r.offset + r.length
    assert not at or max(at.values()) <= length
    return len(at), -(-sum(at.values()) // length)


def test_awkward_rows(spark):
    docs = awkward_docs(spark)
    used, bound = check(pack.pack(docs, PATH).collect(), docs.collect(), 2048)
    assert used <= bound + 1


def test_documents_fill_their_sequences(spark):
    docs = read(spark, SF_SMALL, "documents")
    used, bound = check(pack.pack(docs, PATH).collect(), docs.select("doc_id", "text").collect(), 2048)
    assert used <= 1.01 * bound + 1


def test_levels_reopen_poorly_filled_bins(spark, monkeypatch):
    docs = read(spark, SF_SMALL, "documents")
    monkeypatch.setattr(pack, "SHARD_PIECES", 40)
    used, bound = check(pack.pack(docs, PATH).collect(), docs.select("doc_id", "text").collect(), 2048)
    assert used <= 1.03 * bound + 1


def test_empty_table(spark):
    assert pack.pack(awkward_docs(spark).limit(0), PATH).collect() == []


def test_reopened_pieces_are_at_most_half_and_the_worst_filled():
    rng = np.random.default_rng(7)
    for _ in range(50):
        bins = np.unique(rng.integers(0, 40, 200), return_inverse=True)[1]
        fill = rng.integers(1, 1001, bins.max() + 1).astype(float)
        again = pack._reopened(bins, fill, 1000)
        assert again.sum() <= 100
        reopened, left = fill[np.unique(bins[again])], fill[np.unique(bins[~again])]
        assert not len(reopened) or (reopened.max() <= left.min() and reopened.max() < 995)


def test_pieces_that_cannot_share_bins_end(spark, monkeypatch):
    monkeypatch.setattr(pack, "SHARD_PIECES", 10)
    words = spark.range(90).selectExpr("id as doc_id", "repeat('word ', 1200) as text")
    used, _ = check(pack.pack(words, PATH).collect(), words.collect(), 2048)
    assert used == 90


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from(" \n\t\r  aB'sé漢١²\U0001F600<|endoftext|>.,-"), st.characters(codec="utf-8")), max_size=60))
def test_words_are_encoded_like_whole_texts(text):
    assert ENCODER.encode(text) == np.array(WHOLE.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


def test_crossover_keeps_every_item_once():
    rng = np.random.default_rng(1)
    sizes = rng.integers(1, 900, 400)
    a, b = (pack.construct(sizes, 1000, n, rng) for n in (0.0, 0.3))
    child = pack.crossover(sizes, a, b, 1000, rng)
    assert len(child) == 400 and np.bincount(child, weights=sizes).max() <= 1000
    best = pack.evolve(sizes, [a, b], 1000, 5, rng)
    assert pack.fitness(sizes, best, 1000) >= max(pack.fitness(sizes, x, 1000) for x in (a, b))
