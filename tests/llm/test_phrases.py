import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from keelson.llm import phrases
from keelson.llm.common import text_buffers
from tests.llm.helpers import UPPER, awkward_docs


def brute(rows, least, top, cover=100):
    """Every contiguous run of one to five words of every piece, counted one by one."""
    f, n = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(UPPER)):
            w = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(w)
            f.update((lang, *w[i:i + k]) for k in range(1, 6) for i in range(len(w) - k + 1))
    cand = {p: a for p, a in f.items() if a >= least and len(p) > 2}
    out = {}
    for p, a in cand.items():
        lang, w = p[0], p[1:]
        inside = any(q[0] == lang and len(q) > len(p) and 100 * b >= cover * a
                     and any(q[i:i + len(w)] == w for i in range(1, len(q) - len(w) + 1)) for q, b in cand.items())
        if inside:
            continue
        score, k = min((1000 * a * n[lang] // (f[(lang, *w[:k])] * f[(lang, *w[k:])]), k) for k in range(1, len(w)))
        out.setdefault(lang, []).append((-score, -a, " ".join(w).encode(), f[(lang, *w[:k])], f[(lang, *w[k:])]))
    return sorted((lang, i + 1, p.decode(), -a, l, r, n[lang], -s)
                  for lang, found in out.items() for i, (s, a, p, l, r) in enumerate(sorted(found)[:top]))


def mine(docs, **kw):
    return sorted(tuple(r) for r in phrases.collocations(docs, **kw).select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


def random_rows(n, seed):
    rng = np.random.default_rng(seed)
    vocab = ["a", "B", "c", "é", "漢", "dd", "x-y", "the", "of", " ", "z'"]
    marks = [" ", " ", " ", "\t", " ", ". ", "\n", ",", "!", "\x0b"]
    return [("".join(vocab[rng.zipf(1.5) % len(vocab)] + marks[rng.integers(len(marks))] for _ in range(rng.integers(0, 60))),
             [None, "en", "und", "fr"][rng.integers(4)]) for _ in range(n)]


@pytest.mark.parametrize("least,top,cover", [(3, 2000, 100), (5, 10, 100), (4, 2000, 60)])
def test_phrases_equal_brute_force(spark, least, top, cover, monkeypatch):
    rows = random_rows(120, least) + [("of the a B c dd of the a B c dd", "en")] * 9
    docs = spark.createDataFrame(rows, "text string, lang string").repartition(3)
    monkeypatch.setattr(phrases, "RANGE_ROWS", 40)
    want = brute(rows, least, top, cover)
    assert mine(docs, least=least, top=top, cover=cover) == want and len(want) > 20


def test_phrases_with_tiny_bitmaps(spark, monkeypatch):
    # Bitmaps that let nearly everything through cost work, never a count.
    rows = random_rows(60, 9)
    monkeypatch.setattr(phrases, "WORD_BITS", 6)
    monkeypatch.setattr(phrases, "PAIR_BITS", 6)
    monkeypatch.setattr(phrases, "RANGE_ROWS", 25)
    assert mine(spark.createDataFrame(rows, "text string, lang string"), least=3) == brute(rows, 3, 2000)


def test_phrases_awkward_rows(spark):
    docs = awkward_docs(spark)
    long = " ".join(["p q r s"] * 30_000)
    docs = docs.unionByName(docs.limit(1).withColumn("text", F.lit(long))).withColumn("words", F.lit(1)).withColumn("key", F.lit("k"))
    rows = [(r.text, r.lang) for r in docs.collect()]
    assert mine(docs, least=3) == brute(rows, 3, 2000)
    assert mine(docs.limit(0)) == [] and mine(docs.withColumn("text", F.lit(None).cast("string"))) == []


def test_quicksort_counts_every_frequent_prefix():
    rng = np.random.default_rng(1)
    for case in range(30):
        table = rng.integers(-2, 3, (rng.integers(1, 200), phrases.DEPTH)).astype(np.int64)
        for k in range(1, phrases.DEPTH):
            table[table[:, k - 1] == 0, k] = 0
        table[table[:, 0] == 0, 0] = 7
        weight = rng.integers(1, 5, len(table))
        want = Counter()
        for row, n in zip(table.tolist(), weight.tolist()):
            for d in range(2, phrases.DEPTH + 1):
                if 0 not in row[:d]:
                    want[tuple(row[:d])] += n
        got = {tuple(table[r, :d].tolist()): n for r, d, n in phrases.quicksort_counts(table, weight, 6)}
        assert got == {p: n for p, n in want.items() if n >= 6}
        ends = {tuple(table[r, :d].tolist()): n for r, d, n in phrases.quicksort_counts(table, weight, 6, keep_ends=True)}
        lowest, highest = min(table.tolist()), max(table.tolist())
        edge = {p: n for p, n in want.items() if list(p) in (lowest[:len(p)], highest[:len(p)])}
        assert ends == got | edge


def test_words_cut_at_pieces_and_rows():
    raw, offsets = text_buffers(pa.array(["a b.c", None, "", "d\te  f", "..g"]))
    starts, ends, piece, row = phrases.words(raw, offsets)
    assert [bytes(raw[a:b]).decode() for a, b in zip(starts, ends)] == ["a", "b", "c", "d", "e", "f", "g"]
    assert row.tolist() == [0, 0, 0, 3, 3, 3, 4]
    assert piece[0] == piece[1] and len(set(piece[1:4].tolist())) == 3 and piece[3] == piece[5] != piece[6]


def test_join_equal_sums_weights():
    table = np.array([[1, 2], [1, 2], [2, 1], [1, 0]], dtype=np.int64)
    rows, n = phrases.join_equal(table, np.array([1, 2, 3, 4]))
    assert sorted(zip(map(tuple, rows.tolist()), n.tolist())) == [((1, 0), 4), ((1, 2), 3), ((2, 1), 3)]


def test_clashing_keys_are_found(spark, monkeypatch):
    raw, offsets = text_buffers(pa.array(["ab cd ab AB abc"]))
    starts, ends, _, _ = phrases.words(raw, offsets)
    assert phrases._other_words(raw, starts, ends, np.array([0, 0, 0, 0, 0])).tolist() == [4, 1]
    assert len(phrases._other_words(raw, starts, ends, np.array([0, 1, 0, 0, 4]))) == 0


def test_suffixes_are_joined_over_all_blocks_of_a_task(monkeypatch):
    class Every:
        value = np.full(1 << 5, 0xFFFFFFFF, dtype=np.uint32)

    batch = pa.RecordBatch.from_arrays([pa.array(["a b c d"] * 40), pa.array(["en"] * 40), pa.array([1] * 40)], ["text", "lang", "lang_hash"])
    monkeypatch.setattr(phrases, "BLOCK_BYTES", 20)
    made = [r for out in phrases._suffixes(0, Every)([batch, batch]) for r in out.to_pylist()]
    assert sorted(r["n"] for r in made) == [80, 80, 80]
    # A task that holds too many hands them on and starts anew; none is lost.
    monkeypatch.setattr(phrases, "HELD_ROWS", 1)
    made = [r for out in phrases._suffixes(0, Every)([batch, batch]) for r in out.to_pylist()]
    assert len(made) > 3 and sum(r["n"] for r in made) == 240


def _made(docs, monkeypatch, least=100):
    """Rows of the suffix table, and the phrases, of one run."""
    made, real = {}, phrases.stash

    def keep(df, label):
        made[label] = real(df, label)
        return made[label]

    monkeypatch.setattr(phrases, "stash", keep)
    found = mine(docs, least=least)
    return made["phrase-suffixes"].agg(F.count(F.lit(1)), F.sum("n"), F.min("w3")).first(), found


def test_suffixes_without_a_frequent_three_are_not_emitted(spark, monkeypatch):
    # All pairs of a to l are frequent; of their threes only "x y z" is.
    vocab = "abcdefghijkl"
    rows = [(f"{a} {b}. {b} {a}", "en") for a in vocab for b in vocab] * 3
    rows += [(f"{vocab[i % 12]} {vocab[i // 12 % 12]} {vocab[i * 7 % 12]}", "en") for i in range(144)] + [("x y z", "en")] * 9
    docs = spark.createDataFrame(rows, "text string, lang string").repartition(3)
    (n, weight, third), found = _made(docs, monkeypatch, least=6)
    assert found == brute(rows, 6, 2000)
    assert n <= 3 and weight == 9


def test_suffix_rows_go_with_cores_not_with_partitions(spark, monkeypatch):
    rows = [("p q r s t. u v w", "en")] * 400
    few = 2 * spark.sparkContext.defaultParallelism
    docs = spark.createDataFrame(rows, "text string, lang string").repartition(10 * few)
    (n, weight, third), found = _made(docs, monkeypatch)
    # Four suffixes of three words or more, once a task; those of two words come from the pairs.
    assert n <= 4 * few and weight == 4 * 400 and third != 0
    assert found == brute(rows, 100, 2000)


@pytest.mark.parametrize("bits", [8, 10])
def test_runs_in_crowded_cells_cost_work_only(spark, monkeypatch, bits):
    rows = random_rows(80, bits) + [("of the a B c dd of the a B c dd", "en")] * 9
    monkeypatch.setattr(phrases, "RUN_BITS", bits)
    monkeypatch.setattr(phrases, "HELD_RUNS", 50)
    assert mine(spark.createDataFrame(rows, "text string, lang string").repartition(3), least=3) == brute(rows, 3, 2000)


def test_cells_of_all_blocks_are_summed(monkeypatch):
    class Every:
        value = np.full(1 << 5, 0xFFFFFFFF, dtype=np.uint32)

    batch = pa.RecordBatch.from_arrays([pa.array(["a b c d"] * 40), pa.array(["en"] * 40), pa.array([1] * 40)], ["text", "lang", "lang_hash"])
    for block, held in ((1 << 20, 1 << 20), (20, 3)):
        monkeypatch.setattr(phrases, "BLOCK_BYTES", block)
        monkeypatch.setattr(phrases, "HELD_RUNS", held)
        made = list(phrases._count_runs(0, Every, 26)([batch, batch]))
        for least, hot in ((80, 3), (81, 0)):
            bits = [np.frombuffer(r["bits"], dtype=np.uint8) for out in phrases._sum_cells(least, 26)(made) for r in out.to_pylist()]
            assert sum(int(np.unpackbits(b).sum()) for b in bits) == hot
