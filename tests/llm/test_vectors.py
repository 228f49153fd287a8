import numpy as np

from keelson.llm import embed_dedup
from keelson.llm.components import connected_components
from tests.llm.helpers import components


def brute(rows, threshold=0.93):
    good = []
    for i, v, g in rows:
        if g is None or not v or any(x is None or not np.isfinite(x) for x in v) or not any(v):
            continue
        good.append((i, np.array(v, np.float32).astype(np.float64), g))
    n, linked = {i: 0 for i, _, _ in rows}, []
    for k, (i, x, g) in enumerate(good):
        for j, y, h in good[k + 1:]:
            if g == h and len(x) == len(y) and x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= threshold:
                n[i] += 1
                n[j] += 1
                linked.append((i, j))
    return n, components(list(n), linked)


def check(spark, rows, **kw):
    df = spark.createDataFrame([(i, v, g, 1, 2) for i, v, g in rows], "vec_id long, embedding array<float>, label int, n_links int, kept int")
    got = embed_dedup.near_duplicates(df, **kw).collect()
    n, comp = brute(rows)
    assert len(got) == len(rows)
    for r in got:
        assert (r.n_links, r.component_id, r.kept) == (n[r.vec_id], comp[r.vec_id], comp[r.vec_id] == r.vec_id)


def test_against_brute_force_with_borderline_pairs(spark):
    rng = np.random.default_rng(0)
    rows = []
    for k in range(400):
        base = rng.normal(size=16) if k % 4 == 0 else rows[k - k % 4][1] + rng.normal(size=16) * rng.uniform(0, 0.6)
        rows.append((k, np.asarray(base, np.float32), int(k % 8 < 4)))
    check(spark, [(i, [float(x) for x in v], g) for i, v, g in rows], block_rows=32)


def test_awkward_vectors(spark):
    one = [1.0, 0.0, 0.0]
    rows = [(0, one, 1), (1, [2.0, 0.0, 0.0], 1), (2, one, 2), (3, one, None), (4, None, 1), (5, [0.0, 0.0, 0.0], 1), (6, [float("nan"), 1.0, 0.0], 1),
            (7, [float("inf"), 1.0, 0.0], 1), (8, [1.0, None, 0.0], 1), (9, [], 1), (10, [1.0, 0.0], 1), (11, one, 1), (12, [1e-30, 0.0, 0.0], 1),
            (13, [-1.0, 0.0, 0.0], 1), (14, [1.0, 0.3, 0.0], 1), (15, [3e38, 1e38, 0.0], 1)]
    check(spark, rows)


def test_many_copies_and_empty_table(spark):
    rows = [(i, [1.0, float(i % 3), 0.5], 1) for i in range(90)]
    check(spark, rows, block_rows=2)
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert embed_dedup.near_duplicates(empty).collect() == []


def test_bounds_hold():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(60, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    q = embed_dedup.quantise(x)
    low, high = embed_dedup.tile_bounds(q, q)
    true = x @ x.T
    assert (low <= true).all() and (true <= high).all() and (high - low).max() < 0.05


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, 100 + i) for i in range(30)] + [(7, 7), (60, 50), (50, 60)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = components({n for e in edges for n in e}, edges)
    assert got == want
    assert connected_components(spark.createDataFrame([], "a long, b long")).collect() == []
