import math

import numpy as np
import pytest

from brevita.llm import topk
from brevita.llm.common import F


def brute(rows, every, k):
    good = [
        (i, tuple(math.floor(1024 * float(np.float32(x))) for x in v))
        for i, v in rows
        if v is not None and len(v) and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = []
    for query, q in sorted({(i, q) for i, q in good if i is not None and i % every == 0}):
        scores = [(-sum(a * b for a, b in zip(q, x)), i is None, i) for i, x in good if i != query and len(x) == len(q)]
        out += [(query, n, i, -s) for n, (s, _, i) in enumerate(sorted(scores, key=lambda t: (t[0], t[1], t[2] or 0))[:k], 1)]
    return sorted(out, key=str)


def check(spark, rows, every=10, k=10, **sizes):
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").repartition(4)
    vectors = df.select("vec_id", topk.quantised(F.col("embedding")).alias("q"))
    got = topk.top_k(vectors, F.col("vec_id") % every == 0, k, **sizes)
    assert sorted(((r.query_id, r["rank"], r.vec_id, r.score) for r in got.collect()), key=str) == brute(rows, every, k)


def clustered(n, dim=8, seed=1):
    random = np.random.default_rng(seed)
    middles = random.normal(size=(6, dim))
    return [(i, (middles[i % 6] + 0.2 * random.normal(size=dim)).tolist()) for i in range(n)]


@pytest.mark.parametrize("sizes", [{}, {"block_rows": 50, "pivots": 6}, {"block_rows": 16, "pivots": 3, "sample": 20}])
def test_clusters_and_blocks(spark, sizes):
    check(spark, clustered(400), **sizes)


def test_odd_vectors(spark):
    rows = clustered(60) + [
        (100, None),
        (110, []),
        (120, [1.0, None] * 4),
        (130, [float("nan")] * 8),
        (140, [float("inf")] + [0.0] * 7),
        (150, [0.0] * 8),
        (160, [1.0, 2.0]),
        (161, [1.0, -2.0]),
        (170, [3.0]),
        (None, [0.5] * 8),
        (None, [0.5] * 8),
        (180, [0.5] * 8),
        (180, [0.5] * 8),
        (190, [0.25] * 8),
        (190, [-0.25] * 8),
        (-10, [-1e-9] * 8),
    ]
    check(spark, rows, block_rows=16, pivots=4)
    check(spark, rows[:3], k=2)
    check(spark, [], k=2)


def test_hot_vector_is_dealt_over_blocks(spark):
    rows = [(i, [1.0, 2.0, 3.0] if i % 3 else [float(i % 7), 1.0, -1.0]) for i in range(900)]
    check(spark, rows, every=50, block_rows=64, pivots=8)


def test_tree_covers_and_bounds_hold():
    random = np.random.default_rng(5)
    x = np.floor(1024 * random.normal(size=(700, 12)))
    tree, open_, leaves = topk.cover_tree(x), [], []
    open_ = [tree]
    while open_:
        node = open_.pop()
        assert np.sqrt(((x[node.points] - node.centre) ** 2).sum(axis=1)).max() <= node.radius + 1e-6
        if node.children:
            assert sorted(np.concatenate([c.points for c in node.children])) == sorted(node.points)
            open_ += node.children
        else:
            leaves.append(node)
    for q in leaves[:8]:
        for d in leaves:
            assert (x[q.points] @ x[d.points].T).max() <= topk.upper_bound(q, d)


def test_pruning_saves_leaves(monkeypatch):
    """Well separated clusters: half of the scores and more are never taken."""
    random = np.random.default_rng(6)
    middles = 4000 * random.normal(size=(40, 6))
    x = np.floor(middles[np.arange(8000) % 40] + random.normal(size=(8000, 6)))
    seen = []
    plain = topk.Search._leaf
    monkeypatch.setattr(topk.Search, "_leaf", lambda self, q, d, *a: (seen.append(len(q) * len(d)), plain(self, q, d, *a)))
    search = topk.Search(x[:80], np.arange(80), np.full(80, -np.inf), 10)
    search.run(x, np.arange(8000), topk.cover_tree(x))
    assert sum(seen) < 0.5 * 80 * 8000


def test_vectors_beyond_exact_products_are_refused(spark):
    df = spark.createDataFrame([(1, [2**27, 1]), (2, [1, 1])], "vec_id bigint, q array<bigint>")
    with pytest.raises(ValueError, match="2\\^53"):
        topk.top_k(df, F.col("vec_id") == 1)
