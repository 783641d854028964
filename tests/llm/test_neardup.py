from collections import Counter, defaultdict

import numpy as np
import pytest
from brute import empty, hot, lower, odd, words

from brevita.llm import neardup
from brevita.llm.components import connected


def shingles(text, width):
    w = words(lower(text))
    if len(w) < width:
        return {tuple(w)} if w else set()
    return {tuple(w[i : i + width]) for i in range(len(w) - width + 1)}


def roots(n, edges):
    label = list(range(n))

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        label[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def brute(rows, width, percent):
    sets, holders, edges = [shingles(t, width) for _, t in rows], defaultdict(list), []
    for i, s in enumerate(sets):
        common = Counter()
        for g in s:
            common.update(holders[g])
            holders[g].append(i)
        edges += [(j, i) for j, n in common.items() if 100 * n >= percent * (len(s) + len(sets[j]) - n)]
    root = roots(len(rows), edges)
    least = defaultdict(list)
    for i, r in enumerate(root):
        if rows[i][0] is not None:
            least[r].append(rows[i][0])
    return sorted(
        ((d, len(sets[i]), min(least[root[i]], default=None), d == min(least[root[i]], default=None)) for i, (d, _) in enumerate(rows)),
        key=str,
    )


def check(docs, width=2, **more):
    got = neardup.near_duplicates(docs, width=width, **more)
    found = sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in got.collect()), key=str)
    assert found == brute([(r.doc_id, r.text) for r in docs.collect()], width, more.get("percent", 80))
    return found


@pytest.mark.parametrize("width", [2, 5])
def test_given_table(spark, small, width):
    assert not all(r[3] for r in check(spark.read.parquet(f"{small}/documents.parquet"), width))


@pytest.mark.parametrize("make", [odd, empty, hot])
def test_odd_and_hot_rows(spark, make):
    check(make(spark))


def test_small_sets_of_every_size(spark):
    """All links between sets of few shingles, one missing or changed at every place."""
    rows, ident = [], 0
    for n in range(1, 14):
        base = [f"b{n}_{i}" for i in range(n + 1)]
        copies = [base] + [base[:i] + base[i + 1 :] for i in range(n + 1)] + [base[:i] + [f"c{n}_{i}"] + base[i + 1 :] for i in range(n + 1)]
        for words_ in copies:
            rows.append((ident * 7 % 1009, " ".join(words_)))
            ident += 1
    check(spark.createDataFrame(rows, "doc_id bigint, text string"))


def test_copies_that_wander(spark, monkeypatch):
    """A long chain of copies, each a little unlike the one before, and blocks of every kind."""
    monkeypatch.setattr(neardup, "BLOCK_CLASSES", 16)
    monkeypatch.setattr(neardup, "LIST_BLOCK", 8)
    random = np.random.default_rng(4)
    text, rows = [f"x{i}" for i in range(100)], []
    for i in range(150):
        for j in random.integers(0, 100, 1 + i % 12):
            text[j] = f"y{i}_{j}"
        rows.append((1000 - i, " ".join(text)))
    check(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5))


def test_connected(spark):
    random = np.random.default_rng(2)
    edges = [(int(a), int(b)) for a, b in random.integers(0, 400, (260, 2))] + [(i, i + 1) for i in range(500, 700)] + [(0, i) for i in range(800, 900)]
    got = {r.v: r.root for r in connected(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    expected = roots(900, edges)
    assert got == {v: expected[v] for e in edges if e[0] != e[1] for v in e}
    assert connected(spark.createDataFrame([], "a bigint, b bigint")).collect() == []


def test_estimate_and_counts_in_tasks(spark):
    random = np.random.default_rng(3)
    base = random.integers(0, 2**62, 400)
    sets = [np.unique(np.concatenate([base[random.random(400) < p], random.integers(0, 2**62, 40)])) for p in (1, 0.9, 0.9, 0.5, 0.1)]
    sets.append(np.zeros(0, np.int64))
    common = neardup.common_counts(sets)
    for i, a in enumerate(sets):
        for j, b in enumerate(sets):
            assert common[i, j] == len(np.intersect1d(a, b))
    rows = [(s[:64].tolist(), len(s)) for s in sets[:5]]
    df = spark.createDataFrame([(*a, *b) for a in rows for b in rows], "a array<bigint>, n bigint, b array<bigint>, m bigint")
    got = [r[0] for r in df.select(neardup.estimate(*(neardup.F.col(c) for c in "anbm"))).collect()]
    k = 0
    for a in sets[:5]:
        for b in sets[:5]:
            exact = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
            assert abs(got[k] - exact) < 0.25
            k += 1
