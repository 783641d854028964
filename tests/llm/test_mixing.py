from collections import Counter, defaultdict

import pytest
from brute import empty, hot, odd, rows, words

from brevita.llm import mixing


def targets(sizes, weights=(5, 2, 1), share=1.5, cap=2.0):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    full = set()
    while True:
        free = [s for s in order if s not in full]
        if not free:
            break
        level = (share * sum(sizes.values()) - cap * sum(sizes[s] for s in full)) / sum(weight[s] for s in free)
        over = {s for s in free if weight[s] * level > cap * sizes[s]}
        if not over:
            break
        full |= over
    return {s: cap * sizes[s] if s in full else weight[s] * level for s in order}


def check(df, got):
    expected = Counter((r["doc_id"], r["source"], len(words(r["text"]))) for r in df.collect())
    assert Counter(r[:3] for r in got) == expected
    sizes, taken, largest = defaultdict(int), defaultdict(int), defaultdict(int)
    for (_, source, size), n in expected.items():
        sizes[source] += size * n
        largest[source] = max(largest[source], size)
    for r in got:
        taken[r.source] += r.taken
        assert r.source_size == sizes[r.source] and r.taken == r.copies * r["size"] <= 2 * r["size"]
    for source, target in targets(sizes).items():
        assert all(r.target == pytest.approx(target) for r in got if r.source == source)
        assert abs(taken[source] - target) <= largest[source] + 1e-6


@pytest.mark.parametrize("make", [odd, hot])
def test_mix(spark, make):
    df = make(spark)
    mixed = mixing.mix(df)
    got = mixed.select("doc_id", "source", "size", "source_size", "target", "copies", "taken").collect()
    check(df, got)
    again = mixing.mix(df.repartition(3))
    assert sorted(map(str, got)) == sorted(map(str, again.select(mixed.columns).collect()))


def test_deep_tree(spark):
    """A fan-out of 3 gives many levels; the words taken still meet the target."""
    df = hot(spark, 900)
    check(df, mixing.mix(df, fanout=3).collect())


def test_documents_of_a_source_have_equal_rates(spark):
    """Over many seeds every document is taken as often as its source's rate says."""
    df = spark.createDataFrame([(i, "w " * (i % 5 + 1), "a" if i < 40 else "b") for i in range(60)], "doc_id int, text string, source string")
    seen = defaultdict(list)
    for seed in range(40):
        for r in mixing.mix(df, weights=(1, 3), share=1.0, seed=seed, fanout=4).collect():
            seen[r.source].append((r.copies, r.target / r.source_size))
    for values in seen.values():
        assert sum(c for c, _ in values) / len(values) == pytest.approx(values[0][1], rel=0.1)


def test_empty_table_and_repeated_row(spark):
    assert rows(mixing.mix(empty(spark))) == []
    df = spark.range(10_000).selectExpr("1L as doc_id", "'a b' as text", "'s' as source").unionByName(
        spark.range(10_000).selectExpr("id + 5 as doc_id", "'a b' as text", "'t' as source")
    )
    got = mixing.mix(df, weights=(1, 3)).groupBy("source").sum("taken").collect()
    assert dict(map(tuple, got)) == {"s": pytest.approx(20_000, abs=2), "t": pytest.approx(40_000, abs=2)}


def test_plan_is_native(spark):
    plan = mixing.mix(odd(spark))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
