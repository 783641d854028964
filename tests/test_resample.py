import random

import numpy as np
import pytest

from brevita.operators import resample, rouge
from brevita.plans import evaluation

SCHEMA = "id bigint, model string, rouge1 double, rouge2 double, rougeL double"


def made(spark, n=900, seed=1, parts=3):
    """Two models, one with two thirds of the rows; skewed scores; a null model."""
    rng = random.Random(seed)
    rows = [(i, None if i % 50 == 0 else "a" if i % 3 else "b", rng.random() ** 4, rng.random(), 0.5) for i in range(n)]
    return spark.createDataFrame(rows, SCHEMA).repartition(parts)


def by_key(df):
    return {(r.model, r.replicate): r for r in df.collect()}


@pytest.mark.parametrize("leaf_rows", [10, 100, 5000])
def test_every_replicate_draws_n_rows(spark, leaf_rows):
    df = made(spark)
    n = {r.model: r["count"] for r in df.groupBy("model").count().collect()}
    got = by_key(resample.resampled(df, 40, leaf_rows=leaf_rows))
    assert got.keys() == {(m, r) for m in n for r in range(40)}
    for (model, _), r in got.items():
        assert r.draws == n[model] and r.rougeL == pytest.approx(n[model] / 2)


def test_same_draws_for_any_partitioning(spark):
    one, other = (by_key(resample.resampled(made(spark, parts=p), 20, leaf_rows=30)) for p in (1, 7))
    assert one.keys() == other.keys()
    for k in one:
        assert one[k].draws == other[k].draws and one[k].rouge1 == pytest.approx(other[k].rouge1, rel=1e-12)
    seeded = by_key(resample.resampled(made(spark), 20, seed=7, leaf_rows=30))
    assert any(one[k].rouge1 != seeded[k].rouge1 for k in one)


@pytest.mark.parametrize("leaf_rows", [20, 5000])
def test_interval_agrees_with_plain_resampling(spark, leaf_rows):
    df = made(spark)
    got = {r.model: r for r in resample.bootstrap_interval(df, 2000, leaf_rows=leaf_rows).collect()}
    rng = np.random.default_rng(3)
    for model in ("a", "b"):
        x = np.array([r.rouge1 for r in df.filter(f"model = '{model}'").collect()])
        means = x[rng.integers(0, len(x), (20_000, len(x)))].mean(axis=1)
        low, mid, high = np.quantile(means, [0.025, 0.5, 0.975])
        width = high - low
        assert abs(got[model].rouge1_mid - mid) < 0.05 * width
        assert abs((got[model].rouge1_high - got[model].rouge1_low) / width - 1) < 0.1


def test_counts_are_multinomial(spark):
    """Each row is drawn once on average with the variance 1 - 1/n, pairs of rows with the covariance -1/n, across leaves too."""
    n, replicates = 12, 4000
    rows = [(i, "m", *[float(i == k) for k in (0, 1, 2)]) for i in range(n)]
    got = resample.resampled(spark.createDataFrame(rows, SCHEMA), replicates, leaf_rows=2).orderBy("replicate").collect()
    counts = np.array([[r.rouge1, r.rouge2, r.rougeL] for r in got])
    assert np.allclose(counts.mean(axis=0), 1, atol=0.07)
    expected = np.eye(3) - 1 / n
    assert np.allclose(np.cov(counts.T), expected, atol=0.1)


def test_equal_rows_are_one_item_with_a_weight(spark):
    """A third of all rows are one row repeated: their sum has the same spread, and no leaf holds them one by one."""
    rows = [(1, "m", 1.0, 0.0, 0.5)] * 3000 + [(i, "m", 0.0, 1.0, 0.5) for i in range(2, 6002)]
    got = resample.resampled(spark.createDataFrame(rows, SCHEMA).repartition(5), 1500, leaf_rows=50).collect()
    hits = np.array([r.rouge1 for r in got])
    assert all(r.draws == 9000 and r.rouge1 + r.rouge2 == 9000 for r in got)
    assert abs(hits.mean() - 3000) < 6 and abs(hits.std() / np.sqrt(9000 * 2 / 9) - 1) < 0.08


def test_dealt_by_weight_and_by_draw():
    rng = np.random.default_rng(0)
    for times in (np.array([1, 1, 1]), np.array([5, 1, 2]), np.array([1000, 1, 500])):
        draws = np.full(3000, 30)
        counts = np.concatenate(list(resample.dealt(draws, times, rng)))
        assert (counts.sum(axis=1) == 30).all()
        assert np.allclose(counts.mean(axis=0), 30 * times / times.sum(), atol=0.3)


def test_empty_and_single_rows(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert resample.bootstrap_interval(empty, 10).collect() == []
    (r,) = resample.bootstrap_interval(spark.createDataFrame([(1, "m", 0.25, 0.5, 1.0)], SCHEMA), 10).collect()
    assert (r.rouge1_low, r.rouge1_high, r.rougeL_mid) == (0.25, 0.25, 1.0)


def test_query_lies_around_the_corpus_means(spark, small):
    means = {r.model: r for r in evaluation.corpus_means(spark, small).collect()}
    rows = evaluation.QUERIES["rouge_resample"](spark, small).collect()
    assert {r.model for r in rows} == means.keys()
    for r in rows:
        for m in rouge.METRICS:
            assert r[f"{m}_low"] <= means[r.model][m] <= r[f"{m}_high"]
