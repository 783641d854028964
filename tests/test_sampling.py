import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from brevita.operators import sampling
from brevita.plans.jobs import CurationJob
from brevita.plans.views import bills_pool

SCHEMA = "pool_pos bigint, doc_id bigint, text_len int, summary_len int"


def pool(spark, lengths):
    return spark.createDataFrame([(i, i, int(n), 1) for i, n in enumerate(lengths)], SCHEMA)


@pytest.mark.parametrize("n, target", [(357, 250), (1000, 7), (11, 10), (10, 10), (5, 9), (2, 2), (1, 2)])
def test_systematic_sample_matches_the_index_list(spark, n, target):
    rng = np.random.default_rng(n)
    lengths = rng.integers(1, 60, n)
    got = sorted(r.text_len for r in sampling.systematic_sample(pool(spark, lengths), target).collect())
    ordered = sorted(lengths.tolist())
    wanted = ordered if n <= target else [ordered[int(i * (n - 1) / (target - 1))] for i in range(target)]
    assert got == wanted


def test_sample_with_a_third_of_the_rows_at_one_length(spark):
    lengths = [100] * 1000 + list(range(2000))
    got = sampling.systematic_sample(pool(spark, lengths), 300)
    assert got.count() == 300 and got.select("doc_id").distinct().count() == 300


def test_target_of_one_is_rejected(spark):
    with pytest.raises(ValueError):
        sampling.systematic_sample(pool(spark, [1, 2]), 1)


@pytest.mark.parametrize("lengths", [list(range(100)), [1] * 40 + [5] * 30 + list(range(6, 36)), [3, 3, 3, 4]])
def test_deciles_equal_qcut(spark, lengths):
    got = sampling.length_deciles(pool(spark, lengths)).orderBy("doc_id").toPandas()
    wanted = pd.qcut(pd.Series(lengths), q=10, labels=False, duplicates="drop")
    assert got.len_bucket.tolist() == wanted.tolist()


def split_of(spark, buckets, test, val, **options):
    rows = [(i, i, b) for i, b in enumerate(buckets)]
    df = spark.createDataFrame(rows, "pool_pos bigint, doc_id bigint, len_bucket int")
    return sampling.exact_split(df, test, val, **options).toPandas()


def test_split_is_exact_disjoint_and_proportional(spark):
    buckets = [0] * 500 + [1] * 300 + [2] * 200
    got = split_of(spark, buckets, 101, 207)
    assert got.split.value_counts().to_dict() == {"train": 692, "val": 207, "test": 101}
    assert got.doc_id.is_unique and len(got) == 1000
    for name, size in (("test", 101), ("val", 207)):
        for bucket, n in ((0, 500), (1, 300), (2, 200)):
            share = ((got.split == name) & (got.len_bucket == bucket)).sum()
            assert abs(share - size * n / 1000) <= 1.5


def test_split_is_reproducible_and_seeded(spark):
    buckets = [0, 1] * 200
    first, again = split_of(spark, buckets, 40, 40), split_of(spark, buckets, 40, 40)
    other = split_of(spark, buckets, 40, 40, seed=7)
    key = lambda df: df.sort_values("doc_id").split.tolist()
    assert key(first) == key(again) != key(other)


@pytest.mark.parametrize(
    "buckets, test, val",
    [
        ([0] * 50 + [1], 10, 10),  # a stratum of one row
        ([0, 1, 2, 3] * 20, 3, 12),  # fewer test rows than strata, validation still stratified
        ([0, 1, 2, 3] * 5, 8, 9),  # fewer left than strata
        ([0] * 20, 0, 5),
        ([0] * 20, 5, 0),
    ],
)
def test_fallback_keeps_exact_sizes(spark, buckets, test, val):
    counts = split_of(spark, buckets, test, val).split.value_counts().to_dict()
    assert counts.get("test", 0) == test and counts.get("val", 0) == val
    assert counts["train"] == len(buckets) - test - val


def test_validation_is_stratified_after_an_unstratified_test_draw(spark):
    got = split_of(spark, [0, 1, 2, 3] * 100, 3, 80)
    shares = got[got.split == "val"].len_bucket.value_counts()
    assert shares.max() - shares.min() <= 1


def test_unstratified_needs_no_bucket(spark):
    df = spark.range(100).select(F.col("id").alias("pool_pos"), F.col("id").alias("doc_id"))
    got = sampling.exact_split(df, 10, 20, stratified=False).toPandas()
    assert got.split.value_counts().to_dict() == {"train": 70, "val": 20, "test": 10}


def test_any_number_of_strata(spark):
    got = split_of(spark, list(range(500)) * 4, 600, 700)
    assert got.split.value_counts().to_dict() == {"train": 700, "val": 700, "test": 600}
    assert got[got.split == "test"].len_bucket.value_counts().max() <= 2


@pytest.mark.parametrize(
    "sizes, test, val",
    [([1, 20, 20, 19], 12, 6), ([10, 20, 30], 12, 6), ([2, 30, 30], 3, 20), ([500, 2, 40], 30, 3), ([5, 5], 0, 4), ([5, 5], 4, 0)],
)
def test_allocation_is_what_the_split_draws(spark, sizes, test, val):
    buckets = [b for b, n in enumerate(sizes) for _ in range(n)]
    df = spark.createDataFrame([(i, i, b) for i, b in enumerate(buckets)], "pool_pos bigint, doc_id bigint, len_bucket int")
    got = {r.len_bucket: (r.n, r.n_test, r.n_val, r.n_train) for r in sampling.split_allocation(df, test, val).collect()}
    drawn = sampling.exact_split(df, test, val).toPandas()
    for b, n in enumerate(sizes):
        of = drawn[drawn.len_bucket == b].split.value_counts()
        assert got[b] == (n, of.get("test", 0), of.get("val", 0), of.get("train", 0))


def test_guard_raises_before_writing(spark):
    with pytest.raises(sampling.NotEnoughExamples):
        sampling.require_rows(pool(spark, [1, 2]), 3)
    assert sampling.require_rows(pool(spark, [1, 2]), 2) == 2


def test_reference_sizes_at_the_largest_scale(spark):
    labelled = CurationJob().assign(bills_pool(spark, "/root/testdata/sf0.1"))
    counts = {r["split"]: r["count"] for r in labelled.groupBy("split").count().collect()}
    assert counts == {"train": 3000, "val": 300, "test": 200}
