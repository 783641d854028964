import random
from collections import Counter

import numpy as np
import pytest

from brevita.operators import sampling
from brevita.operators.ranks import histogram_quantiles, running_totals


def test_running_totals_are_those_of_one_sorted_pass(spark):
    draw = random.Random(3)
    rows = [(x, b, draw.randint(0, 9)) for x in [None, -1.5, 0.0, 2.5, *(draw.random() for _ in range(500))] for b in (1, 2)]
    df = spark.createDataFrame(rows, "x double, b int, n bigint").repartition(7)
    start, want = 0, {}
    for x, b, n in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1])):
        want[x, b] = (start, sum(r[2] for r in rows))
        start += n
    got = {(r.x, r.b): (r.start, r.total) for r in running_totals(df, ["x", "b"], "n").collect()}
    assert got == want
    assert running_totals(df.filter("false"), ["x", "b"], "n").collect() == []


@pytest.mark.parametrize("values", [[5.0], [1.0, 2.0], [float(i * i % 977) / 7 for i in range(700)], [3.0] * 500 + [1e18, -2.0]])
def test_quantiles_of_a_histogram(spark, values):
    counted = spark.createDataFrame([*Counter(values).items(), (None, 40)], "x double, n bigint")
    probabilities = [0.0, 0.1, 0.25, 0.5, 0.77, 1.0]
    edges = histogram_quantiles(counted, "x", "n", probabilities).first().edges
    assert edges == pytest.approx(list(np.quantile(values, probabilities)), rel=1e-12)
    assert histogram_quantiles(counted.filter("x is null"), "x", "n", [0.5]).first().edges is None


def test_sample_and_bins_of_a_column_of_any_range(spark):
    draw = random.Random(8)
    values = [draw.lognormvariate(0, 20) for _ in range(900)] + [7.25] * 600
    pool = spark.createDataFrame([(i, i, x) for i, x in enumerate(values)], "doc_id bigint, pool_pos bigint, score double")
    ordered = sorted(values)
    want = sorted(ordered[i * (len(values) - 1) // 99] for i in range(100))
    assert sorted(r.score for r in sampling.systematic_sample(pool, 100, "score").collect()) == want
    edges = sorted(set(np.quantile(values, [k / 10 for k in range(11)])))[1:]
    bins = {r.doc_id: r.len_bucket for r in sampling.length_deciles(pool, "score").collect()}
    assert bins == {i: sum(e < x for e in edges) for i, x in enumerate(values)}


def test_no_window_sees_all_values(spark):
    """The only window without a partition is over the sums of the ranges."""
    counted = spark.range(1000).selectExpr("cast(id as double) as x", "1L as n")
    plan = running_totals(counted, ["x"], "n")._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.splitlines() if "Window [" in line]
    assert windows
    assert all("_range" in line for line in windows if "x#" in line)
    assert not [line for line in windows if "x#" in line and "_sum" in line]
