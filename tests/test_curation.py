import re

import pytest
from pyspark.sql import functions as F

from brevita.operators import curation
from brevita.plans.views import bills_pool


def split(spark, rows):
    return spark.createDataFrame(rows, "doc_id bigint, text string, summary string")


def test_pool_orders_train_before_test(spark):
    pool = curation.pool_splits(split(spark, [(9, "a", "b")]), split(spark, [(1, "c", "d")]))
    assert [(r.src_rank, r.doc_id) for r in pool.orderBy("pool_pos").collect()] == [(0, 9), (1, 1)]


def test_ids_outside_the_range_raise(spark):
    with pytest.raises(Exception, match="document ids"):
        curation.pool_splits(split(spark, [(-1, "a", "b")])).collect()


def test_first_copy_wins_even_if_it_is_dropped_later(spark):
    long = "word " * 10
    pool = curation.pool_splits(
        split(spark, [(5, long, ""), (7, "other text", "ot")]),
        split(spark, [(1, "WORD-" * 10, "w"), (2, "!!!", "x"), (3, "???", "x")]),
    )
    kept = curation.near_dedup(pool).collect()
    assert sorted((r.src_rank, r.doc_id) for r in kept) == [(0, 5), (0, 7), (1, 2)]
    band = curation.LengthBand(1, 1000, 1, 1000)
    left = curation.curated_positions(pool, band).collect()
    assert [(r.src_rank, r.doc_id) for r in left] == [(0, 7), (1, 2)]
    funnel = curation.curation_funnel(pool, band).first()
    assert (funnel.loaded, funnel.deduplicated, funnel.valid, funnel.in_band) == (5, 3, 2, 2)


def test_one_key_holding_a_third_of_the_rows(spark):
    hot = spark.range(3000).select(
        F.col("id").alias("doc_id"),
        F.when(F.col("id") % 3 == 0, F.lit("same")).otherwise(F.concat(F.lit("t"), "id")).alias("text"),
        F.lit("s").alias("summary"),
    )
    kept = curation.near_dedup(curation.pool_splits(hot))
    assert kept.count() == 2001
    assert kept.filter("text = 'same'").first().doc_id == 0


def test_gates_are_strict_and_inclusive(spark):
    rows = [(1, "abc", "ab"), (2, "abc", "abc"), (3, "", ""), (4, "abcd", "a")]
    df = split(spark, rows)
    assert sorted(r.doc_id for r in curation.quality_filter(df).collect()) == [1, 4]
    band = curation.LengthBand(3, 4, 2, 3)
    assert sorted(r.doc_id for r in curation.length_filter(df, band).collect()) == [1, 2]
    report = curation.length_report(df, band).first()
    assert (report.initial, report.kept, report.kept_pct) == (4, 2, 50.0)


@pytest.mark.parametrize("sf, expected", [("0.001", (200, 193, 175, 76)), ("0.01", (1000, 951, 861, 357))])
def test_funnel_of_the_given_tables(spark, sf, expected):
    got = curation.curation_funnel(bills_pool(spark, f"/root/testdata/sf{sf}")).first()
    assert (got.loaded, got.deduplicated, got.valid, got.in_band) == expected


def exchanged(df):
    """Columns that leave each exchange of a plan."""
    text = df._jdf.queryExecution().executedPlan().toString()
    formatted = df._jdf.queryExecution().explainString(df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    assert ("Exchange" in text) == bool(parts := re.findall(r"\(\d+\) (?:Broadcast)?Exchange\nInput \[\d+\]: \[(.*)\]", formatted))
    return [set(re.findall(r"(\w+)#", p)) for p in parts]


def test_only_narrow_rows_are_shuffled(spark, small):
    pool = bills_pool(spark, small)
    for df in (curation.curation_funnel(pool), curation.near_dedup(pool), curation.curated_positions(pool)):
        moved = exchanged(df)
        assert moved and not set.union(*moved) & {"text", "summary", "near_key"}
    plan = curation.curation_funnel(pool)._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan
