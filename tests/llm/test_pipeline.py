import pytest
import test_contamination
import test_lines
import test_mixing
import test_neardup
from brute import empty, odd, words

import __spark_entry__ as contract
import corpus_pipeline as pipeline
from brevita.llm import quality
from brevita.llm.queries import ORACLE, QUERIES
from brevita.session import pin


def pairs(df):
    return [(r.doc_id, r.text) for r in df.collect()]


def stages_checked(spark, docs, folder):
    """Runs the stages one after another and holds each against brute force on its own input."""
    columns = docs.columns

    model = quality.train(docs, spark.read.parquet(f"{folder}/labels.parquet"))
    scored = quality.score(docs, model, keep=("doc_id", "text")).collect()
    kept = pin(pipeline.keep_quality(spark, docs, folder))
    assert kept.columns == columns
    assert sorted(pairs(kept), key=str) == sorted(((r.row.doc_id, r.row.text) for r in scored if r.score >= 0.3), key=str)

    cut = pin(pipeline.cut_lines(spark, kept, folder))
    assert cut.columns == columns
    left = [(i, t) for i, _, n, t in test_lines.brute(pairs(kept)) if not n or words(t)]
    assert sorted(pairs(cut), key=str) == sorted(left, key=str)

    one = pin(pipeline.keep_one_of_a_group(spark, cut, folder))
    assert one.columns == columns
    stays = {d for d, _, _, k in test_neardup.brute(pairs(cut), 5, 80) if k}
    assert sorted(pairs(one), key=str) == sorted((p for p in pairs(cut) if p[0] in stays), key=str)

    clean = pin(pipeline.keep_clean_of_benchmark(spark, one, folder))
    assert clean.columns == columns
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    hits = test_contamination.brute(pairs(one), items)
    assert sorted((r.doc_id for r in clean.collect()), key=str) == sorted((d for d, _, n, _ in hits if n == 0), key=str)

    mixed = pipeline.mix_sources(spark, clean, folder).collect()
    assert all(r.copies > 0 for r in mixed)
    return clean, mixed


def test_stages_on_given_tables(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    clean, mixed = stages_checked(spark, docs, small)
    assert clean.count() < docs.count()
    assert sorted(map(str, pipeline.run(spark, small).collect())) == sorted(map(str, mixed))
    test_mixing.check(clean, test_mixing.mixing.mix(clean).collect())


def test_odd_rows(spark, small):
    df = odd(spark).dropDuplicates(["doc_id", "text"])
    stages_checked(spark, df, small)


def test_empty_table(spark, small):
    docs = empty(spark)
    for _, stage in pipeline.STAGES:
        docs = stage(spark, docs, small)
        assert docs.count() == 0


def test_repeated_rows_go_through_every_stage(spark, small):
    df = odd(spark).unionByName(odd(spark))
    for _, stage in pipeline.STAGES:
        df = pin(stage(spark, df, small))
    assert df.count() > 0


def test_registration():
    assert {*QUERIES, "pipeline"} <= set(contract.queries())
    assert set(ORACLE) <= set(contract.oracle_sql())
    assert [name.split("_")[0] for name in QUERIES] == [f"op{i}" for i in range(1, 14)]
    assert len(pipeline.STAGES) == 5


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_its_sql(spark, small, name):
    import duckdb

    con = duckdb.connect()
    for table in ("documents", "embeddings", "pages"):
        con.sql(f"create view {table} as select * from '{small}/{table}.parquet'")
    expected = con.sql(ORACLE[name])
    got = contract.queries()[name](spark, small)
    assert sorted(got.columns) == sorted(expected.columns)
    assert sorted(map(str, (tuple(r) for r in got.select(expected.columns).collect()))) == sorted(map(str, expected.fetchall()))
