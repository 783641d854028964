import json
from pathlib import Path

from pyspark.sql import functions as F

from brevita.operators.records import chat_texts, instruction_records
from brevita.plans.jobs import CurationJob, SplitSizes
from brevita.plans.views import bills_pool
from brevita.session import fresh_dir
from brevita.sources import records as store
from brevita.sources.tables import load_corpus, load_predictions, load_training_splits


def rows(spark):
    values = [("train", "é\n\"q\"", "s"), ("val", "b", None), ("test", "c", "t")]
    df = spark.createDataFrame(values, "split string, text string, summary string")
    return instruction_records(df, "split")


def test_jsonl_keeps_nulls_and_utf8(spark):
    path = fresh_dir(spark, "jsonl")
    store.write_jsonl(rows(spark), path)
    lines = [line for f in Path(path).glob("split=*/*.json") for line in f.read_text(encoding="utf-8").splitlines()]
    assert len(lines) == 3 and any("é" in line for line in lines)
    assert {"instruction", "input", "output"} == set(json.loads(lines[0]))
    back = store.read_jsonl(spark, path, store.RECORD_SCHEMA + ", split string")
    assert sorted(map(str, back.select("split", "input", "output").collect())) == sorted(
        map(str, rows(spark).select("split", "input", "output").collect())
    )


def test_splits_are_rebuilt_only_when_one_is_missing(spark):
    path, calls = fresh_dir(spark, "splits"), []

    def build():
        calls.append(1)
        return rows(spark)

    assert store.ensure_splits(spark, path, build)[1] is True
    assert store.ensure_splits(spark, path, build)[1] is False
    assert store.ensure_splits(spark, path, build, force=True)[1] is True
    store.write_jsonl(rows(spark).filter("split <> 'val'"), path)
    assert store.ensure_splits(spark, path, build)[1] is True
    assert store.ensure_splits(spark, path, build)[0].count() == 3 and len(calls) == 3


def test_published_names_and_fallback(spark):
    local, published = fresh_dir(spark, "local"), fresh_dir(spark, "published")
    store.publish_splits(rows(spark), published)
    assert {p.name for p in Path(published).glob("split=*")} == {"split=train", "split=validation", "split=test"}
    train, val = load_training_splits(spark, local, published, store.RECORD_SCHEMA)
    assert (train.count(), val.first().input) == (1, "b")
    store.write_jsonl(rows(spark).filter("split = 'train'"), local)
    assert load_training_splits(spark, local, published, store.RECORD_SCHEMA)[1].first().input == "b"
    store.write_jsonl(rows(spark).withColumn("input", F.col("instruction")), local)
    assert load_training_splits(spark, local, published, store.RECORD_SCHEMA)[1].first().input.startswith("Summarize")


def test_json_array_and_result_files(spark, tmp_path):
    values = [{"id": 0, "relevance": 2, "fluency": 5}, {"id": 1, "error": "bad"}]
    (tmp_path / "results.json").write_text(json.dumps(values, indent=2))
    got = store.read_json_array(spark, str(tmp_path / "results.json")).orderBy("id").collect()
    assert (got[0].relevance, got[0].factual, got[1].error) == (2, None, "bad")
    path = fresh_dir(spark, "result")
    for score in (1, 2):
        store.write_result(spark.createDataFrame([("m", score)], "model string, score int"), path)
    assert spark.read.json(path).first().score == 2


def test_corpus_and_prediction_readers(spark):
    a, b = fresh_dir(spark, "train"), fresh_dir(spark, "test")
    for path, n in ((a, 3), (b, 2)):
        spark.range(n).selectExpr("id as doc_id", "'t' as text", "'s' as summary", "1 as extra").write.parquet(path)
    assert load_corpus(spark, a, b).groupBy("src_rank").count().orderBy("src_rank").collect()[1]["count"] == 2
    path = fresh_dir(spark, "predictions")
    spark.range(1).selectExpr(
        "id", "'m' as model", "'r' as reference_summary", "'g' as generated_summary", "0 as x"
    ).write.parquet(path)
    assert load_predictions(spark, path).columns == ["id", "model", "reference_summary", "generated_summary"]


def test_chat_text(spark):
    text = chat_texts(rows(spark)).filter("split = 'test'").first().text
    assert text == (
        "<|begin_of_text|><|start_header_id|>system<|end_header_id|>\n\nSummarize the following legal bill.<|eot_id|>"
        "<|start_header_id|>user<|end_header_id|>\n\nc<|eot_id|>"
        "<|start_header_id|>assistant<|end_header_id|>\n\nt<|eot_id|>"
    )


def test_curation_job_end_to_end(spark, small):
    job = CurationJob(SplitSizes(train=40, val=12, test=10))
    path, published = fresh_dir(spark, "job"), fresh_dir(spark, "job-published")
    kept = job.run(spark, bills_pool(spark, small), path, published)
    counts = {r["split"]: r["count"] for r in kept.groupBy("split").count().collect()}
    assert counts == {"train": 40, "val": 12, "test": 10}
    assert spark.read.parquet(published).filter("split = 'validation'").count() == 12
