import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from brevita.operators import logs, records
from brevita.operators.generate import batch_generate
from brevita.operators.quantiles import exact_quantiles
from brevita.plans.jobs import dashboard, serve
from brevita.session import fresh_dir
from brevita.sources.records import append_logs
from brevita.streaming.logs import hourly_kpis, ingest_logs, read_files, write_hourly_kpis

START = dt.datetime(2024, 1, 1, 22, 30)
LOG = (
    "timestamp_utc timestamp, request_id string, latency_ms double, input_length int, output_length int, "
    "status string, model_version string, model_repo string, model_filename string, error_message string"
)


def log(spark, rows):
    """Rows of (minutes after the start, id, latency, status, model)."""
    full = [
        (START + dt.timedelta(minutes=m), i, ms, 1, 1, status, model, "repo", "file", None)
        for m, i, ms, status, model in rows
    ]
    return spark.createDataFrame(full, LOG)


@pytest.mark.parametrize(
    "values",
    [
        [1.0],
        [5.0, 1.0],
        list(np.random.default_rng(1).lognormal(5, 2, 3000)),
        list(np.random.default_rng(2).normal(0, 50, 999)),
        [30000.0] * 500 + [1.5, 2.5, -0.0, 0.0, -7.25] + [250.0] * 250,
        [1e-300, 1e300, -1e300, 0.0],
    ],
)
def test_quantiles_equal_numpy(spark, values):
    probs = {"q0": 0.0, "q1": 0.05, "q2": 0.5, "q3": 0.95, "q4": 1.0}
    mixed = [("a", float(v)) for v in values] + [(None, float(-v)) for v in values] + [("a", None), ("a", float("nan"))]
    df = spark.createDataFrame(mixed, "g string, x double").repartition(4)
    got = {r.g: r for r in exact_quantiles(df, "x", probs, "g").collect()}
    for group, data in (("a", values), (None, [-v for v in values])):
        for name, q in probs.items():
            assert got[group][name] == pytest.approx(np.quantile(data, q), rel=1e-12, abs=1e-12)


@pytest.mark.parametrize("range_rows", [1, 50])
def test_quantiles_of_crowded_ranges(spark, range_rows):
    """Many values close together, two neighbouring doubles, one value most of the time: ranges are cut until they are small."""
    rng = np.random.default_rng(5)
    near = [100 + 0.02 * v for v in rng.random(2000)]
    steps = [1.0, float(np.nextafter(1.0, 2.0))] * 300
    most = [7.0] * 900 + [7.0 + i * 1e-9 for i in range(300)]
    rows = [(g, float(v)) for g, values in (("near", near), ("steps", steps), ("most", most)) for v in values]
    df = spark.createDataFrame(rows, "g string, x double").repartition(4)
    probs = {"q1": 0.05, "q2": 0.5, "q3": 0.95}
    got = {r.g: r for r in exact_quantiles(df, "x", probs, "g", range_rows=range_rows).collect()}
    for g, values in (("near", near), ("steps", steps), ("most", most)):
        for name, q in probs.items():
            assert got[g][name] == pytest.approx(np.quantile(values, q), rel=1e-15)


def test_a_million_values_in_one_bucket_leave_small_ranges(spark):
    df = spark.range(1_000_000).selectExpr("100 + id * 2e-8 as x")
    got = exact_quantiles(df, "x", {"p50": 0.5, "p95": 0.95})
    assert got.first().p50 == pytest.approx(100 + 499_999.5 * 2e-8, rel=1e-14)
    plan = got._jdf.queryExecution().toString()
    ranges = [line for line in plan.splitlines() if "near_n" in line]
    assert ranges
    rows = spark.read.parquet(*{p for p in got.inputFiles()}).select("near_n").collect()
    assert rows and max(r.near_n for r in rows) <= 100_000


def test_kpis_skip_null_latency_but_not_null_status(spark):
    rows = [(0, "a", 10.0, "success", "v1"), (1, "b", 20.0, None, "v1"), (2, "c", None, "error", "v2"), (3, "d", 40.0, "success", None)]
    overall = logs.latency_kpis(log(spark, rows)).first()
    assert (overall.requests, overall.p50_latency_ms, overall.success_pct) == (4, 20.0, 50.0)
    assert overall.avg_latency_ms == pytest.approx(70 / 3, abs=1e-6) and overall.p95_latency_ms == 38.0
    by = {r.model_version: r for r in logs.latency_kpis(log(spark, rows), "model_version").collect()}
    assert (by["v2"].requests, by["v2"].p50_latency_ms, by["v2"].success_pct) == (1, None, 0.0)
    assert (by["v1"].p50_latency_ms, by[None].requests) == (15.0, 1)


def test_empty_hours_are_zero(spark):
    rows = [(0, "a", 1.0, "success", "v"), (1, "b", 1.0, "success", "v"), (190, "c", 1.0, "success", "v")]
    got = logs.requests_by_hour(log(spark, rows)).orderBy("hour").collect()
    assert [(r.hour.hour, r.requests) for r in got] == [(22, 2), (23, 0), (0, 0), (1, 1)]


def test_recent_trend_and_dashboard(spark):
    table = log(spark, [(m % 50, f"r{m:04d}", float(m), "success", "v") for m in range(120)])
    recent = logs.recent_requests(table, 3).collect()
    assert [r.request_id for r in recent] == ["r0049", "r0099", "r0048"]
    assert [r.request_id for r in logs.latency_trend(table, 3).collect()] == ["r0048", "r0049", "r0099"]
    views = dashboard(table, 10)
    assert views["kpis"].first().requests == 10 and dashboard(table, None)["kpis"].first().requests == 120


def test_request_validation(spark):
    rows = [(1, "x", None), (2, "", None), (3, " ", 32), (4, "x", 31), (5, "x", 1024), (6, "x", 1025), (7, None, None)]
    df = spark.createDataFrame(rows, "request_no bigint, text string, max_new_tokens int")
    got = records.validate_requests(df).orderBy("request_no").collect()
    assert [r.valid for r in got] == [True, False, True, False, True, False, False]
    assert [got[0].max_tokens, got[2].max_tokens] == [256, 32]
    assert records.with_prompt(df.filter("request_no = 3")).first().prompt.endswith("user<|end_header_id|>\n\n<|eot_id|>"
        "<|start_header_id|>assistant<|end_header_id|>\n\n")  # fmt: skip


@pytest.fixture
def shouting():
    """Generator factory, nested so that it is sent to the workers by value."""

    def factory():
        def generate(prompt, max_tokens):
            if "bad" in prompt:
                raise RuntimeError("boom")
            return f"  {max_tokens} WORDS\n"

        return generate

    return factory


def test_generation_keeps_failed_requests_as_rows(spark, shouting):
    df = spark.createDataFrame([(1, "good"), (2, "bad")], "request_no bigint, text string")
    ready = df.select("*", F.col("text").alias("prompt"), F.lit(64).alias("max_tokens"))
    got = {r.request_no: r for r in batch_generate(ready, shouting).collect()}
    assert (got[1].summary, got[1].output_length, got[1].status) == ("64 WORDS", 8, "success")
    assert (got[2].summary, got[2].status, got[2].error_message) == (None, "error", "Inference failed: boom")


def test_serving_logs_lengths_and_never_texts(spark, shouting):
    df = spark.createDataFrame([(1, "fine text", None), (2, "bad", 50), (3, "", None)], "request_no bigint, text string, max_new_tokens int")
    path = fresh_dir(spark, "served")
    assert serve(df, shouting, "repo", "file", path).count() == 2
    stored = spark.read.parquet(path)
    assert set(stored.columns) == {*records.LOG_COLUMNS, "log_date", "run"}
    rows = {r.status: r for r in stored.collect()}
    assert (rows["success"].input_length, rows["success"].output_length, rows["success"].model_version) == (9, 9, "repo/file")
    assert rows["error"].error_message == "Inference failed: boom"


def test_log_append_never_raises(spark):
    table = log(spark, [(0, "a", 1.0, "success", "v")])
    path = fresh_dir(spark, "log")
    assert append_logs(table, path) and append_logs(table, path)
    assert spark.read.parquet(path).count() == 2
    assert append_logs(table, "nosuchscheme://nowhere/log") is False


def test_ingest_drops_retries_across_batches(spark):
    source, out, checkpoint = (fresh_dir(spark, n) for n in ("source", "out", "checkpoint"))
    first = log(spark, [(0, "a", 1.0, "success", "v"), (1, "a", 1.0, "success", "v"), (2, "b", 1.0, "success", "v")])
    later = log(spark, [(3, "b", 1.0, "success", "v"), (4, "c", 1.0, "success", "v")])
    for part in (first, later):
        part.coalesce(1).write.mode("append").parquet(source)
        ingest_logs(read_files(spark, source, LOG), out, checkpoint).awaitTermination()
    assert sorted(r.request_id for r in spark.read.parquet(out).collect()) == ["a", "b", "c"]


def test_streamed_hours_equal_batch_hours_and_late_rows_are_dropped(spark):
    source, out, checkpoint = (fresh_dir(spark, n) for n in ("source", "out", "checkpoint"))
    rows = [(7 * k, f"r{k}", float(k % 11), "success" if k % 3 else None, f"v{k % 2}") for k in range(100)]
    log(spark, rows[:60]).coalesce(1).write.mode("append").parquet(source)
    write_hourly_kpis(read_files(spark, source, LOG), out, checkpoint, refresh=None).awaitTermination()
    late = [(1, "late", 1.0, "success", "v0")]
    log(spark, rows[60:] + late).coalesce(1).write.mode("append").parquet(source)
    write_hourly_kpis(read_files(spark, source, LOG), out, checkpoint, refresh=None).awaitTermination()
    closed = START + dt.timedelta(minutes=rows[-1][0] - 70)
    batch = hourly_kpis(log(spark, rows)).filter(F.col("hour") <= F.lit(closed))
    streamed = spark.read.parquet(out)
    assert sorted(map(tuple, streamed.collect()), key=str) == sorted(map(tuple, batch.collect()), key=str)
    assert batch.count() > 15
