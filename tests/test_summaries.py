import datetime as dt
import itertools
import random

import pytest
from test_logs import LOG, START, log

from brevita.operators import logs, summaries
from brevita.plans import monitoring
from brevita.session import pin
from brevita.streaming import live

HOUR = dt.timedelta(hours=1)


def rank_error(values, estimate, q):
    """How far the estimate's rank range is from the wanted one, as a share of the rows."""
    low, high = sum(v < estimate for v in values) / len(values), sum(v <= estimate for v in values) / len(values)
    return max(low - q, q - high, 0)


def noisy(n, seed=1):
    """A third of the rows in one hour and model with one latency; heavy tails, nulls and NaN elsewhere."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        if i % 3 == 0:
            rows.append((5, str(i), 250.0, "success", "hot"))
        else:
            ms = None if i % 50 == 1 else float("nan") if i % 50 == 2 else rng.lognormvariate(5, 2)
            rows.append((rng.randrange(60 * 30), str(i), ms, rng.choice(["success", "error", None]), rng.choice(["a", "b", None])))
    return rows


def test_ranges_from_sketches_agree_with_exact_figures(spark, tmp_path):
    rows = noisy(30_000)
    table = pin(log(spark, rows).repartition(6))
    for run, part in (("one", table.filter("request_id % 2 = 0")), ("two", table.filter("request_id % 2 = 1")), ("one", table.filter("request_id % 2 = 0"))):
        summaries.write_summaries(summaries.hourly_summaries(part), f"{tmp_path}/s", run)
    since, until = START + dt.timedelta(minutes=30) + 3 * HOUR, START + dt.timedelta(minutes=30) + 20 * HOUR
    for window in ((None, None), (since, until)):
        kept = [r for r in rows if (not window[0] or since <= START + dt.timedelta(minutes=r[0]) < until)]
        held = summaries.read_summaries(spark, f"{tmp_path}/s", *[w and str(w) for w in window])
        exact = {r.model_version: r for r in logs.latency_kpis(log(spark, kept), "model_version").collect()}
        got = {r.model_version: r for r in summaries.merged_kpis(held, "model_version").collect()}
        assert got.keys() == exact.keys()
        for model, r in got.items():
            values = [ms for *_, ms, _, m in kept if m == model and ms is not None and ms == ms]
            assert (r.requests, r.max_latency_ms) == (exact[model].requests, max(values))
            assert r.avg_latency_ms == pytest.approx(exact[model].avg_latency_ms) and r.success_pct == pytest.approx(exact[model].success_pct)
            assert rank_error(values, r.p50_latency_ms, 0.5) <= 2 * summaries.RANK_ERROR
            assert rank_error(values, r.p95_latency_ms, 0.95) <= 2 * summaries.RANK_ERROR
    plan = summaries.merged_kpis(held)._jdf.queryExecution().executedPlan().toString()
    assert "log_date" in plan.split("PartitionFilters", 1)[1].split("]")[0]


def test_groups_without_latencies(spark):
    table = log(spark, [(1, "1", None, "success", "a"), (2, "2", float("nan"), None, "a"), (3, "3", 7.0, "success", "b")])
    held = pin(summaries.hourly_summaries(table))
    got = {r.model_version: r for r in summaries.merged_kpis(held, "model_version").collect()}
    assert (got["a"].requests, got["a"].avg_latency_ms, got["a"].p50_latency_ms, got["a"].success_pct) == (2, None, None, 50.0)
    assert (got["b"].p50_latency_ms, got["b"].p95_latency_ms) == (7.0, 7.0)
    (overall,) = summaries.merged_kpis(held).collect()
    assert (overall.requests, overall.avg_latency_ms) == (3, 7.0)
    (none,) = summaries.merged_kpis(held.limit(0)).collect()
    assert (none.requests, none.p50_latency_ms, none.success_pct) == (0, None, None)
    assert summaries.merged_kpis(held.limit(0), "model_version").collect() == []


def test_hours_are_filled_for_each_model(spark):
    table = log(spark, [(0, "1", 1.0, "success", "a"), (200, "2", 1.0, "success", "a"), (90, "3", 1.0, "success", "b"), (95, "4", 1.0, "success", "b")])
    got = sorted((r.model_version, r.hour.hour, r.requests) for r in summaries.filled_hours(summaries.hourly_summaries(table)).collect())
    assert got == [("a", 0, 0), ("a", 1, 1), ("a", 22, 1), ("a", 23, 0), ("b", 0, 2)]


def stream_batches(spark, tmp_path, batches, compact_after=50):
    for k, rows in enumerate(batches):
        log(spark, rows).coalesce(1).write.parquet(f"{tmp_path}/in/b{k}")
        stream = spark.readStream.schema(LOG).parquet(f"{tmp_path}/in/*")
        live.write_live(stream, f"{tmp_path}/live", f"{tmp_path}/state", None, compact_after).awaitTermination()


def figures(df):
    return sorted(((str(r.hour), str(r.model_version), r.requests, r.latency_sum) for r in df.collect()), key=str)


@pytest.mark.parametrize("compact_after", [50, 2])
def test_open_hours_are_visible_and_a_replayed_batch_changes_nothing(spark, tmp_path, compact_after):
    assert live.read_live(spark, f"{tmp_path}/live").collect() == []
    batches = [[(m, f"{k}-{m}", float(m), "success", "a" if m % 2 else "b") for m in range(10 * k, 10 * k + 25)] for k in range(5)]
    stream_batches(spark, tmp_path, batches, compact_after)
    expected = figures(summaries.hourly_summaries(log(spark, list(itertools.chain(*batches)))))
    assert figures(live.read_live(spark, f"{tmp_path}/live")) == expected
    # A batch that ran before, run again: its rows under its number, and the copy merged with it.
    number = max(live.versions(spark, f"{tmp_path}/live/batches"))
    again = pin(spark.read.parquet(f"{tmp_path}/live/batches/version={number}"))
    live.write_version(again, f"{tmp_path}/live/batches", number)
    live.compact(spark, f"{tmp_path}/live", number)
    assert figures(live.read_live(spark, f"{tmp_path}/live")) == expected
    kpis = summaries.merged_kpis(live.read_live(spark, f"{tmp_path}/live")).first()
    assert kpis.requests == 125


def test_query_marks_estimates_within_the_bound(spark, small):
    rows = monitoring.QUERIES["kpis_from_summaries"](spark, small).collect()
    assert rows and all(r.p50_within and r.p95_within for r in rows)
