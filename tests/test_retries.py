import random

import numpy as np
import pytest
from test_logs import LOG, START, log

from brevita.operators.generate import answered, batch_generate_lists, length_batches
from brevita.streaming import retries

DAY = 24 * 60


def run(spark, folder, bits=1 << 10):
    stream = spark.readStream.schema(LOG).parquet(f"{folder}/in/*")
    retries.ingest_once(stream, f"{folder}/log", f"{folder}/state", bits=bits).awaitTermination()


def feed(spark, folder, name, rows, bits=1 << 10):
    log(spark, rows).coalesce(1).write.parquet(f"{folder}/in/{name}")
    run(spark, folder, bits)


def stored(spark, folder):
    return sorted(((r.request_id, r.latency_ms) for r in retries.read_log(spark, f"{folder}/log", LOG).collect()), key=str)


@pytest.mark.parametrize("bits", [8, 1 << 14])
def test_a_retry_is_stored_once_however_late(spark, tmp_path, bits):
    """Filters of eight bits are always full, so every id is looked up; large ones point to the right day. The rows are the same."""
    rng, kept = random.Random(1), {}
    for batch in range(4):
        rows = [(batch * 3 * DAY + rng.randrange(DAY), f"r{rng.randrange(60)}", float(batch * 1000 + i), "success", "v") for i in range(40)]
        rows += [(batch * DAY, None, -1.0, "success", "v")]
        feed(spark, str(tmp_path), f"b{batch}", rows, bits)
        for m, i, ms, *_ in sorted((r for r in rows if r[1]), key=lambda r: r[0]):
            kept.setdefault(i, ms)
    got = stored(spark, str(tmp_path))
    assert [g for g in got if g[0] is None] == [(None, -1.0)] * 4
    # Of equal times in one batch either may stay.
    assert {i for i, _ in got if i} == set(kept) and len([1 for i, _ in got if i]) == len(kept)
    assert sum(ms == kept[i] for i, ms in got if i) >= len(kept) - 3


def test_only_the_days_that_filters_point_to_are_read(spark, tmp_path):
    for batch in range(3):
        feed(spark, str(tmp_path), f"b{batch}", [(batch * DAY + k, f"d{batch}-{k}", 1.0, "success", "v") for k in range(5)], 1 << 14)
    retry = log(spark, [(9 * DAY, "d1-3", 2.0, "success", "v"), (9 * DAY, "new", 2.0, "success", "v")])
    found = retries.stored_again(retry, f"{tmp_path}/log", 99)
    plan = found._jdf.queryExecution().executedPlan().toString()
    day = str((START + (START - START)).date().replace(day=2))
    assert [r[0] for r in found.collect()] == ["d1-3"]
    assert "PartitionFilters" in plan and day in plan and "2024-01-01" not in plan and "2024-01-03" not in plan


def test_a_batch_that_dies_is_repeated_whole(spark, tmp_path, monkeypatch):
    feed(spark, str(tmp_path), "a", [(0, "x", 1.0, "success", "v"), (1, "y", 1.0, "success", "v")])
    write, before = retries.write_version, stored(spark, str(tmp_path))

    def killed(*a):
        write(*a)
        raise RuntimeError("killed")

    monkeypatch.setattr(retries, "write_version", killed)
    with pytest.raises(Exception, match="killed"):
        feed(spark, str(tmp_path), "b", [(2, "x", 2.0, "success", "v"), (3, "z", 2.0, "success", "v")])
    assert stored(spark, str(tmp_path)) == before
    monkeypatch.setattr(retries, "write_version", write)
    run(spark, str(tmp_path))
    assert stored(spark, str(tmp_path)) == [("x", 1.0), ("y", 1.0), ("z", 2.0)]


def test_filters_never_miss_and_rarely_err():
    rng = np.random.default_rng(0)
    held, others = (rng.integers(0, 2**63, 80_000).astype(np.uint64) for _ in range(2))
    bits = np.zeros(retries.BITS // 8, np.uint8)
    retries._set(bits, held)
    assert retries._has(bits, held).all() and retries._has(bits, others).mean() < 0.01


# --- generation in lists -----------------------------------------------------------------------------------------------------------


@pytest.fixture
def counting():
    """Answers tell the size of their batch; prompts with 'bad' fail the whole call. Nested, so that it goes to the workers by value."""

    def factory():
        def generate(prompts, budgets):
            if any("bad" in p for p in prompts):
                raise RuntimeError("boom")
            return [f" {len(prompts)} {max(map(len, prompts))} " for _ in prompts]

        return generate

    return factory


def requests(spark, lengths, parts=1):
    rows = [(i, "t" * (i % 5), "p" * n if n else "a bad one", 10) for i, n in enumerate(lengths)]
    return spark.createDataFrame(rows, "request_no bigint, text string, prompt string, max_tokens int").repartition(parts)


def test_batches_are_full_and_of_similar_length(spark, counting):
    rng = random.Random(3)
    df = requests(spark, [rng.choice([40, 400, 4000]) for _ in range(600)])
    got = batch_generate_lists(df, counting, batch_tokens=4096, batch_rows=32).collect()
    assert len(got) == 600 and {r.status for r in got} == {"success"}
    size = {}
    for r in got:
        n, longest = map(int, r.summary.split())
        size.setdefault(longest, []).append(n)
    # 4,096 tokens hold 4 requests of 1,010, 32 of 110 (at most 32 rows) and 32 of 20; only the last batch of a length may be short.
    assert max(size[4000]) == 4 and max(size[400]) == 32 and max(size[40]) == 32
    assert sum(n == 32 for n in size[40]) >= len(size[40]) - 64


def test_one_bad_prompt_is_the_only_error(spark, counting):
    lengths = [50] * 200
    lengths[17] = lengths[140] = 0
    got = {r.request_no: r for r in batch_generate_lists(requests(spark, lengths, 2), counting).collect()}
    assert {i for i, r in got.items() if r.status == "error"} == {17, 140}
    assert (got[17].summary, got[17].output_length, got[17].error_message) == (None, 0, "Inference failed: boom")
    assert got[4].input_length == 4 and len(got) == 200


def test_wrong_number_of_answers_and_batches_by_cost():
    assert [x[2] for x in answered(lambda p, b: p[:1], ["a", "b", "c"], [1, 1, 1])] == ["success"] * 3
    assert [x[2] for x in answered(lambda p, b: [], ["a"], [1])] == ["error"]
    assert list(length_batches([5, 100, 5, 7, 3], 14, 2)) == [[1], [3, 0], [2, 4]]
    assert list(length_batches([], 10, 2)) == []
