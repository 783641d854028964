import random

import pytest
from pyspark.sql import functions as F

from brevita.operators import gate
from brevita.streaming import champions
from brevita.streaming.logs import read_files

CANDIDATES = "family string, seq bigint, combined_score double"


def made(seed, n=400):
    """A third of the candidates in one family, whose scores rise slowly; ties and repeated scores."""
    rng, rows = random.Random(seed), []
    for seq in range(n):
        family = "hot" if seq % 3 == 0 else f"f{rng.randrange(5)}"
        score = seq / n + rng.random() * 0.02 if family == "hot" else round(rng.random(), 2)
        rows.append((family, seq, score))
    return rows


def fold(rows, threshold):
    held, out = {}, []
    for family, seq, score in sorted(rows, key=lambda r: r[1]):
        if score is not None and (family not in held or score > held[family] + threshold):
            out.append((family, seq, score, held.get(family)))
            held[family] = score
    return sorted(out, key=str)


def add_file(spark, rows, folder, name, schema=CANDIDATES, parts=3):
    df = spark.createDataFrame(rows, schema).repartition(parts)
    df.write.parquet(f"{folder}/{name}")


def run(spark, folder, out, checkpoint, threshold=0.02, schema=CANDIDATES, **more):
    stream = spark.readStream.schema(schema).parquet(f"{folder}/*")
    query = champions.write_timeline(champions.champion_timeline(stream, threshold, **more), out, checkpoint)
    query.awaitTermination()
    return query


def timeline(spark, out):
    return sorted(((r.family, r.seq, r.combined_score, r.champion_score) for r in champions.read_timeline(spark, out).collect()), key=str)


@pytest.mark.parametrize(("cuts", "threshold"), [([400], 0.02), ([1, 2, 3, 200, 400], 0.0), ([150, 151, 400], 0.02)])
def test_any_cut_into_batches_gives_the_history(spark, tmp_path, cuts, threshold):
    rows = made(sum(cuts))
    out, state = f"{tmp_path}/out", f"{tmp_path}/state"
    for begin, end in zip([0, *cuts[:-1]], cuts, strict=True):
        add_file(spark, rows[begin:end], f"{tmp_path}/in", f"b{end}")
        run(spark, f"{tmp_path}/in", out, state, threshold)
    assert timeline(spark, out) == fold(rows, threshold)
    candidates = spark.createDataFrame(rows, CANDIDATES)
    got = gate.decisions_by_timeline(candidates, champions.read_timeline(spark, out), threshold).collect()
    assert sorted(map(str, got)) == sorted(map(str, gate.promotion_history(candidates, threshold).collect()))
    held = sorted(map(tuple, champions.champions_of(champions.read_timeline(spark, out)).collect()))
    assert held == sorted(map(tuple, gate.current_champions(gate.promotion_history(candidates, threshold)).collect()))


def test_restart_after_a_failed_batch(spark, tmp_path, monkeypatch):
    """A batch that dies half-way leaves no trace; the restart goes on from the champions of the batch before."""
    rows = made(7)
    out, state = f"{tmp_path}/out", f"{tmp_path}/state"
    add_file(spark, rows[:200], f"{tmp_path}/in", "a")
    run(spark, f"{tmp_path}/in", out, state)
    add_file(spark, rows[200:], f"{tmp_path}/in", "b")
    whole = champions._fold

    def broken(threshold, idle):
        inner = whole(threshold, idle)

        def fail(key, frames, held):
            yield from inner(key, frames, held)
            if key == ("hot",):
                raise RuntimeError("killed")

        return fail

    monkeypatch.setattr(champions, "_fold", broken)
    with pytest.raises(Exception, match="killed"):
        run(spark, f"{tmp_path}/in", out, state)
    monkeypatch.setattr(champions, "_fold", whole)
    assert timeline(spark, out) == fold(rows[:200], 0.02)
    run(spark, f"{tmp_path}/in", out, state)
    assert timeline(spark, out) == fold(rows, 0.02)
    # One row of state a family, whatever the number of candidates.
    kept = spark.read.format("statestore").load(state).select("value.*").collect()
    assert len(kept) == len({f for f, *_ in rows})


def test_late_null_and_nan_scores(spark, tmp_path):
    out, state = f"{tmp_path}/out", f"{tmp_path}/state"
    add_file(spark, [("f", 5, 0.5), ("f", 6, None), ("f", 7, float("nan")), ("g", 1, None)], f"{tmp_path}/in", "a")
    run(spark, f"{tmp_path}/in", out, state)
    add_file(spark, [("f", 6, 0.9), ("f", 8, 0.51), ("f", 9, 0.6), ("g", 2, 0.1), (None, 1, 0.3)], f"{tmp_path}/in", "b")
    run(spark, f"{tmp_path}/in", out, state)
    assert timeline(spark, out) == sorted([("f", 5, 0.5, None), ("f", 9, 0.6, 0.5), ("g", 2, 0.1, None), (None, 1, 0.3, None)], key=str)
    with pytest.raises(ValueError, match="at least 0"):
        champions.champion_timeline(spark.createDataFrame([], CANDIDATES), -0.1)


def test_idle_families_lose_their_champion(spark, tmp_path):
    schema = CANDIDATES + ", decided_at timestamp"
    out, state = f"{tmp_path}/out", f"{tmp_path}/state"
    days = lambda n: f"2024-01-{n:02d}"
    for k, rows in enumerate([[("f", 1, 0.5, 1), ("g", 1, 0.5, 1)], [("g", 2, 0.4, 20)], [("g", 3, 0.9, 21)], [("f", 4, 0.2, 22)], [("g", 5, 0.1, 23)]]):
        made = spark.createDataFrame([(*r[:3], days(r[3])) for r in rows], CANDIDATES + ", day string")
        made.select("family", "seq", "combined_score", F.col("day").cast("timestamp").alias("decided_at")).write.parquet(f"{tmp_path}/in/{k}")
        run(spark, f"{tmp_path}/in", out, state, schema=schema, idle="15 days")
    got = champions.read_timeline(spark, out)
    assert [tuple(r) for r in got.filter("event = 'RETIRED'").collect()] == [("f", 1, None, 0.5, "RETIRED")]
    assert sorted(map(tuple, champions.champions_of(got).collect())) == [("f", 4, 0.2), ("g", 3, 0.9)]


def test_few_rows_of_a_hot_family_reach_the_state(spark):
    rng = random.Random(2)
    df = spark.createDataFrame([("hot", i, rng.random()) for i in range(20_000)], CANDIDATES).repartition(4)
    few = df.withColumn("at", F.lit(None).cast("timestamp")).mapInPandas(champions._contenders, few_schema())
    assert few.count() < 100


def few_schema():
    return "family string, seq bigint, combined_score double, at timestamp"


def test_stream_of_the_given_events(spark, small):
    assert read_files(spark, f"{small}/events.parquet", "event_id bigint").isStreaming
