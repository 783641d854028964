import random

import pytest
from pyspark.sql import functions as F

from brevita.operators import gate
from brevita.plans.jobs import evaluate, promote
from brevita.session import fresh_dir
from brevita.sources.files import versions
from brevita.sources.records import read_version
from brevita.streaming.gate import gate_stream
from brevita.streaming.logs import read_files

ROUGE = "model string, rouge1 double, rouge2 double, rougeL double"
JUDGE = "model string, overall_average double, num_examples bigint"
CANDIDATES = "family string, seq bigint, combined_score double"


def test_golden_scorecard(spark):
    rouge = spark.createDataFrame([("m", 0.49014326676848985, 0.30095941368833834, 0.3797067724539025)], ROUGE)
    judged = spark.createDataFrame([("m", 3.611, 12)], JUDGE)
    got = gate.build_scorecards(rouge, judged).first()
    assert (got.rouge_average, got.gemini_average, got.combined_score) == (0.39027, 0.7222, 0.556235)
    assert got.raw.gemini.num_examples == 12 and got.raw.rouge.rouge1 == 0.49014326676848985


def test_any_subset_of_metrics(spark):
    judged = spark.createDataFrame([("m", 5.0, 1), ("n", 5.0, 1)], JUDGE)
    some = spark.createDataFrame([("m", 0.2, None, 0.4), ("n", None, None, None)], ROUGE)
    cards = gate.build_scorecards(some.filter("model = 'm'"), judged)
    assert cards.first().rouge_average == 0.3
    assert gate.build_scorecards(some.select("model", "rougeL").filter("model = 'm'"), judged).first().rouge_average == 0.4
    with pytest.raises(Exception, match="no ROUGE metric"):
        gate.build_scorecards(some.filter("model = 'n'"), judged).collect()
    missing = spark.createDataFrame([("m", None, 1)], JUDGE)
    with pytest.raises(Exception, match="no overall average"):
        gate.build_scorecards(some.filter("model = 'm'"), missing).collect()


def test_golden_decisions(spark):
    champion = spark.createDataFrame([("f", 1, 0.556235)], CANDIDATES)
    worse = spark.createDataFrame([("f", 2, 0.395135)], CANDIDATES)
    got = gate.promotion_decision(champion, worse).first()
    assert (got.decision, got.margin, got.reason, got.threshold) == ("REJECTED", -0.1611, gate.COMPARED, 0.02)
    first = gate.promotion_decision(champion.limit(0), worse).first()
    assert (first.decision, first.margin, first.reason, first.champion) == ("PROMOTED", None, gate.NO_CHAMPION, None)
    assert first.timestamp_utc.endswith("+00:00")


def test_threshold_is_strict(spark):
    champion = spark.createDataFrame([("f", 1, 0.5)], CANDIDATES)
    entrants = spark.createDataFrame([("f", 2, 0.5 + 0.25), ("f", 3, 0.7500001)], CANDIDATES)
    got = gate.promotion_decision(champion, entrants, 0.25).orderBy("challenger.seq").collect()
    assert [r.decision for r in got] == ["REJECTED", "PROMOTED"]


def fold(rows, threshold, start):
    out, held = [], dict(start)
    for family, seq, score in sorted(rows):
        champion = held.get(family)
        promoted = champion is None or score > champion + threshold
        out.append((family, seq, champion, "PROMOTED" if promoted else "REJECTED"))
        if promoted:
            held[family] = score
    return out


@pytest.mark.parametrize("threshold", [0.0, 0.02, 0.3])
@pytest.mark.parametrize("step, start", [(1, {}), (10**12 + 7, {"b": 0.4, "z": 0.1})])
@pytest.mark.parametrize("shape", ["random", "rising", "equal"])
def test_history_equals_the_sequential_fold(spark, threshold, step, start, shape):
    rng = random.Random(f"{threshold}{step}{shape}")
    score = {"random": lambda i: round(rng.random(), 3), "rising": lambda i: i / 100, "equal": lambda i: 0.5}[shape]
    rows = [(f, i * step, score(i)) for f, n in (("a", 90), ("b", 30), ("c", 1)) for i in rng.sample(range(200), n)]
    champions = spark.createDataFrame([(f, 0, s) for f, s in start.items()], CANDIDATES) if start else None
    df = spark.createDataFrame(rows, CANDIDATES).repartition(3)
    got = gate.promotion_history(df, threshold, champions).collect()
    assert sorted((r.family, r.seq, r.champion_score, r.decision) for r in got) == fold(rows, threshold, start)


def test_very_many_promotions_take_a_logarithm_of_jobs(spark):
    """50,000 promotions of one family, ``seq`` a time stamp in microseconds."""
    n = 50_000
    df = spark.range(n).selectExpr("'f' as family", "id * 1000003 + 1700000000000000 as seq", "id * 1.0D as combined_score")
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("history", "")
    history = gate.promotion_history(df, 0.5)
    counts = {r.decision: r["count"] for r in history.groupBy("decision").count().collect()}
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert counts == {"PROMOTED": n}
    assert len(tracker.getJobIdsForGroup("history")) < 60 + 25 * 16


def test_negative_threshold_is_rejected(spark):
    with pytest.raises(ValueError):
        gate.promotion_history(spark.createDataFrame([("f", 1, 0.5)], CANDIDATES), -0.1)


def test_dry_run_writes_nothing_and_update_persists(spark):
    champions, log = fresh_dir(spark, "champions"), fresh_dir(spark, "log")

    def run(score, **options):
        entrant = spark.createDataFrame([("f", int(score * 100), score)], CANDIDATES)
        return promote(spark, entrant, champions, log, **options).first().decision

    assert run(0.5) == "PROMOTED" and versions(spark, champions) == [] and versions(spark, log) == []
    assert run(0.5, update=True) == "PROMOTED"
    assert run(0.51, update=True) == "REJECTED"
    assert run(0.6, update=True) == "PROMOTED"
    assert versions(spark, champions) == [0, 1, 2]
    assert read_version(spark, champions).first().combined_score == 0.6
    assert read_version(spark, champions, before=2).first().combined_score == 0.5
    assert spark.read.parquet(log).count() == 3


def test_evaluate_joins_rouge_and_judge(spark):
    pairs = spark.createDataFrame(
        [(i, "m", "the bill funds schools", "the bill funds schools") for i in range(20)],
        "id bigint, model string, reference_summary string, generated_summary string",
    )
    replies = pairs.select("id", "model", F.lit('{"relevance": 5, "factual": 5, "fluency": 5}').alias("raw_text"))
    assert evaluate(pairs, replies).first().combined_score == 1.0


def test_stream_over_several_batches_equals_the_batch(spark):
    rng = random.Random(3)
    rows = [(f, i, round(rng.random(), 4)) for i in range(120) for f in ("a", "b")]
    source, log, champions = (fresh_dir(spark, n) for n in ("candidates", "log", "champions"))
    checkpoint = fresh_dir(spark, "checkpoint")
    for start in (0, 80):
        chunk = [r for r in rows if start <= r[1] < start + 80]
        spark.createDataFrame(chunk, CANDIDATES).coalesce(1).write.mode("append").parquet(source)
        gate_stream(read_files(spark, source, CANDIDATES, max_files=1), log, champions, checkpoint).awaitTermination()
    columns = ("family", "seq", "champion_score", "decision")
    streamed = sorted(tuple(r) for r in spark.read.parquet(log).select(*columns).collect())
    assert streamed == fold(rows, gate.DEFAULT_THRESHOLD, {})
    batch = gate.current_champions(gate.promotion_history(spark.createDataFrame(rows, CANDIDATES)))
    assert sorted(map(tuple, read_version(spark, champions).collect())) == sorted(map(tuple, batch.collect()))
