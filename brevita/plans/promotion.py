"""Registered promotion-gate queries and their SQL counterparts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brevita.operators import gate
from brevita.plans.evaluation import CORPUS_DIGITS, CORPUS_ROUGE, corpus_means, judge_summary, sql_judge_summary
from brevita.plans.views import CANDIDATES, EVENTS, derived, duck
from brevita.plans.jobs import promote
from brevita.session import fresh_dir, pin
from brevita.sources import records as store
from brevita.streaming.champions import champion_timeline, read_timeline, write_timeline
from brevita.streaming.gate import gate_stream
from brevita.streaming.logs import read_files

DECIDED_AT = "2024-02-01T00:00:00+00:00"


def scorecards(spark: SparkSession, sf: str) -> DataFrame:
    return gate.build_scorecards(corpus_means(spark, sf).drop("num_examples"), judge_summary(spark, sf))


def scorecard(spark: SparkSession, sf: str) -> DataFrame:
    return scorecards(spark, sf).select(
        "model",
        "rouge_average",
        "gemini_average",
        "combined_score",
        F.round("raw.rouge.rouge1", CORPUS_DIGITS).alias("rouge1"),
        F.col("raw.gemini.overall_average").alias("overall_average"),
    )


def candidates(spark: SparkSession, sf: str) -> DataFrame:
    return derived(spark, sf, CANDIDATES)


def decisions(spark: SparkSession, sf: str) -> DataFrame:
    """All candidates against each family's first one; ``signup`` has no champion yet."""
    rows = candidates(spark, sf)
    first = rows.filter(F.col("family") != "signup").groupBy("family").agg(
        F.min("seq").alias("seq"), F.min_by("combined_score", "seq").alias("combined_score")
    )
    return gate.promotion_decision(first, rows, decided_at=F.lit(DECIDED_AT))


def _flat(decided: DataFrame) -> DataFrame:
    return decided.select(
        "family",
        "timestamp_utc",
        "decision",
        "reason",
        "threshold",
        "margin",
        F.col("champion.combined_score").alias("champion_score"),
        F.col("challenger.seq").alias("seq"),
        F.col("challenger.combined_score").alias("challenger_score"),
    )


def promotion_decision(spark: SparkSession, sf: str) -> DataFrame:
    return _flat(decisions(spark, sf))


def promotion_log(spark: SparkSession, sf: str) -> DataFrame:
    """Decisions appended to a log of JSON lines and read back with their nested schema."""
    path = fresh_dir(spark, "decisions")
    decided = decisions(spark, sf)
    store.append_decisions(decided.filter(F.col("champion").isNull()), path)
    store.append_decisions(decided.filter(F.col("champion").isNotNull()), path)
    return _flat(spark.read.schema(decided.schema).json(path))


def history(spark: SparkSession, sf: str) -> DataFrame:
    return gate.promotion_history(candidates(spark, sf))


def champion_table(spark: SparkSession, sf: str) -> DataFrame:
    path = fresh_dir(spark, "champions")
    store.write_version(gate.current_champions(history(spark, sf)), path, 0)
    return store.read_version(spark, path)


def stream_promotion(spark: SparkSession, sf: str) -> DataFrame:
    """The history as a stream; every decision it logged."""
    log_path, champions = fresh_dir(spark, "gate-log"), fresh_dir(spark, "gate-champions")
    gate_stream(_event_candidates(spark, sf), log_path, champions, fresh_dir(spark, "gate-checkpoint")).awaitTermination()
    return spark.read.parquet(log_path).drop("version")


def _event_candidates(spark: SparkSession, sf: str) -> DataFrame:
    return read_files(spark, f"{sf}/events.parquet", EVENTS).select(
        F.col("event_type").alias("family"),
        F.col("event_id").alias("seq"),
        F.round(F.col("value") / 500, 6).alias("combined_score"),
    )


def _timeline(spark: SparkSession, sf: str) -> DataFrame:
    """Promotions that a stream with champions in its state store has found."""
    path = fresh_dir(spark, "timeline")
    write_timeline(champion_timeline(_event_candidates(spark, sf)), path, fresh_dir(spark, "timeline-state")).awaitTermination()
    return read_timeline(spark, path)


def stream_champions(spark: SparkSession, sf: str) -> DataFrame:
    """All decisions by the timeline that the keyed state has emitted."""
    return gate.decisions_by_timeline(candidates(spark, sf), _timeline(spark, sf))


def stream_timeline(spark: SparkSession, sf: str) -> DataFrame:
    return _timeline(spark, sf).drop("event")


def promotion_chain(spark: SparkSession, sf: str) -> DataFrame:
    """Scorecards of all models through two promotions and a dry run; what the log, the dry run and the champion table hold."""
    champions, log = fresh_dir(spark, "champions"), fresh_dir(spark, "decisions")
    cards = pin(scorecards(spark, sf).withColumn("family", F.col("model")))
    lower = lambda by: F.round(F.col("combined_score") - by, 6)
    at = F.lit(DECIDED_AT)
    promote(spark, cards.withColumn("combined_score", lower(0.05)), champions, log, update=True, decided_at=at)
    promote(spark, cards, champions, log, update=True, decided_at=at)
    dry = promote(spark, cards.withColumn("combined_score", lower(0.01)), champions, log, decided_at=at)
    shown = [
        "family",
        "decision",
        "reason",
        "margin",
        F.col("champion.combined_score").alias("champion_score"),
        F.col("champion.raw.gemini.num_examples").alias("champion_examples"),
        F.col("challenger.combined_score").alias("challenger_score"),
        F.col("challenger.rouge_average").alias("challenger_rouge"),
    ]
    logged = spark.read.parquet(log).select(F.concat(F.lit("log "), "version").alias("step"), *shown)
    held = store.read_version(spark, champions).select(
        F.lit("champion").alias("step"),
        "family",
        F.col("combined_score").alias("champion_score"),
        F.col("raw.gemini.num_examples").alias("champion_examples"),
        F.col("rouge_average").alias("challenger_rouge"),
    )
    return logged.unionByName(dry.select(F.lit("dry run").alias("step"), *shown)).unionByName(held, allowMissingColumns=True)


QUERIES = {
    "scorecard": scorecard,
    "promotion_chain": promotion_chain,
    "promotion_decision": promotion_decision,
    "promotion_log": promotion_log,
    "promotion_history": history,
    "champion_table": champion_table,
    "stream_promotion": stream_promotion,
    "stream_champions": stream_champions,
    "stream_timeline": stream_timeline,
}


# --- SQL counterparts -------------------------------------------------------------------------------

THRESHOLD = gate.DEFAULT_THRESHOLD


def _outcome(champion: str, challenger: str) -> str:
    return f"""case when {champion} is null or {challenger} > {champion} + cast({THRESHOLD} as double) then 'PROMOTED'
    else 'REJECTED' end as decision,
  case when {champion} is null then '{gate.NO_CHAMPION}' else '{gate.COMPARED}' end as reason,
  cast({THRESHOLD} as double) as threshold, round_even({challenger} - {champion}, 6) as margin"""


DECISION = f"""with candidates as ({duck(CANDIDATES)}),
champions as (select family, arg_min(combined_score, seq) as champion_score from candidates where family <> 'signup'
  group by family)
select c.family, '{DECIDED_AT}' as timestamp_utc, {_outcome("champion_score", "combined_score")}, champion_score, seq,
  combined_score as challenger_score
from candidates c left join champions h on h.family = c.family"""

# One recursion step per candidate of each family.
HISTORY = f"""with recursive candidates as (select family, seq, combined_score,
  row_number() over (partition by family order by seq) as nth from ({duck(CANDIDATES)}) c),
fold as (
  select family, nth, seq, combined_score, cast(null as double) as champion_score from candidates where nth = 1
  union all
  select c.family, c.nth, c.seq, c.combined_score,
    case when f.champion_score is null or f.combined_score > f.champion_score + cast({THRESHOLD} as double)
      then f.combined_score else f.champion_score end
  from fold f join candidates c on c.family = f.family and c.nth = f.nth + 1),
history as (select family, seq, combined_score, champion_score, {_outcome("champion_score", "combined_score")} from fold)"""

CARDS = f"""with recursive {CORPUS_ROUGE},
{sql_judge_summary()},
parts as (select model, rouge1, overall_average, j.num_examples, (rouge1 + rouge2 + "rougeL") / 3 as r, overall_average / 5.0 as j
  from rouge_corpus join judge_summary j using (model)),
cards as (select *, round_even(r, 6) as rouge_average, round_even(j, 6) as gemini_average,
  round_even(0.5 * r + 0.5 * j, 6) as combined_score from parts),
rounded as (select model, num_examples, rouge_average as r6, combined_score as c from cards)"""


def _chain(champion: str, challenger: str) -> str:
    return f"""case when {champion} is null or {challenger} > {champion} + cast({THRESHOLD} as double) then 'PROMOTED'
    else 'REJECTED' end as decision,
  case when {champion} is null then '{gate.NO_CHAMPION}' else '{gate.COMPARED}' end as reason,
  round_even({challenger} - {champion}, 6) as margin"""


ORACLE = {
    "scorecard": f"""{CARDS}
select model, rouge_average, gemini_average, combined_score, round(rouge1, {CORPUS_DIGITS}) as rouge1, overall_average from cards""",
    "promotion_chain": f"""{CARDS},
steps as (select 'log 0' as step, model as family, num_examples, r6, null as champion, round(c - 0.05, 6) as challenger from rounded
  union all select 'log 1', model, num_examples, r6, round(c - 0.05, 6), c from rounded
  union all select 'dry run', model, num_examples, r6, c, round(c - 0.01, 6) from rounded)
select step, family, {_chain("champion", "challenger")}, champion as champion_score,
  case when champion is not null then num_examples end as champion_examples, challenger as challenger_score,
  r6 as challenger_rouge from steps
union all
select 'champion', model, null, null, null, c, num_examples, null, r6 from rounded""",
    "promotion_decision": DECISION,
    "promotion_log": DECISION,
    "promotion_history": f"{HISTORY} select * from history",
    "champion_table": f"""{HISTORY} select family, max(seq) as seq, arg_max(combined_score, seq) as combined_score
from history where decision = 'PROMOTED' group by family""",
    "stream_promotion": f"{HISTORY} select * from history",
    "stream_champions": f"{HISTORY} select * from history",
    "stream_timeline": f"{HISTORY} select family, seq, combined_score, champion_score from history where decision = 'PROMOTED'",
}
