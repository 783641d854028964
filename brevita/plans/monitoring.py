"""Registered request, log and stream queries and their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brevita.functions.templates import CHAT_ASSISTANT, CHAT_SYSTEM, CHAT_USER, INSTRUCTION
from brevita.operators import logs, records, summaries
from brevita.operators.generate import batch_generate as run_generator
from brevita.operators.generate import batch_generate_lists as run_lists
from brevita.plans.corpus import sql_text
from brevita.plans.views import EVENTS, INFERENCE_LOGS, REQUESTS, derived, duck
from brevita.session import fresh_dir, pin
from brevita.sources.records import append_logs
from brevita.streaming.live import read_live, write_live
from brevita.streaming.logs import ingest_logs, read_files, write_hourly_kpis
from brevita.streaming.retries import ingest_once, read_log

MODEL_REPO = "models/summariser"
MODEL_FILE = "weights.gguf"
LONG_WORD = 7
# Range of hours of the query over summaries.
SINCE, UNTIL = "2024-01-03 05:00:00", "2024-01-24 17:00:00"


def requests(spark: SparkSession, sf: str) -> DataFrame:
    return derived(spark, sf, REQUESTS)


def inference_logs(spark: SparkSession, sf: str) -> DataFrame:
    return derived(spark, sf, INFERENCE_LOGS)


def _hour_text(hours: DataFrame, column: str = "hour") -> DataFrame:
    return hours.withColumn(column, F.date_format(column, "yyyy-MM-dd HH:mm:ss"))


def long_words() -> Callable[[str, int], str]:
    """Stand-in for a model: the long words of the prompt's user text, up to the token budget."""

    def generate(prompt: str, max_tokens: int) -> str:
        text = prompt.split(CHAT_USER, 1)[1].rsplit(CHAT_ASSISTANT, 1)[0]
        return " ".join([w for w in text.split() if len(w) >= LONG_WORD][:max_tokens])

    return generate


def request_validation(spark: SparkSession, sf: str) -> DataFrame:
    return records.validate_requests(requests(spark, sf)).drop("text")


def inference_prompt(spark: SparkSession, sf: str) -> DataFrame:
    return records.with_prompt(requests(spark, sf)).select("request_no", "prompt")


def generated(spark: SparkSession, sf: str) -> DataFrame:
    accepted = records.validate_requests(requests(spark, sf)).filter("valid")
    return run_generator(records.with_prompt(accepted), long_words)


def batch_generate(spark: SparkSession, sf: str) -> DataFrame:
    """Everything the slot returns but the measured latency."""
    return generated(spark, sf).drop("latency_ms")


def long_words_of_lists() -> Callable[[list[str], list[int]], list[str]]:
    one = long_words()
    return lambda prompts, budgets: [one(p, n) for p, n in zip(prompts, budgets, strict=True)]


def batch_generate_lists(spark: SparkSession, sf: str) -> DataFrame:
    """The same answers from a generator that takes lists."""
    accepted = records.validate_requests(requests(spark, sf)).filter("valid")
    return run_lists(records.with_prompt(accepted), long_words_of_lists).drop("latency_ms")


def log_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Log rows of served requests; the answer's stand-in is the request text between brackets."""
    served = requests(spark, sf).select(
        "request_no", "text", F.concat(F.lit("["), "text", F.lit("]")).alias("summary"), (F.length("text") * 0.5).alias("latency_ms")
    )
    rows = records.log_rows(served, MODEL_REPO, MODEL_FILE, timestamp=F.lit("2024-01-01").cast("timestamp"))
    return rows.drop("timestamp_utc")


def recent_requests(spark: SparkSession, sf: str) -> DataFrame:
    return _hour_text(logs.recent_requests(inference_logs(spark, sf)), "timestamp_utc")


def recent_from_log(spark: SparkSession, sf: str) -> DataFrame:
    """The same from a log in folders by run and day; a run that is repeated leaves one copy of its rows."""
    path = fresh_dir(spark, "request-log")
    rows = inference_logs(spark, sf)
    even = F.col("request_id").cast("bigint") % 2 == 0
    for run, part in (("even", rows.filter(even)), ("odd", rows.filter(~even)), ("even", rows.filter(even))):
        append_logs(part, path, run)
    return _hour_text(logs.recent_requests(spark.read.parquet(path)), "timestamp_utc")


def latency_trend(spark: SparkSession, sf: str) -> DataFrame:
    return _hour_text(logs.latency_trend(inference_logs(spark, sf)), "timestamp_utc")


def _rounded(kpis: DataFrame) -> DataFrame:
    """Figures as they are compared with SQL; the operators do not round."""
    return kpis.withColumns({c: F.round(c, 6) for c, kind in kpis.dtypes if kind == "double"})


def latency_kpis(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(logs.latency_kpis(inference_logs(spark, sf)))


def latency_kpis_recent(spark: SparkSession, sf: str) -> DataFrame:
    """The dashboard's own figures, over its newest 1,000 rows."""
    return _rounded(logs.latency_kpis(logs.recent_requests(inference_logs(spark, sf))))


def latency_kpis_by_model(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(logs.latency_kpis(inference_logs(spark, sf), by="model_version"))


def requests_by_hour(spark: SparkSession, sf: str) -> DataFrame:
    return _hour_text(logs.requests_by_hour(inference_logs(spark, sf)))


def _event_logs(events: DataFrame) -> DataFrame:
    """Log rows of a request event; also valid on a stream."""
    value = F.col("value") * 10
    return events.select(
        F.col("ts").cast("timestamp").alias("timestamp_utc"),
        records.request_key(F.col("event_id")).alias("request_id"),
        value.alias("latency_ms"),
        (500 + F.col("event_id") % 5500).cast("int").alias("input_length"),
        (100 + F.col("event_id") % 900).cast("int").alias("output_length"),
        F.when(F.col("event_type") == "error", "error")
        .when(F.col("event_id") % 97 == 0, F.lit(None))
        .otherwise("success")
        .alias("status"),
        F.concat(F.lit("v"), (F.col("user_id") % 4).cast("string")).alias("model_version"),
        F.lit("repo").alias("model_repo"),
        F.lit("file").alias("model_filename"),
        F.when(F.col("event_type") == "error", "Inference failed").alias("error_message"),
    )


def _log_stream(spark: SparkSession, sf: str) -> DataFrame:
    return _event_logs(read_files(spark, f"{sf}/events.parquet", EVENTS))


def stream_log_ingest(spark: SparkSession, sf: str) -> DataFrame:
    path = fresh_dir(spark, "log")
    ingest_logs(_log_stream(spark, sf), path, fresh_dir(spark, "log-checkpoint")).awaitTermination()
    stored = spark.read.parquet(path).select(*records.LOG_COLUMNS)
    return _hour_text(stored, "timestamp_utc")


def stream_hourly_kpis(spark: SparkSession, sf: str) -> DataFrame:
    """Hours the watermark has closed; the last open ones come with later data."""
    path = fresh_dir(spark, "kpis")
    stream = write_hourly_kpis(_log_stream(spark, sf), path, fresh_dir(spark, "kpi-checkpoint"), refresh=None)
    stream.awaitTermination()
    kpis = spark.read.parquet(path)
    return _hour_text(kpis.withColumns({c: F.round(c, 6) for c in ("avg_latency_ms", "success_pct")}))


def _within(rows: DataFrame, kpis: DataFrame, name: str, q: float) -> DataFrame:
    """(model_version, name_within): whether the share of latencies below the estimate, or up to it, reaches the wanted one within twice the stated error."""
    estimate, x = F.col(name), F.col("latency_ms")
    counted = rows.join(kpis.select(F.col("model_version").alias("m"), name), F.col("model_version").eqNullSafe(F.col("m")))
    n, slack = F.count(x), 2 * summaries.RANK_ERROR
    inside = (F.count_if(x < estimate) / n <= q + slack) & (F.count_if(x <= estimate) / n >= q - slack)
    return counted.groupBy(F.col("model_version").alias("m")).agg(inside.alias(f"{name[:3]}_within"))


def kpis_from_summaries(spark: SparkSession, sf: str) -> DataFrame:
    """KPIs of a range of hours merged from kept summaries, and whether the estimated percentiles lie within the stated error of the exact ranks."""
    path, rows = fresh_dir(spark, "summaries"), inference_logs(spark, sf)
    even = F.col("request_id").cast("bigint") % 2 == 0
    for run, part in (("even", rows.filter(even)), ("odd", rows.filter(~even)), ("even", rows.filter(even))):
        summaries.write_summaries(summaries.hourly_summaries(part), path, run)
    kpis = pin(summaries.merged_kpis(summaries.read_summaries(spark, path, SINCE, UNTIL), "model_version"))
    ranged = rows.filter((F.col("timestamp_utc") >= F.lit(SINCE).cast("timestamp")) & (F.col("timestamp_utc") < F.lit(UNTIL).cast("timestamp")))
    shown = kpis.drop(*logs.PERCENTILES)
    for name, q in logs.PERCENTILES.items():
        shown = shown.join(_within(ranged, kpis, name, q), F.col("model_version").eqNullSafe(F.col("m"))).drop("m")
    return _rounded(shown)


def stream_live_hours(spark: SparkSession, sf: str) -> DataFrame:
    """Requests of every hour and model from the live table, open hours too, hours without requests as 0."""
    path = fresh_dir(spark, "live")
    write_live(_log_stream(spark, sf), path, fresh_dir(spark, "live-state"), refresh=None).awaitTermination()
    return _hour_text(summaries.filled_hours(read_live(spark, path)))


def stream_once(spark: SparkSession, sf: str) -> DataFrame:
    """The whole log with every request once, after all of it has come twice: the second time as one late batch."""
    path, state, source = (fresh_dir(spark, n) for n in ("once", "once-state", "once-source"))
    rows = _event_logs(derived(spark, sf, "select * from {events}"))
    for _ in range(2):
        rows.write.mode("append").parquet(source)
        stream = spark.readStream.schema(rows.schema).parquet(source)
        ingest_once(stream, path, state).awaitTermination()
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema)
    return _hour_text(read_log(spark, path, schema).select(*records.LOG_COLUMNS), "timestamp_utc")


QUERIES = {
    "request_validation": request_validation,
    "inference_prompt": inference_prompt,
    "batch_generate": batch_generate,
    "batch_generate_lists": batch_generate_lists,
    "log_rows": log_rows,
    "recent_requests": recent_requests,
    "recent_from_log": recent_from_log,
    "latency_trend": latency_trend,
    "latency_kpis": latency_kpis,
    "latency_kpis_recent": latency_kpis_recent,
    "latency_kpis_by_model": latency_kpis_by_model,
    "requests_by_hour": requests_by_hour,
    "stream_log_ingest": stream_log_ingest,
    "stream_hourly_kpis": stream_hourly_kpis,
    "kpis_from_summaries": kpis_from_summaries,
    "stream_live_hours": stream_live_hours,
    "stream_once": stream_once,
}


# --- SQL counterparts -------------------------------------------------------------------------------

LOGS = f"logs as ({duck(INFERENCE_LOGS)})"
RECENT = f"{LOGS}, recent as (select * from logs order by timestamp_utc desc, request_id limit {logs.RECENT_ROWS})"
TIME = "strftime({}, '%Y-%m-%d %H:%M:%S')"


def _kpis(source: str, by: str | None = None) -> str:
    key = f"{by}, " if by else ""
    tail = f" group by {by}" if by else ""
    return f"""select {key}count(*) as requests, round(avg(latency_ms), 6) as avg_latency_ms,
  round(quantile_cont(latency_ms, 0.5), 6) as p50_latency_ms, round(quantile_cont(latency_ms, 0.95), 6) as p95_latency_ms,
  round(avg(case when status = 'success' then 1.0 else 0.0 end) * 100, 6) as success_pct from {source}{tail}"""


REQUEST_PROMPT = (
    f"{sql_text(CHAT_SYSTEM + INSTRUCTION + CHAT_USER)} || "
    rf"regexp_replace(text, '^\s+|\s+$', '', 'g')"
    f" || {sql_text(CHAT_ASSISTANT)}"
)
REASON = f"""case when text is null then 'text is missing' when length(text) < 1 then 'text is empty'
  when max_new_tokens < {records.MIN_NEW_TOKENS} then 'max_new_tokens is below {records.MIN_NEW_TOKENS}'
  when max_new_tokens > {records.MAX_NEW_TOKENS} then 'max_new_tokens is above {records.MAX_NEW_TOKENS}' end"""
BUDGET = f"coalesce(max_new_tokens, {records.DEFAULT_MAX_TOKENS})"
LOG_LIST = ", ".join(c for c in records.LOG_COLUMNS if c != "timestamp_utc")
HOUR = TIME.format("date_trunc('hour', timestamp_utc)")

ORACLE = {
    "request_validation": f"""select request_no, max_new_tokens, {BUDGET} as max_tokens, {REASON} is null as valid,
  {REASON} as reject_reason from ({duck(REQUESTS)}) r""",
    "inference_prompt": f"select request_no, {REQUEST_PROMPT} as prompt from ({duck(REQUESTS)}) r",
    "batch_generate": rf"""with accepted as (select request_no, text, {BUDGET} as budget from ({duck(REQUESTS)}) r
  where {REASON} is null),
answers as (select request_no, text, array_to_string(list_filter(string_split(regexp_replace(text, '\s+', ' ', 'g'), ' '),
  lambda w: length(w) >= {LONG_WORD})[1:budget], ' ') as summary from accepted)
select request_no, summary, cast(length(text) as int) as input_length, cast(length(summary) as int) as output_length,
  'success' as status, cast(null as varchar) as error_message from answers""",
    "log_rows": f"""select sha256(cast(request_no as varchar)) as request_id,
  cast(length(text) * 0.5 as double) as latency_ms, cast(length(text) as int) as input_length,
  cast(length('[' || text || ']') as int) as output_length, 'success' as status, '{MODEL_REPO}/{MODEL_FILE}' as model_version,
  '{MODEL_REPO}' as model_repo, '{MODEL_FILE}' as model_filename, cast(null as varchar) as error_message
from ({duck(REQUESTS)}) r""",
    "recent_requests": f"with {RECENT} select {TIME.format('timestamp_utc')} as timestamp_utc, {LOG_LIST} from recent",
    "recent_from_log": f"with {RECENT} select {TIME.format('timestamp_utc')} as timestamp_utc, {LOG_LIST} from recent",
    "latency_trend": f"""with {RECENT} select {TIME.format('timestamp_utc')} as timestamp_utc, request_id, latency_ms
from recent""",
    "latency_kpis": f"with {LOGS} {_kpis('logs')}",
    "latency_kpis_recent": f"with {RECENT} {_kpis('recent')}",
    "latency_kpis_by_model": f"with {LOGS} {_kpis('logs', 'model_version')}",
    "requests_by_hour": f"""with {LOGS}, counts as (select date_trunc('hour', timestamp_utc) as h, count(*) as n
  from logs group by 1),
hours as (select unnest(generate_series(min(h), max(h), interval 1 hour)) as h from counts)
select {TIME.format('hours.h')} as hour, coalesce(n, 0) as requests from hours left join counts on counts.h = hours.h""",
    "kpis_from_summaries": f"""with {LOGS}
select model_version, count(*) as requests, round(avg(latency_ms), 6) as avg_latency_ms, round(max(latency_ms), 6) as max_latency_ms,
  round(avg(case when status = 'success' then 1.0 else 0.0 end) * 100, 6) as success_pct, true as p50_within, true as p95_within
from logs where timestamp_utc >= timestamp '{SINCE}' and timestamp_utc < timestamp '{UNTIL}' group by model_version""",
    "stream_live_hours": f"""with {LOGS},
counts as (select model_version, date_trunc('hour', timestamp_utc) as h, count(*) as n from logs group by all),
hours as (select model_version, unnest(generate_series(min(h), max(h), interval 1 hour)) as h from counts group by model_version)
select {TIME.format('hours.h')} as hour, model_version, coalesce(n, 0) as requests
from hours left join counts using (model_version, h)""",
    "stream_log_ingest": f"""with {LOGS} select {TIME.format('timestamp_utc')} as timestamp_utc,
  {LOG_LIST.replace('request_id', 'sha256(request_id) as request_id')} from logs""",
    "stream_hourly_kpis": f"""with {LOGS}
select {HOUR} as hour, model_version, count(*) as requests, round(avg(latency_ms), 6) as avg_latency_ms,
  list_sort(list(latency_ms))[cast(greatest(1, ceil(0.5 * count(latency_ms))) as bigint)] as p50_latency_ms,
  list_sort(list(latency_ms))[cast(greatest(1, ceil(0.95 * count(latency_ms))) as bigint)] as p95_latency_ms,
  round(avg(case when status = 'success' then 1.0 else 0.0 end) * 100, 6) as success_pct
from logs group by date_trunc('hour', timestamp_utc), model_version
having date_trunc('hour', timestamp_utc) + interval 1 hour
  <= (select max(timestamp_utc) - interval 10 minute from logs)""",
}
ORACLE["batch_generate_lists"] = ORACLE["batch_generate"]
ORACLE["stream_once"] = ORACLE["stream_log_ingest"]
