"""Inputs of the registered queries, derived by Spark from the given tables.

The tables hold no legislative headers, summaries, judge replies or request logs, so these views
derive them from every row of ``documents``, ``events`` and ``conversations``. The SQL strings state
the same derivations for DuckDB.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brevita.functions.keys import pool_position

# Schema of the event stream, stated because a file stream does not infer one.
EVENTS = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"


TABLES = ("documents", "events", "conversations")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


BILLS = """
select doc_id, cast(doc_id % 3 = 2 as int) as src_rank,
  concat(case when doc_id % 5 = 0 then concat('108th CONGRESS', chr(10), '  1st Session  H. R. 1 ') else '' end,
         case when doc_id % 7 = 0 then concat(chr(96), chr(96), 'quoted', chr(39), chr(39), ' [Page H12] ') else '' end,
         text) as text,
  case when doc_id % 17 = 0 then ''
       when doc_id % 19 = 0 then concat(text, ' end')
       else substring(text, 1, cast(floor(length(text) / 5) as int)) end as summary
from {documents}
"""

# Replies about every document: the reasoning holds its whole text, escaped as JSON wants it, and the scores are counted from it.
JUDGE_RAW = """
select doc_id as id, concat('m', cast(doc_id % 3 as {string})) as model,
  case doc_id % 10
    when 0 then concat('```json', chr(10), j, chr(10), '```')
    when 1 then concat('```', chr(10), j, chr(10), '```')
    when 2 then concat('```json', chr(10), j, '```')
    when 3 then concat('  ', j, chr(10))
    when 4 then concat('I cannot rate this: ', text)
    when 5 then substring(j, 1, cast(length(j) - 2 as int))
    when 6 then concat('{{"relevance": "', cast(1 + length(text) % 5 as {string}), '", "factual": 4.7, "fluency": true, "relevance_reasoning": "', escaped, '"}}')
    when 7 then '{{"relevance": 4, "factual": null, "fluency": 2}}'
    when 8 then concat('{{"relevance": 5, "factual": ', cast(1 + length(escaped) % 5 as {string}), '}}')
    else j end as raw_text
from (select doc_id, text, escaped, concat('{{"relevance": ', cast(1 + length(text) % 5 as {string}),
        ', "factual": ', cast(1 + length(replace(text, 'e', '')) % 5 as {string}),
        ', "fluency": ', cast(1 + length(replace(text, ' ', '')) % 5 as {string}),
        ', "relevance_reasoning": "', escaped, '"}}') as j
      from (select doc_id, text, replace(replace(replace(text, chr(92), concat(chr(92), chr(92))), chr(34), concat(chr(92), chr(34))),
              chr(10), concat(chr(92), 'n')) as escaped from {documents}) e) d
"""

INFERENCE_LOGS = """
select cast(event_id as {string}) as request_id, cast(ts as timestamp) as timestamp_utc, value * 10 as latency_ms,
  cast(500 + event_id % 5500 as int) as input_length, cast(100 + event_id % 900 as int) as output_length,
  case when event_type = 'error' then 'error' when event_id % 97 = 0 then null else 'success' end as status,
  concat('v', cast(user_id % 4 as {string})) as model_version, 'repo' as model_repo, 'file' as model_filename,
  case when event_type = 'error' then 'Inference failed' end as error_message
from {events}
"""

CANDIDATES = """
select event_type as family, event_id as seq, round(value / 500, 6) as combined_score from {events}
"""

# Each assistant turn is scored against the turn before it: whole texts, one pair per reply. Ids are unique for turns below 2^20.
REPLY_PAIRS = """
select a.conv_id * 1048576 + a.turn as id, concat('m', cast(a.conv_id % 3 as {string})) as model,
  q.text as reference_summary, a.text as generated_summary
from {conversations} a join {conversations} q on q.conv_id = a.conv_id and q.turn = a.turn - 1
where a.role = 'assistant'
"""

# Whole documents against themselves with their halves exchanged, their beginning repeated, and words of seven or more characters
# left out: neither side holds all of the other.
DOCUMENT_PAIRS = """
select doc_id as id, concat('m', cast(doc_id % 3 as {string})) as model, text as reference_summary,
  case when doc_id % 13 = 0 then '' else regexp_replace(
    concat(substring(text, 1 + cast(floor(length(text) / 2) as int)), ' ', substring(text, 1, cast(floor(length(text) / 2) as int)),
      ' ', substring(text, 1, 200)), '[^ ]{{7,}}', ''{flags}) end as generated_summary
from {documents}
"""

REQUESTS = """
select doc_id as request_no, case when doc_id % 11 = 0 then '' when doc_id % 23 = 0 then ' ' else text end as text,
  case when doc_id % 4 = 0 then null else cast(doc_id % 1400 as int) end as max_new_tokens
from {documents}
"""

_DUCK_NAMES = {
    "string": "varchar",
    "flags": ", 'g'",
    "documents": "documents",
    "events": "events",
    "conversations": "conversations",
}


def duck(view: str) -> str:
    """The view's text for DuckDB, where the tables are registered by name."""
    return view.format(**_DUCK_NAMES).strip()


def derived(spark: SparkSession, sf_dir: str, view: str) -> DataFrame:
    """The view as a DataFrame over the tables below ``sf_dir``."""
    tables = {name: table(spark, sf_dir, name) for name in TABLES if "{" + name + "}" in view}
    text = view.replace("{string}", "string").replace("{flags}", "")
    return spark.sql(text, **tables)


def bills_pool(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The bills view as a pool: it already holds both corpus splits under their rank."""
    return derived(spark, sf_dir, BILLS).withColumn("pool_pos", pool_position(F.col("src_rank"), F.col("doc_id")))


def bills_splits(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The two corpus splits of the bills view as separate tables."""
    bills = derived(spark, sf_dir, BILLS)
    return bills.filter(F.col("src_rank") == 0), bills.filter(F.col("src_rank") == 1)
