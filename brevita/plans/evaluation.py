"""Registered evaluation queries and their SQL counterparts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brevita.functions.templates import JUDGE_PREDICTION, JUDGE_PROMPT, JUDGE_REFERENCE
from brevita.operators import curation, judge, resample, rouge
from brevita.plans.corpus import sql_text
from brevita.plans.stem_sql import stem_tables
from brevita.plans.views import DOCUMENT_PAIRS, JUDGE_RAW, REPLY_PAIRS, derived, duck, table
from brevita.session import fresh_dir, pin
from brevita.sources import records as store
from brevita.sources.bucketed import consecutive_turns, load_bucketed, store_bucketed
from brevita.sources.tables import load_predictions

# Digits at which figures of Spark and DuckDB are compared; the operators do not round.
DIGITS = 9
CORPUS_DIGITS = 6


def reply_pairs(spark: SparkSession, sf: str) -> DataFrame:
    return derived(spark, sf, REPLY_PAIRS)


def document_pairs(spark: SparkSession, sf: str) -> DataFrame:
    return derived(spark, sf, DOCUMENT_PAIRS)


def _rounded(scores: DataFrame, digits: int = DIGITS) -> DataFrame:
    exact = [c for c, kind in scores.dtypes if kind == "double"]
    return scores.withColumns({c: F.round(c, digits) for c in exact})


def rouge_n(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(rouge.rouge_n(document_pairs(spark, sf)))


def rouge_l(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(rouge.rouge_l(reply_pairs(spark, sf)))


def rouge_l_documents(spark: SparkSession, sf: str) -> DataFrame:
    """ROUGE-L of whole documents; too slow for SQL, checked against brute force in the tests."""
    return _rounded(rouge.rouge_l(document_pairs(spark, sf)))


def rouge_stemmed(spark: SparkSession, sf: str) -> DataFrame:
    """All three metrics with the stemmer, as the reference runs them."""
    return _rounded(rouge.rouge_scores(reply_pairs(spark, sf), stem=True))


def corpus_means(spark: SparkSession, sf: str) -> DataFrame:
    return rouge.rouge_corpus(rouge.rouge_scores(reply_pairs(spark, sf)))


def rouge_corpus(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(corpus_means(spark, sf), CORPUS_DIGITS)


def rouge_bootstrap(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(rouge.rouge_bootstrap(rouge.rouge_scores(reply_pairs(spark, sf))), CORPUS_DIGITS)


def extractive_overlap(spark: SparkSession, sf: str) -> DataFrame:
    """How far each document's stand-in summary is copied from it: whole texts on both sides."""
    pairs = document_pairs(spark, sf).withColumnsRenamed({"reference_summary": "text", "generated_summary": "summary"})
    return _rounded(curation.extractive_overlap(pairs))


def rouge_resample(spark: SparkSession, sf: str) -> DataFrame:
    """Intervals by exact resampling; its random numbers have no SQL form."""
    return _rounded(resample.bootstrap_interval(rouge.rouge_scores(reply_pairs(spark, sf))), CORPUS_DIGITS)


def rouge_replicates(spark: SparkSession, sf: str) -> DataFrame:
    """What is fixed about the replicates: how many there are, how many rows each draws, and that they spread around the mean."""
    scores = pin(rouge.rouge_scores(reply_pairs(spark, sf)))
    found = resample.resampled(scores).withColumn("x", F.col("rouge1") / F.col("draws"))
    spread = found.groupBy("model").agg(
        F.count("*").alias("replicates"), F.min("draws").alias("fewest"), F.max("draws").alias("most"), F.min("x").alias("low"), F.max("x").alias("high")
    )
    mean = F.col("rouge1").between(F.col("low"), F.col("high")).alias("spread_around_mean")
    return spread.join(rouge.rouge_corpus(scores), "model").select("model", "num_examples", "replicates", "fewest", "most", mean)


def judge_raw(spark: SparkSession, sf: str) -> DataFrame:
    return derived(spark, sf, JUDGE_RAW)


def judge_sample(spark: SparkSession, sf: str) -> DataFrame:
    return judge.judge_sample(reply_pairs(spark, sf)).select("id", "reference_summary", "generated_summary")


def judge_messages(spark: SparkSession, sf: str) -> DataFrame:
    return judge.judge_messages(reply_pairs(spark, sf))


def judge_parse(spark: SparkSession, sf: str) -> DataFrame:
    parsed = judge.parse_replies(judge_raw(spark, sf))
    return parsed.select(
        "id",
        "model",
        F.col("scores").isNotNull().alias("parsed"),
        "error",
        F.try_variant_get("scores", "$.relevance_reasoning", "string").alias("relevance_reasoning"),
    )


def judge_scores_typed(spark: SparkSession, sf: str) -> DataFrame:
    typed = judge.typed_scores(judge.parse_replies(judge_raw(spark, sf)))
    return typed.select("id", "model", *judge.CRITERIA)


def judged_examples(spark: SparkSession, sf: str) -> DataFrame:
    parsed = judge.parse_replies(judge_raw(spark, sf))
    return judge.judged_examples(derived(spark, sf, DOCUMENT_PAIRS), parsed)


def judged_by_bucket(spark: SparkSession, sf: str) -> DataFrame:
    """Judged examples from two tables stored in buckets by id: whole texts meet without a shuffle."""
    pairs = store_bucketed(derived(spark, sf, DOCUMENT_PAIRS), "id")
    replies = store_bucketed(judge_raw(spark, sf), "id")
    parsed = judge.parse_replies(load_bucketed(spark, replies))
    return judge.judged_examples(load_bucketed(spark, pairs), parsed.hint("merge"))


def reply_turns(spark: SparkSession, sf: str) -> DataFrame:
    """Assistant turns with the turn before them, by one window over blocks of turns."""
    return consecutive_turns(table(spark, sf, "conversations"))


def judge_summary(spark: SparkSession, sf: str) -> DataFrame:
    return judge.judge_summary(judge.typed_scores(judge.parse_replies(judge_raw(spark, sf))))


def judge_summary_clean(spark: SparkSession, sf: str) -> DataFrame:
    typed = judge.typed_scores(judge.parse_replies(judge_raw(spark, sf)))
    return judge.judge_summary(typed, drop_errors=True)


def judge_results_file(spark: SparkSession, sf: str) -> DataFrame:
    """Judged examples written as records and read back with the stored schema."""
    path = fresh_dir(spark, "judged")
    store.write_jsonl(judged_examples(spark, sf), path, by=None)
    kept = store.read_jsonl(spark, path, store.JUDGE_RESULT_SCHEMA)
    return kept.agg(
        F.count("*").alias("examples"),
        F.count("error").alias("errors"),
        *[F.sum(c).alias(c) for c in judge.CRITERIA],
    )


def stored_predictions(spark: SparkSession, sf: str) -> DataFrame:
    """Prediction pairs stored with more columns than needed, and read by path."""
    path = fresh_dir(spark, "predictions")
    reply_pairs(spark, sf).withColumn("more", F.lit(1)).write.parquet(path)
    return load_predictions(spark, path)


def judge_results_array(spark: SparkSession, sf: str) -> DataFrame:
    """Judged examples stored as JSON arrays, a file of some hundred each, and read back."""
    path = fresh_dir(spark, "judged-arrays")
    rows = judged_examples(spark, sf)
    some = F.col("id") - F.col("id") % 256
    arrays = rows.groupBy(some.alias("part")).agg(F.to_json(F.collect_list(F.struct(*rows.columns)), {"ignoreNullFields": "false"}).alias("value"))
    # One file for each part of 256 ids.
    arrays.repartition("part").write.partitionBy("part").text(path)
    kept = store.read_json_array(spark, path, store.JUDGE_RESULT_SCHEMA)
    return kept.select("id", "reference_summary", "error", *judge.CRITERIA)


QUERIES = {
    "stored_predictions": stored_predictions,
    "judge_results_array": judge_results_array,
    "rouge_n": rouge_n,
    "rouge_l": rouge_l,
    "rouge_l_documents": rouge_l_documents,
    "rouge_stemmed": rouge_stemmed,
    "rouge_corpus": rouge_corpus,
    "rouge_bootstrap": rouge_bootstrap,
    "extractive_overlap": extractive_overlap,
    "rouge_resample": rouge_resample,
    "rouge_replicates": rouge_replicates,
    "judge_sample": judge_sample,
    "judge_messages": judge_messages,
    "judge_parse": judge_parse,
    "judge_scores_typed": judge_scores_typed,
    "judged_examples": judged_examples,
    "judged_by_bucket": judged_by_bucket,
    "reply_turns": reply_turns,
    "judge_summary": judge_summary,
    "judge_summary_clean": judge_summary_clean,
    "judge_results_file": judge_results_file,
}


# --- SQL counterparts -------------------------------------------------------------------------------


def _tokens(c: str) -> str:
    return (
        f"list_filter(string_split(trim(regexp_replace(lower({c}), '[^a-z0-9]+', ' ', 'g')), ' '), lambda x: x <> '')"
    )


def _pairs(view: str) -> str:
    return f"""pairs as ({duck(view)}),
toks as (select id, model, {_tokens("reference_summary")} as r, {_tokens("generated_summary")} as g from pairs)"""


def _stemmed_pairs(view: str) -> str:
    """As ``_pairs``, with each distinct word stemmed once."""
    return f"""pairs as ({duck(view)}),
plain as (select id, model, {_tokens("reference_summary")} as r, {_tokens("generated_summary")} as g from pairs),
vocabulary as (select distinct unnest(list_concat(r, g)) as w0 from plain),
{stem_tables("vocabulary")},
placed as (select id, 'r' as side, unnest(r) as w0, unnest(range(1, len(r) + 1)) as place from plain
  union all select id, 'g', unnest(g), unnest(range(1, len(g) + 1)) from plain),
spelled as (select id, list(w order by place) filter (side = 'r') as r, list(w order by place) filter (side = 'g') as g
  from placed join stems using (w0) group by id),
toks as (select plain.id, model, coalesce(spelled.r, plain.r) as r, coalesce(spelled.g, plain.g) as g from plain left join spelled using (id))"""


def _ngrams(view: str) -> str:
    return _grams(_pairs(view))


def _grams(pairs: str) -> str:
    """Clipped overlap and n-gram counts by exploding and grouping, one row per id and n."""
    return f"""{pairs},
sides as (select id, 'r' as side, r as t from toks union all select id, 'g', g from toks),
words as (select id, side, t, unnest(range(1, len(t) + 1)) as i from sides),
grams as (select id, side, 1 as n, t[i] as gram from words
  union all select id, side, 2, t[i] || ' ' || t[i + 1] from words where i < len(t)),
per_gram as (select id, n, gram, count(*) filter (side = 'r') as cr, count(*) filter (side = 'g') as cg
  from grams group by id, n, gram),
per_pair as (select id, n, sum(least(cr, cg)) as hits, sum(cr) as nr, sum(cg) as ng from per_gram group by id, n),
counts as (select toks.id, toks.model,
  {", ".join(f"cast(coalesce(max({c}) filter (n = {n}), 0) as bigint) as {name}_{n}"
             for n in (1, 2) for c, name in (("nr", "ref"), ("ng", "gen"), ("hits", "hits")))}
  from toks left join per_pair on per_pair.id = toks.id group by toks.id, toks.model)"""


def _ratio(hits: str, n: str) -> str:
    return f"(case when {n} > 0 then {hits} / cast({n} as double) else 0.0 end)"


def _f1(hits: str, gen: str, ref: str) -> str:
    p, r = _ratio(hits, gen), _ratio(hits, ref)
    return f"(case when {hits} > 0 then 2 * {p} * {r} / ({p} + {r}) else 0.0 end)"


# The recurrence row over the shorter reference, one step per token of the reply. A row is the running
# maximum of (match ? previous[j-1] + 1 : previous[j]).
LCS = """lcs(id, i, dp) as (
  select id, 0, list_transform(range(len(r) + 1), lambda x: cast(0 as bigint)) from toks
  union all
  select l.id, l.i + 1, list_reduce(
      list_transform(l.dp, lambda x, j: [case when j > 1 and t.r[j - 1] = t.g[l.i + 1] then l.dp[j - 1] + 1 else x end]),
      lambda a, b: list_append(a, greatest(a[len(a)], b[1])))
  from lcs l join toks t on t.id = l.id where l.i < len(t.g)),
lcs_len as (select l.id, l.dp[len(l.dp)] as lcs from lcs l join toks t on t.id = l.id where l.i = len(t.g))"""



def _scores(pairs: str) -> str:
    return f"""{_grams(pairs)},
{LCS},
scores as (select c.id, c.model, {_f1("hits_1", "gen_1", "ref_1")} as rouge1, {_f1("hits_2", "gen_2", "ref_2")} as rouge2,
  {_f1("lcs", "gen_1", "ref_1")} as "rougeL" from counts c join lcs_len on lcs_len.id = c.id)"""


SCORES = _scores(_pairs(REPLY_PAIRS))


def _word(start: int) -> str:
    return f"cast('0x' || substring(md5('42:' || id), {start}, 8) as bigint) % {rouge.PRIME}"


_WEIGHT = " + ".join(f"(case when u >= {step} then 1 else 0 end)" for step in rouge.POISSON_STEPS)
_BOUNDS = {"low": 0.025, "mid": 0.5, "high": 0.975}

REPLIES = rf"""raw as ({duck(JUDGE_RAW)}),
stripped as (select id, model, regexp_replace(raw_text, '^\s+|\s+$', '', 'g') as t from raw),
opened as (select id, model, starts_with(t, '```') as fenced,
  case when not starts_with(t, '```') then t when instr(t, chr(10)) > 0 then substring(t, instr(t, chr(10)) + 1)
    else '' end as t from stripped),
closed as (select id, model, case when fenced and ends_with(t, '```')
  then regexp_replace(t, '\n[^\n]*$', '') else t end as t from opened),
parsed as (select id, model, t, json_valid(t) and coalesce(json_type(case when json_valid(t) then t end), '') = 'OBJECT'
  as ok from closed)"""


def _value(key: str, missing: str) -> str:
    kind = f"json_type(case when ok then t end, '$.{key}')"
    text = f"json_extract_string(case when ok then t end, '$.{key}')"
    return f"""case when {kind} is null then {missing} when {kind} = 'NULL' then null
    when {kind} = 'VARCHAR' then case when regexp_matches({text}, '^\\s*[+-]?\\d+\\s*$') then cast(trim({text}) as bigint) end
    when {kind} = 'BOOLEAN' then case when {text} = 'true' then 1 else 0 end
    when {kind} in ('BIGINT', 'UBIGINT', 'DOUBLE') then cast(trunc(cast({text} as double)) as bigint) end"""


TYPED = f"""{REPLIES},
typed as (select id, model, ok, {", ".join(f"cast({_value(c, '0')} as bigint) as {c}" for c in judge.CRITERIA)} from parsed)"""


def sql_judge_summary(where: str = "true") -> str:
    reached = "relevance is not null"
    sums = [f"sum(relevance) filter ({reached}) as s1"]
    for k, c in ((2, "factual"), (3, "fluency")):
        reached += f" and {c} is not null"
        sums.append(f"sum({c}) filter ({reached}) as s{k}")
    return f"""{TYPED},
sums as (select model, {", ".join(sums)}, count(*) filter ({reached}) as num_examples from typed where {where} group by model),
means as (select model, round_even(s1 / cast(num_examples as double), 3) as mean_relevance,
  round_even(s2 / cast(num_examples as double), 3) as mean_factual,
  round_even(s3 / cast(num_examples as double), 3) as mean_fluency, num_examples from sums),
judge_summary as (select model, mean_relevance, mean_factual, mean_fluency,
  round_even((mean_relevance + mean_factual + mean_fluency) / 3, 3) as overall_average, num_examples from means)"""


CORPUS_ROUGE = f"""{SCORES},
rouge_corpus as (select model, count(*) as num_examples, avg(rouge1) as rouge1, avg(rouge2) as rouge2, avg("rougeL") as "rougeL"
  from scores group by model)"""

JUDGED = f"""{REPLIES},
pairs as ({duck(DOCUMENT_PAIRS)}),
judged as (select pairs.id, reference_summary, generated_summary, case when not ok then t end as error,
  {", ".join(f"cast({_value(c, 'null')} as bigint) as {c}" for c in judge.CRITERIA)},
  {", ".join(f"json_extract_string(case when ok then t end, '$.{r}') as {r}" for r in judge.REASONS)}
  from pairs left join parsed on parsed.id = pairs.id)"""

# Runs of equal tokens by diagonals, the longest at each place of the summary, then one recursion step for each fragment or lone token.
FRAGMENTS = f"""with recursive {_pairs(DOCUMENT_PAIRS)},
t as (select id, unnest(r) as w, unnest(range(1, len(r) + 1)) as j from toks),
s as (select id, unnest(g) as w, unnest(range(1, len(g) + 1)) as i from toks),
met as (select s.id, i, j, i - row_number() over (partition by s.id, i - j order by i) as run from s join t on s.id = t.id and s.w = t.w),
runs as (select id, i, max(i) over (partition by id, i - j, run) - i + 1 as k from met),
best as (select id, i, max(k) as k from runs group by id, i),
steps as (select s.id, s.i, coalesce(k, 0) as k from s left join best using (id, i)),
walk as (select * from steps where i = 1
  union all select n.id, n.i, n.k from walk w join steps n on n.id = w.id and n.i = w.i + greatest(w.k, 1)),
sums as (select id, count(*) filter (k > 0) as fragments, sum(k) as covered, sum(k * k) as squares, max(k) as longest from walk group by id),
words as (select id, model, len(r) as nt, len(g) as ns, len(list_intersect(list_distinct(r), list_distinct(g))) as both_,
  len(list_distinct(list_concat(r, g))) as every from toks)"""

ORACLE = {
    "extractive_overlap": f"""{FRAGMENTS}
select id, model, nt as text_tokens, ns as summary_tokens, coalesce(fragments, 0) as fragments, cast(coalesce(covered, 0) as bigint) as covered,
  cast(coalesce(longest, 0) as bigint) as longest, round(case when ns > 0 then coalesce(covered, 0) / cast(ns as double) else 0.0 end, {DIGITS}) as coverage,
  round(case when ns > 0 then coalesce(squares, 0) / cast(ns as double) else 0.0 end, {DIGITS}) as density,
  round(case when every > 0 then both_ / cast(every as double) else 0.0 end, {DIGITS}) as jaccard
from words left join sums using (id)""",
    "rouge_replicates": f"""with pairs as ({duck(REPLY_PAIRS)})
select model, count(*) as num_examples, cast({rouge.REPLICATES} as bigint) as replicates, count(*) as fewest, count(*) as most,
  true as spread_around_mean from pairs group by model""",
    "stored_predictions": f"select id, model, reference_summary, generated_summary from ({duck(REPLY_PAIRS)}) p",
    "judge_results_array": f"""with {JUDGED} select id, reference_summary, error,
  {", ".join(f"cast({c} as int) as {c}" for c in judge.CRITERIA)} from judged""",
    "rouge_n": f"""with {_ngrams(DOCUMENT_PAIRS)}
select id, model, ref_1, gen_1, hits_1, ref_2, gen_2, hits_2, {", ".join(
        f"round({_ratio(f'hits_{n}', f'gen_{n}')}, {DIGITS}) as rouge{n}_p, "
        f"round({_ratio(f'hits_{n}', f'ref_{n}')}, {DIGITS}) as rouge{n}_r, "
        f"round({_f1(f'hits_{n}', f'gen_{n}', f'ref_{n}')}, {DIGITS}) as rouge{n}_f" for n in (1, 2))}
from counts""",
    "rouge_l": f"""with recursive {_pairs(REPLY_PAIRS)}, {LCS}
select t.id, t.model, cast(len(t.r) as bigint) as ref_1, cast(len(t.g) as bigint) as gen_1, lcs,
  round({_ratio("lcs", "len(t.g)")}, {DIGITS}) as "rougeL_p", round({_ratio("lcs", "len(t.r)")}, {DIGITS}) as "rougeL_r",
  round({_f1("lcs", "len(t.g)", "len(t.r)")}, {DIGITS}) as "rougeL_f"
from toks t join lcs_len on lcs_len.id = t.id""",
    "rouge_stemmed": f"""with recursive {_scores(_stemmed_pairs(REPLY_PAIRS))}
select id, model, {", ".join(f'round("{m}", {DIGITS}) as "{m}"' for m in rouge.METRICS)} from scores""",
    "rouge_corpus": f"""with recursive {CORPUS_ROUGE} select model, num_examples,
  {", ".join(f'round("{m}", {CORPUS_DIGITS}) as "{m}"' for m in rouge.METRICS)} from rouge_corpus""",
    "rouge_bootstrap": f"""with recursive {SCORES},
halves as (select *, {_word(1)} as a, {_word(9)} as b from scores),
drawn as (select *, (a * rep + b) % {rouge.PRIME} as u from halves, range(1, {rouge.REPLICATES} + 1) reps(rep)),
weighted as (select *, {_WEIGHT} as w from drawn),
sums as (select model, rep, {", ".join(f'sum(w * "{m}") / sum(w) as "{m}"' for m in rouge.METRICS)} from weighted
  group by model, rep having sum(w) > 0)
select model, {", ".join(f'round(quantile_cont("{m}", {q}), 6) as "{m}_{part}"'
                          for m in rouge.METRICS for part, q in _BOUNDS.items())}
from sums group by model""",
    "judge_sample": f"""select id, reference_summary, generated_summary from ({duck(REPLY_PAIRS)}) p
order by id limit {judge.MAX_EXAMPLES}""",
    "judge_messages": f"""select id, {sql_text(JUDGE_PROMPT)} as system_prompt,
  {sql_text(JUDGE_REFERENCE)} || reference_summary || {sql_text(JUDGE_PREDICTION)} || generated_summary as user_message
from ({duck(REPLY_PAIRS)}) p""",
    "judge_parse": f"""with {REPLIES} select id, model, ok as parsed, case when not ok then t end as error,
  json_extract_string(case when ok then t end, '$.relevance_reasoning') as relevance_reasoning from parsed""",
    "judge_scores_typed": f"with {TYPED} select id, model, relevance, factual, fluency from typed",
    "judged_examples": f"with {JUDGED} select * from judged",
    "judge_summary": f"with {sql_judge_summary()} select * from judge_summary",
    "judge_summary_clean": f"with {sql_judge_summary('ok')} select * from judge_summary",
    "judge_results_file": f"""with {JUDGED} select count(*) as examples, count(error) as errors,
  {", ".join(f"cast(sum({c}) as bigint) as {c}" for c in judge.CRITERIA)} from judged""",
}
ORACLE["judged_by_bucket"] = ORACLE["judged_examples"]
ORACLE["reply_turns"] = """select a.conv_id, a.turn, q.text as asked, a.text as answered
from conversations a join conversations q on q.conv_id = a.conv_id and q.turn = a.turn - 1 where a.role = 'assistant'"""
