"""Registered corpus-curation queries and their SQL counterparts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brevita.functions.templates import CHAT_ASSISTANT, CHAT_END, CHAT_SYSTEM, CHAT_USER, INSTRUCTION
from brevita.functions.text import near_dup_key, with_cleaned
from brevita.operators import curation, records, sampling
from brevita.plans.views import BILLS, bills_pool, bills_splits, duck
from brevita.session import fresh_dir, pin
from brevita.sources import published
from brevita.sources import records as store
from brevita.sources.tables import load_corpus, load_training_splits

# Sizes of the registered sample and splits: small enough that the smallest scale fills them. Only ``systematic_sample`` samples;
# all other queries work on the whole curated pool.
SAMPLE_SIZE = 250
TEST_SIZE = 20
VAL_SIZE = 30

ID = ("src_rank", "doc_id")


def _clean(spark: SparkSession, sf: str) -> DataFrame:
    return curation.clean_pool(bills_pool(spark, sf))


def curated(spark: SparkSession, sf: str) -> DataFrame:
    """Narrow curated pool, written once because sampling and splitting read it several times."""
    return pin(curation.curated_positions(bills_pool(spark, sf)))


def split_rows(spark: SparkSession, sf: str) -> DataFrame:
    return sampling.exact_split(sampling.length_deciles(curated(spark, sf)), TEST_SIZE, VAL_SIZE)


def lone_stratum(spark: SparkSession, sf: str) -> DataFrame:
    """The curated pool in two strata, one of them a single row, so that no draw can be stratified."""
    pool = curated(spark, sf)
    first = pool.agg(F.min("pool_pos")).scalar()
    return pool.withColumn("len_bucket", (F.col("pool_pos") == first).cast("int"))


def split_records(spark: SparkSession, sf: str) -> DataFrame:
    """Instruction records of the split rows with their ids; texts are attached last."""
    labelled = pin(split_rows(spark, sf).select("pool_pos", "split"))
    rows = curation.select_rows(bills_pool(spark, sf), labelled, curation.LengthBand())
    return records.instruction_records(rows, *ID, "split")


def corpus_pool(spark: SparkSession, sf: str) -> DataFrame:
    return curation.pool_splits(*bills_splits(spark, sf)).select(*ID, "text", "summary")


def loaded_corpus(spark: SparkSession, sf: str) -> DataFrame:
    """Both corpus splits stored and loaded by path."""
    paths = []
    for split in bills_splits(spark, sf):
        paths.append(fresh_dir(spark, "corpus"))
        split.write.parquet(paths[-1])
    return load_corpus(spark, *paths).select(*ID, "text", "summary")


def minimum_size(spark: SparkSession, sf: str) -> DataFrame:
    """The guard on the curated pool: passed with its own size, raised with one row more."""
    pool = curated(spark, sf)
    found = sampling.require_rows(pool, TEST_SIZE)
    try:
        sampling.require_rows(pool, found + 1)
        raised = False
    except sampling.NotEnoughExamples:
        raised = True
    return pool.agg(F.count("*").alias("n")).select(F.col("n"), F.lit(found).cast("bigint").alias("found"), F.lit(raised).alias("raised"))


def clean_text(spark: SparkSession, sf: str) -> DataFrame:
    return _clean(spark, sf).select(*ID, "text", "summary")


def near_dup_keys(spark: SparkSession, sf: str) -> DataFrame:
    pool = bills_pool(spark, sf).select("src_rank", "doc_id", "text")
    return with_cleaned(pool, ("text",)).select(*ID, near_dup_key(F.col("text")).alias("near_key"))


def quality_filter(spark: SparkSession, sf: str) -> DataFrame:
    return curation.quality_filter(_clean(spark, sf)).select(*ID, "text", "summary")


def length_filter(spark: SparkSession, sf: str) -> DataFrame:
    return curation.length_filter(_clean(spark, sf)).select(*ID, "text", "summary")


def length_report(spark: SparkSession, sf: str) -> DataFrame:
    return curation.length_report(_clean(spark, sf))


def near_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return curation.near_dedup(bills_pool(spark, sf)).select(*ID, "text", "summary")


def curated_pool(spark: SparkSession, sf: str) -> DataFrame:
    return curation.curated_positions(bills_pool(spark, sf)).drop("pool_pos")


def curation_funnel(spark: SparkSession, sf: str) -> DataFrame:
    return curation.curation_funnel(bills_pool(spark, sf))


def systematic_sample(spark: SparkSession, sf: str) -> DataFrame:
    return sampling.systematic_sample(curated(spark, sf), SAMPLE_SIZE).select(*ID, "text_len")


def length_deciles(spark: SparkSession, sf: str) -> DataFrame:
    return sampling.length_deciles(curated(spark, sf)).select(*ID, "text_len", "len_bucket")


def stratified_split(spark: SparkSession, sf: str) -> DataFrame:
    return split_rows(spark, sf).select(*ID, "len_bucket", "split")


def unstratified_split(spark: SparkSession, sf: str) -> DataFrame:
    """The fallback, set off by its data: both draws are made over the whole pool."""
    return sampling.exact_split(lone_stratum(spark, sf), TEST_SIZE, VAL_SIZE).select(*ID, "len_bucket", "split")


def split_allocation(spark: SparkSession, sf: str) -> DataFrame:
    return sampling.split_allocation(sampling.length_deciles(curated(spark, sf)), TEST_SIZE, VAL_SIZE)


def split_allocation_fallback(spark: SparkSession, sf: str) -> DataFrame:
    return sampling.split_allocation(lone_stratum(spark, sf), TEST_SIZE, VAL_SIZE)


def split_stats(spark: SparkSession, sf: str) -> DataFrame:
    stats = sampling.split_stats(split_rows(spark, sf))
    return stats.withColumns({c: F.round(c, 4) for c in ("avg_text_len", "avg_summary_len")})


def instruction_records(spark: SparkSession, sf: str) -> DataFrame:
    return records.instruction_records(_clean(spark, sf), *ID)


def chat_template(spark: SparkSession, sf: str) -> DataFrame:
    return records.chat_texts(records.instruction_records(_clean(spark, sf), *ID)).select(*ID, "text")


def jsonl_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    path = fresh_dir(spark, "jsonl")
    store.write_jsonl(split_records(spark, sf).drop(*ID), path)
    return store.read_jsonl(spark, path, store.RECORD_SCHEMA + ", split string")


def published_splits(spark: SparkSession, sf: str) -> DataFrame:
    path = fresh_dir(spark, "published")
    store.publish_splits(split_records(spark, sf), path)
    return spark.read.parquet(path).select("split", *ID, "instruction", "input", "output")


def materialize_splits(spark: SparkSession, sf: str) -> DataFrame:
    """The first call builds the splits, the second finds them and only reads."""
    path = fresh_dir(spark, "materialized")

    def build() -> DataFrame:
        return split_records(spark, sf).drop(*ID)

    store.ensure_splits(spark, path, build)
    kept, rebuilt = store.ensure_splits(spark, path, build)
    return kept.groupBy("split").agg(F.count("*").alias("n")).withColumn("rebuilt", F.lit(rebuilt))


def published_versions(spark: SparkSession, sf: str) -> DataFrame:
    """Two versions, each published twice, read by number and as the newest: rows by split, and what the second call wrote."""
    path = fresh_dir(spark, "versions")
    rows = pin(split_records(spark, sf).drop(*ID))
    steps = [published.publish_version(part, path) for part in (rows, rows, rows.filter("split <> 'val'"), rows.filter("split <> 'val'"))]
    shown = []
    for name, number, again in (("first", steps[0].number, steps[1]), ("newest", None, steps[3])):
        counted = published.read_published(spark, path, number).groupBy("split").agg(F.count("*").alias("n"))
        shown.append(counted.select(F.lit(name).alias("version"), "split", "n", F.lit(again.wrote_files or again.wrote_pointer).alias("written_again")))
    return shown[0].unionByName(shown[1])


def training_texts(spark: SparkSession, sf: str) -> DataFrame:
    """Chat texts of train and validation, from the published table because no local copy exists."""
    published = fresh_dir(spark, "published")
    store.publish_splits(split_records(spark, sf).drop(*ID), published)
    train, val = load_training_splits(spark, fresh_dir(spark, "absent"), published, store.RECORD_SCHEMA)
    both = train.withColumn("split", F.lit("train")).unionByName(val.withColumn("split", F.lit("validation")))
    return records.chat_texts(both).select("split", "text")


QUERIES = {
    "curation_funnel": curation_funnel,
    "corpus_pool": corpus_pool,
    "loaded_corpus": loaded_corpus,
    "minimum_size": minimum_size,
    "clean_text": clean_text,
    "near_dup_key": near_dup_keys,
    "quality_filter": quality_filter,
    "length_filter": length_filter,
    "length_report": length_report,
    "near_dedup": near_dedup,
    "curated_pool": curated_pool,
    "systematic_sample": systematic_sample,
    "length_deciles": length_deciles,
    "stratified_split": stratified_split,
    "unstratified_split": unstratified_split,
    "split_allocation": split_allocation,
    "split_allocation_fallback": split_allocation_fallback,
    "split_stats": split_stats,
    "instruction_records": instruction_records,
    "chat_template": chat_template,
    "jsonl_roundtrip": jsonl_roundtrip,
    "published_splits": published_splits,
    "materialize_splits": materialize_splits,
    "published_versions": published_versions,
    "training_texts": training_texts,
}


# --- SQL counterparts -------------------------------------------------------------------------------


def sql_text(value: str) -> str:
    """SQL string expression for a fixed text, newlines spelled as chr(10)."""
    return "('" + value.replace("'", "''").replace("\n", "' || chr(10) || '") + "')"


def _sql_clean(c: str) -> str:
    quoted = f"replace(replace(coalesce({c}, ''), chr(96) || chr(96), '\"'), chr(39) || chr(39), '\"')"
    # Fixed value: the header pattern of the cleaning rules.
    header = r"(?is)^\s*\d+[a-z]{2}\s+CONGRESS.*?(?:Session|SESSION)\s+\S+\s+"
    headless = f"(regexp_replace(substring({quoted}, 1, 400), '{header}', '') || substring({quoted}, 401))"
    return rf"trim(regexp_replace(regexp_replace({headless}, '\[Page\s+[A-Z0-9]+\]', '', 'g'), '\s+', ' ', 'g'))"


def _sql_order(seed: str, ident: str = "doc_id") -> str:
    return f"cast('0x' || substring(md5('{seed}:' || {ident}), 1, 15) as bigint)"


CLEANED = f"""bills as ({duck(BILLS)}),
cleaned as (select src_rank, doc_id, {_sql_clean("text")} as text, {_sql_clean("summary")} as summary from bills)"""

NEAR_KEY = "substring(regexp_replace(lower(substring(text, 1, 800)), '[^a-z0-9]', '', 'g'), 1, 500)"
VALID = "length(text) > 0 and length(summary) > 0 and length(summary) < length(text)"
IN_BAND = "length(text) between 1500 and 6000 and length(summary) between 200 and 1500"

DEDUPED = f"""{CLEANED},
firsts as (select * from (select *, row_number() over (partition by {NEAR_KEY} order by src_rank, doc_id) as nth
  from cleaned) k where nth = 1)"""

POOL = f"""{DEDUPED},
pool as (select src_rank, doc_id, cast(length(text) as int) as text_len, cast(length(summary) as int) as summary_len, text, summary
  from firsts where {VALID} and {IN_BAND})"""

SAMPLE = f"""{POOL},
placed as (select *, row_number() over (order by text_len, {_sql_order("length")}, src_rank, doc_id) - 1 as pos,
  count(*) over () as n from pool),
sample as (select * from placed where n <= {SAMPLE_SIZE}
  or pos in (select (i * (n - 1)) // {SAMPLE_SIZE - 1} from range({SAMPLE_SIZE}) t(i)))"""

DECILES = f"""{POOL},
edges as (select distinct unnest(quantile_cont(text_len, [0.0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0])) as e
  from pool),
bucketed as (select *, cast((select count(*) from edges where e < s.text_len and e > (select min(e) from edges)) as int) as len_bucket
  from pool s)"""


def _sql_allocation(counts: str, size: int, out: str) -> str:
    """Largest-remainder allocation of ``size`` over (len_bucket, n)."""
    return f"""{out} as (select len_bucket, n, base + case when row_number() over (order by rem desc, len_bucket)
    <= {size} - sum(base) over () then 1 else 0 end as take
  from (select len_bucket, n, (n * {size}) // sum(n) over () as base, (n * {size}) % sum(n) over () as rem
    from {counts}) a)"""


def _sql_split(stratum: str, rows: str = DECILES) -> str:
    return f"""{rows},
keyed as (select src_rank, doc_id, text_len, summary_len, text, summary, len_bucket as bucket_kept,
  {stratum} as len_bucket, {_sql_order("42")} as h from bucketed),
c1 as (select len_bucket, count(*) as n from keyed group by len_bucket),
{_sql_allocation("c1", TEST_SIZE, "a1")},
c2 as (select len_bucket, n - take as n from a1),
{_sql_allocation("c2", VAL_SIZE, "a2")},
labelled as (select k.* exclude (len_bucket, bucket_kept), k.bucket_kept as len_bucket,
  case when nth <= a1.take then 'test' when nth <= a1.take + a2.take then 'val' else 'train' end as split
  from (select *, row_number() over (partition by len_bucket order by h, src_rank, doc_id) as nth from keyed) k
  join a1 on a1.len_bucket = k.len_bucket join a2 on a2.len_bucket = k.len_bucket)"""


SPLIT = _sql_split("len_bucket")
LONE = _sql_split(
    "0",
    f"""{POOL},
bucketed as (select *, cast((src_rank, doc_id) = (select (src_rank, doc_id) from pool order by src_rank, doc_id limit 1) as int)
  as len_bucket from pool)""",
)
CHAT = (
    f"{sql_text(CHAT_SYSTEM + INSTRUCTION + CHAT_USER)} || text || {sql_text(CHAT_ASSISTANT)} || summary"
    f" || {sql_text(CHAT_END)}"
)

ORACLE = {
    "curation_funnel": f"""with {DEDUPED}
select (select count(*) from cleaned) as loaded, count(*) as deduplicated,
  count(*) filter ({VALID}) as valid, count(*) filter ({VALID} and {IN_BAND}) as in_band,
  (select count(*) from cleaned) - count(*) as duplicates_removed,
  round(100.0 * count(*) filter ({VALID} and {IN_BAND}) / count(*) filter ({VALID}), 1) as kept_pct
from firsts""",
    "corpus_pool": f"select src_rank, doc_id, text, summary from ({duck(BILLS)}) b",
    "loaded_corpus": f"select src_rank, doc_id, text, summary from ({duck(BILLS)}) b",
    "minimum_size": f"with {POOL} select count(*) as n, count(*) as found, true as raised from pool",
    "clean_text": f"with {CLEANED} select src_rank, doc_id, text, summary from cleaned",
    "near_dup_key": f"with {CLEANED} select src_rank, doc_id, {NEAR_KEY} as near_key from cleaned",
    "quality_filter": f"with {CLEANED} select src_rank, doc_id, text, summary from cleaned where {VALID}",
    "length_filter": f"with {CLEANED} select src_rank, doc_id, text, summary from cleaned where {IN_BAND}",
    "length_report": f"""with {CLEANED} select count(*) as initial, count(*) filter ({IN_BAND}) as kept,
  round(100.0 * count(*) filter ({IN_BAND}) / count(*), 1) as kept_pct from cleaned""",
    "near_dedup": f"with {DEDUPED} select src_rank, doc_id, text, summary from firsts",
    "curated_pool": f"with {POOL} select src_rank, doc_id, text_len, summary_len from pool",
    "systematic_sample": f"with {SAMPLE} select src_rank, doc_id, text_len from sample",
    "length_deciles": f"with {DECILES} select src_rank, doc_id, text_len, len_bucket from bucketed",
    "stratified_split": f"with {SPLIT} select src_rank, doc_id, len_bucket, split from labelled",
    "unstratified_split": f"with {LONE} select src_rank, doc_id, len_bucket, split from labelled",
    "split_allocation_fallback": f"""with {LONE} select len_bucket, count(*) as n, count(*) filter (split = 'test') as n_test,
  count(*) filter (split = 'val') as n_val, count(*) filter (split = 'train') as n_train from labelled group by len_bucket""",
    "split_allocation": f"""with {SPLIT} select len_bucket, n, cast(a1.take as bigint) as n_test,
  cast(a2.take as bigint) as n_val, cast(n - a1.take - a2.take as bigint) as n_train
from c1 join a1 using (len_bucket, n) join (select len_bucket, take from a2) a2 using (len_bucket)""",
    "split_stats": f"""with {SPLIT} select split, count(*) as n, round(avg(text_len), 4) as avg_text_len,
  round(avg(summary_len), 4) as avg_summary_len from labelled group by split""",
    "instruction_records": f"""with {CLEANED} select src_rank, doc_id, '{INSTRUCTION}' as instruction, text as input,
  summary as output from cleaned""",
    "chat_template": f"with {CLEANED} select src_rank, doc_id, {CHAT} as text from cleaned",
    "jsonl_roundtrip": f"""with {SPLIT} select '{INSTRUCTION}' as instruction, text as input, summary as output, split
from labelled""",
    "published_splits": f"""with {SPLIT} select case split when 'val' then 'validation' else split end as split,
  src_rank, doc_id, '{INSTRUCTION}' as instruction, text as input, summary as output from labelled""",
    "materialize_splits": f"with {SPLIT} select split, count(*) as n, false as rebuilt from labelled group by split",
    "published_versions": f"""with {SPLIT},
counted as (select case split when 'val' then 'validation' else split end as split, count(*) as n from labelled group by 1)
select 'first' as version, split, n, false as written_again from counted
union all select 'newest', split, n, false from counted where split <> 'validation'""",
    "training_texts": f"""with {SPLIT} select case split when 'val' then 'validation' else split end as split,
  {CHAT} as text from labelled where split <> 'test'""",
}
