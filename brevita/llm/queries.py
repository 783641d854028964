"""The registered queries of this folder: each applies its operator to the whole table with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brevita.llm import alignment, contamination, fingerprints, langid, lines, mixing, neardup, phrases, quality, secret_scan, substrings, topk, warc
from brevita.llm.common import crc_remainder, prepare, table
from brevita.session import fresh_dir, pin


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(prepare(spark), sf_dir, "documents")
    return mixing.mix(docs).select("doc_id", "size", "source_size", "target", "taken")


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(prepare(spark), sf_dir, "documents")
    model = secret_scan.fit(secret_scan.labelled_strings(docs))
    base, added = F.col("base"), F.col("all")
    return secret_scan.scan(docs, model).select(
        "doc_id",
        *[secret_scan.count_of(base, kind).alias(f"n_{kind}") for kind in secret_scan.KINDS[:3]],
        F.sha2(secret_scan.written(base), 256).alias("base_sha256"),
        secret_scan.written(added).alias("spans"),
    )


def op3_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(prepare(spark), sf_dir, "documents")
    return neardup.near_duplicates(docs, width=2).select("doc_id", "n_shingles", "component_id", "kept")


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(prepare(spark), sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = quality.train(docs, labels.filter(crc_remainder(F.col("doc_id"), 5) != 0))
    return quality.score(docs, model).select(
        "row.doc_id",
        F.coalesce(crc_remainder(F.col("row.doc_id"), 5) == 0, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= quality.THRESHOLD).cast("int").alias("predicted"),
    )


def op5_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(prepare(spark), sf_dir, "documents")
    net = langid.train(docs.filter(crc_remainder(F.col("doc_id"), 4) != 2))
    return langid.predict(docs, net).select(
        "row.doc_id",
        F.coalesce(crc_remainder(F.col("row.doc_id"), 4) == 2, F.lit(False)).alias("held_out"),
        "lang_pred",
        "score",
    )


def op6_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(prepare(spark), sf_dir, "documents")
    cut = substrings.remove_repeats(docs, texts=False)
    return cut.select("row.doc_id", "n_words", "n_removed", "kept_sha256")


def op7_contamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, benchmark = table(prepare(spark), sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return contamination.contaminated(docs, benchmark).select(
        "row.doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = fresh_dir(prepare(spark), "warc")
    # Smaller than the defaults, which suit tables of terabytes.
    warc.write_warc(table(spark, sf_dir, "pages"), folder, shard_bytes=16 << 20, file_bytes=4 << 20)
    return warc.read_warc(spark, folder).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op9_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(prepare(spark), sf_dir, "embeddings").select("vec_id", topk.quantised(F.col("embedding")).alias("q"))
    return topk.top_k(vectors, F.col("vec_id") % 100 == 0).select("query_id", "rank", "vec_id", "score")


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(prepare(spark), sf_dir, "documents").select("doc_id", "text")
    return lines.remove_repeated_chunks(docs).select(
        "doc_id",
        F.col("_n_lines").alias("n_lines"),
        F.col("_n_removed").alias("n_removed"),
        F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"),
    )


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(prepare(spark), sf_dir, "documents")
    digest = F.when(F.col("n_a") > 0, F.sha2("groups", 256)).otherwise("")
    aligned = pin(alignment.align(docs).withColumn("digest", digest).drop("groups"))
    scored = alignment.score_links(aligned, pin(alignment.link_counts(aligned)))
    return scored.select("row.doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", F.col("digest").alias("groups_sha256"))


def op12_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = fingerprints.compare_with_next(table(prepare(spark), sf_dir, "documents"))
    return found.select("row.doc_id", *found.columns[1:])


def op13_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(prepare(spark), sf_dir, "documents"))


QUERIES = {
    "op1_mixing": op1_mixing,
    "op2_secret_scan": op2_secret_scan,
    "op3_neardup": op3_neardup,
    "op4_quality": op4_quality,
    "op5_langid": op5_langid,
    "op6_substrings": op6_substrings,
    "op7_contamination": op7_contamination,
    "op8_warc": op8_warc,
    "op9_topk": op9_topk,
    "op10_line_dedup": op10_line_dedup,
    "op11_alignment": op11_alignment,
    "op12_fingerprints": op12_fingerprints,
    "op13_phrases": op13_phrases,
}
ORACLE = {
    "op13_phrases": r"""
with p as (
  select coalesce(lang, 'und') as lang, doc_id,
    unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[.,;:!?\x0A-\x0D]')) as piece
  from documents),
w as (select lang, regexp_extract_all(piece, '[^\x20\x09]+') as w from p),
g as (
  select lang, unnest(list_concat(
    w, list_transform(range(1, len(w)), lambda i: array_to_string(w[i:i+1], ' ')),
    list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i+2], ' ')))) as phrase
  from w),
f as (select lang, phrase, string_split(phrase, ' ') as w, count(*)::hugeint as f from g group by all),
n as (select lang, sum(len(w))::bigint as n from w group by lang),
longer as (select lang, w, f from f where len(w) = 3 and f >= 10),
inside as (
  select lang, phrase, max(f) as longest from (
    select lang, unnest([array_to_string(w[1:2], ' '), array_to_string(w[2:3], ' ')]) as phrase, f from longer)
  group by all),
c as (
  select f.lang, f.phrase, f.w, f.f as a from f left join inside i on f.lang = i.lang and f.phrase = i.phrase
  where len(f.w) > 1 and f.f >= 10 and coalesce(100 * longest < 50 * f.f, true)),
cuts as (select *, unnest(range(1, len(w))) as k from c),
scored as (
  select c.lang, c.phrase, c.a, c.k, l.f as l, r.f as r, (1000000 * c.a * c.a) // (l.f * r.f) as score
  from cuts c join f l on c.lang = l.lang and l.phrase = array_to_string(c.w[1:c.k], ' ')
  join f r on c.lang = r.lang and r.phrase = array_to_string(c.w[c.k + 1:], ' ')),
best as (select *, row_number() over (partition by lang, phrase order by score, k) as nth from scored),
ranked as (
  select *, row_number() over (partition by lang order by score desc, a desc, phrase) as rank from best where nth = 1)
select r.lang, rank, phrase, a::bigint as a, l::bigint as l, r::bigint as r, n, score::bigint as score
from ranked r join n on r.lang = n.lang where rank <= 2000
""",
    "op9_topk": """
with v as (
  select vec_id, list_transform(embedding, lambda x: floor(1024 * x::double)::bigint) as q
  from embeddings
  where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
s as (
  select a.vec_id as query_id, b.vec_id, list_sum(list_transform(list_zip(a.q, b.q), lambda p: p[1] * p[2]))::bigint as score
  from v a join v b on a.vec_id <> b.vec_id where a.vec_id % 100 = 0),
r as (
  select query_id, row_number() over (partition by query_id order by score desc, vec_id) as rank, vec_id, score from s)
select query_id, rank::integer as rank, vec_id, score from r where rank <= 10
""",
    "op8_warc": """
with p as (
  select page_id, octet_length(encode(coalesce(html, ''))) as payload_bytes, sha256(coalesce(html, '')) as payload_digest
  from pages),
f as (
  select *, case when payload_bytes >= 100 then min(page_id) over (partition by payload_digest) else page_id end as first_id
  from p)
select page_id, payload_bytes, payload_digest,
  case when first_id = page_id then 'response' else 'revisit' end as record_type,
  case when first_id <> page_id then first_id end as refers_to
from f
""",
}
