"""The corpus pipeline: quality, line dedup, near-dedup, decontamination, mixing.

Each stage takes (spark, docs, sf_dir) and returns what it keeps; all but the last return the columns of ``documents``. A stage works on
all rows that its predecessor kept. Stages handle nulls, empty texts, repeated rows and empty tables as their operators say; very long texts are
judged whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from brevita.llm import contamination, lines, mixing, neardup, quality
from brevita.llm.common import WORD, prepare, table
from brevita.session import pin

# The operators' models and hashes have no counterpart in SQL; the tests compare the stages with brute force.
ORACLE_SQL = None


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on the labelled ones among them, does not reject."""
    model = quality.train(docs, table(prepare(spark), sf_dir, "labels"))
    return quality.score(docs, model, keep=docs.columns).filter(F.col("score") >= quality.THRESHOLD).select("row.*")


def _has_words() -> Column:
    return F.coalesce("text", F.lit("")).rlike(WORD)


def cut_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages of two or more lines that occur before; ``n_chars`` is that of the new text. Texts that had words and have none left go;
    those that never had any stay."""
    prepare(spark)
    cut = lines.remove_repeated_chunks(docs)
    chars = F.when(F.col("_n_removed") > 0, F.length("text").cast("bigint")).otherwise(F.col("n_chars"))
    # Only passages with words are cut, so a cut text had some.
    return cut.filter((F.col("_n_removed") == 0) | _has_words()).withColumn("n_chars", chars).select(docs.columns)


def keep_one_of_a_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near-duplicates: five words to a shingle, similarity 0.8 or more.

    It is the row with the smallest id, nulls last, then the smallest hash of the text; of rows equal in both the one with the smallest hash of
    all columns. Texts without words are in no group and stay.
    """
    prepare(spark)
    found = neardup.near_duplicates(docs).filter("component is not null")
    key = F.struct(F.col("doc_id").isNull().alias("no"), "doc_id", "text_hash")
    # Narrow: one row for each key, with the times it occurs.
    keys = pin(found.groupBy("component", "doc_id", "text_hash").agg(F.count("*").alias("times")))
    best = keys.groupBy(F.col("component").alias("_of")).agg(F.min(key).alias("best"), F.count("*").alias("n")).filter("n > 1")
    named = [F.col("doc_id").alias("_doc"), F.col("text_hash").alias("_hash")]
    gone = pin(keys.join(best, F.col("component") == F.col("_of")).filter(~key.eqNullSafe(F.col("best"))).select(*named))
    same = F.col("doc_id").eqNullSafe(F.col("_doc")) & F.xxhash64("text").eqNullSafe(F.col("_hash"))
    left = docs.join(gone, same, "left_anti")
    # Rows of one id and text: each map task sends one of them at most.
    several = pin(keys.filter("times > 1").select(*named).join(gone.select(F.col("_doc").alias("_d"), F.col("_hash").alias("_h")),
        F.col("_doc").eqNullSafe(F.col("_d")) & F.col("_hash").eqNullSafe(F.col("_h")), "left_anti"))
    row = F.struct(*docs.columns).alias("_row")
    one = left.join(several, same).select("_doc", "_hash", row, F.xxhash64(*docs.columns).alias("_rest"))
    one = one.groupBy("_doc", "_hash").agg(F.min_by("_row", "_rest").alias("_row")).select("_row.*")
    return left.join(several, same, "left_anti").unionByName(one)


def keep_clean_of_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of ten consecutive words of a benchmark item."""
    found = contamination.contaminated(docs, table(prepare(spark), sf_dir, "benchmark"), keep=docs.columns)
    return found.filter("n_hit = 0").select("row.*")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix takes, with the number of copies: doc_id, source, size, source_size, target, copies, taken."""
    prepare(spark)
    return mixing.mix(docs).filter("copies > 0")


STAGES = [
    ("quality", keep_quality),
    ("line_dedup", cut_lines),
    ("near_dedup", keep_one_of_a_group),
    ("decontamination", keep_clean_of_benchmark),
    ("mixing", mix_sources),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder before the next reads it."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = pin(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
