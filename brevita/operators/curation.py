"""Corpus curation: pooling, keep-first deduplication, quality and length gates, the stage funnel.

The order of work follows from size. Everything that compares rows runs on a narrow table of
(position, digest, two lengths); full texts are read again only for the rows that are kept.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brevita.functions.fragments import FRAGMENTS, fragment_counts
from brevita.functions.keys import document_id, pool_position, split_rank
from brevita.functions.text import key_digest, near_dup_key, with_cleaned
from brevita.functions.tokens import normalised
from brevita.session import pin


@dataclass(frozen=True)
class LengthBand:
    """Inclusive character bounds; the defaults are the reference sizes."""

    min_text: int = 1500
    max_text: int = 6000
    min_summary: int = 200
    max_summary: int = 1500

    def holds(self, text_len: Column, summary_len: Column) -> Column:
        return text_len.between(self.min_text, self.max_text) & summary_len.between(
            self.min_summary, self.max_summary
        )

    def may_hold(self, raw_text_len: Column, raw_summary_len: Column) -> Column:
        """Necessary test on uncleaned lengths: cleaning never lengthens a text."""
        return (raw_text_len >= self.min_text) & (raw_summary_len >= self.min_summary)


def pool_splits(*splits: DataFrame) -> DataFrame:
    """Bag union of corpus splits with a position that orders them split by split."""
    ranked = [s.drop("src_rank").withColumn("src_rank", F.lit(k)) for k, s in enumerate(splits)]
    pool = ranked[0]
    for other in ranked[1:]:
        pool = pool.unionByName(other)
    return pool.withColumn("pool_pos", pool_position(F.col("src_rank"), F.col("doc_id")))


def clean_pool(pool: DataFrame) -> DataFrame:
    return with_cleaned(pool)


def is_valid(text_len: Column, summary_len: Column) -> Column:
    """Quality gate: neither side empty, summary strictly shorter than its source."""
    return (text_len > 0) & (summary_len > 0) & (summary_len < text_len)


def quality_filter(cleaned: DataFrame) -> DataFrame:
    return cleaned.filter(is_valid(F.length("text"), F.length("summary")))


def extractive_overlap(pairs: DataFrame) -> DataFrame:
    """``pairs`` without ``text`` and ``summary``, with how far each summary is copied from its text.

    text_tokens, summary_tokens; fragments (greedy longest runs that the text has, too), covered (the summary's tokens in them), longest; coverage =
    covered / summary_tokens, density = sum of squared fragment lengths / summary_tokens, jaccard of the two sets of words. Tokens are lowercase runs of
    ``[a-z0-9]``. A side that is null or has no tokens has coverage, density and jaccard 0. Map-only.
    """
    kept = [c for c in pairs.columns if c not in ("text", "summary")]
    counted = pairs.select(*kept, fragment_counts(normalised(F.col("text")), normalised(F.col("summary"))).alias("_n"))
    n = {c: F.col(f"_n.{c}") for c in FRAGMENTS.names}
    share = lambda part, whole: F.when(whole > 0, part / whole).otherwise(0.0)
    return counted.select(
        *kept,
        *[n[c].alias(c) for c in ("text_tokens", "summary_tokens", "fragments", "covered", "longest")],
        share(n["covered"], n["summary_tokens"]).alias("coverage"),
        share(n["squares"], n["summary_tokens"]).alias("density"),
        share(n["shared_words"], n["all_words"]).alias("jaccard"),
    )


def abstractive_filter(cleaned: DataFrame, most_density: float, most_coverage: float = 1.0) -> DataFrame:
    """Pairs whose summary is not copied in long runs: density and coverage up to the bounds. Texts stay in place: the figures are of the row itself."""
    n = fragment_counts(normalised(F.col("text")), normalised(F.col("summary")))
    held = cleaned.withColumn("_n", n)
    tokens = F.greatest(F.col("_n.summary_tokens"), F.lit(1))
    return held.filter((F.col("_n.squares") / tokens <= most_density) & (F.col("_n.covered") / tokens <= most_coverage)).drop("_n")


def length_filter(cleaned: DataFrame, band: LengthBand = LengthBand()) -> DataFrame:
    return cleaned.filter(band.holds(F.length("text"), F.length("summary")))


def length_report(cleaned: DataFrame, band: LengthBand = LengthBand()) -> DataFrame:
    """One row: rows in, rows inside the band, kept percentage to one decimal."""
    kept = band.holds(F.length("text"), F.length("summary")).cast("bigint")
    counts = cleaned.agg(F.count("*").alias("initial"), F.coalesce(F.sum(kept), F.lit(0)).alias("kept"))
    share = F.when(F.col("initial") > 0, F.round(100 * F.col("kept") / F.col("initial"), 1))
    return counts.withColumn("kept_pct", share)


def fingerprints(pool: DataFrame) -> DataFrame:
    """Narrow row per document: position, key digest and cleaned lengths (one text scan)."""
    cleaned = with_cleaned(pool.select("pool_pos", "text", "summary"))
    return cleaned.select(
        "pool_pos",
        key_digest(near_dup_key(F.col("text"))).alias("near_digest"),
        F.length("text").alias("text_len"),
        F.length("summary").alias("summary_len"),
    )


def keep_first(prints: DataFrame) -> DataFrame:
    """Earliest row of every near-duplicate group, with its lengths and the group size.

    All buffers are fixed-width, so this is a hash aggregate with map-side combine: however many
    copies one key has, each map task sends one row for it.
    """
    lengths = F.shiftleft(F.col("text_len").cast("bigint"), 32).bitwiseOR(F.col("summary_len").cast("bigint"))
    firsts = prints.groupBy("near_digest").agg(
        F.min("pool_pos").alias("pool_pos"),
        F.min_by(lengths, "pool_pos").alias("lengths"),
        F.count("*").alias("copies"),
    )
    return firsts.select(
        "pool_pos",
        F.shiftright("lengths", 32).cast("int").alias("text_len"),
        F.col("lengths").bitwiseAND(F.lit(0xFFFFFFFF)).cast("int").alias("summary_len"),
        "copies",
    )


def select_rows(pool: DataFrame, chosen: DataFrame, band: LengthBand | None = None) -> DataFrame:
    """Attach raw texts to chosen positions and clean only those.

    A small choice is broadcast by AQE from its measured size, so the corpus is scanned in place;
    a large one shuffles only rows whose raw lengths can still pass ``band``.
    """
    rows = pool
    if band is not None:
        rows = rows.filter(band.may_hold(F.length("text"), F.length("summary")))
    return with_cleaned(rows.join(chosen, "pool_pos"))


def near_dedup(pool: DataFrame) -> DataFrame:
    """Cleaned rows that are the first of their near-duplicate group.

    The rows that go are found on the narrow table. They are the few: where Spark can broadcast them, the texts stay in place.
    """
    prints = pin(fingerprints(pool).select("pool_pos", "near_digest"))
    firsts = prints.groupBy("near_digest").agg(F.min("pool_pos").alias("first"), F.count("*").alias("copies")).filter("copies > 1")
    gone = prints.join(firsts, "near_digest").filter("pool_pos > first").select("pool_pos")
    return with_cleaned(pool.join(pin(gone), "pool_pos", "left_anti"))


def curated_positions(pool: DataFrame, band: LengthBand = LengthBand()) -> DataFrame:
    """Narrow table of rows that survive deduplication, quality and length, in that order.

    Deduplication comes first: a first copy that fails a later gate still removes its twins.
    """
    gate = is_valid(F.col("text_len"), F.col("summary_len")) & band.holds(F.col("text_len"), F.col("summary_len"))
    survivors = keep_first(fingerprints(pool)).filter(gate)
    return survivors.select(
        "pool_pos",
        split_rank(F.col("pool_pos")).alias("src_rank"),
        document_id(F.col("pool_pos")).alias("doc_id"),
        "text_len",
        "summary_len",
    )


def curation_funnel(pool: DataFrame, band: LengthBand = LengthBand()) -> DataFrame:
    """Rows after loading, deduplication, quality and length gates, and the kept share.

    One text scan and one narrow shuffle; no stage is counted by a pass of its own.
    """
    valid = is_valid(F.col("text_len"), F.col("summary_len"))
    inside = valid & band.holds(F.col("text_len"), F.col("summary_len"))
    counts = keep_first(fingerprints(pool)).agg(
        F.coalesce(F.sum("copies"), F.lit(0)).alias("loaded"),
        F.count("*").alias("deduplicated"),
        F.count(F.when(valid, 1)).alias("valid"),
        F.count(F.when(inside, 1)).alias("in_band"),
    )
    return counts.select(
        "*",
        (F.col("loaded") - F.col("deduplicated")).alias("duplicates_removed"),
        F.when(F.col("valid") > 0, F.round(100 * F.col("in_band") / F.col("valid"), 1)).alias("kept_pct"),
    )
