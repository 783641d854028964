"""Length-spread sampling and exact stratified splitting without a global sort.

Both need exact ranks. Ranks come from a two-level histogram: rows are counted per
(group, 12-bit hash bucket), running counts give each bucket its first rank, and only buckets that
hold a wanted rank are ordered row by row. A length or stratum that holds a third of all rows is
thereby spread over 4,096 even buckets.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from brevita.functions.keys import hash_bucket, hash_order
from brevita.operators.ranks import histogram_quantiles, running_totals
from brevita.session import pin

SAMPLE_SEED = "length"
SPLIT_SEED = 42

# Stratum of a draw that cannot be stratified.
UNSTRATIFIED = -1


class NotEnoughExamples(ValueError):
    """Fewer rows than the splits need."""


def _with_order(df: DataFrame, seed: int | str) -> DataFrame:
    ordered = df.withColumn("h", hash_order(F.col("doc_id"), seed))
    return ordered.withColumn("bucket", hash_bucket(F.col("h")))


def _running(column: str, over: Window) -> Column:
    """Sum of the rows before this one."""
    earlier = over.rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum(column).over(earlier), F.lit(0).cast("bigint"))


def require_rows(df: DataFrame, needed: int) -> int:
    """Minimum-size guard: one count, raised on the driver before anything is written."""
    found = df.count()
    if found < needed:
        raise NotEnoughExamples(f"not enough examples matching criteria: needed {needed}, got {found}")
    return found


def systematic_sample(pool: DataFrame, target_size: int, length_col: str = "text_len") -> DataFrame:
    """Rows at positions ``i*(n-1) div (target-1)`` of the pool ordered by length.

    Rows of equal length have no order of their own in the reference; here their hash order decides,
    which also spreads them evenly. A pool of at most ``target_size`` rows is returned whole. The column may have any range, as many values as
    rows, or one value in most of them: ranks come from running totals over ranges of (value, bucket).
    """
    if target_size < 2:
        raise ValueError("target_size must be at least 2")
    rows = _with_order(pool, SAMPLE_SEED)

    buckets = rows.groupBy(length_col, "bucket").agg(F.count("*").alias("n"))
    placed = running_totals(buckets, [length_col, "bucket"], "n")

    total = F.col("total")
    whole = total <= target_size

    def pick_at_or_after(rank: str) -> Column:
        """Smallest sampled position that is not below ``rank``, in exact integer arithmetic."""
        index = f"(({rank} * {target_size - 1}L + total - 2) div (total - 1))"
        return F.expr(f"({index} * (total - 1)) div {target_size - 1}L")

    wanted = placed.filter(
        F.when(whole, F.lit(True)).otherwise(pick_at_or_after("start") < F.col("start") + F.col("n"))
    ).select(length_col, "bucket", "start", "total")
    in_bucket = Window.partitionBy(length_col, "bucket").orderBy("h", "pool_pos")
    # At most ``target_size`` rows; written, so that Catalyst picks the join by their real size.
    ranked = rows.join(pin(wanted), [length_col, "bucket"]).withColumn(
        "rank", F.col("start") + F.row_number().over(in_bucket) - 1
    )
    picked = F.when(whole, F.lit(True)).otherwise(pick_at_or_after("rank") == F.col("rank"))
    return ranked.filter(picked).select(*pool.columns)


def length_deciles(pool: DataFrame, length_col: str = "text_len", bins: int = 10) -> DataFrame:
    """Add ``len_bucket``: equal-frequency bins, right-closed, repeated edges dropped.

    Edges are linear-interpolated quantiles taken from the histogram of lengths, by running totals over ranges of it, so that
    no task holds all lengths. Rows without a length get no bin.
    """
    histogram = pool.groupBy(length_col).agg(F.count("*").alias("n"))
    edges = histogram_quantiles(histogram, length_col, "n", [k / bins for k in range(bins + 1)])
    edges = pin(edges.select(F.array_distinct("edges").alias("edges")))
    upper = F.slice("edges", 2, bins + 1)
    with_edges = pool.withColumn("edges", edges.scalar())
    below = F.filter(upper, lambda e: e < F.col(length_col))
    return with_edges.withColumn("len_bucket", F.when(F.col(length_col).isNotNull(), F.size(below))).drop("edges")


def _shares(counts: DataFrame, size: int) -> DataFrame:
    """Add ``take``: the largest-remainder share of ``size`` for each row's stratum; ties go to the lower one.

    ``counts`` has ``stratum`` and ``n`` and may hold several rows per stratum (one per bucket). It is small,
    so all windows here and in the callers run in one partition, after a single exchange.
    """
    everything, mine = Window.partitionBy(), Window.partitionBy("stratum")
    shared = (
        counts.withColumns(
            {
                "total": F.sum("n").over(everything),
                "stratum_rows": F.sum("n").over(mine),
                "first": F.row_number().over(mine.orderBy("n")) == 1,
            }
        )
        .withColumns(
            {
                "base": F.expr(f"stratum_rows * {size}L div total"),
                "remainder": F.expr(f"stratum_rows * {size}L % total"),
            }
        )
        .withColumns(
            {
                "left_over": F.lit(size) - F.sum(F.when(F.col("first"), F.col("base"))).over(everything),
                "place": F.dense_rank().over(Window.orderBy(F.desc("remainder"), "stratum")),
            }
        )
    )
    take = F.col("base") + (F.col("place") <= F.col("left_over")).cast("bigint")
    return shared.select(*counts.columns, take.alias("take"))


def _stratifiable(counts: DataFrame, size: int) -> bool:
    """The rule of a draw: every stratum has two rows, and the strata outnumber neither side.

    ``counts`` (stratum, n) is one row per stratum; strata without rows do not count. One small aggregate.
    """
    fewest, strata, total = counts.filter("n > 0").agg(F.min("n"), F.count("*"), F.sum("n")).first()
    return bool(strata) and fewest >= 2 and strata <= size and total - size >= strata


def _takes(counts: DataFrame, test_size: int, val_size: int) -> DataFrame:
    """(stratum, n, n_test, n_val): both draws by largest remainders, validation from what test leaves."""
    test = _shares(counts, test_size).select(
        "stratum", F.col("n").alias("all_rows"), F.col("take").alias("n_test"), (F.col("n") - F.col("take")).alias("n")
    )
    return _shares(test, val_size).select("stratum", F.col("all_rows").alias("n"), "n_test", F.col("take").alias("n_val"))


def _parts(rows: DataFrame, ends: DataFrame) -> DataFrame:
    """Add ``part``: how many of its stratum's ``ends`` (ascending ranks, from 1) a row lies behind.

    Ranks come from one histogram of (stratum, bucket). The few buckets that hold an end are ordered row by row, and the rows
    found there, one per end, are joined to all rows.
    """
    histogram = rows.groupBy("stratum", "bucket").agg(F.count("*").alias("n"))
    start = _running("n", Window.partitionBy("stratum").orderBy("bucket"))
    wanted = (
        histogram.withColumn("start", start)
        .join(ends, "stratum")
        .select("stratum", "bucket", "n", F.explode(F.transform("ends", lambda e: e - F.col("start"))).alias("nth"))
        .filter("nth > 0 and nth <= n")
        .groupBy("stratum", "bucket")
        .agg(F.collect_list("nth").alias("nths"))
    )
    place = F.row_number().over(Window.partitionBy("stratum", "bucket").orderBy("h", "pool_pos"))
    key = F.struct("h", "pool_pos")
    cuts = (
        rows.select("stratum", "bucket", "h", "pool_pos")
        .join(pin(wanted), ["stratum", "bucket"])
        .withColumn("place", place)
        .select("stratum", key.alias("cut"), "place", F.explode("nths").alias("nth"))
        .filter("place = nth")
        .groupBy("stratum")
        .agg(F.collect_list("cut").alias("cuts"))
    )
    ends_and_cuts = pin(ends.join(cuts, "stratum", "left"))
    none_before = F.size(F.filter("ends", lambda e: e == 0))
    behind = F.size(F.filter(F.coalesce("cuts", F.array().cast("array<struct<h:bigint,pool_pos:bigint>>")), lambda c: c < key))
    return rows.join(ends_and_cuts, "stratum").withColumn("part", none_before + behind).drop("ends", "cuts")


def _counts(rows: DataFrame) -> DataFrame:
    return pin(rows.groupBy("stratum").agg(F.count("*").alias("n")))


def _drawn(rows: DataFrame, size: int) -> DataFrame:
    """One draw on its own, stratified if it can be: adds ``drawn``."""
    if size == 0:
        return rows.withColumn("drawn", F.lit(False))
    counts = _counts(rows)
    kept = rows.withColumn("own_stratum", F.col("stratum"))
    if not _stratifiable(counts, size):
        kept = kept.withColumn("stratum", F.lit(UNSTRATIFIED))
        counts = counts.groupBy(F.lit(UNSTRATIFIED).alias("stratum")).agg(F.sum("n").alias("n"))
    ends = pin(_shares(counts, size).select("stratum", F.array("take").alias("ends")))
    marked = _parts(kept, ends).withColumn("stratum", F.col("own_stratum"))
    return marked.withColumn("drawn", F.col("part") == 0).drop("own_stratum", "part")


def _both_stratified(counts: DataFrame, test_size: int, val_size: int) -> DataFrame | None:
    """(stratum, n, n_test, n_val) if both draws can be stratified, else nothing: the one rule of split and allocation."""
    if test_size and not _stratifiable(counts, test_size):
        return None
    takes = pin(_takes(counts, test_size, val_size))
    left = takes.select("stratum", (F.col("n") - F.col("n_test")).alias("n"))
    return None if val_size and not _stratifiable(left, val_size) else takes


def exact_split(
    pool: DataFrame,
    test_size: int,
    val_size: int,
    seed: int = SPLIT_SEED,
    stratified: bool = True,
) -> DataFrame:
    """Label every row ``test``, ``val`` or ``train`` with exact sizes.

    ``pool`` has ``doc_id``, ``pool_pos`` and, if stratified, ``len_bucket``, with any number of values. Test is drawn first, validation
    from what is left; each draw falls back to a single stratum on its own when a stratum has fewer than two rows or the
    strata outnumber either side. Rows are drawn in hash order of (seed, id), because the seeded shuffle of an outside library
    cannot be reproduced; sizes and per-stratum shares are the same.

    Both draws are ranks of that order within a stratum, so one histogram and one look-up serve both. If a draw falls back, its order is
    another one, and the draws are made one after the other.
    """
    stratum = F.col("len_bucket") if stratified else F.lit(UNSTRATIFIED)
    rows = pin(_with_order(pool, seed).withColumn("stratum", stratum))
    counts = _counts(rows)
    takes = _both_stratified(counts, test_size, val_size) if stratified else _takes(counts, test_size, val_size)
    if takes is not None:
        ends = pin(takes.select("stratum", F.array("n_test", F.col("n_test") + F.col("n_val")).alias("ends")))
        names = F.array(F.lit("test"), F.lit("val"), F.lit("train"))
        return _parts(rows, ends).select(*pool.columns, F.element_at(names, F.col("part") + 1).alias("split"))
    tested = pin(_drawn(rows, test_size))
    rest = _drawn(tested.filter("not drawn").drop("drawn"), val_size)
    return (
        tested.filter("drawn")
        .select(*pool.columns, F.lit("test").alias("split"))
        .unionByName(rest.select(*pool.columns, F.when(F.col("drawn"), "val").otherwise("train").alias("split")))
    )


def split_allocation(pool: DataFrame, test_size: int, val_size: int) -> DataFrame:
    """Rows per length bucket and split: from the bucket counts alone, or, if a draw falls back, from the rows it draws."""
    counts = pin(pool.groupBy(F.col("len_bucket").alias("stratum")).agg(F.count("*").alias("n")))
    takes = _both_stratified(counts, test_size, val_size)
    if takes is not None:
        return takes.select(
            F.col("stratum").alias("len_bucket"), "n", "n_test", "n_val", (F.col("n") - F.col("n_test") - F.col("n_val")).alias("n_train")
        )
    drawn = exact_split(pool, test_size, val_size)
    of = lambda name: F.count_if(F.col("split") == name).alias(f"n_{name}")
    return drawn.groupBy("len_bucket").agg(F.count("*").alias("n"), of("test"), of("val"), of("train"))


def split_stats(labelled: DataFrame) -> DataFrame:
    """Size and mean lengths of each split, from the narrow table."""
    return labelled.groupBy("split").agg(
        F.count("*").alias("n"),
        F.avg("text_len").alias("avg_text_len"),
        F.avg("summary_len").alias("avg_summary_len"),
    )
