"""Scorecards and the champion/challenger gate, for one pair and for whole candidate histories."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from brevita.functions.numbers import round_even
from brevita.session import pin

# Promotion threshold, weights, judge scale, wording of the decisions.
DEFAULT_THRESHOLD = 0.02
ROUGE_WEIGHT = 0.5
JUDGE_WEIGHT = 0.5
JUDGE_SCALE = 5.0
NO_CHAMPION = "No cached champion exists."
COMPARED = "Compared against cached champion."
ROUGE_METRICS = ("rouge1", "rouge2", "rougeL")


def _required(value: Column, message: str) -> Column:
    return F.coalesce(value, F.raise_error(F.lit(message)).cast("double"))


def rouge_average(metrics: tuple[str, ...] = ROUGE_METRICS) -> Column:
    """Mean over the metrics that are present; raises if there are none."""
    present = [F.col(m).cast("double") for m in metrics]
    total = sum((F.coalesce(v, F.lit(0.0)) for v in present[1:]), F.coalesce(present[0], F.lit(0.0)))
    count = sum((v.isNotNull().cast("int") for v in present[1:]), present[0].isNotNull().cast("int"))
    return _required(F.when(count > 0, total / count), "no ROUGE metric is present")


def judge_average(overall: str = "overall_average") -> Column:
    """Overall judge mean on a scale of 0 to 1; raises if missing."""
    return _required(F.col(overall).cast("double"), "the judge summary has no overall average") / JUDGE_SCALE


def build_scorecards(rouge: DataFrame, judge: DataFrame) -> DataFrame:
    """Join the two summaries of each model into its weighted scorecard, inputs kept under ``raw``.

    Both tables have one row per model. The combined score uses the unrounded parts.
    """
    metrics = tuple(m for m in ROUGE_METRICS if m in rouge.columns)
    judged = [c for c in judge.columns if c != "model"]
    inputs = rouge.select("model", F.struct(*metrics).alias("rouge")).join(
        judge.select("model", F.struct(*judged).alias("gemini")), "model"
    )
    parts = inputs.select("model", "rouge", "gemini", "rouge.*", "gemini.overall_average").select(
        "model", "rouge", "gemini", rouge_average(metrics).alias("r"), judge_average().alias("j")
    )
    return parts.select(
        "model",
        round_even(F.col("r"), 6).alias("rouge_average"),
        round_even(F.col("j"), 6).alias("gemini_average"),
        round_even(ROUGE_WEIGHT * F.col("r") + JUDGE_WEIGHT * F.col("j"), 6).alias("combined_score"),
        F.struct("rouge", "gemini").alias("raw"),
    )


def _decision(champion_score: Column, challenger_score: Column, threshold: float) -> list[Column]:
    """Decision columns. Promotion needs strictly more than champion + threshold, or no champion."""
    promoted = champion_score.isNull() | (challenger_score > champion_score + F.lit(threshold))
    return [
        F.when(promoted, "PROMOTED").otherwise("REJECTED").alias("decision"),
        F.when(champion_score.isNull(), NO_CHAMPION).otherwise(COMPARED).alias("reason"),
        F.lit(threshold).alias("threshold"),
        round_even(challenger_score - champion_score, 6).alias("margin"),
    ]


def utc_now() -> Column:
    """Current time as ISO text with microseconds and offset."""
    return F.date_format(F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'")


def promotion_decision(
    champions: DataFrame,
    challengers: DataFrame,
    threshold: float = DEFAULT_THRESHOLD,
    on: str = "family",
    decided_at: Column | None = None,
) -> DataFrame:
    """Compare every challenger with its family's current champion; nothing is written.

    ``champions`` has at most one row per family. Both sides keep all their columns, nested under
    ``champion`` (null if there is none) and ``challenger``.
    """
    # Written first: one row per family, and Catalyst then sends it to the challengers instead of dealing those by family.
    champions = pin(champions)
    held = champions.select(F.col(on), F.struct(*[c for c in champions.columns if c != on]).alias("champion"))
    entered = challengers.select(F.col(on), F.struct(*[c for c in challengers.columns if c != on]).alias("challenger"))
    met = entered.join(held, on, "left")
    return met.select(
        on,
        (utc_now() if decided_at is None else decided_at).alias("timestamp_utc"),
        *_decision(F.col("champion.combined_score"), F.col("challenger.combined_score"), threshold),
        "champion",
        "challenger",
    )


def _blocked(df: DataFrame, *order: str) -> DataFrame:
    """The rows dealt by ranges of (family, order), with the number of their range in ``block``.

    Ranges hold about equal numbers of rows whatever the values are, so a family with most of the rows becomes many blocks and
    small families share one. Written, so that the numbers stand.
    """
    return pin(df.repartitionByRange("family", *order).withColumn("block", F.spark_partition_id()))


def _successors(records: DataFrame, threshold: float) -> DataFrame:
    """(family, seq, next_seq): the lowest record score above each record's score + threshold, if there is one.

    Records and bars (score + threshold) are laid out by value. A bar's successor is the next record above it: the last one seen from above
    within the block, else the lowest of the blocks above.
    """
    point = records.select("family", F.col("combined_score").alias("key"), F.lit(False).alias("is_bar"), "seq")
    bar = records.select("family", (F.col("combined_score") + F.lit(threshold)).alias("key"), F.lit(True).alias("is_bar"), "seq")
    laid = _blocked(point.unionByName(bar), "key")
    seen = F.when(~F.col("is_bar"), F.col("seq"))
    above = Window.partitionBy("family", "block").orderBy(F.desc("key"), F.desc("is_bar"))
    lowest = laid.groupBy("family", "block").agg(F.min_by(seen, F.when(~F.col("is_bar"), F.col("key"))).alias("lowest"))
    higher = Window.partitionBy("family").orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, -1)
    beyond = lowest.select("family", "block", F.last("lowest", ignorenulls=True).over(higher).alias("beyond"))
    inside = F.last(seen, ignorenulls=True).over(above.rowsBetween(Window.unboundedPreceding, -1))
    return (
        laid.withColumn("inside", inside)
        .filter("is_bar")
        .join(beyond, ["family", "block"])
        .select("family", "seq", F.coalesce("inside", "beyond").alias("next_seq"))
        .filter("next_seq is not null")
    )


def _promotions(records: DataFrame, entry: DataFrame | None, threshold: float) -> DataFrame:
    """The promoted ones among each family's records (family, block, seq, combined_score, rising): family, block, seq, promoted.

    Every record has one fixed successor, so the promotions are what is reachable from the first one. Reach and leaps double in
    each round: as many rounds as the logarithm of the longest chain of promotions.
    """
    records = pin(records.select("family", "block", "seq", "combined_score"))
    open_ = records
    if entry is not None:
        bar = F.col("entry").isNull() | (F.col("combined_score") > F.col("entry") + F.lit(threshold))
        open_ = records.join(entry, "family", "left").filter(bar)
    reached = pin(open_.groupBy("family").agg(F.min("seq").alias("seq")))
    leaps, known = pin(_successors(records, threshold)), reached.count()
    while True:
        further = reached.join(leaps, ["family", "seq"]).select("family", F.col("next_seq").alias("seq"))
        reached = pin(reached.unionByName(further))
        found = reached.count()
        if found == known:
            break
        known = found
        onward = leaps.select("family", F.col("seq").alias("next_seq"), F.col("next_seq").alias("far_seq"))
        leaps = pin(leaps.join(onward, ["family", "next_seq"]).select("family", "seq", F.col("far_seq").alias("next_seq")))
    return records.join(reached, ["family", "seq"]).select("family", "block", "seq", F.col("combined_score").alias("promoted"))


def promotion_history(
    candidates: DataFrame, threshold: float = DEFAULT_THRESHOLD, champions: DataFrame | None = None
) -> DataFrame:
    """Decide every candidate (family, seq, combined_score) against the champion of its moment.

    The champion changes only on PROMOTED, so this is a sequential fold and not a running maximum: a score
    above the champion by less than the threshold leaves the bar where it is. It still splits into parallel
    work, because a promoted score always beats every earlier score of its family. (Whatever came before and
    was not promoted was at most champion + threshold, and a promoted score is above that.) Hence:

    1. Blocks: ranges of (family, seq) of about equal size, and their maxima.
    2. Records: rows that beat all earlier ones. Only blocks whose maximum beats all earlier blocks are read row by row.
    3. Promotions: records reachable from the first one over fixed successors, see ``_promotions``.
    4. Every row takes the latest promotion before it: within its block from a window, else from the blocks before.

    No step depends on the size or spread of ``seq`` or on one family's share. ``seq`` is unique in a family. ``champions`` (family, combined_score)
    starts families off with a champion. ``threshold`` must not be negative.
    """
    if threshold < 0:
        raise ValueError("promotion_history needs a threshold of at least 0")
    score = F.col("combined_score")
    rows = _blocked(candidates.select("family", "seq", score.cast("double").alias("combined_score")), "seq")
    earlier_blocks = Window.partitionBy("family").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    in_block = Window.partitionBy("family", "block").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    entry = None if champions is None else pin(champions.select("family", score.cast("double").alias("entry")))

    # At most one row for each block, and one more for each family.
    blocks = rows.groupBy("family", "block").agg(F.max("combined_score").alias("top"))
    blocks = blocks.withColumn("bar", F.max("top").over(earlier_blocks))
    blocks = pin(blocks.withColumn("entry", F.lit(None).cast("double")) if entry is None else blocks.join(entry, "family", "left"))

    rising = blocks.filter(F.col("bar").isNull() | (F.col("top") > F.col("bar"))).select("family", "block", "bar")
    records = (
        rows.join(rising, ["family", "block"])
        .withColumn("best", F.greatest(F.col("bar"), F.max("combined_score").over(in_block)))
        .filter(F.col("best").isNull() | (score > F.col("best")))
    )
    promotions = pin(_promotions(records, entry, threshold))
    return _decided(rows, blocks.select("family", "block", "entry"), promotions, threshold)


def _decided(rows: DataFrame, blocks: DataFrame, promotions: DataFrame, threshold: float) -> DataFrame:
    """Every row of the blocks against the latest promotion (family, block, seq, promoted) before it, else against its family's ``entry``."""
    earlier_blocks = Window.partitionBy("family").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    in_block = Window.partitionBy("family", "block").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    by_block = promotions.groupBy("family", "block").agg(F.max_by("promoted", "seq").alias("last_promoted"))
    opening = blocks.join(by_block, ["family", "block"], "left").select(
        "family",
        "block",
        F.coalesce(F.last("last_promoted", ignorenulls=True).over(earlier_blocks), F.col("entry")).alias("opening"),
    )
    held = (
        rows.join(opening, ["family", "block"])
        .join(promotions, ["family", "block", "seq"], "left")
        .withColumn("champion", F.coalesce(F.last("promoted", ignorenulls=True).over(in_block), F.col("opening")))
    )
    return held.select(
        "family",
        "seq",
        "combined_score",
        F.col("champion").alias("champion_score"),
        *_decision(F.col("champion"), F.col("combined_score"), threshold),
    )


def decisions_by_timeline(
    candidates: DataFrame, promotions: DataFrame, threshold: float = DEFAULT_THRESHOLD, champions: DataFrame | None = None
) -> DataFrame:
    """Decide every candidate by a known timeline of promotions (family, seq, combined_score), as a stream keeps it: an as-of join.

    The rows of ``promotion_history``, if the promotions are those of all the candidates. Retirements (no score) are passed over. Rows are dealt by ranges of (family, seq), so a family with most of
    the rows is spread; at most one promotion for each candidate is read.
    """
    score = F.col("combined_score").cast("double").alias("combined_score")
    rows = _blocked(candidates.select("family", "seq", score), "seq")
    blocks = rows.select("family", "block").distinct()
    none = F.lit(None).cast("double").alias("entry")
    entry = None if champions is None else pin(champions.select("family", score.alias("entry")))
    blocks = pin(blocks.select("family", "block", none) if entry is None else blocks.join(entry, "family", "left"))
    scored = promotions.filter("combined_score is not null")
    promoted = scored.select("family", "seq", score.alias("promoted")).join(rows.select("family", "seq", "block"), ["family", "seq"])
    return _decided(rows, blocks, pin(promoted.select("family", "block", "seq", "promoted")), threshold)


def current_champions(history: DataFrame) -> DataFrame:
    """Latest promoted candidate of each family (the table that replaces the champion file)."""
    promoted = history.filter(F.col("decision") == "PROMOTED")
    return promoted.groupBy("family").agg(
        F.max("seq").alias("seq"), F.max_by("combined_score", "seq").alias("combined_score")
    )
