"""Judge replies: messages out, parsed scores back, means per model."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brevita.functions.numbers import round_even
from brevita.functions.replies import lenient_int, object_variant, unfenced
from brevita.functions.templates import JUDGE_PROMPT, judge_message

CRITERIA = ("relevance", "factual", "fluency")
REASONS = tuple(f"{c}_reasoning" for c in CRITERIA)

# Fixed value: examples shown to the judge.
MAX_EXAMPLES = 30


def judge_sample(pairs: DataFrame, limit: int | None = MAX_EXAMPLES) -> DataFrame:
    """First examples in id order; ``None`` judges them all."""
    return pairs if limit is None else pairs.orderBy("id").limit(limit)


def judge_messages(pairs: DataFrame) -> DataFrame:
    return pairs.select(
        "id",
        F.lit(JUDGE_PROMPT).alias("system_prompt"),
        judge_message(F.col("reference_summary"), F.col("generated_summary")).alias("user_message"),
    )


def parse_replies(replies: DataFrame) -> DataFrame:
    """Add ``scores`` (variant, null if the reply is no JSON object) and ``error`` (the text then)."""
    kept = [c for c in replies.columns if c != "raw_text"]
    text = F.inline(F.array(F.struct(unfenced(F.col("raw_text")).alias("reply"))))
    parsed = replies.select(*kept, text)
    parsed = parsed.select(*kept, "reply", F.inline(F.array(F.struct(object_variant(F.col("reply")).alias("scores")))))
    return parsed.select(*kept, "scores", F.when(F.col("scores").isNull(), F.col("reply")).alias("error"))


def typed_scores(parsed: DataFrame) -> DataFrame:
    """Integer scores; null marks a value that is there but is no number."""
    return parsed.withColumns({c: lenient_int(F.col("scores"), c) for c in CRITERIA})


def judged_examples(pairs: DataFrame, parsed: DataFrame) -> DataFrame:
    """Every example with its parsed reply; examples without a reply stay, with nulls.

    A reply may carry ``reference_summary`` or ``generated_summary`` of its own; it then wins, as the
    reply's keys are merged last.
    """

    def text(key: str) -> Column:
        return F.try_variant_get("scores", f"$.{key}", "string")

    replies = parsed.select(
        "id",
        "scores",
        "error",
        *[lenient_int(F.col("scores"), c, missing=None).alias(c) for c in CRITERIA],
        *[text(r).alias(r) for r in REASONS],
    )
    joined = pairs.select("id", "reference_summary", "generated_summary").join(replies, "id", "left")
    merged = {c: F.coalesce(text(c), F.col(c)) for c in ("reference_summary", "generated_summary")}
    return joined.withColumns(merged).drop("scores")


def judge_summary(typed: DataFrame, drop_errors: bool = False, strict: bool = False) -> DataFrame:
    """Mean score per criterion and model, rounded to 3, and the mean of those three.

    A reply without a key scores 0 there and counts, error replies included, unless ``drop_errors``. A value that
    does not convert stops its row at that criterion: the ones before it have been added, the row is not counted.
    ``strict`` raises for a model without one valid row; otherwise its means are null.
    """
    rows = typed.filter(F.col("error").isNull()) if drop_errors else typed
    reached = F.lit(True)
    sums = []
    for c in CRITERIA:
        reached = reached & F.col(c).isNotNull()
        sums.append(F.coalesce(F.sum(F.when(reached, F.col(c))), F.lit(0)).alias(f"sum_{c}"))
    totals = rows.groupBy("model").agg(*sums, F.count(F.when(reached, 1)).alias("num_examples"))
    if strict:
        missing = F.raise_error(F.concat(F.lit("no valid scores for model "), F.col("model"))).cast("bigint")
        totals = totals.withColumn(
            "num_examples", F.when(F.col("num_examples") == 0, missing).otherwise(F.col("num_examples"))
        )
    n = F.col("num_examples")
    means = {f"mean_{c}": round_even(F.when(n > 0, F.col(f"sum_{c}") / n), 3) for c in CRITERIA}
    averaged = totals.withColumns(means)
    overall = sum((F.col(f"mean_{c}") for c in CRITERIA[1:]), F.col(f"mean_{CRITERIA[0]}")) / 3
    return averaged.select("model", *means, round_even(overall, 3).alias("overall_average"), "num_examples")
