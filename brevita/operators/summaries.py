"""Request KPIs over long histories from hourly summaries with mergeable quantile sketches.

Each hour and model is summarised once: counts, sums and a KLL sketch of its latencies. Any range of hours is then merged from those rows; the log is
not read again. Sketches merge in any order and grouping at the same error.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from brevita.functions.numbers import success_flag
from brevita.operators.logs import PERCENTILES

# Size of a sketch: a quantile's rank is off by at most RANK_ERROR of the rows, with 99 % confidence; some tens of kilobytes when full.
SKETCH_K = 2000
RANK_ERROR = 0.0025
SUMMARY_SCHEMA = (
    "hour timestamp, model_version string, requests bigint, successes bigint, latency_count bigint, latency_sum double, "
    "latency_max double, latency_sketch binary, log_date date"
)


def summary_columns(k: int = SKETCH_K) -> list[Column]:
    """Aggregates of a summary; NaN and null latencies count as requests only."""
    latency = F.col("latency_ms").cast("double")
    latency = F.when(~F.isnan(latency), latency)
    return [
        F.count("*").alias("requests"),
        F.sum(success_flag(F.col("status")).cast("bigint")).alias("successes"),
        F.count(latency).alias("latency_count"),
        F.sum(latency).alias("latency_sum"),
        F.max(latency).alias("latency_max"),
        F.kll_sketch_agg_double(latency, k).alias("latency_sketch"),
    ]


def hourly_summaries(logs: DataFrame, k: int = SKETCH_K) -> DataFrame:
    """One row for each hour and model (``SUMMARY_SCHEMA``). Rows without a time are left out; a null model is a model.

    Tasks sketch what they read, so an hour with a third of all rows is a few sketches to merge.
    """
    rows = logs.filter(F.col("timestamp_utc").isNotNull())
    summed = rows.groupBy(F.date_trunc("hour", "timestamp_utc").alias("hour"), "model_version").agg(*summary_columns(k))
    return summed.withColumn("log_date", F.to_date("hour"))


def write_summaries(summaries: DataFrame, path: str, run: str) -> None:
    """Keep the summaries of one run, by day. A run repeated under its name replaces its own; runs of other rows add up on reading."""
    summaries.write.mode("overwrite").partitionBy("log_date").parquet(f"{path}/run={run}")


def read_summaries(spark: SparkSession, path: str, since: str | None = None, until: str | None = None) -> DataFrame:
    """Summaries of the hours from ``since`` up to, not including, ``until``. Only the folders of those days are read."""
    rows = spark.read.schema(SUMMARY_SCHEMA + ", run string").parquet(path).drop("run")
    hour = F.col("hour")
    if since is not None:
        at = F.lit(since).cast("timestamp")
        rows = rows.filter((F.col("log_date") >= F.to_date(at)) & (hour >= at))
    if until is not None:
        at = F.lit(until).cast("timestamp")
        rows = rows.filter((F.col("log_date") <= F.to_date(at)) & (hour < at))
    return rows


def merged_kpis(summaries: DataFrame, by: str | list[str] | None = None) -> DataFrame:
    """Requests, mean, largest, p50 and p95 latency, and success percentage, overall or per ``by``; as ``logs.latency_kpis`` has them, but percentiles
    are values of the data whose rank is off by ``RANK_ERROR`` at most (99 % confidence), not interpolated.

    A group without latencies has null figures. No summaries give one row of 0 requests overall, none per group.
    """
    keys = [by] if isinstance(by, str) else list(by or [])
    merged = summaries.groupBy(*keys).agg(
        F.coalesce(F.sum("requests"), F.lit(0)).alias("requests"),
        F.sum("successes").alias("successes"),
        F.coalesce(F.sum("latency_count"), F.lit(0)).alias("n"),
        F.sum("latency_sum").alias("total"),
        F.max("latency_max").alias("max_latency_ms"),
        # An hour without latencies has an empty sketch, which adds nothing.
        F.kll_merge_agg_double(F.when(F.col("latency_count") > 0, F.col("latency_sketch"))).alias("sketch"),
    )
    quantiles = [F.when(F.col("n") > 0, F.kll_sketch_get_quantile_double("sketch", F.lit(q))).alias(name) for name, q in PERCENTILES.items()]
    return merged.select(
        *keys,
        "requests",
        F.when(F.col("n") > 0, F.col("total") / F.col("n")).alias("avg_latency_ms"),
        *quantiles,
        "max_latency_ms",
        F.when(F.col("requests") > 0, F.col("successes") / F.col("requests") * 100).alias("success_pct"),
    )


def filled_hours(summaries: DataFrame) -> DataFrame:
    """(hour, model_version, requests) of each model, from its first to its last hour, hours without requests as 0.

    Each hour that has requests fills the gap up to the model's next one.
    """
    counts = summaries.groupBy("model_version", F.col("hour").alias("first")).agg(F.sum("requests").alias("n"))
    one_hour = F.expr("interval 1 hour")
    following = F.lead("first").over(Window.partitionBy("model_version").orderBy("first"))
    hours = F.sequence(F.col("first"), F.coalesce(following - one_hour, F.col("first")), one_hour)
    filled = counts.withColumn("hours", hours).select("model_version", F.explode("hours").alias("hour"), "first", "n")
    return filled.select("hour", "model_version", F.when(F.col("hour") == F.col("first"), F.col("n")).otherwise(0).alias("requests"))
