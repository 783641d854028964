"""Inference-log analytics: KPIs, hourly counts, recent requests, latency trend."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from brevita.functions.numbers import success_flag
from brevita.operators.quantiles import exact_quantiles
from brevita.operators.records import LOG_COLUMNS

# Rows shown by the dashboard and its latency percentiles.
RECENT_ROWS = 1000
PERCENTILES = {"p50_latency_ms": 0.50, "p95_latency_ms": 0.95}


def _newest_days(logs: DataFrame, limit: int) -> DataFrame:
    """The newest days that hold ``limit`` rows. Counts come from the folders' files without reading a column."""
    days = logs.groupBy("log_date").agg(F.count("*").alias("n"))
    newer = F.coalesce(F.sum("n").over(Window.orderBy(F.desc("log_date")).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    # One row per day.
    oldest, undated = (
        days.withColumn("newer", newer).filter(F.col("newer") < limit).agg(F.min("log_date"), F.count_if(F.col("log_date").isNull())).first()
    )
    return logs if oldest is None or undated else logs.filter(F.col("log_date") >= F.lit(oldest))


def recent_requests(logs: DataFrame, limit: int | None = RECENT_ROWS) -> DataFrame:
    """Newest rows first; equal times are ordered by request id. ``None`` gives the whole log.

    Not the whole log is read for it: of a log in ``log_date`` folders only the newest days, then their time column for the time of the
    last row wanted, then the rows from that time on, a filter that reaches the files.
    """
    if limit is None:
        return logs.select(*LOG_COLUMNS)
    rows = _newest_days(logs, limit) if "log_date" in logs.columns else logs
    newest = rows.select("timestamp_utc").orderBy(F.desc("timestamp_utc")).limit(limit)
    since, found, timed = newest.agg(F.min("timestamp_utc").cast("string"), F.count("*"), F.count("timestamp_utc")).first()
    if found == limit and timed == limit:
        rows = rows.filter(F.col("timestamp_utc") >= F.lit(since).cast("timestamp"))
    return rows.select(*LOG_COLUMNS).orderBy(F.desc("timestamp_utc"), "request_id").limit(limit)


def latency_trend(logs: DataFrame, limit: int | None = RECENT_ROWS) -> DataFrame:
    """(timestamp_utc, latency_ms) of the recent rows in ascending time."""
    return (
        recent_requests(logs, limit)
        .orderBy("timestamp_utc", "request_id")
        .select("timestamp_utc", "request_id", "latency_ms")
    )


def latency_kpis(logs: DataFrame, by: str | None = None) -> DataFrame:
    """Requests, mean, p50 and p95 latency, and success percentage, overall or per ``by``.

    Means and percentiles skip null latencies; a null status counts as not successful.
    """
    latency = F.col("latency_ms").cast("double")
    totals = {
        "requests": F.lit(1).cast("bigint"),
        "latency_sum": F.when(~F.isnan(latency), latency),
        "successes": success_flag(F.col("status")).cast("bigint"),
    }
    found = exact_quantiles(logs, "latency_ms", PERCENTILES, by, totals)
    kpis = {
        "avg_latency_ms": F.when(F.col("values") > 0, F.col("latency_sum") / F.col("values")),
        **{name: F.col(name) for name in PERCENTILES},
        "success_pct": F.col("successes") / F.col("requests") * 100,
    }
    return found.select(
        *([by] if by else []), "requests", *[column.alias(name) for name, column in kpis.items()]
    )


def requests_by_hour(logs: DataFrame) -> DataFrame:
    """Requests per hour from the first to the last hour, empty hours as 0.

    Each hour that has requests fills the gap up to the next one. The window without a partition runs over
    hours, not requests.
    """
    counts = (
        logs.filter(F.col("timestamp_utc").isNotNull())
        .groupBy(F.date_trunc("hour", "timestamp_utc").alias("first"))
        .agg(F.count("*").alias("n"))
    )
    one_hour = F.expr("interval 1 hour")
    following = F.lead("first").over(Window.orderBy("first"))
    last = F.coalesce(following - one_hour, F.col("first"))
    filled = counts.withColumn("last", last).select(
        F.explode(F.sequence("first", "last", one_hour)).alias("hour"), "first", "n"
    )
    return filled.select("hour", F.when(F.col("hour") == F.col("first"), F.col("n")).otherwise(0).alias("requests"))
