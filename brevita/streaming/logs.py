"""Request-log streams: ingest without duplicates, and live hourly KPIs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from brevita.functions.numbers import success_flag
from brevita.sources.files import is_folder

WATERMARK = "10 minutes"
WINDOW = "1 hour"

# Fixed value: seconds between refreshes of the live view.
REFRESH = "60 seconds"

# Rank error of at most n / accuracy. The state of a window is a sketch of bounded size.
QUANTILE_ACCURACY = 10_000


def read_files(spark: SparkSession, path: str, schema: str, max_files: int | None = None) -> DataFrame:
    """Stream of the Parquet files below a folder, or of one single file, with a stated schema."""
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if is_folder(spark, path):
        return reader.parquet(path)
    folder, _, name = path.rpartition("/")
    return reader.option("pathGlobFilter", name).parquet(folder)


def _triggered(writer, refresh: str | None):
    """Every ``refresh``, or once over what is there."""
    return writer.trigger(processingTime=refresh) if refresh else writer.trigger(availableNow=True)


def ingest_logs(
    rows: DataFrame, path: str, checkpoint: str, watermark: str = WATERMARK, refresh: str | None = None
) -> StreamingQuery:
    """Append log rows to a Parquet table by day; a request retried within the watermark is stored once."""
    stored = (
        rows.withWatermark("timestamp_utc", watermark)
        .dropDuplicatesWithinWatermark(["request_id"])
        .withColumn("log_date", F.to_date("timestamp_utc"))
    )
    writer = stored.writeStream.format("parquet").outputMode("append").partitionBy("log_date")
    return _triggered(writer.option("path", path).option("checkpointLocation", checkpoint), refresh).start()


def hourly_kpis(logs: DataFrame, watermark: str = WATERMARK, window: str = WINDOW) -> DataFrame:
    """Requests, latency and success percentage per hour and model; for streams and batches alike.

    Percentiles are approximate within the stated rank error, since an exact one would keep every latency
    of an open window as state. Empty hours are filled on read, not here.
    """
    latency = F.col("latency_ms")
    p50, p95 = (F.percentile_approx(latency, q, QUANTILE_ACCURACY) for q in (0.50, 0.95))
    return (
        logs.withWatermark("timestamp_utc", watermark)
        .groupBy(F.window("timestamp_utc", window).alias("w"), "model_version")
        .agg(
            F.count("*").alias("requests"),
            F.avg(latency).alias("avg_latency_ms"),
            p50.alias("p50_latency_ms"),
            p95.alias("p95_latency_ms"),
            (F.avg(success_flag(F.col("status"))) * 100).alias("success_pct"),
        )
        .select(F.col("w.start").alias("hour"), "model_version", "requests", "avg_latency_ms",
                "p50_latency_ms", "p95_latency_ms", "success_pct")
    )


def write_hourly_kpis(logs: DataFrame, path: str, checkpoint: str, refresh: str | None = REFRESH) -> StreamingQuery:
    """Append each hour once the watermark has passed its end. ``refresh=None`` runs over what is there and stops."""
    writer = hourly_kpis(logs).writeStream.format("parquet").outputMode("append")
    return _triggered(writer.option("path", path).option("checkpointLocation", checkpoint), refresh).start()
