"""Live hourly summaries: open hours are visible, and a replayed micro-batch changes nothing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from brevita.operators.summaries import SKETCH_K, SUMMARY_SCHEMA, summary_columns
from brevita.session import delete
from brevita.sources.files import version_folders, versions
from brevita.sources.records import write_version
from brevita.streaming.logs import REFRESH, WATERMARK, WINDOW

# Batches whose rows lie beside the merged copy before they are folded into a new one.
COMPACT_AFTER = 50
KEYS = ["hour", "model_version"]


def live_summaries(logs: DataFrame, watermark: str = WATERMARK, k: int = SKETCH_K) -> DataFrame:
    """Stream of the summaries of all hours, open ones included: each batch gives the whole new row of every hour and model it changed.

    State is one row with a sketch of bounded size for each open hour and model; the watermark drops closed ones.
    """
    grouped = logs.withWatermark("timestamp_utc", watermark).groupBy(F.window("timestamp_utc", WINDOW).alias("w"), "model_version")
    summed = grouped.agg(*summary_columns(k)).withColumn("hour", F.col("w.start"))
    return summed.drop("w").withColumn("log_date", F.to_date("hour"))


def write_live(logs: DataFrame, path: str, checkpoint: str, refresh: str | None = REFRESH, compact_after: int = COMPACT_AFTER) -> StreamingQuery:
    """Upsert the live summaries into a table below ``path``. Each batch writes what it changed under its own number, so a repeated batch replaces
    its own rows only; the row of the newest batch is the one in force (``read_live``). ``refresh=None`` runs over what is there and stops."""

    def upsert(batch: DataFrame, batch_id: int) -> None:
        write_version(batch, f"{path}/batches", batch_id)
        if batch_id % compact_after == compact_after - 1:
            compact(batch.sparkSession, path, batch_id)

    writer = live_summaries(logs).writeStream.outputMode("update").foreachBatch(upsert).option("checkpointLocation", checkpoint)
    return (writer.trigger(processingTime=refresh) if refresh else writer.trigger(availableNow=True)).start()


def _newest(rows: DataFrame) -> DataFrame:
    columns = [c for c in rows.columns if c not in (*KEYS, "version")]
    newest = rows.groupBy(*KEYS).agg(F.max_by(F.struct(*columns), "version").alias("x"))
    return newest.select(*KEYS, "x.*")


def _parts(spark: SparkSession, path: str, upto: int | None = None) -> tuple[list[str], list[int]]:
    """Folders in force: the newest merged copy and the finished batches behind it."""
    merged = [n for n in versions(spark, f"{path}/merged") if upto is None or n <= upto][-1:]
    after = merged[0] if merged else -1
    batches = [n for n in versions(spark, f"{path}/batches") if n > after and (upto is None or n <= upto)]
    return [f"{path}/merged/version={n}" for n in merged] + [f"{path}/batches/version={n}" for n in batches], merged


def _in_force(spark: SparkSession, path: str, upto: int | None = None) -> DataFrame:
    parts, _ = _parts(spark, path, upto)
    if not parts:
        return spark.createDataFrame([], SUMMARY_SCHEMA)
    number = F.regexp_extract(F.col("_metadata.file_path"), r"/version=(\d+)/", 1).cast("bigint")
    return _newest(spark.read.schema(SUMMARY_SCHEMA).parquet(*parts).withColumn("version", number))


def read_live(spark: SparkSession, path: str) -> DataFrame:
    """The newest row of each hour and model (``SUMMARY_SCHEMA``), open hours included; an empty table before the first batch."""
    return _in_force(spark, path).select(*[c.split(" ")[0] for c in SUMMARY_SCHEMA.split(", ")])


def compact(spark: SparkSession, path: str, upto: int) -> None:
    """Fold all batches up to a number into one merged copy of that number. Batches go once the copy behind them is finished and a whole round old, so a reader
    that has listed them still finds them; a repeated call writes the same copy."""
    _, before = _parts(spark, path, upto - 1)
    write_version(_in_force(spark, path, upto), f"{path}/merged", upto)
    for folder, last in (("batches", before[0] if before else -1), ("merged", before[0] - 1 if before else -1)):
        for n in version_folders(spark, f"{path}/{folder}"):
            if n <= last:
                delete(spark, f"{path}/{folder}/version={n}")
