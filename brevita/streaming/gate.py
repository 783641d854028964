"""Promotion gate over a stream of candidates, with the champions as versioned state."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from brevita.operators.gate import DEFAULT_THRESHOLD, current_champions, promotion_history
from brevita.session import scratch
from brevita.sources.records import prune_versions, read_version, write_version


def merge_champions(held: DataFrame, promoted: DataFrame) -> DataFrame:
    """Champions after a batch: a family's new one if it has one, else the one it had. All columns are kept; what one side
    lacks is null there."""
    staying = held.join(promoted.select("family"), "family", "left_anti")
    return promoted.unionByName(staying, allowMissingColumns=True)


def gate_stream(
    candidates: DataFrame,
    log_path: str,
    champion_path: str,
    checkpoint: str,
    threshold: float = DEFAULT_THRESHOLD,
    refresh: str | None = None,
) -> StreamingQuery:
    """Decide candidates batch by batch; ``seq`` must not go back from one batch to the next.

    Each micro-batch runs the batch operator from the champions of the batch before, so a family with a
    third of the candidates is still spread over blocks, which a keyed state function would pull into one task.
    Decisions and champions are written under the batch number; a repeated batch replaces its own output. The newest copies of the
    champions stay, older ones are deleted.
    """

    def decide(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        with scratch(spark):  # tables pinned for this batch go with it
            held = read_version(spark, champion_path, before=batch_id)
            write_version(promotion_history(batch, threshold, held), log_path, batch_id)
            decided = spark.read.parquet(f"{log_path}/version={batch_id}")
            write_version(merge_champions(held, current_champions(decided)), champion_path, batch_id)
            prune_versions(spark, champion_path)

    writer = candidates.writeStream.foreachBatch(decide).option("checkpointLocation", checkpoint)
    return (writer.trigger(processingTime=refresh) if refresh else writer.trigger(availableNow=True)).start()
