"""Promotion gate over a stream of candidates, with each family's champion in a state store.

A micro-batch is first cut down to the rows that can be promoted at all. The state function then folds those over the family's champion, and emits
promotions: the timeline from which every candidate's decision follows (``gate.decisions_by_timeline``).
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from brevita.operators.gate import DEFAULT_THRESHOLD

TIMELINE = "family string, seq bigint, combined_score double, champion_score double, event string"
# Champion and its place, and the last place seen: the same size for every family, however many candidates it had.
STATE = "champion double, champion_seq bigint, last_seq bigint"
PROMOTED, RETIRED = "PROMOTED", "RETIRED"
# Rows that a task holds before it cuts them down again.
HELD_ROWS = 50_000


def _rising(rows: pd.DataFrame) -> pd.DataFrame:
    """Of each family the rows that beat all earlier ones here, and the last one, which has the place and time reached."""
    rows = rows.sort_values(["family", "seq"], kind="stable")
    best = rows.groupby("family", sort=False)["combined_score"].cummax().groupby(rows["family"], sort=False).shift()
    last = ~rows.duplicated("family", keep="last")
    return rows[(best.isna() & rows["combined_score"].notna()) | (rows["combined_score"] > best) | last]


def _contenders(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows that beat all earlier ones of their family in this task, and each family's last row.

    With a threshold of at least 0 no other row can be promoted: the champion is at most the threshold below every score decided before.
    """
    held, size, limit = [], 0, HELD_ROWS
    for frame in frames:
        held.append(_rising(frame))
        size += len(held[-1])
        if size > limit:
            held = [_rising(pd.concat(held))]
            size = len(held[0])
            limit = max(HELD_ROWS, 2 * size)
    if held:
        yield _rising(pd.concat(held))


def _fold(threshold: float, idle_ms: int | None):
    """State function of one family: its promotions among the contenders, in order of ``seq``."""

    def emitted(rows: list[tuple]) -> pd.DataFrame:
        return pd.DataFrame(rows, columns=["family", "seq", "combined_score", "champion_score", "event"]).astype(
            {"seq": "int64", "combined_score": "float64", "champion_score": "float64"}
        )

    def run(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        (family,) = key
        if state.hasTimedOut:
            champion, seq, last = state.get
            state.remove()
            yield emitted([(family, last, None, champion, RETIRED)])
            return
        champion, champion_seq, before = state.get if state.exists else (None, None, None)
        rows = pd.concat(list(frames)).sort_values("seq", kind="stable")
        out, last = [], before
        for seq, score in zip(rows["seq"].tolist(), rows["combined_score"].tolist(), strict=True):
            if before is not None and seq <= before:
                continue  # behind what an earlier batch has decided
            last = seq
            if score == score and (champion is None or score > champion + threshold):
                out.append((family, seq, score, champion, PROMOTED))
                champion, champion_seq = score, seq
        state.update((champion, champion_seq, last))
        if idle_ms is not None:
            reached = int(rows["at"].max().timestamp() * 1000)
            state.setTimeoutTimestamp(max(reached, state.getCurrentWatermarkMs()) + idle_ms)
        if out:
            yield emitted(out)

    return run


def champion_timeline(
    candidates: DataFrame, threshold: float = DEFAULT_THRESHOLD, idle: str | None = None, watermark: str = "10 minutes"
) -> DataFrame:
    """Stream of the promotions among streamed candidates (family, seq, combined_score): family, seq, combined_score, champion_score, event.

    The same promotions as ``promotion_history`` has, for any cut of the candidates into batches, as long as ``seq`` does not go back in a family from one
    batch to the next; rows that do are never promoted. A null or NaN score is never promoted. ``threshold`` must not be negative.

    With ``idle`` (an interval such as "30 days") candidates also have ``decided_at``, and a family without a candidate for that long by event time
    loses its champion: a RETIRED row with the last ``seq`` seen, and its state is dropped. State is one row of fixed width for each family.
    """
    if threshold < 0:
        raise ValueError("champion_timeline needs a threshold of at least 0")
    score = F.col("combined_score").cast("double").alias("combined_score")
    at = F.col("decided_at").cast("timestamp") if idle else F.lit(None).cast("timestamp")
    rows = candidates.select("family", F.col("seq").cast("bigint").alias("seq"), score, at.alias("at"))
    few = rows.mapInPandas(_contenders, "family string, seq bigint, combined_score double, at timestamp")
    timeout, idle_ms = GroupStateTimeout.NoTimeout, None
    if idle:
        timeout, idle_ms = GroupStateTimeout.EventTimeTimeout, int(pd.Timedelta(idle).total_seconds() * 1000)
        few = few.withWatermark("at", watermark)
    return few.groupBy("family").applyInPandasWithState(_fold(threshold, idle_ms), TIMELINE, STATE, "append", timeout)


def write_timeline(timeline: DataFrame, path: str, checkpoint: str, refresh: str | None = None) -> StreamingQuery:
    """Append the timeline to a Parquet table. The sink and the state store commit by batch, so a restart from the checkpoint neither
    loses nor repeats a promotion."""
    writer = timeline.writeStream.format("parquet").outputMode("append").option("path", path).option("checkpointLocation", checkpoint)
    return (writer.trigger(processingTime=refresh) if refresh else writer.trigger(availableNow=True)).start()


def read_timeline(spark, path: str) -> DataFrame:
    """All rows that finished batches have appended."""
    return spark.read.schema(TIMELINE).parquet(path)


def champions_of(timeline: DataFrame) -> DataFrame:
    """The champion in force in each family (family, seq, combined_score); retired ones are left out."""
    # A promotion that follows a retirement has a larger seq; a retirement at a promotion's own place comes after it.
    newest = timeline.groupBy("family").agg(F.max(F.struct("seq", (F.col("event") == RETIRED).alias("gone"), "combined_score")).alias("x"))
    return newest.filter("not x.gone").select("family", "x.seq", "x.combined_score")
