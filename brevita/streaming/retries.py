"""Log ingest that knows late retries: Bloom filters of request ids, by day, are kept beside the log.

A micro-batch asks the filters which of its ids may be stored already, and on which day. Only those few are looked up, in those days alone; the filters err on
the side of a look-up, never of a lost or doubled row.

    <path>/rows/version=N/log_date=D      what batch N has added
    <path>/filters/version=N              the filters that batch N has changed: log_date, shard, bits
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from brevita.session import pin, scratch
from brevita.sources.files import versions
from brevita.sources.records import write_version

# A day's ids are dealt over shards; each shard has a filter of so many bits, of which an id sets HASHES. 64 shards of 2^20 bits tell 5,000,000
# ids of a day apart at about one in a hundred. More ids cost more look-ups, nothing else.
SHARDS = 64
BITS = 1 << 20
HASHES = 7

FILTER = "log_date date, shard int, bits binary"


def _places(hashes: np.ndarray, bits: int) -> np.ndarray:
    """Bits of each 64-bit hash: two halves, doubled (Kirsch and Mitzenmacher 2006)."""
    h = hashes.astype(np.uint64)
    low, high = h & np.uint64(0xFFFFFFFF), (h >> np.uint64(32)) | np.uint64(1)
    return ((low[:, None] + high[:, None] * np.arange(HASHES, dtype=np.uint64)) % np.uint64(bits)).astype(np.int64)


def _set(filter_: np.ndarray, hashes: np.ndarray) -> None:
    np.bitwise_or.at(filter_, (p := _places(hashes, len(filter_) * 8)) >> 3, np.uint8(1) << (p & 7).astype(np.uint8))


def _has(filter_: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    p = _places(hashes, len(filter_) * 8)
    return ((filter_[p >> 3] >> (p & 7).astype(np.uint8)) & 1).all(axis=1)


def _possible(ids: pd.DataFrame, filters: pd.DataFrame) -> pd.DataFrame:
    """(request_id, log_date) of ids of a shard that a day's filter may hold."""
    hashes = ids["hash"].to_numpy(np.int64).view(np.uint64)
    found = [
        pd.DataFrame({"request_id": ids["request_id"][_has(np.frombuffer(bits, np.uint8), hashes)], "log_date": day})
        for day, bits in zip(filters["log_date"], filters["bits"])
        if len(ids)
    ]
    return pd.concat(found) if found else pd.DataFrame({"request_id": pd.Series(dtype=str), "log_date": pd.Series(dtype=object)})


def _updated(bits: int):
    def run(ids: pd.DataFrame, filters: pd.DataFrame) -> pd.DataFrame:
        held, out = dict(zip(filters["log_date"], filters["bits"])), []
        for day, rows in ids.groupby("log_date"):
            made = np.frombuffer(held[day], np.uint8).copy() if day in held else np.zeros(bits // 8, np.uint8)
            _set(made, rows["hash"].to_numpy(np.int64).view(np.uint64))
            out.append((day, int(rows["shard"].iloc[0]), made.tobytes()))
        return pd.DataFrame(out, columns=["log_date", "shard", "bits"])

    return run


def _hashed(rows: DataFrame) -> DataFrame:
    hashed = rows.withColumn("hash", F.xxhash64("request_id"))
    # Another hash than the one that sets the bits.
    return hashed.withColumn("shard", F.pmod(F.xxhash64(F.lit("shard"), "request_id"), F.lit(SHARDS)).cast("int"))


def _before(spark: SparkSession, path: str, folder: str, schema: str, batch_id: int) -> DataFrame:
    """Rows of the finished batches below a number, with their ``version``."""
    numbers = [n for n in versions(spark, f"{path}/{folder}") if n < batch_id]
    if not numbers:
        return spark.createDataFrame([], f"{schema}, version bigint")
    base = f"{path}/{folder}"
    return spark.read.option("basePath", base).schema(f"{schema}, version bigint").parquet(*[f"{base}/version={n}" for n in numbers])


def stored_again(batch: DataFrame, path: str, batch_id: int) -> DataFrame:
    """(request_id) of the batch's ids that earlier batches have stored, on whatever day. Reads the request ids of the days that filters point to."""
    spark = batch.sparkSession
    filters = _before(spark, path, "filters", FILTER, batch_id)
    newest = filters.groupBy("log_date", "shard").agg(F.max_by("bits", "version").alias("bits"))
    ids = _hashed(batch.filter("request_id is not null").select("request_id").distinct())
    asked = ids.groupBy("shard").cogroup(newest.groupBy("shard"))
    possible = pin(asked.applyInPandas(_possible, "request_id string, log_date date"))
    # As many as there are days: a filter on folders.
    days = [r[0] for r in possible.select("log_date").distinct().collect()]
    rows = _before(spark, path, "rows", "request_id string, log_date date", batch_id).filter(F.col("log_date").isin(days) if days else F.lit(False))
    return rows.join(possible, ["request_id", "log_date"], "left_semi").select("request_id").distinct()


def ingest_once(rows: DataFrame, path: str, checkpoint: str, refresh: str | None = None, bits: int = BITS) -> StreamingQuery:
    """Append log rows to a table by day, each request once, however late it is retried and whatever time the retry carries.

    The first row that arrives stays; of several in one batch the earliest by time. Rows without an id are all kept. Batches write under their number, so
    a repeated batch replaces its own output and changes nothing. No watermark, and no state in the stream: what is remembered is ``bits`` for each
    shard and day in the shared folder.
    """

    def store(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        with scratch(spark):
            dated = pin(batch.withColumn("log_date", F.to_date("timestamp_utc")))
            named, unnamed = dated.filter("request_id is not null"), dated.filter("request_id is null")
            columns = F.struct(F.col("timestamp_utc").isNull().alias("_no"), "timestamp_utc", F.xxhash64(*dated.columns).alias("_tie"))
            one = named.groupBy("request_id").agg(F.min_by(F.struct(*dated.columns), columns).alias("x")).select("x.*")
            new = pin(one.join(pin(stored_again(dated, path, batch_id)), "request_id", "left_anti").select(dated.columns))
            ids = _hashed(new.select("request_id", "log_date").filter("log_date is not null"))
            held = _before(spark, path, "filters", FILTER, batch_id).groupBy("log_date", "shard").agg(F.max_by("bits", "version").alias("bits"))
            changed = ids.groupBy("shard").cogroup(held.groupBy("shard")).applyInPandas(_updated(bits), FILTER)
            # Filters first: a batch that dies in between is repeated, and reads neither.
            write_version(changed, f"{path}/filters", batch_id)
            new.unionByName(unnamed).write.mode("overwrite").partitionBy("log_date").parquet(f"{path}/rows/version={batch_id}")

    writer = rows.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint)
    return (writer.trigger(processingTime=refresh) if refresh else writer.trigger(availableNow=True)).start()


def read_log(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """All rows stored so far, with ``log_date``."""
    return _before(spark, path, "rows", f"{schema}, log_date date", 1 << 62).drop("version")
