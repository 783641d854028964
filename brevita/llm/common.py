"""Small helpers that several operators of this folder share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from brevita import session
from brevita.session import pin

# Words are runs of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def prepare(spark: SparkSession) -> SparkSession:
    """What any job of the library needs, Arrow batches bounded by rows and bytes, since a row may hold a very long text, and shuffle files removed
    once their job is over.

    Every operator here writes what later steps read to the shared folder, so a finished job's shuffle files are of no more use.
    """
    session.prepare(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "256")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "4m")
    spark.conf.set("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once, also where ``body`` uses it inside other lambdas."""
    return F.element_at(F.transform(F.array(value), body), 1)


def uniform(*keys: Column) -> Column:
    """A double in [0, 1) that depends on the keys alone."""
    return F.shiftrightunsigned(F.xxhash64(*keys), 11).cast("double") * F.lit(2.0**-53)


def crc_remainder(ident: Column, divisor: int) -> Column:
    """crc32 of the id as text, modulo ``divisor``; null for a null id."""
    return F.crc32(ident.cast("string").cast("binary")) % divisor


def ranked(df: DataFrame, *order: Column, name: str = "rank") -> DataFrame:
    """Adds the row's position, from 0, in the whole table's order. No task sorts more than one range of the rows."""
    parts = pin(df.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()))
    counts = parts.groupBy("_part").agg(F.count("*").alias("_rows"))
    # One row per partition, hence bounded: the running sum and the broadcast stay small.
    before = counts.select(
        "_part",
        F.coalesce(
            F.sum("_rows").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
        ).alias("_before"),
    )
    inside = F.row_number().over(Window.partitionBy("_part").orderBy(*order))
    return (
        parts.withColumn("_inside", inside)
        .join(F.broadcast(before), "_part")
        .withColumn(name, (F.col("_before") + F.col("_inside") - 1).cast("bigint"))
        .drop("_part", "_inside", "_before")
    )
