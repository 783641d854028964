"""Running totals along a whole table's order, without a task that sees the whole table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from brevita.session import pin


def _earlier(weight: str, window: Window) -> Column:
    before = F.sum(weight).over(window.rowsBetween(Window.unboundedPreceding, -1))
    return F.coalesce(before, F.lit(0).cast("bigint"))


def running_totals(df: DataFrame, order: list[str], weight: str) -> DataFrame:
    """Add ``start``, the sum of ``weight`` over the rows before this one, and ``total``, over all rows.

    Rows are ordered by the columns ``order``, nulls first, which must tell them apart: equal rows would follow each other in any order. ``weight``
    is a whole number. Rows are dealt by ranges of that order and written once, so that the ranges stay what they were; a window runs within each
    range, and another over the ranges' sums, one row a partition. An empty table gives an empty result.
    """
    ranged = pin(df.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()))
    sums = ranged.groupBy("_range").agg(F.sum(weight).alias("_sum"))
    # One row per partition, hence bounded: this window and the broadcast stay small whatever the table holds.
    offsets = sums.select(
        "_range", _earlier("_sum", Window.orderBy("_range")).alias("_offset"), F.sum("_sum").over(Window.partitionBy()).alias("total")
    )
    inside = _earlier(weight, Window.partitionBy("_range").orderBy(*order))
    return (
        ranged.withColumn("_inside", inside)
        .join(F.broadcast(offsets), "_range")
        .withColumn("start", F.col("_offset") + F.col("_inside"))
        .drop("_range", "_inside", "_offset")
    )


def histogram_quantiles(histogram: DataFrame, value: str, weight: str, probabilities: list[float]) -> DataFrame:
    """One row with ``edges``, linear-interpolated quantiles of ``value``, each row of which counts ``weight`` times.

    ``histogram`` has one row a value. Ranks come from ``running_totals``, and at most two rows per quantile are looked at. Rows with a null value count
    for nothing; without any other ``edges`` is null.
    """
    placed = running_totals(histogram.filter(F.col(value).isNotNull()), [value], weight)
    end = F.col("start") + F.col(weight)

    def at(rank: Column) -> Column:
        return F.max(F.when((F.col("start") <= rank) & (rank < end), F.col(value).cast("double")))

    positions = [(F.col("total") - 1) * F.lit(float(p)) for p in probabilities]
    ends = [at(f(p)).alias(f"{f.__name__}_{i}") for i, p in enumerate(positions) for f in (F.floor, F.ceil)]
    found = placed.agg(F.max("total").alias("total"), *ends)

    def between(i: int, position: Column) -> Column:
        low, high = F.col(f"floor_{i}"), F.col(f"ceil_{i}")
        mixed = (F.ceil(position) - position) * low + (position - F.floor(position)) * high
        return F.when(low == high, low).otherwise(mixed)

    edges = F.array(*[between(i, p) for i, p in enumerate(positions)])
    return found.select(F.when(F.col("total").isNotNull(), edges).alias("edges"))
