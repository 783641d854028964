"""Exact quantiles of a column that is too long for one task.

``percentile`` keeps every distinct value of a group in one reducer. Here a histogram over monotone
buckets finds the few buckets that hold the wanted ranks; while one of them holds many rows of different values, it is cut again, and
only values of small ranges are counted one by one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from brevita.session import pin

# Buckets per factor e: a bucket spans 0.025 % of its value, and all doubles fit in under 13 million buckets.
STEPS_PER_E = 4096
SIGN_OFFSET = 10_000_000
MAX_DOUBLE = 1.7976931348623157e308


# A range of values with more rows than this is cut into so many parts.
RANGE_ROWS = 100_000
RANGE_PARTS = 4096

# Bucket of rows without a value.
NO_VALUE = -(1 << 40)


def value_bucket(x: Column) -> Column:
    """Integer bucket of a double; never decreases as the value grows."""
    size = F.ln(F.least(F.abs(x), F.lit(MAX_DOUBLE))) * STEPS_PER_E
    return (
        F.when(x > 0, F.lit(SIGN_OFFSET) + F.floor(size))
        .when(x < 0, F.lit(-SIGN_OFFSET) + F.floor(-size))
        .otherwise(F.lit(0).cast("bigint"))
    )


def exact_quantiles(
    df: DataFrame,
    value: str,
    quantiles: dict[str, float],
    by: str | None = None,
    sums: dict[str, Column] | None = None,
    range_rows: int = RANGE_ROWS,
) -> DataFrame:
    """Linear-interpolated quantiles, overall or per group, one column per entry of ``quantiles``.

    Nulls and NaN are skipped. ``sums`` adds totals over all rows of the group, and ``values`` counts the rows that
    have a value; both come out of the histogram pass. A group without values keeps its row, with null quantiles.

    Two scans of the column, and one more for each time that a range has to be cut. Each combines on the map side: to (group, bucket)
    counts, then, for at most two ranges per quantile and group, to (group, part) or (group, value) counts, so a value that many
    rows share is one row. A range has a value at either end; cut into parts of equal width, a few rounds separate any two
    doubles. The ranges are written between the scans; Catalyst then knows their size and broadcasts them only if they are small.
    """
    sums = sums or {}
    keys = ["grp"] if by else []
    x = F.col(value).cast("double")
    rows = df.select(
        *([F.col(by).alias("grp")] if by else []),
        F.when(~F.isnan(x), x).alias("x"),
        *[column.alias(name) for name, column in sums.items()],
    ).withColumn("b", F.when(F.col("x").isNull(), F.lit(NO_VALUE)).otherwise(value_bucket(F.col("x"))))
    group = Window.partitionBy(*keys)

    def before(order: str, *within: str) -> Column:
        window = Window.partitionBy(*keys, *within).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
        return F.coalesce(F.sum("n").over(window), F.lit(0).cast("bigint"))

    positions = {name: (F.col("values") - 1) * F.lit(float(q)) for name, q in quantiles.items()}
    end = F.col("start") + F.col("n")

    def holds(position: Column) -> Column:
        return (F.floor(position) < end) & (F.ceil(position) >= F.col("start"))

    ends_of = [F.count("x").alias("n"), F.min("x").alias("low"), F.max("x").alias("high")]
    buckets = rows.groupBy(*keys, "b").agg(*ends_of, *[F.sum(name).alias(name) for name in sums])
    placed = buckets.select(
        *keys,
        "b",
        "n",
        "low",
        "high",
        before("b").alias("start"),
        F.sum("n").over(group).alias("values"),
        *[F.sum(name).over(group).alias(name) for name in sums],
    )
    wanted = (F.col("values") == 0) & (F.col("b") == NO_VALUE)
    for position in positions.values():
        wanted = wanted | ((F.col("n") > 0) & holds(position))
    carried = ["start", "values", *sums]

    def near_ranges(found: DataFrame) -> DataFrame:
        names = [F.col(k).alias(f"near_{k}") for k in [*keys, "b", "low", "high", "n"]]
        return pin(found.filter(wanted).select(*names, *carried))

    match = F.col("b") == F.col("near_b")
    for key in keys:
        match = match & F.col(key).eqNullSafe(F.col(f"near_{key}"))
    low, width = F.col("near_low"), F.col("near_high") - F.col("near_low")
    match = match & (F.col("x").isNull() | F.col("x").between(F.col("near_low"), F.col("near_high")))
    near = near_ranges(placed)
    large = (F.col("near_n") > range_rows) & (F.col("near_low") < F.col("near_high"))
    inner = [*keys, "b", "near_low"]
    while not near.filter(large).isEmpty():
        # The upper end is a part of its own, so that every cut separates the ends.
        part = F.when(~large, F.lit(0)).when(F.col("x") == F.col("near_high"), F.lit(RANGE_PARTS)).otherwise(
            F.floor((F.col("x") - low) / width * RANGE_PARTS)
        )
        cut = rows.select(*keys, "b", "x").join(near, match).withColumn("part", part)
        cut = cut.groupBy(*inner, *carried, "part").agg(*ends_of)
        near = near_ranges(cut.withColumn("start", F.col("start") + before("part", "b", "near_low")))
    counted = (
        rows.select(*keys, "b", "x")
        .join(near, match)
        .groupBy(*inner, *carried, "x")
        .agg(F.count("x").alias("n"))
        .withColumn("start", F.col("start") + before("x", "b", "near_low"))
    )
    ends = []
    for name, position in positions.items():
        for side, rank in (("low", F.floor(position)), ("high", F.ceil(position))):
            inside = (F.col("start") <= rank) & (rank < end)
            ends.append(F.max(F.when(inside, F.col("x"))).alias(f"{name}_{side}"))
    found = counted.groupBy(*keys).agg(*[F.first(c).alias(c) for c in carried if c != "start"], *ends)
    result = []
    for name, position in positions.items():
        low, high = F.col(f"{name}_low"), F.col(f"{name}_high")
        result.append((low + (high - low) * (position - F.floor(position))).alias(name))
    return found.select(*([F.col("grp").alias(by)] if by else []), "values", *sums, *result)
