"""Exact bootstrap: n rows drawn with replacement from n rows, for tables of any size.

The draws of a replicate fall to the rows as one multinomial. That splits exactly: a binary tree over hashed rows halves the draws by
conditional binomials from the root down to leaves of bounded size, and a leaf deals its share to its rows. Every draw depends on the seed, the model, the
replicate and the place in the tree alone, never on how the table is partitioned.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brevita.operators.rouge import INTERVAL, METRICS, REPLICATES
from brevita.session import pin

LEAF_ROWS = 4096
# Draws, or counts, that a task holds at once.
HELD = 4_000_000
# Rows that are equal in everything are one item with a weight; beyond so many rows an item, items get their counts by weight.
HEAVY = 64


def _random(seed: int, *place: int) -> np.random.Generator:
    return np.random.default_rng([seed, *place])


def leaf_draws(path: list[tuple[int, int, int, bool]], n: int, replicates: int, seed: int, model: int) -> np.ndarray:
    """Draws of each replicate that reach a leaf. ``path``: from the root down (parent's number in its level, rows in its left half, rows in all, whether the
    path goes right). Both halves of a node compute the same split."""
    draws = np.full(replicates, n, np.int64)
    for level, (parent, left, whole, right) in enumerate(path):
        taken = _random(seed, model, level, parent).binomial(draws, left / whole)
        draws = draws - taken if right else taken
    return draws


def dealt(draws: np.ndarray, times: np.ndarray, random: np.random.Generator):
    """Counts of each item (columns) in each replicate (rows), some replicates at a time: replicate ``r`` deals ``draws[r]`` to items by their weight ``times``."""
    total, k = int(times.sum()), len(times)
    heavy = total > HEAVY * k
    ends, step = np.cumsum(times), max(1, HELD // max(k, 1 if heavy else total))
    for at in range(0, len(draws), step):
        some = draws[at : at + step]
        if heavy:
            yield random.multinomial(some, times / total)
            continue
        drawn = random.integers(0, total, int(some.sum()))
        item = drawn if total == k else np.searchsorted(ends, drawn, "right")
        place = np.repeat(np.arange(len(some)), some) * k + item
        yield np.bincount(place, minlength=len(some) * k).reshape(len(some), k)


def _leaf_sums(replicates: int, seed: int, metrics: tuple[str, ...]):
    def run(items: pd.DataFrame, leaf: pd.DataFrame) -> pd.DataFrame:
        items = items.sort_values(["id", *metrics], kind="stable")
        (place,) = leaf.to_dict("records")
        path = sorted((p["level"], p["parent"], p["left"], p["whole"], p["right"]) for p in place["path"] if p["level"] is not None)
        draws = leaf_draws([p[1:] for p in path], int(place["total"]), replicates, seed, int(place["key"]))
        values = items[list(metrics)].to_numpy(np.float64)
        random = _random(seed, int(place["key"]), 64, int(place["leaf"]))
        counts = dealt(draws, items["times"].to_numpy(np.int64), random)
        sums = np.concatenate([part @ values for part in counts])
        out = pd.DataFrame(sums, columns=list(metrics))
        return out.assign(model=items["model"].iloc[0], replicate=np.arange(replicates), draws=draws)

    return run


def _nodes(leaves: DataFrame) -> DataFrame:
    """The path of each leaf (key, total, leaf, path) from the rows (key, depth, total, leaf, n) of all leaves."""
    levels = F.when(F.col("depth") > 0, F.sequence(F.lit(0), F.col("depth") - 1))
    steps = leaves.select("key", "leaf", "depth", F.explode(levels).alias("level"))
    parent = F.expr("shiftright(leaf, depth - level)")
    steps = steps.withColumn("parent", parent).withColumn("right", F.expr("shiftright(leaf, depth - level - 1) % 2 = 1"))
    split = leaves.select("key", "n", "leaf", "depth", F.explode(levels).alias("level")).select(
        "key", "level", parent.alias("parent"), F.when(F.expr("shiftright(leaf, depth - level - 1) % 2 = 0"), F.col("n")).otherwise(0).alias("l"), "n"
    )
    sizes = split.groupBy("key", "level", "parent").agg(F.sum("l").alias("left"), F.sum("n").alias("whole"))
    step = F.struct("level", "parent", "left", "whole", "right")
    paths = steps.join(sizes, ["key", "level", "parent"]).groupBy("key", "leaf").agg(F.collect_list(step).alias("path"))
    return leaves.select("key", "leaf", "total").join(paths, ["key", "leaf"], "left").withColumn("path", F.coalesce("path", F.array().cast(paths.schema["path"].dataType)))


def resampled(
    scores: DataFrame, replicates: int = REPLICATES, seed: int = 42, metrics: tuple[str, ...] = METRICS, leaf_rows: int = LEAF_ROWS
) -> DataFrame:
    """Bootstrap replicates (model, replicate from 0, draws, sums of the metrics): each draws as many rows of the model as it has, with replacement.

    Reads model, id and the metrics, which must not be null. Repeated rows count as often as they are there; rows that are equal in everything are one item with
    a weight, so no leaf of the tree grows with them. The same figures, up to the order of additions, for any partitioning; a seed names the draws of one numpy
    version. An empty table gives no rows. Work is rows times replicates, in leaves of about ``leaf_rows`` rows; a task sends ``replicates`` rows per model.
    """
    model_key = F.xxhash64(F.col("model")).bitwiseAND(F.lit((1 << 63) - 1)).alias("key")
    items = scores.select("model", "id", *[F.col(m).cast("double").alias(m) for m in metrics])
    items = items.groupBy("model", "id", *metrics).agg(F.count("*").alias("times")).withColumn("key", model_key)
    items = pin(items.withColumn("hash", F.xxhash64("id", *metrics)))
    # One row per model, bounded by their number; Catalyst broadcasts it by its written size.
    depth = F.greatest(F.lit(0), F.ceil(F.log2(F.count("*") / F.lit(float(leaf_rows))))).cast("int")
    models = pin(items.groupBy("key").agg(depth.alias("depth"), F.sum("times").alias("total")))
    leaf = F.expr("if(depth = 0, 0L, shiftrightunsigned(hash, 64 - depth))")
    placed = pin(items.join(models, "key").withColumn("leaf", leaf).drop("hash"))
    leaves = pin(placed.groupBy("key", "depth", "total", "leaf").agg(F.sum("times").alias("n")))
    shape = "model string, replicate bigint, draws bigint, " + ", ".join(f"{m} double" for m in metrics)
    sums = (
        placed.select("key", "leaf", "model", "id", "times", *metrics)
        .groupBy("key", "leaf")
        .cogroup(pin(_nodes(leaves)).groupBy("key", "leaf"))
        .applyInPandas(_leaf_sums(replicates, seed, metrics), shape)
    )
    return sums.groupBy("model", "replicate").agg(*[F.sum(c).alias(c) for c in ("draws", *metrics)])


def bootstrap_interval(
    scores: DataFrame, replicates: int = REPLICATES, seed: int = 42, metrics: tuple[str, ...] = METRICS, leaf_rows: int = LEAF_ROWS
) -> DataFrame:
    """Interval of each model's mean of each metric by exact resampling: model, and ``<metric>_low``, ``_mid``, ``_high`` (2.5, 50 and 97.5 percentiles of the
    replicates' means, linearly interpolated)."""
    bounds = F.array(*[F.lit(q) for q in INTERVAL])
    means: list[Column] = [F.percentile(F.col(m) / F.col("draws"), bounds).alias(m) for m in metrics]
    spreads = resampled(scores, replicates, seed, metrics, leaf_rows).groupBy("model").agg(*means)
    parts = [F.col(m)[k].alias(f"{m}_{part}") for m in metrics for k, part in enumerate(("low", "mid", "high"))]
    return spreads.select("model", *parts)
