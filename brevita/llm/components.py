"""Connected components of a graph given as edges, by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brevita.session import pin


def _parents(edges: DataFrame) -> DataFrame:
    """(v, parent): the smallest of a vertex and its neighbours, followed one step further."""
    both = edges.select(F.col("a").alias("v"), F.col("b").alias("u")).unionByName(
        edges.select(F.col("b").alias("v"), F.col("a").alias("u"))
    )
    near = pin(both.groupBy("v").agg(F.min("u").alias("u")).select("v", F.least("v", "u").alias("parent")))
    next_step = near.select(F.col("v").alias("parent"), F.col("parent").alias("grand"))
    return near.join(next_step, "parent").select("v", F.col("grand").alias("parent"))


def connected(edges: DataFrame) -> DataFrame:
    """(v, root): the smallest vertex reachable from each vertex that occurs in ``edges`` (a, b: bigint).

    Every round maps vertices to the smallest vertex near them and replaces the edges by those between different images, so the graph
    shrinks at least by half; stars and cliques are gone after one round. Vertices with very many edges are minima over partial sums.
    """
    left, maps = pin(edges.filter("a <> b").distinct()), []
    while not left.isEmpty():
        parents = pin(_parents(left))
        maps.append(parents)
        of = lambda name: parents.select(F.col("v").alias(name), F.col("parent").alias(f"_{name}"))  # noqa: B023, E731
        moved = left.join(of("a"), "a").join(of("b"), "b").select(F.col("_a").alias("a"), F.col("_b").alias("b"))
        left = pin(moved.filter("a <> b").distinct())
    if not maps:
        return edges.select(F.col("a").alias("v"), F.col("b").alias("root")).limit(0)
    roots = maps[0].withColumnRenamed("parent", "root")
    for later in maps[1:]:
        moved = later.select(F.col("v").alias("root"), F.col("parent").alias("_root"))
        roots = roots.join(moved, "root", "left").select("v", F.coalesce("_root", "root").alias("root"))
    return roots
