"""Exact top-k search by inner product with cover trees on both sides.

Vectors are dealt to blocks of bounded size around a few pivots. A task indexes the data of its block and the queries that come to it in
one cover tree each, and walks over pairs of nodes. Over all points of two nodes the inner product is at most

    <cq, cx> + rq |cx| + rx |cq| + rq rx

with centres c and covering radii r, so a pair is dropped if that is below the worst kth score of the query node. Queries first search
the block they lie in. Their kth scores then tell, by the centres and radii of whole blocks, which other blocks they have to visit.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from brevita.session import pin

BLOCK_ROWS = 4096
PIVOTS = 256
SAMPLE_ROWS = 4096
GROUP_ROWS = 256
CHUNK_BLOCKS = 512
SALTS = 16
# Leaves are wide enough that a product of two of them outweighs the step that finds them.
LEAF = 64
QUERY_LEAF = 8
FANOUT = 64
BASE = 1.3
_NO_ID = np.iinfo(np.int64).max
EXACT = 2.0**53


# --- trees, in tasks -------------------------------------------------------------------------------------------------------


@dataclass
class Node:
    """A set of points (places in the matrix) around a centre, with the radius that covers them, and its children with their figures side by side."""

    points: np.ndarray
    centre: np.ndarray
    radius: float
    norm: float
    children: list[Node]
    centres: np.ndarray | None = None
    radii: np.ndarray | None = None
    norms: np.ndarray | None = None


def _node(x: np.ndarray, points: np.ndarray, centre: np.ndarray) -> Node:
    radius = float(np.sqrt(((x[points] - centre) ** 2).sum(axis=1).max()))
    return Node(points, centre, radius, float(np.sqrt((centre**2).sum())), [])


def farthest_first(x: np.ndarray, first: int, most: int, enough: float) -> tuple[list[int], np.ndarray]:
    """Places of centres, each the point farthest from those before it, until all points are within ``enough`` of one; and the nearest centre of
    each point."""
    centres, nearest = [first], np.zeros(len(x), np.int64)
    distance = ((x - x[first]) ** 2).sum(axis=1)
    while len(centres) < most and distance.max() > enough * enough:
        far = int(distance.argmax())
        to = ((x - x[far]) ** 2).sum(axis=1)
        nearest[to < distance] = len(centres)
        distance = np.minimum(distance, to)
        centres.append(far)
    return centres, nearest


def cover_tree(x: np.ndarray, leaf: int = LEAF, fanout: int = FANOUT, base: float = BASE) -> Node:
    """Cover tree over the rows of ``x`` (at least one). Children cover their points within the parent's radius over ``base``; the radii kept are the true ones.

    Where ``fanout`` centres do not cover that closely, as in many dimensions without clusters, children would bound hardly better than their parent: such a node
    stays a leaf, whatever its size, and its scores are taken in one product.
    """
    middle = int(((x - x.mean(axis=0)) ** 2).sum(axis=1).argmin())
    root = _node(x, np.arange(len(x)), x[middle])
    open_ = [root]
    while open_:
        node = open_.pop()
        if len(node.points) <= leaf or node.radius == 0:
            continue
        own = x[node.points]
        first = int(((own - node.centre) ** 2).sum(axis=1).argmin())
        centres, nearest = farthest_first(own, first, fanout, node.radius / base)
        parts = [node.points[nearest == i] for i in range(len(centres))]
        children = [_node(x, p, own[c]) for p, c in zip(parts, centres, strict=True)]
        if len(children) > 1 and max(c.radius for c in children) <= node.radius / base:
            node.children = children
            node.centres = np.array([c.centre for c in children])
            node.radii, node.norms = np.array([c.radius for c in children]), np.array([c.norm for c in children])
            open_ += children
    return root


def _bound(q: Node, centre: np.ndarray, radius, norm):
    """Most that an inner product of a point of ``q`` with one of a node, or of each of several, can be."""
    bound = centre @ q.centre + q.radius * norm + radius * (q.norm + q.radius)
    return bound + 1e-9 * np.abs(bound) + 1e-3  # more than rounding can take away


def upper_bound(q: Node, x: Node) -> float:
    return float(_bound(q, x.centre, x.radius, x.norm))


class Search:
    """The best ``k`` of the data for each query so far; ties go to the smaller id."""

    def __init__(self, queries: np.ndarray, query_ids: np.ndarray, worst: np.ndarray, k: int):
        self.q, self.ids, self.k = queries, query_ids, k
        self.worst = worst.astype(np.float64)  # a score that k others reach; -inf where unknown
        self.scores = np.full((len(queries), k), -np.inf)
        self.found = np.full((len(queries), k), _NO_ID, np.int64)
        self.filled = np.zeros((len(queries), k), bool)
        self.length = np.sqrt((queries**2).sum(axis=1))
        self.tree = cover_tree(self.q, leaf=QUERY_LEAF)

    def run(self, data: np.ndarray, data_ids: np.ndarray, tree: Node) -> None:
        stack = [(self.tree, tree, upper_bound(self.tree, tree))]
        while stack:
            q, x, bound = stack.pop()
            if bound < self.worst[q.points].min():
                continue
            if x.children and (len(x.points) >= len(q.points) or not q.children):
                bounds = _bound(q, x.centres, x.radii, x.norms)
                # The most promising on top; what cannot reach the worst kth score stays away.
                order = np.argsort(bounds)
                order = order[bounds[order] >= self.worst[q.points].min()]
                stack += [(q, x.children[i], bounds[i]) for i in order.tolist()]
            elif q.children:
                stack += [(c, x, bound) for c in q.children]
            else:
                # Each query by itself: its product with the centre, and the leaf's radius times its length.
                own = self.q[q.points] @ x.centre + self.length[q.points] * x.radius
                near = q.points[own + 1e-9 * np.abs(own) + 1e-3 >= self.worst[q.points]]
                if len(near):
                    self._leaf(near, x.points, data, data_ids)

    def _leaf(self, qs: np.ndarray, xs: np.ndarray, data: np.ndarray, data_ids: np.ndarray) -> None:
        """Scores of all pairs at once; those that may be among the best of their query join the ones held."""
        scores, ids = self.q[qs] @ data[xs].T, data_ids[xs]
        scores[ids[None, :] == self.ids[qs][:, None]] = -np.inf
        enough = self.worst[qs]
        if len(xs) > self.k:
            # No score below the kth of this leaf alone counts.
            enough = np.maximum(enough, np.partition(scores, len(xs) - self.k, axis=1)[:, len(xs) - self.k])
        row, column = np.nonzero((scores >= enough[:, None]) & (scores > -np.inf))
        if not len(row):
            return
        old_row, old_place = np.nonzero(self.filled[qs])
        rows = np.concatenate([old_row, row])
        s = np.concatenate([self.scores[qs][old_row, old_place], scores[row, column]])
        i = np.concatenate([self.found[qs][old_row, old_place], ids[column]])
        order = np.lexsort((i, -s, rows))
        rows, s, i = rows[order], s[order], i[order]
        first = np.searchsorted(rows, np.arange(len(qs)))
        place = np.arange(len(rows)) - first[rows]
        best = place < self.k
        rows, place, s, i = rows[best], place[best], s[best], i[best]
        at = qs[rows]
        self.scores[at, place], self.found[at, place], self.filled[at, place] = s, i, True
        full = place == self.k - 1
        self.worst[at[full]] = np.maximum(self.worst[at[full]], s[full])


def _matrix(cells: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(cells), np.int64).reshape(len(cells), -1).astype(np.float64)


def _by_key(batches: Iterator[pa.RecordBatch], keys: tuple[str, ...]) -> Iterator[tuple[tuple, dict[str, list]]]:
    """Columns, as lists, of each run of rows with equal ``keys``; a run never spans more than what shares a key."""
    held_key, held = None, {}
    for batch in batches:
        columns = {name: batch.column(name).to_pylist() for name in batch.schema.names}
        names = list(zip(*[columns[k] for k in keys], strict=True))
        start = 0
        for i in range(1, len(names) + 1):
            if i == len(names) or names[i] != names[start]:
                part = {c: v[start:i] for c, v in columns.items()}
                if held_key == names[start]:
                    for c, v in part.items():
                        held[c] += v
                else:
                    if held_key is not None:
                        yield held_key, held
                    held_key, held = names[start], part
                start = i
    if held_key is not None:
        yield held_key, held


_BLOCK = ("dim", "cell", "salt")


def _searched(k: int):
    """Task over rows sorted by block, data before queries, queries in groups: the best of the block for each query."""
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64())
    names = ["query_id", "query_hash", "vec_id", "score"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = None
        for (*place, group), rows in _by_key(batches, (*_BLOCK, "grp")):
            if group < 0:  # the data of the block
                block, data = place, _matrix(rows["vec"])
                ids = np.array([_NO_ID if i is None else i for i in rows["vec_id"]], np.int64)
                tree = cover_tree(data)
                continue
            if block != place:
                continue  # a block without data
            query_ids = np.array(rows["vec_id"], np.int64)
            worst = np.array([-np.inf if w is None else w for w in rows["worst"]], np.float64)
            search = Search(_matrix(rows["vec"]), query_ids, worst, k)
            search.run(data, ids, tree)
            at, place_ = np.nonzero(search.filled)
            found = search.found[at, place_]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(query_ids[at], kinds[0]),
                    pa.array(np.array(rows["query_hash"], np.int64)[at], kinds[1]),
                    pa.array(found, kinds[2], mask=found == _NO_ID),
                    pa.array(search.scores[at, place_].astype(np.int64), kinds[3]),
                ],
                names=names,
            )

    return run


def _summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Centre and covering radius of each block."""
    for place, rows in _by_key(batches, _BLOCK):
        x = _matrix(rows["vec"])
        centre = x.mean(axis=0)
        radius = float(np.sqrt(((x - centre) ** 2).sum(axis=1).max()))
        arrays = [pa.array([p], pa.int32()) for p in place]
        yield pa.RecordBatch.from_arrays(
            [*arrays, pa.array([centre.tobytes()], pa.binary()), pa.array([radius], pa.float64())], names=[*_BLOCK, "centre", "radius"]
        )


def _visits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From rows of a query group and a chunk of blocks, the other blocks that a query has to visit."""
    for batch in batches:
        for row in batch.to_pylist():
            queries, blocks, out = row["queries"], row["blocks"], []
            q = _matrix([x["vec"] for x in queries])
            centres = np.frombuffer(b"".join(b["centre"] for b in blocks), np.float64).reshape(len(blocks), -1)
            bound = q @ centres.T + np.sqrt((q**2).sum(axis=1))[:, None] * np.array([b["radius"] for b in blocks])
            bound += 1e-9 * np.abs(bound) + 1e-3
            worst = np.array([-np.inf if x["worst"] is None else x["worst"] for x in queries])
            home = np.array([[(x["cell"], x["salt"]) == (b["cell"], b["salt"]) for b in blocks] for x in queries])
            for i, j in np.argwhere((bound >= worst[:, None]) & ~home):
                x, b = queries[i], blocks[j]
                out.append((row["dim"], b["cell"], b["salt"], row["grp"], x["vec_id"], x["query_hash"], x["vec"], x["worst"]))
            if out:
                kinds = (pa.int32(),) * 4 + (pa.int64(), pa.int64(), pa.binary(), pa.int64())
                names = [*_BLOCK, "grp", "vec_id", "query_hash", "vec", "worst"]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)], names=names)


# --- the operator --------------------------------------------------------------------------------------------------------

_PLACED = "dim int, cell int, vec_id bigint, vec binary, is_query boolean"


def quantised(vector: Column, scale: int = 1024) -> Column:
    """floor(scale * x) of each component as long; null for a vector that is null, empty, or has a null or non-finite component."""
    wide = vector.cast("array<double>")
    good = F.forall(wide, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.when(good & (F.size(wide) > 0), F.transform(wide, lambda x: F.floor(x * scale)))


def _pivots(vectors: DataFrame, rows: int, most: int) -> dict[int, np.ndarray]:
    """By dimension, at most ``most`` pivots from at most ``rows`` vectors, chosen by a hash."""
    picked = vectors.orderBy(F.xxhash64("q"), "vec_id").limit(rows).select("q").collect()
    by_dim: dict[int, list] = {}
    for r in picked:
        by_dim.setdefault(len(r.q), []).append(r.q)
    found = {}
    for dim, q in by_dim.items():
        x = np.array(q, np.float64)
        found[dim] = x[farthest_first(x, 0, most, 0.0)[0]]
    return found


def top_k(
    vectors: DataFrame, is_query: Column, k: int = 10, block_rows: int = BLOCK_ROWS, pivots: int = PIVOTS, sample: int = SAMPLE_ROWS
) -> DataFrame:
    """The ``k`` rows of the largest integer inner product for each query: query_id, query_hash, rank (from 1), vec_id, score.

    ``vectors``: vec_id (integer) and ``q``, an array of longs, null rows left out; vectors whose squared length reaches 2^53 are refused, since inner products may. ``is_query`` is a condition on
    vec_id. Only vectors of one dimension are compared. Ties go to the smaller vec_id, null last. Rows with the query's own vec_id are not its
    candidates; other rows are candidates once each, repeated or not. A null vec_id is no query. Rows of one id and equal vectors are one query, of
    different vectors several, told apart by query_hash. Fewer than ``k`` candidates give fewer rows; an empty table none.
    """
    vectors = vectors.filter(F.col("q").isNotNull())
    size = F.aggregate("q", F.lit(0.0), lambda total, x: total + x.cast("double") * x.cast("double"))
    total, longest = vectors.agg(F.count("*"), F.max(size)).first()
    if longest is not None and longest >= EXACT:
        raise ValueError("inner products of these vectors can reach 2^53, beyond which doubles are not exact")
    centres = _pivots(vectors, sample, max(1, min(pivots, -(-total // block_rows))))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells, dims, packed = [], [], []
            for q in batch.column("q").to_pylist():
                x = np.array(q, np.int64)
                near = centres.get(len(x))
                cells.append(0 if near is None else int(((near - x) ** 2).sum(axis=1).argmin()))
                dims.append(len(x))
                packed.append(x.tobytes())
            yield pa.RecordBatch.from_arrays(
                [pa.array(dims, pa.int32()), pa.array(cells, pa.int32()), batch.column("vec_id"), pa.array(packed, pa.binary()), batch.column("is_query")],
                names=["dim", "cell", "vec_id", "vec", "is_query"],
            )

    asked = F.coalesce(is_query, F.lit(False)).alias("is_query")
    located = pin(vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), "q", asked).mapInArrow(place, _PLACED))
    sizes = located.groupBy("dim", "cell").agg(F.count("*").alias("n"))
    # Salts from the row's own place in its file part spread equal vectors and ids, too.
    salted = located.join(pin(sizes), ["dim", "cell"]).withColumn(
        "salt", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.ceil(F.col("n") / block_rows)).cast("int")
    )
    placed = pin(salted.drop("n"))
    asking = (
        placed.filter("is_query")
        .withColumn("query_hash", F.xxhash64("vec"))
        .dropDuplicates(["vec_id", "query_hash"])
        .select(*_BLOCK, "vec_id", "query_hash", "vec")
    )
    asking = pin(asking)
    data = placed.select(*_BLOCK, F.lit(-1).alias("grp"), "vec_id", F.lit(None).cast("bigint").alias("query_hash"), "vec", F.lit(None).cast("bigint").alias("worst"))

    def search(queries: DataFrame) -> DataFrame:
        return (
            data.unionByName(queries.select(data.columns))
            .repartition(*_BLOCK)
            .sortWithinPartitions(*_BLOCK, "grp")
            .mapInArrow(_searched(k), "query_id bigint, query_hash bigint, vec_id bigint, score bigint")
        )

    part = F.pmod(F.xxhash64("vec_id", "query_hash"), F.lit(-(-block_rows // GROUP_ROWS))).cast("int")
    home = pin(search(asking.withColumn("grp", part).withColumn("worst", F.lit(None).cast("bigint"))))
    worst = home.groupBy("query_id", "query_hash").agg(F.when(F.count("*") == k, F.min("score")).alias("worst"))

    summaries = placed.select(*_BLOCK, "vec").repartition(*_BLOCK).sortWithinPartitions(*_BLOCK)
    summaries = pin(summaries.mapInArrow(_summaries, "dim int, cell int, salt int, centre binary, radius double"))
    chunks = -(-summaries.count() // CHUNK_BLOCKS)
    chunk = F.pmod(F.xxhash64(*_BLOCK), F.lit(max(1, chunks))).cast("int")
    spread = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
    blocks = (
        summaries.groupBy("dim", chunk.alias("chunk"))
        .agg(F.collect_list(F.struct("cell", "salt", "centre", "radius")).alias("blocks"))
        .withColumn("s", spread)
    )
    counts = asking.groupBy("dim", "cell").agg(F.count("*").alias("n"))
    grp = F.pmod(F.xxhash64("query_hash", "vec_id"), F.ceil(F.col("n") / GROUP_ROWS)).cast("int")
    known = asking.join(worst.withColumnRenamed("query_id", "vec_id"), ["vec_id", "query_hash"], "left")
    grouped = (
        known.join(counts, ["dim", "cell"])
        .withColumn("grp", grp)
        .groupBy("dim", F.col("cell").alias("from"), "grp")
        .agg(F.collect_list(F.struct("cell", "salt", "vec_id", "query_hash", "vec", "worst")).alias("queries"))
        .withColumn("s", F.pmod(F.xxhash64("from", "grp"), F.lit(SALTS)))
        .withColumn("chunk", F.explode(F.sequence(F.lit(0), F.lit(max(0, chunks - 1)))))
    )
    names = [*_BLOCK, "grp", "vec_id", "query_hash", "vec", "worst"]
    visits = (
        grouped.join(blocks, ["dim", "chunk", "s"])
        .select("dim", (F.col("from") * 65536 + F.col("grp")).cast("int").alias("grp"), "queries", "blocks")
        .mapInArrow(_visits, "dim int, cell int, salt int, grp int, vec_id bigint, query_hash bigint, vec binary, worst bigint")
        .select(names)
    )
    best = Window.partitionBy("query_id", "query_hash").orderBy(F.col("score").desc(), F.col("vec_id").asc_nulls_last())
    return (
        home.unionByName(search(visits))
        .withColumn("rank", F.row_number().over(best))
        .filter(F.col("rank") <= k)
        .select("query_id", "query_hash", "rank", "vec_id", "score")
    )
