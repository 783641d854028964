"""Near-duplicate groups by bottom-k sketches from one hash function.

1. Texts with equal shingle sets are one class. A class keeps the k smallest hashes of its set, its sketch.
2. Inverted lists: the key of a list is a run of three values that follow each other in a sketch, so that a frequent shingle alone makes no list.
   Two sets of Jaccard similarity 0.8 share such a run surely if they are small, and else but for one case in millions.
3. Every member of a list is compared with the list's smallest class by the estimate from the union of both sketches. Similar ones are joined. Jaccard
   distance is a metric, so whatever links to a member very near the smallest class is joined with it, too; only members that are not very near stay
   in the list, and are compared among each other.
4. What is joined so far is a cluster of candidates. Within a cluster all full sets are compared exactly, in blocks, by matrix products; of each
   block only the edges of a spanning forest leave the task.
5. Components of the exact edges give the groups.

No step emits pairs of a group: a list yields one edge a member, a block one edge a class.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brevita.llm.components import connected
from brevita.llm.words import groups, window_hashes, word_hashes
from brevita.session import pin

SKETCH = 64
KEYED = 48
LOOSE, TIGHT, ALIKE = 0.4, 0.8, 0.55
LIST_BLOCK = 1024
BLOCK_CLASSES = 512
BLOCK_SHINGLES = 2_000_000
_COLUMNS = 8192
_EVER = np.iinfo(np.int64).max


# --- sets and sketches ---------------------------------------------------------------------------------------------------


def shingle_sets(texts: list[bytes | None], width: int) -> Iterator[np.ndarray]:
    """Sorted distinct hashes of each text's shingles of ``width`` words; of fewer words the whole sequence is one."""
    for part in groups(texts):
        hashes, offsets = word_hashes([(t or b"").lower().split() for t in texts[part]])
        for a, b in zip(offsets[:-1], offsets[1:], strict=True):
            yield np.unique(window_hashes(hashes[a:b], min(width, max(1, b - a))).view(np.int64))


def _digest(values: np.ndarray) -> bytes:
    """128 bits that depend on the whole set: sums of two mixed forms of its members."""
    x = values.view(np.uint64)
    with np.errstate(over="ignore"):
        one = x * np.uint64(0x9FB21C651E98DF25)
        one ^= one >> np.uint64(29)
        two = (x ^ (x >> np.uint64(31))) * np.uint64(0xC2B2AE3D27D4EB4F)
        two ^= two >> np.uint64(33)
        return one.sum(dtype=np.uint64).tobytes() + two.sum(dtype=np.uint64).tobytes()


def _sketches(width: int, size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [(len(s), _digest(s), s[:size]) for s in shingle_sets(batch.column("_text").to_pylist(), width)]
            n, digest, sketch = zip(*sets, strict=True) if sets else ((), (), ())
            columns = [pa.array(n, pa.int64()), pa.array(digest, pa.binary()), pa.array(sketch, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_hash"), *columns],
                names=["doc_id", "text_hash", "n_shingles", "digest", "sketch"],
            )

    return run


def _keys(keyed: int) -> Column:
    """Hashes of the runs of three among the first values; of two as well for sets of four or five."""

    def runs(length: int) -> Column:
        last = F.least(F.col("n_shingles"), F.lit(keyed)) - length + 1
        return F.transform(
            F.sequence(F.lit(1), last.cast("int")), lambda i: F.xxhash64(F.slice(F.col("sketch"), i, length), F.lit(length))
        )

    n = F.col("n_shingles")
    return F.when(n < 4, F.array().cast("array<bigint>")).when(n < 6, F.concat(runs(2), runs(3))).otherwise(runs(3))


def estimate(one: Column, n_one: Column, two: Column, n_two: Column, size: int = SKETCH) -> Column:
    """Jaccard similarity from the sketch of the union: the values up to the smaller of the two last values.

    Exact if both sets fit in their sketches.
    """
    ever = F.lit(_EVER)
    limit = F.least(
        F.when(n_one > size, F.element_at(one, -1)).otherwise(ever), F.when(n_two > size, F.element_at(two, -1)).otherwise(ever)
    )
    common = F.size(F.array_intersect(one, two))
    upto = lambda s: F.size(F.filter(s, lambda v: v <= limit))
    return common / (upto(one) + upto(two) - common)


# --- comparing many sets in one task ---------------------------------------------------------------------------------------


def common_counts(sets: list[np.ndarray]) -> np.ndarray:
    """Matrix of intersection sizes, as products of 0-1 matrices over the values that occur in more than one set."""
    m = len(sets)
    owner = np.repeat(np.arange(m), [len(s) for s in sets])
    _, column, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = times > 1
    place = np.cumsum(shared) - 1
    keep = shared[column]
    owner, column = owner[keep], place[column[keep]]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    total = np.zeros((m, m), np.float32)
    for start in range(0, int(shared.sum()), _COLUMNS):
        a, b = np.searchsorted(column, [start, start + _COLUMNS])
        part = np.zeros((m, min(_COLUMNS, int(shared.sum()) - start)), np.float32)
        part[owner[a:b], column[a:b] - start] = 1
        total += part @ part.T
    np.fill_diagonal(total, [len(s) for s in sets])
    return total.astype(np.int64)


def forest(linked: np.ndarray) -> np.ndarray:
    """Smallest member reachable from each member of a symmetric relation."""
    label = np.arange(len(linked))
    while True:
        least = np.minimum(label, np.where(linked, label[None, :], len(label)).min(axis=1, initial=len(label)))
        least = least[least]
        if (least == label).all():
            return label
        label = least


def _alike(sketches: list[np.ndarray], sizes: np.ndarray, size: int, least: float) -> np.ndarray:
    limits = np.array([s[-1] if n > size else _EVER for s, n in zip(sketches, sizes, strict=True)])
    upto = np.stack([np.searchsorted(s, limits, side="right") for s in sketches])
    common = common_counts(sketches)
    return common >= least * (upto + upto.T - common)


def _grouped(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[list[tuple]]:
    """Rows of sorted batches, one list for each value of the first ``keys`` columns."""
    held: list[tuple] = []
    for batch in batches:
        for row in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            if held and held[0][:keys] != row[:keys]:
                yield held
                held = []
            held.append(row)
    if held:
        yield held


def _edges(pairs: list[tuple[int, int]]) -> pa.RecordBatch:
    a, b = zip(*pairs, strict=True) if pairs else ((), ())
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


def _compared(keys: int, linked):
    """Task that turns groups of rows (keys, class, ...) into the edges of a spanning forest of ``linked(rows)``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple[int, int]] = []
        for rows in _grouped(batches, keys):
            rows = list({r[keys]: r for r in rows}.values())
            if len(rows) > 1:
                root = forest(linked(rows))
                out += [(rows[i][keys], rows[r][keys]) for i, r in enumerate(root) if i != r]
            if len(out) > 10_000:
                yield _edges(out)
                out = []
        yield _edges(out)

    return run


def _blocks(df: DataFrame, group: str, ident: str, count: Column) -> DataFrame:
    """Deals each group over ``count`` blocks and repeats a row for every pair of blocks that its block is in: columns i, j.

    One block meets itself; of more, each pair meets once, and rows of one block meet in each of its pairs.
    """
    own = F.pmod(F.xxhash64(ident), count).cast("int")
    other = F.explode(F.when(count == 1, F.array(F.lit(0))).otherwise(F.array_remove(F.sequence(F.lit(0), (count - 1).cast("int")), own)))
    dealt = df.withColumn("_other", other).withColumn("_own", own)
    return dealt.withColumn("i", F.least("_own", "_other")).withColumn("j", F.greatest("_own", "_other")).drop("_own", "_other")


# --- the operator --------------------------------------------------------------------------------------------------------


def _candidate_edges(classes: DataFrame, size: int, keyed: int) -> DataFrame:
    """Edges (a, b) between classes that may be linked, enough to connect all that are."""
    posted = classes.select("cls", F.explode(_keys(keyed)).alias("key"))
    heads = posted.groupBy("key").agg(F.min("cls").alias("head"), F.count("*").alias("n")).filter("n > 1").select("key", "head")
    members = pin(posted.join(heads, "key").filter("cls <> head"))
    sketch = lambda name: classes.select(
        F.col("cls").alias(name), F.col("sketch").alias(f"s_{name}"), F.col("n_shingles").alias(f"n_{name}")
    )
    similarity = estimate(F.col("s_cls"), F.col("n_cls"), F.col("s_head"), F.col("n_head"), size)
    pairs = members.select("cls", "head").distinct()
    pairs = pin(pairs.join(sketch("cls"), "cls").join(sketch("head"), "head").select("cls", "head", similarity.alias("alike")))
    near = pairs.filter(F.col("alike") >= LOOSE).select(F.col("cls").alias("a"), F.col("head").alias("b"))

    # Not very near their head: compared among each other.
    far = members.join(pairs.filter(F.col("alike") < TIGHT).select("cls", "head"), ["cls", "head"]).select("key", "cls").distinct()
    far = pin(far)
    counts = far.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1")
    rest = far.join(counts, "key").join(classes.select("cls", "sketch", "n_shingles"), "cls")
    dealt = _blocks(rest, "key", "cls", F.ceil(F.col("n") / LIST_BLOCK))

    def linked(rows: list[tuple]) -> np.ndarray:
        return _alike([np.array(r[4], np.int64) for r in rows], np.array([r[5] for r in rows]), size, ALIKE)

    order = ("key", "i", "j")
    compared = (
        dealt.select(*order, "cls", "sketch", "n_shingles")
        .repartition(*order)
        .sortWithinPartitions(*order)
        .mapInArrow(_compared(3, linked), "a bigint, b bigint")
    )
    return near.unionByName(compared)


def _exact_edges(docs: DataFrame, classes: DataFrame, clusters: DataFrame, width: int, percent: int) -> DataFrame:
    """Spanning edges of the links between classes of one cluster, on full sets."""
    named = classes.select("cls", "doc_id", "text_hash", "n_shingles").join(clusters.withColumnRenamed("v", "cls"), "cls")
    sizes = named.groupBy("root").agg(F.count("*").alias("n"), F.sum("n_shingles").alias("total"))
    wanted = named.join(sizes, "root").select(
        F.col("doc_id").alias("_doc"),
        F.col("text_hash").alias("_hash"),
        "cls",
        "root",
        F.greatest(F.ceil(F.col("n") / BLOCK_CLASSES), F.ceil(F.col("total") / BLOCK_SHINGLES)).alias("blocks"),
    )
    held = docs.join(wanted, F.col("doc_id").eqNullSafe(F.col("_doc")) & F.col("text_hash").eqNullSafe(F.col("_hash")))
    dealt = _blocks(held.select("root", "cls", "blocks", "_text"), "root", "cls", F.col("blocks"))

    def linked(rows: list[tuple]) -> np.ndarray:
        sets = list(shingle_sets([r[4] for r in rows], width))
        common, n = common_counts(sets), np.array([len(s) for s in sets])
        return 100 * common >= percent * (n[:, None] + n[None, :] - common)

    order = ("root", "i", "j")
    return (
        dealt.select(*order, "cls", "_text")
        .repartition(*order)
        .sortWithinPartitions(*order)
        .mapInArrow(_compared(3, linked), "a bigint, b bigint")
    )


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80, size: int = SKETCH, keyed: int = KEYED) -> DataFrame:
    """Groups of documents linked by shingle sets with 100 * intersection >= ``percent`` * union, ``percent`` at least 80.

    Reads ``doc_id`` (integer) and ``text``; other columns are ignored. A-Z count as a-z; words are runs of anything but ASCII white space;
    a set holds the distinct sequences of ``width`` words, or the whole sequence of a shorter text. A text that is null or has no
    words has an empty set and no links. One row per input row: doc_id, text_hash (tells rows of one id apart), n_shingles,
    component_id (smallest doc_id reachable, its own included), kept (doc_id equals component_id). A null id is smaller than none; a group of null
    ids only has a null component_id and is kept. Repeated rows have equal results. Also ``component``, a number of the group that tells groups
    of one component_id apart, null for a text without words. Very long texts are
    compared by their whole sets. An empty table gives an empty result.
    """
    if percent < 80:
        raise ValueError("the inverted lists are made for similarities of 80 percent or more")
    keyed_docs = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64("text").alias("text_hash"), F.col("text").cast("binary").alias("_text")
    )
    shape = "doc_id bigint, text_hash bigint, n_shingles bigint, digest binary, sketch array<bigint>"
    sets = pin(keyed_docs.mapInArrow(_sketches(width, size), shape))
    of_class = ("doc_id", "text_hash", "n_shingles", "sketch")
    classes = (
        sets.filter("n_shingles > 0")
        .groupBy("digest")
        .agg(F.min("doc_id").alias("least"), *[F.first(c).alias(c) for c in of_class])
        .withColumn("cls", F.monotonically_increasing_id())
    )
    classes = pin(classes)  # from here on the numbers stand
    clusters = pin(connected(_candidate_edges(classes, size, keyed)))
    exact = pin(_exact_edges(keyed_docs, classes, clusters, width, percent))
    roots = pin(connected(exact))
    named = classes.select("digest", "least", "cls").join(roots.withColumnRenamed("v", "cls"), "cls", "left")
    named = named.withColumn("root", F.coalesce("root", "cls"))
    ids = named.groupBy("root").agg(F.min("least").alias("component_id"))
    known = named.select("digest", "root").join(ids, "root").select("digest", "component_id", F.col("root").alias("component"), F.lit(True).alias("_known"))
    component = F.when(F.col("_known"), F.col("component_id")).otherwise(F.col("doc_id"))
    empty = F.when(F.col("n_shingles") > 0, F.col("digest"))
    return (
        sets.select("doc_id", "text_hash", "n_shingles", empty.alias("digest"))
        .join(known, "digest", "left")
        .withColumn("component_id", component)
        .select("doc_id", "text_hash", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"), "component")
    )
