"""Document fingerprints: bottom-k sketches of hashed word shingles.

The k smallest distinct hashes of a text's shingles stand for its whole set. Sketches of parts merge into that of the whole, and tell the
number of distinct shingles, the resemblance of two sets and how much of one the other contains.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brevita.llm.words import groups, window_hashes, word_hashes
from brevita.session import pin

WIDTH = 5
K = 128
# Rows of a hot key are merged in so many groups first.
SALTS = 64
_TOP = 2.0**64


# --- sketches, in tasks ------------------------------------------------------------------------------------------------------


def sketches(texts: list[bytes | None], width: int = WIDTH, k: int = K) -> list[np.ndarray]:
    """The ``k`` smallest distinct hashes, ascending, of each text's shingles of ``width`` words. Words are runs of anything but ASCII white space;
    fewer words are one shingle, a null text, or one without words, has none."""
    # ASCII white space, as bytes.split has it.
    hashes, offsets = word_hashes([(t or b"").split() for t in texts])
    windows = window_hashes(hashes, width)
    found = []
    for begin, end in zip(offsets[:-1], offsets[1:], strict=True):
        n = end - begin
        own = windows[begin : end - width + 1] if n >= width else window_hashes(hashes[begin:end], n) if n else hashes[:0]
        found.append(smallest(own, k))
    return found


def smallest(hashes: np.ndarray, k: int) -> np.ndarray:
    """The ``k`` smallest distinct values, ascending. Doubles the part it sorts while repeats leave too few."""
    take = 2 * k
    while take < len(hashes):
        low = np.unique(np.partition(hashes, take)[:take])
        if len(low) >= k:
            return low[:k]
        take *= 4
    return np.unique(hashes)[:k]


def resemblance(a: np.ndarray, b: np.ndarray, k: int = K) -> float:
    """Estimated share of the union that both sets hold, exact while the union has at most ``k`` shingles; two empty sets are alike."""
    union = np.union1d(a, b)[:k]
    return float(np.isin(union, np.intersect1d(a, b)).mean()) if len(union) else 1.0


# --- sketches as columns: arrays of long, in the order of unsigned numbers -----------------------------------------------------


def _flip(x: np.ndarray) -> np.ndarray:
    """Unsigned numbers as signed ones of the same order, and back."""
    return x ^ np.uint64(1 << 63)


def sketch_of(text: Column, width: int = WIDTH, k: int = K) -> Column:
    """Sketch of a text as an ascending array of at most ``k`` distinct longs; a null text has an empty one."""

    @F.pandas_udf("array<bigint>")
    def run(texts: pd.Series) -> pd.Series:
        data = [None if t is None else t.encode() for t in texts]
        found: list[np.ndarray] = []
        for part in groups(data):
            found += sketches(data[part], width, k)
        return pd.Series([_flip(x).view(np.int64) for x in found], dtype=object)

    return run(text)


def union_of(a: Column, b: Column, k: int = K) -> Column:
    """Sketch of the union of two sets from their sketches; null counts as empty."""
    none = F.array().cast("array<bigint>")
    return F.slice(F.array_sort(F.array_union(F.coalesce(a, none), F.coalesce(b, none))), 1, k)


def resemblance_of(a: Column, b: Column, k: int = K) -> Column:
    """As ``resemblance``, for sketches as columns."""
    union = union_of(a, b, k)
    both = F.size(F.array_intersect(union, F.array_intersect(a, b)))
    return F.when(F.size(union) == 0, F.lit(1.0)).otherwise(both / F.size(union))


def distinct_of(sketch: Column, k: int = K) -> Column:
    """Estimated number of distinct shingles, exact below ``k``."""
    # The kth smallest of n uniform numbers stands near k / n of the way.
    height = (F.element_at(sketch, -1).cast("double") + F.lit(2.0**63)) / F.lit(_TOP)
    return F.when(F.size(sketch) < k, F.size(sketch).cast("double")).otherwise(F.lit(k - 1.0) / height)


def containment_of(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of the first set that the second holds, 0 to 1; an empty set is contained in any."""
    share = resemblance_of(a, b, k) * distinct_of(union_of(a, b, k), k) / distinct_of(a, k)
    return F.when(F.size(a) == 0, F.lit(1.0)).otherwise(F.least(F.lit(1.0), share))


def merge_sketches(parts: DataFrame, key: str, sketch: str = "sketch", k: int = K) -> DataFrame:
    """One sketch per value of ``key`` (null is a value), that of the union of its parts: ``key`` and ``sketch``.

    Tasks merge what they read first, then the parts of a key in up to ``SALTS`` groups, so a key with a third of all rows is spread. Null and
    empty sketches add nothing; a key of only such has an empty one. Other columns are not read. No rows give no rows.
    """
    kind = parts.schema[key].dataType
    shape = f"key {kind.simpleString()}, sketch array<bigint>"

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict = {}

        def given() -> pa.RecordBatch:
            columns = [pa.array(list(held), batch.schema.field(0).type), pa.array([x.tolist() for x in held.values()], pa.list_(pa.int64()))]
            held.clear()
            return pa.RecordBatch.from_arrays(columns, names=["key", "sketch"])

        for batch in batches:
            for name, values in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                new = np.array([v for v in values or [] if v is not None], np.int64)
                held[name] = np.union1d(held[name], new)[:k] if name in held else np.unique(new)[:k]
            if len(held) > 50_000:
                yield given()
        if held:
            yield given()

    rows = parts.select(F.col(key).alias("key"), F.col(sketch).alias("sketch"))
    salted = rows.mapInArrow(merged, shape).withColumn("salt", F.pmod(F.xxhash64("sketch"), F.lit(SALTS)))
    for by in (["key", "salt"], ["key"]):
        salted = salted.repartition(*by).sortWithinPartitions(*by)
        salted = salted.select("key", "sketch").mapInArrow(merged, shape).withColumn("salt", F.pmod(F.xxhash64("sketch"), F.lit(SALTS)))
    # A task may give up a key twice when it holds very many; what is left of that meets in one small row each.
    flat = F.flatten(F.collect_list("sketch"))
    return salted.groupBy(F.col("key").alias(key)).agg(F.slice(F.array_sort(F.array_distinct(flat)), 1, k).alias("sketch"))


# --- each document, its neighbour and a text of both -----------------------------------------------------------------------------


def _written(sketch: np.ndarray) -> str:
    return sketch.astype(">u8").tobytes().hex()


def _neighbours(width: int, k: int):
    """Task over rows sorted by range and order, the head of the following range behind each: all but that head, with the next row's figures."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            for part in groups([t.as_py() for t in batch.column("text")]):
                piece = batch.slice(part.start, part.stop - part.start)
                if held is not None:
                    piece = pa.Table.from_batches([held, piece]).combine_chunks().to_batches()[0]
                if piece.num_rows > 1:
                    yield figures(piece)
                held = piece.slice(piece.num_rows - 1)

    def figures(piece: pa.RecordBatch) -> pa.RecordBatch:
        texts = [(t or b"").decode() for t in piece.column("text").to_pylist()]
        tail, place = piece.column("tail").to_pylist(), piece.column("range").to_pylist()
        # A head copied for the range before is a neighbour only; between two ranges there is none.
        kept = [i for i in range(len(texts) - 1) if not tail[i] and place[i] == place[i + 1]]
        n = [len(texts[i]) for i in kept]
        edited = [(texts[i][: m - m // 2] + texts[i + 1][: m // 2]).encode() for i, m in zip(kept, n, strict=True)]
        own = sketches([t.encode() for t in texts], width, k)
        new: list[np.ndarray] = []
        for part in groups(edited):
            new += sketches(edited[part], width, k)
        columns = [
            piece.column("row").take(pa.array(kept, pa.int64())),
            pa.array(n, pa.int64()),
            pa.array([hashlib.sha256(e).hexdigest() for e in edited], pa.string()),
            pa.array([_written(own[i]) for i in kept], pa.string()),
            pa.array([_written(x) for x in new], pa.string()),
            pa.array([resemblance(own[i], x, k) for i, x in zip(kept, new, strict=True)], pa.float64()),
            pa.array([resemblance(own[i], own[i + 1], k) for i in kept], pa.float64()),
        ]
        names = ["row", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
        return pa.RecordBatch.from_arrays(columns, names=names)

    return run


def compare_with_next(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",), width: int = WIDTH, k: int = K) -> DataFrame:
    """Fingerprints of each text and of an edited one, whose second half is the beginning of the next document.

    Reads ``doc_id`` (integer) and ``text``. Documents follow one another by descending doc_id, null last, rows of one id by a hash of the
    text; after the last comes the first, so a single row is its own neighbour. The last floor(n/2) of a text's n code points are replaced by the first as
    many of the next text, or all it has. One row per input row: ``row`` (a struct of the columns in ``keep``, whatever their names), n_chars,
    edited_sha256, fingerprint, edited_fingerprint (hashes of 16 hex digits each, ascending), near_edited and near_next, the estimated resemblance with the
    edited and with the next text: 0 to 1, exact for up to ``k`` shingles in both, 1 for two texts without words. A null text is empty, an
    empty one has the fingerprint ''. Equal texts have equal fingerprints. An empty table gives no row. A text is held whole by its task.

    Texts are shuffled once, into ranges of the order; each range also gets the first row of the following one.
    """
    # Descending without overflow, as one struct of fixed width.
    place = F.struct(F.col("doc_id").isNull().cast("int").alias("no"), F.coalesce(F.bitwise_not(F.col("doc_id").cast("bigint")), F.lit(0)).alias("at"), F.xxhash64("text").alias("hash"))
    spark = docs.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = pin(docs.select(place.alias("k")))
    ranges = keys.repartitionByRange(n, "k").groupBy(F.spark_partition_id()).agg(F.min("k").alias("k"))
    # One row per range, of fixed width: bounded by the number of ranges. Equal keys lie in one range.
    heads = sorted({tuple(r.k) for r in ranges.collect()}) or [(0, 0, 0)]
    # One literal, however many ranges there are.
    written = json.dumps([{"no": a, "at": b, "hash": c} for a, b, c in heads])
    bounds = F.from_json(F.lit(written), "array<struct<no: int, at: bigint, hash: bigint>>")
    steps = F.array(*[F.lit(1 << b) for b in reversed(range(len(heads).bit_length()))])
    # Binary search: how many bounds are not above the key.
    below = F.aggregate(steps, F.lit(0), lambda at, step: F.when(F.get(bounds, at + step - 1) <= F.col("k"), at + step).otherwise(at))
    rows = docs.select(F.struct(*keep).alias("row"), F.col("text").cast("binary").alias("text"), place.alias("k")).withColumn("range", below - 1)
    own = F.struct(F.col("range"), F.lit(False).alias("tail"))
    before = F.struct(F.pmod(F.col("range") - 1, F.lit(len(heads))).alias("range"), F.lit(True).alias("tail"))
    copies = F.when(F.get(bounds, F.col("range")) == F.col("k"), F.array(own, before)).otherwise(F.array(own))
    dealt = rows.select("row", "text", "k", F.explode(copies).alias("to")).select("row", "text", "k", "to.*")
    shape = dealt.schema["row"].dataType.simpleString()
    return (
        dealt.repartitionById(n, "range")
        .sortWithinPartitions("range", "tail", "k")
        .select("row", "text", "range", "tail")
        .mapInArrow(
            _neighbours(width, k),
            f"row {shape}, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double",
        )
    )
