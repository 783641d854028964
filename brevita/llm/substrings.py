"""Substring deduplication on Rabin-Karp hashes of all fixed-length word windows.

The first of equal windows, by document and start, stays; the words of all others go. Shuffling every window of the corpus would
move several times its size, so windows are counted in two steps. Each window is known by its anchor, the smallest hash of the short
grams in it. Neighbouring windows share anchors, and equal windows have equal anchors, so a window whose anchor occurs once in the whole corpus
cannot repeat. Only the anchors, each once per document, are counted first; then the hashes of those windows whose anchor repeats.
The words that stand in a repeated window form maximal intervals, which are cut in one last pass over the texts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brevita.llm.words import covered, groups, sliding_min, window_hashes, word_hashes
from brevita.session import pin

WINDOW = 20
GRAM = 5


class _Windows:
    """Hashes of one text's windows, their anchors, and the anchors that occur at two places of the text."""

    def __init__(self, hashes: np.ndarray, window: int, gram: int):
        grams = window_hashes(hashes, gram)
        self.anchors = sliding_min(grams, window - gram + 1)
        self.hashes = window_hashes(hashes, window)
        found, times = np.unique(grams, return_counts=True)
        self.own = np.intersect1d(self.anchors, found[times > 1])

    def candidates(self, repeated: np.ndarray) -> np.ndarray:
        """Starts of the windows that may occur elsewhere, or twice here."""
        return np.flatnonzero(np.isin(self.anchors, repeated) | np.isin(self.anchors, self.own))


def _hashed(texts: Sequence[bytes | None]) -> Iterator[tuple[list[bytes], np.ndarray]]:
    """Words and word hashes of each text, hashed in groups."""
    for part in groups(texts):
        words = [(t or b"").split() for t in texts[part]]
        hashes, offsets = word_hashes(words)
        for i, w in enumerate(words):
            yield w, hashes[offsets[i] : offsets[i + 1]]


def _longs(values: np.ndarray) -> np.ndarray:
    return values.view(np.int64)


def _anchors(window: int, gram: int):
    kinds = (pa.list_(pa.int64()), pa.list_(pa.int64()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for _, hashes in _hashed(batch.column("_text").to_pylist()):
                w = _Windows(hashes, window, gram)
                rows.append((_longs(np.unique(w.anchors)), _longs(w.own)))
            columns = [pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([batch.column("k1"), batch.column("k2"), *columns], names=["k1", "k2", "anchors", "own"])

    return run


def _candidates(window: int, gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            repeated = batch.column("repeated")
            for i, (_, hashes) in enumerate(_hashed(batch.column("_text").to_pylist())):
                w = _Windows(hashes, window, gram)
                starts = w.candidates(_uint64(repeated[i]))
                found.append(_longs(np.unique(w.hashes[starts])))
            windows = pa.array(found, pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([batch.column("k1"), batch.column("k2"), windows], names=["k1", "k2", "windows"])

    return run


def _uint64(cell: pa.Scalar) -> np.ndarray:
    """A list of longs as hashes; null is empty."""
    return cell.values.to_numpy(zero_copy_only=False).view(np.uint64) if cell.is_valid else np.zeros(0, np.uint64)


def _cut(window: int, gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            repeated, first, rows = batch.column("repeated"), batch.column("first"), []
            for i, (words, hashes) in enumerate(_hashed(batch.column("_text").to_pylist())):
                removed = 0
                if repeated[i].is_valid:
                    w = _Windows(hashes, window, gram)
                    starts = w.candidates(_uint64(repeated[i]))
                    values = w.hashes[starts]
                    stays = np.zeros(len(starts), bool)
                    stays[np.unique(values, return_index=True)[1]] = True
                    stays &= np.isin(values, _uint64(first[i]))
                    if not stays.all():
                        gone = covered(starts[~stays], window, len(words))
                        removed = int(gone.sum())
                        kept = [words[j] for j in np.flatnonzero(~gone)]
                        rows.append((len(words), removed, b" ".join(kept)))
                        continue
                rows.append((len(words), 0, b" ".join(words)))
            n, gone, kept = zip(*rows, strict=True) if rows else ((), (), ())
            digests = [hashlib.sha256(k).hexdigest() for k in kept]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("row"),
                    pa.array(n, pa.int64()),
                    pa.array(gone, pa.int64()),
                    pa.array(kept, pa.binary()),
                    pa.array(digests, pa.string()),
                ],
                names=["row", "n_words", "n_removed", "kept", "kept_sha256"],
            )

    return run


def _only_digest(batches: Iterator[pa.RecordBatch], cut) -> Iterator[pa.RecordBatch]:
    for batch in cut(batches):
        yield batch.drop_columns(["kept"])


def _keys(ident: Column, text: Column) -> list[Column]:
    """Null ids would all be one key, so the text tells them apart."""
    return [ident.cast("bigint").alias("k1"), F.when(ident.isNull(), F.xxhash64(text)).otherwise(F.lit(0)).alias("k2")]


def _on_keys(left: DataFrame, right: DataFrame, how: str) -> DataFrame:
    right = right.withColumnsRenamed({"k1": "_k1", "k2": "_k2"})
    same = F.col("k1").eqNullSafe(F.col("_k1")) & (F.col("k2") == F.col("_k2"))
    return left.join(right, same, how).drop("_k1", "_k2")


def remove_repeats(
    docs: DataFrame, keep: Sequence[str] = ("doc_id",), window: int = WINDOW, gram: int = GRAM, texts: bool = True
) -> DataFrame:
    """Cut every word that is covered by a window of ``window`` words which also starts earlier.

    Reads ``doc_id`` (integer) and ``text``. Words are runs of anything but ASCII white space, unchanged; null has none. Earlier is a
    smaller doc_id, or the same document and an earlier start; all windows are judged on the input. One row per input row: ``row`` (a struct of
    the columns in ``keep``, whatever their names), n_words, n_removed, kept (the other words joined by one blank, UTF-8 bytes; not with
    ``texts=False``) and kept_sha256.

    Rows with a null id come after all others, in an order given by a hash of their text. Among rows that share an id each keeps its own first
    occurrence, so repeated rows are treated alike. Texts with fewer words than a window lose nothing; very long ones are
    judged in all of their windows. Empty tables give no rows.
    """
    if not 0 < gram <= window:
        raise ValueError("gram must be at least 1 and at most window")
    text = F.col("text").cast("binary").alias("_text")
    keyed = docs.select(*_keys(F.col("doc_id"), F.col("text")), text)
    anchors = pin(
        keyed.mapInArrow(_anchors(window, gram), "k1 bigint, k2 bigint, anchors array<bigint>, own array<bigint>")
    )
    each = anchors.select("k1", "k2", F.explode("anchors").alias("anchor"))
    twice = each.groupBy("anchor").agg(F.count("*").alias("n")).filter("n > 1").select("anchor")
    own = anchors.select("k1", "k2", F.explode("own").alias("anchor"))
    repeated = pin(
        each.join(twice, "anchor")
        .select("k1", "k2", "anchor")
        .unionByName(own)
        .groupBy("k1", "k2")
        .agg(F.collect_set("anchor").alias("repeated"))
    )
    windows = _on_keys(keyed, repeated, "inner").mapInArrow(
        _candidates(window, gram), "k1 bigint, k2 bigint, windows array<bigint>"
    )
    # Two fixed-width minima: of the ids, and of the text hashes that stand for null ids.
    least = (
        windows.select("k1", "k2", F.explode("windows").alias("window"))
        .groupBy("window")
        .agg(F.min("k1").alias("k1"), F.min(F.when(F.col("k1").isNull(), F.col("k2"))).alias("rest"))
    )
    first = (
        least.select("window", "k1", F.when(F.col("k1").isNull(), F.col("rest")).otherwise(F.lit(0)).alias("k2"))
        .groupBy("k1", "k2")
        .agg(F.collect_list("window").alias("first"))
    )
    known = pin(_on_keys(repeated, first, "left"))
    rows = docs.select(F.struct(*keep).alias("row"), *_keys(F.col("doc_id"), F.col("text")), text)
    shape = f"row {rows.schema['row'].dataType.simpleString()}, n_words bigint, n_removed bigint"
    joined = _on_keys(rows, known, "left").select("row", "_text", "repeated", "first")
    cut = _cut(window, gram)
    if texts:
        return joined.mapInArrow(cut, f"{shape}, kept binary, kept_sha256 string")
    return joined.mapInArrow(lambda batches: _only_digest(batches, cut), f"{shape}, kept_sha256 string")
