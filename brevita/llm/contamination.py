"""Benchmark decontamination by winnowing.

A text's fingerprints are the smallest hashes of k-grams in every sliding window of k-grams. A span as long as k + window - 1 words
holds the same fingerprint wherever it stands, so every shared span of that length is found by a join on fingerprints. Each
hit is then extended: the document's windows are compared with all windows of the item. The fingerprints of documents stay where they
are if those of the benchmark are small enough for Spark to broadcast; otherwise both are shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brevita.llm.words import ALNUM, covered, groups, inside, sliding_min, window_hashes, word_hashes
from brevita.session import pin

SPAN = 10
GRAM = 5


def _words(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(ALNUM).split()


def _prints(hashes: np.ndarray, offsets: np.ndarray, span: int, gram: int, short: Sequence[int]) -> tuple[np.ndarray, np.ndarray]:
    """(text number, fingerprint) pairs, each once: winnowed ones, and the whole spans of the lengths in ``short``."""
    texts, prints = [], []
    smallest = sliding_min(window_hashes(hashes, gram), span - gram + 1)
    for width, values in [(span, smallest), *((n, window_hashes(hashes, n)) for n in short)]:
        text, at = inside(offsets, width)
        texts.append(text)
        prints.append(values[at])
    text, value = np.concatenate(texts), np.concatenate(prints)
    if len(value):
        # Neighbouring windows mostly share their minimum; what is left of repeats does no harm.
        fresh = np.ones(len(value), bool)
        fresh[1:] = (value[1:] != value[:-1]) | (text[1:] != text[:-1])
        text, value = text[fresh], value[fresh]
    return text, value


def _lists(text: np.ndarray, value: np.ndarray, n: int) -> pa.ListArray:
    """Values grouped by text number as an Arrow list column."""
    order = np.argsort(text, kind="stable")
    ends = np.zeros(n + 1, np.int32)
    np.cumsum(np.bincount(text, minlength=n), out=ends[1:])
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(value[order].view(np.int64)))


def _fingerprints(span: int, gram: int, short: Sequence[int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("_text").to_pylist()
            for part in groups(texts):
                hashes, offsets = word_hashes([_words(t) for t in texts[part]])
                found = _lists(*_prints(hashes, offsets, span, gram, short), len(offsets) - 1)
                ids = batch.column("doc_id").slice(part.start, part.stop - part.start)
                yield pa.RecordBatch.from_arrays([ids, found], names=["doc_id", "prints"])

    return run


def _item_windows(span: int, gram: int):
    shape = pa.schema([("item_id", pa.string()), ("width", pa.int32()), ("windows", pa.binary()), ("prints", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for ident, text in zip(batch.column("item_id").to_pylist(), batch.column("_text").to_pylist(), strict=True):
                hashes, offsets = word_hashes([_words(text)])
                if not len(hashes):
                    continue
                width = min(span, len(hashes))
                windows = np.unique(window_hashes(hashes, width))
                prints = windows if width < span else _prints(hashes, offsets, span, gram, ())[1]
                rows.append((ident, width, windows.tobytes(), np.unique(prints).view(np.int64).tolist()))
            if rows:
                columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), shape.types, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, schema=shape)

    return run


def _extend(text: bytes | None, items: list[dict] | None) -> tuple[int, int, list[str]]:
    """Words of the text, words inside any window of the items, ids of the items whose windows occur."""
    words = _words(text)
    if not items or not words:
        return len(words), 0, []
    hashes, _ = word_hashes([words])
    by_width = {w: window_hashes(hashes, w) for w in {x["width"] for x in items}}
    hit, found = np.zeros(len(words), bool), set()
    for x in items:
        windows = by_width[x["width"]]
        starts = np.flatnonzero(np.isin(windows, np.frombuffer(x["windows"], np.uint64)))
        if len(starts):
            hit |= covered(starts, x["width"], len(words))
            found.add(x["item_id"])
    return len(words), int(hit.sum()), sorted(x for x in found if x is not None)


def _extension(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [
            _extend(text.as_py(), items.as_py()) for text, items in zip(batch.column("_text"), batch.column("_items"), strict=True)
        ]
        n_words, n_hit, items = zip(*found, strict=True) if found else ((), (), ())
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("row"),
                pa.array(n_words, pa.int64()),
                pa.array(n_hit, pa.int64()),
                pa.array(items, pa.list_(pa.string())),
            ],
            names=["row", "n_words", "n_hit", "items"],
        )


def contaminated(
    docs: DataFrame, benchmark: DataFrame, keep: Sequence[str] = ("doc_id",), span: int = SPAN, gram: int = GRAM
) -> DataFrame:
    """Words of each document that stand in a window of ``span`` consecutive words of a benchmark item.

    Reads ``doc_id`` and ``text`` of ``docs``, ``item_id`` and ``text`` of ``benchmark``. Words are runs of ASCII letters, digits and
    all characters beyond ASCII, A-Z in lower case. An item of fewer words is one window as a whole; an item without words, or null,
    has none. One row per input row: ``row`` (a struct of the columns in ``keep``, whatever their names), n_words, n_hit, items (ids as
    strings, sorted). A null text has no words. A null item id hits words but is not listed; rows of equal item id are one item.
    Repeated rows and ids, and null ids, are judged by their own text, very long ones in all of their windows. Empty tables
    give no rows or no hits.

    Winnowed with ``gram`` words in windows that make up ``span``: no shared span of ``span`` words is missed. Items shorter than
    ``span`` are matched on all of the documents' spans of their length.
    """
    text = F.col("text").cast("binary").alias("_text")
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), text).mapInArrow(
        _item_windows(span, gram), "item_id string, width int, windows binary, prints array<bigint>"
    )
    items = pin(items)
    # Lengths below ``span``, so fewer than ``span`` rows.
    short = sorted(r[0] for r in items.filter(F.col("width") < span).select("width").distinct().collect())
    kind = docs.schema["doc_id"].dataType.simpleString()
    prints = docs.select("doc_id", text).mapInArrow(
        _fingerprints(span, gram, short), f"doc_id {kind}, prints array<bigint>"
    )
    shared = (
        prints.select("doc_id", F.explode("prints").alias("print"))
        .join(pin(items.select("item_id", F.explode("prints").alias("print"))), "print")
        .select("doc_id", "item_id")
        .distinct()
    )
    windows = items.select(F.col("item_id").alias("_item"), "width", "windows")
    hits = (
        shared.join(windows, F.col("item_id").eqNullSafe(F.col("_item")))
        .groupBy(F.col("doc_id").alias("_doc"))
        .agg(F.collect_list(F.struct("item_id", "width", "windows")).alias("_items"))
    )
    rows = docs.select(F.struct(*keep).alias("row"), text, F.col("doc_id").alias("_id"))
    shape = rows.schema["row"].dataType.simpleString()
    joined = rows.join(pin(hits), F.col("_id").eqNullSafe(F.col("_doc")), "left").select("row", "_text", "_items")
    return joined.mapInArrow(_extension, f"row {shape}, n_words bigint, n_hit bigint, items array<string>")
