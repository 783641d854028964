"""Quality classifier: a factorisation machine over hashed words, structure statistics and the recorded length.

The score is the logistic function of w0 + sum w_i x_i + sum over pairs of <v_i, v_j> x_i x_j. The pair sum is taken in linear time as half of
(sum v_i x_i)^2 - sum (v_i x_i)^2, for each of the few columns of v. The model is fitted in numpy on a bounded sample of labelled rows and
then sent to the tasks, which score every whole text. Its size depends on parameters only.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brevita.llm.common import uniform
from brevita.llm.words import groups, mixed, word_hashes

BITS = 14
RANK = 8
SAMPLE_ROWS = 4096
THRESHOLD = 0.3

# Classes of bytes whose shares are statistics.
_CLASSES = {
    "lower": range(97, 123),
    "upper": range(65, 91),
    "digit": range(48, 58),
    "line": (10,),
    "blank": (9, 11, 12, 13, 32),
    "bar": (124,),
    "bang": (33, 63),
    "stop": (44, 46, 58, 59),
    "symbol": (35, 36, 37, 38, 42, 64, 94, 126),
    "beyond": range(128, 256),
}
_CLASS_OF = np.full(256, len(_CLASSES))
for _i, _bytes in enumerate(_CLASSES.values()):
    _CLASS_OF[list(_bytes)] = _i
STATISTICS = (*_CLASSES, "log_bytes", "log_words", "word_length", "distinct", "most_frequent", "same_as_before", "log_chars", "no_chars")


def _structure(text: bytes, hashes: np.ndarray, recorded: int | None) -> list[float]:
    """Statistics of a text; 0 for each that has no words or bytes to speak of."""
    n, size = len(hashes), max(1, len(text))
    shares = np.bincount(_CLASS_OF, np.bincount(np.frombuffer(text, np.uint8), minlength=256), len(_CLASSES) + 1)[:-1] / size
    if n:
        times = np.unique(hashes, return_counts=True)[1]
        shape = [len(text) / n, len(times) / n, times.max() / n, float((hashes[1:] == hashes[:-1]).sum()) / n]
    else:
        shape = [0.0] * 4
    chars = [np.log1p(max(0, recorded or 0)), float(recorded is None)]
    return [*shares, np.log1p(len(text)), np.log1p(n), *shape, *chars]


def features(
    texts: Sequence[bytes | None], recorded: Sequence[int | None], bits: int = BITS
) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """For groups of texts: offsets, hashed word indices and values, and statistics. A text's word values have length 1."""
    for part in groups(texts):
        chunk = [t or b"" for t in texts[part]]
        hashes, offsets = word_hashes([t.lower().split() for t in chunk])
        stats = np.array(
            [_structure(t, hashes[a:b], c) for t, a, b, c in zip(chunk, offsets[:-1], offsets[1:], recorded[part], strict=True)],
            np.float32,
        )
        text_no = np.repeat(np.arange(len(chunk)), np.diff(offsets))
        bucket = (mixed(hashes) >> np.uint64(64 - bits)).astype(np.int64)
        entry, times = np.unique((text_no << bits) | bucket, return_counts=True)
        owner = entry >> bits
        length = np.sqrt(np.bincount(owner, times.astype(np.float64) ** 2, len(chunk)))
        ends = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=len(chunk)))])
        yield ends, entry & ((1 << bits) - 1), (times / length[owner]).astype(np.float32), stats


@dataclass
class Model:
    bits: int
    mean: np.ndarray
    scale: np.ndarray
    bias: float
    weights: np.ndarray
    factors: np.ndarray

    def rows(self, ends, index, value, stats) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Words and scaled statistics of each text as one sparse row: starts, indices, values."""
        n, width = stats.shape
        scaled = np.clip((stats - self.mean) / self.scale, -4, 4) / np.sqrt(width)
        counts = np.diff(ends)
        starts = np.concatenate([[0], np.cumsum(counts + width)])
        where = np.arange(len(index)) + np.repeat(np.arange(n) * width, counts)
        all_index, all_value = np.empty(starts[-1], np.int64), np.empty(starts[-1], np.float32)
        all_index[where], all_value[where] = index, value
        places = (starts[1:, None] - width + np.arange(width)).ravel()
        all_index[places], all_value[places] = np.tile(np.arange(width) + (1 << self.bits), n), scaled.ravel()
        return starts, all_index, all_value

    def sums(self, starts, index, value):
        """Linear part, sum of v x, and sum of (v x)^2 of each row."""
        if len(starts) == 1:
            return np.zeros(0), np.zeros((0, self.factors.shape[1])), np.zeros((0, self.factors.shape[1]))
        moved = self.factors[index] * value[:, None]
        at = starts[:-1]
        linear = np.add.reduceat(self.weights[index] * value, at)
        return linear, np.add.reduceat(moved, at, axis=0), np.add.reduceat(moved * moved, at, axis=0)

    def logit(self, starts, index, value) -> np.ndarray:
        linear, s, squares = self.sums(starts, index, value)
        return self.bias + linear + 0.5 * (s * s - squares).sum(axis=1)

    def score(self, ends, index, value, stats) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logit(*self.rows(ends, index, value, stats)).astype(np.float64), -30, 30)))


def fit(
    ends: np.ndarray, index: np.ndarray, value: np.ndarray, stats: np.ndarray, labels: np.ndarray, bits: int = BITS,
    rank: int = RANK, epochs: int = 20, batch: int = 128, rate: float = 0.1, decay: float = 1e-4, seed: int = 3,
) -> Model:
    """Stochastic gradient with per-coordinate steps on the logistic loss. Without rows, a model that scores everything 0.5."""
    random = np.random.default_rng(seed)
    width = (1 << bits) + stats.shape[1]
    some = len(stats) > 0
    model = Model(
        bits,
        stats.mean(axis=0) if some else np.zeros(stats.shape[1], np.float32),
        np.maximum(stats.std(axis=0), 1e-3) if some else np.ones(stats.shape[1], np.float32),
        0.0,
        np.zeros(width, np.float32),
        random.normal(0, 0.05 if some else 0.0, (width, rank)).astype(np.float32),
    )
    starts, index, value = model.rows(ends, index, value, stats)
    seen_w, seen_v, seen_b = np.full(width, 1e-3, np.float32), np.full((width, rank), 1e-3, np.float32), 1e-3
    for _ in range(epochs):
        order = random.permutation(len(stats))
        for picked in np.split(order, range(batch, len(order), batch)):
            if not len(picked):
                continue
            counts = starts[picked + 1] - starts[picked]
            local = np.concatenate([[0], np.cumsum(counts)])
            entries = np.arange(local[-1]) + np.repeat(starts[picked] - local[:-1], counts)
            i, x = index[entries], value[entries]
            linear, s, squares = model.sums(local, i, x)
            logit = model.bias + linear + 0.5 * (s * s - squares).sum(axis=1)
            error = (1 / (1 + np.exp(-np.clip(logit, -30, 30))) - labels[picked]).astype(np.float32) / len(picked)
            each = np.repeat(error, counts) * x
            per_v = each[:, None] * (np.repeat(s, counts, axis=0) - model.factors[i] * x[:, None])
            touched, place = np.unique(i, return_inverse=True)
            by = np.argsort(place, kind="stable")
            at = np.concatenate([[0], np.cumsum(np.bincount(place))[:-1]])
            g_w = np.add.reduceat(each[by], at) + decay * model.weights[touched]
            g_v = np.add.reduceat(per_v[by], at, axis=0) + decay * model.factors[touched]
            seen_w[touched] += g_w * g_w
            seen_v[touched] += g_v * g_v
            model.weights[touched] -= rate * g_w / np.sqrt(seen_w[touched])
            model.factors[touched] -= rate * g_v / np.sqrt(seen_v[touched])
            seen_b += float(error.sum()) ** 2
            model.bias -= rate * float(error.sum()) / seen_b**0.5
    return model


def sample(labels: DataFrame, label: str, rows: int = SAMPLE_ROWS, seed: int = 11) -> DataFrame:
    """At most ``rows`` labelled ids, chosen by a hash: (doc_id, label). Ids that are null or have both labels are left out."""
    sure = (
        labels.filter(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1))
        .groupBy("doc_id")
        .agg(F.min(label).alias("_label"), F.max(label).alias("_most"))
        .filter("_label = _most")
        .drop("_most")
    )
    return sure.withColumn("_order", uniform(F.col("doc_id"), F.lit(seed))).orderBy("_order", "doc_id").limit(rows)


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", rows: int = SAMPLE_ROWS, bits: int = BITS) -> Model:
    """Fit on at most ``rows`` of the labelled documents: columns doc_id, text, n_chars, and doc_id, ``label`` (0, 1, else left out).

    Features are made in Spark; the driver gets at most ``rows`` sparse rows. Of rows with one id one is used.
    """
    chosen = sample(labels, label, rows)
    texts = docs.select("doc_id", "text", "n_chars").join(F.broadcast(chosen), "doc_id")  # at most ``rows`` rows
    texts = texts.groupBy("doc_id", "_order", "_label").agg(F.min(F.struct("text", "n_chars")).alias("d"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = features(batch.column("text").to_pylist(), batch.column("n_chars").to_pylist(), bits)
            rows = [
                (index[a:b], value[a:b], s)
                for ends, index, value, stats in made
                for a, b, s in zip(ends[:-1], ends[1:], stats, strict=True)
            ]
            kinds = (pa.list_(pa.int64()), pa.list_(pa.float32()), pa.list_(pa.float32()))
            columns = [pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)]
            names = ["_order", "_label", "index", "value", "stats"]
            yield pa.RecordBatch.from_arrays([batch.column("_order"), batch.column("_label"), *columns], names=names)

    made = texts.select(
        "_order", F.col("_label").cast("int").alias("_label"), F.col("d.text").cast("binary").alias("text"),
        F.col("d.n_chars").cast("bigint").alias("n_chars"),
    ).mapInArrow(run, "_order double, _label int, index array<bigint>, value array<float>, stats array<float>")
    got = made.toArrow().sort_by("_order")
    flat = lambda name, kind: (
        np.concatenate([np.zeros(0, kind), *(c.flatten().to_numpy(zero_copy_only=False) for c in got.column(name).chunks)])
    )
    counts = np.array([len(x) for x in got.column("index")], np.int64)
    ends = np.concatenate([[0], np.cumsum(counts)])
    stats = flat("stats", np.float32).reshape(-1, len(STATISTICS)).astype(np.float32)
    return fit(
        ends, flat("index", np.int64).astype(np.int64), flat("value", np.float32).astype(np.float32), stats,
        np.array(got.column("_label").to_pylist(), np.float32), bits,
    )


def score(docs: DataFrame, model: Model, keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """Score of every whole text: ``row`` (a struct of the columns in ``keep``, whatever their names) and score, from 0 to 1.

    Reads ``text`` and ``n_chars`` only. A null text counts as empty and is scored like any other; a null n_chars is a statistic of its own. Equal
    texts of equal n_chars have equal scores. Very long texts are scored whole, in time linear in their length. An empty table gives no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = features(batch.column("_text").to_pylist(), batch.column("_chars").to_pylist(), model.bits)
            scores = np.concatenate([np.zeros(0), *(model.score(*m) for m in made)])
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(scores, pa.float64())], names=["row", "score"])

    text, chars = F.col("text").cast("binary").alias("_text"), F.col("n_chars").cast("bigint").alias("_chars")
    rows = docs.select(F.struct(*keep).alias("row"), text, chars)
    return rows.mapInArrow(run, f"row {rows.schema['row'].dataType.simpleString()}, score double")
