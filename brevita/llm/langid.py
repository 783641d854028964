"""Language identification with a convolutional network over bytes.

A text is cut into windows of a fixed number of bytes, the last one filled up with zeros. Filters of several widths slide over a
window, each keeps its largest answer, and a softmax layer maps those to languages. A text's languages are scored by the mean of its
windows' outputs. The network is trained in numpy on a bounded labelled sample; tasks apply it to batches of windows of all texts.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from brevita.llm.common import uniform
from brevita.session import pin

WIDTHS = (2, 3, 4)
FILTERS = 16
SIZE = 128
PER_LANGUAGE = 500
WINDOWS_PER_TEXT = 4
UNKNOWN = "und"
_AT_ONCE = 512


def windows(text: bytes, size: int = SIZE) -> np.ndarray:
    """The text's bytes as rows of ``size``, without overlap, the last one filled with zeros; at least one row."""
    rows = max(1, -(-len(text) // size))
    flat = np.zeros(rows * size, np.uint8)
    flat[: len(text)] = np.frombuffer(text, np.uint8)
    return flat.reshape(rows, size)


@dataclass
class Network:
    """``filters[w]``: weights (width, 256, filters) over one-hot bytes; ``out``: (all filters, languages)."""

    languages: list[str]
    filters: dict[int, np.ndarray]
    bias: np.ndarray
    out: np.ndarray
    out_bias: np.ndarray
    tables: dict = field(default_factory=dict, repr=False)

    def prepared(self) -> Network:
        """Adds tables that answer for two neighbouring bytes at once."""
        pair = lambda w, j: (w[j][:, None, :] + w[j + 1][None, :, :]).reshape(65536, -1)
        starts = [pair(w, 0) for w in self.filters.values()]
        self.tables = {"starts": np.ascontiguousarray(np.concatenate(starts, axis=1))}
        for width, w in self.filters.items():
            later = [(j, pair(w, j)) for j in range(2, width - 1, 2)]
            self.tables[width] = later, (width - 1, w[width - 1]) if width % 2 else None
        return self

    def pooled(self, x: np.ndarray) -> np.ndarray:
        """Largest answer of each filter in each window (rows of bytes)."""
        pairs = x[:, :-1].astype(np.int64) << 8 | x[:, 1:]
        first = self.tables["starts"][pairs]
        out, at = [], 0
        for width, w in self.filters.items():
            n, count = x.shape[1] - width + 1, w.shape[2]
            z = first[:, :n, at : at + count]
            later, last = self.tables[width]
            for j, two in later:
                z = z + two[pairs[:, j : j + n]]
            if last:
                z = z + last[1][x[:, last[0] : last[0] + n]]
            out.append(z.max(axis=1))
            at += count
        return np.concatenate(out, axis=1)

    def logits(self, x: np.ndarray) -> np.ndarray:
        parts = [self.pooled(x[i : i + _AT_ONCE]) for i in range(0, len(x), _AT_ONCE)]
        return np.maximum(np.concatenate(parts) + self.bias, 0) @ self.out + self.out_bias


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def fit(
    x: np.ndarray, label: np.ndarray, languages: Sequence[str], widths: Sequence[int] = WIDTHS, filters: int = FILTERS,
    epochs: int = 6, batch: int = 64, rate: float = 0.01, seed: int = 7,
) -> Network:
    """Adam on the cross entropy of windows (rows of bytes) with labels (places in ``languages``)."""
    random = np.random.default_rng(seed)
    every = filters * len(widths)
    net = Network(
        list(languages),
        {w: random.normal(0, 0.1, (w, 256, filters)).astype(np.float32) for w in widths},
        np.zeros(every, np.float32),
        random.normal(0, 0.2, (every, len(languages))).astype(np.float32),
        np.zeros(len(languages), np.float32),
    )
    weights = [*net.filters.values(), net.bias, net.out, net.out_bias]
    first, second, step = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights], 0
    share = np.bincount(label, minlength=len(languages))
    weight = len(label) / np.maximum(1, share) / len(languages)  # languages count alike
    for _ in range(epochs):
        order = random.permutation(len(x))
        for picked in np.split(order, range(batch, len(order), batch)):
            if not len(picked):
                continue
            b, rows = x[picked], np.arange(len(picked))
            answers, places = [], []
            for w, table in net.filters.items():
                n = b.shape[1] - w + 1
                z = sum(table[j][b[:, j : j + n]] for j in range(w))
                places.append(z.argmax(axis=1))
                answers.append(np.take_along_axis(z, places[-1][:, None, :], axis=1)[:, 0])
            before = np.concatenate(answers, axis=1) + net.bias
            hidden = np.maximum(before, 0)
            error = softmax(hidden @ net.out + net.out_bias)
            error[rows, label[picked]] -= 1
            error *= (weight[label[picked]] / len(picked))[:, None]
            back = (error @ net.out.T) * (before > 0)
            grads = []
            for i, (w, table) in enumerate(net.filters.items()):
                g, own = np.zeros_like(table), back[:, i * filters : (i + 1) * filters]
                for j in range(w):
                    np.add.at(g[j], (b[rows[:, None], places[i] + j], np.arange(filters)[None, :]), own)
                grads.append(g)
            grads += [back.sum(axis=0), hidden.T @ error, error.sum(axis=0)]
            step += 1
            for w, g, m, v in zip(weights, grads, first, second, strict=True):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                w -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return net


def sample(docs: DataFrame, per_language: int = PER_LANGUAGE, seed: int = 13) -> DataFrame:
    """At most ``per_language`` ids of each language: (doc_id, lang), chosen by a hash. Null ids and languages are left out."""
    known = docs.filter(F.col("doc_id").isNotNull() & F.col("lang").isNotNull()).select("doc_id", "lang")
    counts = pin(known.groupBy("lang").agg(F.count("*").alias("n")))  # its real size is known, so the rows stay where they are
    drawn = uniform(F.col("doc_id"), F.lit(seed))
    # First about twice as many as wanted, so that ranking a language's rows is a small task whatever its share.
    few = known.join(counts, "lang").filter(drawn * F.col("n") < 2 * per_language).select("doc_id", "lang").distinct()
    place = F.row_number().over(Window.partitionBy("lang").orderBy(drawn, "doc_id"))
    return few.withColumn("place", place).filter(F.col("place") <= per_language).drop("place")


def train(docs: DataFrame, per_language: int = PER_LANGUAGE, per_text: int = WINDOWS_PER_TEXT, size: int = SIZE) -> Network:
    """Train on ``docs`` (doc_id, text, lang): at most ``per_language`` texts of each language, ``per_text`` windows spread over each text.

    Windows are cut in Spark; the driver gets their bytes only. Without labelled texts the network knows no language.
    """
    chosen = sample(docs, per_language).withColumnRenamed("lang", "_lang")
    texts = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")  # per_language rows for each language
    texts = texts.groupBy("doc_id", "_lang").agg(F.min("text").alias("text")).filter(F.col("text").rlike(r"\p{L}"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cut = []
            for text in batch.column("text").to_pylist():
                all_rows = windows(text, size)
                picked = np.unique(np.linspace(0, len(all_rows) - 1, per_text).astype(int))
                cut.append(all_rows[picked].tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("_lang"), pa.array(cut, pa.binary())], names=["doc_id", "_lang", "cut"]
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    made = texts.select("doc_id", "_lang", F.col("text").cast("binary").alias("text"))
    got = made.mapInArrow(run, f"doc_id {kind}, _lang string, cut binary").toArrow().sort_by([("doc_id", "ascending"), ("_lang", "ascending")])
    rows = [np.frombuffer(c, np.uint8).reshape(-1, size) for c in got.column("cut").to_pylist()]
    names = got.column("_lang").to_pylist()
    languages = sorted(set(names))
    label = np.repeat([languages.index(n) for n in names], [len(r) for r in rows]).astype(np.int64) if rows else np.zeros(0, np.int64)
    return fit(np.concatenate(rows) if rows else np.zeros((0, size), np.uint8), label, languages)


def predict(docs: DataFrame, net: Network, keep: Sequence[str] = ("doc_id",), size: int = SIZE) -> DataFrame:
    """Language of every whole text: ``row`` (a struct of the columns in ``keep``, whatever their names), lang_pred, score.

    Reads ``text`` only. A text that is null or has no letter, or a network that knows no language, gives ``und`` with score 0. The score is the softmax
    of the mean window output, by default of windows of 128 bytes. Equal texts have equal results. Very long texts are scored in all
    of their windows. An empty table gives no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ready = net.prepared() if net.languages else net
        for batch in batches:
            names, scores = [], []
            for text, known in zip(batch.column("_text").to_pylist(), batch.column("_letters").to_pylist(), strict=True):
                if not known or not ready.languages:
                    names.append(UNKNOWN)
                    scores.append(0.0)
                    continue
                # Long texts in parts, so that memory does not grow with them.
                step, total, count = size * 4096, 0.0, 0
                for i in range(0, len(text), step):
                    part = ready.logits(windows(text[i : i + step], size))
                    total, count = total + part.sum(axis=0, dtype=np.float64), count + len(part)
                chance = softmax(total / count)
                names.append(ready.languages[int(chance.argmax())])
                scores.append(float(chance.max()))
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), pa.array(names, pa.string()), pa.array(scores, pa.float64())], names=["row", "lang_pred", "score"]
            )

    rows = docs.select(
        F.struct(*keep).alias("row"),
        F.col("text").cast("binary").alias("_text"),
        F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias("_letters"),
    )
    return rows.mapInArrow(run, f"row {rows.schema['row'].dataType.simpleString()}, lang_pred string, score double")
