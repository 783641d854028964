"""ROUGE-1, ROUGE-2 and ROUGE-L per pair, and their corpus means with bootstrap intervals (Lin 2004).

All scores of a pair come from its own row, so scoring is map-only whatever the number of pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brevita.functions.overlap import NGRAM_COUNTS, lcs_tokens, ngram_overlap
from brevita.functions.stemming import stem_tokens
from brevita.functions.tokens import normalised, token_count

METRICS = ("rouge1", "rouge2", "rougeL")

# Bootstrap replicates and interval, and the Mersenne prime 2^31-1.
REPLICATES = 1000
INTERVAL = (0.025, 0.5, 0.975)
PRIME = 2_147_483_647

# Cumulative Poisson(1) probabilities on the scale [0, PRIME): a uniform number at or above k of them weighs k.
POISSON_STEPS = tuple(int(sum(math.exp(-1) / math.factorial(j) for j in range(k + 1)) * PRIME) for k in range(11))


def _score(hits: Column, predicted: Column, expected: Column, name: str) -> list[Column]:
    """Precision, recall and F1; 0 where a side has nothing to count."""
    precision = F.when(predicted > 0, hits / predicted).otherwise(0.0)
    recall = F.when(expected > 0, hits / expected).otherwise(0.0)
    f1 = F.when(hits > 0, 2 * precision * recall / (precision + recall)).otherwise(0.0)
    return [precision.alias(f"{name}_p"), recall.alias(f"{name}_r"), f1.alias(f"{name}_f")]


def _tokenised(pairs: DataFrame, stem: bool) -> DataFrame:
    """Normalised texts next to the pair's other columns; with ``stem``, Porter-stemmed."""
    kept = [c for c in pairs.columns if c not in ("reference_summary", "generated_summary")]
    ref, gen = normalised(F.col("reference_summary")), normalised(F.col("generated_summary"))
    if stem:
        ref, gen = stem_tokens(ref), stem_tokens(gen)
    return pairs.select(*kept, ref.alias("ref_text"), gen.alias("gen_text"))


def rouge_n(pairs: DataFrame, stem: bool = False) -> DataFrame:
    """Clipped unigram and bigram overlap of each pair with precision, recall and F1."""
    texts = _tokenised(pairs, stem)
    counted = texts.withColumn("counts", ngram_overlap("ref_text", "gen_text")).drop("ref_text", "gen_text")
    counted = counted.select("*", "counts.*").drop("counts")
    scores = []
    for n in (1, 2):
        scores += _score(F.col(f"hits_{n}"), F.col(f"gen_{n}"), F.col(f"ref_{n}"), f"rouge{n}")
    return counted.select("*", *scores)


def rouge_l(pairs: DataFrame, stem: bool = False) -> DataFrame:
    """Longest common token subsequence of each pair with precision, recall and F1."""
    measured = (
        _tokenised(pairs, stem)
        .withColumns(
            {
                "ref_1": token_count(F.col("ref_text")).cast("bigint"),
                "gen_1": token_count(F.col("gen_text")).cast("bigint"),
                "lcs": lcs_tokens("ref_text", "gen_text"),
            }
        )
        .drop("ref_text", "gen_text")
    )
    return measured.select("*", *_score(F.col("lcs"), F.col("gen_1"), F.col("ref_1"), "rougeL"))


def rouge_scores(pairs: DataFrame, stem: bool = False) -> DataFrame:
    """F1 of the three metrics per pair: (id, model, rouge1, rouge2, rougeL)."""
    counted = _tokenised(pairs, stem).select(
        "id",
        "model",
        ngram_overlap("ref_text", "gen_text").alias("counts"),
        lcs_tokens("ref_text", "gen_text").alias("lcs"),
    )
    n = {name: F.col(f"counts.{name}") for name in NGRAM_COUNTS.names}
    scores = {
        "rouge1": _score(n["hits_1"], n["gen_1"], n["ref_1"], "rouge1")[2],
        "rouge2": _score(n["hits_2"], n["gen_2"], n["ref_2"], "rouge2")[2],
        "rougeL": _score(F.col("lcs"), n["gen_1"], n["ref_1"], "rougeL")[2],
    }
    return counted.select("id", "model", *[score.alias(name) for name, score in scores.items()])


def rouge_corpus(scores: DataFrame) -> DataFrame:
    """Plain mean F1 per model."""
    means = [F.avg(m).alias(m) for m in METRICS]
    return scores.groupBy("model").agg(F.count("*").alias("num_examples"), *means)


def _replicate_sums(replicates: int):
    """Arrow pass over (model, a, b, scores): weighted sums of every replicate, a row for each model and replicate of a task."""
    steps = np.array(POISSON_STEPS)
    numbers = np.arange(1, replicates + 1, dtype=np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            models, place = np.unique(np.array(batch.column("model").to_pylist(), dtype=object).astype(str), return_inverse=True)
            a, b = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("a", "b"))
            values = np.column_stack([np.ones(len(a)), *[batch.column(m).to_numpy(zero_copy_only=False) for m in METRICS]])
            weights = np.searchsorted(steps, (a[:, None] * numbers[None, :] + b[:, None]) % PRIME, side="right").astype(np.float64)
            for k, model in enumerate(models):
                mine = place == k
                sums[model] = sums.get(model, 0) + weights[mine].T @ values[mine]
        for model, total in sums.items():
            columns = [pa.array([model] * replicates), pa.array(numbers), *[pa.array(total[:, j]) for j in range(len(METRICS) + 1)]]
            yield pa.RecordBatch.from_arrays(columns, names=["model", "replicate", "w", *METRICS])

    return run


def rouge_bootstrap(scores: DataFrame, replicates: int = REPLICATES, seed: int | str = 42) -> DataFrame:
    """Bootstrap interval of each mean F1 per model: 2.5, 50 and 97.5 percentiles. Models must not be null.

    Poisson weights stand in for drawing n of n rows with replacement: replicate r gives each row a
    Poisson(1) weight, independent of the other rows, which needs neither n nor a driver-side draw. The
    weights of one row come from one md5: its first two 32-bit words a and b give (a*(r+1)+b) mod (2^31-1), uniform
    and pairwise independent over replicates. A task multiplies the weights with the scores of its rows and sends
    ``replicates`` rows per model; the final percentile sees ``replicates`` values.
    """
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")))
    halves = scores.select(
        "model",
        *METRICS,
        (F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") % PRIME).alias("a"),
        (F.conv(F.substring(digest, 9, 8), 16, 10).cast("bigint") % PRIME).alias("b"),
    )
    shape = "model string, replicate bigint, w double, " + ", ".join(f"{m} double" for m in METRICS)
    sums = (
        halves.mapInArrow(_replicate_sums(replicates), shape)
        .groupBy("model", "replicate")
        .agg(*[F.sum(c).alias(c) for c in ("w", *METRICS)])
        .filter("w > 0")
    )
    bounds = F.array(*[F.lit(q) for q in INTERVAL])
    spreads = sums.groupBy("model").agg(
        *[F.percentile(F.col(m) / F.col("w"), bounds).alias(m) for m in METRICS]
    )
    parts = [F.col(m)[k].alias(f"{m}_{part}") for m in METRICS for k, part in enumerate(("low", "mid", "high"))]
    return spreads.select("model", *parts)
