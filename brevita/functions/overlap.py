"""Counts behind ROUGE, as Arrow functions over two normalised texts (tokens separated by one space).

Spark has no expression for a longest common subsequence, so scoring a pair takes one pass through
Python in any case. The n-gram counts ride along: functions of the same columns share one Arrow transfer. Exploded
rows with a group-by would add a shuffle of all words.
"""

from __future__ import annotations

from collections import Counter

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

NGRAM_COUNTS = StructType([StructField(f"{side}_{n}", LongType()) for n in (1, 2) for side in ("ref", "gen", "hits")])


def ngram_counts(reference: list[str], generated: list[str], n: int) -> tuple[int, int, int]:
    """n-grams on either side, and how many they share when each is used once."""
    expected, found = (Counter(zip(*[side[k:] for k in range(n)])) for side in (reference, generated))
    few, many = sorted((expected, found), key=len)
    shared = sum(min(count, many[gram]) for gram, count in few.items() if gram in many)
    return max(len(reference) - n + 1, 0), max(len(generated) - n + 1, 0), shared


def lcs_length(left: list[str], right: list[str]) -> int:
    """Length of the longest common subsequence.

    Bit-parallel (Crochemore et al. 2001, Hyyro 2004): one row of the recurrence is one Python integer.
    """
    if len(left) > len(right):
        left, right = right, left
    where: dict[str, int] = {}
    for i, token in enumerate(left):
        where[token] = where.get(token, 0) | (1 << i)
    full = (1 << len(left)) - 1
    row = full
    for token in right:
        hit = row & where.get(token, 0)
        if hit:
            row = ((row + hit) | (row - hit)) & full
    return len(left) - row.bit_count()


@F.pandas_udf(NGRAM_COUNTS)
def ngram_overlap(reference: pd.Series, generated: pd.Series) -> pd.DataFrame:
    """Unigram and bigram counts of each pair."""
    counts = []
    for a, b in zip(reference, generated):
        ref, gen = a.split(), b.split()
        counts.append(ngram_counts(ref, gen, 1) + ngram_counts(ref, gen, 2))
    return pd.DataFrame(counts, columns=NGRAM_COUNTS.names, dtype="int64")


@F.pandas_udf(LongType())
def lcs_tokens(reference: pd.Series, generated: pd.Series) -> pd.Series:
    """LCS length of each pair."""
    return pd.Series([lcs_length(a.split(), b.split()) for a, b in zip(reference, generated)], dtype="int64")
