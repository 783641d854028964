"""How much of a summary is copied from its text, as an Arrow function over two normalised texts (tokens separated by one space).

Greedy extractive fragments (Grusky et al. 2018): from the first token of the summary on, the longest run that the text has anywhere is a fragment, and the
search goes on behind it; a token that the text lacks is passed over.

The longest run at every place comes from sorted ranks of token windows that double in length: the ranks of windows of 2w tokens are those of pairs of windows of
w tokens. In the order of the widest windows, the longest match of a summary's place is with the nearest place of the text before or behind it. All pairs of a
batch are ranked together; the work is tokens times the logarithm of the longest run, whatever repeats.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

FRAGMENTS = StructType(
    [StructField(c, LongType()) for c in ("text_tokens", "summary_tokens", "fragments", "covered", "squares", "longest", "shared_words", "all_words")]
)
# Tokens that are ranked together, about; a longer pair is ranked alone.
BATCH_TOKENS = 500_000


def _ranks(ids: np.ndarray, is_text: np.ndarray, is_summary: np.ndarray) -> list[np.ndarray]:
    """Order-keeping ranks of the windows of 1, 2, 4, ... tokens at every place, until no summary window stands in a text. Windows end at the end."""
    levels, width = [np.unique(ids, return_inverse=True)[1]], 1
    while True:
        rank = levels[-1]
        texts = np.zeros(rank.max() + 1, bool)
        texts[rank[is_text]] = True
        if width >= len(ids) or not texts[rank[is_summary]].any():
            return levels
        behind = np.zeros(len(ids), np.int64)
        behind[:-width] = rank[width:] + 1
        levels.append(np.unique(rank * (len(ids) + 1) + behind, return_inverse=True)[1])
        width *= 2


def _common(levels: list[np.ndarray], at: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Length of the longest common run from each place in ``at`` and the place beside it in ``other`` (-1: none)."""
    length, (at, other) = np.zeros(len(at), np.int64), (at.copy(), other.copy())
    n, open_ = len(levels[0]), other >= 0
    for k in range(len(levels) - 1, -1, -1):
        inside = open_ & (at < n) & (other < n)
        same = np.flatnonzero(inside)
        same = same[levels[k][at[same]] == levels[k][other[same]]]
        length[same] += 1 << k
        at[same] += 1 << k
        other[same] += 1 << k
    return length


def longest_matches(texts: list[np.ndarray], summaries: list[np.ndarray]) -> list[np.ndarray]:
    """For each pair of token numbers, the longest run from every place of the summary that the text has anywhere."""
    if not texts:
        return []
    parts, sides, mark = [], [], -1
    span = 1 + max((int(x.max(initial=0)) for x in (*texts, *summaries)), default=0)
    for pair, (text, summary) in enumerate(zip(texts, summaries, strict=True)):
        # Numbers of their own for each pair, and a mark of its own behind each side: no run leaves its side or pair.
        for side, tokens in ((0, text), (1, summary)):
            parts += [tokens.astype(np.int64) + pair * span, [mark]]
            sides += [np.full(len(tokens), side, np.int8), [2]]
            mark -= 1
    ids, side = np.concatenate(parts).astype(np.int64), np.concatenate(sides)
    is_text, is_summary = side == 0, side == 1
    levels = _ranks(ids, is_text, is_summary)
    order = np.argsort(levels[-1], kind="stable")
    text_here = np.where(is_text[order], order, -1)
    place = np.arange(len(order))
    before = np.maximum.accumulate(np.where(text_here >= 0, place, -1))
    behind = len(order) - 1 - np.maximum.accumulate(np.where(text_here[::-1] >= 0, place, -1))[::-1]
    wanted = np.flatnonzero(is_summary[order])
    at = order[wanted]
    found = np.zeros(len(ids), np.int64)
    for near in (before[wanted], behind[wanted]):
        other = np.where((near >= 0) & (near < len(order)), order[np.clip(near, 0, len(order) - 1)], -1)
        found[at] = np.maximum(found[at], _common(levels, at, other))
    ends = np.cumsum([len(t) + len(s) + 2 for t, s in zip(texts, summaries, strict=True)])
    return [found[end - 1 - len(s) : end - 1] for end, s in zip(ends, summaries, strict=True)]


def greedy(lengths: list[int]) -> list[int]:
    """Lengths of the fragments, from the longest run at every place."""
    out, at = [], 0
    while at < len(lengths):
        if lengths[at]:
            out.append(lengths[at])
        at += lengths[at] or 1
    return out


def _groups(sizes: list[int]) -> Iterator[slice]:
    start, held = 0, 0
    for i, size in enumerate(sizes):
        held += size
        if held > BATCH_TOKENS:
            yield slice(start, i + 1)
            start, held = i + 1, 0
    if start < len(sizes):
        yield slice(start, len(sizes))


@F.pandas_udf(FRAGMENTS)
def fragment_counts(text: pd.Series, summary: pd.Series) -> pd.DataFrame:
    """Tokens of either side, fragments, the summary's tokens in them, the sum of their squared lengths, the longest, and distinct words shared and in all."""
    pairs, rows = [(a.split(), b.split()) for a, b in zip(text, summary)], []
    for some in _groups([len(a) + len(b) for a, b in pairs]):
        flat = [t for a, b in pairs[some] for side in (a, b) for t in side]
        numbers = pd.factorize(np.array(flat, dtype=object))[0] if flat else np.zeros(0, np.int64)
        cuts = np.cumsum([len(side) for pair in pairs[some] for side in pair])[:-1]
        sides = np.split(numbers, cuts)
        matches = longest_matches(sides[::2], sides[1::2])
        for a, b, found in zip(sides[::2], sides[1::2], matches, strict=True):
            kept = greedy(found.tolist())
            shared = len(np.intersect1d(a, b))
            every = len(np.unique(a)) + len(np.unique(b)) - shared
            rows.append((len(a), len(b), len(kept), sum(kept), sum(k * k for k in kept), max(kept, default=0), shared, every))
    return pd.DataFrame(rows, columns=FRAGMENTS.names, dtype="int64")
