import random

import numpy as np
import pytest

from brevita.functions import fragments
from brevita.operators import curation


def plain(text, summary):
    """Fragment lengths by trying every place of the text."""
    out, i = [], 0
    while i < len(summary):
        best = 0
        for j in range(len(text)):
            k = 0
            while i + k < len(summary) and j + k < len(text) and summary[i + k] == text[j + k]:
                k += 1
            best = max(best, k)
        if best:
            out.append(best)
        i += max(best, 1)
    return out


def made(rng, n, words):
    return [f"w{rng.randrange(words)}" for _ in range(n)]


def some_pairs(seed):
    rng, pairs = random.Random(seed), []
    for _ in range(30):
        text = made(rng, rng.randrange(60), rng.choice([2, 5, 40]))
        summary = made(rng, rng.randrange(30), 40)
        for _ in range(rng.randrange(4)):
            at = rng.randrange(len(text) + 1)
            summary[rng.randrange(len(summary) + 1) :] = text[at : at + rng.randrange(20)]
        pairs.append((text, summary))
    return pairs


@pytest.mark.parametrize("seed", range(8))
def test_equals_a_search_of_every_place(spark, seed, monkeypatch):
    pairs = some_pairs(seed)
    monkeypatch.setattr(fragments, "BATCH_TOKENS", [200, 10**6][seed % 2])
    numbers = {w: i for i, w in enumerate(sorted({w for p in pairs for side in p for w in side}))}
    coded = [[np.array([numbers[w] for w in side], np.int64) for side in pair] for pair in pairs]
    found = fragments.longest_matches([a for a, _ in coded], [b for _, b in coded])
    assert [fragments.greedy(x.tolist()) for x in found] == [plain(*p) for p in pairs]


def test_operator(spark):
    pairs = some_pairs(99) + [([], []), (["a"], []), ([], ["a"])]
    rows = [(i, " ".join(t), "  ".join(s).upper() + " !", 5) for i, (t, s) in enumerate(pairs)] + [(1000, None, "a b", 5), (1001, "a b", None, 5)]
    df = spark.createDataFrame(rows, "id bigint, text string, summary string, fragments bigint").repartition(3)
    got = {r[0]: r for r in curation.extractive_overlap(df.withColumnRenamed("fragments", "more")).collect()}
    for i, (text, summary) in enumerate(pairs):
        kept, r = plain(text, summary), got[i]
        assert (r.text_tokens, r.summary_tokens, r.fragments, r.covered) == (len(text), len(summary), len(kept), sum(kept))
        assert r.longest == max(kept, default=0) and r.coverage == (sum(kept) / len(summary) if summary else 0)
        assert r.density == pytest.approx(sum(k * k for k in kept) / len(summary) if summary else 0)
        every = set(text) | set(summary)
        assert r.jaccard == pytest.approx(len(set(text) & set(summary)) / len(every) if every else 0)
    assert (got[1000].coverage, got[1000].summary_tokens, got[1001].coverage) == (0.0, 2, 0.0)
    few = curation.abstractive_filter(df, most_density=2.0, most_coverage=0.9)
    assert few.columns == df.columns
    assert {r.id for r in few.collect()} == {i for i, r in got.items() if r.density <= 2.0 and r.coverage <= 0.9}


def test_long_and_repetitive_texts_take_no_quadratic_time(spark):
    text = "same " * 60_000 + " ".join(f"w{i % 5000}" for i in range(60_000))
    df = spark.createDataFrame([(1, text, "same " * 30_000 + "other " + text[-200_000:])], "id bigint, text string, summary string")
    (r,) = curation.extractive_overlap(df).collect()
    assert (r.longest >= 30_000, r.covered) == (True, r.summary_tokens - 1 - (text[-200_000:].split()[0] not in set(text.split())))


def test_empty_table(spark):
    assert curation.extractive_overlap(spark.createDataFrame([], "id int, text string, summary string")).collect() == []
