import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from brute import LONG, empty, hot, lower, odd

from brevita.llm import phrases


def counted(rows):
    """Counts by language and word sequence; the empty sequence has all words."""
    f = defaultdict(Counter)
    for lang, text in rows:
        of = f["und" if lang is None else lang]
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower(text)):
            words = re.findall(r"[^\x20\x09]+", piece)
            for size in (1, 2, 3):
                of.update(tuple(words[i : i + size]) for i in range(len(words) - size + 1))
            of[()] += len(words)
    return f


def brute(rows, least=10, top=2000):
    out = []
    for lang, f in counted(rows).items():
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        gone = {
            p[i : i + 2] for p, a in candidates.items() if len(p) == 3 for i in (0, 1) if 100 * a >= 50 * f[p[i : i + 2]]
        }
        scored = []
        for p, a in candidates.items():
            if p not in gone:
                score, _, l, r = min((10**6 * a * a // (f[p[:k]] * f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
                scored.append((-score, -a, " ".join(p).encode(), l, r))
        for rank, (score, a, p, l, r) in enumerate(sorted(scored)[:top], 1):
            out.append((lang, rank, p.decode(), -a, l, r, f[()], -score))
    return sorted(out)


def pairs(df):
    return [(r.lang, r.text) for r in df.select("lang", "text").collect()]


def check(df, **kw):
    found = sorted(map(tuple, phrases.collocations(df, **kw).collect()))
    assert found == brute(pairs(df), kw.get("least", 10), kw.get("top", 2000))
    return found


def test_given_table(spark, small):
    found = check(spark.read.parquet(f"{small}/documents.parquet"))
    assert len(found) > 100 and {len(r[2].split()) for r in found} == {2, 3}


@pytest.mark.parametrize("least", [1, 2])
def test_odd_rows(spark, least):
    extra = [
        (20, "A.b a b;a b\x0bc\x0cd\re a\tb  a b!", "en"),
        (21, "é a\x01 b a b a\x01 b a \x00 b \x85 c   d", None),
        (22, "..,,;;", "und"),
        (23, "ÄB äb Äb äB ẞ", ""),
    ]
    more = spark.createDataFrame(extra, "doc_id bigint, text string, lang string")
    df = odd(spark).unionByName(more, allowMissingColumns=True)
    found = check(df, least=least, top=30)
    assert {r[0] for r in found} > {"en", "und"}
    assert check(empty(spark)) == []


def test_skewed_rows_and_ties(spark):
    found = check(hot(spark, 600).withColumn("doc_id", phrases.F.lit(1)))
    assert ("en", "the same words") in {(r[0], r[2]) for r in found}


def test_runs_of_many_spills_give_the_same_counts(spark, small):
    """A trie of few entries spills again and again; a merge of few waiting phrases gives its rows early."""
    df = spark.read.parquet(f"{small}/documents.parquet").select("lang", "text").repartition(3)
    f = counted(pairs(df))
    expected = sorted((lang, " ".join(p), len(p), n) for lang, of in f.items() for p, n in of.items() if n >= 3 or not p)
    found = phrases.count_phrases(df, least=3, part_words=5000, entries=3000).groupBy("lang", "phrase", "words").agg(phrases.F.sum("f"))
    assert sorted(map(tuple, found.collect())) == expected


def test_parts_of_a_very_long_text(monkeypatch):
    """Phrases that reach over the end of a part are counted once, also where words are forgotten in between."""
    monkeypatch.setattr(phrases, "GROUP_BYTES", 1000)
    monkeypatch.setattr(phrases, "_MASK", (1 << 21) - 1)
    text = LONG + ". " + LONG.replace("w3", "w3, ")
    counter = phrases.Counter(parts=5, entries=2000)
    counter.add("en", [text.encode(), b"", b"short one"])
    counter.finish()
    found = Counter()
    for _, _, _, names, numbers in counter.rows:
        for p, n in zip(*phrases._unpacked(names, numbers), strict=True):
            found[tuple(p.decode().split(" ")[:-1])] += n
    assert found == counted([("en", text), ("en", ""), ("en", "short one")])["en"]


def test_trie_bursts():
    trie = phrases.Trie(burst=4)
    rng, expected = np.random.default_rng(1), Counter()
    for _ in range(20):
        keys, counts = np.unique((rng.integers(1, 3, 50) << 42) | (rng.integers(0, 4, 50) << 21) | rng.integers(0, 3, 50), return_counts=True)
        trie.add(keys, counts)
        expected.update(dict(zip(keys.tolist(), counts.tolist(), strict=True)))
    assert trie.burst == {1, 2} and trie.entries == len(expected)
    largest = trie.largest(0.4)
    keys, counts = trie.take(largest)
    more = trie.take(list(trie.size))
    assert len(largest) == 1 and trie.entries == 0 and not trie.root
    found = dict(zip([*keys.tolist(), *more[0].tolist()], [*counts.tolist(), *more[1].tolist()], strict=True))
    assert found == expected


def test_products_beyond_64_bits(spark):
    rows = [("en", "", 0, 10**13), ("en", "a", 1, 10**12 + 7), ("en", "b", 1, 10**12 + 9), ("en", "a b", 2, 10**12 - 11)]
    counts = spark.createDataFrame(rows, "lang string, phrase string, words int, f bigint")
    original = phrases.count_phrases
    phrases.count_phrases = lambda *a, **k: counts
    try:
        (row,) = phrases.collocations(counts).collect()
    finally:
        phrases.count_phrases = original
    assert row.score == 10**6 * (10**12 - 11) ** 2 // ((10**12 + 7) * (10**12 + 9))
