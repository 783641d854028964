import hashlib

import numpy as np
import pytest
from brute import LONG, ODD_SCHEMA, empty, hot, odd, sha, words

from brevita.llm import fingerprints as fp
from brevita.llm.queries import QUERIES


def shingles(text, width=5):
    w = words(text)
    return {tuple(w[i : i + width]) for i in range(max(1, len(w) - width + 1))} if w else set()


def likeness(a, b):
    a, b = shingles(a), shingles(b)
    return len(a & b) / len(a | b) if a | b else 1.0


def neighbours(rows):
    """(id, text, edited) by descending id; ids are distinct."""
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0)))
    out = []
    for (i, t), (_, after) in zip(order, order[1:] + order[:1], strict=True):
        t, after = t or "", after or ""
        n = len(t)
        out.append((i, t, t[: n - n // 2] + after[: n // 2], after))
    return out


def check(df, found, k=fp.K):
    expected = {i: (t, e, a) for i, t, e, a in neighbours([(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()])}
    assert len(found) == len(expected)
    wrong = 0
    for r in found:
        text, edited, after = expected[r.doc_id]
        assert (r.n_chars, r.edited_sha256) == (len(text), sha(edited))
        for near, other in ((r.near_edited, edited), (r.near_next, after)):
            exact = likeness(text, other)
            if len(shingles(text) | shingles(other)) <= k:
                assert near == exact
            # Five standard deviations of the estimate.
            wrong += abs(near - exact) > 5 * (0.25 / k) ** 0.5
    assert wrong == 0
    return {r.doc_id: r for r in found}


def test_query_on_given_table(spark, small):
    df = spark.read.parquet(f"{small}/documents.parquet")
    got = QUERIES["op12_fingerprints"](spark, small)
    assert got.columns == ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    found = check(df, got.collect())
    by_text = {}
    for r in df.collect():
        assert by_text.setdefault(r.text, found[r.doc_id].fingerprint) == found[r.doc_id].fingerprint
    near = [r.near_edited for r in found.values() if r.n_chars > 1000]
    assert 0.25 < np.mean(near) < 0.42


@pytest.mark.parametrize("parts", [1, 7])
def test_odd_rows(spark, parts):
    df = odd(spark).dropDuplicates(["doc_id"]).repartition(parts)
    got = fp.compare_with_next(df, keep=tuple(df.columns))
    assert got.select("row.*").columns == df.columns
    found = check(df, got.select("row.doc_id", *got.columns[1:]).collect())
    assert found[3].fingerprint == "" and found[5].n_chars == len(LONG)
    assert fp.compare_with_next(empty(spark)).collect() == []


def test_one_row_is_its_own_neighbour(spark):
    df = spark.createDataFrame([(7, "ab😀d e")], "doc_id bigint, text string")
    (r,) = fp.compare_with_next(df).collect()
    assert (r.n_chars, r.edited_sha256, r.near_next) == (6, sha("ab😀ab😀"), 1.0)


def test_repeated_rows_and_null_ids(spark):
    """Rows of one id follow by a hash of the text; equal rows are neighbours of each other."""
    df = spark.createDataFrame([(1, "a b", 1), (1, "a b", 1), (1, "c", 1), (None, "a b", 2), (None, None, 2), (2, "a b", 3)], "doc_id bigint, text string, n int")
    for parts in (1, 4):
        rows = fp.compare_with_next(df.repartition(parts), keep=("doc_id", "n")).collect()
        assert len(rows) == 6
        hashes = {t: df.sparkSession.range(1).select(fp.F.xxhash64(fp.F.lit(t).cast("string"))).first()[0] for t in ("a b", "c", None)}
        order = sorted(((i is None, -(i or 0), hashes[t], t or "") for i, t, _ in df.collect()))
        texts = [t for *_, t in order]
        edited = sorted(sha(t[: len(t) - len(t) // 2] + u[: len(t) // 2]) for t, u in zip(texts, texts[1:] + texts[:1], strict=True))
        assert sorted(r.edited_sha256 for r in rows) == edited


def test_hot_groups(spark):
    df = hot(spark, 600)
    got = fp.compare_with_next(df)
    check(df, got.select("row.doc_id", *got.columns[1:]).collect())


def test_sketches_of_parts_merge(spark):
    """The sketch of a set is that of its parts together, in any cut, also for one hot key; figures lie near the exact ones."""
    rng = np.random.default_rng(3)
    texts = {"a": [f"w{x}" for x in rng.integers(0, 10**6, 9000)], "b": [f"w{x}" for x in rng.integers(0, 300, 90)], None: ["x", "y"]}
    texts["c"] = texts["a"][:3000]
    rows = [(key, " ".join(w[i : i + 34])) for key, w in texts.items() for i in range(0, max(1, len(w) - 4), 30)]
    rows += [("e", None), ("e", "")] + [("hot", "one two three four five six")] * 500
    parts = spark.createDataFrame(rows, "key string, text string").repartition(6).withColumn("sketch", fp.sketch_of(fp.F.col("text")))
    merged = fp.merge_sketches(parts, "key").collect()
    whole = spark.createDataFrame([(k, " ".join(w)) for k, w in texts.items()] + [("e", ""), ("hot", rows[-1][1])], "key string, text string")
    expected = whole.withColumn("sketch", fp.sketch_of(fp.F.col("text"))).select("key", "sketch").collect()
    assert sorted(merged, key=str) == sorted(expected, key=str)
    s = {r.key: r.sketch for r in merged}
    row = spark.createDataFrame([(s["a"], s["c"], s["b"], s["e"])], "a array<bigint>, c array<bigint>, b array<bigint>, e array<bigint>")
    c = fp.F.col
    r = row.select(
        fp.distinct_of(c("a")).alias("n"), fp.distinct_of(c("b")).alias("m"), fp.resemblance_of(c("a"), c("c")).alias("near"),
        fp.containment_of(c("c"), c("a")).alias("inside"), fp.containment_of(c("a"), c("c")).alias("part"),
        fp.containment_of(c("e"), c("a")).alias("none"), fp.resemblance_of(c("e"), c("e")).alias("empty"),
    ).first()
    assert abs(r.n / 8996 - 1) < 0.4 and r.m == len(shingles(" ".join(texts["b"])))
    assert abs(r.near - 1 / 3) < 0.2 and r.inside > 0.7 and abs(r.part - 1 / 3) < 0.25
    assert (r.none, r.empty) == (1.0, 1.0)
    assert fp.merge_sketches(parts.limit(0), "key").collect() == []


def test_smallest_with_many_repeats():
    x = np.repeat(np.arange(1000, dtype=np.uint64), 50)
    np.random.default_rng(0).shuffle(x)
    assert fp.smallest(x, 128).tolist() == list(range(128)) and fp.smallest(x[:0], 5).tolist() == []
    assert hashlib.sha256(b"").hexdigest() == sha("") and ODD_SCHEMA
