import pytest
from brute import empty, hot, odd, sha, words

from brevita.llm import substrings


def brute(rows, window):
    """Ids are unique here but for null; nulls are left out by the caller."""
    seen, out = set(), []
    for ident, text in sorted(rows):
        w = words(text)
        gone = set()
        for i in range(len(w) - window + 1):
            span = tuple(w[i : i + window])
            if span in seen:
                gone |= set(range(i, i + window))
            seen.add(span)
        out.append((ident, len(w), len(gone), sha(" ".join(x for i, x in enumerate(w) if i not in gone))))
    return out


def check(docs, window=20, gram=5):
    cut = substrings.remove_repeats(docs, window=window, gram=gram)
    got = [(r.row.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in cut.collect()]
    for r in cut.select("kept", "kept_sha256").collect():
        assert sha(bytes(r.kept).decode()) == r.kept_sha256
    assert sorted(got) == brute([(r.doc_id, r.text) for r in docs.collect()], window)
    return got


def test_given_table(spark, small):
    assert any(r[2] for r in check(spark.read.parquet(f"{small}/documents.parquet")))


@pytest.mark.parametrize("window,gram", [(20, 5), (3, 3), (4, 1)])
def test_odd_and_hot_rows(spark, window, gram):
    check(odd(spark).filter("doc_id is not null").dropDuplicates(["doc_id"]), window, gram)
    check(hot(spark, 600), window, gram)
    check(empty(spark), window, gram)


def test_repeats_inside_one_document(spark):
    rows = [(1, "a b c d " * 12), (2, "x " * 19), (3, "x " * 41), (4, "a b c d " * 6)]
    check(spark.createDataFrame(rows, "doc_id bigint, text string"))


def test_null_and_repeated_ids(spark):
    passage = " ".join(f"p{i}" for i in range(25))
    rows = [(None, passage), (None, passage + " z"), (3, passage + " y"), (3, passage + " y"), (9, "q " + passage)]
    cut = substrings.remove_repeats(spark.createDataFrame(rows, "doc_id bigint, text string"), keep=("doc_id", "text"))
    gone = sorted(((r.row.doc_id or 0, r.row.text), r.n_removed) for r in cut.collect())
    assert gone == [((0, passage), 25), ((0, passage + " z"), 25), ((3, passage + " y"), 0), ((3, passage + " y"), 0), ((9, "q " + passage), 25)]
    only = substrings.remove_repeats(spark.createDataFrame(rows[:2] + rows[:1], "doc_id bigint, text string"), keep=("text",))
    by_text = {}
    for r in only.collect():
        by_text.setdefault(r.row.text, []).append(r.n_removed)
    assert sorted(map(tuple, by_text.values())) in ([(0,), (25, 25)], [(0, 0), (25,)])
