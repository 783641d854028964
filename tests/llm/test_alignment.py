import hashlib
from collections import Counter

import numpy as np
import pytest
from brute import LONG, empty, hot, odd

from brevita.llm import alignment
from brevita.llm.queries import QUERIES

A, B = (
    alignment.byte_level(open(alignment.BYTE_LEVEL, "rb").read()),
    alignment.pieces(open(alignment.PIECES, "rb").read()),
)


def ranges(tokens, ids):
    out, at = [], 0
    for i in ids:
        out.append((i, at, at + len(tokens.spelled[i])))
        at = out[-1][2]
    return out


def plain(text):
    """Groups and links of one text, by sets and by comparing each token with those that may overlap."""
    if not text:
        return [], []
    a, b = (ranges(t, t.encode([text])[0]) for t in (A, B))
    whole = (" " + text).encode()
    if any(b"".join(t.spelled[i] for i, *_ in x) != whole for t, x in ((A, a), (B, b))):
        return [], []
    cuts = sorted({e for *_, e in a} & {e for *_, e in b})
    groups, start, i, j = [], 0, 0, 0
    for cut in cuts:
        left, right = [], []
        while i < len(a) and a[i][2] <= cut:
            left.append(a[i][0])
            i += 1
        while j < len(b) and b[j][2] <= cut:
            right.append(b[j][0])
            j += 1
        groups.append((left, right))
        start = cut
    assert start == len(whole)
    links, low = [], 0
    for x, s, e in a:
        while b[low][2] <= s:
            low += 1
        at = low
        while at < len(b) and b[at][1] < e:
            links.append((x, b[at][0]))
            at += 1
    return groups, links


def brute(rows):
    each = [(i, *plain(t)) for i, t in rows]
    n = Counter(link for _, _, links in each for link in links)
    highest = {}
    for (_, b), k in n.items():
        highest[b] = max(highest.get(b, 0), k)
    out = []
    for i, groups, links in each:
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        out.append(
            (
                i, sum(len(x) for x, _ in groups), sum(len(y) for _, y in groups), len(groups), len(links), sum(n[p] == highest[p[1]] for p in links),
                sum(n[p] for p in links), hashlib.sha256(text.encode()).hexdigest() if groups else "",
            )
        )
    return sorted(out, key=str)


def check(spark, df, tmp_path):
    df.write.parquet(f"{tmp_path}/documents.parquet")
    got = QUERIES["op11_alignment"](spark, str(tmp_path))
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    found = sorted(map(tuple, got.collect()), key=str)
    assert found == brute([(r.doc_id, r.text) for r in df.collect()])
    return {r[0]: r for r in found}


def test_query_on_given_table(spark, small, tmp_path):
    found = check(spark, spark.read.parquet(f"{small}/documents.parquet").repartition(3), tmp_path)
    assert all(r[3] > 0 and r[4] == r[1] + r[2] - r[3] for r in found.values() if r[1])


ODD = [
    (30, "<|endoftext|> <s> </s> <unk> <0x41>"), (31, "a▁b"), (32, "\x00a\tb\r\nc  d   "), (33, "😀é ﬁ 漢字かな交じり文"), (34, " lead"), (35, " "),
    (36, "x" * 300 + "é" * 300), (37, "日本語" * 400), (38, "\n\n\n"), (39, "a▁b and more"), (40, " 　x\x85"),
]


def test_odd_rows(spark, tmp_path):
    df = odd(spark).unionByName(spark.createDataFrame(ODD, "doc_id bigint, text string"), allowMissingColumns=True)
    found = check(spark, df.repartition(4), tmp_path)
    assert found[31][1:] == (0, 0, 0, 0, 0, 0, "") and found[30][1] > 0 and found[5][1] > len(LONG) / 10


def test_empty_and_hot_tables(spark, tmp_path):
    check(spark, empty(spark), tmp_path / "none")
    check(spark, spark.createDataFrame([(1, None), (2, "")], "doc_id bigint, text string"), tmp_path / "blank")
    check(spark, hot(spark, 600), tmp_path / "hot")


def test_small_blocks_and_other_columns(spark, monkeypatch, tmp_path):
    """Blocks of few links give the same sums; all columns of a row pass, whatever their names."""
    monkeypatch.setattr(alignment, "BLOCK_LINKS", 50)
    monkeypatch.setattr(alignment, "PART_BYTES", 300)
    df = odd(spark).withColumns({"block": alignment.F.lit(1), "groups": alignment.F.col("doc_id"), "place": alignment.F.lit("p")})
    aligned = alignment.pin(alignment.align(df, keep=tuple(df.columns)).withColumnRenamed("groups", "digest"))
    counts = alignment.link_counts(aligned)
    scored = alignment.score_links(aligned, alignment.pin(counts)).collect()
    assert scored[0].row.asDict().keys() == set(df.columns)
    expected = brute([(r.doc_id, r.text) for r in df.collect()])
    assert sorted(((r.row.doc_id, r.n_best, r.count_sum) for r in scored), key=str) == sorted(((x[0], x[5], x[6]) for x in expected), key=str)
    links = Counter(link for r in df.collect() for link in plain(r.text)[1])
    assert {(r.a, r.b): r.n for r in counts.collect()} == links
    # The real output: groups as text.
    texts = {r.row.doc_id: r.digest for r in aligned.filter("pairs is null").collect()}
    assert texts[7] == ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in plain("one")[0])


@pytest.mark.parametrize("seed", range(20))
def test_cuts_are_all_shared_ends(seed):
    rng = np.random.default_rng(seed)
    a, b, stops_a, stops_b = [], [], [], []
    base = 0
    for _ in range(rng.integers(1, 6)):
        n = int(rng.integers(1, 200))
        share = rng.choice([0.02, 0.3, 0.9])
        for ends, stops in ((a, stops_a), (b, stops_b)):
            inner = [base + i for i in range(1, n) if rng.random() < share]
            ends += [*inner, base + n]
            stops.append(len(ends))
        base += n
    a, b = np.array(a), np.array(b)
    at_a, at_b = alignment.shared_cuts(a, b, np.array(stops_a), np.array(stops_b))
    assert a[at_a].tolist() == b[at_b].tolist() == np.intersect1d(a, b).tolist()


def test_a_long_interval_without_cuts():
    a, b = np.arange(1, 4001) * 2, np.concatenate([np.arange(0, 3999) * 2 + 1, [8000]])
    at_a, at_b = alignment.shared_cuts(a, b, np.array([4000]), np.array([4000]))
    assert (at_a.tolist(), at_b.tolist()) == ([3999], [3999])
    x, y = alignment.overlaps(a, b, np.concatenate([[0], b[:-1]]))
    assert len(x) == 4000 + 4000 - 1 and y.max() == 3999


def test_ranks_give_the_ids_of_the_file(small):
    """The faster way by ranks against the tokenizer of the file, on given texts, odd ones and random joins of tokens."""
    import pyarrow.parquet as pq
    from tokenizers import Tokenizer

    file = Tokenizer.from_file(alignment.BYTE_LEVEL)
    file.encode_special_tokens = True
    rng = np.random.default_rng(5)
    tokens = np.array([t for t in (x.decode(errors="ignore") for x in A.spelled) if t], dtype=object)
    texts = ["".join(rng.choice(tokens, 3)) for _ in range(20_000)] + [t for _, t in ODD]
    texts += [f"a{chr(c)}b {chr(c)}{chr(c)} 1{chr(c)}2 '{chr(c)}" for c in range(1, 0x3000)]
    texts += [" " * 3000 + "a", "x" * 2000, "a" + "\n \t" * 500]
    texts += [t for t in pq.read_table(f"{small}/documents.parquet")["text"].to_pylist() if t]
    assert A.encode(texts) == [e.ids for e in file.encode_batch([" " + t for t in texts], add_special_tokens=False)]
    words = alignment.FOLDER + "/word_bpe_49k.json"
    assert alignment._ranks(open(words, "rb").read(), []) is None


def test_large_vocabulary_files_are_refused(spark):
    with pytest.raises(ValueError, match="more than 10 bytes"):
        alignment.read_file(spark, alignment.PIECES, most=10)
