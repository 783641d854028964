import struct

import pytest
import xxhash
from brute import empty, hot, odd

from brevita.llm import lines
from brevita.llm.common import F
from brevita.llm.queries import QUERIES


def signed(x):
    return x - 2**64 if x >= 2**63 else x


def cut(text, divisor):
    """Segments of a text."""
    out, held, before = [], [], None
    all_lines = text.split("\n")
    for i, line in enumerate(all_lines):
        held.append(line)
        h = xxhash.xxh64_intdigest(line.encode(), 42)
        seed = 42 if before is None else xxhash.xxh64_intdigest(struct.pack("<Q", before), 42)
        rolled = signed(xxhash.xxh64_intdigest(struct.pack("<Q", h), seed))
        if rolled % divisor == 0 or i == len(all_lines) - 1:
            out.append("\n".join(held))
            held = []
        before = h
    return out


def brute(rows, divisor=1):
    """(id, lines, removed, text) of each row, from all pairs of neighbouring segments; rows equal in id and text are one document."""
    order = sorted({(i is None, i or 0, signed(xxhash.xxh64_intdigest(t.encode(), 42)), t) for i, t in rows if t is not None})
    first, result = {}, {}
    for no, ident, _, text in order:
        parts, gone = cut(text, divisor), set()
        for at in range(len(parts) - 1):
            pair = (parts[at], parts[at + 1])
            if not "".join(pair).strip(" \t\n\x0b\f\r"):
                continue
            own = (no, ident, text, at)
            *document, begin = first.setdefault(pair, own)
            if (*document, begin) != own:
                gone |= {at, at + 1} - ({begin, begin + 1} if document == [no, ident, text] else set())
        kept = [x for at, x in enumerate(parts) if at not in gone]
        n = text.count("\n") + 1
        result[None if no else ident, text] = (n, n - sum(x.count("\n") + 1 for x in kept), "\n".join(kept))
    return sorted(((i, *(result[i, t] if t is not None else (0, 0, None))) for i, t in rows), key=str)


def check(docs, divisor=1):
    got = lines.remove_repeated_chunks(docs, divisor)
    assert got.columns == [*docs.columns, "_n_lines", "_n_removed"]
    found = sorted(((r.doc_id, r["_n_lines"], r["_n_removed"], r.text) for r in got.collect()), key=str)
    assert found == brute([(r.doc_id, r.text) for r in docs.collect()], divisor)
    return found


PASSAGE = "\n".join(f"line {i} of the passage" for i in range(30))


def test_query_cuts_every_shared_run_of_lines(spark, small):
    """Runs of two or more lines that an earlier document holds, found line by line, lose all their lines in the query."""
    docs = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()
    before, shared = set(), {}
    for ident, text in sorted(docs):
        all_lines = (text or "").split("\n")
        pairs = list(zip(all_lines, all_lines[1:], strict=False))
        runs = {at + k for at, pair in enumerate(pairs) if pair in before and "".join(pair).strip() for k in (0, 1)}
        shared[ident] = len(runs)
        before |= set(pairs)
    assert sum(n > 0 for n in shared.values()) > 10
    removed = {r.doc_id: r.n_removed for r in QUERIES["op10_line_dedup"](spark, small).collect()}
    assert [ident for ident, n in shared.items() if removed[ident] < n] == []


@pytest.mark.parametrize("n", range(2, 9))
def test_short_passages(spark, n):
    """A passage of a few lines goes whole, at the start, in the middle and at the end of a text."""
    passage = "\n".join(f"shared {n} {i}" for i in range(n))
    texts = [f"a\n{passage}\nb", f"{passage}\nc", f"d\n{passage}\ne", f"f\n{passage}", passage]
    found = check(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string"))
    assert [r[3] for r in found] == [texts[0], "c", "d\ne", "f", ""]


@pytest.mark.parametrize("divisor", [1, 2, 4])
def test_odd_rows(spark, small, divisor):
    extra = [
        (20, "a\nb\n" + PASSAGE + "\nend"),
        (21, "other start\n" + PASSAGE),
        (22, PASSAGE + "\n" + PASSAGE),
        (23, PASSAGE),
        (23, PASSAGE),
        (23, PASSAGE + "\nmore"),
        (24, "\n\n\n\n\n\n"),
        (25, "\n" * 50 + "x"),
        (26, "\n".join("zzzzz")),
        (27, "\n".join("yyzzyyzz")),
        (28, "one\n\ntwo\n\none\n\ntwo"),
        (None, PASSAGE),
        (None, PASSAGE + "\n?"),
    ]
    found = check(odd(spark).unionByName(spark.createDataFrame(extra, "doc_id bigint, text string"), allowMissingColumns=True), divisor)
    assert divisor > 1 or (26, 5, 3, "z\nz") in found
    check(empty(spark), divisor)
    check(spark.read.parquet(f"{small}/documents.parquet"), divisor)


def test_coarse_chunks_of_a_passage_are_found_at_any_place(spark):
    """All but the ends of a long passage goes, whatever stands before it, also with boundaries behind one line in four."""
    rows = [(i, "\n".join(f"own {i} {j}" for j in range(i % 5)) + "\n" + PASSAGE + f"\ntail {i}") for i in range(50)]
    found = check(spark.createDataFrame(rows, "doc_id bigint, text string"), 4)
    assert min(r[2] for r in found if r[0] > 4) > 15


def test_hot_passage_and_very_many_lines(spark):
    check(hot(spark, 300))
    many = "\n".join(f"{i % 1000} x" for i in range(40_000))
    rows = [(i, PASSAGE) for i in range(500)] + [(1000, many), (1001, many)]
    found = check(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5))
    assert sum(r[2] for r in found) == 499 * 30 + 39_000 + 40_000


def test_plan_is_native(spark):
    for divisor in (1, 4):
        plan = lines.remove_repeated_chunks(odd(spark), divisor)._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Arrow" not in plan
    assert [r[0] for r in spark.sql("select 'a\\nb' as c").select(lines.line_count(F.col("c"))).collect()] == [2]
