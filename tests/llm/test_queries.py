"""The registered queries of the first operators, their flags, digests and columns, on the whole smallest tables."""

import re
import zlib

import pytest
from brute import sha, words
from test_contamination import brute as hits
from test_secret_scan import base
from test_substrings import brute as kept

from brevita.llm.queries import QUERIES


@pytest.fixture(scope="module")
def given(spark, small):
    return {name: spark.read.parquet(f"{small}/{name}.parquet").collect() for name in ("documents", "benchmark", "labels")}


def result(spark, small, name):
    return [r.asDict() for r in QUERIES[name](spark, small).collect()]


def remainder(ident, divisor):
    return zlib.crc32(str(ident).encode()) % divisor


def test_op1_mixing(spark, small, given):
    got = result(spark, small, "op1_mixing")
    size = {r.doc_id: len(words(r.text)) for r in given["documents"]}
    source = {r.doc_id: r.source for r in given["documents"]}
    assert {r["doc_id"]: r["size"] for r in got} == size and len(got) == len(size)
    whole = {s: sum(size[i] for i in size if source[i] == s) for s in set(source.values())}
    assert all(r["source_size"] == whole[source[r["doc_id"]]] for r in got)
    assert all(0 <= r["taken"] <= 2 * r["size"] for r in got)
    targets = {source[r["doc_id"]]: r["target"] for r in got}
    assert sum(targets.values()) == pytest.approx(1.5 * sum(whole.values()))
    for s, target in targets.items():
        longest = max(size[i] for i in size if source[i] == s)
        assert abs(sum(r["taken"] for r in got if source[r["doc_id"]] == s) - target) <= longest
    again = result(spark, small, "op1_mixing")
    assert {r["doc_id"]: r["taken"] for r in again} == {r["doc_id"]: r["taken"] for r in got}


def test_op2_secret_scan(spark, small, given):
    got = {r["doc_id"]: r for r in result(spark, small, "op2_secret_scan")}
    assert len(got) == len(given["documents"])
    for doc in given["documents"]:
        spans, row = base(doc.text), got[doc.doc_id]
        written = [f"{('assign', 'access', 'hex')[kind]}:{a}:{b}" for a, kind, b in spans]
        assert [row["n_assign"], row["n_access"], row["n_hex"]] == [sum(s[1] == k for s in spans) for k in range(3)]
        assert row["base_sha256"] == sha(",".join(written))
        assert [s for s in row["spans"].split(",") if s and not s.startswith("markov")] == written


def test_op4_quality(spark, small, given):
    got = {r["doc_id"]: r for r in result(spark, small, "op4_quality")}
    assert set(got) == {r.doc_id for r in given["documents"]}
    assert all(r["held_out"] == (remainder(i, 5) == 0) for i, r in got.items())
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in got.values())
    held = [(r.quality, got[r.doc_id]["score"]) for r in given["labels"] if r.doc_id in got and remainder(r.doc_id, 5) == 0]
    good, bad = [s for q, s in held if q], [s for q, s in held if not q]
    assert good and all(g > b for g in good for b in bad)


def test_op5_langid(spark, small, given):
    got = {r["doc_id"]: r for r in result(spark, small, "op5_langid")}
    known = {r.lang for r in given["documents"] if r.lang}
    right = []
    for doc in given["documents"]:
        row = got[doc.doc_id]
        assert row["held_out"] == (remainder(doc.doc_id, 4) == 2) and 0 <= row["score"] <= 1
        if not re.search(r"[^\W\d_]", doc.text or ""):
            assert row["lang_pred"] == "und"
            continue
        assert row["lang_pred"] in known
        if row["held_out"] and doc.lang:
            right.append(row["lang_pred"] == doc.lang)
    assert sum(right) >= 0.9 * len(right)


def test_op6_substrings(spark, small, given):
    got = [tuple(r[c] for c in ("doc_id", "n_words", "n_removed", "kept_sha256")) for r in result(spark, small, "op6_substrings")]
    assert sorted(got) == kept([(r.doc_id, r.text) for r in given["documents"]], 20)


def test_op7_contamination(spark, small, given):
    want = hits([(r.doc_id, r.text) for r in given["documents"]], [(r.item_id, r.text) for r in given["benchmark"]])
    got = {r["doc_id"]: r for r in result(spark, small, "op7_contamination")}
    assert len(got) == len(want)
    for ident, n_words, n_hit, found in want:
        row = got[ident]
        assert [row["n_words"], row["n_hit"], row["n_items"], row["contaminated"]] == [n_words, n_hit, len(found), n_hit > 0]
        assert row["items_sha256"] == sha(",".join(found))
