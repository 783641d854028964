import pytest
from brute import ALNUM, LONG, PASSAGE, empty, hot, lower, odd

from brevita.llm import contamination


def brute(docs, items, span=10):
    wanted = {}
    for ident, text in items:
        w = ALNUM.findall(lower(text))
        n = min(span, len(w))
        for i in range(len(w) - n + 1 if n else 0):
            wanted.setdefault((n, tuple(w[i : i + n])), set()).add(ident)
    widths = {n for n, _ in wanted}
    out = []
    for ident, text in docs:
        w = ALNUM.findall(lower(text))
        hit, found = set(), set()
        for n in widths:
            for i in range(len(w) - n + 1):
                if (n, tuple(w[i : i + n])) in wanted:
                    hit |= set(range(i, i + n))
                    found |= wanted[n, tuple(w[i : i + n])]
        out.append((ident, len(w), len(hit), sorted(str(x) for x in found if x is not None)))
    return sorted(out, key=str)


def check(spark, docs, benchmark):
    got = contamination.contaminated(docs, benchmark, keep=docs.columns)
    shape = got.select("row.*").columns
    assert shape == docs.columns
    found = sorted(((r.row.doc_id, r.n_words, r.n_hit, r["items"]) for r in got.collect()), key=str)
    assert found == brute([(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in benchmark.collect()])
    return found


def items(spark, rows):
    return spark.createDataFrame([(*r, 7) for r in rows], "item_id bigint, text string, width int")


def test_given_tables(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    found = check(spark, docs, spark.read.parquet(f"{small}/benchmark.parquet"))
    assert any(n for _, _, n, _ in found)


ITEMS = [
    (1, " ".join(PASSAGE.split()[5:30])),
    (2, " ".join(LONG.split()[20_000:20_010])),
    (3, "Beta, GAMMA!"),
    (4, "one"),
    (5, None),
    (6, "... !!"),
    (7, "passage1 passage2 passage3 passage4 passage5 passage6 passage7 passage8 passage9 other"),
    (3, "same same same same same same same same same same same"),
    (None, "über 😀 alles"),
    (8, "x y z q"),
    (10, "no id here but"),
]


@pytest.mark.parametrize("make", [odd, empty, hot])
def test_odd_rows(spark, make):
    check(spark, make(spark), items(spark, ITEMS))
    check(spark, make(spark), items(spark, []))


def test_without_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        check(spark, odd(spark), items(spark, ITEMS))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
