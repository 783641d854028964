import numpy as np
import pytest
from brute import empty, odd

from brevita.llm import langid
from brevita.llm.common import F, crc_remainder


def test_tables_equal_plain_convolution():
    random = np.random.default_rng(1)
    net = langid.fit(np.zeros((0, 16), np.uint8), np.zeros(0, int), ["a", "b"], widths=(2, 3, 4, 5), filters=3)
    for w in net.filters:
        net.filters[w] = random.normal(size=net.filters[w].shape).astype(np.float32)
    x = random.integers(0, 256, (7, 16)).astype(np.uint8)
    plain = []
    for w, table in net.filters.items():
        one_hot = np.eye(256)[x]
        z = np.stack([sum(one_hot[:, t + j] @ table[j] for j in range(w)) for t in range(16 - w + 1)], axis=1)
        plain.append(z.max(axis=1))
    assert np.allclose(net.prepared().pooled(x), np.concatenate(plain, axis=1), atol=1e-4)


def test_windows():
    assert langid.windows(b"", 4).tolist() == [[0, 0, 0, 0]]
    assert langid.windows(b"abcde", 4).tolist() == [[97, 98, 99, 100], [101, 0, 0, 0]]
    assert len(langid.windows(b"abcd", 4)) == 1


@pytest.fixture(scope="module")
def trained(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    return docs, langid.train(docs.filter(crc_remainder(F.col("doc_id"), 4) != 2))


def test_held_out_accuracy(trained):
    docs, net = trained
    held = docs.filter(crc_remainder(F.col("doc_id"), 4) == 2)
    rows = langid.predict(held, net, keep=("doc_id", "lang")).collect()
    assert np.mean([r.row.lang == r.lang_pred for r in rows]) > 0.97
    assert all(0 <= r.score <= 1 for r in rows)


def test_input_is_the_text_alone_and_training_agrees_again(trained):
    docs, net = trained
    again = langid.train(docs.filter(crc_remainder(F.col("doc_id"), 4) != 2).repartition(5))
    assert np.array_equal(again.out, net.out)
    other = docs.select((-F.col("doc_id")).alias("doc_id"), "text", F.lit("zz").alias("lang"))
    one = sorted((r.row.doc_id, r.lang_pred, r.score) for r in langid.predict(docs, net).collect())
    two = sorted((-r.row.doc_id, r.lang_pred, r.score) for r in langid.predict(other, net).collect())
    assert one == two


def test_odd_rows(spark, trained):
    docs, net = trained
    extra = spark.createDataFrame([(50, "123 !! 456"), (51, "\x00"), (52, "é"), (53, "x" * 3_000_000)], "doc_id bigint, text string")
    df = odd(spark).unionByName(extra, allowMissingColumns=True)
    rows = langid.predict(df, net, keep=df.columns).collect()
    assert len(rows) == df.count()
    unknown = {r.row.doc_id for r in rows if r.lang_pred == "und"}
    assert unknown == {2, 3, 4, 50, 51} and all(r.score == 0 for r in rows if r.lang_pred == "und")
    assert {r.lang_pred for r in rows} <= {"und", *net.languages}
    assert langid.predict(empty(spark), net).collect() == []


def test_sample_is_bounded_and_no_labels(spark):
    rows = [(i % 900, "hot" if i % 3 else "rare", "text") for i in range(3000)] + [(1, None, "text"), (None, "hot", "t")]
    docs = spark.createDataFrame(rows, "doc_id bigint, lang string, text string")
    got = langid.sample(docs, 100).groupBy("lang").count().collect()
    assert all(0 < r["count"] <= 100 for r in got) and len(got) == 2
    nothing = langid.train(empty(spark))
    assert {r.lang_pred for r in langid.predict(odd(spark), nothing).collect()} == {"und"}
