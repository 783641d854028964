import numpy as np
import pytest
from brute import empty, odd

from brevita.llm import quality
from brevita.llm.common import F, crc_remainder


def test_linear_time_score_equals_the_sum_over_pairs():
    random = np.random.default_rng(0)
    made = list(quality.features([b"a b c a", b"", None, b"Long text " * 9], [7, 0, None, 90], 6))
    model = quality.fit(*made[0], np.array([1, 0, 1, 0], np.float32), bits=6, rank=3, epochs=2, batch=2)
    model.factors = random.normal(size=model.factors.shape).astype(np.float32)
    starts, index, value = model.rows(*made[0])
    for row, got in enumerate(model.logit(starts, index, value)):
        i, x = index[starts[row] : starts[row + 1]], value[starts[row] : starts[row + 1]]
        pairs = sum(
            float(model.factors[i[a]] @ model.factors[i[b]]) * x[a] * x[b] for a in range(len(i)) for b in range(a + 1, len(i))
        )
        assert got == pytest.approx(model.bias + float(model.weights[i] @ x) + pairs, rel=1e-3, abs=1e-4)


def test_gradient_step_lowers_the_loss():
    texts = [b"good plain words here %d" % i for i in range(40)] + [b"BAD!! JUNK!! %d!!" % i for i in range(40)]
    (made,) = quality.features(texts, [0] * 80)
    labels = np.array([1.0] * 40 + [0.0] * 40, np.float32)
    losses = []
    for epochs in (1, 5):
        p = quality.fit(*made, labels, epochs=epochs, batch=16).score(*made)
        losses.append(-np.mean(labels * np.log(p) + (1 - labels) * np.log(1 - p)))
    assert losses[1] < losses[0] < 0.7


@pytest.fixture(scope="module")
def trained(spark):
    folder = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")
    return docs, labels, quality.train(docs, labels.filter(crc_remainder(F.col("doc_id"), 5) != 0))


def test_held_out_rows(trained):
    docs, labels, model = trained
    held = labels.filter(crc_remainder(F.col("doc_id"), 5) == 0)
    rows = quality.score(docs, model).select("row.doc_id", "score").join(held, "doc_id").collect()
    good, bad = [r.score for r in rows if r.quality == 1], [r.score for r in rows if r.quality == 0]
    assert np.mean([g > b for g in good for b in bad]) > 0.95
    assert np.mean([g >= quality.THRESHOLD for g in good]) > 0.97


def test_scores_use_text_and_length_only_and_agree_again(trained):
    docs, labels, model = trained
    again = quality.train(docs.repartition(5), labels.filter(crc_remainder(F.col("doc_id"), 5) != 0).repartition(3))
    assert np.array_equal(again.weights, model.weights) and again.bias == model.bias
    other = docs.withColumn("lang", F.lit("xx")).withColumn("source", F.lit(None).cast("string")).withColumn("doc_id", F.col("doc_id") + 10**9)
    first = sorted((r.row.doc_id, r.score) for r in quality.score(docs, model).collect())
    second = sorted((r.row.doc_id - 10**9, r.score) for r in quality.score(other, model).collect())
    assert first == second


def test_odd_rows(spark, trained):
    _, _, model = trained
    got = quality.score(odd(spark), model, keep=odd(spark).columns)
    assert got.select("row.*").columns == odd(spark).columns
    rows = got.collect()
    assert len(rows) == odd(spark).count() and all(0 <= r.score <= 1 for r in rows)
    by_text = {}
    for r in rows:
        by_text.setdefault((r.row.text, r.row.n_chars), set()).add(r.score)
    assert all(len(s) == 1 for s in by_text.values())
    assert quality.score(empty(spark), model).collect() == []


def test_sample_is_bounded_and_labels_may_be_odd(spark):
    labels = spark.createDataFrame(
        [(1, 1), (1, 1), (2, 0), (2, 1), (3, None), (None, 1), (4, 7), *((i, i % 2) for i in range(10, 200))], "doc_id bigint, quality int"
    )
    chosen = [r.doc_id for r in quality.sample(labels, "quality", 50).collect()]
    assert len(chosen) == len(set(chosen)) == 50
    assert {r.doc_id for r in quality.sample(labels, "quality").collect()} == {1, *range(10, 200)}
    nothing = quality.train(empty(spark), labels)
    assert {r.score for r in quality.score(odd(spark), nothing).collect()} == {0.5}
