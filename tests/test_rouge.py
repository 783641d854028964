import hashlib
import random
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from brevita.functions.overlap import lcs_length
from brevita.functions.stemming import STEP_2, STEP_3, STEP_4, porter_stem, stem_lists, stem_token
from brevita.operators import rouge
from brevita.plans.stem_sql import stem_tables

SCHEMA = "id bigint, model string, reference_summary string, generated_summary string"


def pairs(spark, texts):
    return spark.createDataFrame([(i, "m", r, g) for i, (r, g) in enumerate(texts)], SCHEMA)


def grams(tokens, n):
    return Counter(tuple(tokens[i : i + n]) for i in range(len(tokens) - n + 1))


def slow_lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        previous = row[:]
        for j, y in enumerate(b):
            row[j + 1] = previous[j] + 1 if x == y else max(previous[j + 1], row[j])
    return row[-1]


@pytest.fixture(scope="module")
def random_texts():
    rng = random.Random(5)

    def text(limit, words):
        return " ".join(rng.choice(words) for _ in range(rng.randrange(limit)))

    few, many = list("abc"), [f"w{i}" for i in range(40)]
    return [(text(60, w), text(90, w)) for w in (few, many) for _ in range(60)] + [("", ""), ("a", ""), ("", "a b")]


def test_ngram_overlap_against_counters(spark, random_texts):
    got = {r.id: r for r in rouge.rouge_n(pairs(spark, random_texts)).collect()}
    assert len(got) == len(random_texts)
    for i, (ref, gen) in enumerate(random_texts):
        for n in (1, 2):
            r, g = grams(ref.split(), n), grams(gen.split(), n)
            found = (got[i][f"ref_{n}"], got[i][f"gen_{n}"], got[i][f"hits_{n}"])
            assert found == (r.total(), g.total(), (r & g).total())


def test_lcs_against_brute_force(spark, random_texts):
    got = {r.id: r.lcs for r in rouge.rouge_l(pairs(spark, random_texts)).collect()}
    for i, (ref, gen) in enumerate(random_texts):
        a, b = ref.split(), gen.split()
        assert got[i] == slow_lcs(a, b) == lcs_length(b, a)


def row_lcs(a, b):
    """Quadratic recurrence, a row at a time: the running maximum of what a match adds and what was there before."""
    codes = {w: i for i, w in enumerate(set(a) | set(b))}
    b = np.array([codes[w] for w in b])
    row = np.zeros(len(b) + 1, np.int64)
    for w in a:
        row[1:] = np.maximum(row[1:], np.where(b == codes[w], row[:-1] + 1, 0))
        row = np.maximum.accumulate(row)
    return int(row[-1])


def test_lcs_of_whole_documents_against_brute_force(spark, small):
    """The longest documents and some short ones, whole, against a neighbour."""
    import re

    docs = spark.read.parquet(f"{small}/documents.parquet").orderBy(F.desc(F.length("text")), "doc_id")
    rows = [r.text for r in docs.limit(25).collect()] + [r.text for r in docs.orderBy(F.length("text"), "doc_id").limit(25).collect()]
    texts = list(zip(rows, rows[1:] + rows[:1]))
    got = {r.id: r.lcs for r in rouge.rouge_l(pairs(spark, texts)).collect()}
    for i, (ref, gen) in enumerate(texts):
        a, b = (re.findall("[a-z0-9]+", t.lower()) for t in (ref, gen))
        assert got[i] == row_lcs(a, b)
    assert row_lcs("abcbdab", "bdcaba") == 4


def test_identical_and_known_scores(spark):
    got = rouge.rouge_scores(pairs(spark, [("The cat, sat!", "the CAT sat"), ("police killed the gunman", "the gunman killed police"), ("x", "")]))
    rows = {r.id: r for r in got.collect()}
    assert (rows[0].rouge1, rows[0].rouge2, rows[0].rougeL) == (1.0, 1.0, 1.0)
    assert (rows[1].rouge1, round(rows[1].rouge2, 6), rows[1].rougeL) == (1.0, round(1 / 3, 6), 0.5)
    assert (rows[2].rouge1, rows[2].rouge2, rows[2].rougeL) == (0.0, 0.0, 0.0)


def test_tokens_are_normalised(spark):
    got = rouge.rouge_n(pairs(spark, [("A-b_c  d1", "a b c d1")])).first()
    assert (got.ref_1, got.hits_1) == (4, 4)


@pytest.mark.parametrize(
    "word, stem",
    [
        ("caresses", "caress"), ("ponies", "poni"), ("ties", "ti"), ("caress", "caress"), ("cats", "cat"),
        ("feed", "feed"), ("agreed", "agre"), ("plastered", "plaster"), ("bled", "bled"), ("motoring", "motor"),
        ("sing", "sing"), ("conflated", "conflat"), ("troubled", "troubl"), ("sized", "size"), ("hopping", "hop"),
        ("tanned", "tan"), ("falling", "fall"), ("hissing", "hiss"), ("fizzed", "fizz"), ("failing", "fail"),
        ("filing", "file"), ("happy", "happi"), ("sky", "sky"), ("relational", "relat"), ("conditional", "condit"),
        ("rational", "ration"), ("digitizer", "digit"), ("radically", "radic"), ("vietnamization", "vietnam"),
        ("operator", "oper"), ("feudalism", "feudal"), ("decisiveness", "decis"), ("hopefulness", "hope"),
        ("sensibiliti", "sensibl"), ("triplicate", "triplic"), ("formative", "form"), ("electrical", "electr"),
        ("goodness", "good"), ("revival", "reviv"), ("allowance", "allow"), ("adjustable", "adjust"),
        ("replacement", "replac"), ("adoption", "adopt"), ("communism", "commun"), ("bowdlerize", "bowdler"),
        ("probate", "probat"), ("rate", "rate"), ("cease", "ceas"), ("controll", "control"), ("roll", "roll"),
    ],
)
def test_stems_of_the_paper(word, stem):
    assert porter_stem(word) == stem


def test_stemming_changes_the_overlap(spark):
    df = pairs(spark, [("committees running", "committee runs")])
    assert rouge.rouge_n(df).first().hits_1 == 0
    assert rouge.rouge_n(df, stem=True).first().hits_1 == 2
    assert stem_token("was") == "was"


def test_bootstrap_interval(spark):
    rng = random.Random(1)
    rows = [(i, "m", *(rng.random() for _ in range(3))) for i in range(400)]
    scores = spark.createDataFrame(rows, "id bigint, model string, rouge1 double, rouge2 double, rougeL double")
    got, mean = rouge.rouge_bootstrap(scores).first(), rouge.rouge_corpus(scores).first()
    for m in rouge.METRICS:
        assert got[f"{m}_low"] < got[f"{m}_mid"] < got[f"{m}_high"]
        assert abs(got[f"{m}_mid"] - mean[m]) < 0.005
        # 1.96 standard errors of a uniform variable over 400 rows is 0.0283
        assert 0.022 < mean[m] - got[f"{m}_low"] < 0.035


def test_poisson_weights_have_mean_and_variance_one():
    u = np.arange(200_000, dtype=np.int64) * 10_007 * 997 % rouge.PRIME
    weights = np.searchsorted(np.array(rouge.POISSON_STEPS), u, side="right")
    assert abs(weights.mean() - 1) < 0.02 and abs(weights.var() - 1) < 0.03


def test_bootstrap_sums_equal_a_loop(spark):
    rows = [(i, f"m{i % 2}", i / 50, 1 - i / 60, 0.5) for i in range(40)]
    scores = spark.createDataFrame(rows, "id bigint, model string, rouge1 double, rouge2 double, rougeL double").repartition(3)
    got = {r.model: r for r in rouge.rouge_bootstrap(scores, replicates=50).collect()}
    for model in ("m0", "m1"):
        means = []
        for rep in range(1, 51):
            total = weight = 0.0
            for i, m, value, *_ in rows:
                digest = hashlib.md5(f"42:{i}".encode()).hexdigest()
                u = (int(digest[:8], 16) % rouge.PRIME * rep + int(digest[8:16], 16) % rouge.PRIME) % rouge.PRIME
                w = sum(u >= step for step in rouge.POISSON_STEPS) if m == model else 0
                total, weight = total + w * value, weight + w
            means.append(total / weight)
        assert got[model].rouge1_mid == pytest.approx(np.quantile(means, 0.5))
        assert got[model].rouge1_low == pytest.approx(np.quantile(means, 0.025))



def test_stems_in_sql_are_those_of_the_function():
    draw = random.Random(4)
    ends = [*STEP_2, *STEP_3, *STEP_4, "s", "sses", "ies", "eed", "ed", "ing", "y", "e", "ll", "ated", "tting", "bled", "izing", "lling", ""]
    starts = ["".join(draw.choice("aeiouybcdlstwx1") for _ in range(draw.randint(0, 6))) for _ in range(400)]
    words = sorted({s + e + t for s in starts for e in draw.sample(ends, 12) for t in ("", draw.choice(["s", "ed", "ing", "ly"]))} - {""})
    con = duckdb.connect()
    con.execute("create table words as select unnest(?) as w0", [words])
    got = dict(con.sql(f"with {stem_tables('words')} select w0, w from stems").fetchall())
    assert len(words) > 5000 and got == {w: stem_token(w) for w in words}


def test_texts_of_a_batch_are_spelled_from_their_stems():
    texts = pa.array(["running runs", None, "", "the generations of relational hopping", "runs"])[1:]
    assert stem_lists(texts).to_pylist() == [None, "", " ".join(map(stem_token, "the generations of relational hopping".split())), "run"]
    assert stem_lists(pa.array([], pa.string())).to_pylist() == []
