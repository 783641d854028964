import random

import pytest

from brevita.operators import judge
from brevita.plans import evaluation
from brevita.plans.views import DOCUMENT_PAIRS, derived
from brevita.sources import bucketed


def test_texts_meet_without_an_exchange(spark, small):
    """The plan has no exchange above the scans, at sizes where Spark would send one side to all tasks, too; the rows are those of the plain join."""
    pairs = bucketed.store_bucketed(derived(spark, small, DOCUMENT_PAIRS), "id", buckets=5)
    replies = bucketed.store_bucketed(evaluation.judge_raw(spark, small), "id", buckets=5)
    parsed = judge.parse_replies(bucketed.load_bucketed(spark, replies))
    got = judge.judged_examples(bucketed.load_bucketed(spark, pairs), parsed.hint("merge"))
    assert bucketed.exchanges(got) == 0
    assert bucketed.exchanges(evaluation.judged_examples(spark, small)) > 0
    assert sorted(map(str, got.collect())) == sorted(map(str, evaluation.judged_examples(spark, small).collect()))
    # Once more from the tables' names, and with another number of buckets on one side.
    again = bucketed.store_bucketed(evaluation.judge_raw(spark, small), "id", replies, buckets=3)
    other = bucketed.meet_by_bucket(bucketed.load_bucketed(spark, pairs), bucketed.load_bucketed(spark, again).drop("model"), "id")
    assert again == replies and bucketed.exchanges(other) >= 1 and other.count() == bucketed.load_bucketed(spark, pairs).count()
    for name in (pairs, replies):
        spark.sql(f"drop table {name}")


@pytest.mark.parametrize("block", [1, 3, 1024])
def test_turns_of_long_and_broken_conversations(spark, block):
    rng = random.Random(4)
    rows = [(1, t, "assistant" if t % 2 else "user", f"hot {t}") for t in range(200)]
    rows += [(c, t, rng.choice(["user", "assistant"]), None if rng.random() < 0.1 else f"{c} {t}") for c in range(2, 30) for t in range(12) if rng.random() < 0.8]
    rows += [(None, 1, "assistant", "x"), (5, None, "assistant", "x"), (40, -3, "user", "a"), (40, -2, "assistant", "b"), (40, 0, "assistant", "c")]
    texts = {(c, t): x for c, t, _, x in rows if c is not None and t is not None}
    expected = [(c, t, texts[c, t - 1], x) for c, t, role, x in rows if (c, t) in texts and role == "assistant" and (c, t - 1) in texts]
    df = spark.createDataFrame(rows, "conv_id bigint, turn int, role string, text string").repartition(4)
    got = bucketed.consecutive_turns(df, block)
    assert sorted(map(tuple, got.collect()), key=str) == sorted(expected, key=str)
    assert bucketed.consecutive_turns(df.limit(0)).collect() == []
    assert bucketed.exchanges(got) <= 2
