import json

import pytest
from pyspark.sql import functions as F

from brevita.functions.replies import unfenced
from brevita.operators import judge

OBJECT = '{"relevance": 3, "factual": 4, "fluency": 5, "relevance_reasoning": "r"}'


def replies(spark, texts):
    return spark.createDataFrame([(i, "m", t) for i, t in enumerate(texts)], "id bigint, model string, raw_text string")


@pytest.mark.parametrize(
    "raw, body",
    [
        (f"```json\n{OBJECT}\n```", OBJECT),
        (f"```\n{OBJECT}\n```\n  ", OBJECT),
        (f"```json {OBJECT} ```", ""),
        (f"```json\n{OBJECT}```", OBJECT + "```"),
        (f"```json\n{{\n}}```", "{"),
        (f"```json\n{OBJECT}", OBJECT),
        (f"  {OBJECT}\n", OBJECT),
        ("no json ```", "no json ```"),
    ],
)
def test_fences(spark, raw, body):
    assert replies(spark, [raw]).select(unfenced(F.col("raw_text"))).first()[0] == body


TEXTS = [
    OBJECT,
    "{}",
    '{"a": {"b": [1, 2]}}',
    '{"a": 1} trailing',
    '{"a": 1}{"b": 2}',
    '{"a": 1},{"b": 2}',
    '{"a": 1}] , [{"b": 1}',
    '{"a": 1},0],[{"b": 2}',
    '{"a": 1',
    "{'a': 1}",
    '{"a": 1,}',
    "[1, 2]",
    "3",
    '"x"',
    "null",
    "",
    "I cannot rate this.",
    ' {"a": "\\u00e9"} ',
    '{"a": 1, "a": 2}',
    '{"a": {"b": 1, "b": 2}}',
]


def test_parsing_agrees_with_json_loads(spark):
    def loads(text):
        try:
            return isinstance(json.loads(text.strip()), dict)
        except ValueError:
            return False

    got = judge.parse_replies(replies(spark, TEXTS)).orderBy("id").collect()
    assert [r.error is None for r in got] == [loads(t) for t in TEXTS]
    assert got[TEXTS.index("I cannot rate this.")].error == "I cannot rate this."


def test_lenient_integers(spark):
    values = ["3", "4.7", "-4.7", '"5"', '" -6 "', '"1_000"', '"4.5"', "true", "false", "null", "[1]", '{"x":1}', "1e2"]
    texts = ['{"relevance": %s}' % v for v in values] + ["{}", "broken", '{"relevance": 1, "relevance": 4}']
    got = judge.typed_scores(judge.parse_replies(replies(spark, texts))).orderBy("id").collect()
    assert [r.relevance for r in got] == [3, 4, -4, 5, -6, 1000, None, 1, 0, None, None, None, 100, 0, 0, 4]


def test_partial_rows_add_up_to_the_failing_criterion(spark):
    texts = [OBJECT, '{"relevance": 5, "factual": null, "fluency": 1}', "no json"]
    typed = judge.typed_scores(judge.parse_replies(replies(spark, texts)))
    got = judge.judge_summary(typed).first()
    # sums 3+5+0, 4+0, 5+0 over the two rows that count
    assert (got.mean_relevance, got.mean_factual, got.mean_fluency, got.num_examples) == (4.0, 2.0, 2.5, 2)
    clean = judge.judge_summary(typed, drop_errors=True).first()
    assert (clean.mean_relevance, clean.mean_fluency, clean.num_examples) == (8.0, 5.0, 1)


def test_golden_summary(spark):
    scores = zip(
        [2, 3, 5, 4, 2, 5, 3, 4, 5, 3, 3, 2], [4, 5, 5, 4, 2, 5, 2, 3, 4, 2, 2, 4], [5, 2, 5, 3, 2, 5, 4, 5, 5, 5, 5, 1]
    )
    texts = [json.dumps(dict(zip(judge.CRITERIA, row))) for row in scores]
    got = judge.judge_summary(judge.typed_scores(judge.parse_replies(replies(spark, texts)))).first()
    assert got.asDict() == {
        "model": "m",
        "mean_relevance": 3.417,
        "mean_factual": 3.5,
        "mean_fluency": 3.917,
        "overall_average": 3.611,
        "num_examples": 12,
    }


def test_no_valid_row(spark):
    typed = judge.typed_scores(judge.parse_replies(replies(spark, ['{"relevance": null}'])))
    assert judge.judge_summary(typed).first().mean_relevance is None
    with pytest.raises(Exception, match="no valid scores for model m"):
        judge.judge_summary(typed, strict=True).collect()
    assert judge.judge_summary(typed.limit(0)).count() == 0


def test_unjudged_examples_stay_and_reply_keys_win(spark):
    pairs = spark.createDataFrame(
        [(0, "r0", "g0"), (1, "r1", "g1"), (2, "r2", "g2")], "id bigint, reference_summary string, generated_summary string"
    )
    parsed = judge.parse_replies(replies(spark, ['{"relevance": 2, "generated_summary": "mine"}', "bad"]))
    got = judge.judged_examples(pairs, parsed).orderBy("id").collect()
    assert [(r.relevance, r.error, r.generated_summary) for r in got] == [
        (2, None, "mine"),
        (None, "bad", "g1"),
        (None, None, "g2"),
    ]


def test_sample_and_message(spark):
    pairs = spark.range(50).select(
        F.col("id"), F.lit("ref").alias("reference_summary"), F.lit("gen").alias("generated_summary")
    )
    assert [r.id for r in judge.judge_sample(pairs).collect()] == list(range(30))
    assert judge.judge_sample(pairs, None).count() == 50
    assert judge.judge_messages(pairs).first().user_message == "Reference summary:\nref\n\nModel prediction:\ngen"
