"""Fixed values, typed once more: the SQL counterparts take them from the code, so a wrong one would pass there."""

import math

from brevita.functions import templates
from brevita.operators import curation, gate, judge, logs, records, rouge, sampling
from brevita.plans.jobs import SplitSizes

# Layout of training texts, and what the judge is told.
TRAINING_TEXT = (
    "<|begin_of_text|><|start_header_id|>system<|end_header_id|>\n\nSummarize the following legal bill.<|eot_id|>"
    "<|start_header_id|>user<|end_header_id|>\n\nBILL<|eot_id|><|start_header_id|>assistant<|end_header_id|>\n\nSUMMARY<|eot_id|>"
)
JUDGE_START = "You are an expert legal‑summarization evaluator. Given a reference summary and a model‑generated prediction,"
JUDGE_KEYS = "relevance factual fluency relevance_reasoning factual_reasoning fluency_reasoning".split()


def test_texts(spark):
    row = spark.sql("select 'Summarize the following legal bill.' as instruction, 'BILL' as input, 'SUMMARY' as output")
    assert records.chat_texts(row).first().text == TRAINING_TEXT
    assert templates.JUDGE_PROMPT.startswith(JUDGE_START)
    assert [k for k in JUDGE_KEYS if f'"{k}": <int>' in templates.JUDGE_PROMPT] == JUDGE_KEYS[:3]
    assert [k for k in JUDGE_KEYS if f'"{k}": "<one sentence>"' in templates.JUDGE_PROMPT] == JUDGE_KEYS[3:]
    assert "each from 1 (worst) to 5 (best)" in templates.JUDGE_PROMPT
    pair = spark.sql("select 1 as id, 'A' as reference_summary, 'B' as generated_summary")
    assert judge.judge_messages(pair).first().user_message == "Reference summary:\nA\n\nModel prediction:\nB"


def test_numbers_and_reasons():
    assert (gate.DEFAULT_THRESHOLD, gate.ROUGE_WEIGHT, gate.JUDGE_WEIGHT, gate.JUDGE_SCALE) == (0.02, 0.5, 0.5, 5.0)
    assert gate.NO_CHAMPION == "No cached champion exists." and gate.COMPARED == "Compared against cached champion."
    assert (judge.MAX_EXAMPLES, logs.RECENT_ROWS, sampling.SPLIT_SEED) == (30, 1000, 42)
    assert list(logs.PERCENTILES.values()) == [0.5, 0.95]
    assert curation.LengthBand() == curation.LengthBand(1500, 6000, 200, 1500)
    assert (SplitSizes().train, SplitSizes().val, SplitSizes().test) == (3000, 300, 200)
    assert (records.MIN_NEW_TOKENS, records.MAX_NEW_TOKENS, records.DEFAULT_MAX_TOKENS) == (32, 1024, 256)


def test_poisson_steps():
    assert rouge.PRIME == 2**31 - 1 and len(rouge.POISSON_STEPS) == 11
    total = 0.0
    for k, step in enumerate(rouge.POISSON_STEPS):
        total += math.exp(-1) / math.factorial(k)
        assert abs(step / rouge.PRIME - total) < 1e-9
