"""Instruction, prompt and message layouts, built by concatenation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The instruction, the chat markers and the judge's system prompt.
INSTRUCTION = "Summarize the following legal bill."
CHAT_SYSTEM = "<|begin_of_text|><|start_header_id|>system<|end_header_id|>\n\n"
CHAT_USER = "<|eot_id|><|start_header_id|>user<|end_header_id|>\n\n"
CHAT_ASSISTANT = "<|eot_id|><|start_header_id|>assistant<|end_header_id|>\n\n"
CHAT_END = "<|eot_id|>"
JUDGE_REFERENCE = "Reference summary:\n"
JUDGE_PREDICTION = "\n\nModel prediction:\n"
JUDGE_PROMPT = (
    "You are an expert legal‑summarization evaluator. Given a reference summary and a model‑generated "
    "prediction, rate the prediction on three criteria: relevance, factual correctness, and fluency, each "
    "from 1 (worst) to 5 (best). Return ONLY a JSON object with EXACTLY these keys, no others: "
    '{"relevance": <int>, "factual": <int>, "fluency": <int>, '
    '"relevance_reasoning": "<one sentence>", "factual_reasoning": "<one sentence>", "fluency_reasoning": "<one sentence>"}'
)


def prompt(instruction: Column, user_text: Column) -> Column:
    """Chat prompt that ends where the answer begins."""
    return F.concat(F.lit(CHAT_SYSTEM), instruction, F.lit(CHAT_USER), user_text, F.lit(CHAT_ASSISTANT))


def conversation(instruction: Column, user_text: Column, answer: Column) -> Column:
    """Full training text: the prompt, the answer and the end marker."""
    return F.concat(prompt(instruction, user_text), answer, F.lit(CHAT_END))


def judge_message(reference: Column, prediction: Column) -> Column:
    """User message shown to the judge."""
    return F.concat(F.lit(JUDGE_REFERENCE), reference, F.lit(JUDGE_PREDICTION), prediction)
