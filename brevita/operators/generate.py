"""Batch generation slot: a caller's text function applied to a table of prompts, one by one or in lists."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame

# A factory is called once per Python worker and returns prompt, token budget -> text.
Generator = Callable[[str, int], str]
Factory = Callable[[], Generator]

# A list factory returns prompts, token budgets -> as many texts, for models that answer a batch at once.
ListGenerator = Callable[[list[str], list[int]], list[str]]
ListFactory = Callable[[], ListGenerator]

# A batch is padded to its longest request: rows times tokens of that one. A token is taken as so many characters.
BATCH_TOKENS = 32_768
BATCH_ROWS = 64
CHARS_PER_TOKEN = 4
# Requests that a task holds to sort them by length, and their characters.
POOL_ROWS = 2048
POOL_CHARS = 64 << 20

OUTPUT = "summary string, latency_ms double, input_length int, output_length int, status string, error_message string"


@lru_cache(maxsize=4)
def _loaded(factory: Factory) -> Generator:
    return factory()


def batch_generate(requests: DataFrame, factory: Factory, key: str = "request_no") -> DataFrame:
    """Run the generator over (key, text, prompt, max_tokens), map-only in Arrow batches.

    A failing request becomes an ``error`` row and does not stop its task.
    """
    key_type = requests.schema[key].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        generate = _loaded(factory)

        def one(prompt: str, max_tokens: int) -> tuple:
            started = time.perf_counter()
            try:
                text, status, error = generate(prompt, max_tokens).strip(), "success", None
            except Exception as failure:  # noqa: BLE001 - one bad request must not fail the job
                text, status, error = None, "error", f"Inference failed: {failure}"
            return text, (time.perf_counter() - started) * 1000, status, error

        for batch in batches:
            out = [one(p, int(m)) for p, m in zip(batch["prompt"], batch["max_tokens"])]
            yield pd.DataFrame(
                {
                    key: batch[key].array,
                    "summary": [o[0] for o in out],
                    "latency_ms": [o[1] for o in out],
                    "input_length": [len(t) for t in batch["text"]],
                    "output_length": [len(o[0] or "") for o in out],
                    "status": [o[2] for o in out],
                    "error_message": [o[3] for o in out],
                }
            )

    return requests.select(key, "text", "prompt", "max_tokens").mapInPandas(run, f"{key} {key_type}, {OUTPUT}")


def length_batches(costs: list[int], batch_tokens: int, batch_rows: int) -> Iterator[list[int]]:
    """Places of requests in batches of similar cost, dearest first: rows times the dearest stay within ``batch_tokens``; one dearer than that is alone."""
    order = sorted(range(len(costs)), key=lambda i: (-costs[i], i))
    at = 0
    while at < len(order):
        fit = min(batch_rows, max(1, batch_tokens // max(1, costs[order[at]])))
        yield order[at : at + fit]
        at += fit


def answered(generate: ListGenerator, prompts: list[str], budgets: list[int]) -> list[tuple]:
    """(text, latency in ms, status, error) of each prompt. A call that fails, or gives another number of texts, is halved until the bad prompt is alone."""
    started = time.perf_counter()
    try:
        texts = generate(prompts, budgets)
        if len(texts) != len(prompts):
            raise ValueError(f"{len(texts)} answers to {len(prompts)} prompts")
        texts = [t.strip() for t in texts]
    except Exception as failure:  # noqa: BLE001 - one bad request must not fail the job
        if len(prompts) == 1:
            return [(None, (time.perf_counter() - started) * 1000, "error", f"Inference failed: {failure}")]
        half = len(prompts) // 2
        return answered(generate, prompts[:half], budgets[:half]) + answered(generate, prompts[half:], budgets[half:])
    spent = (time.perf_counter() - started) * 1000
    return [(t, spent, "success", None) for t in texts]


def batch_generate_lists(
    requests: DataFrame,
    factory: ListFactory,
    key: str = "request_no",
    batch_tokens: int = BATCH_TOKENS,
    batch_rows: int = BATCH_ROWS,
    pool_rows: int = POOL_ROWS,
) -> DataFrame:
    """``batch_generate`` for a generator that takes lists: the same rows, in batches by token budget and prompt length.

    A task holds up to ``pool_rows`` requests (or ``POOL_CHARS`` characters), sorts them by prompt length and budget, and calls the generator on batches
    whose padded size, rows times the tokens of the longest, stays within ``batch_tokens``. ``latency_ms`` is the time of the call that answered the request. One bad prompt costs
    its batch some repeated calls, and is the only ``error`` row. Map-only; rows come out in another order.
    """
    key_type = requests.schema[key].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        generate = _loaded(factory)

        def served(pool: pd.DataFrame) -> Iterator[pd.DataFrame]:
            costs = (pool["prompt"].str.len() // CHARS_PER_TOKEN + pool["max_tokens"]).astype(int).tolist()
            for places in length_batches(costs, batch_tokens, batch_rows):
                some = pool.iloc[places]
                out = answered(generate, some["prompt"].tolist(), [int(m) for m in some["max_tokens"]])
                yield pd.DataFrame(
                    {
                        key: some[key].array,
                        "summary": [o[0] for o in out],
                        "latency_ms": [o[1] for o in out],
                        "input_length": [len(t) for t in some["text"]],
                        "output_length": [len(o[0] or "") for o in out],
                        "status": [o[2] for o in out],
                        "error_message": [o[3] for o in out],
                    }
                )

        held, rows, chars = [], 0, 0
        for batch in batches:
            held.append(batch)
            rows, chars = rows + len(batch), chars + int(batch["prompt"].str.len().sum())
            if rows >= pool_rows or chars >= POOL_CHARS:
                yield from served(pd.concat(held, ignore_index=True))
                held, rows, chars = [], 0, 0
        if rows:
            yield from served(pd.concat(held, ignore_index=True))

    return requests.select(key, "text", "prompt", "max_tokens").mapInPandas(run, f"{key} {key_type}, {OUTPUT}")
