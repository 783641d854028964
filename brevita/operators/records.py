"""Instruction records, chat texts, requests and log rows: one row in, one row out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brevita.functions.templates import INSTRUCTION, conversation, prompt
from brevita.functions.text import strip

# Bounds and default of a request's token budget.
MIN_NEW_TOKENS = 32
MAX_NEW_TOKENS = 1024
DEFAULT_MAX_TOKENS = 256

LOG_COLUMNS = (
    "timestamp_utc", "request_id", "latency_ms", "input_length", "output_length", "status",
    "model_version", "model_repo", "model_filename", "error_message",
)


def instruction_records(rows: DataFrame, *keep: str) -> DataFrame:
    """(instruction, input, output) of each (text, summary) pair."""
    return rows.select(
        *keep, F.lit(INSTRUCTION).alias("instruction"), F.col("text").alias("input"), F.col("summary").alias("output")
    )


def chat_texts(records: DataFrame) -> DataFrame:
    """Add ``text``: the record as one chat-formatted training string."""
    return records.withColumn("text", conversation(F.col("instruction"), F.col("input"), F.col("output")))


def validate_requests(requests: DataFrame) -> DataFrame:
    """Add ``max_tokens`` (default filled in), ``valid`` and the first ``reject_reason``; no row is dropped.

    Length is tested before stripping, so a single blank is a valid text.
    """
    text, tokens = F.col("text"), F.col("max_new_tokens")
    reason = (
        F.when(text.isNull(), "text is missing")
        .when(F.length(text) < 1, "text is empty")
        .when(tokens < MIN_NEW_TOKENS, f"max_new_tokens is below {MIN_NEW_TOKENS}")
        .when(tokens > MAX_NEW_TOKENS, f"max_new_tokens is above {MAX_NEW_TOKENS}")
    )
    return requests.select(
        "*",
        F.coalesce(tokens, F.lit(DEFAULT_MAX_TOKENS)).alias("max_tokens"),
        reason.isNull().alias("valid"),
        reason.alias("reject_reason"),
    )


def with_prompt(requests: DataFrame) -> DataFrame:
    """Add ``prompt``: the chat prompt around the stripped text."""
    return requests.withColumn("prompt", prompt(F.lit(INSTRUCTION), strip(F.col("text"))))


def request_key(source_key: Column) -> Column:
    """Request id from the source key, so that a retried request gets the same id."""
    return F.sha2(source_key.cast("string"), 256)


def log_rows(
    served: DataFrame,
    model_repo: str,
    model_filename: str,
    source_key: str = "request_no",
    status: Column | None = None,
    error_message: Column | None = None,
    timestamp: Column | None = None,
) -> DataFrame:
    """Log rows of served requests (input_length or text, summary, latency_ms): lengths only, never the texts."""
    input_length = F.col("input_length") if "input_length" in served.columns else F.length("text")
    rows = served.select(
        (F.current_timestamp() if timestamp is None else timestamp).alias("timestamp_utc"),
        request_key(F.col(source_key)).alias("request_id"),
        F.col("latency_ms").cast("double").alias("latency_ms"),
        input_length.alias("input_length"),
        F.length("summary").alias("output_length"),
        (F.lit("success") if status is None else status).alias("status"),
        F.lit(f"{model_repo}/{model_filename}").alias("model_version"),
        F.lit(model_repo).alias("model_repo"),
        F.lit(model_filename).alias("model_filename"),
        (F.lit(None).cast("string") if error_message is None else error_message).alias("error_message"),
    )
    return rows.select(*LOG_COLUMNS)
