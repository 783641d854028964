"""Writing and reading records, splits, result tables and the decision log."""

from __future__ import annotations

import logging
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brevita.session import delete
from brevita.sources.files import exists, make_folder, newest_version, version_folders

RECORD_SCHEMA = "instruction string, input string, output string"
SPLITS = ("train", "val", "test")

# Fixed value: the validation split has a longer name where it is published.
PUBLISHED_NAMES = {"train": "train", "val": "validation", "test": "test"}

JUDGE_RESULT_SCHEMA = (
    "id bigint, reference_summary string, generated_summary string, relevance int, factual int, fluency int, "
    "relevance_reasoning string, factual_reasoning string, fluency_reasoning string, error string"
)
CHAMPION_SCHEMA = "family string, seq bigint, combined_score double"

# Copies of a versioned table that a stream leaves: the one in force, and those that a repeated batch may start from.
KEPT_VERSIONS = 10

log = logging.getLogger(__name__)


def write_jsonl(records: DataFrame, path: str, by: str | None = "split") -> None:
    """One JSON object per line, null fields kept, one folder per split."""
    writer = records.write.mode("overwrite").option("ignoreNullFields", False)
    (writer.partitionBy(by) if by else writer).json(path)


def read_jsonl(spark: SparkSession, path: str, schema: str = RECORD_SCHEMA) -> DataFrame:
    """Records with a stated schema, so that no pass is spent on inferring one."""
    return spark.read.schema(schema).json(path)


def read_json_array(spark: SparkSession, path: str, schema: str = JUDGE_RESULT_SCHEMA) -> DataFrame:
    """Results stored as one JSON array. Such a file cannot be split; JSONL is the layout for long tables."""
    return spark.read.schema(schema).option("multiLine", True).json(path)


def publish_splits(records: DataFrame, path: str) -> None:
    """Named splits as Parquet, one folder each, under their published names."""
    names = F.create_map(*[F.lit(x) for pair in PUBLISHED_NAMES.items() for x in pair])
    records.withColumn("split", names[F.col("split")]).write.mode("overwrite").partitionBy("split").parquet(path)


def splits_complete(spark: SparkSession, path: str) -> bool:
    """All three splits are there and the job that wrote them finished."""
    return exists(spark, f"{path}/_SUCCESS") and all(exists(spark, f"{path}/split={s}") for s in SPLITS)


def ensure_splits(
    spark: SparkSession, path: str, build: Callable[[], DataFrame], force: bool = False
) -> tuple[DataFrame, bool]:
    """Records below ``path``, built only if a split is missing or ``force`` is set; and whether they were built. A split without rows is an empty folder."""
    build_now = force or not splits_complete(spark, path)
    if build_now:
        write_jsonl(build(), path)
        for s in SPLITS:
            make_folder(spark, f"{path}/split={s}")
    return read_jsonl(spark, path, RECORD_SCHEMA + ", split string"), build_now


def write_result(df: DataFrame, path: str) -> None:
    """Replace a small result table."""
    df.write.mode("overwrite").option("ignoreNullFields", False).json(path)


def append_decisions(decisions: DataFrame, path: str) -> None:
    """Append decisions, one JSON object per line."""
    decisions.write.mode("append").option("ignoreNullFields", False).json(path)


def write_version(df: DataFrame, path: str, version: int) -> None:
    """Write one numbered copy of a table; repeating a number replaces that copy only."""
    df.write.mode("overwrite").parquet(f"{path}/version={version}")


def read_version(
    spark: SparkSession, path: str, empty: str = CHAMPION_SCHEMA, before: int | None = None
) -> DataFrame:
    """Newest finished copy (below ``before``) with all its columns, or an empty table of the schema ``empty``."""
    newest = newest_version(spark, path, before)
    if newest is None:
        return spark.createDataFrame([], empty)
    return spark.read.parquet(f"{path}/version={newest}")


def prune_versions(spark: SparkSession, path: str, keep: int = KEPT_VERSIONS) -> None:
    """Delete all but the newest ``keep`` finished copies, and what lies before them unfinished."""
    numbers = version_folders(spark, path)
    finished = [n for n in numbers[: keep + 1] if exists(spark, f"{path}/version={n}/_SUCCESS")]
    if len(finished) >= keep:
        for n in numbers:
            if n < finished[keep - 1]:
                delete(spark, f"{path}/version={n}")


def append_logs(rows: DataFrame, path: str, run: str | None = None) -> bool:
    """Append log rows by run and day. Best effort: a failure is logged and reported, never raised.

    A run that is repeated under its own name replaces what it has written; without a name each call is a run of its own.
    """
    try:
        by_day = rows.withColumn("log_date", F.to_date("timestamp_utc"))
        folder = f"{path}/run={run or uuid.uuid4().hex}"
        by_day.write.mode("overwrite").partitionBy("log_date").parquet(folder)
        return True
    except Exception as failure:  # noqa: BLE001 - logging must not stop serving
        log.warning("log rows were not appended: %s", failure)
        return False
