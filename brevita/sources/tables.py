"""Loading corpora, prediction pairs and published splits."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from brevita.operators.curation import pool_splits

PAIR_COLUMNS = ("doc_id", "text", "summary")
PREDICTION_COLUMNS = ("id", "model", "reference_summary", "generated_summary")


def load_corpus(spark: SparkSession, *paths: str) -> DataFrame:
    """Pool of named corpus splits, one path each, ordered as given."""
    return pool_splits(*[spark.read.parquet(p).select(*PAIR_COLUMNS) for p in paths])


def load_predictions(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).select(*PREDICTION_COLUMNS)


def load_training_splits(
    spark: SparkSession, local_dir: str, published_dir: str, schema: str
) -> tuple[DataFrame, DataFrame]:
    """Train and validation records from local JSONL, or from the published table.

    The local copy is used only if both of its splits exist.
    """
    try:
        return (
            spark.read.schema(schema).json(f"{local_dir}/split=train"),
            spark.read.schema(schema).json(f"{local_dir}/split=val"),
        )
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
    published = spark.read.parquet(published_dir)
    return (
        published.filter("split = 'train'").drop("split"),
        published.filter("split = 'validation'").drop("split"),
    )
