"""Tables stored in buckets by a key, so that joins on the key move no row.

Texts and what is said about them meet by id again and again: pairs and judge replies, predictions and references. Dealt and sorted once when they are stored,
two such tables with the same number of buckets join bucket by bucket, without an exchange of texts above their scans.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

BUCKETS = 64
# Turns that a window holds at once.
BLOCK_TURNS = 1024


def store_bucketed(df: DataFrame, key: str, name: str | None = None, buckets: int = BUCKETS) -> str:
    """Save ``df`` as a table in ``buckets`` buckets by ``key``, each one sorted file, below the warehouse folder; its name, a new one by default.

    One shuffle, here and never again. A bucket should fit an executor's memory several times: give large tables more buckets, the same number to all that are
    to meet. A name that exists is replaced.
    """
    spark = df.sparkSession
    table = name or f"bucketed_{uuid.uuid4().hex}"
    spark.sql(f"drop table if exists {table}")
    df.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key).format("parquet").saveAsTable(table)
    return table


def load_bucketed(spark: SparkSession, table: str) -> DataFrame:
    return spark.table(table)


def meet_by_bucket(left: DataFrame, right: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """Join of two bucketed tables by a sort-merge of their buckets, also where one would fit a broadcast; a side of other buckets is dealt anew."""
    return left.join(right.hint("merge"), key, how)


def exchanges(df: DataFrame) -> int:
    """Shuffles and broadcasts in the plan of ``df``."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.split("Initial Plan")[0].count("Exchange ")


def consecutive_turns(conversations: DataFrame, block: int = BLOCK_TURNS) -> DataFrame:
    """Each assistant turn with the turn before it: conv_id, turn, asked (the text before), answered.

    Reads conv_id, turn, role and text; (conv_id, turn) is unique, rows without either are left out. Only a turn that is one higher counts as the next. One shuffle of
    the texts in place of a join's two. Turns lie in blocks of ``block``, and the last of each stands in the next one, too, so a conversation with a third of
    all turns is many blocks. Null texts stay null; an empty table gives no row.
    """
    place = F.floor(F.col("turn") / block)
    last = F.col("turn") % block == block - 1
    own, copy = F.struct(place.alias("block"), F.lit(False).alias("copy")), F.struct((place + 1).alias("block"), F.lit(True).alias("copy"))
    rows = conversations.filter("conv_id is not null and turn is not null")
    laid = rows.select("conv_id", "turn", "role", "text", F.explode(F.when(last, F.array(own, copy)).otherwise(F.array(own))).alias("to"))
    order = Window.partitionBy("conv_id", "to.block").orderBy("turn")
    before = laid.withColumns({"before": F.lag("turn").over(order), "asked": F.lag("text").over(order)})
    kept = before.filter((F.col("role") == "assistant") & ~F.col("to.copy") & (F.col("before") == F.col("turn") - 1))
    return kept.select("conv_id", "turn", "asked", F.col("text").alias("answered"))
