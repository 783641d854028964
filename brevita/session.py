"""Session setup and lineage cutting."""

from __future__ import annotations

import contextlib
import contextvars
import functools
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def prepare(spark: SparkSession) -> SparkSession:
    """What the jobs expect of any session: the package on the workers, UTC, and JSON as Python reads it.

    Of a key that a JSON object repeats, the last one counts. Arrow batches are kept short, since a row may be a
    whole document. Safe to repeat.
    """
    ship_package(spark)
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.variant.allowDuplicateKeys", "true")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1024")
    return spark


def local_session(cores: str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """Session for tests and benches; a cluster brings its own configuration."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("brevita")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    return prepare(spark)


@functools.cache
def _archive() -> str:
    package = Path(__file__).resolve().parent
    target = str(Path(tempfile.mkdtemp(prefix="brevita-")) / package.name)
    return shutil.make_archive(target, "zip", root_dir=package.parent, base_dir=package.name)


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, whatever folder the driver was started in. Safe to repeat."""
    context = spark.sparkContext
    if not any(Path(f).name == "brevita.zip" for f in context.listFiles):
        context.addPyFile(_archive())


@functools.cache
def _local_fallback() -> str:
    return tempfile.mkdtemp(prefix="brevita-")


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, taken from ``spark.checkpoint.dir``.

    Only in local mode, where driver and tasks are one process, an unset folder is replaced by a temporary one.
    On any other master an unset folder is an error: each executor would write to its own disk.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    master = spark.sparkContext.master
    if not (master == "local" or master.startswith("local[")):
        raise RuntimeError(f"spark.checkpoint.dir must name a folder shared by all executors on master {master}")
    return _local_fallback()


_scope: contextvars.ContextVar[list[str] | None] = contextvars.ContextVar("scratch", default=None)


def fresh_dir(spark: SparkSession, label: str) -> str:
    """A new, unused path below the shared folder."""
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    if (scope := _scope.get()) is not None:
        scope.append(path)
    return path


def delete(spark: SparkSession, path: str) -> None:
    """Remove a folder through the file system that Spark uses for it."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


@contextlib.contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Delete at the end every pinned table and fresh folder made inside. Only for jobs that end with their own action:
    a DataFrame returned out of the scope could no longer read what was pinned in it."""
    made: list[str] = []
    token = _scope.set(made)
    try:
        yield
    finally:
        _scope.reset(token)
        for path in made:
            delete(spark, path)


def pin(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder once and go on from the written copy.

    Used on narrow id-and-length tables that several later steps read, so that a lost executor
    costs a re-read instead of the whole corpus scan. Inside ``scratch`` the copy goes at the end of the scope.
    """
    spark = df.sparkSession
    path = fresh_dir(spark, "pinned")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
