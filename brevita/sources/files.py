"""Path checks on whatever file system a path names."""

from __future__ import annotations

from pyspark.sql import SparkSession


def resolved(spark: SparkSession, path: str):
    """The file system that Spark uses for a path, and the path as it takes it."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def exists(spark: SparkSession, path: str) -> bool:
    system, hadoop_path = resolved(spark, path)
    return system.exists(hadoop_path)


def is_folder(spark: SparkSession, path: str) -> bool:
    system, hadoop_path = resolved(spark, path)
    return system.exists(hadoop_path) and system.getFileStatus(hadoop_path).isDirectory()


def make_folder(spark: SparkSession, path: str) -> None:
    system, hadoop_path = resolved(spark, path)
    system.mkdirs(hadoop_path)


def version_folders(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the ``version=N`` folders below ``path``, newest first, finished or not. One listing."""
    if not exists(spark, path):
        return []
    system, hadoop_path = resolved(spark, path)
    names = [status.getPath().getName() for status in system.listStatus(hadoop_path)]
    return sorted((int(n.removeprefix("version=")) for n in names if n.startswith("version=")), reverse=True)


def newest_version(spark: SparkSession, path: str, before: int | None = None) -> int | None:
    """The newest finished version (below ``before``): looks at folders from the newest on and stops at the first."""
    for n in version_folders(spark, path):
        if (before is None or n < before) and exists(spark, f"{path}/version={n}/_SUCCESS"):
            return n
    return None


def versions(spark: SparkSession, path: str) -> list[int]:
    """Numbers of all finished versions below ``path``, ascending."""
    return [n for n in version_folders(spark, path)[::-1] if exists(spark, f"{path}/version={n}/_SUCCESS")]
