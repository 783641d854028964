"""Published splits in versions: folders named by their contents, a manifest in each, and numbered pointers.

    <path>/contents/<digest>/split=.../*.parquet, _manifest.json    one folder for each content, never changed
    <path>/versions/00000001.json                                   the digest that became the newest, one file for each publish

A version is written under another name and renamed once it is whole; a pointer is a small file that is renamed into place and never replaced. So a reader
sees the version before or the one after, whatever a publisher does meanwhile, and a reader of an old number still finds its files. Renames have to be
atomic, as on HDFS and local disks.
"""

from __future__ import annotations

import hashlib
import json
import time
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from brevita.session import delete, pin, scratch
from brevita.sources.files import exists, resolved
from brevita.sources.records import PUBLISHED_NAMES

MANIFEST = "_manifest.json"


@dataclass(frozen=True)
class Version:
    """A published version: its number, the digest of its contents, rows by split; and whether this call wrote its files and its pointer."""

    number: int
    digest: str
    rows: dict[str, int]
    wrote_files: bool = False
    wrote_pointer: bool = False


# --- small files ---------------------------------------------------------------------------------------------------------------


def _read_json(spark: SparkSession, path: str) -> dict:
    system, target = resolved(spark, path)
    stream = system.open(target)
    try:
        return json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def _write_json(spark: SparkSession, path: str, value: dict) -> None:
    system, target = resolved(spark, path)
    stream = system.create(target, False)
    stream.write(bytearray(json.dumps(value, sort_keys=True, indent=1).encode()))
    stream.close()


def _renamed(spark: SparkSession, source: str, target: str) -> bool:
    """Rename, unless the target is there already; whether it was done."""
    jvm = spark._jvm
    system, to = resolved(spark, target)
    system.mkdirs(to.getParent())
    # Options are left out: an existing target is an error, not a folder to move into.
    options = spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(to.toUri(), spark._jsc.hadoopConfiguration())
    try:
        context.rename(context.makeQualified(jvm.org.apache.hadoop.fs.Path(source)), context.makeQualified(to), options)
        return True
    except Exception:  # noqa: BLE001 - the JVM's errors differ between file systems
        if not exists(spark, target):
            raise
        return False


def _listed(spark: SparkSession, path: str) -> list[str]:
    system, target = resolved(spark, path)
    return sorted(s.getPath().getName() for s in system.listStatus(target)) if system.exists(target) else []


def _numbers(spark: SparkSession, path: str) -> list[int]:
    return [int(name.removesuffix(".json")) for name in _listed(spark, f"{path}/versions") if name.endswith(".json") and name[0].isdigit()]


# --- publishing ------------------------------------------------------------------------------------------------------------------


def contents(records: DataFrame) -> tuple[str, dict[str, int]]:
    """Digest of the rows, whatever their order and files, with columns and split names; and rows by split. One pass."""
    columns = [c for c in records.columns if c != "split"]
    row = F.struct(*columns)
    sums = records.groupBy("split").agg(
        F.count("*").alias("n"),
        F.sum(F.xxhash64(row).cast("decimal(20,0)")).cast("string").alias("sum"),
        F.hex(F.bit_xor(F.xxhash64(F.lit("second"), row))).alias("xor"),
    )
    # A row for each split.
    found = sorted(tuple(r) for r in sums.collect())
    rows = dict.fromkeys(PUBLISHED_NAMES.values(), 0) | {split: n for split, n, *_ in found}
    said = json.dumps([[[f.name, f.dataType.simpleString()] for f in records.schema if f.name != "split"], sorted(rows.items()), found])
    return hashlib.sha256(said.encode()).hexdigest(), rows


def publish_version(records: DataFrame, path: str) -> Version:
    """Make ``records`` (with ``split``: train, val or test) the newest version below ``path``.

    What is the newest version already is not published again, and contents that any version had are not written again: a repeated call writes nothing.
    Splits get their published names; one without rows is a part of the version all the same. Two publishers at a time both succeed, one after the other.
    """
    spark = records.sparkSession
    names = F.create_map(*[F.lit(x) for pair in PUBLISHED_NAMES.items() for x in pair])
    with scratch(spark):
        fixed = pin(records.withColumn("split", F.coalesce(names[F.col("split")], F.col("split"))))
        digest, rows = contents(fixed)
        newest = newest_version(spark, path)
        if newest and newest.digest == digest:
            return newest
        folder = f"{path}/contents/{digest}"
        wrote = False
        if not exists(spark, f"{folder}/{MANIFEST}"):
            made = f"{path}/contents/.{digest}-{uuid.uuid4().hex}"
            fixed.write.partitionBy("split").parquet(made)
            _write_json(spark, f"{made}/{MANIFEST}", _manifest(spark, made, fixed.schema, digest, rows))
            wrote = _renamed(spark, made, folder)
            if not wrote:  # another publisher of the same rows was first
                delete(spark, made)
    number = _point(spark, path, digest)
    return Version(number, digest, rows, wrote, True)


def _manifest(spark: SparkSession, folder: str, schema: StructType, digest: str, rows: dict[str, int]) -> dict:
    system, root = resolved(spark, folder)
    files, found = [], system.listFiles(root, True)
    base = system.makeQualified(root).toString()
    while found.hasNext():
        status = found.next()
        if status.getPath().getName().endswith(".parquet"):
            files.append({"file": status.getPath().toString().removeprefix(base).lstrip("/"), "bytes": status.getLen()})
    return {"digest": digest, "rows": rows, "schema": schema.jsonValue(), "files": sorted(files, key=lambda f: f["file"])}


def _point(spark: SparkSession, path: str, digest: str) -> int:
    """The next free number names the digest. A number that someone else takes meanwhile is passed over."""
    number = max(_numbers(spark, path), default=0)
    made = f"{path}/versions/.{uuid.uuid4().hex}"
    while True:
        number += 1
        _write_json(spark, made, {"number": number, "digest": digest, "published_at": time.time()})
        if _renamed(spark, made, f"{path}/versions/{number:08d}.json"):
            return number
        delete(spark, made)


# --- reading ---------------------------------------------------------------------------------------------------------------------


def newest_version(spark: SparkSession, path: str) -> Version | None:
    numbers = _numbers(spark, path)
    return version(spark, path, max(numbers)) if numbers else None


def version(spark: SparkSession, path: str, number: int) -> Version:
    digest = _read_json(spark, f"{path}/versions/{number:08d}.json")["digest"]
    return Version(number, digest, _read_json(spark, f"{path}/contents/{digest}/{MANIFEST}")["rows"])


def history(spark: SparkSession, path: str) -> list[Version]:
    """All versions that are still there, oldest first."""
    return [version(spark, path, n) for n in sorted(_numbers(spark, path))]


def published_complete(spark: SparkSession, path: str) -> bool:
    """A version is there, and it names all splits, with rows or without."""
    newest = newest_version(spark, path)
    return newest is not None and set(PUBLISHED_NAMES.values()) <= newest.rows.keys()


def read_published(spark: SparkSession, path: str, number: int | None = None) -> DataFrame:
    """The records, with ``split``, of a version, by default the newest one at this moment. Exactly the files of its manifest are read."""
    held = newest_version(spark, path) if number is None else version(spark, path, number)
    if held is None:
        raise FileNotFoundError(f"no version is published below {path}")
    folder = f"{path}/contents/{held.digest}"
    manifest = _read_json(spark, f"{folder}/{MANIFEST}")
    schema = StructType.fromJson(manifest["schema"])
    files = [f"{folder}/{f['file']}" for f in manifest["files"]]
    if not files:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", folder).parquet(*files).select(schema.names)


def ensure_published(
    spark: SparkSession, path: str, build: Callable[[], DataFrame], force: bool = False
) -> tuple[DataFrame, Version]:
    """The newest records, built and published only if there is no complete version or ``force`` is set."""
    build_now = force or not published_complete(spark, path)
    held = publish_version(build(), path) if build_now else newest_version(spark, path)
    return read_published(spark, path, held.number), held


def forget_versions(spark: SparkSession, path: str, keep: int) -> list[int]:
    """Delete all but the newest ``keep`` pointers, then contents that no pointer names and that no publish in the last day began. Numbers deleted."""
    if keep < 1:
        raise ValueError("at least the newest version has to stay")
    gone = sorted(_numbers(spark, path))[:-keep]
    for n in gone:
        delete(spark, f"{path}/versions/{n:08d}.json")
    named = {v.digest for v in history(spark, path)}
    system, root = resolved(spark, f"{path}/contents")
    day_ago = (time.time() - 86_400) * 1000
    for status in system.listStatus(root) if system.exists(root) else []:
        name = status.getPath().getName()
        if name not in named and (not name.startswith(".") or status.getModificationTime() < day_ago):
            delete(spark, f"{path}/contents/{name}")
    return gone
