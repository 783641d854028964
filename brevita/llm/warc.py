"""WARC archives: a deterministic sharded writer and a streaming reader.

Records are range-sorted by page. A histogram of bytes over at most some thousand page ranges, which is the same in every run, says where a
shard ends; each shard is written by one task, which rolls to a new file when the compressed size is reached. A file is
written under a temporary name, then renamed to a name that depends on shard and sequence only. The files that count are those in the
manifest, a table that Spark commits at the end. So a repeated task or run writes the same bytes to the same names.
"""

from __future__ import annotations

import gzip
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from brevita.session import delete, pin

# What a record has besides its payload, about, and the tasks that write; beyond so many shards a task writes several.
RECORD_BYTES = 600
MOST_TASKS = 20_000
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
SMALLEST_REVISITED = 100

_MANIFEST = "file string, shard int, part int, records bigint, bytes bigint, sha256 string"
_RECORD = (
    "page_id bigint, url string, record_id string, record_type string, payload_bytes bigint, payload_digest string, refers_to bigint"
)


# --- writing -----------------------------------------------------------------------------------------------------------


def _record_id(page_id: int | None, digest: str) -> str:
    name = f"{page_id}:{digest}"
    return f"<urn:uuid:{uuid.UUID(bytes=hashlib.sha256(name.encode()).digest()[:16], version=5)}>"


def _member(headers: list[tuple[str, object]], block: bytes) -> bytes:
    """One record as a gzip member of its own, without a time stamp."""
    lines = [f"{name}: {value}" for name, value in headers if value is not None]
    head = "\r\n".join(["WARC/1.1", *lines, f"Content-Length: {len(block)}", "", ""])
    squeeze = zlib.compressobj(6, zlib.DEFLATED, 31)
    return squeeze.compress(head.encode() + block + b"\r\n\r\n") + squeeze.flush()


def _info(name: str, date: str) -> bytes:
    fields = b"format: WARC File Format 1.1\r\n"
    ident = f"<urn:uuid:{uuid.UUID(bytes=hashlib.sha256(name.encode()).digest()[:16], version=5)}>"
    return _member(
        [
            ("WARC-Type", "warcinfo"),
            ("WARC-Record-ID", ident),
            ("WARC-Date", date),
            ("WARC-Filename", name),
            ("Content-Type", "application/warc-fields"),
        ],
        fields,
    )


def _page(page_id, url: str | None, digest: str, size: int, payload: bytes, revisited, date: str) -> bytes:
    """A response with HTTP head and payload, or a revisit with the head only. ``revisited``: (page_id,) of the response."""
    length = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    block = length if revisited else length + payload
    # Line ends or blanks in an address would end the header.
    uri = None if url is None else re.sub(r"[\x00-\x20\x7F]", lambda m: f"%{ord(m[0]):02X}", url)
    return _member(
        [
            ("WARC-Type", "revisit" if revisited else "response"),
            ("WARC-Record-ID", _record_id(page_id, digest)),
            ("WARC-Date", date),
            ("WARC-Target-URI", uri),
            ("WARC-Payload-Digest", f"sha256:{digest}"),
            ("WARC-Block-Digest", f"sha256:{hashlib.sha256(block).hexdigest()}"),
            ("WARC-Profile", REVISIT_PROFILE if revisited else None),
            ("WARC-Refers-To", _record_id(revisited[0], digest) if revisited else None),
            ("Content-Type", "application/http; msgtype=response"),
            ("X-Page-ID", page_id),
            ("X-Refers-To-Page-ID", revisited[0] if revisited else None),
            ("X-Payload-Length", size),
        ],
        block,
    )


class _Roller:
    """The files of one shard after another, one open at a time."""

    def __init__(self, folder: str, most: int, date: str):
        self.store, self.root = fs.FileSystem.from_uri(folder)
        self.most, self.date = most, date
        self.shard, self.part, self.out = None, 0, None

    def add(self, shard: int, member: bytes) -> dict | None:
        """Writes a record; returns the manifest row of a file that was closed for it."""
        closed = None
        if self.out and (shard != self.shard or self.size >= self.most):
            closed = self.close()
        if not self.out:
            self.part = self.part + 1 if shard == self.shard else 0
            self.shard, self.size, self.records, self.digest = shard, 0, 0, hashlib.sha256()
            self.name = f"pages-{shard:06d}-{self.part:05d}.warc.gz"
            self.temporary = f"{self.root}/_temporary/{self.name}.{uuid.uuid4().hex}"
            self.store.create_dir(f"{self.root}/_temporary", recursive=True)
            self.out = self.store.open_output_stream(self.temporary, compression=None)
            self._put(_info(self.name, self.date))
        self._put(member)
        self.records += 1
        return closed

    def _put(self, data: bytes) -> None:
        self.out.write(data)
        self.digest.update(data)
        self.size += len(data)

    def _sha256(self, path: str) -> str:
        digest = hashlib.sha256()
        with self.store.open_input_stream(path, compression=None) as stream:
            while data := stream.read(1 << 20):
                digest.update(data)
        return digest.hexdigest()

    def close(self) -> dict:
        self.out.close()
        self.out = None
        final = f"{self.root}/{self.name}"
        held = self.store.get_file_info(final)
        if held.type == fs.FileType.File and held.size == self.size and self._sha256(final) == self.digest.hexdigest():
            self.store.delete_file(self.temporary)  # an earlier attempt has put the same bytes in place
        else:
            self.store.move(self.temporary, final)
        return {
            "file": self.name,
            "shard": self.shard,
            "part": self.part,
            "records": self.records,
            "bytes": self.size,
            "sha256": self.digest.hexdigest(),
        }


def _writer(folder: str, most: int, date: str):
    shape = pa.schema(
        [("file", pa.string()), ("shard", pa.int32()), ("part", pa.int32()), ("records", pa.int64()), ("bytes", pa.int64())]
        + [("sha256", pa.string())]
    )

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        roller, known = _Roller(folder, most, date), None
        for batch in batches:
            columns = [batch.column(c) for c in ("shard", "page_id", "digest", "refers_to", "url", "payload_bytes")]
            bodies, marks = batch.column("payload"), batch.column("mark").to_pylist()
            for i, (shard, page, digest, refers, url, size) in enumerate(zip(*[c.to_pylist() for c in columns], strict=True)):
                if marks[i]:  # says that the pages behind it, with this id and digest, are revisits
                    known = (page, digest, refers)
                    continue
                revisited = (known[2],) if known and known[:2] == (page, digest) else None
                member = _page(page, url, digest, size, bodies[i].as_py() if not revisited else b"", revisited, date)
                if done := roller.add(shard, member):
                    yield pa.RecordBatch.from_pylist([done], schema=shape)
        if roller.out:
            yield pa.RecordBatch.from_pylist([roller.close()], schema=shape)

    return write


def _key() -> Column:
    """Place of a page in the archive's order, as one struct of fixed width: page_id, null last, then digest."""
    return F.struct(F.col("page_id").isNull().cast("int").alias("no"), F.coalesce(F.col("page_id"), F.lit(0)).cast("bigint").alias("id"), "digest")


def _borders(narrow: DataFrame, shard_bytes: int) -> tuple[DataFrame, int]:
    """One row with the first key of each shard, ascending, and their number.

    Keys are laid out in order by ranges of their own, whatever the spread of the ids, and the bytes before each key are a sum over the ranges before
    and within its own. A shard begins where they pass a multiple of ``shard_bytes``: the same borders for any layout of the table. Only the bytes of
    one id and payload are not divided.
    """
    sizes = narrow.groupBy(_key().alias("k")).agg(F.sum(F.col("payload_bytes") + RECORD_BYTES).alias("n"))
    laid = pin(sizes.repartitionByRange("k").withColumn("part", F.spark_partition_id()))
    # One row for each range.
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = laid.groupBy("part").agg(F.sum("n").alias("n")).select("part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    inside = Window.partitionBy("part").orderBy("k").rowsBetween(Window.unboundedPreceding, -1)
    summed = laid.join(F.broadcast(before), "part").select("k", (F.col("before") + F.coalesce(F.sum("n").over(inside), F.lit(0))).alias("at"))
    firsts = summed.groupBy(F.floor(F.col("at") / shard_bytes)).agg(F.min("k").alias("k"))
    # As long as there are shards: some ten bytes for every ``shard_bytes``.
    borders = pin(firsts.agg(F.array_sort(F.collect_list("k")).alias("borders")))
    return borders, borders.select(F.size("borders")).first()[0]


def write_warc(
    pages: DataFrame,
    folder: str,
    shard_bytes: int = 256 << 20,
    file_bytes: int = 64 << 20,
    date: str = "2000-01-01T00:00:00Z",
) -> DataFrame:
    """Write one record per row of ``pages`` (page_id integer, url, html) below ``folder``, and return the manifest.

    The payload is the html in UTF-8, empty for null. Of the pages with equal payloads of at least 100 bytes, the one with the smallest
    page_id is a response and the others are revisits of it; smaller payloads are all responses. Rows that repeat the smallest
    page_id are responses as well, since a record cannot revisit itself; a null page_id comes last. A null url has no
    ``WARC-Target-URI``. Other columns are ignored. An empty table gives an empty manifest.

    ``shard_bytes`` is counted before compression, ``file_bytes`` after it; a very long page has a shard, and its payload stands in its task's memory, by itself. ``date`` goes to every record, so that reruns agree.
    """
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    narrow = pin(pages.select("page_id", F.sha2(payload, 256).alias("digest"), F.octet_length(payload).cast("bigint").alias("payload_bytes")))
    borders, shards = _borders(narrow, shard_bytes)
    firsts_of = borders.scalar()
    steps = F.array(*[F.lit(1 << b) for b in reversed(range(max(1, shards).bit_length()))])

    def placed(df: DataFrame) -> DataFrame:
        # Binary search: how many borders are not above the key.
        at = F.aggregate(steps, F.lit(0), lambda n, step: F.when(F.get(F.col("borders"), n + step - 1) <= F.col("k"), n + step).otherwise(n))
        return df.withColumns({"borders": firsts_of, "k": _key()}).withColumn("shard", at - 1).drop("borders", "k")

    # Only payloads that occur more than once, then only the pages that revisit.
    firsts = (
        narrow.filter(F.col("payload_bytes") >= SMALLEST_REVISITED)
        .groupBy("digest")
        .agg(F.min("page_id").alias("refers_to"), F.count("*").alias("n"))
        .filter("n > 1")
        .drop("n")
    )
    marks = (
        narrow.select("page_id", "digest")
        .distinct()
        .join(firsts, "digest")
        .filter(~F.col("page_id").eqNullSafe(F.col("refers_to")))
        .select("page_id", "digest", "refers_to", F.lit(True).alias("mark"))
    )
    records = pages.select(
        "page_id",
        F.sha2(payload, 256).alias("digest"),
        F.lit(False).alias("mark"),
        "url",
        payload.alias("payload"),
        F.octet_length(payload).cast("bigint").alias("payload_bytes"),
    )
    stream = (
        placed(records)
        .unionByName(placed(marks), allowMissingColumns=True)
        .repartitionById(max(1, min(shards, MOST_TASKS)), "shard")
        .sortWithinPartitions("shard", F.col("page_id").asc_nulls_last(), "digest", F.col("mark").desc(), "url")
    )
    manifest = stream.mapInArrow(_writer(folder, file_bytes, date), _MANIFEST)
    manifest.write.mode("overwrite").parquet(f"{folder}/manifest")
    delete(pages.sparkSession, f"{folder}/_temporary")  # what attempts that were lost have left
    return read_manifest(pages.sparkSession, folder)


# --- reading -----------------------------------------------------------------------------------------------------------


def read_manifest(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(_MANIFEST).parquet(f"{folder}/manifest")


def records_of(stream) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers, by lower-case name, and block of each record of a gzip stream, one at a time."""
    with gzip.GzipFile(fileobj=stream) as plain:
        while version := plain.readline():
            if not version.startswith(b"WARC/"):
                raise ValueError(f"no WARC record at {version[:40]!r}")
            headers = {}
            while (line := plain.readline().rstrip(b"\r\n")) != b"":
                name, _, value = line.partition(b":")
                headers[name.decode().lower()] = value.strip().decode()
            block = plain.read(int(headers["content-length"]))
            if plain.read(4) != b"\r\n\r\n":
                raise ValueError(f"record {headers.get('warc-record-id')} has no end")
            yield headers, block


def _reader(folder: str, with_payload: bool):
    names = ["page_id", "url", "record_id", "record_type", "payload_bytes", "payload_digest", "refers_to"]
    kinds = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64()]
    if with_payload:
        names, kinds = [*names, "payload"], [*kinds, pa.binary()]
    shape = pa.schema(list(zip(names, kinds, strict=True)))

    def row(headers: dict[str, str], block: bytes) -> tuple | None:
        kind = headers["warc-type"]
        if kind not in ("response", "revisit"):
            return None
        if headers["warc-block-digest"] != f"sha256:{hashlib.sha256(block).hexdigest()}":
            raise ValueError(f"block digest of {headers['warc-record-id']} does not match")
        digest, payload = headers["warc-payload-digest"].removeprefix("sha256:"), block.partition(b"\r\n\r\n")[2]
        size = len(payload) if kind == "response" else int(headers["x-payload-length"])
        if kind == "response" and hashlib.sha256(payload).hexdigest() != digest:
            raise ValueError(f"payload digest of {headers['warc-record-id']} does not match")
        number = lambda name: int(headers[name]) if name in headers else None
        ident, uri = headers["warc-record-id"], headers.get("warc-target-uri")
        fields = (number("x-page-id"), uri, ident, kind, size, digest, number("x-refers-to-page-id"))
        return (*fields, payload) if with_payload else fields

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = fs.FileSystem.from_uri(folder)
        held, size = [], 0
        for batch in batches:
            for name in batch.column("file").to_pylist():
                with store.open_input_stream(f"{root}/{name}", compression=None) as stream:
                    for headers, block in records_of(stream):
                        if (found := row(headers, block)) is None:
                            continue
                        held.append(found)
                        size += len(block) if with_payload else 200
                        if size > 4 << 20:
                            yield _batch(held, shape)
                            held, size = [], 0
        if held:
            yield _batch(held, shape)

    return read


def _batch(rows: list[tuple], shape: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), shape.types, strict=True)], schema=shape)


def read_warc(spark: SparkSession, folder: str, with_payload: bool = False) -> DataFrame:
    """Page records of the files in the manifest, one file per task at a time, digests checked while reading.

    Columns: page_id, url, record_id, record_type, payload_bytes, payload_digest, refers_to (page_id), and payload on demand,
    empty for revisits. A record that is cut or whose digest differs raises.
    """
    files = read_manifest(spark, folder).select("file")
    schema = _RECORD + (", payload binary" if with_payload else "")
    return files.repartition(max(1, files.count()), "file").mapInArrow(_reader(folder, with_payload), schema)
