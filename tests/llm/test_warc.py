import gzip
import hashlib

import pytest
from pyspark.errors import PythonException

from brevita.llm import warc

BIG = "<p>" + "payload " * 40
ROWS = [
    (5, "http://a/1", BIG),
    (3, "http://a/2", BIG),
    (3, "http://a/2", BIG),
    (9, None, BIG + "é"),
    (None, "http://a/3", BIG),
    (None, "http://a/3", BIG),
    (11, "http://a/x\r\nWARC-Type: fake", None),
    (12, "", ""),
    (13, "u", "short"),
    (14, "u", "short"),
    (15, "u", "x" * 100),
    (16, "u", "x" * 100),
    (17, "u", "x" * 99),
    (18, "u", "x" * 99),
    (-7, "u", "a\r\n\r\nb\x00" * 50),
    (2**40, "u", "far " * 100_000),
]


def expected(rows):
    first = {}
    for page, _, html in rows:
        data = (html or "").encode()
        if page is not None and len(data) >= 100:
            first[data] = min(page, first.get(data, page))
    out = []
    for page, _, html in rows:
        data = (html or "").encode()
        refers = first.get(data)
        revisit = refers is not None and page != refers
        out.append((page, len(data), hashlib.sha256(data).hexdigest(), "revisit" if revisit else "response", refers if revisit else None))
    return sorted(map(str, out))


def pages(spark, rows):
    return spark.createDataFrame([(*r, 1) for r in rows], "page_id bigint, url string, html string, shard int")


def read(spark, folder):
    got = warc.read_warc(spark, folder).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    return sorted(str(tuple(r)) for r in got.collect())


@pytest.mark.parametrize("sizes", [{}, {"shard_bytes": 1000, "file_bytes": 500}])
def test_round_trip(spark, tmp_path, sizes):
    folder = f"file://{tmp_path}/w"
    warc.write_warc(pages(spark, ROWS), folder, **sizes)
    assert read(spark, folder) == expected(ROWS)
    payloads = {(r.page_id, bytes(r.payload)) for r in warc.read_warc(spark, folder, True).filter("record_type = 'response'").collect()}
    assert {(p, (h or "").encode()) for p, _, h in ROWS if p in (3, 9, 11, -7, 2**40)} <= payloads
    manifest = warc.read_manifest(spark, folder).collect()
    assert sum(r.records for r in manifest) == len(ROWS)
    for r in manifest:
        data = (tmp_path / "w" / r.file).read_bytes()
        assert len(data) == r.bytes and hashlib.sha256(data).hexdigest() == r.sha256
        assert gzip.decompress(data).startswith(b"WARC/1.1\r\nWARC-Type: warcinfo")


def test_same_bytes_in_every_run_and_sorted(spark, tmp_path):
    found = []
    for name, df in (("a", pages(spark, ROWS)), ("b", pages(spark, ROWS[::-1]).repartition(5))):
        warc.write_warc(df, f"file://{tmp_path}/{name}", shard_bytes=2000, file_bytes=400)
        manifest = warc.read_manifest(spark, f"file://{tmp_path}/{name}").orderBy("shard", "part").collect()
        found.append([tuple(r) for r in manifest])
        ids = []
        for r in manifest:
            with (tmp_path / name / r.file).open("rb") as stream:
                ids += [h.get("x-page-id") for h, _ in warc.records_of(stream) if h["warc-type"] != "warcinfo"]
        assert ids == sorted(ids, key=lambda x: (x is None, int(x or 0)))
        assert not (tmp_path / name / "_temporary").exists()
    assert found[0] == found[1] and len(found[0]) > 3


def test_hot_null_id_is_dealt_over_shards(spark, tmp_path):
    df = spark.range(600).selectExpr("if(id % 3 = 0, null, id) as page_id", "'u' as url", "repeat(cast(id as string), 200) as html")
    manifest = warc.write_warc(df, f"file://{tmp_path}/w", shard_bytes=20_000)
    assert manifest.agg({"records": "max"}).first()[0] < 100
    assert warc.read_warc(spark, f"file://{tmp_path}/w").count() == 600


def test_empty_table_and_damage(spark, tmp_path):
    folder = f"file://{tmp_path}/w"
    assert warc.write_warc(pages(spark, []), folder).count() == 0
    assert read(spark, folder) == []
    warc.write_warc(pages(spark, ROWS[:4]), f"{folder}2")
    file = tmp_path / "w2" / warc.read_manifest(spark, f"{folder}2").first().file
    text = gzip.decompress(file.read_bytes())
    file.write_bytes(gzip.compress(text.replace(b"payload payload", b"payload PAYLOAD")))
    with pytest.raises(PythonException, match="does not match"):
        read(spark, f"{folder}2")


def test_one_outlying_id_leaves_the_shards_even(spark, tmp_path):
    rows = [(i, "u", f"{i} " * 100) for i in range(400)] + [(2**62, "u", "far"), (-(2**62), "u", "near")]
    folder = f"file://{tmp_path}/w"
    manifest = warc.write_warc(pages(spark, rows).repartition(3), folder, shard_bytes=20_000).collect()
    assert max(r.records for r in manifest) < 25 and len({r.shard for r in manifest}) > 15
    assert read(spark, folder) == expected(rows)


def test_thousands_of_shards(spark, tmp_path, monkeypatch):
    """A shard for almost every page; tasks write several. The bound on a shard holds at any number."""
    monkeypatch.setattr(warc, "MOST_TASKS", 8)
    df = spark.range(4500).selectExpr("id * id as page_id", "'u' as url", "repeat(cast(id as string), 60) as html")
    manifest = warc.write_warc(df, f"file://{tmp_path}/w", shard_bytes=700).collect()
    assert len({r.shard for r in manifest}) > 4096 and max(r.records for r in manifest) <= 2
    assert sorted({r.shard for r in manifest}) == list(range(len({r.shard for r in manifest})))
    assert warc.read_warc(spark, f"file://{tmp_path}/w").count() == 4500


def test_an_attempt_that_comes_second_leaves_the_file_in_place(tmp_path):
    for attempt in range(2):
        roller = warc._Roller(f"file://{tmp_path}", 1 << 20, "2000-01-01T00:00:00Z")
        roller.add(0, warc._page(1, "u", "d", 3, b"abc", None, "2000-01-01T00:00:00Z"))
        made = roller.close()
        at = (tmp_path / made["file"]).stat().st_ino
        assert attempt == 0 or at == first
        first = at
    (tmp_path / made["file"]).write_bytes(b"other")
    roller = warc._Roller(f"file://{tmp_path}", 1 << 20, "2000-01-01T00:00:00Z")
    roller.add(0, warc._page(1, "u", "d", 3, b"abc", None, "2000-01-01T00:00:00Z"))
    assert hashlib.sha256((tmp_path / roller.close()["file"]).read_bytes()).hexdigest() == made["sha256"]
