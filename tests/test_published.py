import os
import threading

import pytest

from brevita.sources import published
from brevita.sources import records as store

SCHEMA = "split string, instruction string, input string, output string"


def rows(spark, n, splits=("train", "val", "test"), tag=""):
    made = [(splits[i % len(splits)], "do", f"{tag}text {i}", None if i % 7 == 0 else f"summary {i}") for i in range(n)]
    return spark.createDataFrame(made, SCHEMA).repartition(3)


def tree(folder):
    return sorted((os.path.join(d, f), os.stat(os.path.join(d, f)).st_mtime_ns) for d, _, files in os.walk(folder) for f in files)


def read(spark, path, number=None):
    return sorted(map(str, published.read_published(spark, path, number).collect()))


def named(df):
    names = store.PUBLISHED_NAMES
    return sorted(str(r.__class__(**(r.asDict() | {"split": names[r.split]}))) for r in df.collect())


def test_versions_stay_readable_and_a_repeat_writes_nothing(spark, tmp_path):
    path = str(tmp_path / "p")
    assert published.newest_version(spark, path) is None and not published.published_complete(spark, path)
    first = published.publish_version(rows(spark, 30), path)
    assert (first.number, first.wrote_files, first.wrote_pointer) == (1, True, True)
    assert first.rows == {"train": 10, "validation": 10, "test": 10}
    before = tree(path)
    # The same rows in other files and another order.
    again = published.publish_version(rows(spark, 30).repartition(5, "input"), path)
    assert (again.number, again.wrote_files, again.wrote_pointer) == (1, False, False) and tree(path) == before
    second = published.publish_version(rows(spark, 12, tag="new "), path)
    assert second.number == 2 and second.digest != first.digest
    # Back to the first contents: a new number, no new files.
    third = published.publish_version(rows(spark, 30), path)
    assert (third.number, third.digest, third.wrote_files, third.wrote_pointer) == (3, first.digest, False, True)
    assert read(spark, path) == read(spark, path, 1) != read(spark, path, 2)
    assert [(v.number, v.digest) for v in published.history(spark, path)] == [(1, first.digest), (2, second.digest), (3, first.digest)]
    assert published.forget_versions(spark, path, keep=1) == [1, 2]
    assert [v.number for v in published.history(spark, path)] == [3] and len(read(spark, path)) == 30
    assert os.listdir(f"{path}/contents") == [first.digest]
    # A number is never given twice.
    assert published.publish_version(rows(spark, 3), path).number == 4


def test_rows_repeat_and_null_fields_stay(spark, tmp_path):
    path = str(tmp_path / "p")
    df = rows(spark, 9).unionByName(rows(spark, 9))
    once, twice = (published.contents(x)[0] for x in (rows(spark, 9), df))
    assert once != twice
    published.publish_version(df, path)
    assert read(spark, path) == named(df.select(*published.read_published(spark, path).columns))


def test_a_split_without_rows_is_complete(spark, tmp_path):
    calls = []

    def build():
        calls.append(1)
        return rows(spark, 10, splits=("train", "test"))

    path = str(tmp_path / "p")
    df, held = published.ensure_published(spark, path, build)
    assert held.rows["validation"] == 0 and df.count() == 10
    _, again = published.ensure_published(spark, path, build)
    assert len(calls) == 1 and not again.wrote_pointer
    published.ensure_published(spark, path, build, force=True)
    assert len(calls) == 2 and published.newest_version(spark, path).number == 1
    nothing = published.publish_version(rows(spark, 10).limit(0), path)
    assert set(nothing.rows.values()) == {0} and read(spark, path) == []
    assert published.read_published(spark, path).columns == SCHEMA.replace(" string", "").split(", ")
    # The unversioned splits, too.
    local = str(tmp_path / "local")
    assert [store.ensure_splits(spark, local, build)[1] for _ in range(2)] == [True, False]


def test_a_reader_during_a_publish_sees_the_old_or_the_new_version(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "p")
    published.publish_version(rows(spark, 6), path)
    old, seen, renamed = read(spark, path), [], published._renamed

    def watched(spark_, source, target):
        seen.append(read(spark, path))
        done = renamed(spark_, source, target)
        seen.append(read(spark, path))
        return done

    monkeypatch.setattr(published, "_renamed", watched)
    # A DataFrame that is read late still has the files it was made from.
    open_ = published.read_published(spark, path)
    published.publish_version(rows(spark, 9, tag="x"), path)
    new = read(spark, path)
    assert seen == [old, old, old, new] and old != new
    assert sorted(map(str, open_.collect())) == old


def test_a_publisher_that_dies_leaves_the_old_version(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "p")
    published.publish_version(rows(spark, 6), path)
    old, point = read(spark, path), published._point

    def killed(*_):
        raise RuntimeError("killed")

    monkeypatch.setattr(published, "_point", killed)
    with pytest.raises(RuntimeError, match="killed"):
        published.publish_version(rows(spark, 9, tag="x"), path)
    assert read(spark, path) == old
    monkeypatch.setattr(published, "_point", point)
    again = published.publish_version(rows(spark, 9, tag="x"), path)
    assert (again.number, again.wrote_files, again.wrote_pointer) == (2, False, True)
    with pytest.raises(FileNotFoundError):
        published.read_published(spark, str(tmp_path / "absent"))
    with pytest.raises(ValueError, match="has to stay"):
        published.forget_versions(spark, path, 0)


def test_two_publishers_at_a_time(spark, tmp_path):
    path, found = str(tmp_path / "p"), []
    parts = [rows(spark, 6, tag=f"{i % 2}") for i in range(4)]
    threads = [threading.Thread(target=lambda p=p: found.append(published.publish_version(p, path))) for p in parts]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert len(found) == 4 and len({v.digest for v in found}) == 2
    held = published.history(spark, path)
    assert [v.number for v in held] == list(range(1, len(held) + 1)) and {v.digest for v in held} == {v.digest for v in found}
    assert len(os.listdir(f"{path}/contents")) == 2 and len(read(spark, path)) == 6
