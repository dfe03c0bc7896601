"""Upsert tables: what a save writes, who wins, and what two writers do to each other."""

import json
from concurrent.futures import ThreadPoolExecutor

import pytest

from reviewloom import files
from reviewloom.operators.upsert import upsert
from reviewloom.sources import upsert_table as ut


@pytest.fixture
def path(tmp_path):
    return str(tmp_path / "t")


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def numbers(spark, low, high, v):
    return spark.range(low, high).selectExpr("CAST(id AS STRING) AS id", f"'{v}' AS v")


def live_rows(spark, path, names):
    return sum(spark.read.parquet(f"{path}/_segment={n}").count() for n in names)


def test_old_rows_win_and_only_new_keys_are_written(spark, path):
    assert ut.save(numbers(spark, 0, 1000, "a"), path, "id")
    first = ut.version(spark, path)
    assert ut.save(numbers(spark, 990, 1010, "b"), path, "id")
    second = ut.version(spark, path)
    added = {s.name for s in second.segments} - {s.name for s in first.segments}
    assert set(first.segments) < set(second.segments) and live_rows(spark, path, added) == 10
    assert ut.read_current(spark, path).where("v = 'a'").count() == 1000
    # the version before is still there
    assert ut.read_current(spark, path, 1).count() == 1000


def test_new_rows_win_and_untouched_buckets_stay(spark, path):
    assert ut.save(numbers(spark, 0, 1000, "a"), path, "id")
    before = ut.version(spark, path).segments[0]
    assert ut.save(numbers(spark, 5, 8, "b"), path, "id", overwrite=True)
    old, new = ut.version(spark, path).segments
    assert old.name == before.name and set(old.buckets) | set(new.buckets) == set(before.buckets)
    assert not set(old.buckets) & set(new.buckets) and len(new.buckets) <= 3
    assert live_rows(spark, path, [new.name]) < 150
    found = dict(rows(ut.read_current(spark, path)))
    assert len(found) == 1000 and {k for k, v in found.items() if v == "b"} == {"5", "6", "7"}


@pytest.mark.parametrize("overwrite", [True, False])
def test_saves_equal_the_operator(spark, path, overwrite):
    steps = [
        spark.createDataFrame([(1, "a"), (2, "b"), (2, "c"), (None, "n")], "k long, v string"),
        spark.createDataFrame([("2", 5), ("3", 6), (None, 7), ("3", 8)], "k string, w int"),
        spark.createDataFrame([("1", "x", 2.5), ("9", None, None)], "k string, v string, z double"),
        spark.createDataFrame([("9", 1 << 40)], "k string, w long"),
    ]
    want = steps[0]
    for k, step in enumerate(steps):
        assert ut.save(step, path, "k", overwrite, buckets=4)
        want = upsert(want, step, "k", overwrite) if k else want
        found = ut.read_current(spark, path)
        assert found.columns == want.columns and [f.dataType for f in found.schema] == [f.dataType for f in want.schema]
        assert rows(found) == rows(want)
    assert ut.compact(spark, path) and not ut.compact(spark, path)
    assert rows(ut.read_current(spark, path)) == rows(want) and len(ut.version(spark, path).segments) == 1


def test_many_segments_are_merged(spark, path, monkeypatch):
    monkeypatch.setattr(ut, "MAX_SEGMENTS", 3)
    for k in range(6):
        assert ut.save(numbers(spark, 10 * k, 10 * k + 12, str(k)), path, "id", buckets=3)
        assert len(ut.version(spark, path).segments) <= 3
    assert ut.read_current(spark, path).count() == 62


def test_guards(spark, path):
    some = numbers(spark, 0, 3, "a")
    assert not ut.save(some, path, None) and not ut.save(some, path, "other") and not ut.save(some.limit(0), path, "id")
    assert ut.read_current(spark, path) is None
    assert ut.save(some.limit(0), path, "id", write_empty=True)
    assert ut.read_current(spark, path).columns == ["id", "v"] and ut.read_current(spark, path).count() == 0
    # into an empty table the rows go as they are
    assert ut.save(spark.range(2), path, "id") and dict(ut.read_current(spark, path).dtypes) == {"id": "bigint"}
    assert not ut.save(some.limit(0), path, "id") and not ut.save(spark.range(1).toDF("k"), path, "k")
    with pytest.raises(ValueError):
        ut.save(spark.createDataFrame([(7, "w")], "id long, v string"), f"{path}2", "id") and ut.save(some, f"{path}2", "v")


def test_a_name_is_published_once(spark, path):
    with ThreadPoolExecutor(8) as pool:
        taken = list(pool.map(lambda k: files.publish(spark, f"{path}/n.json", json.dumps(k)), range(16)))
    assert taken.count(True) == 1
    assert json.loads(files.read_text(spark, f"{path}/n.json")) == taken.index(True)
    assert {n for n in files.list_names(spark, path) if not n.endswith(".crc")} == {"n.json"}


@pytest.mark.parametrize("overwrite", [True, False])
def test_the_second_writer_starts_from_the_first_ones_rows(spark, path, monkeypatch, overwrite):
    assert ut.save(numbers(spark, 0, 10, "a"), path, "id")
    plain, between = ut.publish, []

    def late(session, name, text):
        if not between:
            between.append(True)
            assert ut.save(numbers(spark, 8, 12, "b"), path, "id", overwrite)
        return plain(session, name, text)

    monkeypatch.setattr(ut, "publish", late)
    assert ut.save(numbers(spark, 11, 14, "c"), path, "id", overwrite)
    assert ut.versions(spark, path) == [1, 2, 3]
    want = upsert(upsert(numbers(spark, 0, 10, "a"), numbers(spark, 8, 12, "b"), "id", overwrite), numbers(spark, 11, 14, "c"), "id", overwrite)
    assert rows(ut.read_current(spark, path)) == rows(want)
    # nothing is left of the attempt that lost
    named = {f"_segment={s.name}" for n in (1, 2, 3) for s in ut.version(spark, path, n).segments}
    assert {n for n in files.list_names(spark, path) if n.startswith("_segment=")} == named


def test_writers_at_once_lose_no_rows(spark, path):
    with ThreadPoolExecutor(4) as pool:
        saved = list(pool.map(lambda k: ut.save(numbers(spark, 100 * k, 100 * k + 100, str(k)), path, "id"), range(4)))
    assert all(saved) and ut.versions(spark, path) == [1, 2, 3, 4]
    assert dict(rows(ut.read_current(spark, path).groupBy("v").count())) == {str(k): 100 for k in range(4)}


def test_old_versions_can_go(spark, path):
    for k in range(4):
        ut.save(numbers(spark, 0, 5 + k, str(k)), path, "id", overwrite=True)
    ut.forget_versions(spark, path, keep=1)
    assert ut.versions(spark, path) == [4] and ut.read_current(spark, path).count() == 8
    named = {f"_segment={s.name}" for s in ut.version(spark, path).segments}
    assert {n for n in files.list_names(spark, path) if n.startswith("_segment=")} == named
