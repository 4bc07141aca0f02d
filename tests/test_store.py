"""Commits of several tables at once, keyed tables that merge when read, retention by folder."""

import random
from datetime import datetime, timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from seqloom.sources import tables
from seqloom.sources.store import Keyed, Store

ROW = "k int, v string, at int"


def files_of(path):
    return sorted(str(p) for p in Path(path).rglob("*.parquet"))


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_upserts_against_a_dictionary(spark, tmp_path):
    rng = random.Random(1)
    store = Store(spark, str(tmp_path / "s"), {"t": Keyed(("k",), buckets=8)})
    want = {}
    for step in range(9):
        change = [(rng.choice([None, *range(30)]), f"v{step}", step) for _ in range(rng.randrange(1, 20))]
        own = {}
        for k, v, at in change:
            own[k] = max(own.get(k, (v, at)), (v, at))
        store.commit({"t": spark.createDataFrame(change, ROW)})
        want |= own
        if step in (3, 6):
            store.compact("t")
    assert rows(store.read("t")) == sorted([(k, *v) for k, v in want.items()], key=str)
    for k in (3, None, 77):
        assert rows(store.lookup("t", k=k)) == [(i, *v) for i, v in want.items() if i == k]


def test_one_row_writes_one_small_file(spark, tmp_path):
    store = Store(spark, str(tmp_path), {"t": Keyed(("k",), buckets=8)})
    store.commit({"t": spark.range(10_000).selectExpr("CAST(id AS int) k", "'x' v", "0 at")})
    store.compact()
    before = set(files_of(tmp_path))
    store.commit({"t": spark.createDataFrame([(5, "new", 1)], ROW)})
    added = set(files_of(tmp_path)) - before
    assert len(added) == 1 and Path(next(iter(added))).stat().st_size < 2000
    assert store.lookup("t", k=5).first().v == "new"
    store.compact()  # one bucket is written again, the others stay
    base = store.state()["tables"]["t"]["base"]
    assert len({p.split("/")[0] for p in base.values()}) == 2 and len(base) == 8
    assert store.read("t").count() == 10_000 and store.read("t").filter("v = 'new'").count() == 1


def test_order_decides_whatever_arrives_when_and_least_values_stay(spark, tmp_path):
    store = Store(spark, str(tmp_path), {"t": Keyed(("k",), ("at",), ("v",), buckets=2)})
    for v, at in (("b", 5), ("c", 9), ("a", 1), ("z", 7)):
        store.commit({"t": spark.createDataFrame([(1, v, at)], ROW)})
        store.compact()
    assert rows(store.read("t")) == [(1, "a", 9)]


def test_a_crash_between_two_tables_shows_neither(spark, tmp_path):
    store = Store(spark, str(tmp_path), {"t": Keyed(("k",))})
    one = spark.createDataFrame([(1, "a", 0)], ROW)
    store.commit({"t": one, "log": one}, "job", 0)
    lost = spark.createDataFrame([(2, "b", 0)], ROW).select("k", F.raise_error(F.lit("lost")).cast("string").alias("v"), "at")
    with pytest.raises(Exception, match="lost"):
        store.commit({"t": spark.createDataFrame([(1, "new", 0)], ROW), "log": lost}, "job", 1)
    assert rows(store.read("t")) == rows(store.read("log")) == [(1, "a", 0)]
    assert not store.is_committed("job", 1)
    again = {"t": spark.createDataFrame([(1, "new", 0)], ROW), "log": spark.createDataFrame([(2, "b", 0)], ROW)}
    assert store.commit(again, "job", 1) and not store.commit(again, "job", 1)
    assert rows(store.read("t")) == [(1, "new", 0)] and store.read("log").count() == 2


def test_readers_keep_what_they_started_on(spark, tmp_path):
    store = Store(spark, str(tmp_path), {"t": Keyed(("k",), buckets=4)})
    store.commit({"t": spark.range(100).selectExpr("CAST(id AS int) k", "'old' v", "0 at")})
    before, number = store.read("t"), store.state()["number"]
    store.commit({"t": spark.range(100).selectExpr("CAST(id AS int) k", "'new' v", "0 at")})
    store.compact()
    assert store.vacuum() == 0
    assert {r.v for r in before.collect()} == {"old"} == {r.v for r in store.read("t", number).collect()}
    assert {r.v for r in store.read("t").collect()} == {"new"}
    assert store.vacuum(keep=1, older_than_s=0) == 2
    assert store.read("t").count() == 100


def test_a_marker_that_is_taken_is_not_overwritten(spark, tmp_path):
    mine, other = Store(spark, str(tmp_path)), Store(spark, str(tmp_path))
    kept = mine.state

    def late(*a):
        found = kept(*a)
        if not other._numbers():
            other.commit({"log": spark.createDataFrame([(2, "b", 0)], ROW)})
        return found

    mine.state = late
    mine.commit({"log": spark.createDataFrame([(1, "a", 0)], ROW)})
    assert mine.read("log").count() == 2


def test_new_columns_join_and_kinds_stay(spark, tmp_path):
    store = Store(spark, str(tmp_path), {"t": Keyed(("k",))})
    store.commit({"t": spark.createDataFrame([(1, "a", 0)], ROW)})
    store.commit({"t": spark.createDataFrame([(2, "b", 0, 1.5)], ROW + ", more double")})
    assert rows(store.read("t")) == [(1, "a", 0, None), (2, "b", 0, 1.5)]
    with pytest.raises(ValueError, match="at was int"):
        store.commit({"t": spark.createDataFrame([(2, "b", "x")], "k int, v string, at string")})


def test_days_go_by_name(spark, tmp_path):
    now = datetime(2024, 5, 10, 12)
    data = spark.createDataFrame([(i, now - timedelta(days=i)) for i in range(60)], "id int, ts timestamp")
    tables.write_by_day(data, str(tmp_path / "t"), "ts")
    for f in files_of(tmp_path):  # nothing may be read
        Path(f).write_bytes(b"")
    gone = tables.drop_days(spark, str(tmp_path / "t"), 30, now)
    left = sorted(p.name for p in (tmp_path / "t").glob("day=*"))
    assert len(gone) + len(left) == 60 and gone == sorted(gone) and gone[-1] < left[0]
    assert left[0] == "day=2024-04-10"
    assert tables.drop_days(spark, str(tmp_path / "t"), 30, now) == []
