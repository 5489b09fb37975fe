import os

import pytest
from pyspark.sql import functions as F

from obsmatch.operators.upsert import counts, next_state, plan
from obsmatch.plans import jobs
from obsmatch.sources import sinks
from obsmatch.sources.sinks import Conflict, VersionedTable, merge_into, merge_partitions

SCHEMA = "k string, v double"


def files(path):
    return sorted(os.listdir(path.removeprefix("file:")))


def df(spark, rows, schema=SCHEMA):
    return spark.createDataFrame(rows, schema)


def state(table):
    return sorted(map(tuple, table.read().collect()), key=repr)


def test_an_abandoned_version_is_neither_read_nor_written_again(spark, tmp_root):
    t = VersionedTable(spark, tmp_root, ["k"])
    merge_into(t, df(spark, [("a", 1.0)]), ["k"], ["v"])
    left = t.stage()  # a job that died before it published, leaving a partition behind
    df(spark, [("zombie", 9.0)]).write.partitionBy("k").parquet(f"{tmp_root}/{left}")
    assert t.version() == 0 and [r["k"] for r in t.read().collect()] == ["a"]
    merge_into(t, df(spark, [("b", 2.0)]), ["k"], ["v"])
    assert t.version() == 1 and sorted(r["k"] for r in t.read().collect()) == ["a", "b"]
    assert "k=zombie" in files(f"{tmp_root}/{left}")


def test_only_one_of_two_writers_of_a_version_publishes(spark, tmp_root):
    a, b = VersionedTable(spark, tmp_root), VersionedTable(spark, tmp_root)
    assert a.replace(df(spark, [("a", 1.0)]), base=None) == 0
    with pytest.raises(Conflict):
        b.replace(df(spark, [("b", 2.0)]), base=None)
    assert a.replace(df(spark, [("c", 3.0)]), {"x": 4}, base=0) == 1 and a.sources() == {"x": 4}
    with pytest.raises(Conflict):
        b.replace(df(spark, [("d", 4.0)]), base=0)
    assert b.replace(df(spark, [("e", 5.0)])) == 2  # SNK-4 without a base: the last writer wins
    assert state(a) == [("e", 5.0)] and sorted(files(tmp_root)) == ["_v=0", "_v=1", "_v=2"]


def test_the_folder_that_loses_a_race_after_its_check_is_not_read(spark, tmp_root, monkeypatch):
    """Both writers see the name free; the second rename finds a folder there and must not touch its rows."""
    a, b = VersionedTable(spark, tmp_root), VersionedTable(spark, tmp_root)
    a.replace(df(spark, [("a", 1.0)]), base=None)
    real = sinks._FS.exists
    monkeypatch.setattr(sinks._FS, "exists", lambda self, name: False if name == "_v=1" and self is b._fs else real(self, name))
    a.replace(df(spark, [("a", 2.0)]), base=0)
    with pytest.raises(Conflict):
        b.replace(df(spark, [("b", 2.0)]), base=0)
    assert state(a) == [("a", 2.0)] and not [n for n in files(f"{tmp_root}/_v=1") if n.startswith("_new")]


@pytest.mark.parametrize("step", ["version", "stage", "publish"])
@pytest.mark.parametrize("first", [True, False])
def test_two_merges_that_interleave_at_any_step_keep_both_rows(spark, tmp_root, monkeypatch, step, first):
    t = VersionedTable(spark, tmp_root)
    if not first:
        merge_into(t, df(spark, [("zero", 0.0)]), ["k"], ["v"])
    real, done = getattr(VersionedTable, step), []

    def other_merge(self, *args):
        out = real(self, *args) if step == "version" else None
        if not done:
            done.append(1)
            merge_into(VersionedTable(spark, tmp_root), df(spark, [("two", 2.0), ("one", 5.0)]), ["k"], ["v"])
        return out if step == "version" else real(self, *args)

    monkeypatch.setattr(VersionedTable, step, other_merge)
    found = merge_into(t, df(spark, [("one", 1.0)]), ["k"], ["v"])
    monkeypatch.setattr(VersionedTable, step, real)
    assert found["updated"] == 1 and found["inserted"] == 0
    assert state(t) == [("one", 1.0), ("two", 2.0)] + ([] if first else [("zero", 0.0)])
    assert t.changes(t.version() - 1, t.version()).collect() == [("one", 1.0)]


def test_changes_between_versions(spark, tmp_root):
    t = VersionedTable(spark, tmp_root)
    for batch in ([("a", 1.0), ("b", 1.0)], [("a", 2.0), ("c", 1.0)], [("b", 1.0), ("c", 3.0), (None, 1.0)]):
        merge_into(t, df(spark, batch), ["k"], ["v"])
    assert t.read().columns == ["k", "v"]
    rows = lambda x: sorted(map(tuple, x.collect()), key=repr)
    assert rows(t.changes(0, 1)) == [("a", 2.0), ("c", 1.0)]
    assert rows(t.changes(0, 2)) == sorted([("a", 2.0), ("c", 1.0), ("c", 3.0), (None, 1.0)], key=repr)
    t.vacuum(keep=1)
    assert t.changes(0, 2) is None and t.versions() == [2] and t.version() == 2
    with pytest.raises(Conflict):  # the name of a deleted version stays taken
        t.replace(df(spark, []), base=0)
    t.replace(df(spark, [("z", 1.0)]))
    assert t.changes(2, 3) is None


def test_replay_writes_nothing(spark, tmp_root):
    t = VersionedTable(spark, tmp_root)
    rows = df(spark, [("a", 1.0), ("b", None)])
    merge_into(t, rows, ["k"], ["v"])
    before = files(tmp_root)
    assert merge_into(t, rows, ["k"], ["v"])["affected"] == 0
    assert files(tmp_root) == before
    t.replace(rows), t.replace(rows)
    t.vacuum(keep=2)
    assert len(t.versions()) == 2 and t.read().count() == 2


def test_only_updating_rows_count_against_a_target_row(spark):
    t = df(spark, [("a", 1.0), ("b", 1.0), ("c", 1.0), ("d", None)])
    s = df(spark, [("a", 1.0), ("a", 2.0), ("a", 1.0), ("b", 1.0), ("b", 1.0), ("d", None), ("d", 4.0), ("e", 5.0), ("e", 5.0), ("e", 6.0), (None, 1.0), (None, 1.0)])
    p = plan(t, s, ["k"], ["v"])
    got = sorted(map(tuple, next_state(p, ["k", "v"]).collect()), key=repr)
    assert got == sorted([("a", 2.0), ("b", 1.0), ("c", 1.0), ("d", 4.0), ("e", 5.0), ("e", 5.0), ("e", 6.0), (None, 1.0), (None, 1.0)], key=repr)
    assert counts(p, ["k"]).first().asDict() == {"inserted": 5, "updated": 2, "unchanged": 1, "untouched": 1, "affected": 7, "null_key_rows": 2}
    for bad in ([("a", 2.0), ("a", 2.0)], [("a", 1.0), ("a", 2.0), ("a", 3.0)], [("a", 2.0), ("a", 3.0)]):
        with pytest.raises(Exception, match="several updating"):
            next_state(plan(t, df(spark, bad), ["k"], ["v"]), ["k", "v"]).collect()


def test_null_partitions_survive_and_null_keys_are_counted(spark, tmp_root):
    schema = "k string, v double, p string, q int"
    first = df(spark, [("a", 1.0, None, 1), ("b", 1.0, "x", None), ("c", 1.0, "y", 2), (None, 1.0, "y", 2)], schema)
    args = (["k"], ["v"], ["p", "q"])
    assert merge_partitions(spark, tmp_root, first, *args)["null_key_rows"] == 1
    second = df(spark, [("d", 2.0, None, 1), ("b", 3.0, "x", None)], schema)
    found = merge_partitions(spark, tmp_root, second, *args)
    assert (found["inserted"], found["updated"], found["untouched"]) == (1, 1, 1)
    got = {(r["k"], r["v"], r["p"]) for r in spark.read.parquet(tmp_root).collect()}
    assert got == {("a", 1.0, None), ("d", 2.0, None), ("b", 3.0, "x"), ("c", 1.0, "y"), (None, 1.0, "y")}


def test_only_touched_partitions_are_written(spark, tmp_root):
    schema = "k string, v double, p string"
    merge_partitions(spark, tmp_root, df(spark, [("a", 1.0, "x"), ("b", 1.0, "y")], schema), ["k"], ["v"], ["p"])
    before = {p: files(f"{tmp_root}/p={p}") for p in "xy"}
    merge_partitions(spark, tmp_root, df(spark, [("a", 2.0, "x")], schema), ["k"], ["v"], ["p"])
    assert files(f"{tmp_root}/p=y") == before["y"] and files(f"{tmp_root}/p=x") != before["x"]


def _tables(spark):
    a = spark.sql("SELECT 'a1' AS accident_id, timestamp'2024-01-01 10:10:00' AS accident_timestamp, 48.0D AS latitude, 2.0D AS longitude")
    from obsmatch.schemas import ACCIDENT_COLUMNS, WEATHER_COLUMNS

    a = a.select(*[c if c in a.columns else F.lit("75").alias(c) for c in ACCIDENT_COLUMNS])
    w = spark.sql(
        "SELECT 's' AS station_id, 'S' AS station_name, 48.0D AS latitude, 2.0D AS longitude,"
        " timestamp'2024-01-01 10:00:00' AS observation_timestamp"
    )
    w = w.select(*[c if c in w.columns else F.lit(1.0).alias(c) for c in WEATHER_COLUMNS])
    return a, w


@pytest.mark.parametrize("dies_in", ["accidents", "weather", "gold"])
def test_a_rerun_heals_a_crash_at_every_step(spark, tmp_root, monkeypatch, dies_in):
    a, w = _tables(spark)
    paths = [f"{tmp_root}/{n}" for n in ("accidents", "weather", "gold")]
    assert jobs.load_and_build_gold(spark, a, w, *paths)["gold"] == "rebuilt"
    more = a.withColumn("accident_id", F.lit("a2")).unionByName(a)
    real = VersionedTable.publish

    def publish(self, staged, base, sources=None):
        if self.root.endswith(dies_in):
            raise SystemError("died")
        return real(self, staged, base, sources)

    changed_w = w.withColumn("station_name", F.lit("T"))
    monkeypatch.setattr(sinks.VersionedTable, "publish", publish)
    with pytest.raises(SystemError):
        jobs.load_and_build_gold(spark, more, changed_w, *paths)
    monkeypatch.setattr(sinks.VersionedTable, "publish", real)
    healed = jobs.load_and_build_gold(spark, more, changed_w, *paths)
    assert healed["gold"] in ("rebuilt", "refreshed")
    clean = [f"{tmp_root}/clean_{n}" for n in ("accidents", "weather", "gold")]
    jobs.load_and_build_gold(spark, a, w, *clean)
    jobs.load_and_build_gold(spark, more, changed_w, *clean)
    for p, q in zip(paths, clean):
        assert state(VersionedTable(spark, p)) == state(VersionedTable(spark, q))
    assert jobs.load_and_build_gold(spark, more, changed_w, *paths)["gold"] == "unchanged"
