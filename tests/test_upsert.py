import pytest

from obsmatch.operators.upsert import counts, next_state, plan, upsert
from obsmatch.sources.sinks import VersionedTable, merge_into

SCHEMA = "k string, v double"


def df(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def test_actions_and_null_semantics(spark):
    t = df(spark, [("a", None), ("b", 1.0), ("c", float("nan")), ("d", 1.0), ("e", 5.0)])
    s = df(spark, [("a", 1.0), ("b", None), ("c", float("nan")), ("d", 1.0), ("f", 2.0), (None, 3.0)])
    p = plan(t, s, ["k"], ["v"])
    acts = {r["t_k"] or r["s_k"]: r["_action"] for r in p.collect()}
    assert acts == {"a": "update", "b": "update", "c": "unchanged", "d": "unchanged", "e": "untouched", "f": "insert", None: "insert"}
    c = counts(p, ["k"]).first().asDict()
    assert c == {"inserted": 2, "updated": 2, "unchanged": 2, "untouched": 1, "affected": 4, "null_key_rows": 1}


def test_replay_is_idempotent_except_null_keys(spark):
    t = df(spark, [("a", 1.0)])
    s = df(spark, [("a", 2.0), ("b", 3.0), (None, 4.0)])
    once = next_state(plan(t, s, ["k"], ["v"]), ["k", "v"])
    again = counts(plan(once, s, ["k"], ["v"]), ["k"]).first()
    assert (again["affected"], again["null_key_rows"]) == (1, 1)


def test_duplicate_updating_source_rows_raise(spark):
    t = df(spark, [("a", 1.0)])
    s = df(spark, [("a", 2.0), ("a", 3.0)])
    with pytest.raises(Exception, match="several updating"):
        next_state(plan(t, s, ["k"], ["v"]), ["k", "v"]).collect()


def test_duplicate_equal_source_rows_keep_target_once(spark):
    t = df(spark, [("a", 1.0)])
    s = df(spark, [("a", 1.0), ("a", 1.0)])
    assert next_state(plan(t, s, ["k"], ["v"]), ["k", "v"]).count() == 1


def test_first_load_copies_without_dedupe(spark):
    state, c = upsert(None, df(spark, [("a", 1.0), ("a", 1.0)]), ["k"], ["v"])
    assert state.count() == 2 and c.first()["inserted"] == 2


def test_versioned_merge_two_batches_and_replay(spark, tmp_root):
    table = VersionedTable(spark, tmp_root)
    c0 = merge_into(table, df(spark, [("a", 1.0), ("b", 2.0)]), ["k"], ["v"])
    assert c0["inserted"] == 2 and table.version() == 0
    c1 = merge_into(table, df(spark, [("b", 3.0), ("c", 4.0)]), ["k"], ["v"])
    assert (c1["inserted"], c1["updated"], c1["untouched"]) == (1, 1, 1) and table.version() == 1
    c2 = merge_into(table, df(spark, [("b", 3.0), ("c", 4.0)]), ["k"], ["v"])
    assert c2["affected"] == 0 and table.version() == 1
    assert sorted(tuple(r) for r in table.read().collect()) == [("a", 1.0), ("b", 3.0), ("c", 4.0)]
