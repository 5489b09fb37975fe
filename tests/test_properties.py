"""Property tests: upsert(upsert(x)) = upsert(x) for non-null keys, and the merge state equals a
plain-Python model of the reference's MERGE."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from obsmatch.operators.upsert import counts, next_state, plan

KEYS = st.sampled_from(["a", "b", "c", "d", "e"])
VALS = st.one_of(st.none(), st.sampled_from([0.0, 1.0, 2.5]))
TARGET = st.dictionaries(KEYS, VALS, max_size=5)
STAGING = st.dictionaries(KEYS, VALS, max_size=5)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(target=TARGET, staging=STAGING)
def test_merge_matches_model_and_is_idempotent(spark, target, staging):
    schema = "k string, v double"
    t = spark.createDataFrame(list(target.items()), schema)
    s = spark.createDataFrame(list(staging.items()), schema)
    once = next_state(plan(t, s, ["k"], ["v"]), ["k", "v"])
    model = dict(target)
    model.update(staging)
    assert sorted(tuple(r) for r in once.collect()) == sorted(model.items())
    expected_affected = sum(1 for k, v in staging.items() if k not in target or target[k] != v)
    assert counts(plan(t, s, ["k"], ["v"]), ["k"]).first()["affected"] == expected_affected
    assert counts(plan(once, s, ["k"], ["v"]), ["k"]).first()["affected"] == 0
