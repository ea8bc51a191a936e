"""Properties on generated data."""

from __future__ import annotations

from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tenantflow.model import IncrementSpec
from tenantflow.operators import lookups
from tenantflow.operators.incremental import incremental_sync
from tenantflow.operators.reconcile import apply_actions, snapshot_diff
from tenantflow.operators.upsert import latest_per_key, upsert

few = settings(
    max_examples=5,
    deadline=None,
    suppress_health_check=[HealthCheck.function_scoped_fixture, HealthCheck.too_slow],
)

STATE = "k string, v int, at int"
names = st.sampled_from(["a", "b", "c", "d"])
versions = st.lists(st.tuples(names, st.integers(0, 9)), min_size=1, max_size=12).map(
    lambda pairs: [(k, v, at) for at, (k, v) in enumerate(pairs, 1)]
)


@few
@given(history=versions, cuts=st.lists(st.integers(0, 12), max_size=3))
def test_increments_equal_one_load(spark, rows, history, cuts):
    whole = spark.createDataFrame(history, STATE)
    spec = IncrementSpec("at", "at")
    table = spark.createDataFrame([], STATE)
    for cut in [*sorted(cuts), len(history)]:
        seen = spark.createDataFrame(history[:cut], STATE)
        table = incremental_sync(seen, table, spec, ["k"], ["at"]).table
        table = spark.createDataFrame(table.collect(), STATE)
    assert rows(table) == rows(latest_per_key(whole, ["k"], ["at"]))


@few
@given(old=versions, new=versions)
def test_second_upsert_changes_nothing(spark, rows, old, new):
    target = latest_per_key(spark.createDataFrame(old, STATE), ["k"], ["at"])
    batch = spark.createDataFrame(new, STATE)
    once = upsert(target, batch, ["k"], ["at"])
    assert rows(upsert(once, batch, ["k"], ["at"])) == rows(once)
    expected = {k: (k, v, at) for k, v, at in target.collect()}
    expected.update({k: (k, v, at) for k, v, at in new})
    assert {r.k: tuple(r) for r in once.collect()} == expected


@few
@given(
    existing=st.sets(st.tuples(names, st.sampled_from(["x", "y"]))),
    desired=st.sets(st.tuples(names, st.sampled_from(["x", "y"]))),
)
def test_applied_diff_gives_the_desired_rows_in_scope(spark, existing, desired):
    schema = "id int, org string, name string"
    table = spark.createDataFrame([(n, *row) for n, row in enumerate(sorted(existing))], schema)
    wanted = spark.createDataFrame([(100, *row) for row in sorted(desired)], schema)
    keys, scope = ["org", "name"], ["org"]
    actions = snapshot_diff(wanted.drop("id"), table, keys, scope)
    applied = {(r.org, r.name) for r in apply_actions(table, actions, wanted, keys).collect()}
    scopes = {org for org, _ in desired}
    assert applied == desired | {row for row in existing if row[0] not in scopes}


@few
@given(
    left=st.lists(st.one_of(st.none(), st.integers(0, 6)), min_size=1, max_size=40),
    right=st.sets(st.integers(0, 8)),
    how=st.sampled_from(["inner", "left", "left_semi", "left_anti"]),
    share=st.sampled_from([0.02, 0.3, 0.9]),
)
def test_lookup_join_equals_plain_join(spark, shuffled, left, right, how, share):
    shuffled.HOT_SHARE = share
    one = spark.createDataFrame([(k, n) for n, k in enumerate(left)], "k int, n int")
    two = spark.createDataFrame([(k, k * 10) for k in sorted(right)], "k int, w int")
    found = Counter(map(tuple, lookups.lookup_join(one, two, "k", how).collect()))
    assert found == Counter(map(tuple, one.join(two, "k", how).collect()))


@pytest.mark.parametrize("share", [0.02, 0.3])
def test_hot_keys_are_the_frequent_ones(spark, monkeypatch, share):
    monkeypatch.setattr(lookups, "HOT_ROWS", 0)
    df = spark.range(1000).selectExpr("IF(id < 400, -1, id) AS k")
    assert len(lookups.hot_key_hashes(df, ["k"], share)) == 1
