"""Random change sequences against a plain replay: state, batches, repeated batches, modes."""

from __future__ import annotations

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from changeloom.operators import feed, merge, state
from changeloom.sources.txlog import ChangeTable
from changeloom.streaming.runs import merge_into

SCHEMA = "id long, v string, _cdc_op string, _cdc_timestamp long, _cdc_lsn long"
RULES = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
ops = st.lists(st.tuples(st.integers(1, 5), st.sampled_from(["INSERT", "UPDATE", "DELETE"])), min_size=1, max_size=25)


def feed_of(changes):
    return [(k, None if op == "DELETE" else f"v{i}", op, 100 + i, 1000 + i) for i, (k, op) in enumerate(changes)]


def replayed(rows):
    out = {}
    for k, v, op, _, lsn in rows:
        out.pop(k, None)
        if op != "DELETE":
            out[k] = (v, lsn)
    return out


def as_dict(df):
    return {r["id"]: (r["v"], r["_cdc_lsn"]) for r in df.collect()}


@RULES
@given(ops)
def test_latest_state_is_the_replay(spark, changes):
    rows = feed_of(changes)
    df = spark.createDataFrame(rows, SCHEMA)
    assert as_dict(state.latest_state(df)) == replayed(rows)
    assert as_dict(state.as_of(df, 1005)) == replayed(rows[:6])


@RULES
@given(ops, st.lists(st.integers(0, 25), max_size=3), st.booleans())
def test_any_split_and_any_repeat_give_the_same_state(spark, changes, cuts, repeat):
    rows = feed_of(changes)
    cuts = sorted({0, len(rows), *[min(c, len(rows)) for c in cuts]})
    batches = [rows[a:b] for a, b in zip(cuts, cuts[1:]) if a < b]
    now = merge.empty_state(spark.createDataFrame([], SCHEMA), tombstones=True)
    for b in batches + (batches[:1] if repeat else []):  # an old batch again: tombstones keep it out
        now = spark.createDataFrame(merge.plan_merge(now, spark.createDataFrame(b, SCHEMA), tombstones=True).collect(), now.schema)
    assert as_dict(merge.visible(now)) == replayed(rows)


STRICT = {  # (matched, op) -> value afterwards, None if there is no row
    (True, "UPDATE"): "new", (True, "INSERT"): "old", (True, "SNAPSHOT"): "old", (True, "DELETE"): None,
    (False, "UPDATE"): "new", (False, "INSERT"): "new", (False, "SNAPSHOT"): None, (False, "DELETE"): None,
}
AWARE = STRICT | {(True, "INSERT"): "new", (False, "SNAPSHOT"): "new"}


@pytest.mark.parametrize("mode, table", [("strict_ops", STRICT), ("snapshot_aware", AWARE)])
def test_truth_table(spark, mode, table):
    for (matched, op), expected in table.items():
        target = spark.createDataFrame([(1, "old", 5)] if matched else [], "id long, v string, _cdc_lsn long")
        lsn = 5 if op == "SNAPSHOT" else 9
        got = merge.plan_merge(target, spark.createDataFrame([(1, "new", op, 1, lsn)], SCHEMA), mode=mode).collect()
        assert (got[0]["v"] if got else None) == expected, (matched, op)


def test_stale_changes_and_null_keys(spark):
    target = spark.createDataFrame([(1, "old", 50), (None, "n", 1)], "id long, v string, _cdc_lsn long")
    got = merge.plan_merge(target, spark.createDataFrame([(1, "stale", "UPDATE", 1, 49), (None, "m", "INSERT", 1, 60)], SCHEMA)).collect()
    assert sorted((r["v"], r["_cdc_lsn"]) for r in got) == [("m", 60), ("n", 1), ("old", 50)]


def test_unchanged_cells_keep_the_old_value(spark):
    target = spark.createDataFrame([(1, "big", "a", 5)], "id long, v string, w string, _cdc_lsn long")
    changes = spark.createDataFrame([(1, None, "b", ["v"], "UPDATE", 1, 9)], "id long, v string, w string, _cdc_unchanged array<string>, _cdc_op string, _cdc_timestamp long, _cdc_lsn long")
    assert [tuple(r) for r in merge.plan_merge(target, changes).collect()] == [(1, "big", "b", 9)]


def test_guard_keeps_the_watermark_itself(spark):
    df = spark.createDataFrame([(1, "a", "INSERT", 1, 99), (2, "b", "INSERT", 1, 100), (3, "c", "SNAPSHOT", 0, 5)], SCHEMA)
    assert {r["id"] for r in feed.handover_guard(df, 100).collect()} == {2, 3}


def test_state_at_equal_positions_prefers_the_change(spark):
    df = spark.createDataFrame([(1, "snap", "SNAPSHOT", 0, 100), (1, "wal", "UPDATE", 7, 100)], SCHEMA)
    assert [r["v"] for r in state.latest_state(df).collect()] == ["wal"]


def test_merge_rewrites_only_touched_files(spark, tmp_path):
    t = ChangeTable(spark, f"file://{tmp_path}/silver")
    t.create(merge.empty_state(spark.createDataFrame([], SCHEMA), True).schema)
    merge_into(t, spark.createDataFrame([(1, "a", "INSERT", 1, 1)], SCHEMA))
    merge_into(t, spark.createDataFrame([(2, "b", "INSERT", 1, 2)], SCHEMA))
    before = set(t.snapshot().files)
    merge_into(t, spark.createDataFrame([(2, "c", "UPDATE", 1, 3)], SCHEMA), app_id="x", batch_id=0)
    after = set(t.snapshot().files)
    assert len(before & after) == len(before) - 1
    version = t.snapshot().version
    merge_into(t, spark.createDataFrame([(2, "d", "UPDATE", 1, 4)], SCHEMA), app_id="x", batch_id=0)  # applied already
    assert t.snapshot().version == version
    assert as_dict(merge.visible(t.read())) == {1: ("a", 1), 2: ("c", 3)}
