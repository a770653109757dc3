"""Merges, tombstones, replay: small literal cases."""

import itertools
from datetime import datetime

import pytest
from tests.conftest import rows

from tidelog.operators import merge
from tidelog.operators.history import scd2_by_load, scd2_precise
from tidelog.spec import CONSENTS

T0 = datetime(2024, 1, 1)
SCHEMA = "k string, lsn long, v string, deleted_ts timestamp_ntz"


def frame(spark, data):
    return spark.createDataFrame(data, SCHEMA)


def test_highest_position_wins_in_any_order(spark):
    batches = [
        [("a", 1, "i", None), ("b", 2, "i", None)],
        [("a", 5, "u", None), ("b", 4, None, T0)],
        [("a", 3, "old", None), ("b", 3, "old", None)],
    ]
    want = [("a", 5, "u", None), ("b", 4, None, T0)]
    for order in itertools.permutations(range(3)):
        state = frame(spark, [])
        for i in (*order, order[0]):  # one batch is replayed
            state = merge.merge_latest(state, frame(spark, batches[i]), ["k"])
        assert rows(state) == want


def test_older_update_does_not_revive_a_tombstone(spark):
    state = frame(spark, [("a", 9, None, T0)])
    out = merge.merge_latest(state, frame(spark, [("a", 8, "late", None)]), ["k"])
    assert rows(out) == [("a", 9, None, T0)]


def test_insert_after_delete_is_live_again(spark):
    log = frame(spark, [("a", 1, "x", None), ("a", 2, None, T0), ("a", 3, "y", None)])
    assert rows(merge.live_rows(merge.latest_per_key(log, ["k"]))) == [("a", 3, "y", None)]
    assert rows(merge.resurrected_keys(log, ["k"])) == [("a", 2, 3)]


def test_change_beats_snapshot_row(spark):
    state = frame(spark, [("a", None, "snapshot", None)])
    out = merge.merge_latest(state, frame(spark, [("a", 1, "change", None)]), ["k"])
    assert rows(out, "v") == [("change",)]


def test_rows_without_key_never_match(spark):
    df = frame(spark, [(None, 1, "x", None), (None, 2, "y", None), ("a", 1, "z", None)])
    assert merge.latest_per_key(df, ["k"]).count() == 3
    assert merge.latest_per_key(df, ["k"], keep_null_keys=False).count() == 1


def test_log_keeps_all_snapshot_rows_and_each_event_once(spark):
    log = frame(spark, [("a", None, "s", None), ("b", None, "s", None), ("a", 1, "u", None)])
    batch = frame(spark, [("a", 1, "u", None), ("b", 2, None, T0), ("b", 2, None, T0)])
    once = merge.event_log_merge(log, batch)
    assert rows(once) == sorted(
        [("a", None, "s", None), ("b", None, "s", None), ("a", 1, "u", None), ("b", 2, None, T0)],
        key=repr,
    )
    assert rows(merge.event_log_merge(once, batch)) == rows(once)


def test_two_events_may_share_a_position(spark):
    """``seq`` tells them apart where the feed has it."""
    schema = "k string, lsn long, seq int, deleted_ts timestamp_ntz"
    batch = spark.createDataFrame([("a", 7, 0, None), ("b", 7, 1, None)], schema)
    empty = spark.createDataFrame([], schema)
    once = merge.event_log_merge(empty, batch)
    assert once.count() == 2
    assert merge.event_log_merge(once, batch).count() == 2
    assert merge.event_log_merge(empty.drop("seq"), batch.drop("seq")).count() == 1


def test_log_size_is_snapshot_plus_distinct_positions(spark):
    snap = frame(spark, [(f"k{i}", None, "s", None) for i in range(5)])
    events = [(f"k{i % 5}", i % 17, "e", None) for i in range(60)]
    log = snap
    for i in range(0, 60, 10):
        log = merge.event_log_merge(log, frame(spark, events[max(0, i - 5) : i + 10]))
    assert log.count() == 5 + 17


def test_unsent_value_fails_or_is_carried(spark):
    schema = "k string, lsn long, v string, kind string"
    data = [("a", 1, "x", "t"), ("a", 2, None, "u"), ("a", 3, None, "t"), ("a", 4, None, "u")]
    df = spark.createDataFrame(data, schema)
    with pytest.raises(Exception, match="unchanged value not sent for column v"):
        merge.unchanged_values(df, ["k"], "v", "kind").collect()
    for size in (2, 100):
        out = merge.unchanged_values(df, ["k"], "v", "kind", carry=True, rows_per_chunk=size)
        assert rows(out, "lsn", "v") == [(1, "x"), (2, "x"), (3, None), (4, None)]


def test_key_change_leaves_old_row_unless_asked(spark):
    schema = "op string, k string, old_k string, lsn long, commit_ts timestamp_ntz, deleted_ts timestamp_ntz"
    feed = spark.createDataFrame(
        [("I", "a", "a", 1, T0, None), ("U", "b", "a", 2, T0, None)], schema
    )
    assert rows(merge.live_rows(merge.latest_per_key(feed, ["k"])), "k") == [("a",), ("b",)]
    both = feed.unionByName(merge.old_key_tombstones(feed, "k", "old_k"))
    assert rows(merge.live_rows(merge.latest_per_key(both, ["k"])), "k") == [("b",)]


def test_precise_windows_are_disjoint_and_tombstones_close(spark):
    schema = "k string, lsn long, commit_ts timestamp_ntz, deleted_ts timestamp_ntz"
    times = [datetime(2024, 1, n) for n in (1, 2, 3, 4)]
    data = [
        ("a", 1, times[0], None),
        ("a", 2, times[1], None),
        ("a", 3, times[2], times[2]),
        ("a", 4, times[3], None),
    ]
    log = spark.createDataFrame(data, schema)
    for size in (2, 100):
        out = scd2_precise(log, "k", rows_per_chunk=size)
        assert rows(out, "valid_from", "valid_to") == [
            (times[0], times[1]),
            (times[1], times[2]),
            (times[3], None),
        ]


def test_load_windows_put_snapshot_first(spark):
    schema = "k string, lsn long, _load_id string, deleted_ts timestamp_ntz"
    log = spark.createDataFrame([("a", 5, "1", None), ("a", None, "0", None)], schema)
    ledger = spark.createDataFrame(
        [("0", datetime(2024, 1, 1)), ("1", datetime(2024, 1, 2))],
        "_load_id string, inserted_at timestamp_ntz",
    )
    out = scd2_by_load(log, ledger, "k")
    assert rows(out, "lsn", "valid_from", "valid_to") == [
        (5, datetime(2024, 1, 2), None),
        (None, datetime(2024, 1, 1), datetime(2024, 1, 2)),
    ]


def test_deleted_consent_is_null_not_granted(spark):
    """A key-only delete must never read as consent given."""
    schema = "patient_id string, lsn long, consent_research boolean, deleted_ts timestamp_ntz"
    log = spark.createDataFrame([("P", 1, True, None), ("P", 2, None, T0)], schema)
    state = merge.latest_per_key(log, CONSENTS.key)
    assert rows(state, "consent_research") == [(None,)]
    from tidelog.operators.consent import consented

    facts = spark.createDataFrame([("P", 1), ("Q", 2)], "patient_id string, n int")
    assert consented(facts, log, "consent_research").count() == 0
    assert consented(facts, log.filter("lsn = 1"), "consent_research").count() == 1


def test_active_entities(spark):
    log = frame(spark, [("a", 1, "x", None), ("a", 2, None, T0), ("b", 3, None, T0)])
    assert rows(merge.active_entity_count(log, "k")) == [(1,)]
