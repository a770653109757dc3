"""Loads, ledger, compaction, erasure in the store, and streams with failures."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F
from tests.conftest import rows

from tidelog.operators.contract import SchemaFrozen
from tidelog.spec import CONSENTS, PATIENTS, PROVIDERS
from tidelog.streaming import stream
from tidelog.streaming.store import SeveralLoads, Store, latest_load, new_load_or_noop

T0 = datetime(2024, 1, 1)
SCHEMA = "provider_id string, name string, specialty string, lsn long, deleted_ts timestamp_ntz"
LOG = (
    "patient_id string, consent_research boolean, consent_marketing boolean, "
    "consent_partner_share boolean, lsn long, deleted_ts timestamp_ntz"
)


def prov(spark, *data):
    return spark.createDataFrame([(k, v, None, n, dt) for k, v, n, dt in data], SCHEMA)


def cons(spark, *data):
    return spark.createDataFrame([(k, f, None, None, n, dt) for k, f, n, dt in data], LOG)


@pytest.fixture
def store(spark, tmp_path):
    return Store(spark, str(tmp_path))


def test_latest_state_over_loads_and_after_compaction(spark, store):
    a = prov(spark, ("p1", "a", 1, None), ("p2", "b", 2, None))
    b = prov(spark, ("p1", "c", 5, None), ("p2", None, 4, T0), ("p1", "old", 3, None))
    late = prov(spark, ("p2", "late", 3, None))
    for i, batch in enumerate((a, b, late)):
        assert store.merge_batch(batch, PROVIDERS, str(i), T0)
    want = [("p1", "c", 5, None), ("p2", None, 4, T0)]
    cols = ("provider_id", "name", "lsn", "deleted_ts")
    assert rows(store.read_state(PROVIDERS, a.schema), *cols) == want
    assert store.compact(PROVIDERS, a.schema, "c", T0)
    assert [e["_load_id"] for e in store.committed("providers")] == ["c"]
    assert rows(store.read_log("providers", a.schema), *cols) == want
    store.merge_batch(late, PROVIDERS, "4", T0)
    assert rows(store.read_state(PROVIDERS, a.schema), *cols) == want


def test_event_log_reads_only_overlapping_loads(spark, store):
    schema = cons(spark).schema
    store.merge_batch(cons(spark, ("P", True, None, None), ("Q", True, None, None)), CONSENTS, "0", T0)
    store.merge_batch(cons(spark, ("P", False, 1, None), ("Q", False, 2, None)), CONSENTS, "1", T0)
    store.merge_batch(cons(spark, ("Q", False, 2, None), ("P", None, 3, T0)), CONSENTS, "2", T0)
    log = store.read_log("patient_consents", schema)
    assert rows(log, "patient_id", "lsn") == sorted(
        [("P", None), ("Q", None), ("P", 1), ("Q", 2), ("P", 3)], key=repr
    )
    assert log.filter("lsn is null").count() == 2
    assert rows(log.filter("_load_id = '2'"), "lsn") == [(3,)]


def test_replayed_load_changes_nothing(spark, store):
    batch = cons(spark, ("P", True, 1, None))
    assert store.merge_batch(batch, CONSENTS, "1", T0)
    assert not store.merge_batch(batch, CONSENTS, "1", T0)
    assert store.ledger("patient_consents").count() == 1
    assert store.read_log("patient_consents", batch.schema).count() == 1


def test_uncommitted_load_is_invisible_and_overwritten(spark, store):
    batch = cons(spark, ("P", True, 1, None))

    def die():
        raise InterruptedError("stop")

    with pytest.raises(InterruptedError):
        store.merge_batch(batch, CONSENTS, "1", T0, before_commit=die)
    assert store.read_log("patient_consents", batch.schema).count() == 0
    empty = batch.limit(0)
    assert store.merge_batch(empty, CONSENTS, "1", T0)  # an empty redo clears the leftovers
    assert store.read_log("patient_consents", batch.schema).count() == 0
    assert store.ledger("patient_consents").first()["rows_out"] == 0


def test_batch_without_rows_is_committed(spark, store, tmp_path):
    """Rows vanish at run time only; the load still gets its entry, with zero rows."""
    path = str(tmp_path / "landed")
    cons(spark, *feed_rows(5)).write.parquet(path)
    none = spark.read.parquet(path).filter("lsn < 0")
    assert store.merge_batch(none, CONSENTS, "0", T0)
    empty = spark.read.schema(SCHEMA).parquet(path).filter("lsn < 0")
    assert store.merge_batch(empty, PROVIDERS, "0", T0)
    entry = store.ledger("patient_consents").first()
    assert (entry["rows_out"], entry["min_lsn"]) == (0, None)


def test_new_load_guard(spark, store):
    batch = cons(spark, ("P", True, 1, None))
    assert store.new_load("patient_consents", set()) == ""
    store.merge_batch(batch, CONSENTS, "1", T0)
    assert store.new_load("patient_consents", set()) == "1"
    assert store.new_load("patient_consents", {"1"}) == ""
    store.merge_batch(batch, CONSENTS, "2", T0)
    with pytest.raises(SeveralLoads):
        store.new_load("patient_consents", set())


def test_latest_load_and_noop(spark, store):
    for i in (1, 2):
        store.merge_batch(cons(spark, ("P", True, i, None)), CONSENTS, str(i), datetime(2024, 1, i))
    ledger = store.ledger("patient_consents")
    assert latest_load(ledger).first()["_load_id"] == "2"
    assert new_load_or_noop(ledger, "1").first()["run_id"] == "2"
    assert new_load_or_noop(ledger.filter("_load_id = '1'"), "1").first()["run_id"] == "noop"


def test_compaction_of_small_loads_only(spark, store):
    a = prov(spark, *[(f"p{i}", "base", 1, None) for i in range(9)])
    store.merge_batch(a, PROVIDERS, "0", T0)
    store.merge_batch(prov(spark, ("p1", "x", 2, None)), PROVIDERS, "1", T0)
    store.merge_batch(prov(spark, ("p1", "y", 3, None)), PROVIDERS, "2", T0)
    store.compact(PROVIDERS, a.schema, "c", T0, max_rows=5)
    assert sorted(e["_load_id"] for e in store.committed("providers")) == ["0", "c"]
    state = store.read_state(PROVIDERS, a.schema)
    assert state.count() == 9
    assert rows(state.filter("provider_id = 'p1'"), "name", "lsn") == [("y", 3)]


def test_erasure_reaches_every_version(spark, store, tmp_path):
    schema = cons(spark).schema
    store.merge_batch(cons(spark, ("P", True, 1, None), ("Q", True, 2, None)), CONSENTS, "0", T0)
    store.compact(CONSENTS, schema, "c0", T0)
    store.merge_batch(cons(spark, ("P", False, 3, None), (None, None, 4, None)), CONSENTS, "1", T0)
    store.merge_batch(cons(spark, ("R", False, 5, None)), CONSENTS, "2", T0)
    asked = spark.createDataFrame([("P", None)], "patient_id string, erased_at timestamp_ntz")
    assert store.erase("patient_consents", schema, asked, "e0", T0)
    assert rows(store.read_log("patient_consents", schema), "patient_id", "lsn", "_load_id") == sorted(
        [("Q", 2, "e0"), (None, 4, "e0"), ("R", 5, "2")], key=repr
    )
    everything = spark.read.parquet(str(tmp_path / "raw" / "patient_consents"))
    assert everything.filter("patient_id = 'P'").count() == 0
    assert not store.erase("patient_consents", schema, asked, "e1", T0)
    assert store.read_log("patient_consents", schema).count() == 3


def test_erasure_of_the_quarantine(spark, store):
    bad = spark.createDataFrame(
        [("patient_consents", "P", ["lsn: type"], 1), ("patient_consents", "Q", ["x"], 2)],
        "table_name string, entity_id string, reasons array<string>, lsn long",
    )
    store.write(bad, "patient_consents_quarantine", "0", T0)
    asked = spark.createDataFrame([("P",)], "patient_id string")
    args = ("patient_consents_quarantine", bad.schema, asked, "e0", T0)
    assert store.erase(*args, key="entity_id")
    assert rows(store.read_log("patient_consents_quarantine", bad.schema), "entity_id") == [("Q",)]


# ---- streams -------------------------------------------------------------------------


def land(df, path, parts=4):
    df.repartitionByRange(parts, "lsn").write.mode("append").parquet(str(path))


def feed_rows(n):
    return [(f"P{i % 7}", i % 3 == 0, i, T0 if i % 11 == 0 else None) for i in range(1, n + 1)]


def run(spark, path, store, spec=CONSENTS, **args):
    schema = cons(spark).schema if spec is CONSENTS else prov(spark).schema
    feed = stream.feed_stream(spark, str(path), schema, {"maxFilesPerTrigger": "1"})
    q = stream.merge_stream(feed, spec, store, f"{store.root}/cp", clock=lambda: T0, **args)
    stream.run_to_end(q)


def test_stream_in_two_runs_with_redelivery(spark, store, tmp_path):
    path = tmp_path / "landed"
    land(cons(spark, *feed_rows(60)), path)
    run(spark, path, store)
    land(cons(spark, *feed_rows(80)[50:]), path)  # events 51 to 60 come again
    run(spark, path, store)
    log = store.read_log("patient_consents", cons(spark).schema)
    assert log.count() == 80 and log.select("lsn").distinct().count() == 80


@pytest.mark.parametrize("crash_at", [0, 2])
def test_stream_crash_between_data_and_ledger(spark, store, tmp_path, crash_at):
    path = tmp_path / "landed"
    land(cons(spark, *feed_rows(60)), path)

    def die(batch_id):
        if batch_id == crash_at:
            raise InterruptedError("injected")

    with pytest.raises(Exception, match="injected"):
        run(spark, path, store, before_commit=die)
    schema = cons(spark).schema
    assert store.ledger("patient_consents").count() == crash_at
    run(spark, path, store)
    log = store.read_log("patient_consents", schema)
    assert log.count() == 60 and log.select("lsn").distinct().count() == 60
    run(spark, path, store)  # nothing new: no load, no row
    assert store.read_log("patient_consents", schema).count() == 60


def test_stream_refuses_a_new_column(spark, store, tmp_path):
    path = tmp_path / "landed"
    df = cons(spark, *feed_rows(4)).withColumn("unexpected_schema_freeze_col", F.lit("extra"))
    land(df, path, 1)
    feed = stream.feed_stream(spark, str(path), df.schema)
    with pytest.raises(SchemaFrozen, match="unexpected_schema_freeze_col"):
        stream.merge_stream(feed, CONSENTS, store, f"{store.root}/cp")
    assert store.ledger("patient_consents").count() == 0


def test_stream_splits_rows_and_counts_them(spark, store, tmp_path):
    df = cons(spark, *feed_rows(20)).withColumn(
        "lsn", F.when(F.col("lsn") % 5 == 0, "x").otherwise(F.col("lsn").cast("string"))
    )
    path = str(tmp_path / "landed")
    df.write.parquet(path)
    feed = stream.feed_stream(spark, path, df.schema)
    q = stream.merge_stream(feed, CONSENTS, store, f"{store.root}/cp", clock=lambda: T0)
    stream.run_to_end(q)
    assert store.read_log("patient_consents", cons(spark).schema).count() == 16
    assert store.ledger("patient_consents_quarantine").first()["rows_out"] == 4
    entry = store.ledger("patient_consents").agg(F.sum("rows_in"), F.sum("rows_dropped")).first()
    assert tuple(entry) == (20, 4)


PATIENT_FEED = (
    "patient_id string, name string, primary_provider_id string, postcode string, "
    "updated_at timestamp_ntz, lsn long, op string, txn long"
)


def test_ingest_strips_validates_and_projects(spark, store, tmp_path):
    rows_in = [("p1", "Jane Roe", "d", "1", T0, 1, "I", 7), (None, "No One", "d", "1", T0, 2, "I", 7)]
    assert stream.ingest_batch(spark.createDataFrame(rows_in, PATIENT_FEED), PATIENTS, store, "0", T0)
    landed = spark.read.parquet(str(tmp_path / "raw" / "patients"))
    assert set(landed.columns) == {*PATIENTS.columns, "lsn", "load_id"}
    assert landed.count() == 1
    entry = store.ledger("patients").first()
    assert (entry["rows_in"], entry["rows_out"], entry["rows_dropped"]) == (2, 1, 1)
    assert store.ledger("patients_quarantine").first()["rows_out"] == 1


def test_events_of_one_position_land_with_seq(spark, store):
    df = cons(spark, ("P", True, 7, None), ("Q", False, 7, None)).withColumn(
        "seq", F.when(F.col("patient_id") == "P", 1).otherwise(2)
    )
    stream.ingest_batch(df, CONSENTS, store, "0", T0)
    stream.ingest_batch(df, CONSENTS, store, "1", T0)  # delivered again
    assert store.read_log("patient_consents", df.schema).count() == 2


def test_snapshot_lands_once_and_changes_follow(spark, store):
    copy = spark.createDataFrame([("P", True, None, None), (None, True, None, None)],
                                 ", ".join(LOG.split(", ")[:4]))
    assert store.bootstrap(copy, CONSENTS, T0)
    assert not store.bootstrap(copy.union(copy), CONSENTS, T0)
    entry = store.ledger("patient_consents").first()
    assert (entry["kind"], entry["rows_in"], entry["rows_out"]) == ("snapshot", 2, 1)
    store.compact(CONSENTS, cons(spark).schema, "c", T0)
    assert not store.bootstrap(copy, CONSENTS, T0)


def test_erased_subjects_do_not_come_back(spark, store):
    schema = cons(spark).schema
    stream.ingest_batch(cons(spark, ("P", True, 1, None), ("Q", True, 2, None)), CONSENTS, store, "0", T0)
    asked = spark.createDataFrame([("P", None)], "patient_id string, erased_at timestamp_ntz")
    tables = {"patient_consents": (schema, "patient_id")}
    stamped, removed = store.erase_subjects(asked, tables, "e0", T0)
    assert removed == {"patient_consents": 1} and rows(stamped, "erased_at") == [(T0,)]
    late = cons(spark, ("P", False, 3, None), ("Q", False, 4, None))
    stream.ingest_batch(late, CONSENTS, store, "1", T0, erased=stamped)
    assert rows(store.read_log("patient_consents", schema), "patient_id", "lsn") == [("Q", 2), ("Q", 4)]
    assert store.erase_subjects(stamped, tables, "e1", T0)[1] == {}


def test_a_failing_table_stops_the_others(spark, store, tmp_path):
    land(cons(spark, *feed_rows(10)), tmp_path / "c", 1)
    bad = cons(spark, *feed_rows(4)).withColumn("surprise", F.lit("x"))
    land(bad, tmp_path / "p", 1)
    feeds = {
        "patient_consents": stream.feed_stream(spark, str(tmp_path / "c"), cons(spark).schema),
        "providers": stream.feed_stream(spark, str(tmp_path / "p"), bad.schema),
    }
    specs = {"patient_consents": CONSENTS, "providers": PROVIDERS}
    with pytest.raises(SchemaFrozen):
        stream.run_tables(feeds, specs, store, f"{store.root}/cp")
    assert not spark.streams.active
    with pytest.raises(ValueError, match="unknown"):
        stream.run_tables(feeds, specs, store, f"{store.root}/cp", tables=["unknown"])


def test_tables_run_apart_and_dry_run_writes_nothing(spark, store, tmp_path):
    land(cons(spark, *feed_rows(10)), tmp_path / "c", 1)
    land(prov(spark, ("p1", "a", 1, None), ("p1", "b", 2, None)), tmp_path / "p", 1)
    feeds = {
        "patient_consents": stream.feed_stream(spark, str(tmp_path / "c"), cons(spark).schema),
        "providers": stream.feed_stream(spark, str(tmp_path / "p"), prov(spark).schema),
    }
    specs = {"patient_consents": CONSENTS, "providers": PROVIDERS}
    args = (feeds, specs, store, f"{store.root}/cp")
    assert stream.run_tables(*args, dry_run=True) == ["patient_consents", "providers"]
    assert store.ledger("providers").count() == 0
    assert stream.run_tables(*args, tables=["providers"]) == ["providers"]
    assert store.ledger("patient_consents").count() == 0
    stream.run_tables(*args)
    assert store.read_log("patient_consents", cons(spark).schema).count() == 10
    assert rows(store.read_state(PROVIDERS, prov(spark).schema), "name") == [("b",)]
