"""The ledger's folds, key filters, bucketed loads: what is read, and that nothing is lost."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F
from tests.conftest import rows
from tests.test_plans import plan

from tidelog.spec import CONSENTS, LATEST, PROVIDERS, TableSpec
from tidelog.streaming import ledger as lg
from tidelog.streaming import store as st
from tidelog.streaming.files import Files
from tidelog.streaming.store import Store

T0 = datetime(2024, 1, 1)
PROV = "provider_id string, name string, specialty string, lsn long, deleted_ts timestamp_ntz"
CONS = (
    "patient_id string, consent_research boolean, consent_marketing boolean, "
    "consent_partner_share boolean, lsn long, deleted_ts timestamp_ntz"
)


def prov(spark, *data):
    return spark.createDataFrame([(k, v, None, n, None) for k, v, n in data], PROV)


def cons(spark, *data):
    return spark.createDataFrame([(k, True, None, None, n, None) for k, n in data], CONS)


def entry(i, replaces=()):
    return {"table_name": "t", lg.LOAD: f"l{i:05d}", "kind": "changes", "status": 0, "seconds": 0.5, "rows_in": i,
            "inserted_at": T0 + timedelta(seconds=i), "min_lsn": i, "max_lsn": i, "replaces": list(replaces)}


def test_files_opened_stay_few(spark, tmp_path, monkeypatch):
    """However many loads there were, a reader opens one fold and a few entries."""
    monkeypatch.setattr(lg, "FOLD_AFTER", 6)
    ledger = lg.Ledger(spark, str(tmp_path), "t")
    opened = []
    for i in range(60):
        gone = [f"l{k:05d}" for k in range(i - 10, i)] if i % 20 == 19 else []
        ledger.add(entry(i, gone))
        files = set()
        for df in (ledger.entries(), ledger.visible()):
            files |= set(df.inputFiles())
        opened.append(len(files))
    assert max(opened) <= 2 * 6 + 2 and max(opened[-24:]) - max(opened[12:36]) <= 0
    assert rows(ledger.entries(), lg.LOAD) == [(f"l{i:05d}",) for i in range(60)]
    replaced = {k for i in (19, 39, 59) for k in range(i - 10, i)}
    assert rows(ledger.visible(), lg.LOAD) == [(f"l{i:05d}",) for i in range(60) if i not in replaced]
    assert all(ledger.has(f"l{i:05d}") for i in range(60)) and not ledger.has("l00060")
    assert [r["rows_in"] for r in ledger.entries().orderBy(lg.LOAD).collect()] == list(range(60))


def test_a_fold_cut_short_is_written_anew(spark, tmp_path):
    ledger = lg.Ledger(spark, str(tmp_path), "t")
    for i in range(3):
        ledger.add(entry(i))
    Files(spark).make(f"{ledger.folds}/n=000000000/visible=1")  # no _SUCCESS
    assert ledger.entries().count() == ledger.visible().count() == 3
    assert ledger.fold(after=1)
    assert rows(ledger.visible(), lg.LOAD) == [("l00000",), ("l00001",), ("l00002",)]


def test_an_entry_cut_short_does_not_count(spark, tmp_path):
    ledger = lg.Ledger(spark, str(tmp_path), "t")
    Files(spark).make(f"{ledger.entry_path('x')}/_temporary")
    assert not ledger.has("x") and ledger.entries().count() == 0


# ---- buckets -------------------------------------------------------------------------


def test_state_of_twenty_loads_is_read_without_a_shuffle(spark, tmp_path):
    store = Store(spark, str(tmp_path), buckets=4)
    want = {}
    for i in range(20):
        data = [(f"p{(i * 7 + k) % 13}", f"v{i}-{k}", i * 10 + k) for k in range(5)]
        store.merge_batch(prov(spark, *data), PROVIDERS, f"b{i:03d}", T0)
        for k, v, n in data:
            want[k] = max(want.get(k, (0, "")), (n, v))
    state = store.read_state(PROVIDERS, prov(spark).schema)
    assert "Exchange" not in plan(state)
    assert rows(state, "provider_id", "lsn", "name") == sorted((k, n, v) for k, (n, v) in want.items())
    one = store.read_state(PROVIDERS, prov(spark).schema, where=F.col("provider_id") == "p3")
    assert "SelectedBucketsCount: 1 out of 4" in plan(one) and one.count() == 1
    assert store.compact(PROVIDERS, prov(spark).schema, "c", T0)
    assert rows(store.read_state(PROVIDERS, prov(spark).schema), "provider_id", "lsn", "name") == rows(
        state, "provider_id", "lsn", "name"
    )
    files = Files(spark).children(f"{store.root}/raw/providers/load_id=c")
    assert len(files) <= 4


def test_bucket_count_stays(spark, tmp_path):
    Store(spark, str(tmp_path), buckets=3).merge_batch(prov(spark, ("a", "x", 1)), PROVIDERS, "0", T0)
    later = Store(spark, str(tmp_path), buckets=9)
    later.merge_batch(prov(spark, ("a", "y", 2)), PROVIDERS, "1", T0)
    assert {e["buckets"] for e in later.committed("providers")} == {3}
    assert rows(later.read_state(PROVIDERS, prov(spark).schema), "name") == [("y",)]


def test_loads_without_buckets_are_still_read(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    store.write(prov(spark, ("a", "old", 1)), "providers", "0", T0)
    store.merge_batch(prov(spark, ("a", "new", 2), ("b", "z", 1)), PROVIDERS, "1", T0)
    schema = prov(spark).schema
    assert rows(store.read_state(PROVIDERS, schema), "name") == [("new",), ("z",)]
    store.compact(PROVIDERS, schema, "c", T0)
    assert rows(store.read_state(PROVIDERS, schema), "name") == [("new",), ("z",)]
    assert {e["buckets"] for e in store.committed("providers")} == {store.bucket_count("providers")}


def test_a_bucketed_load_cut_short_is_overwritten(spark, tmp_path):
    store = Store(spark, str(tmp_path))

    def die():
        raise InterruptedError("stop")

    with pytest.raises(InterruptedError):
        store.merge_batch(prov(spark, ("a", "x", 1), ("b", "x", 1)), PROVIDERS, "0", T0, before_commit=die)
    store.merge_batch(prov(spark, ("a", "y", 1)), PROVIDERS, "0", T0)
    assert rows(store.read_state(PROVIDERS, prov(spark).schema), "name") == [("y",)]


# ---- key filters ---------------------------------------------------------------------


def test_key_filter_has_no_false_negative(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    held = {}
    for i in range(6):
        keys = [f"P{i}-{k}" if k % 3 else f"common{k}" for k in range(40)]
        store.merge_batch(cons(spark, *[(k, i * 100 + n) for n, k in enumerate(keys)]), CONSENTS, str(i), T0)
        held[str(i)] = set(keys)
    store.merge_batch(cons(spark, (None, 9000)), CONSENTS, "n", T0)  # no key at all
    for asked in (["P3-1"], ["P0-1", "P5-2"], ["common3"], ["absent"], [None]):
        near = store.holding("patient_consents", spark.createDataFrame([(a,) for a in asked], "patient_id string"), ["patient_id"])
        need = {i for i, keys in held.items() if keys & set(asked)}
        assert need <= set(near) and len(near) <= len(need) + 1
    near = store.holding("patient_consents", cons(spark, ("P3-1", 1)), ["patient_id"])
    assert near == ["3"]


def test_erasure_opens_only_loads_that_may_hold_the_subject(spark, tmp_path, monkeypatch):
    store = Store(spark, str(tmp_path))
    for i in range(5):
        store.merge_batch(cons(spark, *[(f"P{i}-{k}", i * 10 + k) for k in range(9)]), CONSENTS, str(i), T0)
    opened = []
    plain = Store.read_loads

    def watched(self, table, schema, loads):
        opened.append(sorted(loads))
        return plain(self, table, schema, loads)

    monkeypatch.setattr(st.Store, "read_loads", watched)
    asked = spark.createDataFrame([("P2-4",)], "patient_id string")
    assert store.erase("patient_consents", cons(spark).schema, asked, "e", T0)
    assert opened == [["2"], ["2"]]
    assert store.read_log("patient_consents", cons(spark).schema).count() == 44


def test_merge_by_another_key_opens_only_loads_that_may_hold_it(spark, tmp_path, monkeypatch):
    spec = TableSpec(**{**CONSENTS.__dict__, "merge_key": ("patient_id",)})
    store = Store(spark, str(tmp_path))
    for i in range(4):
        store.merge_batch(cons(spark, *[(f"P{i}-{k}", k) for k in range(5)]), spec, str(i), T0)
    opened = []
    plain = Store.read_loads
    monkeypatch.setattr(st.Store, "read_loads", lambda s, t, c, loads: opened.append(sorted(loads)) or plain(s, t, c, loads))
    store.merge_batch(cons(spark, ("P1-2", 77), ("new", 78), (None, 79)), spec, "4", T0)
    assert opened == [["1"]]
    log = store.read_log("patient_consents", cons(spark).schema)
    assert rows(log.filter("_load_id = '4'"), "patient_id") == sorted([("new",), (None,)], key=repr)


def test_a_latest_spec_of_two_key_columns(spark, tmp_path):
    spec = TableSpec(**{**PROVIDERS.__dict__, "key": ("provider_id", "specialty"), "mode": LATEST})
    store = Store(spark, str(tmp_path), buckets=3)
    df = spark.createDataFrame([("a", "x", "s", 1, None), ("a", "y", "t", 2, None), ("a", "z", "s", 3, None)], PROV)
    store.merge_batch(df, spec, "0", T0)
    state = store.read_state(spec, df.schema)
    assert "Exchange" not in plan(state) and rows(state, "name") == [("y",), ("z",)]
    near = store.holding("providers", df.filter("name = 'z'"), ["provider_id", "specialty"])
    assert near == ["0"] and store.holding("providers", df.filter(F.lit(False)), ["provider_id", "specialty"]) == []
