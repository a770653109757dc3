"""Landed feed files: whole transactions, one pass per feed, erasure of files a stream read."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F
from tests.conftest import rows

from tidelog.spec import CONSENTS, PROVIDERS
from tidelog.streaming import landing, stream
from tidelog.streaming.files import Files
from tidelog.streaming.store import ErasureIncomplete, Store

T0 = datetime(2024, 1, 1)
CONS = (
    "patient_id string, consent_research boolean, consent_marketing boolean, "
    "consent_partner_share boolean, lsn long, deleted_ts timestamp_ntz"
)
ASKED = "patient_id string, erased_at timestamp_ntz"


def cons(spark, *data):
    return spark.createDataFrame([(k, True, None, None, n, None) for k, n in data], CONS)


def ingest(spark, store, path, **args):
    feed = stream.feed_stream(spark, str(path), cons(spark).schema, {"maxFilesPerTrigger": "1"})
    stream.run_to_end(stream.merge_stream(feed, CONSENTS, store, f"{store.root}/cp", clock=lambda: T0, **args))


def test_no_transaction_spans_two_batches(spark, tmp_path):
    sizes = [1, 7, 3, 12, 2, 2, 5, 30, 1, 4]
    data, lsn = [], 0
    for txn, n in enumerate(sizes):
        for _ in range(n):
            lsn += 1
            data.append((f"P{lsn % 5}", True, None, None, lsn, None, txn))
    feed = spark.createDataFrame(data, CONS + ", txn long").repartition(4)
    landing.land_transactions(feed, str(tmp_path / "landed"), target=8)
    store = Store(spark, str(tmp_path / "store"))
    changes = stream.feed_stream(spark, str(tmp_path / "landed"), feed.schema, {"maxFilesPerTrigger": "1"})
    stream.run_to_end(stream.merge_stream(changes, CONSENTS, store, str(tmp_path / "cp"), keep=("txn",)))
    log = store.read_log("patient_consents", feed.schema)
    per = log.groupBy("txn").agg(F.count_distinct("_load_id").alias("loads"), F.count("lsn").alias("n"))
    assert rows(per, "txn", "loads", "n") == [(t, 1, n) for t, n in enumerate(sizes)]
    assert log.select("_load_id").distinct().count() == 6  # 0-7, 8-15, 16-23, 24-31, 32-39, 56-63, 64-


def test_split_stream_reads_the_feed_once(spark, tmp_path):
    def mixed(first, last):
        return spark.range(first, last).select(
            F.when(F.col("id") % 3 == 0, "patient_consents").when(F.col("id") % 3 == 1, "providers").otherwise("_loads").alias("relation"),
            F.concat(F.lit("K"), F.col("id") % 4).alias("key"), F.col("id").alias("lsn"),
        )

    source, split = str(tmp_path / "in"), str(tmp_path / "split")
    for first, last in ((0, 60), (60, 90)):
        mixed(first, last).write.mode("append").parquet(source)
        feed = stream.feed_stream(spark, source, mixed(0, 1).schema)
        q = landing.split_stream(feed, split, str(tmp_path / "cp"), ["_loads"])
        q.awaitTermination()
        assert len(q.lastProgress["sources"]) == 1 and q.lastProgress["numInputRows"] == last - first
    assert Files(spark).children(split) == ["relation=patient_consents", "relation=providers"]
    got = {}
    for table in ("patient_consents", "providers"):
        one = landing.table_stream(spark, split, mixed(0, 1).schema, table)
        name = f"seen_{table}"
        one.writeStream.format("memory").queryName(name).trigger(availableNow=True).start().awaitTermination()
        got[table] = rows(spark.table(name), "lsn")
    assert sorted(got["patient_consents"]) == [(i,) for i in range(0, 90, 3)]
    assert sorted(got["providers"]) == [(i,) for i in range(1, 90, 3)]


def land(df, path, parts=4):
    df.repartitionByRange(parts, "lsn").write.mode("append").parquet(str(path))


def feed_of(spark, n=40):
    return cons(spark, *[(f"P{i % 8}", i) for i in range(1, n + 1)], (None, 500), ("only", 600))


def test_subjects_leave_files_a_stream_has_read(spark, tmp_path):
    path = tmp_path / "landed"
    land(feed_of(spark), path)
    store = Store(spark, str(tmp_path / "store"))
    ingest(spark, store, path)
    before = Files(spark).children(str(path))
    n = landing.erase_files(spark, str(path), spark.createDataFrame([("P3",), ("only",)], "patient_id string"), "patient_id")
    assert n == 6
    assert Files(spark).children(str(path)) == before
    left = spark.read.parquet(str(path))
    assert left.count() == 36 and left.filter("patient_id is null").count() == 1
    land(cons(spark, ("P1", 700)), path, 1)
    ingest(spark, store, path)  # the old files are not read again
    log = store.read_log("patient_consents", cons(spark).schema)
    assert log.count() == 42 and log.filter("lsn = 700").count() == 1
    assert landing.erase_files(spark, str(path), spark.createDataFrame([("P3",)], "patient_id string"), "patient_id") == 0


def test_files_in_partition_folders(spark, tmp_path):
    path = str(tmp_path / "landed")
    feed_of(spark).withColumn("relation", F.lit("a")).write.partitionBy("relation").parquet(path)
    assert landing.erase_files(spark, path, spark.createDataFrame([("P5",)], "patient_id string"), "patient_id") == 5
    left = spark.read.parquet(path)
    assert left.count() == 37 and "relation" in left.columns


def test_rewriting_cut_short_is_finished(spark, tmp_path, monkeypatch):
    path = tmp_path / "landed"
    land(feed_of(spark), path)
    asked = spark.createDataFrame([("P3",), ("P4",)], "patient_id string")
    plain, calls = Files.replace, []

    def dies(self, source, target):
        calls.append(target)
        if len(calls) == 2:
            raise InterruptedError("stop")
        return plain(self, source, target)

    monkeypatch.setattr(Files, "replace", dies)
    with pytest.raises(InterruptedError):
        landing.erase_files(spark, str(path), asked, "patient_id")
    monkeypatch.setattr(Files, "replace", plain)
    assert spark.read.parquet(str(path)).count() >= 32  # nobody else's rows are lost
    landing.erase_files(spark, str(path), asked, "patient_id")
    left = spark.read.parquet(str(path))
    assert left.count() == 32 and left.filter("patient_id in ('P3', 'P4')").isEmpty()


# ---- erasure over all copies ---------------------------------------------------------


def asked(spark, *ids):
    return spark.createDataFrame([(i, None) for i in ids], ASKED)


def test_other_requests_under_the_same_id_are_carried_out(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    store.merge_batch(cons(spark, ("A", 1), ("B", 2), ("C", 3)), CONSENTS, "0", T0)
    tables = {"patient_consents": (cons(spark).schema, "patient_id")}
    store.erase_subjects(asked(spark, "A"), tables, "e0", T0)
    stamped, removed = store.erase_subjects(asked(spark, "B"), tables, "e0", T0)
    assert removed == {"patient_consents": 1} and rows(stamped, "erased_at") == [(T0,)]
    assert rows(store.read_log("patient_consents", cons(spark).schema), "patient_id") == [("C",)]
    # The same request again, after the subject came back.
    store.merge_batch(cons(spark, ("B", 9)), CONSENTS, "1", T0)
    assert store.erase_subjects(asked(spark, "B"), tables, "e0", T0)[1] == {"patient_consents": 1}
    assert rows(store.read_log("patient_consents", cons(spark).schema), "patient_id") == [("C",)]
    with pytest.raises(ValueError, match="can't erase again"):
        store.merge_batch(cons(spark, ("B", 10)), CONSENTS, "2", T0)
        store.erase("patient_consents", cons(spark).schema, asked(spark, "B"), "2", T0)


def test_nothing_is_stamped_while_rows_are_left(spark, tmp_path, monkeypatch):
    store = Store(spark, str(tmp_path))
    store.merge_batch(cons(spark, ("A", 1)), CONSENTS, "0", T0)
    monkeypatch.setattr(Store, "erase", lambda *a, **k: False)
    with pytest.raises(ErasureIncomplete, match="patient_consents: 1 rows"):
        store.erase_subjects(asked(spark, "A"), {"patient_consents": (cons(spark).schema, "patient_id")}, "e", T0)


def test_erasure_cut_short_between_commit_and_deletion(spark, tmp_path, monkeypatch):
    store = Store(spark, str(tmp_path))
    store.merge_batch(cons(spark, ("A", 1), ("B", 2)), CONSENTS, "0", T0)
    tables = {"patient_consents": (cons(spark).schema, "patient_id")}

    def dies(*a):
        raise InterruptedError("stop")

    plain = Store.clear_replaced
    monkeypatch.setattr(Store, "clear_replaced", dies)
    with pytest.raises(InterruptedError):
        store.erase_subjects(asked(spark, "A"), tables, "e", T0)
    monkeypatch.setattr(Store, "clear_replaced", plain)
    stamped, _ = store.erase_subjects(asked(spark, "A"), tables, "e", T0)
    assert rows(stamped, "erased_at") == [(T0,)]
    everything = spark.read.option("recursiveFileLookup", "true").parquet(f"{store.root}/raw/patient_consents")
    assert rows(everything, "patient_id") == [("B",)]


def test_every_retained_copy(spark, tmp_path):
    path = tmp_path / "landed"
    land(feed_of(spark), path)
    store = Store(spark, str(tmp_path / "store"))
    ingest(spark, store, path)
    tables = {"patient_consents": (cons(spark).schema, "patient_id")}
    stamped, removed = store.erase_subjects(asked(spark, "P2"), tables, "e", T0, landed={str(path): "patient_id"})
    assert removed == {"patient_consents": 5, str(path): 5}
    ingest(spark, store, path, erased=stamped)
    assert store.read_log("patient_consents", cons(spark).schema).filter("patient_id = 'P2'").isEmpty()


def test_erasure_in_a_bucketed_table(spark, tmp_path):
    store = Store(spark, str(tmp_path), buckets=2)
    schema = "provider_id string, name string, specialty string, lsn long, deleted_ts timestamp_ntz"
    df = spark.createDataFrame([(f"p{i}", "n", None, i, None) for i in range(9)], schema)
    store.merge_batch(df, PROVIDERS, "0", T0)
    who = spark.createDataFrame([("p4",)], "patient_id string")
    assert store.erase("providers", df.schema, who, "e", T0, key="provider_id")
    state = store.read_state(PROVIDERS, df.schema)
    assert state.count() == 8 and state.filter("provider_id = 'p4'").isEmpty()
    assert {e["buckets"] for e in store.committed("providers")} == {2}
