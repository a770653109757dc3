"""Row validation, frozen contract, staging, quality, erasure."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F
from tests.conftest import rows

from tidelog.operators import contract, erasure, quality, staging, validate
from tidelog.sources import snapshot
from tidelog.spec import APPOINTMENTS, CONSENTS, PATIENTS, PROVIDERS

T0 = datetime(2024, 1, 1)


def provider(spark, *data):
    return spark.createDataFrame(
        data, "provider_id string, name string, specialty string, lsn string, deleted_ts timestamp_ntz"
    )


def split(df, spec):
    checked = validate.prepare(df, spec)
    return validate.accepted(checked), validate.quarantined(checked, spec)


def test_provider_accepts_null_specialty(spark):
    good, bad = split(
        provider(
            spark,
            ("prov-1", "Test Provider A", "Cardiology", "12345", None),
            ("prov-2", "Test Provider B", None, "1", None),
        ),
        PROVIDERS,
    )
    assert rows(good, "provider_id", "specialty", "lsn") == [
        ("prov-1", "Cardiology", 12345),
        ("prov-2", None, 1),
    ]
    assert bad.count() == 0


@pytest.mark.parametrize("lsn", ["not-an-int", "0/103D8F0"])
def test_bad_position_is_quarantined(spark, lsn):
    good, bad = split(provider(spark, ("prov-1", "A", None, lsn, None)), PROVIDERS)
    assert good.count() == 0
    assert rows(bad, "table_name", "entity_id", "reasons") == [
        ("providers", "prov-1", ["lsn: type"])
    ]


def test_missing_required_value_and_column(spark):
    _, bad = split(provider(spark, ("prov-1", None, None, "1", None)), PROVIDERS)
    assert bad.first()["reasons"] == ["name: missing"]
    no_column = provider(spark, ("prov-1", "A", None, "1", None)).drop("specialty")
    _, bad = split(no_column, PROVIDERS)
    assert bad.first()["reasons"] == ["specialty: missing"]


def test_extra_column_is_a_contract_error(spark):
    df = provider(spark, ("prov-1", "A", None, "1", None)).withColumn(
        "unexpected_column", F.lit("boom")
    )
    with pytest.raises(contract.SchemaFrozen, match="unexpected_column"):
        validate.prepare(df, PROVIDERS)


def test_key_only_delete_is_accepted_with_null_flags(spark):
    schema = (
        "patient_id string, consent_research string, consent_marketing string, "
        "consent_partner_share string, lsn string, deleted_ts timestamp_ntz"
    )
    df = spark.createDataFrame([("PT0001", None, None, None, "999", T0)], schema)
    good, bad = split(df, CONSENTS)
    assert rows(good, "patient_id", "consent_research", "lsn") == [("PT0001", None, 999)]
    assert bad.count() == 0


def test_quarantine_holds_the_key_and_no_other_value(spark):
    df = spark.createDataFrame(
        [("pat-bad", "Jane", None, "1234", "not-a-datetime", "1", None)],
        "patient_id string, name string, primary_provider_id string, postcode string, "
        "updated_at string, lsn string, deleted_ts timestamp_ntz",
    )
    good, bad = split(df, PATIENTS)
    assert good.count() == 0 and "name" not in good.columns
    text = str(bad.collect())
    assert "pat-bad" in text and "1234" not in text and "Jane" not in text


def test_live_appointment_needs_all_columns_a_tombstone_too(spark):
    cols = {c: "x" for c in APPOINTMENTS.columns}
    cols |= {c: "2024-03-01T10:00:00" for c in ("scheduled_at", "event_timestamp", "ingested_at")}
    schema = ", ".join(f"{c} string" for c in cols) + ", lsn string, deleted_ts timestamp_ntz"
    full = tuple(cols.values())
    data = [(*full, "1", None), (*full, "2", datetime(2024, 3, 2, 12)), (*full[:-1], None, "3", T0)]
    good, bad = split(spark.createDataFrame(data, schema), APPOINTMENTS)
    assert rows(good, "lsn", "deleted_ts") == [(1, None), (2, datetime(2024, 3, 2, 12))]
    assert bad.first()["reasons"] == ["ingested_at: missing"]


def test_other_errors_stop_the_job(spark):
    df = provider(spark, ("p", "A", None, "1", None)).withColumn(
        "lsn", F.raise_error(F.lit("source broke")).cast("string")
    )
    with pytest.raises(Exception, match="source broke"):
        validate.accepted(validate.prepare(df, PROVIDERS)).collect()


def test_user_hooks_run_after_the_strip(spark):
    from dataclasses import replace

    spec = replace(PROVIDERS, preprocess=(lambda df: df.withColumn("name", F.upper("name")),))
    good, _ = split(provider(spark, ("p", "ann", None, "1", None)), spec)
    assert rows(good, "name") == [("ANN",)]


def test_strip_is_no_error_when_absent(spark):
    df = spark.createDataFrame([("P", "1")], "patient_id string, postcode string")
    assert validate.strip_columns(df, PATIENTS).columns == ["patient_id", "postcode"]


def test_relation_versions_are_checked(spark):
    ok = spark.createDataFrame([(["patient_id", "consent_research"],)], "columns array<string>")
    contract.check_versions(ok, CONSENTS)
    drifted = spark.createDataFrame([(["patient_id", "channel"],)], "columns array<string>")
    with pytest.raises(contract.SchemaFrozen, match="channel"):
        contract.check_versions(drifted, CONSENTS)


def test_snapshot_declares_change_columns(spark):
    df = spark.createDataFrame([("P1", "A", None)], "provider_id string, name string, specialty string")
    out = snapshot.snapshot(lambda: df, PROVIDERS)
    assert out.columns == ["provider_id", "name", "specialty", "lsn", "deleted_ts"]
    assert rows(out, "lsn", "deleted_ts") == [(None, None)]


def test_csv_source_types_and_nulls(spark, tmp_path):
    (tmp_path / "requests.csv").write_text("patient_id,erased_at\nPT0001,\nPT0002,2024-01-01 00:00:00\n")
    read = snapshot.csv_reader(
        spark, str(tmp_path / "requests.csv"), "patient_id string, erased_at timestamp_ntz"
    )
    assert rows(read()) == [("PT0001", None), ("PT0002", T0)]
    assert rows(erasure.pending(read()), "patient_id") == [("PT0001",)]


def test_mask_and_row_identity(spark):
    df = spark.createDataFrame([("P", "Jane", "1234")], "patient_id string, name string, postcode string")
    assert rows(staging.mask(df, PATIENTS)) == [("P", "<redacted>", "<redacted>")]
    a = spark.createDataFrame([("x", None), (None, "x"), ("", "x")], "a string, b string")
    assert staging.row_identity(a, ["a", "b"]).select("_row_id").distinct().count() == 3
    b = spark.createDataFrame([("x\u0001", "y"), ("x", "\u0001y"), ("N", None), (None, "N")], "a string, b string")
    assert staging.row_identity(b, ["a", "b"]).select("_row_id").distinct().count() == 4


def test_foreign_keys(spark):
    child = spark.createDataFrame([("a",), ("a",), ("z",), ("z",), (None,)], "fk string")
    parent = spark.createDataFrame([("a",), ("a",)], "pk string")
    assert rows(quality.orphan_keys(child, "fk", parent, "pk")) == [("z", 2)]
    out = quality.relationships(child, "c", "fk", parent, "pk", "warn").first()
    assert (out["failures"], out["status"]) == (2, "warn")
    assert quality.relationships(parent, "c", "pk", parent, "pk").first()["status"] == "pass"


def test_unique_ignores_null_keys(spark):
    df = spark.createDataFrame([(None,), (None,), ("a",)], "k string")
    assert quality.unique(df, "t", ["k"]).first()["failures"] == 0


@pytest.fixture
def subject_tables(spark):
    return {
        t: spark.createDataFrame([("PT1", 1), ("PT2", 2), (None, 3)], "patient_id string, n int")
        for t in erasure.CASCADE
    }


def test_erasure_round(spark, subject_tables):
    requests = spark.createDataFrame(
        [("PT1", None), ("PT9", T0)], "patient_id string, erased_at timestamp_ntz"
    )
    assert {r["rows_deleted"] for r in erasure.deletion_counts(subject_tables, requests).collect()} == {1}
    once = erasure.purge_all(subject_tables, requests)
    for df in once.values():
        assert rows(df, "n") == [(2,), (3,)]  # the row without a subject stays
    twice = erasure.purge_all(once, requests)
    assert all(rows(twice[t]) == rows(once[t]) for t in once)
    now = F.lit("2024-05-01 00:00:00").cast("timestamp_ntz")
    done = erasure.stamp(requests, now)
    assert rows(done) == [("PT1", datetime(2024, 5, 1)), ("PT9", T0)]
    assert rows(erasure.stamp(done, F.lit("2025-01-01").cast("timestamp_ntz"))) == rows(done)
    assert quality.passes(erasure.violations(once, done))
    back = {t: df for t, df in subject_tables.items()}
    assert erasure.violations(back, done).count() == 3
    assert not quality.passes(erasure.violations(back, done))
    assert erasure.replayable(subject_tables["patients"], done).count() == 2


def test_inserts_alone_are_appended():
    from tidelog.sources import feed

    assert feed.disposition(["I"]) == "append"
    assert feed.disposition(["I", "U", "D"]) == "merge"


def test_jdbc_options(spark, monkeypatch):
    """Split bounds, contract columns and the pinned snapshot reach the reader."""
    seen = {}

    class Reader:
        def format(self, name):
            seen["format"] = name
            return self

        def option(self, key, value):
            seen[key] = value
            return self

        def options(self, **kw):
            seen.update(kw)
            return self

        def load(self):
            return spark.createDataFrame([], PATIENTS.schema)

    class Session:
        read = Reader()

    read = snapshot.jdbc_reader(
        Session(),
        "jdbc:x",
        PATIENTS,
        split_column="row_no",
        lower=0,
        upper=100,
        partitions=4,
        properties={"user": "u"},
        snapshot_id="0003-1",
    )
    assert read().columns == PATIENTS.columns
    assert " name" not in seen["dbtable"] and "postcode" in seen["dbtable"]
    assert seen["numPartitions"] == 4 and "0003-1" in seen["sessionInitStatement"]


def test_rules_set_rows_aside_by_name(spark):
    from dataclasses import replace

    from tidelog.spec import Rule

    spec = replace(CONSENTS, rules=(Rule("early", "lsn < 10"), Rule("granted", "consent_research")))
    rows_in = [("a", True, None, None, 5, None), ("b", False, None, None, 50, None), ("c", None, None, None, 7, None)]
    df = spark.createDataFrame(rows_in, ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in CONSENTS.raw_schema.fields))
    checked = validate.prepare(df, spec)
    assert sorted(r["patient_id"] for r in validate.accepted(checked).collect()) == ["a", "c"]
    bad = validate.quarantined(checked, spec).first()
    assert bad["entity_id"] == "b" and bad["reasons"] == ["rule early", "rule granted"]


def test_propagation_tells_wrong_values_from_missing_rows(spark):
    from tidelog.operators import report

    schema = "k string, v string, deleted_ts timestamp_ntz"
    t = datetime(2024, 1, 1)
    table = spark.createDataFrame([("a", "1", None), ("b", "old", None), ("c", "x", t), ("d", None, None), (None, "n", None)], schema)
    wanted = spark.createDataFrame(
        [("INSERT", "a", "1", None), ("UPDATE", "b", "new", None), ("DELETE", "c", None, t), ("UPDATE", "e", "1", None),
         ("INSERT", "d", None, None), ("INSERT", None, "n", None), ("DELETE", "a", None, t)], "mutation string, " + schema,
    )
    got = {r["mutation"]: tuple(r)[2:] for r in report.propagation(table, "t", wanted, ["k"], ["v"]).collect()}
    assert got == {"INSERT": (3, 3, 3, True), "UPDATE": (2, 1, 0, False), "DELETE": (2, 2, 1, False)}
