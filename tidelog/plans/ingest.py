"""Queries over snapshots, feeds, validation and staging."""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog.functions.cells import spark_type, try_typed
from tidelog.operators import contract, merge, staging, validate
from tidelog.plans import standins as s
from tidelog.plans.registry import query
from tidelog.plans.standins import sql
from tidelog.session import run_dir
from tidelog.sources import feed, snapshot, wal
from tidelog.spec import APPOINTMENTS, CONSENTS, PATIENTS, PROVIDERS, SPECS
from tidelog.streaming import landing, stream
from tidelog.streaming.store import Store

NTZ = "timestamp_ntz"
CONSENT_COLUMNS = [*CONSENTS.columns, "lsn", "deleted_ts"]
CONSENT_LIST = ", ".join(CONSENT_COLUMNS)


def union(parts: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), parts)


def patient_snapshot(spark: SparkSession, d: str) -> DataFrame:
    return snapshot.snapshot(lambda: s.patients(spark, d).drop("lsn"), PATIENTS)


def appointment_snapshot(spark: SparkSession, d: str) -> DataFrame:
    return snapshot.declare_cdc_columns(s.appointments(spark, d))


@query(
    "snapshot_load",
    sql(
        """select patient_id, primary_provider_id, postcode, updated_at,
                  cast(null as bigint) lsn, cast(null as timestamp) deleted_ts
           from patients""",
        "patients",
    ),
)
def snapshot_load(spark, d):
    return patient_snapshot(spark, d)


@query(
    "snapshot_null_key_append",
    sql(
        """select 'patients' table_name, count(*) n_rows from patients
           union all
           select 'appointments', count(distinct event_id) from appointments
           union all
           select 'patient_consents', count(*) from consent_snapshot""",
        "patients",
        "appointments",
        "consent_snapshot",
    ),
)
def snapshot_null_key_append(spark, d):
    landed = {
        "patients": snapshot.land_snapshot(patient_snapshot(spark, d), PATIENTS),
        "appointments": snapshot.land_snapshot(
            appointment_snapshot(spark, d), APPOINTMENTS, s.APPOINTMENT_TIES
        ),
        "patient_consents": snapshot.land_snapshot(s.consent_snapshot(spark, d), CONSENTS),
    }
    return union(
        [
            df.agg(F.count(F.lit(1)).alias("n_rows")).select(
                F.lit(name).alias("table_name"), "n_rows"
            )
            for name, df in landed.items()
        ]
    )


@query(
    "bootstrap_idempotent",
    sql(
        """select 'patients' table_name, count(*) n_rows from patients
           union all
           select 'patient_consents', cast(0 as bigint)""",
        "patients",
    ),
)
def bootstrap_idempotent(spark, d):
    """The ledger knows a consent snapshot but no patient snapshot."""
    ledger = s.load_entries(spark, d)
    parts = []
    for name, df in (
        ("patients", patient_snapshot(spark, d)),
        ("patient_consents", s.consent_snapshot(spark, d)),
    ):
        left = snapshot.not_bootstrapped(df, name, ledger)
        n = left.agg(F.count(F.lit(1)).alias("n_rows"))
        parts.append(n.select(F.lit(name).alias("table_name"), "n_rows"))
    return union(parts)


@query(
    "change_range_scan",
    sql(
        f"""select {CONSENT_LIST} from consents
            where lsn > (select max(event_id) + 1 from events) // 4
              and lsn <= (select max(event_id) + 1 from events) * 3 // 4""",
        "consents",
    ),
)
def change_range_scan(spark, d):
    changes = s.consents(spark, d)
    high = feed.high_water_value(changes)
    return feed.change_range(changes, high // 4, high * 3 // 4).select(*CONSENT_COLUMNS)


@query("high_water_lsn", "select max(event_id) + 1 high_water_lsn from events")
def high_water_lsn(spark, d):
    return feed.high_water(s.consents(spark, d))


@query(
    "include_columns",
    sql("select patient_id, consent_research, lsn, deleted_ts from consents", "consents"),
)
def include_columns(spark, d):
    return feed.include_columns(s.consents(spark, d), ["patient_id", "consent_research"])


@query(
    "publish_ops_filter",
    sql("select patient_id, lsn, op from consents where op in ('I', 'U')", "consents"),
)
def publish_ops_filter(spark, d):
    return feed.publish(s.consents(spark, d), ["I", "U"]).select("patient_id", "lsn", "op")


def mixed_feed(spark: SparkSession, d: str) -> DataFrame:
    """One feed of two tables and of bookkeeping rows."""
    head = ["relation", "key", "lsn", "op"]
    cons = s.consents(spark, d).withColumns({"relation": F.lit("patient_consents"), "key": F.col("patient_id")})
    prov = s.provider_changes(spark, d).withColumns({"relation": F.lit("providers"), "key": F.col("provider_id")})
    own = prov.filter("lsn % 100 = 0").withColumn("relation", F.lit("_loads"))
    return union([x.select(*head) for x in (cons, prov, own)])


@query(
    "feed_demux",
    sql(
        """select 'patient_consents' relation, op, count(*) n_rows, count(distinct patient_id) n_keys,
                  min(lsn) min_lsn, max(lsn) max_lsn from consents group by op
           union all
           select 'providers', op, count(*), count(distinct provider_id), min(lsn), max(lsn)
           from provider_changes group by op""",
        "consents",
        "provider_changes",
    ),
)
def feed_demux(spark, d):
    """One pass over the feed lands every table in a folder of its own; each is read there."""
    path = run_dir(spark, "demux")
    landing.land_by_table(mixed_feed(spark, d), path, ["_loads"])
    streams = feed.demux(spark.read.parquet(path), ["providers", "patient_consents"], ["_loads"])
    return union(
        [
            df.groupBy("relation", "op").agg(
                F.count(F.lit(1)).alias("n_rows"),
                F.count_distinct("key").alias("n_keys"),
                F.min("lsn").alias("min_lsn"),
                F.max("lsn").alias("max_lsn"),
            )
            for df in streams.values()
        ]
    )


@query(
    "dry_run_targets",
    sql(
        """select 'providers' table_name, 'latest' mode, count(*) n_pending from consents
           union all select 'patient_consents', 'log', count(*) from consents""",
        "consents",
    ),
)
def dry_run_targets(spark, d):
    modes = {name: spec.mode for name, spec in SPECS.items()}
    return feed.table_targets(mixed_feed(spark, d), modes)


@query(
    "raw_roundtrip",
    sql(
        f"select {CONSENT_LIST}, cast(load_no as varchar) _load_id from consents", "consents"
    ),
)
def raw_roundtrip(spark, d):
    """Written load by load, read back through the ledger."""
    store = Store(spark, run_dir(spark, "raw"))
    changes = s.with_loads(spark, d, s.consents(spark, d))
    schema = changes.select(*CONSENT_COLUMNS).schema
    for n in range(4):
        part = changes.filter(F.col("load_no") == n).select(*CONSENT_COLUMNS)
        store.write(part, "patient_consents", str(n), datetime(2024, 2, 1 + n))
    return store.read_log("patient_consents", schema)


def landed_messages(spark: SparkSession, d: str) -> DataFrame:
    """The replication messages as they lie on the shared folder, in slot order."""
    path = f"{run_dir(spark, 'messages')}/landed"
    s.wal_messages(spark, d).write.parquet(path)
    return spark.read.parquet(path)


@query(
    "decode_wal_messages",
    sql(
        """select patient_id, op, lsn, max(commit_ts) over (partition by txn) commit_ts,
                  case when op = 'D' then max(commit_ts) over (partition by txn) end deleted_ts,
                  consent_research, consent_marketing, consent_partner_share
           from consents""",
        "consents",
    ),
)
def decode_wal_messages(spark, d):
    messages = landed_messages(spark, d)
    return wal.typed_rows(wal.decode(messages), CONSENTS).drop("slot", "seq")


@query(
    "relation_versions",
    sql(
        """select 'patient_consents' relation, case when load_no < 2 then 4 else 5 end n_columns,
                  case when load_no < 2 then '' else 'channel' end new_columns,
                  count(*) n_changes
           from consents group by all""",
        "consents",
    ),
)
def relation_versions(spark, d):
    scanned = wal.scan(landed_messages(spark, d))
    versions = wal.relation_versions(wal.decode(scanned), wal.relations(scanned))
    known = F.array(*[F.lit(c) for c in CONSENTS.columns])
    return versions.select(
        "relation",
        F.size("columns").alias("n_columns"),
        F.array_join(F.array_except("columns", known), ",").alias("new_columns"),
        "n_changes",
    )


@query(
    "versions_landed",
    sql(
        """select 'b000000000000-0' _load_id, count(*) n_rows, min(lsn) min_lsn, max(lsn) max_lsn,
                  '' refused
           from consents where load_no < 2
           union all
           select 'b000000000000-1', 0, null, null, 'table patient_consents: new column(s) channel'""",
        "consents",
    ),
)
def versions_landed(spark, d):
    """A batch in which the table gets a column: the rows before land as a load of their own,
    the rest stops with the column's name."""
    messages = landed_messages(spark, d)
    store = Store(spark, run_dir(spark, "versions"))
    refused = ""
    try:
        stream.ingest_messages(messages, CONSENTS, store, stream.load_id(0), datetime(2024, 2, 1))
    except contract.SchemaFrozen as e:
        refused = str(e)
    rows = store.ledger("patient_consents").select("_load_id", F.col("rows_out").alias("n_rows"), "min_lsn", "max_lsn")
    rest = spark.range(1 if refused else 0).select(
        F.lit("b000000000000-1"), F.lit(0).cast("long"), F.lit(None).cast("long"), F.lit(None).cast("long"), F.lit(refused)
    )
    return rows.withColumn("refused", F.lit("")).unionAll(rest)


@query(
    "typed_cells",
    """select event_id, cast(user_id as integer) user_id, ts, cast(ts as date) as day,
              event_type as tag, event_id % 2 = 0 is_even,
              cast(round(value * 100) as bigint) cents,
              cast(json_extract(props, '$.k') as bigint) k, cast(1 as bigint) has_type
       from events""",
)
def typed_cells(spark, d):
    """Every value rendered as text, then typed by the source's type number."""
    e = s.table(spark, d, "events")
    flag = F.when(F.col("event_id") % 2 == 0, "t").otherwise("f")
    cells = e.select(
        F.col("event_id").cast("string").alias("c20"),
        F.col("user_id").cast("string").alias("c23"),
        F.col("ts").cast("string").alias("c1114"),
        F.substring(F.col("ts").cast("string"), 1, 10).alias("c1082"),
        F.concat(F.lit("\\x"), F.hex("event_type")).alias("c17"),
        flag.alias("c16"),
        F.col("value").cast("string").alias("c1700"),
        F.col("props").alias("c3802"),
        F.col("event_type").alias("c25"),
    )
    typmods = {1700: ((18 << 16) | 4) + 4}
    typed = cells.select(
        *[
            try_typed(F.col(f"c{oid}"), spark_type(oid, typmods.get(oid, -1))).alias(f"c{oid}")
            for oid in (20, 23, 1114, 1082, 17, 16, 1700, 3802, 25)
        ]
    )
    return typed.select(
        F.col("c20").alias("event_id"),
        F.col("c23").alias("user_id"),
        F.col("c1114").alias("ts"),
        F.col("c1082").alias("day"),
        F.col("c17").cast("string").alias("tag"),
        F.col("c16").alias("is_even"),
        F.round(F.col("c1700") * 100).cast("bigint").alias("cents"),
        F.variant_get("c3802", "$.k", "bigint").alias("k"),
        (F.col("c25") == F.col("c17").cast("string")).cast("bigint").alias("has_type"),
    )


# ---- projections and predicates ------------------------------------------------------


@query(
    "strip_pii",
    sql(
        "select patient_id, primary_provider_id, postcode, updated_at, lsn from patients",
        "patients",
    ),
)
def strip_pii(spark, d):
    return validate.strip_columns(s.patients(spark, d), PATIENTS)


TIMES = {"scheduled_at", "event_timestamp", "ingested_at", "updated_at", "deleted_ts"}
FIGURES = {"lsn", "part", "consent_research", "consent_marketing", "consent_partner_share"}


def _digest(columns: list[str]) -> str:
    def cell(c: str) -> str:
        if c in TIMES:
            return f"cast(epoch_us({c}) as varchar)"
        return f"cast({c} as varchar)" if c in FIGURES else f"length({c}) || ':' || {c}"

    return f"sha256({' || '.join(f'coalesce({cell(c)}, {chr(39)}N{chr(39)}) || {chr(39)}|{chr(39)}' for c in columns)})"


APPOINTMENT_ROW = [*SPECS["appointments"].columns, "part"]
ROW_COLUMNS = {
    "appointments": APPOINTMENT_ROW,
    "patients": [*PATIENTS.columns, "lsn"],
    "providers": PROVIDERS.columns,
    "patient_consents": [*SPECS["patient_consents"].columns, "lsn"],
}


def raw(df: DataFrame, name: str, load_id) -> DataFrame:
    return staging.row_identity(df.withColumn("_load_id", load_id), ROW_COLUMNS[name])


def staged(df: DataFrame, name: str) -> DataFrame:
    """Staged view with zone-free times, as the comparison needs them."""
    out = staging.stage(df, name)
    times = [f.name for f in out.schema.fields if isinstance(f.dataType, T.TimestampType)]
    return out.withColumns({c: F.col(c).cast(NTZ) for c in times})


@query(
    "stg_appointments",
    sql(
        f"""select event_id, appointment_id, patient_id, provider_id,
                   scheduled_at scheduled_time, status, event_timestamp event_time,
                   ingested_at ingested_time, cast(null as bigint) lsn,
                   cast(null as timestamp) deleted_time, 'snapshot' _load_id,
                   {_digest(ROW_COLUMNS['appointments'])} _row_id
            from appointments""",
        "appointments",
    ),
)
def stg_appointments(spark, d):
    return staged(raw(appointment_snapshot(spark, d), "appointments", F.lit("snapshot")), "appointments")


@query(
    "stg_patients",
    sql(
        f"""select patient_id, primary_provider_id, postcode, updated_at updated_time,
                   'snapshot' _load_id, {_digest(ROW_COLUMNS['patients'])} _row_id
            from patients""",
        "patients",
    ),
)
def stg_patients(spark, d):
    stripped = validate.strip_columns(s.patients(spark, d), PATIENTS)
    return staged(raw(stripped, "patients", F.lit("snapshot")), "patients")


@query(
    "stg_providers",
    sql(
        f"""select provider_id, name, specialty, cast(null as bigint) lsn,
                   cast(null as timestamp) deleted_time, 'snapshot' _load_id,
                   {_digest(ROW_COLUMNS['providers'])} _row_id
            from providers""",
        "providers",
    ),
)
def stg_providers(spark, d):
    df = snapshot.snapshot(lambda: s.providers(spark, d), PROVIDERS)
    return staged(raw(df, "providers", F.lit("snapshot")), "providers")


@query(
    "stg_consents",
    sql(
        f"select {CONSENT_LIST}, cast(load_no as varchar) _load_id from consents", "consents"
    ),
)
def stg_consents(spark, d):
    loaded = s.with_loads(spark, d, s.consents(spark, d))
    return staged(loaded.withColumn("_load_id", F.col("load_no").cast("string")), "patient_consents")


@query(
    "row_identity",
    sql(
        f"""select event_id, part, provider_id, 'snapshot' _load_id,
                   {_digest(APPOINTMENT_ROW)} _row_id
            from appointments""",
        "appointments",
    ),
)
def row_identity(spark, d):
    df = raw(s.appointments(spark, d), "appointments", F.lit("snapshot"))
    return df.select("event_id", "part", "provider_id", "_load_id", "_row_id")


@query(
    "live_rows",
    sql(f"select {CONSENT_LIST} from consents where deleted_ts is null", "consents"),
)
def live_rows(spark, d):
    return merge.live_rows(s.consents(spark, d)).select(*CONSENT_COLUMNS)


@query(
    "deleted_rows",
    sql(f"select {CONSENT_LIST} from consents where deleted_ts is not null", "consents"),
)
def deleted_rows(spark, d):
    return merge.deleted_rows(s.consents(spark, d)).select(*CONSENT_COLUMNS)


@query(
    "change_rows_only",
    sql(f"select {CONSENT_LIST} from consents where lsn is not null", "consents"),
)
def change_rows_only(spark, d):
    both = s.consent_snapshot(spark, d).unionByName(s.consents(spark, d).select(*CONSENT_COLUMNS))
    return merge.change_rows(both)


@query(
    "prefix_exclude",
    "select s_suppkey, s_name from supplier where s_name not like 'Supplier_00000000_'",
)
def prefix_exclude(spark, d):
    df = s.table(spark, d, "supplier").select("s_suppkey", "s_name")
    return staging.exclude_prefix(df, "s_name", "Supplier_00000000_")


@query(
    "mask_pii",
    sql(
        """select patient_id, '<redacted>' as name, primary_provider_id,
                  '<redacted>' postcode, updated_at, lsn from patients""",
        "patients",
    ),
)
def mask_pii(spark, d):
    return staging.mask(s.patients(spark, d), PATIENTS)


# ---- validation ----------------------------------------------------------------------


def text_consents(spark: SparkSession, d: str) -> DataFrame:
    """The consent feed as text cells with faults: bad positions, bad flags, no subject."""
    k = F.col("lsn") % 100
    flag = F.col("consent_research").cast("string")
    bad_lsn = F.concat(F.lit("0/"), F.hex("lsn"))
    return s.consents(spark, d).select(
        F.when(F.col("lsn") % 37 != 0, F.col("patient_id")).alias("patient_id"),
        F.when((k < 12) & (F.col("op") != "D"), "maybe").otherwise(flag).alias("consent_research"),
        F.col("consent_marketing").cast("string").alias("consent_marketing"),
        F.col("consent_partner_share").cast("string").alias("consent_partner_share"),
        F.when(k < 10, bad_lsn).otherwise(F.col("lsn").cast("string")).alias("lsn"),
        "deleted_ts",
        F.col("lsn").alias("seq"),
    )


def text_patients(spark: SparkSession, d: str) -> DataFrame:
    bad = F.col("lsn") % 97 == 0
    when = F.when(bad, "not-a-datetime").otherwise(F.col("updated_at").cast("string"))
    return s.patients(spark, d).withColumn("updated_at", when)


TEXT_CONSENTS = """
    text_consents as (
        select case when lsn % 37 <> 0 then patient_id end patient_id,
               consent_research is not null and lsn % 100 < 12 bad_flag,
               lsn % 100 < 10 bad_lsn, consent_research, consent_marketing,
               consent_partner_share, lsn, deleted_ts
        from consents)"""
FAULTS = """concat_ws(';', case when patient_id is null then 'patient_id: missing' end,
                      case when bad_flag then 'consent_research: type' end,
                      case when bad_lsn then 'lsn: type' end)"""


@query(
    "validate_accept",
    sql(
        f""", {TEXT_CONSENTS}
            select {CONSENT_LIST}, lsn seq from text_consents
            where patient_id is not null and not bad_flag and not bad_lsn""",
        "consents",
    ),
)
def validate_accept(spark, d):
    return validate.accepted(validate.prepare(text_consents(spark, d), CONSENTS))


@query(
    "validate_quarantine",
    sql(
        f""", {TEXT_CONSENTS}
            select 'patient_consents' table_name, coalesce(patient_id, '') entity_id,
                   {FAULTS} reasons, case when not bad_lsn then lsn end lsn
            from text_consents
            where patient_id is null or bad_flag or bad_lsn
            union all
            select 'patients', patient_id, 'updated_at: type', lsn
            from patients where lsn % 97 = 0""",
        "consents",
        "patients",
    ),
)
def validate_quarantine(spark, d):
    return quarantine(spark, d).withColumn("reasons", F.array_join("reasons", ";"))


def quarantine(spark: SparkSession, d: str) -> DataFrame:
    cons = validate.prepare(text_consents(spark, d), CONSENTS)
    pats = validate.prepare(text_patients(spark, d), PATIENTS)
    return validate.quarantined(cons, CONSENTS).unionByName(
        validate.quarantined(pats, PATIENTS)
    )


@query(
    "drop_report",
    sql(
        f""", {TEXT_CONSENTS}, rows as (
                select 'patient_consents' table_name, unnest(string_split({FAULTS}, ';')) reason
                from text_consents
                where patient_id is null or bad_flag or bad_lsn
                union all
                select 'patients', 'updated_at: type' from patients where lsn % 97 = 0
                union all
                select 'slot_patient_consents', 'truncate_ignored'
                from (select distinct txn from consents where txn % 50 = 0))
            select table_name, reason, count(*) n_rows from rows group by all""",
        "consents",
        "patients",
    ),
)
def drop_report(spark, d):
    dropped = validate.drop_report(quarantine(spark, d))
    return dropped.unionByName(wal.ignored_truncates(s.wal_messages(spark, d)))


@query(
    "schema_drift_report",
    sql(
        """select load_no, 'channel' column_name, count(*) n_rows
           from consents where load_no >= 2 group by load_no
           union all
           select load_no, 'consent_source', count(*)
           from consents where load_no = 3 and op = 'U' group by load_no""",
        "consents",
    ),
)
def schema_drift_report(spark, d):
    """Two columns the contract does not know turn up in later loads."""
    loaded = s.with_loads(spark, d, s.consents(spark, d))
    n = F.col("load_no")
    drifted = loaded.withColumn("channel", F.when(n >= 2, "web")).withColumn(
        "consent_source", F.when((n == 3) & (F.col("op") == "U"), "form")
    )
    return contract.drift_report(drifted, CONSENTS)
