"""Queries over merges, deletes, replay, loads and streams."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog.operators import merge, report
from tidelog.plans import ingest
from tidelog.plans import standins as s
from tidelog.plans.ingest import CONSENT_COLUMNS, CONSENT_LIST
from tidelog.plans.registry import query
from tidelog.plans.standins import sql
from tidelog.session import run_dir
from tidelog.sources import feed, snapshot
from tidelog.spec import CONSENTS, PATIENTS, PROVIDERS
from tidelog.streaming import landing, stream
from tidelog.streaming import store as st
from tidelog.streaming.store import Store

PROVIDER_COLUMNS = [*PROVIDERS.columns, "lsn", "deleted_ts"]
PROVIDER_LIST = ", ".join(PROVIDER_COLUMNS)
STATE = [*CONSENT_COLUMNS, "op"]
FLAG_COLUMNS = "consent_research, consent_marketing, consent_partner_share"

LATEST_PROVIDERS = f"""
    , providers_state as (
        select {PROVIDER_LIST} from (
            select *, row_number() over (partition by provider_id
                                         order by lsn desc nulls last) rn
            from (select provider_id, name, specialty, cast(null as bigint) lsn,
                         cast(null as timestamp) deleted_ts from providers
                  union all select {PROVIDER_LIST} from provider_changes))
        where rn = 1)"""
LATEST_CONSENTS = f"""
    , state as (
        select {CONSENT_LIST}, op from (
            select *, row_number() over (partition by patient_id order by lsn desc) rn
            from consents)
        where rn = 1)"""


def provider_state(spark: SparkSession, d: str) -> DataFrame:
    first = snapshot.snapshot(lambda: s.providers(spark, d), PROVIDERS)
    changes = s.provider_changes(spark, d).select(*PROVIDER_COLUMNS)
    return merge.merge_latest(first, changes, PROVIDERS.key)


@query(
    "merge_latest",
    sql(
        f"{LATEST_PROVIDERS} select {PROVIDER_LIST} from providers_state",
        "providers",
        "provider_changes",
    ),
)
def merge_latest(spark, d):
    return provider_state(spark, d)


@query(
    "live_state_by_op",
    sql(
        """, last as (
             select op, deleted_ts from (
               select *, row_number() over (partition by patient_id order by lsn desc) rn
               from consents) where rn = 1)
           select op, count(*) n_keys from last where deleted_ts is null group by op""",
        "consents",
    ),
)
def live_state_by_op(spark, d):
    """The smallest whole path: feed, merge, live rows, count per change kind."""
    state = merge.latest_per_key(s.consents(spark, d).select(*STATE), ["patient_id"])
    return merge.live_rows(state).groupBy("op").agg(F.count(F.lit(1)).alias("n_keys"))


@query(
    "dedup_delivery",
    sql(
        """select event_id, appointment_id, patient_id, provider_id, scheduled_at, status,
                  event_timestamp, ingested_at, part
           from (select *, row_number() over (partition by event_id
                     order by event_timestamp desc, part desc, provider_id desc) rn
                 from appointments) where rn = 1""",
        "appointments",
    ),
)
def dedup_delivery(spark, d):
    order = [F.col(c).desc_nulls_last() for c in s.APPOINTMENT_TIES]
    return merge.latest_per_key(s.appointments(spark, d), ["event_id"], order=order)


def redelivered(df: DataFrame) -> DataFrame:
    """Every twentieth event once more."""
    return df.unionByName(df.filter("lsn % 20 = 1"))


@query(
    "event_log_merge",
    sql(
        f"""select {CONSENT_LIST} from consent_snapshot
            union all select {CONSENT_LIST} from consents""",
        "consent_snapshot",
        "consents",
    ),
)
def event_log_merge(spark, d):
    """Log = snapshot + loads 0 to 2; the batch repeats load 2 and brings load 3, with
    copies inside the batch."""
    changes = s.with_loads(spark, d, s.consents(spark, d))
    log = s.consent_snapshot(spark, d).unionByName(
        changes.filter("load_no < 3").select(*CONSENT_COLUMNS)
    )
    batch = redelivered(changes.filter("load_no >= 2").select(*CONSENT_COLUMNS))
    return merge.event_log_merge(log, batch)


@query("soft_delete_state", sql(f"{LATEST_CONSENTS} select {CONSENT_LIST}, op from state", "consents"))
def soft_delete_state(spark, d):
    """A deleted key keeps its row: key, NULL flags (never dummies), delete time."""
    return merge.latest_per_key(s.consents(spark, d).select(*STATE), ["patient_id"])


@query(
    "tombstone_events",
    sql(
        """select patient_id, count(*) n_events,
                  cast(count(deleted_ts) as bigint) n_tombstones,
                  max(deleted_ts) last_deleted_ts
           from consents group by patient_id having count(deleted_ts) > 0""",
        "consents",
    ),
)
def tombstone_events(spark, d):
    """Tombstones stand beside the earlier events of their key."""
    first = s.consents(spark, d).select(*CONSENT_COLUMNS)
    log = merge.event_log_merge(first, redelivered(first))
    return (
        log.groupBy("patient_id")
        .agg(
            F.count(F.lit(1)).alias("n_events"),
            F.count("deleted_ts").alias("n_tombstones"),
            F.max("deleted_ts").alias("last_deleted_ts"),
        )
        .filter("n_tombstones > 0")
    )


@query(
    "resurrected_keys",
    sql(
        """select patient_id, max(case when gone then lsn end) last_delete_lsn,
                  max(case when not gone then lsn end) last_live_lsn
           from (select *, deleted_ts is not null gone from consents)
           group by patient_id
           having max(case when not gone then lsn end) > max(case when gone then lsn end)""",
        "consents",
    ),
)
def resurrected_keys(spark, d):
    return merge.resurrected_keys(s.consents(spark, d), ["patient_id"])


@query(
    "commit_time_of_delete",
    sql(
        """select patient_id, lsn, deleted_ts from (
               select patient_id, lsn, op, max(commit_ts) over (partition by txn) deleted_ts
               from consents) where op = 'D'""",
        "consents",
    ),
)
def commit_time_of_delete(spark, d):
    """The delete time is the commit time of the transaction, not of the statement."""
    return (
        ingest.decode_wal_messages(spark, d)
        .filter("op = 'D'")
        .select("patient_id", "lsn", "deleted_ts")
    )


def moved_keys(spark: SparkSession, d: str) -> DataFrame:
    """Some updates carry a new key; ``old_key`` is the key before."""
    e = s.consents(spark, d).withColumn("old_key", F.col("patient_id"))
    moved = (F.col("op") == "U") & (F.col("lsn") % 50 == 1)
    return e.withColumn(
        "patient_id",
        F.when(moved, F.concat(F.lit("N"), F.col("patient_id"))).otherwise(F.col("patient_id")),
    )


MOVED = """
    , moved as (
        select case when op = 'U' and lsn % 50 = 1 then concat('N', patient_id)
                    else patient_id end patient_id,
               patient_id old_key, lsn, op, commit_ts, consent_research, deleted_ts
        from consents)"""


@query(
    "key_change_update",
    sql(
        f"""{MOVED} select patient_id, lsn, consent_research, deleted_ts from (
                select *, row_number() over (partition by patient_id order by lsn desc) rn
                from moved) where rn = 1""",
        "consents",
    ),
)
def key_change_update(spark, d):
    """Only the new image counts: the row under the old key stays as it was."""
    cols = ["patient_id", "lsn", "consent_research", "deleted_ts"]
    return merge.latest_per_key(moved_keys(spark, d).select(*cols), ["patient_id"])


@query(
    "key_change_tombstones",
    sql(
        f"""{MOVED}, feed as (
                select patient_id, lsn, consent_research, deleted_ts from moved
                union all
                select old_key, lsn, consent_research, commit_ts from moved
                where old_key <> patient_id)
            select patient_id, lsn, consent_research, deleted_ts from (
                select *, row_number() over (partition by patient_id order by lsn desc) rn
                from feed) where rn = 1""",
        "consents",
    ),
)
def key_change_tombstones(spark, d):
    """The opt-in variant closes the old key."""
    changes = moved_keys(spark, d)
    both = changes.unionByName(merge.old_key_tombstones(changes, "patient_id", "old_key"))
    cols = ["patient_id", "lsn", "consent_research", "deleted_ts"]
    return merge.latest_per_key(both.select(*cols), ["patient_id"])


@query(
    "unchanged_value_carry",
    sql(
        """, sent as (
               select *, case when op = 'U' and lsn % 3 = 0 then null
                              else consent_marketing end v,
                      case when op = 'U' and lsn % 3 = 0 then 0 else 1 end is_sent
               from consents where op <> 'D'),
             pointed as (
               select *, max(case when is_sent = 1 then lsn end) over (
                   partition by patient_id order by lsn
                   rows between unbounded preceding and current row) src
               from sent)
           select p.patient_id, p.lsn, q.v consent_marketing
           from pointed p left join sent q on q.lsn = p.src""",
        "consents",
    ),
)
def unchanged_value_carry(spark, d):
    """Updates that did not send a value take the key's last sent one."""
    unsent = (F.col("op") == "U") & (F.col("lsn") % 3 == 0)
    cells = (
        s.consents(spark, d)
        .filter("op <> 'D'")
        .withColumn("kind", F.when(unsent, "u").otherwise("t"))
        .withColumn("consent_marketing", F.when(~unsent, F.col("consent_marketing")))
        .select("patient_id", "lsn", "kind", "consent_marketing")
    )
    filled = merge.unchanged_values(cells, ["patient_id"], "consent_marketing", "kind", carry=True)
    return filled.select("patient_id", "lsn", "consent_marketing")


@query("replay_invariance", sql(f"{LATEST_CONSENTS} select {CONSENT_LIST}, op from state", "consents"))
def replay_invariance(spark, d):
    """Batches out of order, one of them twice, give the one-shot state."""
    changes = s.with_loads(spark, d, s.consents(spark, d)).select(*STATE, "load_no")
    state = changes.filter("load_no = 2").drop("load_no")
    for n in (0, 3, 1, 2):
        batch = changes.filter(F.col("load_no") == n).drop("load_no")
        state = merge.merge_latest(state, batch, ["patient_id"])
    return state


@query(
    "active_entity_count",
    sql(
        "select count(distinct patient_id) active_entities from consents where deleted_ts is null",
        "consents",
    ),
)
def active_entity_count(spark, d):
    return merge.active_entity_count(s.consents(spark, d), "patient_id")


# ---- loads and ledger ----------------------------------------------------------------


@query(
    "load_ledger",
    sql(
        """select _load_id, kind, status, inserted_at, rows_out, min_lsn, max_lsn,
                  rows_out n_joined
           from load_entries where status = 0""",
        "load_entries",
    ),
)
def load_ledger(spark, d):
    """Four loads are written, the last one dies before its ledger entry; rows join back to
    the entries by load id."""
    store = Store(spark, run_dir(spark, "ledger"))
    changes = s.with_loads(spark, d, s.consents(spark, d))
    entries = s.load_entries(spark, d).select("_load_id", "kind", "inserted_at").collect()
    schema = changes.select(*CONSENT_COLUMNS).schema

    def die():
        raise InterruptedError("stopped before the ledger entry")

    for e in sorted(entries, key=lambda r: r["_load_id"]):
        part = changes.filter(F.col("load_no") == int(e["_load_id"])).select(*CONSENT_COLUMNS)
        try:
            store.write(
                part,
                "patient_consents",
                e["_load_id"],
                e["inserted_at"],
                kind=e["kind"],
                before_commit=die if e["_load_id"] == "3" else None,
            )
        except InterruptedError:
            pass
    counted = (
        store.read_log("patient_consents", schema)
        .groupBy("_load_id")
        .agg(F.count(F.lit(1)).alias("n_joined"))
    )
    return (
        store.ledger("patient_consents")
        .join(counted, "_load_id", "left")
        .select(
            "_load_id", "kind", "status", "inserted_at", "rows_out", "min_lsn", "max_lsn", "n_joined"
        )
    )


@query(
    "load_status",
    sql("select status, count(*) n_loads from load_entries group by status", "load_entries"),
)
def load_status(spark, d):
    return st.load_status(s.load_entries(spark, d))


@query(
    "latest_load",
    sql(
        """select _load_id, inserted_at from load_entries
           where status = 0 and _load_id <> '1' order by inserted_at desc limit 1""",
        "load_entries",
    ),
)
def latest_load(spark, d):
    return st.latest_load(s.load_entries(spark, d), prior="1").select("_load_id", "inserted_at")


@query(
    "new_load_or_noop",
    sql(
        """select coalesce(max(_load_id), 'noop') run_id from (
               select _load_id from load_entries where status = 0 and _load_id <> '2'
               order by inserted_at desc limit 1)""",
        "load_entries",
    ),
)
def new_load_or_noop(spark, d):
    return st.new_load_or_noop(s.load_entries(spark, d), "2")


@query(
    "run_metrics",
    sql(
        f""", {ingest.TEXT_CONSENTS}
            select 'patient_consents' table_name, count(*) rows_in,
                   count(*) filter (where patient_id is not null and not bad_flag
                                      and not bad_lsn) rows_out,
                   count(*) filter (where patient_id is null or bad_flag or bad_lsn) rows_dropped
            from text_consents""",
        "consents",
    ),
)
def run_metrics(spark, d):
    """Rows in, out and dropped of an ingested batch, from its own ledger entry."""
    store = Store(spark, run_dir(spark, "metrics"))
    stream.ingest_batch(ingest.text_consents(spark, d), CONSENTS, store, "0", clock())
    return store.ledger("patient_consents").select(
        "table_name", "rows_in", "rows_out", "rows_dropped"
    )


@query(
    "txn_microbatches",
    sql(
        """, per_txn as (
               select txn, count(*) n_rows, min(lsn) min_lsn, max(lsn) commit_lsn
               from consents group by txn),
             placed as (
               select *, cast(coalesce(sum(n_rows) over (order by commit_lsn
                   rows between unbounded preceding and 1 preceding), 0) as bigint) n_before
               from per_txn)
           select txn, n_rows, min_lsn, commit_lsn, n_before // 1000 batch_no from placed""",
        "consents",
    ),
)
def txn_microbatches(spark, d):
    return feed.txn_batches(s.consents(spark, d))


# ---- streams -------------------------------------------------------------------------


def landed(spark: SparkSession, d: str, df: DataFrame, root: str):
    """Land a feed as files in log order and open it as a stream of about four batches."""
    files = max(4, spark.sparkContext.defaultParallelism)
    df.repartitionByRange(files, "lsn").sortWithinPartitions("lsn").write.parquet(f"{root}/landed")
    limits = {"maxFilesPerTrigger": str(-(-files // 4))}
    return stream.feed_stream(spark, f"{root}/landed", df.schema, limits)


def clock():
    return datetime(2024, 2, 1)


@query(
    "stream_merge_latest",
    sql(f"{LATEST_CONSENTS} select {CONSENT_LIST}, op from state", "consents"),
)
def stream_merge_latest(spark, d):
    """Keyed merge of a stream: each batch lands its newest rows, reading resolves keys."""
    root = run_dir(spark, "stream-latest")
    source = s.consents(spark, d).select(*STATE)
    store = Store(spark, root)
    spec = CONSENTS_LATEST
    changes = landed(spark, d, source, root)
    args = (changes, spec, store, f"{root}/cp")
    stream.run_to_end(stream.merge_stream(*args, keep=("op",), clock=clock))
    return store.read_state(spec, source.schema).select(*STATE)


CONSENTS_LATEST = CONSENTS.__class__(
    **{**CONSENTS.__dict__, "mode": "latest", "merge_key": ("patient_id",)}
)


def stream_log(spark: SparkSession, source: DataFrame, root: str, d: str, before_commit=None):
    store = Store(spark, root)
    changes = landed(spark, d, source, root)
    args = (changes, CONSENTS, store, f"{root}/cp")
    stream.run_to_end(stream.merge_stream(*args, clock=clock, before_commit=before_commit))
    return store.read_log("patient_consents", source.schema).select(*source.columns)


@query("stream_event_log", sql(f"select {CONSENT_LIST} from consents", "consents"))
def stream_event_log(spark, d):
    source = s.consents(spark, d).select(*CONSENT_COLUMNS)
    return stream_log(spark, source, run_dir(spark, "stream-log"), d)


@query("stream_replay_dedup", sql(f"select {CONSENT_LIST} from consents", "consents"))
def stream_replay_dedup(spark, d):
    """Every twentieth event is delivered again, later and in another file."""
    root = run_dir(spark, "stream-replay")
    source = s.consents(spark, d).select(*CONSENT_COLUMNS)
    source.filter("lsn % 20 = 1").repartition(4).write.parquet(f"{root}/landed")
    store = Store(spark, root)
    source.repartition(4).write.mode("append").parquet(f"{root}/landed")
    changes = stream.feed_stream(
        spark, f"{root}/landed", source.schema, {"maxFilesPerTrigger": "2"}
    )
    stream.run_to_end(stream.merge_stream(changes, CONSENTS, store, f"{root}/cp", clock=clock))
    return store.read_log("patient_consents", source.schema).select(*source.columns)


@query("stream_resume", sql(f"select {CONSENT_LIST} from consents", "consents"))
def stream_resume(spark, d):
    """The second batch dies between its data and its ledger entry; a restart on the same
    checkpoint finishes the work."""
    root = run_dir(spark, "stream-resume")
    source = s.consents(spark, d).select(*CONSENT_COLUMNS)

    def die(batch_id: int) -> None:
        if batch_id == 1:
            raise InterruptedError("stopped before the ledger entry")

    store = Store(spark, root)
    changes = landed(spark, d, source, root)
    first = stream.merge_stream(
        changes, CONSENTS, store, f"{root}/cp", clock=clock, before_commit=die
    )
    try:
        stream.run_to_end(first)
    except Exception as e:  # the injected failure comes back wrapped by the stream
        if "stopped before the ledger entry" not in str(e):
            raise
    stream.run_to_end(stream.merge_stream(changes, CONSENTS, store, f"{root}/cp", clock=clock))
    return store.read_log("patient_consents", source.schema).select(*source.columns)


KIND = "case op when 'I' then 'INSERT' when 'D' then 'DELETE' else 'UPDATE' end"
_SAME = " and ".join(
    ["(w.deleted_ts is null) = (t.deleted_ts is null)"]
    + [f"(w.deleted_ts is not null or w.{c} is not distinct from t.{c})" for c in FLAG_COLUMNS.split(", ")]
)
_SAME_PROVIDER = " and ".join(
    ["(w.deleted_ts is null) = (t.deleted_ts is null)"]
    + [f"(w.deleted_ts is not null or w.{c} is not distinct from t.{c})" for c in ("name", "specialty")]
)


def _compared(name: str, wanted: str, table: str, key: str, same: str) -> str:
    return f"""select '{name}' table_name, mutation, count(*) n_expected, count(t.{key}) n_observed,
                      count(*) filter (where t.{key} is not null and {same}) n_equal,
                      count(*) = count(*) filter (where t.{key} is not null and {same}) ok
               from {wanted} w left join {table} t using ({key}) group by mutation"""


@query(
    "propagation_report",
    sql(
        f"""{LATEST_CONSENTS}, wanted as (
             select *, {KIND} mutation from (
               select *, row_number() over (partition by patient_id order by lsn desc) rn
               from consents where load_no = 3) where rn = 1),
           logged as (select *, {KIND} mutation from consents where load_no = 3),
           lossy as (select * from consents where load_no < 3 or lsn % 7 <> 0),
           stale as (select * from (
               select *, row_number() over (partition by patient_id order by lsn desc) rn from lossy) where rn = 1),
           moves as (select *, {KIND} mutation from (
               select *, row_number() over (partition by provider_id order by lsn desc) rn
               from provider_changes where load_no = 3) where rn = 1)
           {LATEST_PROVIDERS}
           {_compared('patient_consents_latest', 'wanted', 'state', 'patient_id', _SAME)}
           union all {_compared('patient_consents_stale', 'wanted', 'stale', 'patient_id', _SAME)}
           union all {_compared('patient_consents', 'logged', 'consents', 'lsn', _SAME)}
           union all {_compared('providers', 'moves', 'providers_state', 'provider_id', _SAME_PROVIDER)}""",
        "consents",
        "providers",
        "provider_changes",
    ),
)
def propagation_report(spark, d):
    """After load 3, every change of it shows with its values in state and log; a state that
    lost every seventh change of the load doesn't pass."""
    changes = s.with_loads(spark, d, s.consents(spark, d)).select(*STATE, "load_no")
    before = changes.filter("load_no < 3").drop("load_no")
    batch = changes.filter("load_no = 3").drop("load_no")
    named = (
        F.when(F.col("op") == "D", "DELETE").when(F.col("op") == "I", "INSERT").otherwise("UPDATE")
    ).alias("mutation")
    moves = s.with_loads(spark, d, s.provider_changes(spark, d)).select(
        *PROVIDER_COLUMNS, "op", "load_no"
    )
    first = snapshot.snapshot(lambda: s.providers(spark, d), PROVIDERS)
    earlier = merge.merge_latest(first, moves.filter("load_no < 3").drop("load_no", "op"), PROVIDERS.key)
    newest = moves.filter("load_no = 3").drop("load_no")
    flags, who = FLAG_COLUMNS.split(", "), ["patient_id"]
    wanted = merge.latest_per_key(batch, who).select(named, "*")
    last_moves = merge.latest_per_key(newest, PROVIDERS.key).select(named, "*")
    state = merge.merge_latest(before, batch, who)
    stale = merge.merge_latest(before, batch.filter("lsn % 7 <> 0"), who)
    log = merge.event_log_merge(before, batch)
    current = merge.merge_latest(earlier, newest.drop("op"), PROVIDERS.key)
    return report.report(
        [
            report.propagation(state, "patient_consents_latest", wanted, who, flags),
            report.propagation(stale, "patient_consents_stale", wanted, who, flags),
            report.propagation(log, "patient_consents", batch.select(named, "*"), ["lsn"], flags),
            report.propagation(current, "providers", last_moves, PROVIDERS.key, ["name", "specialty"]),
        ]
    )


@query(
    "stream_whole_transactions",
    sql(
        """, per_txn as (
               select txn, count(*) n_rows, min(lsn) min_lsn, max(lsn) commit_lsn from consents group by txn),
             placed as (
               select *, cast(coalesce(sum(n_rows) over (order by commit_lsn
                   rows between unbounded preceding and 1 preceding), 0) as bigint) n_before
               from per_txn)
           select min(min_lsn) min_lsn, max(commit_lsn) max_lsn, cast(sum(n_rows) as bigint) n_rows,
                  count(*) n_txns, count(*) n_whole
           from placed, (select (max(event_id) + 1) // 4 + 1 target from events)
           group by n_before // target""",
        "consents",
    ),
)
def stream_whole_transactions(spark, d):
    """Files are cut at commits, so no load of a stream holds a part of a transaction."""
    root = run_dir(spark, "stream-txn")
    source = s.consents(spark, d).select(*CONSENT_COLUMNS, "txn")
    target = s.table(spark, d, "events").agg(F.floor((F.max("event_id") + 1) / 4) + 1).first()[0]
    landing.land_transactions(source, f"{root}/landed", target)
    changes = stream.feed_stream(spark, f"{root}/landed", source.schema, {"maxFilesPerTrigger": "1"})
    store = Store(spark, root)
    stream.run_to_end(stream.merge_stream(changes, CONSENTS, store, f"{root}/cp", keep=("txn",), clock=clock))
    log = store.read_log("patient_consents", source.schema)
    parts = log.groupBy("_load_id", "txn").agg(
        F.min("lsn").alias("lo"), F.max("lsn").alias("hi"), F.count(F.lit(1)).alias("n")
    )
    sizes = source.groupBy("txn").agg(F.count(F.lit(1)).alias("all"))
    return (
        parts.join(sizes, "txn")
        .groupBy("_load_id")
        .agg(
            F.min("lo").alias("min_lsn"), F.max("hi").alias("max_lsn"), F.sum("n").alias("n_rows"),
            F.count(F.lit(1)).alias("n_txns"), F.count_if(F.col("n") == F.col("all")).alias("n_whole"),
        )
        .drop("_load_id")
    )


# ---- whole runs ----------------------------------------------------------------------


@query(
    "ingest_run",
    sql(
        """, faulty as (select *, lsn % 41 = 0 bad from patients)
           select 'raw' part, patient_id, primary_provider_id, postcode, updated_at, lsn,
                  cast(null as bigint) n
           from faulty where not bad
           union all
           select 'quarantine', '', null, null, null, lsn, null from faulty where bad
           union all
           select part, null, null, null, null, null, n from (
               select 'rows_in' part, count(*) n from faulty
               union all select 'rows_out', count(*) from faulty where not bad
               union all select 'rows_dropped', count(*) from faulty where bad)""",
        "patients",
    ),
)
def ingest_run(spark, d):
    """A feed with a column to strip and rows without a subject goes through the one ingest
    path as a stream: raw rows, quarantine, and the ledger's sums."""
    root = run_dir(spark, "ingest-run")
    feed_rows = s.patients(spark, d)
    key = F.when(F.col("lsn") % 41 != 0, F.col("patient_id"))
    changes = landed(spark, d, feed_rows.withColumn("patient_id", key), root)
    store = Store(spark, root)
    stream.run_tables({"patients": changes}, {"patients": PATIENTS}, store, f"{root}/cp")
    raw = store.read_log("patients", PATIENTS.raw_schema)
    bad = store.read_log("patients_quarantine", QUARANTINE)
    sums = store.ledger("patients").agg(*[F.sum(c).alias(c) for c in COUNTS])
    columns = ("patient_id", "primary_provider_id", "postcode", "updated_at", "lsn")
    none = {c: F.lit(None).cast(raw.schema[c].dataType).alias(c) for c in columns}
    no_n = F.lit(None).cast("long").alias("n")
    return (
        raw.select(F.lit("raw").alias("part"), *columns, no_n)
        .unionAll(
            bad.select(
                F.lit("quarantine"), "entity_id", *[none[c] for c in columns[1:-1]], "lsn", no_n
            )
        )
        .unionAll(
            sums.select(
                F.explode(F.create_map(*[x for c in COUNTS for x in (F.lit(c), F.col(c))])).alias("part", "n")
            ).select("part", *none.values(), "n")
        )
    )


COUNTS = ("rows_in", "rows_out", "rows_dropped")
QUARANTINE = T.StructType(
    [
        T.StructField("table_name", T.StringType()),
        T.StructField("entity_id", T.StringType()),
        T.StructField("reasons", T.ArrayType(T.StringType())),
        T.StructField("lsn", T.LongType()),
    ]
)


@query(
    "log_shared_position",
    sql(
        """select patient_id, lsn // 3 lsn, lsn seq, consent_research from consents""",
        "consents",
    ),
)
def log_shared_position(spark, d):
    """Three events share each position; ``seq`` tells them apart, in redeliveries too."""
    events = s.consents(spark, d).selectExpr(
        "patient_id", "lsn div 3 lsn", "lsn seq", "consent_research"
    )
    log = merge.event_log_merge(events.filter("seq % 2 = 0"), events)
    return merge.event_log_merge(log, events.filter("seq % 5 = 0"))


@query(
    "merge_null_keys",
    sql(
        """, k as (select case when lsn % 37 <> 0 then patient_id end patient_id, lsn from consents)
           select patient_id, lsn from (
               select *, row_number() over (partition by patient_id order by lsn desc) rn from k)
           where rn = 1 or patient_id is null""",
        "consents",
    ),
)
def merge_null_keys(spark, d):
    """Rows without a key match nothing and all stay."""
    rows = s.consents(spark, d).select(
        F.when(F.col("lsn") % 37 != 0, F.col("patient_id")).alias("patient_id"), "lsn"
    )
    return merge.latest_per_key(rows, ["patient_id"])


@query(
    "snapshot_then_changes",
    sql(
        f""", mark as (select (max(event_id) + 1) // 2 m from events),
             early as (select *, row_number() over (partition by patient_id order by lsn desc) rn
                       from consents, mark where lsn <= m)
           select patient_id, {FLAG_COLUMNS}, cast(null as bigint) lsn from early
           where rn = 1 and deleted_ts is null
           union all
           select patient_id, {FLAG_COLUMNS}, lsn from consents, mark where lsn > m""",
        "consents",
    ),
)
def snapshot_then_changes(spark, d):
    """A snapshot lands once, by the store's own ledger; changes follow from its position
    on, although the feed delivers all of them: no gap, no overlap."""
    root = run_dir(spark, "hand-over")
    changes = s.consents(spark, d)
    mark = s.table(spark, d, "events").agg(F.floor((F.max("event_id") + 1) / 2)).first()[0]
    seen = merge.latest_per_key(changes.filter(F.col("lsn") <= mark), ["patient_id"])
    copy = merge.live_rows(seen).select(*CONSENTS.columns)
    store = Store(spark, root)
    store.bootstrap(copy, CONSENTS, clock())
    store.bootstrap(copy, CONSENTS, clock())
    later = snapshot.after_snapshot(changes.select(*CONSENT_COLUMNS), mark)
    stream.ingest_batch(later, CONSENTS, store, "0", clock())
    log = store.read_log("patient_consents", CONSENTS.raw_schema)
    return log.select(*CONSENTS.columns, "lsn")


@query(
    "erasure_run",
    sql(
        """, asked as (select concat('PT', cast(c_custkey as varchar)) patient_id,
                              c_custkey % 50 = 1 done
                       from customer where c_custkey % 50 in (0, 1))
           select 'kept' part, patient_id, lsn, cast(null as bigint) n from consents
           where patient_id not in (select patient_id from asked)
           union all
           select 'removed', null, null, 2 * count(*) from consents
           where patient_id in (select patient_id from asked where not done)
           union all
           select 'left in landed files', null, null, count(*) from consents
           where patient_id not in (select patient_id from asked where not done)
           union all
           select 'open requests', null, null, 0""",
        "consents",
    ),
)
def erasure_run(spark, d):
    """Pending requests are carried out over loads, quarantine and landed feed files and
    stamped, in two lists under one id; events of erased subjects that are delivered
    afterwards don't land, the stream goes on, and a further run does nothing."""
    store = Store(spark, run_dir(spark, "erasure-run"))
    requests = s.erasure_requests(spark, d)
    changes = s.consents(spark, d).select(*CONSENT_COLUMNS)
    half = F.col("lsn") % 2 == 0
    feed_files = f"{store.root}/landed"
    changes.filter(half).repartitionByRange(4, "lsn").write.parquet(feed_files)

    def consume(erased: DataFrame) -> None:
        arrived = stream.feed_stream(spark, feed_files, changes.schema)
        args = (arrived, CONSENTS, store, f"{store.root}/cp")
        stream.run_to_end(stream.merge_stream(*args, clock=clock, erased=erased))

    consume(requests)
    tables = {
        "patient_consents": (CONSENTS.raw_schema, "patient_id"),
        "patient_consents_quarantine": (QUARANTINE, "entity_id"),
    }
    files = {feed_files: "patient_id"}
    odd = F.col("erased_at").isNotNull() | (F.pmod(F.xxhash64("patient_id"), F.lit(2)) == 1)
    stamped, removed = store.erase_subjects(requests.filter(odd), tables, "e0", clock(), landed=files)
    others, more = store.erase_subjects(requests.filter(~odd), tables, "e0", clock(), landed=files)
    stamped = stamped.unionAll(others)
    changes.filter(~half).repartitionByRange(4, "lsn").write.mode("append").parquet(feed_files)
    consume(stamped)
    _, rest = store.erase_subjects(requests, tables, "e0", clock(), landed=files)
    late = changes.withColumn("lsn", F.col("lsn") + 1_000_000_000)
    late = late.join(requests.select("patient_id"), "patient_id", "left_semi").select(*changes.columns)
    stream.ingest_batch(late, CONSENTS, store, "2", clock(), erased=stamped)
    _, again = store.erase_subjects(stamped, tables, "e1", clock())
    log = store.read_log("patient_consents", CONSENTS.raw_schema)
    none = F.lit(None)
    counts = stamped.filter("erased_at is null").agg(F.count(F.lit(1)).alias("n"))
    # Of events that came before the requests loads and files lose a row each; the others
    # never land, so only their files do: counted once more for the loads.
    held_back = changes.filter(~half).join(requests.filter("erased_at is null"), "patient_id", "left_semi").count()
    total = sum(sum(x.values()) for x in (removed, more, rest, again)) + held_back
    left = spark.read.parquet(feed_files).agg(F.count(F.lit(1)).alias("n"))
    return (
        log.select(F.lit("kept").alias("part"), "patient_id", "lsn", none.cast("long").alias("n"))
        .unionAll(
            spark.range(1).select(F.lit("removed"), none.cast("string"), none.cast("long"), F.lit(total).cast("long"))
        )
        .unionAll(left.select(F.lit("left in landed files"), none.cast("string"), none.cast("long"), "n"))
        .unionAll(counts.select(F.lit("open requests"), none.cast("string"), none.cast("long"), "n"))
    )
