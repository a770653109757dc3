"""Queries over validity windows, point-in-time lookups, consent and collapses."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidelog.operators import consent, history, merge
from tidelog.operators.validate import strip_columns
from tidelog.plans import standins as s
from tidelog.plans.ingest import CONSENT_COLUMNS, CONSENT_LIST
from tidelog.plans.merges import LATEST_PROVIDERS, PROVIDER_LIST, provider_state
from tidelog.plans.registry import query
from tidelog.plans.standins import sql
from tidelog.sources import feed
from tidelog.spec import PATIENTS

FLAGS = ["consent_research", "consent_marketing", "consent_partner_share"]
FLAG_LIST = ", ".join(FLAGS)

CURRENT = """
    , granted as (
        select patient_id from (
            select *, row_number() over (partition by patient_id order by lsn desc) rn
            from consents)
        where rn = 1 and deleted_ts is null and consent_research)"""
PRECISE = f"""
    , windows as (
        select patient_id, lsn, {FLAG_LIST}, deleted_ts, commit_ts valid_from,
               lead(commit_ts) over (partition by patient_id order by lsn) valid_to
        from consents)"""


@query(
    "scd2_consents",
    sql(
        f""", log as (
                select {CONSENT_LIST}, load_no from consents
                union all
                select {CONSENT_LIST}, 0 from consent_snapshot),
              timed as (
                select log.*, e.inserted_at valid_from
                from log left join load_entries e on e._load_id = cast(load_no as varchar))
            select patient_id, lsn, {FLAG_LIST}, deleted_ts, valid_from,
                   coalesce(deleted_ts, lead(valid_from) over (
                       partition by patient_id order by lsn asc nulls first)) valid_to
            from timed""",
        "consents",
        "consent_snapshot",
        "load_entries",
    ),
)
def scd2_consents(spark, d):
    changes = s.with_loads(spark, d, s.consents(spark, d)).select(*CONSENT_COLUMNS, "load_no")
    first = s.consent_snapshot(spark, d).withColumn("load_no", F.lit(0).cast("bigint"))
    log = changes.unionByName(first).withColumn("_load_id", F.col("load_no").cast("string"))
    windows = history.scd2_by_load(log, s.load_entries(spark, d), "patient_id")
    return windows.select(*CONSENT_COLUMNS, "valid_from", "valid_to")


@query(
    "scd2_precise",
    sql(
        f"""{PRECISE} select patient_id, lsn, {FLAG_LIST}, valid_from, valid_to
            from windows where deleted_ts is null""",
        "consents",
    ),
)
def scd2_precise(spark, d):
    return history.scd2_precise(s.consents(spark, d), "patient_id").select(
        "patient_id", "lsn", *FLAGS, "valid_from", "valid_to"
    )


@query(
    "consent_as_of",
    sql(
        f"""{PRECISE} select patient_id, lsn, {FLAG_LIST} from windows
            where deleted_ts is null and valid_from <= timestamp '2024-01-15 12:00:00'
              and (valid_to is null or valid_to > timestamp '2024-01-15 12:00:00')""",
        "consents",
    ),
)
def consent_as_of(spark, d):
    """The rows in force at one instant."""
    t = F.lit("2024-01-15 12:00:00").cast("timestamp_ntz")
    log = s.consents(spark, d)
    return history.state_at(log, "patient_id", t).select("patient_id", "lsn", *FLAGS)


@query(
    "fact_consent_as_of",
    """with facts as (
           select o_orderkey fact_id, concat('PT', cast(o_custkey as varchar)) patient_id,
                  o_custkey, timestamp '2024-01-01 00:00:00'
                    + to_hours(cast(o_orderkey % 720 as integer)) fact_at
           from orders),
       ev as (
           select user_id, event_id, ts, event_type = 'error' gone,
                  cast(json_extract(props, '$.k') as bigint) k
           from events)
       select fact_id, patient_id, fact_at,
              case when not gone then k % 2 = 0 end consent_research
       from facts asof left join ev on user_id = o_custkey and ts <= fact_at""",
)
def fact_consent_as_of(spark, d):
    """For every fact the consent in force at the fact's own time."""
    hours = F.make_dt_interval(F.lit(0), (F.col("o_orderkey") % 720).cast("int"))
    start = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    facts = s.table(spark, d, "orders").select(
        F.col("o_orderkey").alias("fact_id"),
        s.tag("PT", F.col("o_custkey")).alias("patient_id"),
        (start + hours).alias("fact_at"),
    )
    return history.value_as_of(
        facts, s.consents(spark, d), "patient_id", "fact_at", "commit_ts", ["consent_research"]
    )


@query(
    "consented_facts",
    sql(
        f"""{CURRENT} select event_id, patient_id, provider_id, status, event_timestamp, part
            from appointments where patient_id in (select patient_id from granted)""",
        "consents",
        "appointments",
    ),
)
def consented_facts(spark, d):
    facts = s.appointments(spark, d).select(
        "event_id", "patient_id", "provider_id", "status", "event_timestamp", "part"
    )
    return consent.consented(facts, s.consents(spark, d), "consent_research")


@query(
    "status_collapse",
    sql(
        """select appointment_id, event_id, status, event_timestamp from (
               select *, row_number() over (partition by appointment_id
                   order by event_timestamp desc, part desc, provider_id desc, event_id desc) rn
               from appointments) where rn = 1""",
        "appointments",
    ),
)
def status_collapse(spark, d):
    ties = ("part", "provider_id", "event_id")
    last = history.status_collapse(
        s.appointments(spark, d), "appointment_id", "event_timestamp", ties
    )
    return last.select("appointment_id", "event_id", "status", "event_timestamp")


SCD1 = """
    , patients_current as (
        select patient_id, primary_provider_id, postcode, updated_at, lsn from (
            select *, row_number() over (partition by patient_id
                                         order by updated_at desc nulls last, lsn desc) rn
            from patients) where rn = 1)"""


@query(
    "scd1_collapse",
    sql(
        f"""{SCD1} select patient_id, primary_provider_id, postcode, updated_at, lsn
            from patients_current""",
        "patients",
    ),
)
def scd1_collapse(spark, d):
    stripped = strip_columns(s.patients(spark, d), PATIENTS)
    return history.scd1_collapse(stripped, "patient_id")


@query(
    "status_transitions",
    """with placed as (
           select lag(o_orderstatus) over (partition by o_custkey
                      order by o_orderdate, o_orderkey) from_status,
                  o_orderstatus to_status
           from orders)
       select from_status, to_status, count(*) n from placed group by all""",
)
def status_transitions(spark, d):
    orders = s.table(spark, d, "orders")
    return history.status_transitions(
        orders, "o_custkey", "o_orderdate", "o_orderstatus", ("o_orderkey",)
    )


@query(
    "serve_obt",
    sql(
        f"""{CURRENT} {SCD1} {LATEST_PROVIDERS}, facts as (
                select event_id, patient_id, provider_id, status, event_timestamp from (
                    select *, row_number() over (partition by event_id
                        order by event_timestamp desc, part desc, provider_id desc) rn
                    from appointments) where rn = 1)
            select f.event_id, f.patient_id, f.provider_id, f.status, f.event_timestamp,
                   p.specialty provider_specialty, c.primary_provider_id, c.postcode
            from facts f
            left join providers_state p on p.provider_id = f.provider_id
            left join patients_current c on c.patient_id = f.patient_id
            where f.patient_id in (select patient_id from granted)""",
        "consents",
        "appointments",
        "patients",
        "providers",
        "provider_changes",
    ),
)
def serve_obt(spark, d):
    order = [F.col(c).desc_nulls_last() for c in s.APPOINTMENT_TIES]
    facts = merge.latest_per_key(s.appointments(spark, d), ["event_id"], order=order).select(
        "event_id", "patient_id", "provider_id", "status", "event_timestamp"
    )
    people = history.scd1_collapse(strip_columns(s.patients(spark, d), PATIENTS), "patient_id")
    return consent.serving_table(
        facts, provider_state(spark, d), people, s.consents(spark, d), "consent_research"
    )


@query(
    "incremental_lag_scan",
    sql(
        """select patient_id, postcode, updated_at, lsn from (
               select *, row_number() over (partition by lsn order by updated_at desc) rn
               from patients
               where updated_at > (select max(o_orderdate) from orders) - interval 200 day)
           where rn = 1""",
        "patients",
    ),
)
def incremental_lag_scan(spark, d):
    """Re-read a lag window before the cursor; rows seen twice collapse on their key."""
    last = s.table(spark, d, "orders").agg(F.max("o_orderdate")).scalar()
    both = s.patients(spark, d).select("patient_id", "postcode", "updated_at", "lsn")
    twice = both.unionByName(both.filter("lsn % 3 = 0"))
    return feed.lag_scan(twice, "updated_at", last, "200 day", ["lsn"])


@query(
    "coverage_gap",
    sql(
        """select patient_id from patients
           except select patient_id from consents""",
        "patients",
        "consents",
    ),
)
def coverage_gap(spark, d):
    from tidelog.operators.profile import key_difference

    return key_difference(s.patients(spark, d), s.consents(spark, d), "patient_id")


@query(
    "nth_key",
    sql(
        """select event_id from (select distinct event_id from appointments
               where event_id not like 'SMOKE_%') order by event_id limit 1 offset 1""",
        "appointments",
    ),
)
def nth_key(spark, d):
    from tidelog.operators.staging import exclude_prefix

    keys = exclude_prefix(s.appointments(spark, d), "event_id", "SMOKE_%").select("event_id")
    return feed.nth_row(keys.distinct(), ["event_id"], 1)
