"""Profiling queries over the four tables."""

from __future__ import annotations

from tidelog.operators import profile, quality
from tidelog.operators.validate import strip_columns
from tidelog.plans import standins as s
from tidelog.plans.registry import query
from tidelog.plans.standins import sql
from tidelog.spec import PATIENTS

FLAGS = ("consent_research", "consent_marketing", "consent_partner_share")
APPOINTMENT_COLUMNS = [
    "appointment_id",
    "patient_id",
    "provider_id",
    "scheduled_at",
    "status",
    "event_timestamp",
    "ingested_at",
]
PATIENT_COLUMNS = ["patient_id", "primary_provider_id", "postcode", "updated_at"]


def _pct(part: str, whole: str, scale: int = 100) -> str:
    return (
        f"case when {whole} > 0 then cast(({part} * {scale * 200} + {whole}) // ({whole} * 2) "
        "as bigint) / 100.0 end"
    )


def _as_double(expr: str) -> str:
    return f"cast({expr} as double)"


@query(
    "profile_null_rates",
    sql(
        " union all ".join(
            f"""select '{c}' column_name, count(*) - count({c}) n_null,
                       {_as_double(_pct(f'(count(*) - count({c}))', 'count(*)'))} pct_null
                from patients"""
            for c in ["name", *PATIENT_COLUMNS]
        ),
        "patients",
    ),
)
def profile_null_rates(spark, d):
    return profile.null_rates(s.patients(spark, d), ["name", *PATIENT_COLUMNS])


@query(
    "profile_duplicates",
    sql(
        f"""select total_rows, distinct_keys, total_rows - distinct_keys duplicate_rows,
                   {_as_double(_pct('(total_rows - distinct_keys)', 'total_rows'))} pct_duplicate,
                   distinct_ids,
                   {_as_double(_pct('total_rows', 'distinct_ids', 1))} avg_per_id
            from (select count(*) total_rows, count(distinct event_id) distinct_keys,
                         count(distinct appointment_id) distinct_ids from appointments)""",
        "appointments",
    ),
)
def profile_duplicates(spark, d):
    return profile.duplicates(s.appointments(spark, d), "event_id", "appointment_id")


@query(
    "profile_dup_nature",
    sql(
        """, fed as (
               select patient_id, lsn, op, consent_research from consents
               union all
               select patient_id, lsn, op, consent_research from consents where lsn % 20 = 1
               union all
               select patient_id, lsn, 'X', consent_research from consents where lsn % 30 = 1),
             per_key as (
               select lsn, count(*) n, count(distinct concat_ws('|', patient_id, op,
                      coalesce(cast(consent_research as varchar), '-'))) c
               from fed group by lsn having count(*) > 1)
           select case when c = 1 then 'exact_redelivery' else 'content_collision' end nature,
                  count(*) n_keys, cast(sum(n) as bigint) n_rows
           from per_key group by 1""",
        "consents",
    ),
)
def profile_dup_nature(spark, d):
    """Some events arrive again unchanged, others under the same position with another
    content."""
    from pyspark.sql import functions as F

    one = s.consents(spark, d).select("patient_id", "lsn", "op", "consent_research")
    fed = one.unionByName(one.filter("lsn % 20 = 1")).unionByName(
        one.filter("lsn % 30 = 1").withColumn("op", F.lit("X"))
    )
    return profile.duplicate_nature(fed, "lsn", ["patient_id", "op", "consent_research"])


@query(
    "profile_events_per_id",
    sql(
        """select appointment_id, count(distinct event_id) n_events from appointments
           group by appointment_id having count(distinct event_id) > 1""",
        "appointments",
    ),
)
def profile_events_per_id(spark, d):
    return profile.events_per_id(s.appointments(spark, d), "appointment_id", "event_id")


@query(
    "profile_value_counts",
    sql("select status, count(*) n_rows from appointments group by status", "appointments"),
)
def profile_value_counts(spark, d):
    return profile.value_counts(s.appointments(spark, d), "status")


@query(
    "profile_count_of_counts",
    sql(
        """select n group_size, count(*) n_groups
           from (select count(*) n from appointments group by appointment_id) group by n""",
        "appointments",
    ),
)
def profile_count_of_counts(spark, d):
    return profile.count_of_counts(s.appointments(spark, d), "appointment_id")


TIMES = ["scheduled_at", "event_timestamp", "ingested_at"]


@query(
    "profile_time_coverage",
    sql(
        " union all ".join(
            f"""select '{c}' column_name, min({c}) first_ts, max({c}) last_ts,
                       count(*) - count({c}) n_null from appointments"""
            for c in TIMES
        ),
        "appointments",
    ),
)
def profile_time_coverage(spark, d):
    return profile.time_coverage(s.appointments(spark, d), TIMES)


@query(
    "profile_history_stats",
    sql(
        f"""select total_rows, entities, with_history, max_rows,
                   {_as_double(_pct('total_rows', 'entities', 1))} mean_rows
            from (select cast(sum(n) as bigint) total_rows, count(*) entities,
                         count(*) filter (where n > 1) with_history, max(n) max_rows
                  from (select count(*) n from patients group by patient_id))""",
        "patients",
    ),
)
def profile_history_stats(spark, d):
    return profile.history_stats(s.patients(spark, d), "patient_id")


@query(
    "profile_composite_key",
    sql(
        """select cast(sum(n) as bigint) total_rows, count(*) distinct_combinations,
                  cast(sum(n) - count(*) as bigint) duplicate_rows, max(n) = 1 is_unique
           from (select count(*) n from patients group by patient_id, updated_at)""",
        "patients",
    ),
)
def profile_composite_key(spark, d):
    stripped = strip_columns(s.patients(spark, d), PATIENTS)
    return profile.composite_key(stripped, ["patient_id", "updated_at"])


@query(
    "profile_pk_unique",
    sql(
        """select count(*) n_rows, count(distinct provider_id) n_keys,
                  count(*) = count(distinct provider_id) pk_unique from providers""",
        "providers",
    ),
)
def profile_pk_unique(spark, d):
    return profile.pk_unique(s.providers(spark, d), "provider_id")


@query(
    "profile_flags",
    sql(
        " union all ".join(
            f"""select '{c}' flag, t n_true, f n_false, n n_null,
                       {_as_double(_pct('t', '(t + f)'))} pct_true
                from (select count(*) filter (where {c}) t, count(*) filter (where not {c}) f,
                             count(*) filter (where {c} is null) n from consents)"""
            for c in FLAGS
        ),
        "consents",
    ),
)
def profile_flags(spark, d):
    return profile.flags(s.consents(spark, d), FLAGS)


@query(
    "profile_coverage",
    sql(
        f""", keys as (
                select p.patient_id, c.patient_id has from (select distinct patient_id from patients) p
                left join (select distinct patient_id from consents) c using (patient_id))
            select needed, covered, needed - covered missing,
                   {_as_double(_pct('covered', 'needed'))} pct_covered
            from (select count(*) needed, count(has) covered from keys)""",
        "patients",
        "consents",
    ),
)
def profile_coverage(spark, d):
    return profile.coverage(s.consents(spark, d), s.patients(spark, d), "patient_id")


@query(
    "dup_key_probe",
    sql(
        """select event_id, count(*) n_rows from appointments
           group by event_id having count(*) > 1""",
        "appointments",
    ),
)
def dup_key_probe(spark, d):
    return quality.duplicate_keys(s.appointments(spark, d), ["event_id"])
