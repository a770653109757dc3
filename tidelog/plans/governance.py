"""Queries over data quality, referential checks and erasure."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog.operators import erasure, quality, validate
from tidelog.operators.merge import latest_per_key
from tidelog.operators.validate import strip_columns
from tidelog.plans import standins as s
from tidelog.plans.ingest import CONSENT_COLUMNS, CONSENT_LIST, union
from tidelog.plans.registry import query
from tidelog.plans.standins import sql
from tidelog.spec import APPOINTMENTS, CONSENTS, PATIENTS, SPECS, Rule


def tables(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    """The four raw tables; the appointments still hold their repeated deliveries."""
    return {
        "providers": s.providers(spark, d),
        "patients": strip_columns(s.patients(spark, d), PATIENTS),
        "appointments": s.appointments(spark, d),
        "patient_consents": s.consents(spark, d),
    }


TABLES = ("providers", "patients", "appointments", "consents")


def _status(severity: str, n: str = "failures") -> str:
    bad = "'fail'" if severity == "error" else "'warn'"
    return f"case when {n} = 0 then 'pass' else {bad} end"


def _nulls(table: str, source: str, columns) -> str:
    return " union all ".join(
        f"""select '{table}' table_name, 'not_null' test, '{c}' column_name, 'error' severity,
                   count(*) failures from {source} where {c} is null"""
        for c in columns
    )


def _unique(table: str, source: str, column: str, severity: str) -> str:
    return f"""select '{table}' table_name, 'unique' test, '{column}' column_name,
                      '{severity}' severity, count(*) failures
               from (select {column} from {source} where {column} is not null
                     group by {column} having count(*) > 1)"""


def _related(table, source, fk, parent, pk, severity) -> str:
    return f"""select '{table}' table_name, 'relationships' test, '{fk}' column_name,
                      '{severity}' severity, count(*) failures
               from {source} c where {fk} is not null
                 and not exists (select 1 from {parent} p where p.{pk} = c.{fk})"""


def _with_status(body: str) -> str:
    return f"""select table_name, test, column_name, severity, failures,
                      case when failures = 0 then 'pass' when severity = 'error' then 'fail'
                           else 'warn' end status from ({body})"""


NOT_NULL_SQL = " union all ".join(
    [
        _nulls("appointments", "appointments", APPOINTMENTS.required),
        _nulls("patients", "patients", PATIENTS.columns),
    ]
)


@query("dq_not_null", sql(_with_status(NOT_NULL_SQL), "appointments", "patients"))
def dq_not_null(spark, d):
    t = tables(spark, d)
    return quality.not_null(t["appointments"], "appointments", APPOINTMENTS.required).unionByName(
        quality.not_null(t["patients"], "patients", PATIENTS.columns)
    )


UNIQUE_SQL = " union all ".join(
    [
        _unique("providers", "providers", "provider_id", "error"),
        _unique("appointments", "appointments", "event_id", "warn"),
        _unique("patient_consents", "consents", "lsn", "error"),
        _unique("erasure_requests", "erasure_requests", "patient_id", "error"),
    ]
)


@query(
    "dq_unique",
    sql(
        _with_status(UNIQUE_SQL), "providers", "appointments", "consents", "erasure_requests"
    ),
)
def dq_unique(spark, d):
    t = tables(spark, d)
    return union(
        [
            quality.unique(t["providers"], "providers", ["provider_id"]),
            quality.unique(t["appointments"], "appointments", ["event_id"], "warn"),
            quality.unique(t["patient_consents"], "patient_consents", ["lsn"]),
            quality.unique(s.erasure_requests(spark, d), "erasure_requests", ["patient_id"]),
        ]
    )


RELATED_SQL = " union all ".join(
    [
        _related("appointments", "appointments", "patient_id", "patients", "patient_id", "warn"),
        _related("appointments", "appointments", "provider_id", "providers", "provider_id", "error"),
        _related("patients", "patients", "primary_provider_id", "providers", "provider_id", "error"),
        _related("patient_consents", "consents", "patient_id", "patients", "patient_id", "warn"),
    ]
)


@query("dq_relationships", sql(_with_status(RELATED_SQL), *TABLES))
def dq_relationships(spark, d):
    t = tables(spark, d)
    parts = []
    for spec in SPECS.values():
        for fk in spec.foreign_keys:
            parts.append(
                quality.relationships(
                    t[spec.name],
                    spec.name,
                    fk.column,
                    t[fk.parent],
                    fk.parent_column,
                    fk.severity,
                    fk.where,
                )
            )
    return union(parts)


SUMMARY_SQL = " union all ".join(
    [
        _nulls("providers", "providers", ("provider_id", "name")),
        _nulls("patients", "patients", PATIENTS.required),
        _nulls("appointments", "appointments", APPOINTMENTS.required),
        _nulls("patient_consents", "consents", CONSENTS.required),
        _unique("providers", "providers", "provider_id", "error"),
        _unique("patients", "patients", "patient_id", "warn"),
        _unique("appointments", "appointments", "event_id", "error"),
        _unique("patient_consents", "consents", "patient_id", "warn"),
        RELATED_SQL,
    ]
)


@query(
    "dq_summary",
    sql(
        f"""select severity, status, count(*) n_tests, cast(sum(failures) as bigint) n_failures
            from ({_with_status(SUMMARY_SQL)}) group by severity, status""",
        *TABLES,
    ),
)
def dq_summary(spark, d):
    """All tests the contracts imply, rolled up by severity and outcome."""
    t = tables(spark, d)
    results = quality.spec_tests(t, list(SPECS.values()))
    return results.groupBy("severity", "status").agg(
        F.count(F.lit(1)).alias("n_tests"), F.sum("failures").alias("n_failures")
    )


@query(
    "dq_where",
    sql(
        _with_status(
            """select 'patients' table_name, 'not_null' test, 'primary_provider_id' column_name,
                      'error' severity, count(*) failures
               from patients where lsn % 10 = 3 and primary_provider_id is null
               union all
               select 'patient_consents', 'unique', 'patient_id', 'warn', count(*) from (
                   select patient_id from consents where op = 'I' and patient_id is not null
                   group by patient_id having count(*) > 1)"""
        ),
        "patients",
        "consents",
    ),
)
def dq_where(spark, d):
    """Tests of some of the rows."""
    t = tables(spark, d)
    return quality.not_null(
        s.patients(spark, d), "patients", ["primary_provider_id"], where="lsn % 10 = 3"
    ).unionByName(
        quality.unique(t["patient_consents"], "patient_consents", ["patient_id"], "warn", where="op = 'I'")
    )


@query(
    "row_rules",
    sql(
        """, judged as (select *, part % 13 = 0 odd, scheduled_at > event_timestamp late from appointments)
           select reason, count(*) n_rows from (
               select 'rule known part' reason from judged where odd
               union all select 'rule seen after it was scheduled' from judged where late)
           group by reason
           union all select 'accepted', count(*) from judged where not odd and not late""",
        "appointments",
    ),
)
def row_rules(spark, d):
    """Two rules of a contract; faulty rows are set aside under the rules' names."""
    rules = (
        Rule("known part", "part % 13 <> 0"),
        Rule("seen after it was scheduled", "scheduled_at <= event_timestamp"),
    )
    schema = T.StructType([*APPOINTMENTS.schema.fields, T.StructField("part", T.LongType())])
    spec = replace(APPOINTMENTS, schema=schema, rules=rules)
    checked = validate.prepare(s.appointments(spark, d), spec)
    reasons = validate.drop_report(validate.quarantined(checked, spec)).select("reason", "n_rows")
    good = validate.accepted(checked).agg(F.count(F.lit(1)).alias("n_rows"))
    return reasons.unionAll(good.select(F.lit("accepted"), "n_rows"))


@query(
    "pii_catalog",
    sql(
        """select 'patients' table_name, 'patient_id' column_name, 'pseudonymous_key' pii_class,
                  'retain' erasure_strategy, count(patient_id) n_values from patients
           union all
           select 'patients', 'postcode', 'quasi_identifier', 'anonymize', count(postcode)
           from patients
           union all
           select 'appointments', 'patient_id', 'pseudonymous_key', 'retain', count(patient_id)
           from appointments
           union all
           select 'patient_consents', 'patient_id', 'pseudonymous_key', 'retain',
                  count(patient_id) from consents""",
        "patients",
        "appointments",
        "consents",
    ),
)
def pii_catalog(spark, d):
    t = tables(spark, d)
    return union([quality.pii_catalog(sp, t[sp.name]) for sp in (PATIENTS, APPOINTMENTS, CONSENTS)])


# ---- erasure -------------------------------------------------------------------------


def subject_tables(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    t = tables(spark, d)
    return {name: t[name] for name in erasure.CASCADE}


@query(
    "erasure_pending",
    sql("select patient_id from erasure_requests where erased_at is null", "erasure_requests"),
)
def erasure_pending(spark, d):
    return erasure.pending(s.erasure_requests(spark, d)).select("patient_id")


def log_with_strays(spark: SparkSession, d: str) -> DataFrame:
    """The consent log with some rows that name no subject."""
    subject = F.when(F.col("lsn") % 101 != 0, F.col("patient_id"))
    return s.consents(spark, d).select(*CONSENT_COLUMNS).withColumn("patient_id", subject)


@query(
    "erasure_purged_log",
    sql(
        f""", log as (select {CONSENT_LIST.replace('patient_id', 'case when lsn % 101 <> 0 then patient_id end patient_id')}
                     from consents)
            select {CONSENT_LIST} from log
            where patient_id is null
               or patient_id not in (select patient_id from erasure_requests
                                     where erased_at is null)""",
        "consents",
        "erasure_requests",
    ),
)
def erasure_purged_log(spark, d):
    return erasure.purge(log_with_strays(spark, d), erasure.pending(s.erasure_requests(spark, d)))


def _count_pending(table: str, source: str) -> str:
    return f"""select '{table}' table_name, count(*) rows_deleted from {source}
               where patient_id in (select patient_id from erasure_requests
                                    where erased_at is null)"""


@query(
    "erasure_counts",
    sql(
        " union all ".join(
            [
                _count_pending("patient_consents", "consents"),
                _count_pending("appointments", "appointments"),
                _count_pending("patients", "patients"),
            ]
        ),
        "consents",
        "appointments",
        "patients",
        "erasure_requests",
    ),
)
def erasure_counts(spark, d):
    return erasure.deletion_counts(subject_tables(spark, d), s.erasure_requests(spark, d))


@query(
    "erasure_stamped",
    sql(
        """select patient_id, coalesce(erased_at, timestamp '2024-03-01 00:00:00') erased_at
           from erasure_requests""",
        "erasure_requests",
    ),
)
def erasure_stamped(spark, d):
    now = F.lit("2024-03-01 00:00:00").cast("timestamp_ntz")
    return erasure.stamp(s.erasure_requests(spark, d), now)


@query(
    "dq_erased_absent",
    sql(
        """, done as (select patient_id from erasure_requests where erased_at is not null)
           select 'patient_consents' source_table, t.patient_id
           from consents t join done using (patient_id)
           union all
           select 'appointments', t.patient_id from appointments t join done using (patient_id)
           union all
           select 'patients', t.patient_id from patients t join done using (patient_id)""",
        "consents",
        "appointments",
        "patients",
        "erasure_requests",
    ),
)
def dq_erased_absent(spark, d):
    """The completed requests of the test tables were never swept, so each row is found."""
    return erasure.violations(subject_tables(spark, d), s.erasure_requests(spark, d))


@query(
    "erasure_cascade",
    sql(
        """, gone as (select patient_id from erasure_requests where erased_at is null)
           select 'patient_consents' table_name, count(*) n_rows from consents
           where patient_id not in (select patient_id from gone)
           union all
           select 'appointments', count(*) from appointments
           where patient_id not in (select patient_id from gone)
           union all
           select 'patients', count(*) from patients
           where patient_id not in (select patient_id from gone)
           union all
           select 'patients_current', count(distinct patient_id) from patients
           where patient_id not in (select patient_id from gone)
           union all
           select 'providers', count(*) from providers""",
        *TABLES,
        "erasure_requests",
    ),
)
def erasure_cascade(spark, d):
    """Raw and derived tables after the sweep; a derived table is purged like a raw one."""
    t = tables(spark, d)
    t["patients_current"] = latest_per_key(t["patients"], ["patient_id"])
    swept = erasure.purge_all(t, s.erasure_requests(spark, d))
    return union(
        [
            df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(n).alias("table_name"), "n_rows")
            for n, df in swept.items()
        ]
    )


@query(
    "erasure_anonymize",
    sql(
        """select p.patient_id, primary_provider_id,
                  case when r.patient_id is null then postcode end postcode, updated_at, lsn
           from patients p
           left join (select patient_id from erasure_requests where erased_at is null) r
             on p.patient_id = r.patient_id""",
        "patients",
        "erasure_requests",
    ),
)
def erasure_anonymize(spark, d):
    return erasure.anonymize(tables(spark, d)["patients"], PATIENTS, s.erasure_requests(spark, d))


# ---- joins and set operations --------------------------------------------------------


@query(
    "orphan_keys",
    sql(
        """select primary_provider_id, count(*) n_rows from patients
           where primary_provider_id is not null
             and primary_provider_id not in (select provider_id from providers)
           group by primary_provider_id""",
        "patients",
        "providers",
    ),
)
def orphan_keys(spark, d):
    t = tables(spark, d)
    return quality.orphan_keys(t["patients"], "primary_provider_id", t["providers"], "provider_id")


@query(
    "replay_after_erasure",
    sql(
        """select patient_id, lsn from consents
           where patient_id not in (select patient_id from erasure_requests
                                    where erased_at is not null)""",
        "consents",
        "erasure_requests",
    ),
)
def replay_after_erasure(spark, d):
    """A feed replayed after a sweep does not bring erased subjects back."""
    kept = erasure.replayable(s.consents(spark, d), s.erasure_requests(spark, d))
    return kept.select("patient_id", "lsn")
