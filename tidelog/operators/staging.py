"""Typed one-to-one projections of the raw tables, and masking."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog.spec import TableSpec

# Fixed value: what a masked cell shows.
REDACTED = "<redacted>"

# Staged columns of each table as (raw name, type, staged name).
STAGED = {
    "appointments": (
        ("event_id", "string", "event_id"),
        ("appointment_id", "string", "appointment_id"),
        ("patient_id", "string", "patient_id"),
        ("provider_id", "string", "provider_id"),
        ("scheduled_at", "timestamp", "scheduled_time"),
        ("status", "string", "status"),
        ("event_timestamp", "timestamp", "event_time"),
        ("ingested_at", "timestamp", "ingested_time"),
        ("lsn", "bigint", "lsn"),
        ("deleted_ts", "timestamp", "deleted_time"),
        ("_load_id", "string", "_load_id"),
        ("_row_id", "string", "_row_id"),
    ),
    "patients": (
        ("patient_id", "string", "patient_id"),
        ("primary_provider_id", "string", "primary_provider_id"),
        ("postcode", "string", "postcode"),
        ("updated_at", "timestamp", "updated_time"),
        ("_load_id", "string", "_load_id"),
        ("_row_id", "string", "_row_id"),
    ),
    "providers": (
        ("provider_id", "string", "provider_id"),
        ("name", "string", "name"),
        ("specialty", "string", "specialty"),
        ("lsn", "bigint", "lsn"),
        ("deleted_ts", "timestamp", "deleted_time"),
        ("_load_id", "string", "_load_id"),
        ("_row_id", "string", "_row_id"),
    ),
    "patient_consents": (
        ("patient_id", "string", "patient_id"),
        ("consent_research", "boolean", "consent_research"),
        ("consent_marketing", "boolean", "consent_marketing"),
        ("consent_partner_share", "boolean", "consent_partner_share"),
        ("lsn", "bigint", "lsn"),
        ("deleted_ts", "timestamp", "deleted_ts"),
        ("_load_id", "string", "_load_id"),
    ),
}


def stage(raw: DataFrame, table: str) -> DataFrame:
    """The staged view of a raw table; instants are zone-aware timestamps (session zone UTC)."""
    return raw.select(
        *[F.col(src).cast(dtype).alias(out) for src, dtype, out in STAGED[table]]
    )


def mask(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Overwrite direct identifiers and quasi-identifiers by a constant."""
    named = {
        f.name
        for f in spec.schema.fields
        if (f.metadata or {}).get("pii_class") in ("direct_identifier", "quasi_identifier")
    }
    hidden = [c for c in df.columns if c in named or c in spec.strip]
    return df.withColumns({c: F.lit(REDACTED) for c in hidden})


def exclude_prefix(df: DataFrame, column: str, pattern: str) -> DataFrame:
    """``NOT LIKE``; an underscore in the pattern matches any one character."""
    return df.filter(~F.col(column).like(pattern))


def row_identity(df: DataFrame, columns: list[str]) -> DataFrame:
    """Add ``_row_id``, a digest of the row's content. A text goes in with its length, so no
    text can pass for two cells; other values are written in figures, a time as microseconds.
    Each cell ends with a bar; NULL differs from any text."""
    cells = []
    for c in columns:
        kind = df.schema[c].dataType
        if isinstance(kind, T.StringType):
            text = F.concat(F.length(c).cast("string"), F.lit(":"), F.col(c))
        elif isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
            text = F.unix_micros(F.col(c).cast("timestamp")).cast("string")
        else:
            text = F.col(c).cast("string")
        cells += [F.coalesce(text, F.lit("N")), F.lit("|")]
    return df.withColumn("_row_id", F.sha2(F.concat(*cells), 256))
