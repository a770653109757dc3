"""Declared table contracts. Nothing is inferred from data."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

LATEST = "latest"  # one row per business key
LOG = "log"  # one row per change event

CDC_FIELDS = (
    T.StructField("lsn", T.LongType(), True),
    T.StructField("deleted_ts", T.TimestampNTZType(), True),
)


@dataclass(frozen=True)
class ForeignKey:
    column: str
    parent: str
    parent_column: str
    severity: str = "error"
    where: str | None = None


@dataclass(frozen=True)
class Rule:
    """What every row must satisfy: a predicate over typed columns, as Spark SQL. A row for
    which it is NULL satisfies it, so a tombstone without values does."""

    name: str
    predicate: str


@dataclass(frozen=True)
class TableSpec:
    """Contract of one table.

    ``required`` columns may not be NULL in a live row. With ``delete_image='key'`` the
    source sends only the key on DELETE, so a tombstone needs nothing but the key.
    """

    name: str
    schema: T.StructType
    key: tuple[str, ...]
    mode: str
    required: tuple[str, ...]
    merge_key: tuple[str, ...]
    delete_image: str = "full"
    strip: tuple[str, ...] = ()
    foreign_keys: tuple[ForeignKey, ...] = ()
    preprocess: tuple = field(default=())
    rules: tuple[Rule, ...] = ()

    @property
    def columns(self) -> list[str]:
        return self.schema.names

    @property
    def raw_schema(self) -> T.StructType:
        return T.StructType(list(self.schema.fields) + list(CDC_FIELDS))


def _pii(pii_class: str, strategy: str) -> dict:
    return {"is_pii": True, "pii_class": pii_class, "erasure_strategy": strategy}


def _text(name: str, nullable: bool = True, meta: dict | None = None) -> T.StructField:
    return T.StructField(name, T.StringType(), nullable, meta)


def _time(name: str, nullable: bool = True) -> T.StructField:
    return T.StructField(name, T.TimestampNTZType(), nullable)


_PATIENT_KEY = _pii("pseudonymous_key", "retain")

PROVIDERS = TableSpec(
    name="providers",
    schema=T.StructType(
        [_text("provider_id", False), _text("name", False), _text("specialty")]
    ),
    key=("provider_id",),
    mode=LATEST,
    required=("provider_id", "name"),
    merge_key=("provider_id",),
)

PATIENTS = TableSpec(
    name="patients",
    schema=T.StructType(
        [
            _text("patient_id", False, _PATIENT_KEY),
            _text("primary_provider_id"),
            _text("postcode", True, _pii("quasi_identifier", "anonymize")),
            _time("updated_at"),
        ]
    ),
    key=("patient_id",),
    mode=LOG,
    required=("patient_id",),
    merge_key=("lsn",),
    strip=("name",),
    foreign_keys=(
        ForeignKey(
            "primary_provider_id",
            "providers",
            "provider_id",
            where="primary_provider_id is not null",
        ),
    ),
)

APPOINTMENTS = TableSpec(
    name="appointments",
    schema=T.StructType(
        [
            _text("event_id", False),
            _text("appointment_id", False),
            _text("patient_id", False, _PATIENT_KEY),
            _text("provider_id", False),
            _time("scheduled_at", False),
            _text("status", False),
            _time("event_timestamp", False),
            _time("ingested_at", False),
        ]
    ),
    key=("event_id",),
    mode=LATEST,
    required=(
        "event_id",
        "appointment_id",
        "patient_id",
        "provider_id",
        "scheduled_at",
        "status",
        "event_timestamp",
        "ingested_at",
    ),
    merge_key=("event_id",),
    foreign_keys=(
        ForeignKey("patient_id", "patients", "patient_id", severity="warn"),
        ForeignKey("provider_id", "providers", "provider_id"),
    ),
)

CONSENTS = TableSpec(
    name="patient_consents",
    schema=T.StructType(
        [
            _text("patient_id", False, _PATIENT_KEY),
            T.StructField("consent_research", T.BooleanType()),
            T.StructField("consent_marketing", T.BooleanType()),
            T.StructField("consent_partner_share", T.BooleanType()),
        ]
    ),
    key=("patient_id",),
    mode=LOG,
    required=("patient_id",),
    merge_key=("lsn",),
    delete_image="key",
    foreign_keys=(ForeignKey("patient_id", "patients", "patient_id", severity="warn"),),
)

SPECS = {s.name: s for s in (PROVIDERS, PATIENTS, APPOINTMENTS, CONSENTS)}
