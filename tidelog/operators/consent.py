"""Consent-gated facts and the wide serving table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.operators.merge import latest_per_key, live_rows

SUBJECT = "patient_id"


def current_consents(log: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Newest event per subject, subjects whose newest event is a delete left out. Naming
    the columns that are needed spares reading the others."""
    if columns is not None:
        wanted = dict.fromkeys([SUBJECT, *columns, "lsn", "seq", "deleted_ts"])
        log = log.select(*[c for c in wanted if c in log.columns])
    ties = [c for c in ("seq",) if c in log.columns]
    return live_rows(latest_per_key(log, [SUBJECT], ties))


def consented(facts: DataFrame, log: DataFrame, flag: str) -> DataFrame:
    """Facts whose subject consents now. No record, a deleted record or NULL means no."""
    granted = current_consents(log, [flag]).filter(F.col(flag)).select(SUBJECT)
    return facts.join(granted, SUBJECT, "left_semi").select(*facts.columns)


def serving_table(
    facts: DataFrame, providers: DataFrame, patients: DataFrame, log: DataFrame, flag: str
) -> DataFrame:
    """One wide row per consented fact with the current provider and patient attributes.

    ``providers`` and ``patients`` hold one row per key."""
    who = providers.select("provider_id", F.col("specialty").alias("provider_specialty"))
    subject = patients.select(SUBJECT, "primary_provider_id", "postcode")
    return (
        consented(facts, log, flag)
        .join(who, "provider_id", "left")
        .join(subject, SUBJECT, "left")
    )
