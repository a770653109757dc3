"""Change-data operators for PySpark: snapshot + change merges, history, quality, erasure."""

from tidelog.spec import (
    APPOINTMENTS,
    CONSENTS,
    PATIENTS,
    PROVIDERS,
    SPECS,
    TableSpec,
)

__all__ = ["APPOINTMENTS", "CONSENTS", "PATIENTS", "PROVIDERS", "SPECS", "TableSpec"]
