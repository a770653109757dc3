"""All registered queries."""

from tidelog.plans import governance, histories, ingest, merges, profiles, scalars
from tidelog.plans.registry import QUERIES, SQL

__all__ = [
    "QUERIES",
    "SQL",
    "governance",
    "histories",
    "ingest",
    "merges",
    "profiles",
    "scalars",
]
