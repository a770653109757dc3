"""Right to erasure: find pending requests, purge, count, stamp, check.

Requests are joined, never spliced into SQL text. No join carries a broadcast hint: the
planner compares the requests' size with its threshold, and a larger list takes a
sort-merge join whose skewed partitions adaptive execution splits.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.operators.quality import union_all
from tidelog.spec import TableSpec

# Tables that hold a subject's data, children before parents.
CASCADE = ("patient_consents", "appointments", "patients")
SUBJECT = "patient_id"


def pending(requests: DataFrame) -> DataFrame:
    return requests.filter(F.col("erased_at").isNull())


def completed(requests: DataFrame) -> DataFrame:
    return requests.filter(F.col("erased_at").isNotNull())


def _subjects(requests: DataFrame, key: str = SUBJECT) -> DataFrame:
    return requests.select(F.col(SUBJECT).alias(key)).distinct()


def purge(df: DataFrame, requests: DataFrame, key: str = SUBJECT) -> DataFrame:
    """Rows of everyone else; a row without a subject stays."""
    return df.join(_subjects(requests, key), key, "left_anti").select(*df.columns)


def purge_all(tables: Mapping[str, DataFrame], requests: DataFrame) -> dict[str, DataFrame]:
    """Cascade over all registered tables that name a subject; others are untouched."""
    targets = pending(requests)
    return {
        name: purge(df, targets) if SUBJECT in df.columns else df
        for name, df in tables.items()
    }


def deletion_counts(tables: Mapping[str, DataFrame], requests: DataFrame) -> DataFrame:
    """Rows to be deleted per table. Rows are counted per subject before the join."""
    targets = _subjects(pending(requests))
    parts = []
    for name in tables:
        per_subject = (
            tables[name].groupBy(SUBJECT).agg(F.count(F.lit(1)).alias("n"))
        )
        hit = per_subject.join(targets, SUBJECT, "left_semi")
        parts.append(
            hit.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("rows_deleted")).select(
                F.lit(name).alias("table_name"), "rows_deleted"
            )
        )
    return union_all(parts)


def stamp(requests: DataFrame, now: Column) -> DataFrame:
    """Mark pending requests as done; completed ones keep their time."""
    return requests.withColumn("erased_at", F.coalesce(F.col("erased_at"), now))


def violations(tables: Mapping[str, DataFrame], requests: DataFrame) -> DataFrame:
    """One row per stored row of a subject whose erasure is complete."""
    done = _subjects(completed(requests))
    parts = [
        df.select(SUBJECT)
        .join(done, SUBJECT, "inner")
        .select(F.lit(name).alias("source_table"), SUBJECT)
        for name, df in tables.items()
    ]
    return union_all(parts)


def replayable(feed: DataFrame, requests: DataFrame) -> DataFrame:
    """A feed to replay after a purge: erased subjects must not come back."""
    return purge(feed, completed(requests))


def anonymize(df: DataFrame, spec: TableSpec, requests: DataFrame) -> DataFrame:
    """Opt-in strategy: keep the row, blank the columns tagged ``anonymize``."""
    tagged = [
        f.name
        for f in spec.schema.fields
        if (f.metadata or {}).get("erasure_strategy") == "anonymize"
    ]
    marked = _subjects(pending(requests)).withColumn("_erased", F.lit(True))
    joined = df.join(marked, SUBJECT, "left")
    blank = {
        c: F.when(F.col("_erased").isNull(), F.col(c)) for c in tagged if c in df.columns
    }
    return joined.withColumns(blank).select(*df.columns)
