"""Frozen schema contract: a new column stops the load before any row is read."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.spec import TableSpec


class SchemaFrozen(Exception):
    """The input has columns the contract does not know."""


# Columns of a change feed that describe the change rather than the row.
FEED_COLUMNS = (
    "op",
    "lsn",
    "commit_ts",
    "deleted_ts",
    "seq",
    "txn",
    "load_no",
    "_load_id",
    "_row_id",
)


def unknown_columns(columns: list[str], spec: TableSpec) -> list[str]:
    known = {*spec.columns, *spec.strip, *FEED_COLUMNS}
    return sorted(set(columns) - known)


def check_frozen(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Raise ``SchemaFrozen`` naming the table and the columns; only metadata is used."""
    extra = unknown_columns(df.columns, spec)
    if extra:
        raise SchemaFrozen(f"table {spec.name}: new column(s) {', '.join(extra)}")
    return df


def drift_report(df: DataFrame, spec: TableSpec, by: str = "load_no") -> DataFrame:
    """Per load and undeclared column, the number of rows that carry a value."""
    extra = unknown_columns(df.columns, spec)
    counts = df.groupBy(by).agg(
        F.count(F.lit(1)).alias("_rows"), *[F.count(c).alias(c) for c in extra]
    )
    pairs = ", ".join(f"'{c}', `{c}`" for c in extra)
    return counts.selectExpr(
        by, f"stack({len(extra)}, {pairs}) as (column_name, n_rows)"
    ).filter("n_rows > 0")


def check_versions(relations: DataFrame, spec: TableSpec) -> None:
    """Check every relation version of a decoded feed (a handful of rows) against the
    contract; ``relations`` has one row per version with an array ``columns``."""
    seen = relations.select(F.explode("columns").alias("c")).distinct()
    known = [*spec.columns, *spec.strip]
    extra = seen.filter(~F.col("c").isin(known)).orderBy("c").collect()
    if extra:
        names = ", ".join(r["c"] for r in extra)
        raise SchemaFrozen(f"table {spec.name}: new column(s) {names}")
