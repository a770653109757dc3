"""Propagation checks: did each change arrive in each table, with its values?"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.operators.quality import union_all


def _image(columns: Sequence[str]) -> Column:
    """What a row says: the values, or that it is deleted (a deleted row's values don't
    count, as some sources send none)."""
    values = F.when(F.col("deleted_ts").isNull(), F.struct(*columns))
    return F.struct(F.col("deleted_ts").isNotNull().alias("gone"), values.alias("values"))


def propagation(
    table: DataFrame, name: str, expected: DataFrame, key: Sequence[str], columns: Sequence[str]
) -> DataFrame:
    """Per kind of change: rows expected, found by key, and found with the expected values.

    ``expected`` has ``mutation``, the key, ``deleted_ts`` and the columns, one row per key.
    The stored table needs no trace of the change but the row itself. Rows of the table that
    nobody expects don't matter. ``ok`` says that all expected rows hold their values.
    """
    stored = table.select(*[F.col(k).alias(f"_{k}") for k in key], _image(columns).alias("_stored"))
    same = None
    for k in key:
        one = F.col(k).eqNullSafe(F.col(f"_{k}"))
        same = one if same is None else same & one
    wanted = expected.select("mutation", *key, _image(columns).alias("_wanted"))
    both = wanted.join(stored, same, "left")
    equal = F.col("_wanted").eqNullSafe(F.col("_stored"))
    return (
        both.groupBy("mutation")
        .agg(
            F.count(F.lit(1)).alias("n_expected"),
            F.count("_stored").alias("n_observed"),
            F.count_if(equal).alias("n_equal"),
        )
        .select(
            F.lit(name).alias("table_name"), "mutation", "n_expected", "n_observed", "n_equal",
            (F.col("n_expected") == F.col("n_equal")).alias("ok"),
        )
    )


def report(checks: list[DataFrame]) -> DataFrame:
    return union_all(checks)
