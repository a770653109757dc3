"""Profiling of whole tables. Distinct counts are two-level group-bys: partial results are
combined before each shuffle and no set of values is built for one key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def ratio_2dp(part: Column, whole: Column, scale: int = 1) -> Column:
    """``part * scale / whole`` rounded half-up to two places, by whole numbers."""
    cents = F.floor((part * (scale * 200) + whole) / (whole * 2)).cast("bigint")
    return F.when(whole > 0, cents.cast("double") / F.lit(100.0))


def null_rates(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Percentage of NULLs per column, one pass."""
    agg = df.agg(
        F.count(F.lit(1)).alias("_n"),
        *[F.count_if(F.col(c).isNull()).alias(c) for c in columns],
    )
    pairs = ", ".join(f"'{c}', `{c}`" for c in columns)
    return agg.selectExpr(
        "_n", f"stack({len(columns)}, {pairs}) as (column_name, n_null)"
    ).select("column_name", "n_null", ratio_2dp(F.col("n_null"), F.col("_n"), 100).alias("pct_null"))


def duplicates(df: DataFrame, key: str, business_id: str) -> DataFrame:
    """Rows, distinct keys, surplus rows and their rate, mean events per business id."""
    keys = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    ids = df.select(business_id).distinct().agg(F.count(F.col(business_id)))
    both = keys.agg(
        F.sum("n").alias("total_rows"), F.count(F.col(key)).alias("distinct_keys")
    ).withColumn("distinct_ids", ids.scalar())
    surplus = F.col("total_rows") - F.col("distinct_keys")
    return both.select(
        "total_rows",
        "distinct_keys",
        surplus.alias("duplicate_rows"),
        ratio_2dp(surplus, F.col("total_rows"), 100).alias("pct_duplicate"),
        "distinct_ids",
        ratio_2dp(F.col("total_rows"), F.col("distinct_ids")).alias("avg_per_id"),
    )


def duplicate_nature(df: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Repeated keys by nature: exact re-delivery or differing content."""
    contents = df.groupBy(key, *columns).agg(F.count(F.lit(1)).alias("n"))
    per_key = contents.groupBy(key).agg(
        F.sum("n").alias("n_rows"), F.count(F.lit(1)).alias("n_contents")
    )
    nature = F.when(F.col("n_contents") == 1, "exact_redelivery").otherwise("content_collision")
    return (
        per_key.filter("n_rows > 1")
        .groupBy(nature.alias("nature"))
        .agg(F.count(F.lit(1)).alias("n_keys"), F.sum("n_rows").alias("n_rows"))
    )


def events_per_id(df: DataFrame, business_id: str, key: str) -> DataFrame:
    """Distinct events per business id, for ids with more than one."""
    pairs = df.groupBy(business_id, key).agg(F.lit(1).alias("one"))
    return (
        pairs.groupBy(business_id)
        .agg(F.count(F.lit(1)).alias("n_events"))
        .filter("n_events > 1")
    )


def value_counts(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("n_rows"))


def count_of_counts(df: DataFrame, key: str) -> DataFrame:
    """How many keys have how many rows."""
    sizes = df.groupBy(key).agg(F.count(F.lit(1)).alias("group_size"))
    return sizes.groupBy("group_size").agg(F.count(F.lit(1)).alias("n_groups"))


def time_coverage(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """First, last and missing instants per column, one pass."""
    aggs = []
    for c in columns:
        aggs += [
            F.min(c).alias(f"{c}__min"),
            F.max(c).alias(f"{c}__max"),
            F.count_if(F.col(c).isNull()).alias(f"{c}__nulls"),
        ]
    parts = ", ".join(f"'{c}', `{c}__min`, `{c}__max`, `{c}__nulls`" for c in columns)
    return df.agg(*aggs).selectExpr(
        f"stack({len(columns)}, {parts}) as (column_name, first_ts, last_ts, n_null)"
    )


def history_stats(df: DataFrame, key: str) -> DataFrame:
    """Rows per entity: entities, those with a history, longest, mean."""
    sizes = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return sizes.agg(
        F.sum("n").alias("total_rows"),
        F.count(F.lit(1)).alias("entities"),
        F.count_if(F.col("n") > 1).alias("with_history"),
        F.max("n").alias("max_rows"),
        ratio_2dp(F.sum("n"), F.count(F.lit(1))).alias("mean_rows"),
    )


def composite_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Is the combination unique? Distinct combinations and surplus rows."""
    combos = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return combos.agg(
        F.sum("n").alias("total_rows"),
        F.count(F.lit(1)).alias("distinct_combinations"),
        (F.sum("n") - F.count(F.lit(1))).alias("duplicate_rows"),
        (F.max("n") == 1).alias("is_unique"),
    )


def pk_unique(df: DataFrame, key: str) -> DataFrame:
    sizes = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return sizes.agg(
        F.sum("n").alias("n_rows"),
        F.count(F.col(key)).alias("n_keys"),
        (F.sum("n") == F.count(F.col(key))).alias("pk_unique"),
    )


def flags(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """True / false / NULL counts and the share of true among the given answers."""
    aggs = []
    for c in columns:
        aggs += [
            F.count_if(F.col(c)).alias(f"{c}__t"),
            F.count_if(~F.col(c)).alias(f"{c}__f"),
            F.count_if(F.col(c).isNull()).alias(f"{c}__n"),
        ]
    parts = ", ".join(f"'{c}', `{c}__t`, `{c}__f`, `{c}__n`" for c in columns)
    long = df.agg(*aggs).selectExpr(
        f"stack({len(columns)}, {parts}) as (flag, n_true, n_false, n_null)"
    )
    given = F.col("n_true") + F.col("n_false")
    return long.withColumn("pct_true", ratio_2dp(F.col("n_true"), given, 100))


def coverage(have: DataFrame, need: DataFrame, key: str) -> DataFrame:
    """How many of the needed keys are present on the other side."""
    present = have.select(key).distinct().withColumn("_has", F.lit(1))
    joined = need.select(key).distinct().join(present, key, "left")
    return joined.agg(
        F.count(F.lit(1)).alias("needed"),
        F.count("_has").alias("covered"),
        (F.count(F.lit(1)) - F.count("_has")).alias("missing"),
        ratio_2dp(F.count("_has"), F.count(F.lit(1)), 100).alias("pct_covered"),
    )


def key_difference(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Distinct keys of one side that the other lacks."""
    return left.select(key).distinct().subtract(right.select(key).distinct())
