"""Bounded reads of a change feed: ranges, columns, change kinds, tables, batches."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.operators.merge import latest_per_key
from tidelog.operators.ordered import ROWS_PER_CHUNK, running_total

# Change kinds of the feed.
INSERT, UPDATE, DELETE, TRUNCATE = "I", "U", "D", "T"
CDC_COLUMNS = ("lsn", "deleted_ts")
BATCH_TARGET = 1000


def change_range(feed: DataFrame, start_lsn: int | None, upto_lsn: int) -> DataFrame:
    """Changes after the last committed position up to the run's frozen high-water mark.

    Both bounds are literals, so they reach the scan as pushed filters."""
    bounded = feed.filter(F.col("lsn") <= upto_lsn)
    return bounded if start_lsn is None else bounded.filter(F.col("lsn") > start_lsn)


def high_water(feed: DataFrame) -> DataFrame:
    """Highest position available (NULL for an empty feed); consumes nothing."""
    return feed.agg(F.max("lsn").alias("high_water_lsn"))


def high_water_value(feed: DataFrame) -> int | None:
    return high_water(feed).first()["high_water_lsn"]


def include_columns(feed: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Chosen columns; position and delete time are always kept."""
    extra = [c for c in CDC_COLUMNS if c in feed.columns and c not in columns]
    return feed.select(*columns, *extra)


def publish(feed: DataFrame, ops: Sequence[str]) -> DataFrame:
    """Only the chosen change kinds."""
    return feed.filter(F.col("op").isin(*ops))


def disposition(ops: Sequence[str]) -> str:
    """Inserts alone can be appended; anything else must be merged."""
    return "append" if set(ops) <= {INSERT} else "merge"


def demux(
    feed: DataFrame, tables: Sequence[str], bookkeeping: Sequence[str] = ()
) -> dict[str, DataFrame]:
    """One frame per table. Asking for a table that is named as bookkeeping is an error.
    Each frame is a filter on the feed, so with a feed partitioned by ``relation`` it reads
    its own folder only."""
    refused = sorted(set(tables) & set(bookkeeping))
    if refused:
        raise ValueError(f"bookkeeping tables can't be read as data: {', '.join(refused)}")
    return {t: feed.filter(F.col("relation") == t) for t in tables}


def txn_batches(
    feed: DataFrame,
    target: int = BATCH_TARGET,
    *,
    slot: str | None = None,
    rows_per_chunk: int = ROWS_PER_CHUNK,
) -> DataFrame:
    """``txn, n_rows, min_lsn, commit_lsn, batch_no``; no transaction is ever split.

    A transaction belongs to the batch in which the rows before it fall, so a batch holds
    at most ``target`` rows more than its last transaction. Rows are counted per
    transaction first; the running total is chunked, not one window over everything."""
    keys = [slot] if slot else []
    per_txn = feed.groupBy(*keys, "txn").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.min("lsn").alias("min_lsn"),
        F.max("lsn").alias("commit_lsn"),
    )
    if not slot:
        per_txn = per_txn.withColumn("_slot", F.lit(0))
    total = running_total(
        per_txn,
        [slot or "_slot"],
        "commit_lsn",
        "n_rows",
        "_before",
        rows_per_chunk=rows_per_chunk,
    )
    return total.withColumn("batch_no", F.floor(F.col("_before") / target)).drop(
        "_before", "_slot"
    )


def lag_scan(
    table: DataFrame,
    cursor: str,
    last_value,
    lag: str,
    key: Sequence[str],
    ties: Sequence[str] = (),
) -> DataFrame:
    """Rows newer than the cursor minus a lag window (re-read on purpose), once per key."""
    since = last_value - F.expr(f"interval {lag}")
    order = [F.col(c).desc_nulls_last() for c in (cursor, *ties)]
    return latest_per_key(table.filter(F.col(cursor) > since), key, order=order)


def nth_row(df: DataFrame, order: Sequence[str], n: int = 0) -> DataFrame:
    """The row at offset ``n`` in the given order (ascending, NULLs last). Every task keeps
    its first ``n + 1`` rows only."""
    return df.orderBy(*[F.col(c).asc_nulls_last() for c in order]).offset(n).limit(1)


def table_targets(
    feed: DataFrame, modes: Mapping[str, str], tables: Sequence[str] | None = None
) -> DataFrame:
    """Dry run: the tables a run would write, how, and how many changes are waiting."""
    wanted = [t for t in modes if tables is None or t in tables]
    pairs = [F.lit(v) for t in wanted for v in (t, modes[t])]
    return (
        feed.filter(F.col("relation").isin(*wanted))
        .groupBy("relation")
        .agg(F.count(F.lit(1)).alias("n_pending"))
        .select(
            F.col("relation").alias("table_name"),
            F.element_at(F.create_map(*pairs), F.col("relation")).alias("mode"),
            "n_pending",
        )
    )
