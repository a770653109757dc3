"""Validity windows, point-in-time lookups and status histories."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.operators.merge import latest_per_key, newest_first
from tidelog.operators.ordered import ROWS_PER_CHUNK, as_of, neighbour


def scd2_by_load(
    log: DataFrame,
    ledger: DataFrame,
    key: str,
    *,
    rows_per_chunk: int = ROWS_PER_CHUNK,
) -> DataFrame:
    """Windows from load times: opened when the event's load was committed, closed at the
    delete time or when the key's next event arrived. NULL end = current row."""
    times = ledger.select("_load_id", F.col("inserted_at").alias("valid_from"))
    timed = log.join(times, "_load_id", "left")
    nexts = neighbour(
        timed, [key], "lsn", {"_next_from": "valid_from"}, rows_per_chunk=rows_per_chunk
    )
    return nexts.withColumn(
        "valid_to", F.coalesce(F.col("deleted_ts"), F.col("_next_from"))
    ).drop("_next_from")


def scd2_precise(
    log: DataFrame, key: str, at: str = "commit_ts", *, rows_per_chunk: int = ROWS_PER_CHUNK
) -> DataFrame:
    """Windows from source time. A tombstone opens no window, it closes the one before."""
    nexts = neighbour(log, [key], "lsn", {"valid_to": at}, rows_per_chunk=rows_per_chunk)
    return nexts.filter(F.col("deleted_ts").isNull()).withColumn("valid_from", F.col(at))


def at_time(windows: DataFrame, t: Column) -> DataFrame:
    """Rows of windows valid at one instant. For one instant alone, ``state_at`` reads less."""
    open_end = F.col("valid_to").isNull() | (F.col("valid_to") > t)
    return windows.filter((F.col("valid_from") <= t) & open_end)


def state_at(log: DataFrame, key: str, t: Column, at: str = "commit_ts") -> DataFrame:
    """The rows in force at one instant, tombstones left out: the time filter reaches the
    scan and each map task keeps one row per key."""
    known = log.filter(F.col(at) <= t)
    return latest_per_key(known, [key], order=newest_first()).filter(F.col("deleted_ts").isNull())


def value_as_of(
    facts: DataFrame,
    log: DataFrame,
    key: str,
    fact_time: str,
    log_time: str,
    values: Sequence[str],
    *,
    rows_per_chunk: int = ROWS_PER_CHUNK,
) -> DataFrame:
    """For every fact the values in force at its own time (after a delete: NULL)."""
    f = facts.withColumn("_at", F.unix_micros(F.col(fact_time).cast("timestamp")))
    h = log.withColumn("_at", F.unix_micros(F.col(log_time).cast("timestamp")))
    out = as_of(
        f, h, [key], "_at", "_at", values, ties=("lsn",), rows_per_chunk=rows_per_chunk
    )
    return out.select(*facts.columns, *values)


def status_collapse(
    events: DataFrame, key: str, time: str, ties: Sequence[str] = ()
) -> DataFrame:
    """Latest status event per business id."""
    order = [F.col(c).desc_nulls_last() for c in (time, *ties)]
    return latest_per_key(events, [key], order=order)


def scd1_collapse(history: DataFrame, key: str, ties: Sequence[str] = ()) -> DataFrame:
    """Latest version per entity."""
    order = [F.col(c).desc_nulls_last() for c in ("updated_at", "lsn", *ties)]
    return latest_per_key(history, [key], order=order)


def status_transitions(
    events: DataFrame,
    key: str,
    time: str,
    status: str,
    ties: Sequence[str] = (),
    *,
    rows_per_chunk: int = ROWS_PER_CHUNK,
) -> DataFrame:
    """How often each status follows each other one within a key (NULL = first event)."""
    placed = events.withColumn("_at", F.unix_micros(F.col(time).cast("timestamp")))
    before = neighbour(
        placed.select(key, "_at", *ties, status),
        [key],
        "_at",
        {"from_status": status},
        step="previous",
        ties=ties,
        rows_per_chunk=rows_per_chunk,
    )
    return (
        before.withColumn("to_status", F.col(status))
        .groupBy("from_status", "to_status")
        .agg(F.count(F.lit(1)).alias("n"))
    )
