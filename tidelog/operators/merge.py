"""Keyed merges, event logs and soft deletes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidelog.operators.ordered import carry_forward, row_hash


def _any_null(keys: Sequence[str]) -> Column:
    cond = F.lit(False)
    for k in keys:
        cond = cond | F.col(k).isNull()
    return cond


_OWN = "_own"


def first_per_key(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], *, keep_null_keys: bool = False
) -> DataFrame:
    """One row per key, in one pass. Each map task keeps at most one row per key before the
    shuffle (window group limit), so a heavy key costs one row per task. Rows equal in
    ``order`` are ordered by a hash of the row, so a retried task picks the same one; it
    covers the columns of ``df``, so callers select what they need first.

    A row with a NULL key matches no other: it goes, or with ``keep_null_keys`` stays as the
    first of a partition of its own. Keys that the schema says are never NULL cost nothing.
    """
    first = F.row_number().over(Window.partitionBy(*_parts(df, keys, keep_null_keys)).orderBy(*order, row_hash(df)))
    marked = _own_parts(df, keys, keep_null_keys)
    return marked.withColumn("_rn", first).filter(F.col("_rn") == 1).drop("_rn", _OWN)


def _nullable(df: DataFrame, keys: Sequence[str]) -> list[str]:
    return [k for k in keys if df.schema[k].nullable]


def _parts(df: DataFrame, keys: Sequence[str], keep_null_keys: bool) -> list[str]:
    return [*keys, _OWN] if keep_null_keys and _nullable(df, keys) else list(keys)


def _own_parts(df: DataFrame, keys: Sequence[str], keep_null_keys: bool) -> DataFrame:
    """Rows with a NULL key left out, or numbered: so they spread over the tasks, too."""
    nullable = _nullable(df, keys)
    if not nullable:
        return df
    if not keep_null_keys:
        return df.filter(~_any_null(nullable))
    return df.withColumn(_OWN, F.when(_any_null(nullable), F.monotonically_increasing_id()).otherwise(-1))


def newest_first(ties: Sequence[str] = ()) -> list[Column]:
    """Highest position first; snapshot rows (no position) last."""
    return [F.col(c).desc_nulls_last() for c in ("lsn", *ties)]


def latest_per_key(
    df: DataFrame,
    keys: Sequence[str],
    ties: Sequence[str] = (),
    *,
    order: Sequence[Column] | None = None,
    keep_null_keys: bool = True,
) -> DataFrame:
    """Newest row per key. Rows without a key never match each other: all are kept, unless
    the caller asks to leave them out."""
    return first_per_key(df, keys, order or newest_first(ties), keep_null_keys=keep_null_keys)


def merge_latest(
    state: DataFrame,
    batch: DataFrame,
    keys: Sequence[str],
    ties: Sequence[str] = (),
    *,
    keep_null_keys: bool = True,
) -> DataFrame:
    """Upsert by key where the highest position wins, in whatever order batches arrive.

    A DELETE is a row with ``deleted_ts``; it stays in the state as a tombstone so that a
    late, older update cannot bring the key back.
    """
    both = state.unionByName(batch, allowMissingColumns=True)
    return latest_per_key(both, keys, ties, keep_null_keys=keep_null_keys)


def log_key(key: Sequence[str], columns: Sequence[str]) -> tuple[str, ...]:
    """The key of an event: ``seq`` belongs to it where the feed numbers its events, as
    several events may share a position."""
    return (*key, "seq") if "seq" in columns and "seq" not in key else tuple(key)


def event_log_merge(
    log: DataFrame,
    batch: DataFrame,
    key: Sequence[str] = ("lsn",),
    ties: Sequence[str] = (),
) -> DataFrame:
    """Append the events of ``batch`` that the log does not hold yet.

    Rows whose key is NULL (snapshot rows) match nothing and are always appended.
    """
    return log.unionByName(new_events(log, batch, key, ties), allowMissingColumns=True)


def new_events(
    log: DataFrame,
    batch: DataFrame,
    key: Sequence[str] = ("lsn",),
    ties: Sequence[str] = (),
    *,
    prune: bool = True,
) -> DataFrame:
    """The part of ``batch`` that an event-log merge would append; the batch is read once,
    and with ``prune`` once more for its range.

    Only log rows inside the batch's range of positions can match. With ``prune`` that
    range is found by the query itself and limits the scan of the log before its shuffle.
    Where both sides have ``seq``, it is part of the key."""
    if "seq" in log.columns:
        key = log_key(key, batch.columns)
    if prune and "lsn" in key:
        span = batch.agg(F.struct(F.min("lsn").alias("lo"), F.max("lsn").alias("hi")).alias("span")).scalar()
        log = log.filter(F.col("lsn").between(span["lo"], span["hi"]))
    # Further copies of one event are alike; any total order picks the same content.
    rest = [c for c in batch.columns if c not in key and c not in ties]
    order = [F.col(c).desc_nulls_last() for c in ties] + [F.xxhash64(*rest).asc()] if rest else [F.lit(0)]
    # Events without a key are numbered, so they meet nothing and don't gather in one task.
    parts = _parts(batch, key, True)
    numbered = _own_parts(batch, key, True)
    first = F.row_number().over(Window.partitionBy(*parts).orderBy(*order))
    once = numbered.withColumn("_rn", first).filter(F.col("_rn") == 1)
    held = log.select(*key, *[F.lit(-1).cast("long").alias(c) for c in parts if c == _OWN])
    return once.join(held, parts, "left_anti").select(*batch.columns)


def live_rows(df: DataFrame) -> DataFrame:
    """``deleted_ts IS NULL`` is the only sign of life."""
    return df.filter(F.col("deleted_ts").isNull())


def deleted_rows(df: DataFrame) -> DataFrame:
    return df.filter(F.col("deleted_ts").isNotNull())


def change_rows(df: DataFrame) -> DataFrame:
    """Rows that came from the change stream, not from the snapshot."""
    return df.filter(F.col("lsn").isNotNull())


def resurrected_keys(log: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that are live now although they were deleted before.

    Three maxima per key; no event list is ever gathered."""
    gone = F.col("deleted_ts").isNotNull()
    return (
        change_rows(log)
        .groupBy(*keys)
        .agg(
            F.max(F.when(gone, F.col("lsn"))).alias("last_delete_lsn"),
            F.max(F.when(~gone, F.col("lsn"))).alias("last_live_lsn"),
        )
        .filter(F.col("last_live_lsn") > F.col("last_delete_lsn"))
    )


def active_entity_count(log: DataFrame, key: str, out: str = "active_entities") -> DataFrame:
    """Distinct keys that have a row without ``deleted_ts``."""
    return live_rows(log).agg(F.count_distinct(F.col(key)).alias(out))


def old_key_tombstones(feed: DataFrame, key: str, old_key: str) -> DataFrame:
    """Opt-in: tombstones for the old key of updates that changed the key.

    Without them the row under the old key stays as it was."""
    moved = (
        (F.col("op") == "U")
        & F.col(old_key).isNotNull()
        & (F.col(old_key) != F.col(key))
    )
    return (
        feed.filter(moved)
        .withColumn(key, F.col(old_key))
        .withColumn("deleted_ts", F.col("commit_ts"))
        .withColumn("op", F.lit("D"))
    )


def unchanged_values(
    feed: DataFrame,
    keys: Sequence[str],
    column: str,
    kind_column: str,
    *,
    carry: bool = False,
    rows_per_chunk: int | None = None,
) -> DataFrame:
    """Cells the source marked ``u`` (value not sent because unchanged).

    By default such a cell fails the job. With ``carry`` the key's last sent value (which
    may be NULL) is filled in."""
    unsent = F.col(kind_column) == "u"
    if not carry:
        message = F.concat(F.lit("unchanged value not sent for column "), F.lit(column))
        return feed.withColumn(
            column, F.when(unsent, F.raise_error(message)).otherwise(F.col(column))
        )
    sent = feed.withColumn("_sent", F.when(~unsent, F.struct(F.col(column).alias("v"))))
    extra = {} if rows_per_chunk is None else {"rows_per_chunk": rows_per_chunk}
    filled = carry_forward(sent, keys, "lsn", {"_held": "_sent"}, **extra)
    return filled.withColumn(column, F.col("_held.v")).select(*feed.columns)
