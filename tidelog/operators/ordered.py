"""Row-order operators that stay parallel when one key holds a large part of the table.

A plain window sends all rows of a key to one task. So rows per key are counted first, over
the key columns alone. If no key has more than ``rows_per_chunk`` rows, the plain window is
used. Otherwise the rows are sorted out by key and full order into ranges of about
``rows_per_chunk`` rows, whatever their positions: bursts, ties and rows without a position
are cut like others. The ranges are landed, so that every later step sees the same cut.
Each part of a key in a range is its own window partition, and one *sentinel* row per part
carries what the neighbouring part would have supplied. Results equal the plain window's
for every key. Rows equal in position and ties are ordered by a hash of the whole row.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog.session import run_dir

ROWS_PER_CHUNK = 1_000_000

CHUNK, HASH = "_chunk", "_hash"
_EDGE, _POS, _VAL = "_edge", "_pos", "_val"


def row_hash(df: DataFrame) -> Column:
    """A hash of the whole row, to order rows that are equal in all else. Columns of types
    that can't be hashed (maps, variants) don't take part."""
    plain = [f.name for f in df.schema.fields if not _unhashable(f.dataType)]
    return F.xxhash64(*[F.col(f"`{c}`") for c in plain]) if plain else F.lit(0).cast("long")


def _unhashable(kind: T.DataType) -> bool:
    if isinstance(kind, T.StructType):
        return any(_unhashable(f.dataType) for f in kind.fields)
    if isinstance(kind, T.ArrayType):
        return _unhashable(kind.elementType)
    return isinstance(kind, (T.MapType, T.VariantType))


def chunked(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], rows_per_chunk: int
) -> DataFrame | None:
    """``df`` with ``_hash`` and the ``_chunk`` of each row, cut along keys and order; None
    if no key has more than ``rows_per_chunk`` rows."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    found = counts.agg(F.max("n").alias("most"), F.sum("n").alias("all")).first()
    if found["most"] is None or found["most"] <= rows_per_chunk:
        return None
    n = math.ceil(found["all"] / rows_per_chunk)
    hashed = df.withColumn(HASH, row_hash(df))
    cut = hashed.repartitionByRange(n, *_ascending([*keys, *order, HASH]))
    path = run_dir(df.sparkSession, "chunks")
    cut.withColumn(CHUNK, F.spark_partition_id()).write.parquet(path)
    schema = T.StructType([*hashed.schema.fields, T.StructField(CHUNK, T.IntegerType())])
    return df.sparkSession.read.schema(schema).parquet(path)


def dense_chunks(df: DataFrame, position: str, rows_per_chunk: int) -> DataFrame:
    """For positions that number the rows: cut every key at fixed positions."""
    return df.withColumn(CHUNK, F.floor(F.col(position) / rows_per_chunk).cast("int"))


def _ascending(columns: Sequence[str]) -> list[Column]:
    return [F.col(c).asc_nulls_first() for c in columns]


def _descending(columns: Sequence[str]) -> list[Column]:
    return [F.col(c).desc_nulls_last() for c in columns]


def neighbour(
    df: DataFrame,
    keys: Sequence[str],
    position: str,
    values: Mapping[str, str],
    *,
    step: str = "next",
    ties: Sequence[str] = (),
    rows_per_chunk: int = ROWS_PER_CHUNK,
) -> DataFrame:
    """Add columns ``values`` (new name -> source column) of the next / previous row.

    Rows of a key are ordered by ``position`` (a whole number), then ``ties``, ascending
    with NULLs first.
    """
    shift = F.lead if step == "next" else F.lag
    cut = chunked(df, keys, (position, *ties), rows_per_chunk)
    if cut is None:
        w = Window.partitionBy(*keys).orderBy(*_ascending((position, *ties)), row_hash(df))
        return df.select("*", *[shift(src).over(w).alias(out) for out, src in values.items()])
    order = (position, *ties, HASH)

    row = F.struct(*[F.col(src).alias(out) for out, src in values.items()])
    # The row of each chunk its neighbour must see: for "next" the first one.
    seen = Window.partitionBy(*keys, CHUNK).orderBy(
        *(_ascending(order) if step == "next" else _descending(order))
    )
    along = Window.partitionBy(*keys).orderBy(CHUNK)
    sentinels = (
        cut.filter(F.col(CHUNK).isNotNull())
        .select(*keys, CHUNK, *order, row.alias(_VAL))
        .withColumn("_rn", F.row_number().over(seen))
        .filter("_rn = 1")
        .select(*keys, CHUNK, shift(_VAL).over(along).alias(_VAL))
        .filter(F.col(_VAL).isNotNull())
        .withColumn(_EDGE, F.lit(1 if step == "next" else -1))
    )
    rows = cut.withColumn(_VAL, row).withColumn(_EDGE, F.lit(0))
    w = Window.partitionBy(*keys, CHUNK).orderBy(_EDGE, *_ascending(order))
    return (
        rows.unionByName(sentinels, allowMissingColumns=True)
        .withColumn("_near", shift(_VAL).over(w))
        .filter(F.col(_EDGE) == 0)
        .select(*df.columns, *[F.col("_near")[out].alias(out) for out in values])
    )


def carry_forward(
    df: DataFrame,
    keys: Sequence[str],
    position: str,
    values: Mapping[str, str],
    *,
    ties: Sequence[str] = (),
    rows_per_chunk: int = ROWS_PER_CHUNK,
) -> DataFrame:
    """For every row, the last non-NULL source value at or before it (per output column)."""
    upto_here = (Window.unboundedPreceding, Window.currentRow)
    kept = [c for c in df.columns if c not in values]
    cut = chunked(df, keys, (position, *ties), rows_per_chunk)
    if cut is None:
        w = Window.partitionBy(*keys).orderBy(*_ascending((position, *ties)), row_hash(df))
        w = w.rowsBetween(*upto_here)
        last = {out: F.last(src, ignorenulls=True).over(w) for out, src in values.items()}
        return df.select(*kept, *[c.alias(out) for out, c in last.items()])

    # The last value inside each chunk, then the last one of all chunks before. A struct is
    # a position even where its first field is NULL.
    order = (position, *ties, HASH)
    at = F.struct(*order)
    last_in_chunk = [
        F.max_by(src, F.when(F.col(src).isNotNull(), at)).alias(f"_src_{out}")
        for out, src in values.items()
    ]
    earlier = (
        Window.partitionBy(*keys).orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    )
    sentinels = (
        cut.filter(F.col(CHUNK).isNotNull())
        .groupBy(*keys, CHUNK)
        .agg(*last_in_chunk)
        .select(
            *keys,
            CHUNK,
            F.lit(-1).alias(_EDGE),
            *[
                F.last(f"_src_{out}", ignorenulls=True).over(earlier).alias(f"_src_{out}")
                for out in values
            ],
        )
    )
    rows = cut.withColumns(
        {f"_src_{out}": F.col(src) for out, src in values.items()}
    ).withColumn(_EDGE, F.lit(0))
    w = (
        Window.partitionBy(*keys, CHUNK)
        .orderBy(_EDGE, *_ascending(order))
        .rowsBetween(*upto_here)
    )
    filled = {f"_out_{out}": F.last(f"_src_{out}", ignorenulls=True).over(w) for out in values}
    return (
        rows.unionByName(sentinels, allowMissingColumns=True)
        .withColumns(filled)
        .filter(F.col(_EDGE) == 0)
        .select(*kept, *[F.col(f"_out_{out}").alias(out) for out in values])
    )


def running_total(
    df: DataFrame,
    keys: Sequence[str],
    position: str,
    amount: str,
    out: str,
    *,
    rows_per_chunk: int = ROWS_PER_CHUNK,
) -> DataFrame:
    """Sum of ``amount`` over all earlier rows of the key (the row itself not included)."""
    before = (Window.unboundedPreceding, -1)
    cut = chunked(df, keys, (position,), rows_per_chunk)
    if cut is None:
        w = Window.partitionBy(*keys).orderBy(*_ascending([position]), row_hash(df))
        w = w.rowsBetween(*before)
        return df.withColumn(out, F.coalesce(F.sum(amount).over(w), F.lit(0)))

    along = Window.partitionBy(*keys).orderBy(CHUNK).rowsBetween(*before)
    sentinels = (
        cut.filter(F.col(CHUNK).isNotNull())
        .groupBy(*keys, CHUNK)
        .agg(F.sum(amount).alias("_sum"))
        .select(*keys, CHUNK, F.sum("_sum").over(along).alias("_amt"))
        .filter(F.col("_amt").isNotNull())
        .withColumn(_EDGE, F.lit(-1))
    )
    rows = cut.withColumn("_amt", F.col(amount)).withColumn(_EDGE, F.lit(0))
    w = (
        Window.partitionBy(*keys, CHUNK)
        .orderBy(_EDGE, *_ascending([position, HASH]))
        .rowsBetween(*before)
    )
    return (
        rows.unionByName(sentinels, allowMissingColumns=True)
        .withColumn(out, F.coalesce(F.sum("_amt").over(w), F.lit(0)))
        .filter(F.col(_EDGE) == 0)
        .select(*df.columns, out)
    )


def as_of(
    facts: DataFrame,
    history: DataFrame,
    keys: Sequence[str],
    fact_position: str,
    history_position: str,
    values: Sequence[str],
    *,
    ties: Sequence[str] = (),
    rows_per_chunk: int = ROWS_PER_CHUNK,
) -> DataFrame:
    """Give every fact the ``values`` of the last history row at or before its position.

    One union and one window: work is linear in both sides, no pairs are formed.
    """
    hist = history.select(
        *keys,
        F.col(history_position).alias(_POS),
        F.lit(0).alias("_side"),
        *[F.col(t).alias(f"_t_{t}") for t in ties],
        F.struct(*values).alias("_hist"),
    )
    left = facts.select(
        *keys,
        F.col(fact_position).alias(_POS),
        F.lit(1).alias("_side"),
        F.struct(*facts.columns).alias("_fact"),
    )
    both = left.unionByName(hist, allowMissingColumns=True)
    filled = carry_forward(
        both,
        keys,
        _POS,
        {"_found": "_hist"},
        ties=("_side", *[f"_t_{t}" for t in ties]),
        rows_per_chunk=rows_per_chunk,
    )
    return filled.filter("_side = 1").select(
        "_fact.*", *[F.col("_found")[v].alias(v) for v in values]
    )
