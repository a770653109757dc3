"""Consistent first copy of a table, and its hand-over to the change feed."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.operators.contract import check_frozen
from tidelog.operators.merge import latest_per_key
from tidelog.operators.validate import strip_columns
from tidelog.spec import CDC_FIELDS, LATEST, TableSpec


def declare_cdc_columns(df: DataFrame) -> DataFrame:
    """Empty position and delete time, so the schema is final before the first change."""
    return df.withColumns({f.name: F.lit(None).cast(f.dataType) for f in CDC_FIELDS})


def snapshot(reader: Callable[[], DataFrame], spec: TableSpec) -> DataFrame:
    """Contract columns of a full read; columns to strip never leave the scan."""
    df = strip_columns(reader(), spec)
    check_frozen(df, spec)
    return declare_cdc_columns(df.select(*spec.columns))


def land_snapshot(df: DataFrame, spec: TableSpec, ties: tuple[str, ...] = ()) -> DataFrame:
    """How a snapshot enters the raw table.

    A latest-state table keeps one row per business key. An event log is keyed by the
    position, which no snapshot row has: every row is appended, none is merged."""
    if spec.mode == LATEST:
        return latest_per_key(df, spec.key, ties)
    return df


def after_snapshot(feed: DataFrame, snapshot_lsn: int) -> DataFrame:
    """Changes the snapshot does not contain yet: no gap, no overlap."""
    return feed.filter(F.col("lsn") > snapshot_lsn)


def not_bootstrapped(snapshot_df: DataFrame, table: str, ledger: DataFrame) -> DataFrame:
    """The snapshot, or nothing if the ledger shows that the table already has one. Then
    the plan is empty and the source is not read again."""
    done = ledger.filter(
        (F.col("table_name") == table)
        & (F.col("kind") == "snapshot")
        & (F.col("status") == 0)
    )
    return snapshot_df if done.isEmpty() else snapshot_df.limit(0)


def jdbc_reader(
    spark: SparkSession,
    url: str,
    spec: TableSpec,
    *,
    split_column: str,
    lower: int,
    upper: int,
    partitions: int,
    properties: dict[str, str],
    snapshot_id: str | None = None,
) -> Callable[[], DataFrame]:
    """Parallel read of a source table, split on a column. Only contract columns are asked
    for. ``snapshot_id`` pins every connection to one exported snapshot."""
    props = dict(properties)
    if snapshot_id:
        props["sessionInitStatement"] = (
            "BEGIN ISOLATION LEVEL REPEATABLE READ; "
            f"SET TRANSACTION SNAPSHOT '{snapshot_id}'"
        )
    columns = ", ".join(dict.fromkeys([*spec.columns, split_column]))

    def read() -> DataFrame:
        return (
            spark.read.format("jdbc")
            .option("url", url)
            .option("dbtable", f"(select {columns} from {spec.name}) s")
            .option("partitionColumn", split_column)
            .option("lowerBound", lower)
            .option("upperBound", upper)
            .option("numPartitions", partitions)
            .options(**props)
            .load()
            .select(*spec.columns)
        )

    return read


def csv_reader(spark: SparkSession, path: str, schema) -> Callable[[], DataFrame]:
    """Header CSV with declared types; empty fields are NULL, bad fields fail the job."""

    def read() -> DataFrame:
        return spark.read.csv(
            path, schema=schema, header=True, mode="FAILFAST", enforceSchema=False
        )

    return read


def parquet_reader(spark: SparkSession, path: str) -> Callable[[], DataFrame]:
    def read() -> DataFrame:
        return spark.read.parquet(path)

    return read
