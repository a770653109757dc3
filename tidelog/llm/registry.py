"""Named queries of this subpackage, each with its SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

# Rows and bytes of one Arrow batch: texts may be long, so a batch stays small.
BATCH_CONF = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(16 << 20),
    "spark.sql.execution.arrow.useLargeVarTypes": "true",
}


def query(name: str, sql: str | None = None):
    """Register a query; ``sql`` is its DuckDB twin."""

    def keep(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            for key, value in BATCH_CONF.items():
                spark.conf.set(key, value)
            return fn(spark, sf_dir)

        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            SQL[name] = sql
        return run

    return keep


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
