"""Feed files on the shared folder: landed in whole transactions, split by table, erased."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidelog.sources.feed import BATCH_TARGET, txn_batches
from tidelog.streaming.files import Files

_FILE = "_file"
#: Names the folder of a batch of whole transactions.
BATCH_COLUMN = "_batch"
#: Files of rewritten rows wait here, inside the folder and hidden from its readers.
_WAITING = "_erasing"


def land_transactions(feed: DataFrame, path: str, target: int = BATCH_TARGET, slot: str | None = None) -> None:
    """Land a feed as files that end at commits: one per batch of about ``target`` rows, so
    a stream that takes whole files never sees a part of a transaction.

    Rows are dealt by batch; the numbers of batches are joined on, one row per transaction.
    """
    keys = [*([slot] if slot else []), "txn"]
    placed = txn_batches(feed, target, slot=slot).select(*keys, "batch_no")
    rows = feed.join(placed, keys).withColumn(BATCH_COLUMN, F.concat_ws("-", *([slot] if slot else []), "batch_no"))
    dealt = rows.repartition(BATCH_COLUMN).sortWithinPartitions(BATCH_COLUMN, "lsn")
    dealt.drop("batch_no").write.mode("append").partitionBy(BATCH_COLUMN).parquet(path)


def land_by_table(feed: DataFrame, path: str, bookkeeping: Sequence[str] = ()) -> None:
    """Split a feed of several tables in one pass: a folder per ``relation``."""
    kept = feed.filter(~F.col("relation").isin(*bookkeeping)) if bookkeeping else feed
    kept.write.mode("append").partitionBy("relation").parquet(path)


def split_stream(
    feed: DataFrame, path: str, checkpoint: str, bookkeeping: Sequence[str] = ()
) -> StreamingQuery:
    """The same for a stream: one query reads the feed once and lands each table's rows, each
    batch once even after a crash (the sink keeps a log of its files). The tables are read
    from there by ``table_stream``, each with its own progress."""
    kept = feed.filter(~F.col("relation").isin(*bookkeeping)) if bookkeeping else feed
    return (
        kept.writeStream.format("parquet")
        .partitionBy("relation")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def table_stream(spark: SparkSession, path: str, schema, table: str, limits=None) -> DataFrame:
    """One table of a split feed as a stream; ``schema`` is that of the whole feed."""
    reader = spark.readStream.schema(schema)
    for key, value in (limits or {}).items():
        reader = reader.option(key, value)
    return reader.parquet(path).filter(F.col("relation") == table).drop("relation")


def erase_files(spark: SparkSession, folder: str, subjects: DataFrame, key: str, column: str = "patient_id") -> int:
    """Take the subjects' rows out of landed files and say how many there were.

    Files without such rows aren't touched. The others are rewritten under their own names,
    so a stream that has consumed them keeps its progress, and one that hasn't reads them
    without the rows. New files are complete before the first old one is replaced; a run that
    was cut short in between is finished by the next.
    """
    files = Files(spark)
    _finish(spark, folder)
    asked = subjects.select(F.col(column).alias(key)).distinct()
    rows = spark.read.parquet(folder)
    located = rows.withColumn(_FILE, F.col("_metadata.file_path"))
    hits = located.select(key, _FILE).join(asked, key, "left_semi").groupBy(_FILE).agg(F.count(F.lit(1)).alias("n")).collect()
    if not hits:
        return 0
    # One entry per file with a subject's rows. A file lies in a folder of partition values,
    # which its rows don't hold.
    waiting = f"{folder}/{_WAITING}/{uuid.uuid4().hex}"
    names = {h[_FILE]: f"f{i:08d}" for i, h in enumerate(sorted(hits, key=lambda h: h[_FILE]))}
    inside = [c for c in rows.columns if c not in _partition_columns(names, folder)]
    plain = spark.read.schema(rows.select(*inside).schema).parquet(*names)
    numbered = plain.withColumn(_FILE, F.col("_metadata.file_path")).join(
        spark.createDataFrame([(f, n) for f, n in names.items()], f"{_FILE} string, _name string"), _FILE
    )
    kept = numbered.join(asked, key, "left_anti").select(*inside, "_name")
    kept.repartition("_name").write.partitionBy("_name").parquet(f"{waiting}/rows")
    plan = [(n, f) for f, n in names.items()]
    spark.createDataFrame(plan, "name string, target string").coalesce(1).write.parquet(f"{waiting}/plan")
    files.make(f"{waiting}/ready")
    _finish(spark, folder)
    return sum(h["n"] for h in hits)


def _partition_columns(paths, folder: str) -> set[str]:
    """Columns that stand in the folders' names."""
    tail = next(iter(paths)).rsplit("/", 1)[0].split(folder.rsplit("/", 1)[-1], 1)[-1]
    return {part.split("=", 1)[0] for part in tail.split("/") if "=" in part}


def _finish(spark: SparkSession, folder: str) -> None:
    """Put complete new files in the places of the old ones; throw away incomplete attempts."""
    files = Files(spark)
    root = f"{folder}/{_WAITING}"
    for attempt in files.children(root):
        at = f"{root}/{attempt}"
        if files.exists(f"{at}/ready"):
            plan = spark.read.schema("name string, target string").parquet(f"{at}/plan").collect()
            for name, target in plan:
                own = f"{at}/rows/_name={name}"
                parts = [p for p in files.children(own) if p.startswith("part-")]
                if parts:  # else it was moved before the interruption, or nothing is left of it
                    files.replace(f"{own}/{parts[0]}", target)
                elif not files.exists(own):
                    _empty(spark, at, target)
        files.delete(at)


def _empty(spark: SparkSession, at: str, target: str) -> None:
    """A file without rows in the place of one whose rows are all gone."""
    files = Files(spark)
    schema = spark.read.parquet(target).schema
    own = f"{at}/empty-{uuid.uuid4().hex}"
    spark.createDataFrame([], schema).coalesce(1).write.parquet(own)
    files.replace(f"{own}/{next(p for p in files.children(own) if p.startswith('part-'))}", target)
