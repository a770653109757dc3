"""The corpus pipeline: quality rules, near-dedup, decontamination, secrets, mixing.

Each stage is a function of (spark, docs, sf_dir) that returns a DataFrame; ``run`` writes
what it returns as Parquet in the shared folder and gives the next stage the reread table.
All stages but the last return the columns of ``docs``, other columns of any name included;
the last adds one.

Stages decide row by row: a row is a document, whatever its doc_id, and rows that repeat a
doc_id or have none are each judged by their own text. A row is named by its place in the
files of ``docs`` (a frame that isn't a table of files is written first). Null texts are
empty (and fail the quality rules). An empty table passes through all stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from tidelog.llm import decontam, mixing, neardup, quality, secret_scan
from tidelog.llm.common import free_name, landed, text_of
from tidelog.llm.registry import query, table


def _numbered(docs: DataFrame) -> tuple[DataFrame, str]:
    """``docs`` with a number per row, the same in every scan of its files: the scan's tasks
    take the same rows of the same files in the same order."""
    try:
        docs.select("_metadata.row_index")
    except AnalysisException:
        docs = landed(docs, "docs")
    name = free_name(docs, "row_number")
    return docs.withColumn(name, F.monotonically_increasing_id()), name


def _kept(numbered: DataFrame, row: str, ids: DataFrame) -> DataFrame:
    """The rows whose number is among ``ids`` (one column)."""
    ids = ids.toDF("_id")
    return numbered.join(ids, numbered[row] == ids["_id"], "left_semi").drop(row)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules or the outlier test reject go."""
    numbered, row = _numbered(docs)
    return _kept(numbered, row, quality.judge(numbered, row).filter("kept").select("doc_id"))


#: Near duplicates of the corpus share this percentage of their five-word shingles or more.
#: The query op3 has its own, 85.
NEAR = 80


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates, the row with the smallest doc_id stays (without one,
    last; of rows with the same, the first). Rows without words are in no group and stay."""
    numbered, row = _numbered(docs)
    linked = neardup.link(numbered, row, threshold=NEAR).select(F.col("doc_id").alias("_row"), "component_id")
    ids = numbered.select(F.col(row).alias("_row"), F.col("doc_id").alias("_doc"))
    order = F.struct(F.col("_doc").isNull(), "_doc", "_row")
    first = linked.join(ids, "_row").groupBy("component_id").agg(F.min(order).alias("m"))
    return _kept(numbered, row, first.select("m._row"))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold an item of the benchmark go."""
    numbered, row = _numbered(docs)
    leaks = decontam.contaminated(numbered, table(spark, sf_dir, "benchmark"), row)
    leaks = leaks.select(F.col("doc_id").alias("_id")).distinct()
    return numbered.join(leaks, numbered[row] == leaks["_id"], "left_anti").drop(row)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each secret is replaced by its kind in brackets; n_chars follows the text."""
    ledger = secret_scan.BlobLedger(spark, secret_scan.ledger_folder(spark))
    ledger.scan(docs)
    blob, spans = free_name(docs, "blob"), free_name(docs, "spans")
    found = landed(ledger.spans(), "spans").select(F.col("blob").alias(blob), F.col("spans").alias(spans))
    marked = docs.withColumn(blob, secret_scan.blob_of("text")).join(found, blob, "left")
    clean = free_name(docs, "clean")
    marked = marked.withColumn(clean, F.when(F.col(spans).isNotNull(), secret_scan.redacted("text", spans)))
    out = {"text": F.coalesce(clean, "text")}
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        out["n_chars"] = F.when(F.col(clean).isNull(), F.col("n_chars")).otherwise(F.length(clean).cast(kind))
    return marked.select(*[out[c].alias(c) if c in out else F.col(c) for c in docs.columns])


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix itself: a row per repetition of a document, numbered by ``copy`` from 1. The
    seeded order is one of doc_id and text, so it doesn't depend on files."""
    numbered, row = _numbered(docs)
    order = F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.md5(text_of("text")))
    mixed = mixing.mix(numbered, weights=(5, 2, 1), share=1.5, epochs=2, key=row, order=order)
    times = mixed.filter("copies > 0").select(F.col(row).alias("_id"), F.col("copies").alias("_n"))
    joined = numbered.join(times, numbered[row] == times["_id"])
    copy = free_name(docs, "copy")
    repeats = F.explode(F.sequence(F.lit(1), F.col("_n").cast("int"))).alias(copy)
    return joined.select(*[numbered[c] for c in docs.columns], repeats)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("secrets", secrets),
    ("mix_sources", mix_sources),
]

#: Bands and outlier estimates have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole of ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = landed(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)


query("pipeline")(run)
