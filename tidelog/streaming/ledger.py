"""The ledger of a store: a log of entries, and folds of the older ones.

``<root>/ledger/<table>/load_id=<id>`` is the entry of one load. Once FOLD_AFTER entries have
gathered, ``<root>/folds/<table>/n=<k>`` is written: all entries so far in two files, the
visible ones apart from those that were replaced. Entries that the fold before last held are
then deleted, and so are older folds. So whatever the number of loads, a reader opens the
newest fold's files and at most a few dozen entries; the visible loads are read without the
replaced ones. An entry that both a fold and the log hold counts once.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog.streaming.files import Files

COMMITTED = 0
LOAD = "_load_id"
FOLD_AFTER = 32

#: Bits of a key filter: SLOTS bitmaps of SLOT_BITS bits each (32 kB a load).
SLOTS, SLOT_BITS = 8, 32768

LEDGER_SCHEMA = T.StructType(
    [
        T.StructField("table_name", T.StringType()),
        T.StructField(LOAD, T.StringType()),
        T.StructField("kind", T.StringType()),
        T.StructField("status", T.IntegerType()),
        T.StructField("inserted_at", T.TimestampNTZType()),
        T.StructField("seconds", T.DoubleType()),
        T.StructField("rows_in", T.LongType()),
        T.StructField("rows_out", T.LongType()),
        T.StructField("rows_dropped", T.LongType()),
        T.StructField("min_lsn", T.LongType()),
        T.StructField("max_lsn", T.LongType()),
        T.StructField("replaces", T.ArrayType(T.StringType())),
        T.StructField("buckets", T.IntegerType()),
        T.StructField("key_columns", T.ArrayType(T.StringType())),
        T.StructField("key_low", T.StringType()),
        T.StructField("key_high", T.StringType()),
        T.StructField("key_bits", T.ArrayType(T.BinaryType())),
    ]
)
#: Fields that say which keys a load may hold; large, so read only where they are asked for.
KEY_FIELDS = ("key_low", "key_high", "key_bits")
PLAIN = [f.name for f in LEDGER_SCHEMA.fields if f.name not in KEY_FIELDS]


def key_text(columns: Iterable[str]) -> Column:
    """A key as one text (NULL if a part is)."""
    return F.concat_ws("\x1f", *columns) if len(list(columns)) > 1 else F.col(list(columns)[0]).cast("string")


def key_filter(columns: list[str]) -> dict[str, Column]:
    """Aggregates that tell which keys can occur: least, greatest, and one bit per key in
    bitmaps of a fixed size. Rows with a NULL in the key are left out."""
    present = F.lit(True)
    for c in columns:
        present = present & F.col(c).isNotNull()
    text = F.when(present, key_text(columns))
    bit = F.pmod(F.xxhash64(text), F.lit(SLOTS * SLOT_BITS))
    slots = [
        F.bitmap_construct_agg(F.when(present & (F.floor(bit / SLOT_BITS) == i), bit % SLOT_BITS))
        for i in range(SLOTS)
    ]
    return {"key_low": F.min(text), "key_high": F.max(text)} | {f"key_{i}": s for i, s in enumerate(slots)}


def may_meet(load, wanted) -> bool:
    """Whether a load can hold one of the wanted keys; both are rows with a key filter."""
    if wanted["key_low"] is None or load["key_low"] is None:
        return False
    # Spark orders text by its bytes.
    low, high = load["key_low"].encode(), load["key_high"].encode()
    if high < wanted["key_low"].encode() or wanted["key_high"].encode() < low:
        return False
    number = lambda b: int.from_bytes(bytes(b), "big")
    return any(number(a) & number(wanted[f"key_{i}"]) for i, a in enumerate(load["key_bits"]))


@dataclass(frozen=True)
class Ledger:
    spark: SparkSession
    root: str
    table: str

    @property
    def folder(self) -> str:
        return f"{self.root}/ledger/{self.table}"

    @property
    def folds(self) -> str:
        return f"{self.root}/folds/{self.table}"

    @property
    def files(self) -> Files:
        return Files(self.spark)

    def entry_path(self, load_id: str) -> str:
        return f"{self.folder}/load_id={load_id}"

    def _fold(self) -> str | None:
        """The newest complete fold."""
        done = [n for n in self.files.children(self.folds) if self.files.exists(f"{self.folds}/{n}/_SUCCESS")]
        return f"{self.folds}/{max(done)}" if done else None

    def _entry_paths(self) -> list[str]:
        names = self.files.children(self.folder)
        return [f"{self.folder}/{n}" for n in names if self.files.is_written(f"{self.folder}/{n}")]

    def _read(self, paths: list[str]) -> DataFrame:
        if not paths:
            return self.spark.createDataFrame([], LEDGER_SCHEMA)
        return self.spark.read.schema(LEDGER_SCHEMA).parquet(*paths)

    def _folded(self, fold: str | None, *parts: str) -> DataFrame:
        """Entries of a fold: visible, replaced, or both."""
        there = [] if fold is None else self.files.children(fold)
        return self._read([f"{fold}/{p}" for p in parts if p in there])

    def entries(self) -> DataFrame:
        """One row per load, replaced ones included."""
        # The log is listed first: an entry that is folded meanwhile is in both, never in neither.
        log, fold = self._entry_paths(), self._fold()
        folded = self._folded(fold, "visible=1", "visible=0")
        if fold is None:
            return self._read(log)
        return self._read(log).join(folded.select(LOAD), LOAD, "left_anti").select(*LEDGER_SCHEMA.names).unionByName(folded)

    def visible(self, columns: list[str] | None = None) -> DataFrame:
        """Entries of committed loads that no later load replaced. Of a fold only its visible
        entries are read."""
        log, fold = self._read(self._entry_paths()).filter(F.col("status") == COMMITTED), self._fold()
        gone = log.select(F.explode("replaces").alias(LOAD)).distinct()
        if fold is not None:
            known = self._folded(fold, "visible=1", "visible=0").select(LOAD)
            log = log.join(known, LOAD, "left_anti").select(*LEDGER_SCHEMA.names)
            log = log.unionByName(self._folded(fold, "visible=1"))
        return log.join(gone, LOAD, "left_anti").select(*(columns or PLAIN))

    def has(self, load_id: str) -> bool:
        """Whether the load is committed: its own entry, else one look into the fold."""
        if self.files.is_written(self.entry_path(load_id)):
            return True
        fold = self._fold()
        if fold is None:
            return False
        done = self._folded(fold, "visible=1", "visible=0").select(LOAD, "status")
        return not done.filter((F.col(LOAD) == load_id) & (F.col("status") == COMMITTED)).isEmpty()

    def add(self, entry: dict) -> None:
        cells = []
        for f in LEDGER_SCHEMA.fields:
            value = entry.get(f.name)
            if isinstance(value, (list, tuple)):
                cell = F.array(*[F.lit(v) for v in value])
            else:
                cell = F.lit(value)
            cells.append(cell.cast(f.dataType).alias(f.name))
        self.spark.range(0, 1, 1, 1).select(*cells).write.mode("overwrite").option(
            "partitionOverwriteMode", "static"
        ).parquet(self.entry_path(entry[LOAD]))
        self.fold()

    def fold(self, after: int | None = None) -> bool:
        """Fold the log once it is long enough. A fold that was cut short is written anew; the
        entries stay until the fold after the next has them, so a reader that listed them
        earlier still finds them."""
        paths, last = self._entry_paths(), self._fold()
        enough = FOLD_AFTER if after is None else after
        # Beside the new entries the log still holds those of the last fold.
        if len(paths) < enough * (1 if last is None else 2):
            return False
        known = set() if last is None else {r[LOAD] for r in self._known(last, paths)}
        done = self.entries()
        gone = done.filter(F.col("status") == COMMITTED).select(F.explode("replaces").alias("_gone")).distinct()
        marked = done.join(gone, F.col(LOAD) == F.col("_gone"), "left")
        visible = (F.col("_gone").isNull() & (F.col("status") == COMMITTED)).cast("int")
        n = 0 if last is None else int(last.rsplit("=", 1)[1]) + 1
        out = marked.withColumn("visible", visible).drop("_gone").coalesce(1).sortWithinPartitions("visible", LOAD)
        out.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("visible").parquet(
            f"{self.folds}/n={n:09d}"
        )
        for path in paths:
            if path.rsplit("=", 1)[1] in known:
                self.files.delete(path)
        for name in self.files.children(self.folds):
            if int(name.rsplit("=", 1)[1]) < n - 1:
                self.files.delete(f"{self.folds}/{name}")
        return True

    def _known(self, fold: str, paths: list[str]) -> list:
        """Which entries of the log a fold holds (a few dozen at most)."""
        names = [p.rsplit("=", 1)[1] for p in paths]
        return self._folded(fold, "visible=1", "visible=0").select(LOAD).filter(F.col(LOAD).isin(names)).collect()
