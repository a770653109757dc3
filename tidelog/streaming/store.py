"""Loads on a shared folder: data first, ledger entry last.

``<root>/raw/<table>/load_id=<id>`` holds the rows of one load, the ledger (``ledger.py``)
an entry per load. Readers open committed loads only, so a crashed run leaves nothing
visible. A load is never changed after its entry exists; compaction writes a new load that
replaces older ones.

Loads of a latest-state table are bucketed by its key, in as many buckets as the table got
with its first load (``<root>/layout/<table>``). All visible loads together are read as one
bucketed table, so the newest row per key is found bucket by bucket without a shuffle, when
reading and when compacting. An entry also holds which keys its load may have (least,
greatest, a bitmap of fixed size): erasure and merges by another key than the position open
only loads that may hold one of theirs.
"""

from __future__ import annotations

import hashlib
import time
from collections.abc import Mapping
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog.operators.erasure import SUBJECT, pending, purge, stamp, violations
from tidelog.operators.merge import latest_per_key, log_key, new_events
from tidelog.operators.validate import BAD, accepted, prepare, quarantined
from tidelog.sources.snapshot import declare_cdc_columns, land_snapshot
from tidelog.spec import LATEST, TableSpec
from tidelog.streaming.files import Files
from tidelog.streaming.landing import erase_files
from tidelog.streaming.ledger import COMMITTED, KEY_FIELDS, LOAD, PLAIN, Ledger, key_filter, may_meet

class SeveralLoads(RuntimeError):
    """A run left more than one new load where one was expected."""


class ErasureIncomplete(RuntimeError):
    """Rows of requested subjects are left; the requests are not stamped."""


@dataclass(frozen=True)
class Store:
    spark: SparkSession
    root: str
    #: Buckets of a latest-state table that has no load yet; the session's number of shuffle
    #: partitions if not given.
    buckets: int | None = None

    def _data(self, table: str) -> str:
        return f"{self.root}/raw/{table}"

    @property
    def files(self) -> Files:
        return Files(self.spark)

    # ---- ledger -------------------------------------------------------------------

    def _ledger(self, table: str) -> Ledger:
        return Ledger(self.spark, self.root, table)

    def ledger(self, table: str) -> DataFrame:
        """Ledger entries of a table: one row per load."""
        return self._ledger(table).entries().select(*PLAIN)

    def committed(self, table: str) -> list[T.Row]:
        """Visible loads: committed and not replaced by a later one. This is bookkeeping
        (one small entry per visible load), not data; ``overlapping`` reads less."""
        return self._ledger(table).visible().collect()

    def overlapping(self, table: str, low: int, high: int) -> list[str]:
        """Visible loads whose range of positions meets low .. high; only they come back."""
        near = self._ledger(table).visible([LOAD, "min_lsn", "max_lsn"])
        near = near.filter((F.col("min_lsn") <= high) & (F.col("max_lsn") >= low))
        return [r[LOAD] for r in near.collect()]

    def holding(self, table: str, keys: DataFrame, key: list[str]) -> list[str]:
        """Visible loads that may hold one of the keys: none that does is left out."""
        f = key_filter(key)
        wanted = keys.agg(*[c.alias(n) for n, c in f.items()]).first()
        loads = self._ledger(table).visible([LOAD, "key_columns", *KEY_FIELDS]).collect()
        return [e[LOAD] for e in loads if e["key_columns"] != key or may_meet(e, wanted)]

    def is_committed(self, table: str, load_id: str) -> bool:
        return self._ledger(table).has(load_id)

    def new_load(self, table: str, known: set[str]) -> str:
        """The load a run added: ``""`` for none, its id for one, an error for several."""
        added = sorted({e[LOAD] for e in self.committed(table)} - known)
        if len(added) > 1:
            raise SeveralLoads(f"table {table}: {len(added)} new loads")
        return added[0] if added else ""

    # ---- data ---------------------------------------------------------------------

    def write(self, df: DataFrame, table: str, load_id: str, at: datetime, **options) -> bool:
        """Write one load and commit it; see ``_commit`` for the options. Returns False if it
        was committed before: then a replay finds its work done and touches nothing."""
        if self.is_committed(table, load_id):
            return False
        return self._commit(df, table, load_id, at, **options)

    def _commit(
        self,
        df: DataFrame,
        table: str,
        load_id: str,
        at: datetime,
        *,
        kind: str = "changes",
        replaces: tuple[str, ...] = (),
        rows_in=None,
        before_commit=None,
        key: tuple[str, ...] | None = None,
        bucketed: bool = False,
        in_buckets: bool = False,
        began: float | None = None,
    ) -> bool:
        """Data, then the ledger entry with what was counted while the data was written.

        ``rows_in`` is a number or a function that gives it once the data is written. ``key``
        names the columns of the key filter, and of the buckets with ``bucketed``; rows that
        are ``in_buckets`` already are written where they are."""
        began = time.monotonic() if began is None else began
        seen = Observation()
        key = [c for c in key or () if c in df.columns]
        found = {"n": F.count(F.lit(1)), "lo": F.min("lsn"), "hi": F.max("lsn")} | (key_filter(key) if key else {})
        observed = df.observe(seen, *[c.alias(n) for n, c in found.items()])
        path, n_buckets = f"{self._data(table)}/load_id={load_id}", None
        if bucketed:
            n_buckets = self.bucket_count(table)
            self._write_buckets(observed, path, key, n_buckets, in_buckets)
        else:
            # Sorted by position, so that row groups of a file have narrow ranges. Overwriting
            # the load's own folder also clears what a crashed attempt left.
            sorted_by = [c for c in ("lsn", "seq") if c in df.columns]
            observed.sortWithinPartitions(*sorted_by).write.mode("overwrite").option(
                "partitionOverwriteMode", "static"
            ).parquet(path)
        got = seen.get
        taken = rows_in() if callable(rows_in) else rows_in
        taken = got["n"] if taken is None else taken
        if before_commit is not None:
            before_commit()
        entry = {
            "table_name": table, LOAD: load_id, "kind": kind, "status": COMMITTED, "inserted_at": at,
            "seconds": time.monotonic() - began, "rows_in": taken, "rows_out": got["n"],
            "rows_dropped": taken - got["n"], "min_lsn": got["lo"], "max_lsn": got["hi"], "replaces": list(replaces),
            "buckets": n_buckets,
        }
        if key:
            bits = [bytes(got[c]) for c in found if c[:4] == "key_" and c[4:].isdigit()]
            entry |= {"key_columns": key, "key_low": got["key_low"], "key_high": got["key_high"], "key_bits": bits}
        self._ledger(table).add(entry)
        return True

    # ---- buckets ------------------------------------------------------------------

    def bucket_count(self, table: str) -> int:
        """Fixed with the table's first bucketed load."""
        folder = f"{self.root}/layout/{table}"
        there = self.files.children(folder)
        if not there:
            n = self.buckets or int(self.spark.conf.get("spark.sql.shuffle.partitions"))
            self.files.make(f"{folder}/buckets={n}")
            there = self.files.children(folder)
        return int(there[0].split("=")[1])

    def _write_buckets(self, df: DataFrame, path: str, key: list[str], n: int, in_buckets: bool) -> None:
        """One file per bucket. The catalogue entry that writing needs goes right after."""
        self.files.delete(path)
        rows = df if in_buckets else df.repartition(n, *key)
        name = f"tidelog_{hashlib.sha1(path.encode()).hexdigest()[:24]}"
        self.spark.sql(f"drop table if exists {name}")
        rows.write.mode("overwrite").format("parquet").option("path", path).bucketBy(n, *key).sortBy(*key).saveAsTable(name)
        self.spark.sql(f"drop table {name}")

    def _read_buckets(self, table: str, schema: T.StructType, loads: list[str], key: tuple[str, ...], n: int) -> DataFrame:
        """The given loads as one table in ``n`` buckets of the key: an entry of the session's
        catalogue with one partition per load, named by its content."""
        parts = sorted(loads)
        said = "|".join([self.root, table, schema.simpleString(), *key, str(n), *parts])
        name = f"tidelog_{hashlib.sha1(said.encode()).hexdigest()}"
        if not self.spark.catalog.tableExists(name):
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields if f.name != LOAD)
            by = ", ".join(f"`{c}`" for c in key)
            where = self._data(table).replace("'", "\\'")
            self.spark.sql(
                f"create table {name} ({columns}, load_id string) using parquet partitioned by (load_id) "
                f"clustered by ({by}) sorted by ({by}) into {n} buckets location '{where}'"
            )
            spans = " ".join(f"partition (load_id='{p}') location '{where}/load_id={p}'" for p in parts)
            self.spark.sql(f"alter table {name} add if not exists {spans}")
        return self.spark.table(name).withColumnRenamed("load_id", LOAD)

    def read_loads(self, table: str, schema: T.StructType, loads: list[str]) -> DataFrame:
        """Rows of the given loads with ``_load_id``; other folders are not even listed."""
        full = T.StructType([*schema.fields, T.StructField("load_id", T.StringType())])
        if not loads:
            empty = self.spark.createDataFrame([], full)
        else:
            empty = (
                self.spark.read.schema(full)
                .option("basePath", self._data(table))
                .parquet(*[f"{self._data(table)}/load_id={i}" for i in sorted(loads)])
            )
        return empty.withColumnRenamed("load_id", LOAD)

    def read_log(self, table: str, schema: T.StructType) -> DataFrame:
        """All visible rows."""
        return self.read_loads(table, schema, [e[LOAD] for e in self.committed(table)])

    def read_state(self, spec: TableSpec, schema: T.StructType, ties=(), where=None) -> DataFrame:
        """Current rows of a latest-state table: newest row per key over visible loads.
        ``where``, a condition on key columns alone, opens only the buckets it can hold for."""
        rows = self._state_rows(spec, schema, self.committed(spec.name))
        return latest_per_key(rows if where is None else rows.filter(where), spec.key, ties)

    def _state_rows(self, spec: TableSpec, schema: T.StructType, loads: list) -> DataFrame:
        """Rows of loads, in buckets if all of them are."""
        names, counts = [e[LOAD] for e in loads], {e["buckets"] for e in loads}
        if len(counts) != 1 or None in counts:
            return self.read_loads(spec.name, schema, names)
        return self._read_buckets(spec.name, schema, names, spec.key, counts.pop())

    # ---- merges -------------------------------------------------------------------

    def merge_batch(
        self,
        batch: DataFrame,
        spec: TableSpec,
        load_id: str,
        at: datetime,
        ties: tuple[str, ...] = (),
        *,
        span: tuple[int | None, int | None] | None = None,
        **options,
    ) -> bool:
        """Merge one batch. Cost follows the batch, not the table:

        - latest state: the batch's newest row per key becomes a load, keys are resolved
          against older loads when reading or compacting;
        - event log: only visible loads whose position range overlaps the batch's (``span``,
          if the caller knows it), or that may hold one of its keys, are read to find events
          that are there already.
        """
        if self.is_committed(spec.name, load_id):
            return False
        if spec.mode == LATEST:
            fresh = latest_per_key(batch, spec.key, ties)
            return self._commit(fresh, spec.name, load_id, at, key=spec.key, bucketed=True, **options)
        key = log_key(spec.merge_key, batch.columns)
        if "lsn" in key:
            if span is None:
                found = batch.agg(F.min("lsn").alias("lo"), F.max("lsn").alias("hi")).first()
                span = found["lo"], found["hi"]
            near = [] if span[0] is None else self.overlapping(spec.name, *span)
            log = self.read_loads(spec.name, batch.schema, near)
            if near:
                log = log.filter(F.col("lsn").between(*span))
        else:  # events may match anywhere in the log
            near = self.holding(spec.name, batch, list(spec.merge_key))
            log = self.read_loads(spec.name, batch.schema, near)
        fresh = new_events(log, batch, key, ties, prune=False)
        return self._commit(fresh, spec.name, load_id, at, key=self._filter_key(spec), **options)

    @staticmethod
    def _filter_key(spec: TableSpec) -> tuple[str, ...]:
        """What the loads of a log are looked up by: the merge key, or for merges by position
        the entity."""
        return spec.key if "lsn" in spec.merge_key else spec.merge_key

    def bootstrap(
        self, source: DataFrame, spec: TableSpec, at: datetime, ties: tuple[str, ...] = ()
    ) -> bool:
        """Land a validated snapshot once: if this store's own ledger has one of the table,
        nothing is read. Faulty rows go to the quarantine."""
        if self.has_snapshot(spec.name):
            return False
        checked = prepare(declare_cdc_columns(source), spec).persist()
        try:
            counts = checked.agg(F.count(F.lit(1)).alias("n"), F.count_if(BAD).alias("bad")).first()
            if counts["bad"]:
                bad = quarantined(checked, spec)
                self.write(bad, f"{spec.name}_quarantine", "snapshot", at, rows_in=counts["bad"], key=("entity_id",))
            good = land_snapshot(accepted(checked).select(*spec.raw_schema.names), spec, ties)
            latest = spec.mode == LATEST
            key = spec.key if latest else self._filter_key(spec)
            return self._commit(
                good, spec.name, "snapshot", at, kind="snapshot", rows_in=counts["n"], key=key, bucketed=latest
            )
        finally:
            checked.unpersist()

    def has_snapshot(self, table: str) -> bool:
        """Whether the ledger has a committed snapshot of the table, replaced or not."""
        done = (F.col("status") == COMMITTED) & (F.col("kind") == "snapshot")
        return not self.ledger(table).filter(done).isEmpty()

    def compact(
        self,
        spec: TableSpec,
        schema: T.StructType,
        load_id: str,
        at: datetime,
        ties=(),
        *,
        max_rows: int | None = None,
    ) -> bool:
        """Replace visible loads by one. With ``max_rows`` only loads up to that size are
        merged, so recent small loads fold together without rewriting the large ones.
        Tombstones stay, so late rows keep losing."""
        small = [e for e in self.committed(spec.name) if max_rows is None or e["rows_out"] <= max_rows]
        old = tuple(sorted(e[LOAD] for e in small))
        if spec.mode != LATEST:
            rows = self.read_loads(spec.name, schema, list(old)).drop(LOAD)
            key = self._filter_key(spec)
            return self.write(rows, spec.name, load_id, at, kind="compaction", replaces=old, key=key)
        rows = latest_per_key(self._state_rows(spec, schema, small).drop(LOAD), spec.key, ties)
        alike = {e["buckets"] for e in small} == {self.bucket_count(spec.name)}
        return self.write(
            rows, spec.name, load_id, at, kind="compaction", replaces=old, key=spec.key, bucketed=True, in_buckets=alike
        )

    def erase(
        self,
        table: str,
        schema: T.StructType,
        requests: DataFrame,
        load_id: str,
        at: datetime,
        key: str = SUBJECT,
    ) -> bool:
        """Remove the requested subjects. Only loads that hold rows of theirs are rewritten:
        the key filters of the ledger tell which may, a pass over the key column of those
        finds them. Then the data of all replaced loads, older versions included, is deleted.
        False if there was nothing to remove; an error if the id was used before."""
        asked = requests.select(F.col(SUBJECT).alias(key)).distinct()
        near = self.holding(table, asked, [key])
        hit = self.read_loads(table, schema, near).select(key, LOAD).join(asked, key, "left_semi")
        old = sorted(r[LOAD] for r in hit.select(LOAD).distinct().collect())  # at most one row per load
        if old:
            if self.is_committed(table, load_id):
                raise ValueError(f"table {table}: load {load_id} is committed, its id can't erase again")
            entries = {e[LOAD]: e for e in self._ledger(table).visible().collect()}
            columns = [entries[i]["key_columns"] for i in old]
            names = columns[0] if columns[0] and all(c == columns[0] for c in columns) else [key]
            layouts = {entries[i]["buckets"] for i in old}
            rows = purge(self.read_loads(table, schema, old), requests, key).drop(LOAD)
            self._commit(
                rows, table, load_id, at, kind="erasure", replaces=tuple(old), key=tuple(names),
                bucketed=layouts == {self._buckets_if_any(table)} and None not in layouts,
            )
        self.clear_replaced(table)
        return bool(old)

    def _buckets_if_any(self, table: str) -> int | None:
        there = self.files.children(f"{self.root}/layout/{table}")
        return int(there[0].split("=")[1]) if there else None

    def clear_replaced(self, table: str) -> None:
        """Delete the data of loads that committed ones replaced. An erasure has done so for
        all loads replaced before it, so only those replaced since the last erasure (its own
        included, should it have been cut short) are left to do."""
        done = self.ledger(table).filter(F.col("status") == COMMITTED).persist()
        try:
            last = done.filter("kind = 'erasure'").agg(F.max("inserted_at")).first()[0]
            fresh = done if last is None else done.filter(F.col("inserted_at") >= F.lit(last))
            gone = [r[LOAD] for r in fresh.select(F.explode("replaces").alias(LOAD)).distinct().collect()]
        finally:
            done.unpersist()
        for load_id in gone:
            self.files.delete(f"{self._data(table)}/load_id={load_id}")

    def erase_subjects(
        self,
        requests: DataFrame,
        tables: Mapping[str, tuple[T.StructType, str]],
        load_id: str,
        at: datetime,
        *,
        landed: Mapping[str, str] | None = None,
    ) -> tuple[DataFrame, dict[str, int]]:
        """Carry out the pending requests over every retained copy, in the order of ``tables``
        (name -> schema and key column; quarantines have ``entity_id``), then over the feed
        files of ``landed`` (folder -> key column), which a stream may have consumed already.

        Returns the requests, stamped with ``at``, and the rows removed per table and folder.
        Loads get ids made of ``load_id`` and the requests, so another list of requests under
        the same id is carried out, too, and a run that was cut short is taken up where it
        stopped. Nothing is stamped before a check has found no row of the subjects left.
        Without pending requests nothing is read or written.
        """
        waiting = pending(requests)
        subjects = waiting.select(SUBJECT).distinct()
        about = subjects.agg(
            F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64(SUBJECT).cast("decimal(38,0)")).alias("h")
        ).first()
        if not about["n"]:
            return requests, {}
        base = f"{load_id}-{hashlib.sha1(f'{about['n']}:{about['h']}'.encode()).hexdigest()[:12]}"
        removed = {}
        for table, (schema, key) in tables.items():
            asked = subjects.select(F.col(SUBJECT).alias(key))
            log = self.read_loads(table, schema, self.holding(table, asked, [key]))
            removed[table] = log.join(asked, key, "left_semi").count()
            own, again = base, 1
            while self.is_committed(table, own):
                again += 1
                own = f"{base}-{again}"
            self.erase(table, schema, waiting, own, at, key)
        for folder, key in (landed or {}).items():
            removed[folder] = erase_files(self.spark, folder, subjects, key)
        stamped = stamp(requests, F.lit(at).cast("timestamp_ntz"))
        self._check_gone(subjects.withColumn("erased_at", F.lit(at)), tables, landed or {})
        return stamped, removed

    def _check_gone(self, done: DataFrame, tables, landed) -> None:
        copies = {t: self.read_log(t, schema).select(F.col(key).alias(SUBJECT)) for t, (schema, key) in tables.items()}
        copies |= {f: self.spark.read.parquet(f).select(F.col(key).alias(SUBJECT)) for f, key in landed.items()}
        left = violations(copies, done).groupBy("source_table").agg(F.count(F.lit(1)).alias("n")).collect()
        if left:
            raise ErasureIncomplete(", ".join(f"{r['source_table']}: {r['n']} rows left" for r in left))


def load_times(ledger: DataFrame) -> DataFrame:
    return ledger.select(LOAD, "inserted_at")


def latest_load(ledger: DataFrame, prior: str | None = None) -> DataFrame:
    """Newest committed load, other than ``prior`` if given."""
    done = ledger.filter(F.col("status") == COMMITTED)
    if prior is not None:
        done = done.filter(F.col(LOAD) != prior)
    return done.orderBy(F.col("inserted_at").desc(), F.col(LOAD).desc()).limit(1)


def new_load_or_noop(ledger: DataFrame, prior: str) -> DataFrame:
    """One row with the new load's id, or ``noop``."""
    newest = latest_load(ledger, prior).agg(F.max(LOAD).alias("run_id"))
    return newest.select(F.coalesce("run_id", F.lit("noop")).alias("run_id"))


def load_status(ledger: DataFrame) -> DataFrame:
    return ledger.groupBy("status").agg(F.count(F.lit(1)).alias("n_loads"))
