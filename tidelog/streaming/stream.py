"""Streaming merges: one query per table, each with its own checkpoint.

Windows are not allowed on a stream, so every merge runs inside ``foreachBatch`` where the
batch is an ordinary frame. The load id is the batch id: after a crash Spark replays the
same batch under the same id, which either overwrites the unfinished attempt or finds its
ledger entry and does nothing.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Mapping
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidelog.operators.contract import SchemaFrozen, check_frozen, unknown_columns
from tidelog.operators.erasure import SUBJECT
from tidelog.operators.validate import BAD, accepted, prepare, quarantined
from tidelog.sources import wal
from tidelog.spec import LATEST, TableSpec
from tidelog.streaming.landing import BATCH_COLUMN
from tidelog.streaming.store import Store


def now() -> datetime:
    return datetime.now(timezone.utc).replace(tzinfo=None)


def feed_stream(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    limits: Mapping[str, str] | None = None,
) -> DataFrame:
    """Landed feed files as a stream. ``limits`` bounds a micro-batch, for example
    ``maxBytesPerTrigger`` or ``maxFilesPerTrigger``. A batch takes whole files: where they
    were landed by ``landing.land_transactions``, it takes whole transactions."""
    reader = spark.readStream.schema(schema)
    for key, value in (limits or {}).items():
        reader = reader.option(key, value)
    return reader.parquet(path).drop(BATCH_COLUMN)


def load_id(batch_id: int) -> str:
    return f"b{batch_id:012d}"


def ingest_batch(
    batch: DataFrame,
    spec: TableSpec,
    store: Store,
    load: str,
    at: datetime,
    *,
    ties: tuple[str, ...] = (),
    keep: tuple[str, ...] = (),
    erased: DataFrame | None = None,
    before_commit: Callable[[], None] | None = None,
) -> bool:
    """The one way a batch enters the store: strip, validate, quarantine, project to the
    contract, hold back erased subjects, merge, and write the ledger entry.

    ``keep`` names columns of the feed that land beside the contract's; ``seq`` always does,
    being part of an event's key. ``erased``: completed requests; later deliveries of these
    subjects don't land. The ledger counts the rows of the batch as they came in; what did
    not land (faulty, repeated, erased) is dropped. Rows are counted in the pass that writes
    a latest-state batch; a log's batch, of which the range of positions must be known first,
    is counted with it and kept in executor storage.
    """
    began = time.monotonic()
    if store.is_committed(spec.name, load):
        return False
    checked = prepare(batch, spec)
    counts = [F.count(F.lit(1)).alias("n"), F.count_if(BAD).alias("bad")]

    def set_aside(bad: int) -> None:
        if bad:
            rows = quarantined(checked, spec)
            if erased is not None:
                rows = without_subjects(rows, erased, "entity_id")
            store.write(rows, f"{spec.name}_quarantine", load, at, rows_in=bad, key=("entity_id",))

    def good(rows: DataFrame) -> DataFrame:
        rows = accepted(rows)
        extra = [c for c in dict.fromkeys(("seq", *keep)) if c in rows.columns]
        names = [c for c in spec.raw_schema.names if c in rows.columns]
        rows = rows.select(*names, *[c for c in extra if c not in names])
        held_back = erased is not None and SUBJECT in rows.columns
        return without_subjects(rows, erased, SUBJECT) if held_back else rows

    if spec.mode == LATEST:
        seen = Observation()

        def rows_in() -> int:
            got = seen.get
            set_aside(got["bad"])
            return got["n"]

        rows = good(checked.observe(seen, *counts))
        return store.merge_batch(
            rows, spec, load, at, ties, rows_in=rows_in, before_commit=before_commit, began=began
        )
    checked = checked.persist()
    try:
        lsn = F.when(~F.col(BAD), F.col("lsn"))
        got = checked.agg(*counts, F.min(lsn).alias("lo"), F.max(lsn).alias("hi")).first()
        set_aside(got["bad"])
        return store.merge_batch(
            good(checked), spec, load, at, ties, span=(got["lo"], got["hi"]), rows_in=got["n"],
            before_commit=before_commit, began=began,
        )
    finally:
        checked.unpersist()


def ingest_messages(
    messages: DataFrame, spec: TableSpec, store: Store, load: str, at: datetime, **options
) -> list[str]:
    """Decode a batch of replication messages and ingest it one table layout at a time.

    Every layout that the batch announces is checked before any row of it lands. Rows of the
    layouts before the first that breaks the contract land as loads ``<load>-0``,
    ``<load>-1`` ..., in order; then ``SchemaFrozen`` names the new columns. After the
    contract was widened the same batch is taken up where it stopped: finished loads are
    skipped. Layouts of other tables are left out. However many layouts there are, the
    payloads are read once.
    """
    scanned = wal.scan(messages)
    changes = wal.decode(scanned)
    announced = wal.relation_versions(changes, wal.relations(scanned)).filter(F.col("relation") == spec.name)
    # One row per layout, a handful.
    layouts = announced.filter("n_changes > 0").orderBy("relation_seq", "slot").collect()
    done = []
    for n, layout in enumerate(layouts):
        extra = unknown_columns(layout["columns"], spec)
        if extra:
            raise SchemaFrozen(f"table {spec.name}: new column(s) {', '.join(extra)}")
        own = changes.filter((F.col("slot") == layout["slot"]) & (F.col("relation_seq") == layout["relation_seq"]))
        ingest_batch(wal.typed_rows(own, spec).drop("slot"), spec, store, f"{load}-{n}", at, **options)
        done.append(f"{load}-{n}")
    return done


def without_subjects(df: DataFrame, requests: DataFrame, key: str) -> DataFrame:
    """Rows of subjects that have no completed request."""
    done = requests.filter("erased_at is not null").select(F.col(SUBJECT).alias(key)).distinct()
    return df.join(done, key, "left_anti").select(*df.columns)


def merge_stream(
    feed: DataFrame,
    spec: TableSpec,
    store: Store,
    checkpoint: str,
    *,
    ties: tuple[str, ...] = (),
    keep: tuple[str, ...] = (),
    erased: DataFrame | None = None,
    clock: Callable[[], datetime] = now,
    before_commit: Callable[[int], None] | None = None,
) -> StreamingQuery:
    """Ingest the feed until all landed files are consumed; see ``ingest_batch``."""
    check_frozen(feed, spec)

    def step(batch: DataFrame, batch_id: int) -> None:
        hook = None if before_commit is None else (lambda: before_commit(batch_id))
        ingest_batch(
            batch, spec, store, load_id(batch_id), clock(),
            ties=ties, keep=keep, erased=erased, before_commit=hook,
        )

    return _start(feed, step, checkpoint)


def _start(feed: DataFrame, step, checkpoint: str) -> StreamingQuery:
    return (
        feed.writeStream.foreachBatch(step)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def run_to_end(query: StreamingQuery) -> None:
    """Wait for an ``availableNow`` query; a failure inside a batch is raised here."""
    query.awaitTermination()


def run_tables(
    feeds: Mapping[str, DataFrame],
    specs: Mapping[str, TableSpec],
    store: Store,
    checkpoint_root: str,
    *,
    tables: list[str] | None = None,
    erased: DataFrame | None = None,
    dry_run: bool = False,
) -> list[str]:
    """Ingest the chosen tables side by side, each with its own progress. A failure stops
    the other streams and is raised; a table without a feed is an error. A dry run returns
    the table names only."""
    unknown = sorted(set(tables or ()) - set(feeds))
    if unknown:
        raise ValueError(f"no feed of table(s) {', '.join(unknown)}")
    chosen = [t for t in feeds if tables is None or t in tables]
    if dry_run:
        return chosen
    running: list[StreamingQuery] = []
    try:
        for t in chosen:
            running.append(
                merge_stream(feeds[t], specs[t], store, f"{checkpoint_root}/{t}", erased=erased)
            )
        waiting = list(running)
        while waiting:  # whichever fails first ends the run
            waiting = [q for q in waiting if not q.awaitTermination(0.2)]
    finally:
        for q in running:
            if q.isActive:
                q.stop()
    return chosen
