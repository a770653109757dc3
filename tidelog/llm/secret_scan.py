"""Secret scans over an incremental blob ledger.

A version of a file is addressed by the SHA-256 of its text. The ledger holds, per blob,
the rule versions that have scanned it and what they found. A run hashes all versions it is
given, scans only pairs of blob and rule version that the ledger lacks, adds them, and joins
the findings back to every path that holds the blob.

A ledger row is true by itself (same content, same rule version, same spans), so rows of a
run that was broken off are kept and repeated rows do no harm.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.llm.common import landed, text_of
from tidelog.llm.urls import bloom, passing
from tidelog.session import run_dir
from tidelog.streaming.files import Files


@dataclass(frozen=True)
class Rule:
    """A kind of secret. ``group`` is the part whose length must reach ``least``; shorter
    matches are consumed and dropped. ``needs``: lower-case words of which a text has one
    if it has a match at all. Raise ``version`` with any change: blobs are then rescanned."""

    kind: str
    pattern: str
    least: int
    group: int = 0
    version: int = 1
    needs: tuple[str, ...] = ()

    @property
    def key(self) -> str:
        return f"{self.kind}@{self.version}"


BASE_RULES = (
    Rule(
        "assign",
        r"(?ai:(password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
        least=8,
        group=2,
        needs=("password", "passwd", "secret", "token", "apikey", "api_key"),
    ),
    # Runs shorter than the least are never part of a longer match, so {n,} finds the same.
    Rule("access", r"AKIA[A-Z0-9]{12,}", least=16, needs=("akia",)),
    Rule("hex", r"[0-9a-f]{32,}", least=32),
)
EXTRA_RULES = (
    Rule(
        "pem",
        r"-----BEGIN (?:[A-Z]+ )*PRIVATE KEY-----(?:[A-Za-z0-9+/=\s]*-----END (?:[A-Z]+ )*PRIVATE KEY-----)?",
        least=27,
        needs=("private key",),
    ),
    Rule("ghp", r"\bgh[pousr]_[A-Za-z0-9]{36,}", least=40, needs=("gh",)),
)
RULES = BASE_RULES + EXTRA_RULES

LEDGER = "blob binary, rules array<string>, found array<struct<kind:string,start:int,stop:int>>"


def blob_of(text) -> F.Column:
    return F.unhex(F.sha2(text_of(text), 256))


def find(text: str, rules: list[tuple[Rule, re.Pattern]]) -> list[tuple[str, int, int]]:
    """Spans of one text in code points, by start, then in the order of the rules."""
    spans = []
    folded = text.lower()
    for at, (rule, pattern) in enumerate(rules):
        if rule.needs and not any(word in folded for word in rule.needs):
            continue
        for m in pattern.finditer(text):
            if m.end(rule.group) - m.start(rule.group) >= rule.least:
                spans.append((m.start(), at, m.end(), rule.kind))
    return [(kind, start, stop) for start, _, stop, kind in sorted(spans)]


def _scan(rules: tuple[Rule, ...]):
    by_key = {r.key: (r, re.compile(r.pattern)) for r in rules}
    fields = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("stop", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            todo = batch.column("todo").to_pylist()
            found = []
            for i, keys in enumerate(todo):
                wanted = [by_key[k] for k in by_key if k in keys]
                spans = find(batch.column("text")[i].as_py(), wanted)
                found.append([{"kind": k, "start": a, "stop": b} for k, a, b in spans])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("blob").cast(pa.binary()),
                    pa.array(todo, pa.list_(pa.string())),
                    pa.array(found, pa.list_(fields)),
                ],
                ["blob", "rules", "found"],
            )

    return run


def ledger_folder(spark: SparkSession) -> str:
    """The folder of the ledger that runs share, or a fresh one."""
    return spark.conf.get("spark.tidelog.blobLedger", None) or run_dir(spark, "blobs")


class BlobLedger:
    """The ledger in one folder of parquet files, appended to by each run.

    ``<path>/gen=<n>`` holds one generation; the newest complete one counts. ``compact``
    writes the next, one row per blob.
    """

    def __init__(self, spark: SparkSession, path: str, rules: tuple[Rule, ...] = RULES):
        self.spark, self.path, self.rules = spark, path, tuple(rules)
        if len({r.kind for r in self.rules}) < len(self.rules):
            raise ValueError("a kind may have one rule at a time")

    def _generation(self) -> int:
        files = Files(self.spark)
        names = [n for n in files.children(self.path) if files.exists(f"{self.path}/{n}/_SUCCESS")]
        return max([int(n.split("=")[1]) for n in names], default=0)

    def rows(self) -> DataFrame:
        """All ledger rows; none before the first run. Reading writes nothing."""
        folder = f"{self.path}/gen={self._generation()}"
        if not Files(self.spark).is_written(folder):
            return self.spark.createDataFrame([], LEDGER)
        return self.spark.read.schema(LEDGER).parquet(folder)

    def compact(self) -> None:
        """One row per blob, with the findings of all its rules. Of a rule that a newer
        version has replaced nothing is kept, if this ledger has the newer one."""
        rule = F.explode(F.when(F.size("rules") > 0, F.col("rules"))).alias("rule")
        rules = self.rows().select("blob", rule).groupBy("blob").agg(F.array_sort(F.collect_set("rule")).alias("rules"))
        found = self.findings().groupBy("blob").agg(
            F.array_sort(F.collect_list(F.struct("kind", "start", "stop"))).alias("found")
        )
        known = F.array(*[F.lit(r.key) for r in self.rules])
        names = F.array(*[F.lit(r.kind) for r in self.rules])
        current = F.filter("rules", lambda r: F.array_contains(known, r) | ~F.array_contains(names, F.split(r, "@")[0]))
        none = F.array().cast("array<struct<kind:string,start:int,stop:int>>")
        out = rules.join(found, "blob", "left").select("blob", current.alias("rules"), F.coalesce("found", none).alias("found"))
        out.write.mode("overwrite").option("compression", "zstd").parquet(f"{self.path}/gen={self._generation() + 1}")

    def unseen(self, versions: DataFrame, text: str = "text") -> DataFrame:
        """One row (blob, text, todo) per blob that some rule version hasn't scanned.

        Hashes are looked up in the ledger first. Texts move only afterwards, and only those
        that a Bloom filter of the unseen blobs (of bounded size) lets pass: with nothing
        new, none does. Copies meet in the map tasks, so a blob with a third of all rows
        costs one row per task; a text crosses the shuffle at most once per map task.
        """
        keys = F.array(*[F.lit(r.key) for r in self.rules])
        seen = self.rows().select("blob", F.explode("rules").alias("rule"))
        seen = seen.groupBy("blob").agg(F.collect_set("rule").alias("seen"))
        todo = F.array_except(keys, F.coalesce("seen", F.array().cast("array<string>")))
        blobs = versions.select(blob_of(text).alias("blob")).distinct().join(seen, "blob", "left")
        open_ = landed(blobs.select("blob", todo.alias("todo")).filter(F.size("todo") > 0), "unseen")
        words, blocks = bloom(open_.select(F.hex("blob").alias("_name")), "_name")
        own = versions.select(blob_of(text).alias("blob"), text_of(text).alias("text"))
        own = passing(own.withColumn("_name", F.hex("blob")), "_name", words, blocks).filter("_maybe")
        own = own.groupBy("blob").agg(F.first("text").alias("text"))
        return own.join(open_, "blob").select("blob", "text", "todo")

    def scan(self, versions: DataFrame, text: str = "text") -> None:
        """Scan what is unseen and append it."""
        fresh = self.unseen(versions, text).mapInArrow(_scan(self.rules), LEDGER)
        fresh.write.mode("append").option("compression", "zstd").parquet(f"{self.path}/gen={self._generation()}")

    def findings(self) -> DataFrame:
        """(blob, kind, start, stop) of the current rule versions, each once."""
        keys = [r.key for r in self.rules]
        kinds = F.create_map(*[F.lit(x) for r in self.rules for x in (r.kind, r.key)])
        one = self.rows().filter(F.size("found") > 0)
        one = one.select("blob", "rules", F.explode("found").alias("f"))
        one = one.select("blob", "rules", "f.kind", "f.start", "f.stop")
        current = F.array_contains("rules", kinds[F.col("kind")]) & kinds[F.col("kind")].isin(keys)
        return one.filter(current).select("blob", "kind", "start", "stop").distinct()

    def spans(self) -> DataFrame:
        """(blob, spans): a blob's findings by start, then in the order of the rules."""
        order = F.create_map(*[F.lit(x) for i, r in enumerate(self.rules) for x in (r.kind, i)])
        span = F.struct("start", order[F.col("kind")].alias("rank"), "stop", "kind")
        return self.findings().groupBy("blob").agg(F.sort_array(F.collect_list(span)).alias("spans"))

    def by_path(self, versions: DataFrame, path: str, text: str = "text") -> DataFrame:
        """(path, spans) of every version, spans null where nothing was found."""
        own = versions.select(path, blob_of(text).alias("blob"))
        return own.join(self.spans(), "blob", "left").select(path, "spans")


def scan_documents(docs: DataFrame, ledger: BlobLedger, key: str = "doc_id") -> DataFrame:
    """Scan a table through the ledger; one row (key, spans) per row of ``docs``.

    Null text is empty and has no span. Repeated rows and equal texts share one scan and
    each get its spans. An empty table gives no row. Other columns are not read.
    """
    ledger.scan(docs)
    return ledger.by_path(docs, key)


def redacted(text: str, spans: str) -> F.Column:
    """The text with each span replaced by its kind in brackets; overlapping spans become
    the first one's. Positions are code points, as in Spark's strings. The pieces between
    spans are listed first and joined once."""
    body = F.col(text)
    piece = "array<struct<begin:int,stop:int,kind:string>>"
    step = lambda acc, s: F.when(
        s["start"] >= acc["at"],
        F.struct(
            F.concat(acc["out"], F.array(F.struct(acc["at"].alias("begin"), s["start"].alias("stop"), s["kind"].alias("kind")))).alias("out"),
            s["stop"].alias("at"),
        ),
    ).otherwise(F.struct(acc["out"].alias("out"), F.greatest(acc["at"], s["stop"]).alias("at")))
    start = F.struct(F.array().cast(piece).alias("out"), F.lit(0).alias("at"))
    cut = lambda x: F.concat(F.substr(body, x["begin"] + 1, x["stop"] - x["begin"]), F.lit("["), x["kind"], F.lit("]"))
    whole = lambda acc: F.concat(F.array_join(F.transform(acc["out"], cut), ""), F.substr(body, acc["at"] + 1))
    return F.aggregate(F.col(spans), start, step, whole)
