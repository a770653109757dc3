"""The four tables and the change feeds, derived from the given tables, in both dialects.

Each frame function has a SQL twin in ``CTE`` under the same name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tag(prefix: str, number: Column) -> Column:
    return F.concat(F.lit(prefix), number.cast("string"))


def null_of(dtype: str) -> Column:
    return F.lit(None).cast(dtype)


def providers(spark: SparkSession, d: str) -> DataFrame:
    joined = table(spark, d, "supplier").join(
        table(spark, d, "nation"), F.col("s_nationkey") == F.col("n_nationkey")
    )
    return joined.select(
        tag("PR", F.col("s_suppkey")).alias("provider_id"),
        F.col("s_name").alias("name"),
        F.when(F.col("s_suppkey") % 10 != 0, F.col("n_name")).alias("specialty"),
    )


def patients(spark: SparkSession, d: str) -> DataFrame:
    """One version per order; ``name`` is the column that must not be ingested."""
    joined = table(spark, d, "orders").join(
        table(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey")
    )
    key = F.col("o_orderkey")
    return joined.select(
        tag("PT", F.col("o_custkey")).alias("patient_id"),
        F.col("c_name").alias("name"),
        F.when(key % 10 != 0, tag("PR", key % 120)).alias("primary_provider_id"),
        F.lpad((key % 10000).cast("string"), 4, "0").alias("postcode"),
        F.col("o_orderdate").alias("updated_at"),
        (key + 1).alias("lsn"),
    )


def appointments(spark: SparkSession, d: str) -> DataFrame:
    """Repeated deliveries of one ``event_id`` are in the data; ``part`` breaks their ties."""
    joined = table(spark, d, "lineitem").join(
        table(spark, d, "orders"), F.col("l_orderkey") == F.col("o_orderkey")
    )
    event = F.concat(
        F.col("l_orderkey").cast("string"), F.lit("-"), F.col("l_linenumber").cast("string")
    )
    status = (
        F.when(F.col("l_returnflag") == "A", "completed")
        .when(F.col("l_returnflag") == "R", "cancelled")
        .otherwise("scheduled")
    )
    return joined.select(
        event.alias("event_id"),
        tag("AP", F.col("l_orderkey")).alias("appointment_id"),
        tag("PT", F.col("o_custkey")).alias("patient_id"),
        tag("PR", F.col("l_suppkey")).alias("provider_id"),
        F.col("o_orderdate").alias("scheduled_at"),
        status.alias("status"),
        F.col("l_shipdate").alias("event_timestamp"),
        (F.col("l_shipdate") + F.expr("interval 1 day")).alias("ingested_at"),
        F.col("l_partkey").alias("part"),
    )


APPOINTMENT_TIES = ("event_timestamp", "part", "provider_id")


def consents(spark: SparkSession, d: str) -> DataFrame:
    """Consent change feed."""
    # props is a flat object; the pattern is several times cheaper than a JSON parse.
    number = F.regexp_extract("props", r'"k":\s*(-?\d+)', 1)
    e = table(spark, d, "events").withColumn("k", number.cast("bigint"))
    k = F.col("k")
    gone = F.col("event_type") == "error"
    op = (
        F.when(F.col("event_type") == "signup", "I").when(gone, "D").otherwise("U")
    )
    return e.select(
        tag("PT", F.col("user_id")).alias("patient_id"),
        (F.col("event_id") + 1).alias("lsn"),
        F.col("ts").alias("commit_ts"),
        op.alias("op"),
        F.when(~gone, k % 2 == 0).alias("consent_research"),
        F.when(~gone, k % 3 == 0).alias("consent_marketing"),
        F.when(~gone, k % 5 == 0).alias("consent_partner_share"),
        F.when(gone, F.col("ts")).alias("deleted_ts"),
        F.floor(F.col("event_id") / 7).alias("txn"),
    )


def with_loads(spark: SparkSession, d: str, feed: DataFrame) -> DataFrame:
    """Four consecutive loads of equal length, numbered 0 to 3."""
    total = table(spark, d, "events").agg(F.max("event_id") + 1).scalar()
    return feed.withColumn("load_no", F.floor((F.col("lsn") - 1) * 4 / total))


def provider_changes(spark: SparkSession, d: str) -> DataFrame:
    """Provider change feed: the events again, under a hundred provider keys."""
    e = table(spark, d, "events")
    key = F.col("user_id") % 100
    gone = F.col("event_type") == "error"
    return e.select(
        tag("PR", key).alias("provider_id"),
        tag("Provider ", key).alias("name"),
        F.col("event_type").alias("specialty"),
        (F.col("event_id") + 1).alias("lsn"),
        F.col("ts").alias("commit_ts"),
        F.when(F.col("event_type") == "signup", "I")
        .when(gone, "D")
        .otherwise("U")
        .alias("op"),
        F.when(gone, F.col("ts")).alias("deleted_ts"),
    )


def consent_snapshot(spark: SparkSession, d: str) -> DataFrame:
    """Every subject once, all flags granted, no position."""
    users = table(spark, d, "events").select("user_id").distinct()
    return users.select(
        tag("PT", F.col("user_id")).alias("patient_id"),
        F.lit(True).alias("consent_research"),
        F.lit(True).alias("consent_marketing"),
        F.lit(True).alias("consent_partner_share"),
        null_of("bigint").alias("lsn"),
        null_of("timestamp_ntz").alias("deleted_ts"),
    )


def erasure_requests(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "customer").filter((F.col("c_custkey") % 50).isin(0, 1))
    done = F.lit("2024-02-01 00:00:00").cast("timestamp_ntz")
    return c.select(
        tag("PT", F.col("c_custkey")).alias("patient_id"),
        F.when(F.col("c_custkey") % 50 == 1, done).alias("erased_at"),
    )


def load_entries(spark: SparkSession, d: str) -> DataFrame:
    """A ledger over the consent feed: one entry per load, committed when its last event
    happened; the last load did not finish."""
    loads = with_loads(spark, d, consents(spark, d)).groupBy("load_no").agg(
        F.max("commit_ts").alias("inserted_at"),
        F.count(F.lit(1)).alias("rows_out"),
        F.min("lsn").alias("min_lsn"),
        F.max("lsn").alias("max_lsn"),
    )
    return loads.select(
        F.lit("patient_consents").alias("table_name"),
        F.col("load_no").cast("string").alias("_load_id"),
        F.when(F.col("load_no") == 0, "snapshot").otherwise("changes").alias("kind"),
        F.when(F.col("load_no") == 3, 1).otherwise(0).alias("status"),
        "inserted_at",
        "rows_out",
        "min_lsn",
        "max_lsn",
    )


# ---- replication messages ------------------------------------------------------------

SLOT = "slot_patient_consents"
RELATION_ID = 16385
# Source type numbers of text and boolean.
TEXT_OID, BOOL_OID = 25, 16


def _i(value: Column, size: int) -> Column:
    """Big-endian bytes of a whole number."""
    return F.unhex(F.substring(F.lpad(F.hex(value.cast("bigint")), 16, "0"), 17 - 2 * size, 2 * size))


def _b(text: str) -> Column:
    return F.encode(F.lit(text), "UTF-8")


def _cell(value: Column) -> Column:
    data = F.encode(value, "UTF-8")
    sent = F.concat(_b("t"), _i(F.octet_length(value), 4), data)
    return F.when(value.isNull(), _b("n")).otherwise(sent)


def _layout(columns: list[tuple[str, int, bool]]) -> Column:
    zero = F.unhex(F.lit("00"))
    parts = [
        _b("R"),
        _i(F.lit(RELATION_ID), 4),
        _b("public"),
        zero,
        _b("patient_consents"),
        zero,
        _b("d"),
        _i(F.lit(len(columns)), 2),
    ]
    for name, oid, key in columns:
        parts += [_i(F.lit(int(key)), 1), _b(name), zero, _i(F.lit(oid), 4), _i(F.lit(-1), 4)]
    return F.concat(*parts)


CONSENT_LAYOUT = [
    ("patient_id", TEXT_OID, True),
    ("consent_research", BOOL_OID, False),
    ("consent_marketing", BOOL_OID, False),
    ("consent_partner_share", BOOL_OID, False),
]


def wal_messages(spark: SparkSession, d: str) -> DataFrame:
    """The consent feed as replication messages of one slot: ``slot, seq, lsn, payload``.

    Transactions wrap seven events; the table gets one more column from load 2 on."""
    flags = ["consent_research", "consent_marketing", "consent_partner_share"]
    words = {c: F.when(F.col(c), "t").when(~F.col(c), "f") for c in flags}
    wide = F.col("load_no") >= 2
    # Built in steps, so that each step's columns are computed once.
    feed = (
        with_loads(spark, d, consents(spark, d))
        .withColumns(words)
        .withColumns({f"_{c}": _cell(F.col(c)) for c in ["patient_id", *flags]})
        .withColumn("_extra", F.when(wide, 1).otherwise(0))
    )
    event = F.col("lsn") - 1
    count = _i(F.col("_extra") + 4, 2)
    nulls = F.when(wide, _b("nnnn")).otherwise(_b("nnn"))
    channel = F.when(wide, _cell(F.lit("web"))).otherwise(F.unhex(F.lit("")))
    new = F.concat(count, *[F.col(f"_{c}") for c in ["patient_id", *flags]], channel)
    old = F.concat(count, F.col("_patient_id"), nulls)
    feed = feed.withColumns({"_new": new, "_old": old})
    new, old = F.col("_new"), F.col("_old")
    head = F.concat(F.encode("op", "UTF-8"), _i(F.lit(RELATION_ID), 4))
    with_old = (F.col("op") == "U") & (event % 5 == 0)
    payload = (
        F.when(F.col("op") == "D", F.concat(head, _b("K"), old))
        .when(with_old, F.concat(head, _b("K"), old, _b("N"), new))
        .otherwise(F.concat(head, _b("N"), new))
    )
    changes = feed.select(
        "txn", "commit_ts", "load_no", event.alias("event"), payload.alias("change")
    )
    # A transaction has at most seven changes.
    txns = changes.groupBy("txn").agg(
        F.collect_list(F.struct("event", "change")).alias("changes"),
        F.min("event").alias("first"),
        F.max("event").alias("last"),
        F.max("commit_ts").alias("at"),
        F.min(F.when(wide, F.col("event"))).alias("first_wide"),
    )
    micros = F.unix_micros(F.col("at").cast("timestamp")) - F.lit(946684800000000)
    end = F.col("last") + 1
    total = table(spark, d, "events").agg(F.max("event_id") + 1).scalar()
    begin = F.concat(_b("B"), _i(end, 8), _i(micros, 8), _i(F.col("txn"), 4))
    commit = F.concat(_b("C"), _i(F.lit(0), 1), _i(end, 8), _i(end, 8), _i(micros, 8))
    truncate = F.concat(_b("T"), _i(F.lit(1), 4), _i(F.lit(0), 1), _i(F.lit(RELATION_ID), 4))
    wide_layout = _layout([*CONSENT_LAYOUT, ("channel", TEXT_OID, False)])
    # Load 2 starts at the first event past half of all events.
    turn = F.col("first_wide").isNotNull() & (F.col("first_wide") == F.ceil(total / 2))

    def message(when: Column, seq: Column, lsn: Column, data: Column) -> Column:
        made = F.struct(seq.alias("seq"), lsn.alias("lsn"), data.alias("payload"))
        return F.when(when, made)

    framing = F.array_compact(
        F.array(
            message(F.lit(True), F.col("first") * 10 - 3, end, begin),
            message(F.col("first") == 0, F.lit(-1).cast("bigint"), end, _layout(CONSENT_LAYOUT)),
            message(turn, F.col("first_wide") * 10 - 1, end, wide_layout),
            message(F.col("txn") % 50 == 0, F.col("last") * 10 + 2, end, truncate),
            message(F.lit(True), F.col("last") * 10 + 3, end, commit),
        )
    )
    body = F.transform(
        "changes",
        lambda c: F.struct(
            (c["event"] * 10).alias("seq"),
            (c["event"] + 1).alias("lsn"),
            c["change"].alias("payload"),
        ),
    )
    messages = txns.select(F.explode(F.concat(framing, body)).alias("m"))
    return messages.select(F.lit(SLOT).alias("slot"), "m.seq", "m.lsn", "m.payload")


# ---- the same in SQL -----------------------------------------------------------------

CTE = {
    "providers": """
        select concat('PR', cast(s_suppkey as varchar)) provider_id, s_name as name,
               case when s_suppkey % 10 <> 0 then n_name end specialty
        from supplier join nation on s_nationkey = n_nationkey""",
    "patients": """
        select concat('PT', cast(o_custkey as varchar)) patient_id, c_name as name,
               case when o_orderkey % 10 <> 0
                    then concat('PR', cast(o_orderkey % 120 as varchar)) end primary_provider_id,
               lpad(cast(o_orderkey % 10000 as varchar), 4, '0') postcode,
               o_orderdate updated_at, o_orderkey + 1 lsn
        from orders join customer on o_custkey = c_custkey""",
    "appointments": """
        select concat(cast(l_orderkey as varchar), '-', cast(l_linenumber as varchar)) event_id,
               concat('AP', cast(l_orderkey as varchar)) appointment_id,
               concat('PT', cast(o_custkey as varchar)) patient_id,
               concat('PR', cast(l_suppkey as varchar)) provider_id, o_orderdate scheduled_at,
               case l_returnflag when 'A' then 'completed' when 'R' then 'cancelled'
                    else 'scheduled' end status,
               l_shipdate event_timestamp, l_shipdate + interval 1 day ingested_at,
               l_partkey part
        from lineitem join orders on l_orderkey = o_orderkey""",
    "ev": """
        select *, cast(json_extract(props, '$.k') as bigint) k,
               event_type = 'error' gone,
               case event_type when 'signup' then 'I' when 'error' then 'D' else 'U' end op,
               event_id * 4 // (select max(event_id) + 1 from events) load_no
        from events""",
    "consents": """
        select concat('PT', cast(user_id as varchar)) patient_id, event_id + 1 lsn,
               ts commit_ts, op,
               case when not gone then k % 2 = 0 end consent_research,
               case when not gone then k % 3 = 0 end consent_marketing,
               case when not gone then k % 5 = 0 end consent_partner_share,
               case when gone then ts end deleted_ts, event_id // 7 txn, load_no
        from ev""",
    "provider_changes": """
        select concat('PR', cast(user_id % 100 as varchar)) provider_id,
               concat('Provider ', cast(user_id % 100 as varchar)) as name,
               event_type specialty, event_id + 1 lsn, ts commit_ts, op,
               case when gone then ts end deleted_ts, load_no
        from ev""",
    "consent_snapshot": """
        select distinct concat('PT', cast(user_id as varchar)) patient_id,
               true consent_research, true consent_marketing, true consent_partner_share,
               cast(null as bigint) lsn, cast(null as timestamp) deleted_ts
        from events""",
    "erasure_requests": """
        select concat('PT', cast(c_custkey as varchar)) patient_id,
               case when c_custkey % 50 = 1 then timestamp '2024-02-01 00:00:00' end erased_at
        from customer where c_custkey % 50 in (0, 1)""",
    "load_entries": """
        select 'patient_consents' table_name, cast(load_no as varchar) _load_id,
               case when load_no = 0 then 'snapshot' else 'changes' end kind,
               case when load_no = 3 then 1 else 0 end status,
               max(ts) inserted_at, count(*) rows_out, min(event_id) + 1 min_lsn,
               max(event_id) + 1 max_lsn
        from ev group by load_no""",
}


def sql(body: str, *names: str) -> str:
    """``with <named stand-ins> <body>``; feeds built on ``ev`` pull it in."""
    wanted = list(dict.fromkeys(names))
    if any("from ev" in CTE[n] for n in wanted) and "ev" not in wanted:
        wanted.insert(0, "ev")
    parts = ", ".join(f"{n} as ({CTE[n]})" for n in wanted)
    return f"with {parts} {body}" if parts else body
