"""Queries over the scalar functions, on whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidelog.functions import lsn
from tidelog.plans import standins as s
from tidelog.plans.registry import query

# A position spread over both halves, from the order key.
WIDE = "o_orderkey * 1000003 + 17029360"


@query(
    "lsn_to_hex",
    f"""select o_orderkey, printf('%X/%08X', ({WIDE}) >> 32, ({WIDE}) & 4294967295) hex_lsn
        from orders""",
)
def lsn_to_hex(spark, d):
    return s.table(spark, d, "orders").select(
        "o_orderkey", lsn.lsn_to_hex(F.expr(WIDE)).alias("hex_lsn")
    )


@query(
    "lsn_from_hex",
    f"""select o_orderkey, case when o_orderkey % 10 <> 0 then {WIDE} end lsn from orders""",
)
def lsn_from_hex(spark, d):
    """Round trip; text that is no position gives NULL."""
    text = F.when(F.col("o_orderkey") % 10 != 0, lsn.lsn_to_hex(F.expr(WIDE))).otherwise("0-1")
    return s.table(spark, d, "orders").select("o_orderkey", lsn.lsn_from_hex(text).alias("lsn"))


@query("pg_epoch_ts", "select event_id, ts from events")
def pg_epoch_ts(spark, d):
    """There and back through microseconds since 2000."""
    return s.table(spark, d, "events").select(
        "event_id", lsn.from_epoch_2000(lsn.to_epoch_2000(F.col("ts"))).alias("ts")
    )


@query(
    "typmod_facets",
    """select p_partkey,
              case when p_size % 7 <> 0 then cast(p_size % 38 + 1 as bigint) end num_precision,
              case when p_size % 7 <> 0 then cast(p_size % 5 as bigint) end num_scale
       from part""",
)
def typmod_facets(spark, d):
    size = F.col("p_size").cast("bigint")
    packed = F.shiftleft(size % 38 + 1, 16).bitwiseOR(size % 5) + 4
    typmod = F.when(size % 7 != 0, packed).otherwise(F.lit(-1).cast("bigint"))
    return s.table(spark, d, "part").select(
        "p_partkey",
        lsn.numeric_precision(typmod).alias("num_precision"),
        lsn.numeric_scale(typmod).alias("num_scale"),
    )
