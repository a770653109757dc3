"""Physical plans: what is read, pushed, combined before shuffles; what must not occur."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tidelog.operators import merge
from tidelog.plans import standins as s
from tidelog.sources import feed

SF = "/root/testdata/sf0.001"
# Queries that run jobs (streams, stores) before they return a frame.
EAGER = re.compile(
    r"stream_|raw_|load_ledger|run_metrics|wal|relation_versions|commit_time|drop_report|demux|versions_landed|_run|dq_summary|snapshot_then"
)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_stripped_column_is_never_read(spark):
    text = plan(entry.queries()["snapshot_load"](spark, SF))
    assert "c_name" not in text and "c_custkey" in text


def test_unused_columns_are_pruned(spark):
    text = plan(entry.queries()["high_water_lsn"](spark, SF))
    assert "ReadSchema: struct<event_id:bigint>" in text


def test_latest_row_is_reduced_before_the_shuffle(spark):
    text = plan(entry.queries()["dedup_delivery"](spark, SF))
    assert "WindowGroupLimit" in text and "Partial" in text and "Final" in text


def test_range_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "feed")
    s.consents(spark, SF).write.parquet(path)
    text = plan(feed.change_range(spark.read.parquet(path), 10, 20))
    assert "GreaterThan(lsn,10)" in text and "LessThanOrEqual(lsn,20)" in text


def test_demux_reads_one_folder(spark, tmp_path):
    from tidelog.plans.ingest import mixed_feed

    path = str(tmp_path / "feed")
    mixed_feed(spark, SF).write.partitionBy("relation").parquet(path)
    streams = feed.demux(spark.read.parquet(path), ["providers"], ["_loads"])
    assert list(streams) == ["providers"]
    assert "PartitionFilters: [isnotnull(relation" in plan(streams["providers"])


def test_demux_refuses_bookkeeping(spark):
    with pytest.raises(ValueError, match="_loads"):
        feed.demux(spark.range(1), ["providers", "_loads"], ["_loads"])


def reads(df):
    """Scans in the optimised plan."""
    return len(re.findall(r"Relation \[", df._jdf.queryExecution().optimizedPlan().toString()))


def test_chained_merges_read_each_input_once(spark, tmp_path):
    for i in range(4):
        s.consents(spark, SF).write.parquet(str(tmp_path / f"b{i}"))
    state = spark.read.parquet(str(tmp_path / "b0"))
    for i in range(1, 4):
        state = merge.merge_latest(state, spark.read.parquet(str(tmp_path / f"b{i}")), ["patient_id"])
        assert reads(state) == i + 1


def test_log_merge_reads_the_batch_once(spark, tmp_path):
    log, batch = (str(tmp_path / n) for n in ("log", "batch"))
    for path in (log, batch):
        s.consents(spark, SF).write.parquet(path)
    out = merge.new_events(spark.read.parquet(log), spark.read.parquet(batch), prune=False)
    assert reads(out) == 2
    pruned = plan(merge.new_events(spark.read.parquet(log), spark.read.parquet(batch)))
    assert pruned.count("Subquery") - pruned.count("ReusedSubquery") >= 1


def test_consent_gate_reads_its_columns_only(spark, tmp_path):
    from tidelog.operators import consent

    path = str(tmp_path / "log")
    s.consents(spark, SF).write.parquet(path)
    text = plan(consent.consented(spark.range(1).selectExpr("'a' patient_id"), spark.read.parquet(path), "consent_research"))
    assert "consent_marketing" not in text and "commit_ts" not in text


@pytest.mark.parametrize("name", sorted(n for n in entry.queries() if not EAGER.search(n)))
def test_no_cross_join_no_python(spark, name):
    text = plan(entry.queries()[name](spark, SF))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython"):
        assert bad not in text


def test_contract_tests_read_a_table_twice(spark, tmp_path):
    """Whatever the number of tests: not NULL in one pass, keys and foreign keys in another."""
    from tidelog.operators import quality
    from tidelog.plans.governance import tables
    from tidelog.spec import SPECS

    own = {}
    for name, df in tables(spark, SF).items():
        df.write.parquet(str(tmp_path / name))
        own[name] = spark.read.parquet(str(tmp_path / name))
    specs = list(SPECS.values())
    assert reads(quality._values(own, specs)) == len(specs)
    # What is left: a pass per table for NULLs, and the landed counts, three times.
    assert reads(quality.spec_tests(own, specs)) == len(specs) + 3


def test_feed_is_split_in_one_scan(spark, tmp_path):
    from tidelog.plans.ingest import mixed_feed
    from tidelog.streaming import landing

    mixed_feed(spark, SF).write.parquet(str(tmp_path / "in"))
    source = spark.read.parquet(str(tmp_path / "in"))
    landing.land_by_table(source, str(tmp_path / "out"), ["_loads"])
    parts = feed.demux(spark.read.parquet(str(tmp_path / "out")), ["providers", "patient_consents"], ["_loads"])
    for table, df in parts.items():
        assert df.count() == source.filter(F.col("relation") == table).count() > 0
        assert "PartitionFilters: [isnotnull(relation" in plan(df)
    assert not (tmp_path / "out" / "relation=_loads").exists()


def test_merge_plan_has_one_shuffle(spark):
    df = merge.latest_per_key(s.consents(spark, SF), ["patient_id"])
    assert plan(df).count("Exchange hashpartitioning") == 1
