"""Row validation: type the text cells, keep good rows, report the others by key only."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.functions.cells import failed_cast, try_typed
from tidelog.operators.contract import check_frozen
from tidelog.spec import TableSpec

BAD, ERRORS = "_bad", "_errors"


def strip_columns(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Drop the columns that must never be ingested; absent ones are no error. As the
    plan does not mention them, the scan does not read them either."""
    return df.drop(*spec.strip)


def with_errors(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Typed contract columns, a verdict, and an array of ``column: reason`` strings.

    All checks are column expressions over one pass. Text that is no value of the column's
    type, a missing required value or a broken rule of the contract is a fault of the row;
    anything else fails the job.
    """
    check_frozen(df, spec)
    tombstone = F.lit(False)
    if spec.delete_image == "key" and "deleted_ts" in df.columns:
        tombstone = F.col("deleted_ts").isNotNull()

    typed, faults = {}, []  # faults: (condition, reason)
    for field in spec.raw_schema.fields:
        if field.name not in df.columns:
            if field.name in spec.columns:
                faults.append((F.lit(True), f"{field.name}: missing"))
            continue
        raw = F.col(field.name)
        if df.schema[field.name].dataType == field.dataType:
            value = raw
        else:
            text = raw.cast("string")
            value = try_typed(text, field.dataType)
            faults.append((failed_cast(text, value), f"{field.name}: type"))
        if field.name in spec.required:
            missing = raw.isNull()
            if field.name not in spec.key:
                missing = missing & ~tombstone
            faults.append((missing, f"{field.name}: missing"))
        typed[field.name] = value
    passed = [c for c in df.columns if c not in typed]
    bad = reduce(lambda a, b: a | b, [cond for cond, _ in faults], F.lit(False))
    none = F.array().cast("array<string>")
    reasons = [F.when(cond, F.array(F.lit(text))).otherwise(none) for cond, text in faults]
    checked = df.select(
        *passed,
        *[v.alias(n) for n, v in typed.items()],
        *[F.col(k).cast("string").alias(f"_key_{k}") for k in spec.key],
        bad.alias(BAD),
        (F.concat(*reasons) if reasons else none).alias(ERRORS),
    )
    if not spec.rules:
        return checked
    broken = {r.name: F.coalesce(~F.expr(r.predicate), F.lit(False)) for r in spec.rules}
    named = [F.when(b, F.array(F.lit(f"rule {n}"))).otherwise(none) for n, b in broken.items()]
    return checked.withColumns(
        {BAD: reduce(lambda a, b: a | b, broken.values(), F.col(BAD)), ERRORS: F.concat(ERRORS, *named)}
    )


def accepted(checked: DataFrame) -> DataFrame:
    drop = [c for c in checked.columns if c.startswith("_key_")]
    return checked.filter(~F.col(BAD)).drop(BAD, ERRORS, *drop)


def quarantined(checked: DataFrame, spec: TableSpec) -> DataFrame:
    """Table, pseudonymous key and reasons; never a value of another column."""
    key = F.concat_ws("|", *[F.col(f"_key_{k}") for k in spec.key])
    kept = [c for c in ("lsn", "load_no", "_load_id") if c in checked.columns]
    return checked.filter(BAD).select(
        F.lit(spec.name).alias("table_name"),
        key.alias("entity_id"),
        F.col(ERRORS).alias("reasons"),
        *kept,
    )


def drop_report(quarantine: DataFrame) -> DataFrame:
    """Rows dropped per table and reason; a row with two faults counts under both."""
    return (
        quarantine.select("table_name", F.explode("reasons").alias("reason"))
        .groupBy("table_name", "reason")
        .agg(F.count(F.lit(1)).alias("n_rows"))
    )


def prepare(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Strip, user hooks, validate; the caller picks the accepted or quarantined part."""
    out = strip_columns(df, spec)
    for step in spec.preprocess:
        out = out.transform(step)
    return with_errors(out, spec)
