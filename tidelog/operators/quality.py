"""Data-quality tests. Every test is a DataFrame of one row with the number of failures."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.session import run_dir
from tidelog.spec import TableSpec

ERROR, WARN = "error", "warn"


def union_all(parts: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), parts)


def _result(table, test: str, column, severity: Column, failures) -> list[Column]:
    return [
        (table if isinstance(table, Column) else F.lit(table)).alias("table_name"),
        F.lit(test).alias("test"),
        column.alias("column_name"),
        severity.alias("severity"),
        failures.alias("failures"),
        F.when(failures == 0, F.lit("pass"))
        .when(severity == ERROR, F.lit("fail"))
        .otherwise(F.lit("warn"))
        .alias("status"),
    ]


def not_null(
    df: DataFrame, table: str, columns: Sequence[str], severity: str = ERROR, where: str | None = None
) -> DataFrame:
    """All columns of the table in one pass without a shuffle of rows. ``where`` names the
    rows that are tested."""
    nulls = _filtered(df, where).agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    pairs = ", ".join(f"'{c}', `{c}`" for c in columns)
    long = nulls.selectExpr(f"stack({len(columns)}, {pairs}) as (c, n)")
    return long.select(
        *_result(table, "not_null", F.col("c"), F.lit(severity), F.col("n"))
    )


def unique(
    df: DataFrame, table: str, key: Sequence[str], severity: str = ERROR, where: str | None = None
) -> DataFrame:
    """Number of key values that occur more than once among the rows that ``where`` names;
    NULL keys are not compared."""
    present = _filtered(df, where)
    for k in key:
        present = present.filter(F.col(k).isNotNull())
    repeated = duplicate_keys(present, key).agg(F.count(F.lit(1)).alias("n"))
    return repeated.select(
        *_result(table, "unique", F.lit(",".join(key)), F.lit(severity), F.col("n"))
    )


def duplicate_keys(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """``GROUP BY key HAVING count(*) > 1``; counts are combined before the shuffle."""
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("n_rows")).filter("n_rows > 1")


def orphan_keys(
    child: DataFrame, fk: str, parent: DataFrame, pk: str, where: str | None = None
) -> DataFrame:
    """Foreign keys without a parent and how many child rows have them.

    Both sides are reduced to one row per key first, so a heavy key weighs nothing in the
    join. A NULL foreign key passes."""
    rows = child.filter(where) if where else child
    counted = (
        rows.filter(F.col(fk).isNotNull())
        .groupBy(fk)
        .agg(F.count(F.lit(1)).alias("n_rows"))
    )
    known = parent.select(F.col(pk).alias(fk)).distinct()
    return counted.join(known, fk, "left_anti")


def relationships(
    child: DataFrame,
    table: str,
    fk: str,
    parent: DataFrame,
    pk: str,
    severity: str = ERROR,
    where: str | None = None,
) -> DataFrame:
    """Number of child rows whose parent is missing."""
    n = F.coalesce(F.sum("n_rows"), F.lit(0)).alias("n")
    failing = orphan_keys(child, fk, parent, pk, where).agg(n)
    return failing.select(
        *_result(table, "relationships", F.lit(fk), F.lit(severity), F.col("n"))
    )


def _filtered(df: DataFrame, where: str | None) -> DataFrame:
    return df.filter(where) if where else df


def _level(spec: TableSpec) -> str:
    """The key of a latest-state table must be unique; in an event log repeats are expected
    and only warned about."""
    return ERROR if spec.mode == "latest" else WARN


def _values(tables: Mapping[str, DataFrame], specs: Sequence[TableSpec]) -> DataFrame:
    """(table, kind, value, n): how often each value of each column that a test needs occurs,
    from one pass per table. A column that several foreign keys point to is counted once."""
    parents = {(fk.parent, fk.parent_column) for s in specs for fk in s.foreign_keys}
    parts = []
    for spec in specs:
        df = tables[spec.name]
        wanted = {",".join(spec.key): F.when(_present(spec.key), key_text(spec.key))}
        wanted |= {c: F.col(c).cast("string") for t, c in sorted(parents) if t == spec.name}
        for fk in spec.foreign_keys:
            value = F.col(fk.column).cast("string")
            wanted[f"-> {fk.column}"] = F.when(F.expr(fk.where), value) if fk.where else value
        kinds = F.array(*[F.struct(F.lit(k).alias("kind"), v.alias("value")) for k, v in wanted.items()])
        each = df.select(F.explode(kinds).alias("x")).select(F.lit(spec.name).alias("table"), "x.kind", "x.value")
        parts.append(each.filter("value is not null"))
    return union_all(parts).groupBy("table", "kind", "value").agg(F.count(F.lit(1)).alias("n"))


def _present(key: Sequence[str]) -> Column:
    there = F.lit(True)
    for k in key:
        there = there & F.col(k).isNotNull()
    return there


def key_text(key: Sequence[str]) -> Column:
    return F.concat_ws("\x1f", *key) if len(key) > 1 else F.col(key[0]).cast("string")


def spec_tests(tables: Mapping[str, DataFrame], specs: Sequence[TableSpec]) -> DataFrame:
    """The tests the contracts imply: required columns, keys, foreign keys.

    Every table is read twice, whatever its number of tests: once for its NULLs, once for
    how often the values of its keys occur. These counts are landed, one row per value; keys
    and all foreign keys are then judged from them, parents shared by their children.
    """
    parts = [not_null(tables[s.name], s.name, s.required) for s in specs]
    spark = tables[specs[0].name].sparkSession
    path, counts = run_dir(spark, "values"), _values(tables, specs)
    counts.write.parquet(path)
    counts = spark.read.schema(counts.schema).parquet(path)
    keys = spark.createDataFrame(
        [(s.name, ",".join(s.key), _level(s)) for s in specs], "table string, kind string, severity string"
    )
    repeated = counts.filter("n > 1").groupBy("table", "kind").agg(F.count(F.lit(1)).alias("n"))
    parts.append(_rolled(keys.join(repeated, ["table", "kind"], "left"), "unique", F.col("kind")))
    links = [
        (s.name, f"-> {fk.column}", fk.column, fk.severity, fk.parent, fk.parent_column)
        for s in specs for fk in s.foreign_keys
    ]
    if links:
        edges = spark.createDataFrame(
            links, "table string, kind string, column string, severity string, parent string, parent_kind string"
        )
        children = counts.join(edges, ["table", "kind"])
        known = counts.select(F.col("table").alias("parent"), F.col("kind").alias("parent_kind"), "value")
        orphans = children.join(known, ["parent", "parent_kind", "value"], "left_anti")
        orphans = orphans.groupBy("table", "kind").agg(F.sum("n").alias("n"))
        parts.append(_rolled(edges.join(orphans, ["table", "kind"], "left"), "relationships", F.col("column")))
    return union_all(parts)


def _rolled(found: DataFrame, test: str, column: Column) -> DataFrame:
    n = F.coalesce("n", F.lit(0).cast("long"))
    return found.select(*_result(F.col("table"), test, column, F.col("severity"), n))


def passes(violations: DataFrame) -> bool:
    """A singular test: any row is a failure."""
    return violations.limit(1).count() == 0


def pii_catalog(spec: TableSpec, df: DataFrame) -> DataFrame:
    """Tagged columns of a table with the number of values that erasure has to reach."""
    tagged = [f for f in spec.schema.fields if (f.metadata or {}).get("is_pii")]
    counts = df.agg(*[F.count(f.name).alias(f.name) for f in tagged])
    rows = ", ".join(
        f"'{f.name}', '{f.metadata['pii_class']}', '{f.metadata['erasure_strategy']}', `{f.name}`"
        for f in tagged
    )
    return counts.selectExpr(
        f"'{spec.name}' as table_name",
        f"stack({len(tagged)}, {rows}) as (column_name, pii_class, erasure_strategy, n_values)",
    )
