"""Mixing sources to target weights: capped water-filling, then whole and fractional
repetitions. DataFrame functions only.

A source's target is its weight's share of the budget, but at most ``epochs`` times its own
size; what a clamped source leaves is reshared by weight among the rest until none is above
its cap. A source is then repeated floor(target / size) times, and of its documents a seeded
sample holding the rest of the words is taken once more.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidelog.llm.common import WORD, landed, text_of

#: Hex digits of the seeded order that name a bucket. Running sums are made in two levels,
#: within a bucket and over a source's 4,096 buckets, so no task holds a whole source.
BUCKET_DIGITS = 3


def source_key(source: Column) -> Column:
    """Sorts by code point with null last."""
    return F.when(source.isNull(), "2").otherwise(F.concat(F.lit("1"), source.cast("string")))


def water_fill(
    sources: DataFrame, weights: tuple[int, ...], share: float, epochs: int
) -> DataFrame:
    """Adds ``target`` to rows (key, source_size), one per source.

    With sources sorted by cap / weight, a source is clamped just when its share of what the
    clamped ones before it leave reaches its cap; so the fixed point of clamping and
    resharing needs two running sums and no loop. The window runs over one row per source:
    sources are a setting of the mix, not a part of the data that grows with documents.
    """
    w = F.element_at(F.array(*[F.lit(x) for x in weights]), (F.col("rank") - 1) % len(weights) + 1)
    ranked = sources.withColumn("rank", F.row_number().over(Window.orderBy("key")))
    ranked = ranked.withColumn("w", w.cast("long")).withColumn("cap", F.col("source_size") * epochs)
    order = Window.orderBy(F.col("cap") / F.col("w"), "key")
    whole = Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("long")
    budget = F.lit(float(share)) * F.sum("source_size").over(whole)
    left = budget - F.coalesce(F.sum("cap").over(before), zero)
    weight_left = F.sum("w").over(whole) - F.coalesce(F.sum("w").over(before), zero)
    full = ranked.withColumn("budget", budget).withColumn("w_all", F.sum("w").over(whole))
    full = full.withColumn("clamped", left * F.col("w") >= F.col("cap") * weight_left)
    clamped = lambda c: F.coalesce(F.sum(F.when(F.col("clamped"), F.col(c))).over(whole), zero)
    level = F.try_divide(F.col("budget") - clamped("cap"), F.col("w_all") - clamped("w"))
    full = full.withColumn("level", level)
    target = F.when(F.col("clamped"), F.col("cap").cast("double")).otherwise(F.col("level") * F.col("w"))
    return full.select("key", "source_size", "n_docs", target.alias("target"))


def mix(
    docs: DataFrame,
    weights: tuple[int, ...] = (5, 2, 1),
    share: float = 1.5,
    epochs: int = 2,
    seed: str = "mix-1",
    key: str = "doc_id",
    order: Column | None = None,
) -> DataFrame:
    """(key, size, source_size, target, copies, taken) per row of ``docs``.

    Size counts words of the whole text, 0 for null or blank. ``weights`` go to the sources
    by code point, null last, repeating. ``copies`` is how often the mix holds the document,
    ``taken`` its words in the mix. The extra sample is a prefix of a seeded order of the
    source's long documents (above its mean size), then of its short ones, which take up
    what the long ones missed: a source's words miss its target by about half a short
    document. The order is a digest of seed and key, so reruns agree. Rows of one key are
    told apart by size. An empty table gives no row; other columns are not read.
    """
    size = F.coalesce(F.regexp_count(text_of("text"), F.lit(WORD)), F.lit(0)).cast("long")
    if order is None:
        order = F.coalesce(F.col(key).cast("string"), F.concat(F.lit("null:"), F.md5(text_of("text"))))
    h = F.md5(F.concat_ws(":", F.lit(seed), order))
    sized = docs.select(
        F.col(key), source_key(F.col("source")).alias("key"), size.alias("size"), h.alias("h")
    )
    sized = landed(sized.withColumn("bucket", F.substring("h", 1, BUCKET_DIGITS)), "sizes")

    buckets = sized.groupBy("key", "bucket").agg(F.count("*").alias("n"), F.sum("size").alias("s"))
    sources = buckets.groupBy("key").agg(F.sum("s").alias("source_size"), F.sum("n").alias("n_docs"))
    sources = water_fill(sources, weights, share, epochs)
    whole = F.coalesce(F.floor(F.try_divide("target", "source_size")), F.lit(0)).cast("long")
    sources = sources.withColumn("whole", whole)
    sources = sources.withColumn("rest", F.col("target") - F.col("whole") * F.col("source_size"))
    # From here on documents meet their source by (source, bucket): even for a hot source.
    by_bucket = landed(buckets.select("key", "bucket").join(sources, "key"), "shares")
    rows = sized.join(by_bucket, ["key", "bucket"])
    rows = rows.withColumn("is_long", F.col("size") * F.col("n_docs") > F.col("source_size"))

    part = ["key", "is_long", "bucket"]
    sums = rows.groupBy(*part).agg(F.sum("size").alias("in_bucket"))
    side = Window.partitionBy("key", "is_long")
    running = side.orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
    sums = sums.select(
        *part,
        (F.sum("in_bucket").over(running) - F.col("in_bucket")).alias("before"),
        F.sum("in_bucket").over(side).alias("side_size"),
    )
    inner = Window.partitionBy(*part).orderBy("h", "size").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.join(sums, part).withColumn(
        "twice_middle", (F.col("before") + F.sum("size").over(inner)) * 2 - F.col("size")
    )
    goal = F.try_divide(F.col("rest") * F.col("side_size"), F.col("source_size"))
    rows = rows.withColumn("long_pick", F.col("is_long") & (F.col("twice_middle") <= goal * 2))
    rows = landed(
        rows.select(
            key, "key", "bucket", "size", "source_size", "target", "whole", "is_long",
            "twice_middle", F.coalesce("long_pick", F.lit(False)).alias("long_pick"),
        ), "order",
    )

    taken = rows.filter("long_pick").groupBy("key").agg(F.sum("size").alias("long_taken"))
    taken = by_bucket.select("key", "bucket", "rest").join(taken, "key", "left")
    short_goal = F.col("rest") - F.coalesce("long_taken", F.lit(0))
    taken = taken.select("key", "bucket", short_goal.alias("short_goal"))
    rows = rows.join(taken, ["key", "bucket"])
    short_pick = ~F.col("is_long") & (F.col("twice_middle") <= F.col("short_goal") * 2)
    pick = (F.col("long_pick") | short_pick) & (F.col("short_goal").isNotNull())
    copies = F.col("whole") + F.when(pick & (F.col("size") > 0), 1).otherwise(0)
    return rows.select(
        key, "size", "source_size", "target",
        copies.alias("copies"), (copies * F.col("size")).alias("taken"),
    )
