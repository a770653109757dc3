"""URL rules, and a blocked Bloom filter in front of an exact join with listed URLs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)(\?[^#]*)?"

#: A block is eight 64-bit words; a key sets one bit in each.
WORDS = 8
#: Blocks of the largest filter: 8 MB of bits. A longer list makes more false positives,
#: which the join removes, but never a larger broadcast.
MAX_BLOCKS = 1 << 17
#: Keys a block is meant for: 16 bits per key.
KEYS_PER_BLOCK = 32


def host_of(url: Column) -> Column:
    """After the first :// up to a slash, question mark or hash, A-Z in lower case."""
    return F.translate(F.coalesce(F.regexp_extract(url, PARTS, 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, PARTS, 2), F.lit(""))


def canonical(url: Column) -> Column:
    """Host without www., path without its last slashes, parameters in order without those
    that only track; neither scheme nor fragment. Empty for null or without ://."""
    query = F.regexp_extract(url, PARTS, 3)
    kept = F.filter(
        F.split(F.substring(query, 2, 1 << 30), "&"),
        lambda p: ~p.rlike("^(utm_[^=]*|ref)(=|$)") & (p != ""),
    )
    kept = F.array_join(F.array_sort(kept), "&")
    return F.coalesce(
        F.concat(
            F.regexp_replace(host_of(url), r"^www\.", ""),
            F.regexp_replace(path_of(url), "/+$", ""),
            F.when(kept != "", F.concat(F.lit("?"), kept)).otherwise(""),
        ),
        F.lit(""),
    )


def rule_of(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> Column:
    """struct(rule, verdict) of the longest of (verdict, host, path) that fits, else null.
    A rule fits its host and all subdomains where the path starts with the rule's. Rules
    are a setting of a few entries; lists of URLs go through ``listed``."""
    found = None
    for verdict, h, p in sorted(rules, key=lambda r: (-len(r[1] + r[2]), r)):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        out = F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict"))
        found = F.when(fits, out) if found is None else found.when(fits, out)
    none = F.lit(None).cast("struct<rule:string,verdict:string>")
    return none if found is None else found.otherwise(none)


def _block(key: Column, n_blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(n_blocks))


def _masks(key: Column) -> list[Column]:
    """One bit per word, from 48 bits of a second hash."""
    h = F.xxhash64(key, F.lit("bits"))
    bit = lambda i: F.shiftrightunsigned(h, 6 * i).bitwiseAND(F.lit(63)).cast("int")
    return [F.call_function("shiftleft", F.lit(1).cast("long"), bit(i)) for i in range(WORDS)]


def bloom(keys: DataFrame, column: str) -> tuple[DataFrame, int]:
    """The filter as rows (block, w0..w7), and its number of blocks: a power of two fit for
    the list's length, at most MAX_BLOCKS. Words are or-ed in the map tasks first."""
    n, blocks = keys.count(), 1
    while blocks < MAX_BLOCKS and blocks * KEYS_PER_BLOCK < n:
        blocks *= 2
    words = [m.alias(f"w{i}") for i, m in enumerate(_masks(F.col(column)))]
    rows = keys.select(_block(F.col(column), blocks).alias("block"), *words)
    merged = rows.groupBy("block").agg(*[F.bit_or(f"w{i}").alias(f"w{i}") for i in range(WORDS)])
    return merged, blocks


def passing(rows: DataFrame, key: str, words: DataFrame, blocks: int) -> DataFrame:
    """Rows with ``_maybe``: whether the filter (see ``bloom``) lets their key pass. It has at
    most MAX_BLOCKS rows of 72 bytes, whatever the list's length, so it may be broadcast."""
    masks = _masks(F.col(key))
    hit = F.lit(True)
    for i in range(WORDS):
        hit = hit & (F.col(f"w{i}").bitwiseAND(masks[i]) == masks[i])
    joined = rows.withColumn("block", _block(F.coalesce(F.col(key), F.lit("")), blocks))
    joined = joined.join(F.broadcast(words), "block", "left")
    return joined.withColumn("_maybe", F.coalesce(hit, F.lit(False))).select(*rows.columns, "_maybe")


def listed(urls: DataFrame, key: str, listing: DataFrame, column: str) -> DataFrame:
    """The rows of ``urls`` and a boolean ``is_listed``: whether ``key`` is in the listing.

    Rows the filter refuses are done. The few it passes meet the listing in an exact join.
    Rows are kept whole: null keys and repeated rows come back as often as they came.
    """
    names = listing.filter(F.col(column).isNotNull()).select(F.col(column).alias("_name")).distinct()
    rows, blocks = bloom(names, "_name")
    joined = passing(urls, key, rows, blocks)
    maybe = joined.filter("_maybe").join(
        names.withColumn("is_listed", F.lit(True)), F.col(key) == F.col("_name"), "left"
    )
    sure = joined.filter("not _maybe")
    return maybe.select(*urls.columns, F.coalesce("is_listed", F.lit(False)).alias("is_listed")).unionAll(
        sure.select(*urls.columns, F.lit(False).alias("is_listed"))
    )


def judge(
    pages: DataFrame, listing: DataFrame, rules: list[tuple[str, str, str]], key: str = "page_id"
) -> DataFrame:
    """(key, host, path, rule, verdict) per row of ``pages``.

    The longest fitting rule decides; without one, a listed URL (its canonical form is in
    ``listing.url``'s canonical forms) is blocked and any other allowed. Null URLs have
    empty host and path and are allowed; an empty listing blocks nothing.
    """
    u = F.col("url").cast("string")
    own = pages.select(F.col(key), u.alias("url")).select(
        key, host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"),
        canonical(F.col("url")).alias("canonical"),
    )
    names = listing.select(canonical(F.col("url").cast("string")).alias("canonical")).filter("canonical != ''")
    out = listed(own, "canonical", names, "canonical")
    out = out.withColumn("fit", rule_of(F.col("host"), F.col("path"), rules))
    mine = F.when(F.col("is_listed"), "block").otherwise("allow")
    return out.select(
        key, "host", "path", F.col("fit.rule").alias("rule"),
        F.coalesce("fit.verdict", mine).alias("verdict"),
    )
