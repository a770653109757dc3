from pyspark.sql import functions as F

from tests.llm.conftest import as_rows, clashing
from tidelog.llm import urls

PAGES = "page_id long, url string"
RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/")]
CASES = [
    ("http://Example.ORG/es/x", "example.org", "/es/x", "example.org/es/", "block"),
    ("http://a.example.org/en/12?q#f", "a.example.org", "/en/12", "example.org/en/1", "block"),
    ("http://notexample.org/es/", "notexample.org", "/es/", "org/", "allow"),
    ("http://org/", "org", "/", "org/", "allow"),
    ("http://xorg/", "xorg", "/", None, "allow"),
    ("http://x.org?a/b", "x.org", "", None, "allow"),
    ("http://x.com/de/://y/", "x.com", "/de/://y/", "com/de/", "block"),
    ("no scheme", "", "", None, "allow"),
    ("", "", "", None, "allow"),
    (None, "", "", None, "allow"),
    ("http://bad.net/p/?utm_source=1#x", "bad.net", "/p/", None, "block"),
    ("https://www.BAD.net/p", "www.bad.net", "/p", None, "block"),
    ("https://bad.net/P", "bad.net", "/P", None, "allow"),
    ("http://É.net/a\nb", "É.net", "/a\nb", None, "allow"),
    ("http://bad.com/fr/", "bad.com", "/fr/", "com/fr/", "allow"),
]
LISTING = ["http://bad.net/p", "http://bad.com/fr/", None, "none", "http://bad.net/p"]


def test_cases(spark):
    pages = spark.createDataFrame([(i, c[0]) for i, c in enumerate(CASES)] + [(0, CASES[0][0]), (None, None)], PAGES)
    listing = spark.createDataFrame([(u,) for u in LISTING], "url string")
    got = as_rows(urls.judge(clashing(pages), listing, RULES), "page_id", "host", "path", "rule", "verdict")
    want = [(i, *c[1:]) for i, c in enumerate(CASES)] + [(0, *CASES[0][1:]), (None, "", "", None, "allow")]
    assert got == sorted(want, key=repr)


def test_filter_refuses_no_listed_key(spark):
    names = spark.range(5000).select(F.concat(F.lit("u"), "id").alias("k"))
    every = spark.range(0, 20000).select(F.concat(F.lit("u"), "id").alias("k"))
    out = urls.listed(every, "k", names, "k")
    assert out.filter("is_listed").count() == 5000 and out.count() == 20000
    rows, blocks = urls.bloom(names, "k")
    assert blocks * urls.KEYS_PER_BLOCK >= 5000 and rows.count() <= blocks


def test_small_filter_stays_exact(spark, monkeypatch):
    monkeypatch.setattr(urls, "MAX_BLOCKS", 1)
    names = spark.range(3000).select(F.concat(F.lit("u"), "id").alias("k"))
    every = spark.range(0, 6000).select(F.concat(F.lit("u"), "id").alias("k"))
    assert urls.listed(every, "k", names, "k").filter("is_listed").count() == 3000


def test_empty(spark):
    none = spark.createDataFrame([], PAGES)
    some = spark.createDataFrame([(1, "http://a.net/")], PAGES)
    assert urls.judge(none, some, RULES).count() == 0
    assert as_rows(urls.judge(some, none, RULES), "verdict") == [("allow",)]
    assert as_rows(urls.judge(some, some, []), "rule", "verdict") == [(None, "block")]
