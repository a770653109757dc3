"""Connected components of an edge table, as Spark joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.llm.common import landed


#: Edges that a task takes. Every turn shuffles edges by vertex; how many tasks that gives is
#: for tables of documents, and a table of edges is far smaller.
EDGES = 50_000


def _pointed(edges: DataFrame) -> DataFrame:
    """Distinct (a, b) with a > b; loops go."""
    pair = edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    return pair.distinct()


def _tasks(edges: DataFrame) -> int:
    return max(edges.sparkSession.sparkContext.defaultParallelism, edges.count() // EDGES + 1)


def _star(edges: DataFrame, least: DataFrame) -> DataFrame:
    """(x, y, m): each edge with the least of x and its neighbours. ``least`` is landed, so a
    vertex with very many edges meets a single row in the join, of which adaptive execution
    splits the other side."""
    least = least.select(F.col("x").alias("_x"), F.least("x", "least").alias("m"))
    return edges.join(least, edges["x"] == least["_x"]).select("x", "y", "m")


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(v, c): for each vertex of an edge, the smallest vertex it is connected to.

    Large and small stars in turn: every vertex sends its larger neighbours to the least one
    it knows (large star), then its smaller neighbours and itself (small star). Both keep
    components as they are, and the number of edges doesn't grow beyond the vertices and
    edges there are. Trees halve in depth with each turn, whatever the order of the ids: the
    bound is a power of the logarithm of the vertices, against one round per vertex of a path
    for plain label propagation. It ends when every edge leads to a vertex that is smaller
    than all it is connected to: each vertex then either has one smaller neighbour and no
    larger one, or no smaller one, as the counts taken with the least neighbours tell. Edges
    are landed after every turn and never leave the executors.
    """
    now = landed(_pointed(edges.select(F.col(a).alias("a"), F.col(b).alias("b"))), "edges")
    tasks = _tasks(now)
    while True:
        both = now.select(F.col("a").alias("x"), F.col("b").alias("y")).unionAll(now.select("b", "a"))
        around = both.groupBy("x").agg(
            F.min("y").alias("least"), F.count_if(F.expr("y < x")).alias("ups"), F.count_if(F.expr("y > x")).alias("downs")
        )
        around = landed(around.coalesce(tasks), "least")
        if around.filter("ups > 1 or (ups > 0 and downs > 0)").isEmpty():
            return around.select(F.col("x").alias("v"), F.least("x", "least").alias("c"))
        large = _star(both, around).filter("y > x").select(F.col("y").alias("x"), F.col("m").alias("y"))
        large = landed(large.coalesce(tasks), "large")
        small = _star(large, landed(large.groupBy("x").agg(F.min("y").alias("least")).coalesce(tasks), "least"))
        pairs = small.select(F.col("y").alias("a"), F.col("m").alias("b")).unionAll(small.select("x", "m"))
        now = landed(_pointed(pairs).coalesce(tasks), "edges")


def merged(labels: DataFrame, edges: DataFrame) -> DataFrame:
    """``labels`` (v, c) after edges (ca, cb) between components are added; a vertex without
    label is its own component. Only these edges are worked on, not those that led to the
    labels."""
    found = components(edges, "ca", "cb")
    moved = labels.join(found.toDF("_v", "_c"), F.col("c") == F.col("_v"), "left")
    alone = found.join(labels.select("v"), "v", "left_anti")
    return landed(moved.select("v", F.coalesce("_c", "c").alias("c")).unionAll(alone), "labels")
