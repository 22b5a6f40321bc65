"""Connected components of a graph given as a table of edges.

Alternating large-star and small-star steps: each step replaces the edges by
edges towards the smallest neighbour, and ends when nothing changes, with
every node linked to the smallest node of its component. All state is a
table in the shared folder; the driver sees two numbers a round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import materialize


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    return both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b")
    low = down.groupBy("a").agg(F.min("b").alias("m"))
    joined = down.join(low, "a")
    return joined.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
        low.select("a", F.col("m").alias("b"))
    )


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """``(node, root)`` for every node of ``edges`` ``(a, b)`` (longs): the
    root is the smallest node it can reach, itself included. Loops and
    repeated edges are allowed; an empty table gives an empty one."""
    loops = edges.where("a = b").select(F.col("a").alias("node")).distinct()
    cur = materialize(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), name)
    mark = None
    while True:
        seen = cur.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        if not seen["n"] or mark == (seen["n"], seen["h"]):
            break
        mark = (seen["n"], seen["h"])
        cur = materialize(_small_star(_large_star(cur).distinct()).distinct(), name)
    roots = cur.select(F.col("a").alias("node"), F.col("b").alias("root"))
    tops = roots.select(F.col("root").alias("node")).union(loops).distinct().join(roots, "node", "left_anti")
    return roots.unionByName(tops.select("node", F.col("node").alias("root")))
