"""Connected components of an edge table, without ever holding the graph in one place."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from symcube.llm.common import Workspace


def connected_components(edges: DataFrame, a: str = "a", b: str = "b", work: Workspace | None = None, rows: int | None = None) -> DataFrame:
    """(node, root) for every node of an edge, root being the smallest node of its component.

    Each round sends every node to the least node of its neighbourhood, and from there once more, and replaces
    both ends of every edge by where they went; loops and repeats go.  The graph thus shrinks from round
    to round, so all rounds together cost little more than the first.  A node's root is read off by following
    the rounds' maps from the last one back.  For nodes that are hashes the number of rounds is logarithmic.

    ``rows`` bounds the number of edges, if that is known.  Null ends and loops are ignored; without an edge the result is empty.  Hot nodes only widen joins that
    adaptive execution splits, and partial aggregates.
    """
    work = work or Workspace(edges.sparkSession)
    ends = edges.select(F.least(a, b).alias("x"), F.greatest(a, b).alias("y"), (F.col(a) != F.col(b)).alias("differ")).where("differ")
    ends = work.put(ends.select("x", "y").distinct(), "edges", rows)
    nodes = None if rows is None else 2 * rows
    maps = []
    while True:
        both = ends.unionByName(ends.select(F.col("y").alias("x"), F.col("x").alias("y")))
        near = work.put(both.groupBy(F.col("x").alias("node")).agg(F.min("y").alias("low")).select("node", F.least("node", "low").alias("low")), "near", nodes)
        jump = near.select(F.col("node").alias("low"), F.col("low").alias("root"))
        step = work.put(near.join(jump, "low").select("node", "root"), "step", nodes)
        maps.append(step)
        moved = ends.join(step.select(F.col("node").alias("x"), F.col("root").alias("p")), "x").join(step.select(F.col("node").alias("y"), F.col("root").alias("q")), "y")
        ends = work.put(moved.where("p <> q").select(F.least("p", "q").alias("x"), F.greatest("p", "q").alias("y")).distinct(), "edges", rows)
        if ends.isEmpty():
            break
    roots = maps.pop()
    while maps:
        later = roots.select(F.col("node").alias("root"), F.col("root").alias("last"))
        roots = work.put(maps.pop().join(later, "root", "left").select("node", F.coalesce("last", "root").alias("root")), "roots", nodes)
    return roots
