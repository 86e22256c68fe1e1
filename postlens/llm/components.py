"""Connected components of an edge table by repeated contraction.

Each round hooks every node to its smallest neighbour, halves the paths of that forest by pointer
jumps, and replaces the edges by the edges between roots. Nodes that are no local minimum vanish,
so the edges shrink fast. Sums are map-side (``min``), and the joins run between written tables,
where adaptive execution splits a hot node.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import written


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b), both long; the root is the smallest node
    reachable. Loops are ignored; an edge may come more than once, in either direction."""
    edges = written(edges.select("a", "b").filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    roots = None
    while not edges.isEmpty():
        ends = edges.select(F.col("a").alias("node"), F.col("b").alias("other")).unionByName(edges.select(F.col("b").alias("node"), F.col("a").alias("other")))
        hooked = ends.groupBy("node").agg(F.min("other").alias("least")).select("node", F.least("node", "least").alias("root"))
        hooked = _jump(written(hooked, "hooked"))
        if roots is None:
            roots = hooked
        else:
            roots = written(_through(roots, hooked, "root"), "roots")
        edges = written(
            _through(_through(edges, hooked, "a"), hooked, "b").filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges"
        )
        roots = written(roots, "roots")
    if roots is None:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots


def _through(rows: DataFrame, roots: DataFrame, column: str) -> DataFrame:
    """``rows`` with ``column`` replaced by its root, where it has one."""
    by = roots.select(F.col("node").alias("__n"), F.col("root").alias("__r"))
    return rows.join(by, F.col(column) == F.col("__n"), "left").withColumn(column, F.coalesce("__r", column)).drop("__n", "__r")


def _jump(forest: DataFrame) -> DataFrame:
    return written(_through(forest, forest, "root"), "forest")
