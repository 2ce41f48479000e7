"""Connected components of an undirected graph, by alternating star rewrites.

An edge list is rewritten until every node points at the smallest node of its
component: the large star links a node's greater neighbours to its smallest one,
the small star its smaller neighbours. Each rewrite keeps the components and
never adds an edge, and the number of rounds grows with the logarithm of the
longest path. The smallest neighbour is an aggregate that combines before the
shuffle, and giving it back is an equality join, so a node with very many
neighbours is split like any other skewed key.

Defined results: nodes without an edge do not occur; repeated and reversed edges
and loops change nothing; an empty edge list gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termlift.plans.scale import written


def _pulled(edges: DataFrame, keep_greater: bool) -> DataFrame:
    """Edges (a, b): link each b, and a itself, to the smallest of a and its neighbours."""
    least = edges.groupBy(F.col("a").alias("c")).agg(F.min("b").alias("low"))
    root = F.least("c", "low")
    joined = edges.join(least, edges.a == least.c)
    if keep_greater:
        moved = joined.filter(F.col("b") > F.col("a")).select(F.col("b").alias("a"), root.alias("b"))
    else:
        moved = joined.filter(F.col("b") != root).select(F.col("b").alias("a"), root.alias("b"))
        moved = moved.unionByName(least.select(F.col("c").alias("a"), root.alias("b")))
    return moved.distinct()


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    return _pulled(both, keep_greater=True)


def _small_star(edges: DataFrame) -> DataFrame:
    return _pulled(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")), keep_greater=False)


def components(edges: DataFrame) -> DataFrame:
    """Each node that has an edge, and the smallest node it can reach: node, component_id."""
    a, b = edges.columns
    down = edges.filter(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b"))
    current = written(down.distinct(), "edges")
    seen = _mark(current)
    while True:
        current = written(_small_star(_large_star(current)), "edges")
        now = _mark(current)
        if now == seen:
            break
        seen = now
    leaves = current.select(F.col("a").alias("node"), F.col("b").alias("component_id"))
    roots = current.select(F.col("b").alias("node"), F.col("b").alias("component_id")).distinct()
    return leaves.unionByName(roots)


def _mark(edges: DataFrame) -> tuple:
    """Two numbers that change whenever the edge list does."""
    mark = F.xxhash64("a", "b").cast("decimal(38,0)")
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(mark)).first())
