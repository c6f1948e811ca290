"""Connected components of an edge table, without ever holding a component anywhere."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meridian.llm.common import durable


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of edges(a, b): component is the smallest node that can be reached.

    Rounds of contraction: each node hooks on to its smallest neighbour, hooks are followed to their ends by doubling their
    reach, and edges are renamed by them; what is left is a smaller graph whose nodes are still smallest-so-far. Hooks only go
    to smaller nodes, so they never form a ring. Each round at least halves the nodes that still have edges, and doubling
    takes the logarithm of the longest chain of hooks, so a chain of any order of ids is short work. A round is
    aggregates, which combine on the map side, and joins of stored tables, which the engine splits where one node has many
    edges. Nothing reaches the driver but whether anything is left to do.
    """
    pairs = lambda df: df.filter("a != b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    left = durable(pairs(edges))
    found: DataFrame | None = None
    while not left.isEmpty():
        hooks = followed(_hooks(left))
        if found is None:
            found = hooks.withColumnRenamed("to", "component")
        else:
            step = hooks.select(F.col("node").alias("mid"), "to")
            found = durable(found.join(step, F.col("component") == F.col("mid"), "left").select("node", F.coalesce("to", "component").alias("component")))
        first = left.join(hooks.select(F.col("node").alias("a"), F.col("to").alias("a2")), "a")
        second = first.select("a2", "b").join(hooks.select(F.col("node").alias("b"), F.col("to").alias("b2")), "b")
        left = durable(pairs(second.select(F.col("a2").alias("a"), F.col("b2").alias("b"))))
    if found is None:
        found = left.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return found


def _hooks(edges: DataFrame) -> DataFrame:
    """(node, to): the smallest of each node and its neighbours."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    return durable(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("to")).select(F.col("a").alias("node"), "to"))


def followed(hooks: DataFrame) -> DataFrame:
    """hooks(node, to) with `to` the end of each one's chain; every `to` is a node, and an end is its own."""
    while True:
        again = hooks.select(F.col("node").alias("mid"), F.col("to").alias("far"))
        reach = durable(hooks.join(again, F.col("to") == F.col("mid")).select("node", F.col("far").alias("to"), (F.col("far") != F.col("to")).alias("moved")))
        hooks = reach.select("node", "to")
        if reach.filter("moved").isEmpty():
            return hooks
