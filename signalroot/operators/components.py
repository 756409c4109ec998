"""Connected components of an edge list, by alternating large and small stars.

Each round rewires edges towards the smallest neighbour (Kiveris et al., SoCC
2014) and writes them to the shared folder; the loop ends when the edges no
longer change. Groups are reduced by partial aggregation and joined back, so a
node with very many edges is never collected, and only counts reach the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..scratch import Scratch, sized


def _toward_min(edges: DataFrame) -> DataFrame:
    """Edges as (a, b) with a > b, distinct, without loops."""
    return edges.filter("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").filter("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b")))


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, component): every node of an edge (a, b) and the smallest node it reaches.

    Loops and repeated edges are harmless; edges with a null end are ignored.
    """
    scratch = Scratch(edges.sparkSession)
    now = scratch.table(_toward_min(edges.select("a", "b").filter("a IS NOT NULL AND b IS NOT NULL")), "round0")
    before = _state(now)
    for k in range(1, max_rounds + 1):
        now = scratch.table(_toward_min(_small_star(_toward_min(_large_star(now)))), f"round{k}")
        after = _state(now)
        scratch.drop(f"round{k - 1}")
        if after == before:
            break
        before = after
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    roots = now.select(F.col("b").alias("node")).distinct().select("node", F.col("node").alias("component"))
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)


def extended(components: DataFrame, edges: DataFrame) -> DataFrame:
    """(node, component) after further edges (a, b), given the components before them.

    A component's name is its smallest node, so new edges are first contracted to
    the names of their ends; only those names are connected anew, and only the
    components that joined another one are renamed. Work follows the new edges,
    beside one pass over the nodes.
    """
    scratch = Scratch(edges.sparkSession)
    new = edges.select("a", "b").filter("a IS NOT NULL AND b IS NOT NULL")
    named = new
    for end in ("a", "b"):
        known = components.select(F.col("node").alias(end), F.col("component").alias("name"))
        named = named.join(known, end, "left").withColumn(end, F.coalesce("name", end)).drop("name")
    # an end without a component is a node of its own: its loop keeps it
    ends = new.select(F.col("a").alias("node")).unionByName(new.select(F.col("b").alias("node"))).distinct()
    joined = scratch.table(connected_components(named), "joined").select(F.col("node").alias("component"), F.col("component").alias("to"))
    moved = joined.filter("component != to")
    before = components.join(sized(scratch.table(moved, "moved")), "component", "left").select("node", F.coalesce("to", "component").alias("component"))
    fresh = ends.join(components.select("node"), "node", "left_anti")
    return before.unionByName(fresh.join(joined, F.col("node") == F.col("component")).select("node", F.col("to").alias("component")))
