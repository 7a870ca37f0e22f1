"""Connected components by alternating large-star and small-star steps over an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlint.llm.common import written


def _least(edges: DataFrame) -> DataFrame:
    """Every edge (u, v) with ``m``, the least of u and its neighbours."""
    least = edges.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    # One key more than the groups have: the join then shuffles by itself, and a hub's edges can be split.
    more = F.crc32(F.col("u").cast("string").cast("binary"))
    return edges.withColumn("more", more).join(least.withColumn("more", more), ["u", "more"])


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return _least(both).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    found = _least(down)
    return found.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(found.select("u", F.col("m").alias("v")))


def _are_stars(edges: DataFrame) -> bool:
    """Whether every edge (u, v) leads down to v, every u has one v, and no v has another: nothing is left to join."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("child"), F.col("v").alias("to")).unionByName(
        edges.select(F.col("v").alias("node"), F.lit(0).alias("child"), F.lit(None).cast("long").alias("to"))
    )
    nodes = ends.groupBy("node").agg(F.min("child").alias("low"), F.max("child").alias("high"), F.min("to").alias("first"), F.max("to").alias("last"))
    return nodes.filter("low <> high or first <> last or first > node").isEmpty()


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every node of an edge; root is the component's least node.

    Nodes are longs; edges with a null end or equal ends are ignored.  Each round
    writes the edges, which never become more than they were, to the shared
    folder; the rounds needed grow with the logarithm of a component's diameter.
    """
    now = edges.select(F.col(a).cast("long").alias("u"), F.col(b).cast("long").alias("v")).filter("u <> v").distinct()
    now = written(now, "edges")
    while not _are_stars(now):
        now = written(_small_star(_large_star(now)).filter("u <> v").distinct(), "edges")
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
