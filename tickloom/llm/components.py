"""Connected components of an edge table, by Spark joins only.

Alternating star contraction: every vertex's larger neighbours, then its smaller
ones, are hung on its least neighbour until nothing changes.  Nothing is collected.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.store import staged
from tickloom.session import freed


def _least(edges: DataFrame) -> DataFrame:
    """(u, m): the least of u and its neighbours, for edges (u, v)."""
    return edges.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))


def _round(edges: DataFrame) -> DataFrame:
    """One contraction of distinct edges (u, v) with u > v."""
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    large = both.join(_least(both), "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
    least = _least(large)
    joined = large.join(least, "u")
    small = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", F.col("m").alias("v")))
    return small.where("u > v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(vertex, component): the least vertex of its component, for every vertex of edges (a, b) other than that least one.

    ``a`` and ``b`` are LONG; nulls and loops are left out.
    """
    now = staged(
        edges.where("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(),
        "edges",
    )
    mark = None
    while True:
        found = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if mark == found or found[0] == 0:
            return now.select(F.col("u").alias("vertex"), F.col("v").alias("component"))
        mark, before, now = found, now, staged(_round(now), "edges")
        freed(before)
