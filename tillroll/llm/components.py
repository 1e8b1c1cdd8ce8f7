"""Connected components by alternating large-star and small-star."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.session import materialize


def _large_star(edges: DataFrame) -> DataFrame:
    """Each larger neighbour of a node goes to the least of node and neighbours."""
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("a"), F.least("u", "m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours go to the least of these."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b"))).distinct()


def _is_star(edges: DataFrame) -> bool:
    """Whether each node that is the larger end of an edge is so just once, and
    never the smaller end of another."""
    ends = edges.select(F.col("a").alias("x"), F.lit(1).alias("up"), F.lit(0).alias("down"))
    ends = ends.union(edges.select(F.col("b").alias("x"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    return ends.groupBy("x").agg(F.sum("up").alias("up"), F.max("down").alias("down")).where("up > 1 OR (up = 1 AND down = 1)").isEmpty()


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for each node that isn't the least of its component.

    Self-loops, repeated edges and edges with a null end are of no account.
    Each round is written to the shared scratch folder and read again, so that
    the lineage stays short; the driver sees only whether all edges form stars.
    """
    full = edges.where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
    now = materialize(full.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).distinct(), "edges")
    while not _is_star(now):
        now = materialize(_small_star(_large_star(now)), "edges")
    return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
