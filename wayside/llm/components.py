"""Connected components of a table of links, by rounds of joins on written tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayside.session import materialize


def _mark(edges: DataFrame) -> tuple:
    """Number of distinct edges and a sum of their hashes; equal for equal sets of edges."""
    h = F.xxhash64("u", "v")
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(h.cast("decimal(20,0)")), F.bit_xor(h)).first())


def components(links: DataFrame, a: str = "a", b: str = "b", hubs: bool = False) -> DataFrame:
    """(node, component): for every linked node the smallest node it reaches.

    Each round hangs every node on the smallest neighbour it has (large star, then
    small star), which keeps the components and shortens all paths; the rounds end
    when no link changes, after about the logarithm of the longest path. Links are
    added up before each shuffle. With ``hubs`` the smallest neighbours are written before
    links are joined with them, so that AQE can split the links of a node that holds many;
    that takes two more small tables a round.
    """
    kept = materialize if hubs else (lambda df: df)
    edges = materialize(
        links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
        .where(F.col("u") != F.col("v"))
        .distinct()
    )
    mark = _mark(edges)
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = kept(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")))
        large = both.where(F.col("v") > F.col("u")).join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = materialize(large.where(F.col("u") != F.col("v")))
        # small star: every node and its smaller neighbours hang on the smallest of them
        least = kept(large.groupBy("u").agg(F.min("v").alias("m")))
        hung = large.join(least, "u")
        small = hung.where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        after = materialize(least.select("u", F.col("m").alias("v")).union(small).distinct())
        before, mark = mark, _mark(after)
        if mark == before:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
                edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
            )
        edges = after
