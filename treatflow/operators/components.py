"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from treatflow.session import cut_lineage


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    lowest = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.filter(F.col("v") > F.col("u")).join(lowest, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    lowest = down.groupBy("u").agg(F.min("v").alias("m"))
    linked = down.join(lowest, "u").filter(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return linked.union(lowest.select("u", F.col("m").alias("v")))


def _settled(edges: DataFrame) -> bool:
    """Every node has one smaller node, and that one has none: all components are stars."""
    roots = edges.select(F.col("v").alias("u"), F.lit(True).alias("is_root")).distinct()
    odd = edges.groupBy("u").agg(F.min("v").alias("low"), F.max("v").alias("high"))
    return odd.join(roots, "u", "left").filter((F.col("low") != F.col("high")) | F.col("is_root")).isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """(``u``, ``grp``) of every node on an edge; ``grp`` is the smallest node of its component.

    Alternates large-star and small-star (Kiveris et al. 2014): a logarithmic number of rounds, also
    on long chains.  Minima are partial aggregates, so a node with very many edges is no hot spot.
    """
    down = edges.filter(F.col("u") != F.col("v")).select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    current = cut_lineage(_small_star(down.distinct()).distinct())
    while not _settled(current):
        current = cut_lineage(_small_star(_large_star(current).distinct()).distinct())
    return current.select("u", F.col("v").alias("grp")).union(
        current.select(F.col("v").alias("u"), F.col("v").alias("grp")).distinct()
    )
