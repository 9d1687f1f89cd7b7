"""Connected components of links by alternating large-star and small-star steps.

Each step hangs a vertex's neighbours on the smallest of them, the larger ones first, then
the smaller; when nothing changes, every vertex hangs on the smallest of its component. The
minima of a step are written to the shared folder, so that joining them back is a join of
two exchanges, in which Spark splits a hot vertex's links.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.session import ensure_checkpoints

MOST_ROUNDS = 60


def components(links: DataFrame) -> DataFrame:
    """``vertex, label`` of every vertex of the links ``a, b``; a label is the smallest vertex. Null ends are ignored."""
    ensure_checkpoints(links.sparkSession)
    high, low = F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")
    edges = links.dropna().select(high, low).filter("u <> v").distinct().checkpoint()
    state = _state(edges)
    for _ in range(MOST_ROUNDS):
        edges = _small_star(_large_star(edges)).checkpoint()
        state, before = _state(edges), state
        if state == before:
            roots = edges.select(F.col("v").alias("vertex"), F.col("v").alias("label")).distinct()
            return edges.select(F.col("u").alias("vertex"), F.col("v").alias("label")).unionByName(roots)
    raise RuntimeError(f"links still move after {MOST_ROUNDS} rounds")


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("u"), F.bit_xor(F.xxhash64("u", "v"))).first())


def _large_star(edges: DataFrame) -> DataFrame:
    """Each larger neighbour of u is linked with the smallest of u and its neighbours."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")).checkpoint()
    moved = both.filter(F.col("v") > F.col("u")).join(least, "u")
    return moved.select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """u and its smaller neighbours are linked with the smallest of them."""
    edges = edges.checkpoint()
    least = edges.groupBy("u").agg(F.min("v").alias("m")).checkpoint()
    moved = edges.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v")
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()
