"""Connected components of a graph given as edges, by joins alone."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sftq.llm.common import stored


def _turned(edges: DataFrame) -> DataFrame:
    """Edges as ``v > u``, each once; loops and nulls vanish."""
    return edges.select(F.greatest("v", "u").alias("v"), F.least("v", "u").alias("u")).where("v > u").distinct()


def components(edges: DataFrame) -> DataFrame:
    """``v, root``: for each end of an edge ``v, u`` (long), the least node it is linked to.

    Alternates two steps until nothing changes: every larger neighbour of a node, then every
    smaller one, is linked to the node's least neighbour. The number of rounds grows with the
    logarithm of the longest path; each keeps at most as many edges as before. Minima are
    aggregated before they are shuffled, so a node with very many neighbours is one row a task.
    """
    edges, seen = stored(_turned(edges)), None
    while True:
        state = edges.agg(F.count("*"), F.expr("bit_xor(xxhash64(v, u))")).first()
        if state == seen or not state[0]:
            roots = edges.select("v", F.col("u").alias("root"))
            return roots.unionByName(edges.select(F.col("u").alias("v"), F.col("u").alias("root")).distinct())
        seen = state
        both = edges.unionByName(edges.select(F.col("u").alias("v"), F.col("v").alias("u")))
        least = both.groupBy("v").agg(F.min("u").alias("m")).select("v", F.least("v", "m").alias("m"))
        large = both.join(least, "v").where("u > v").select(F.col("u").alias("v"), F.col("m").alias("u")).distinct()
        least = large.groupBy("v").agg(F.min("u").alias("m"))
        small = large.join(least, "v").select(F.explode(F.array(F.struct("v", F.col("m").alias("u")), F.struct(F.col("u").alias("v"), F.col("m").alias("u")))).alias("e")).select("e.*")
        edges = stored(_turned(small))
