"""Connected components of an edge table by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from talkloom.llm.common import written


def _least_neighbour(edges: DataFrame) -> DataFrame:
    return edges.groupBy("u").agg(F.min("v").alias("m"))


def connected(edges: DataFrame, max_rounds: int = 50) -> DataFrame:
    """``edges(u, v)`` -> ``(node, root)``: every node of an edge with the least node it reaches.

    Each round joins every node to the least of its neighbours, first those above it, then
    those below (the published two-phase star contraction); a long chain halves in a round.
    Nothing but the count of changed edges comes to the driver.
    """
    state = written(
        edges.filter(F.col("u") != F.col("v")).select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges"
    )
    for _ in range(max_rounds):
        both = state.unionByName(state.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = _least_neighbour(both).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").filter(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = written(large.filter(F.col("u") != F.col("v")).distinct(), "large")
        low = _least_neighbour(large)
        pointed = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(low.withColumnRenamed("m", "v"))
        new = written(pointed.filter(F.col("u") != F.col("v")).distinct(), "edges")
        changed = new.exceptAll(state).limit(1).count() + state.exceptAll(new).limit(1).count()
        state = new
        if not changed:
            break
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    roots = state.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return state.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
