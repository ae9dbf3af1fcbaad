"""Connected components of an edge table by repeated contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from popflow.llm.common import staged


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node with an edge; root is its component's smallest node.

    Each round points a node at its smallest neighbour, follows the pointers
    twice, and keeps the edges between different roots. All steps are joins
    and partially aggregated minima; every round is written out, so lineage
    stays short and a lost executor costs one round.
    """
    edges = staged(edges.select(F.col("a").cast("long").alias("a"), F.col("b").cast("long").alias("b"))
                   .where("a != b").distinct(), "edges")
    levels = []
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        step = staged(both.groupBy(F.col("a").alias("node"))
                      .agg(F.min("b").alias("m"))
                      .select("node", F.least("node", "m").alias("root")), "parents")
        jump = step.select(F.col("node").alias("root"), F.col("root").alias("next"))
        step = staged(step.join(jump, "root").select("node", F.col("next").alias("root")), "roots")
        levels.append(step)
        ra = step.select(F.col("node").alias("a"), F.col("root").alias("ra"))
        rb = step.select(F.col("node").alias("b"), F.col("root").alias("rb"))
        edges = staged(edges.join(ra, "a").join(rb, "b").where("ra != rb")
                       .select(F.col("ra").alias("a"), F.col("rb").alias("b")).distinct(), "edges")
    if not levels:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    out = levels[0]
    for level in levels[1:]:
        up = level.select(F.col("node").alias("root"), F.col("root").alias("up"))
        out = out.join(up, "root", "left").select("node", F.coalesce("up", "root").alias("root"))
    return out
