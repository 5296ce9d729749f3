"""Connected components by contraction, entirely in joins and aggregations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._util import discard, materialise


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every node with an edge; root is the smallest node reachable.

    Each round points every node at its smallest neighbour (one partial aggregation),
    shortens the pointers twice, renames the edges by them and drops those that became
    loops; the graph shrinks at least by half.  Rounds are written out, which cuts
    lineage.  Nodes of very many edges meet in equi-joins, which adaptive execution splits.
    """
    was = e = materialise(edges.where(F.col(a) != F.col(b)).select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b")).distinct(), "edges")
    rounds: list[DataFrame] = []
    while e.limit(1).count():
        both = e.unionAll(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        parent = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("node"), F.least("a", "m").alias("root"))
        parent = materialise(_shorten(_shorten(parent)), "parents")
        rounds.append(parent)
        pa = parent.select(F.col("node").alias("a"), F.col("root").alias("ra"))
        pb = parent.select(F.col("node").alias("b"), F.col("root").alias("rb"))
        e = e.join(pa, "a").join(pb, "b").where("ra != rb").select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b")).distinct()
        e = materialise(e, "edges")
        discard(was)
        was = e
    if not rounds:
        return e.select(F.col("a").alias("node"), F.col("b").alias("root"))
    out = rounds[0]
    for later in rounds[1:]:
        out = out.join(later.select(F.col("node").alias("root"), F.col("root").alias("next")), "root", "left").select("node", F.coalesce("next", "root").alias("root"))
    if len(rounds) > 1:
        out = materialise(out, "roots")
        discard(*rounds)
    return out


def _shorten(parent: DataFrame) -> DataFrame:
    up = parent.select(F.col("node").alias("root"), F.col("root").alias("up"))
    return parent.join(up, "root", "left").select("node", F.coalesce("up", "root").alias("root"))
