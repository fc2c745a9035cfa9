"""Connected components of a graph given by its edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketmill.session import materialize


#: Slices of the edges of one node.
SLICES = 64


def _with_least(edges: DataFrame) -> DataFrame:
    """Edges (u, v) with m, the smallest neighbour of u."""
    sliced = edges.withColumn("__s", F.pmod(F.xxhash64("v"), F.lit(SLICES)))
    per = sliced.groupBy("u", "__s").agg(F.min("v").alias("m"))
    least = per.groupBy("u").agg(F.min("m").alias("m"))
    # a node has as many rows here as slices at most
    per = per.drop("m").join(least, "u")
    return sliced.join(per, ["u", "__s"]).drop("__s")


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, root) for every node of the edges (a, b); the root is the smallest node that can be reached.

    Alternating large and small stars: each round hangs the neighbours of a node
    onto the smallest one, first the larger neighbours and then the smaller,
    until only stars are left. The minima are aggregated by node and slice first and joined back by
    node and slice, so that a node with very many edges is dealt over SLICES tasks. Every round is written to
    the shared folder, which cuts the lineage. Loops and repeated edges do no harm; an empty input
    gives no rows. Raises if the rounds do not suffice.
    """
    now = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct()
    now, before = materialize(now, "edges"), None
    for _ in range(max_rounds):
        state = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if state == before or state[0] == 0:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
                now.select("v", "v").distinct()
            )
        before = state
        large = _with_least(now.union(now.select("v", "u")))
        large = large.filter("v > u").select(F.col("v").alias("u"), F.least("u", "m").alias("v"))
        small = _with_least(large).select(F.explode(F.array(F.struct("u", "m"), F.struct(F.col("v").alias("u"), "m"))).alias("e"))
        small = small.select(F.col("e.u").alias("u"), F.col("e.m").alias("v")).filter("u <> v")
        now = materialize(small.distinct(), "edges")
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
