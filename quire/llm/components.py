"""Connected components by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm.common import compact


def connected_components(edges: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 60) -> DataFrame:
    """Map every node that has an edge to the smallest node it reaches: columns ``node``, ``root``.

    Each round is two aggregations and two equi-joins over the edges; every round's edges go to
    the shared checkpoint folder, so lost executors cost no earlier round. Self-loops, repeated
    edges and nulls are ignored; no edges give an empty result. Neighbour lists are never
    collected: only minima per node are.
    """
    e = (
        edges.where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
        .select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b"))
        .distinct()
    )
    e, rows = compact(e)
    if not rows:
        return e.select(F.col("a").alias("node"), F.col("b").alias("root"))
    seen = None
    for _ in range(max_rounds):
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.explode(F.array(F.struct("a", "m"), F.struct(F.col("b").alias("a"), "m"))).alias("e"))
        e, _ = compact(small.select(F.col("e.a").alias("a"), F.col("e.m").alias("b")).where("a <> b").distinct())
        now = e.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)")).alias("h")).first()
        if seen == (now["n"], now["h"]):
            return e.select(F.col("a").alias("node"), F.col("b").alias("root"))
        seen = (now["n"], now["h"])
    raise RuntimeError(f"no fixed point in {max_rounds} rounds")
