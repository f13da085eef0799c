"""Connected components of an edge table by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumenframe.session import checkpoint


def _stars(pairs: DataFrame) -> DataFrame:
    """(u, v, m): each pair with the smallest of u and all its v. Minima are pre-aggregated before the join."""
    least = pairs.groupBy("u").agg(F.min("v").alias("m"))
    return pairs.join(least.select("u", F.least("u", "m").alias("m")), "u")


def connected_components(edges: DataFrame) -> DataFrame:
    """``edges`` (a, b) -> (node, root): every node of an edge but the roots, with the smallest node it reaches.

    Loops and repeated edges do no harm; edges with a null end are left out; no edges give no rows. The
    number of rounds grows with the logarithm of the longest path; each is written to the checkpoint folder.
    """
    now = edges.where(F.col("a") != F.col("b")).select(
        F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")
    )
    now = checkpoint(now.distinct())
    state = None
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _stars(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = _stars(large.where("u <> v").distinct())
        moved = small.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        now = checkpoint(moved.unionByName(small.select("u", F.col("m").alias("v"))).distinct())
        before, state = state, now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before or state[0] == 0:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
