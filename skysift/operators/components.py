"""Connected components of a link table by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skysift.stored import materialize


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.join(least.hint("merge"), "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v")
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    return down.join(least.hint("merge"), "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v"))).where("u <> v").distinct()


def components(links: DataFrame, most_rounds: int = 60) -> DataFrame:
    """links (u, v) to (node, component): the least node that each linked node reaches, itself aside.

    Each round is a stored table, so lost executors repeat one round at most. Its joins hold a row for each node, so neither side is broadcast.
    """
    sign = lambda t: t.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    edges, before = materialize(links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct(), "links"), None
    for _ in range(most_rounds):
        now = sign(edges)
        if now == before or not now[0]:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
        before = now
        edges = materialize(_small_star(_large_star(edges)), "stars")
    raise RuntimeError(f"components did not settle in {most_rounds} rounds")
