"""Clusters of varying density: a ladder of radii in place of a continuous one, all its steps as joins and sums."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skysift.operators import reach
from skysift.stored import materialize


def psf_distance(psf: Callable[[list[Column]], Column], offsets: list[Column]) -> Column:
    """The distance of two candidates, times the point-spread function of their offset."""
    return psf(offsets) * F.sqrt(sum((d * d for d in offsets[1:]), offsets[0] * offsets[0]))


def nested_clusters(cands: DataFrame, key: str, axes: list[str], id_col: str, radii: list[float], least: int, size: int, metric: Callable[[list[Column]], Column] | None = None) -> DataFrame:
    """cluster (the least id of its members, null: noise) and level of each candidate, within its key.

    radii fall strictly. A point is dense at a radius if `least` points lie within it, itself included; at each radius
    dense points within it of each other link up, and groups of `size` members count. Groups form a tree, as those of a
    smaller radius lie in one of a larger; with one part only it lives on in that part, with several it ends. Its weight is
    the sum, over the levels that it lives and its members there, of what 1 / radius gains on the level above (the first level: on
    0). It is chosen if it weighs no less than the best choice among its parts. Ids are unique within a key; points with a null or NaN axis are noise.
    Groups are found as in reach.dense_groups, for all levels in one run; what it asks of the metric holds here. Groups and points may be many, so
    none are broadcast.
    """
    if sorted(set(radii), reverse=True) != list(radii):
        raise ValueError("radii must fall")
    names = [f"x{n}" for n in range(len(axes))]
    points = materialize(cands.select(F.col(key).alias("k"), F.col(id_col).alias("id"), *[F.col(a).cast("double").alias(x) for a, x in zip(axes, names, strict=True)]), "points")
    roots, _ = reach.dense_groups(reach.positions(points, names), names, radii, least, metric or reach.euclid)
    large = roots.groupBy("k", "level", "root").agg(F.sum("n").alias("n")).where(F.col("n") >= size)
    member = materialize(roots.select("k", "level", "id", "root", *names).join(large.select("k", "level", "root").hint("merge"), ["k", "level", "root"]), "members")
    # the tree: a group's parent is the group of one of its members a level up
    up = member.select("k", (F.col("level") + 1).alias("level"), "id", F.col("root").alias("parent"))
    tree = member.where("id = root").select("k", "level", "root").join(up.withColumnRenamed("id", "root").hint("merge"), ["k", "level", "root"], "left")
    tree = materialize(tree.join(large.hint("merge"), ["k", "level", "root"]).select("k", "level", "root", "parent", "n"), "tree")
    # an only child carries its parent on: the chain has one weight, and is one group
    gain = F.element_at(F.array(*[F.lit(1 / r - (1 / radii[n - 1] if n else 0.0)) for n, r in enumerate(radii)]), F.col("level") + 1)
    tables: list[DataFrame] = []
    for at in reversed(range(len(radii))):
        here = tree.where(F.col("level") == at).select("k", "root", "parent", (F.col("n") * gain).alias("own"))
        if tables:
            below = tables[-1].groupBy("k", F.col("parent").alias("root")).agg(F.count("*").alias("parts"), F.sum("best").alias("below"), F.max("chain").alias("down"), F.max("under").alias("deeper"))
            one = F.col("parts") == 1
            chain, under = F.col("own") + F.when(one, F.col("down")).otherwise(0.0), F.when(one, F.col("deeper")).otherwise(F.coalesce("below", F.lit(0.0)))
            here = here.join(below.hint("merge"), ["k", "root"], "left")
        else:
            chain, under = F.col("own"), F.lit(0.0)
        now = here.select("k", "root", "parent", chain.alias("chain"), under.alias("under"), F.greatest(chain, under).alias("best"), (chain >= under).alias("chosen"), F.lit(at).alias("level"))
        tables.append(materialize(now, f"level{at}"))
    chosen = tables[0]
    for t in tables[1:]:
        chosen = chosen.unionByName(t)
    # of the chosen groups that hold a point, the widest counts
    first = Window.partitionBy("k", "id").orderBy("level")
    picked = member.join(chosen.where("chosen").select("k", "level", "root").hint("merge"), ["k", "level", "root"]).withColumn("n", F.row_number().over(first)).where("n = 1")
    out = points.join(picked.select("k", *names, "level", "root").hint("merge"), ["k", *names], "left")
    return out.select(F.col("k").alias(key), F.col("id").alias(id_col), F.col("root").alias("cluster"), "level")
