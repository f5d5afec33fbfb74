"""Dense points within fixed radii and their groups, without a row for each pair of neighbours.

Points at one place are one position with a count. A fine cell is so small that all its positions lie within the radius of each
other: where it holds `least` points all of them are dense, and its dense positions are one group whatever their number, with
that of least id as its hub. Only positions of poorer cells count their neighbours. Hubs within the radius link up
first; then positions meet only across cells that hold different groups, so nothing is compared inside a group.
Pairs that are looked at stay within a join and are summed or made distinct there. Two groups that lie side by side without a link
are still compared position by position where their cells touch.

No side of a join is broadcast: each may hold a row for each position, and a broadcast is built on the driver.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skysift.operators.components import components
from skysift.stored import materialize

Metric = Callable[[list[Column]], Column]


def euclid(offsets: list[Column]) -> Column:
    return F.sqrt(sum((d * d for d in offsets[1:]), offsets[0] * offsets[0]))


def positions(points: DataFrame, axes: list[str]) -> DataFrame:
    """k, axes, id (the least there) and n of the points (k, id, axes) whose axes are neither null, NaN nor infinite; stored."""
    whole = points.where(" and ".join(f"abs({a}) < double('infinity')" for a in axes))  # NaN is above infinity
    return materialize(whole.groupBy("k", *axes).agg(F.min("id").alias("id"), F.count("*").alias("n")), "positions")


def _side(points: DataFrame, axes: int, radius: float, bound: float, metric: Metric) -> float:
    """The side of a cell whose corners lie within the radius of each other."""
    sides = [radius / axes**0.5 * (1 - 1e-9) * 0.8**k for k in range(60)]
    far = points.sparkSession.range(1).select(F.array(*[metric([F.lit(s)] * axes) for s in sides]).alias("d")).first().d
    for side, d in zip(sides, far, strict=True):
        if d <= bound * (1 - 1e-9):
            return side
    raise ValueError("the metric is above its bound for any offset")


def _around(rows: DataFrame, cells: list[str]) -> DataFrame:
    """Rows dealt to their cell and all that touch it."""
    for c in cells:
        rows = rows.withColumn(c, F.explode(F.array(*[F.col(c) + d for d in (-1, 0, 1)])))
    return rows


def dense_groups(places: DataFrame, axes: list[str], radii: list[float], least: int, metric: Metric = euclid, bounds: list[float] | None = None) -> tuple[DataFrame, DataFrame]:
    """Dense positions (level, k, id, n, axes, cells, root), root the least id of their group, and those that aren't (without root).

    level numbers the radii; a position is dense at one if `least` points lie within it, itself included, and dense positions within it of
    each other are of one group. Within means a metric up to its bound (the radius where there are none). The metric takes the offsets,
    may not fall as one of them grows, and may not be within its bound for an offset beyond the radius.
    """
    cells, fine, at = [f"c{n}" for n in range(len(axes))], [f"f{n}" for n in range(len(axes))], ["level", "k"]
    level = F.explode(F.array(*[F.struct(F.lit(n).alias("level"), F.lit(float(r)).alias("radius"), F.lit(float(b)).alias("bound"), F.lit(_side(places, len(axes), r, b, metric)).alias("side")) for n, (r, b) in enumerate(zip(radii, bounds or radii, strict=True))])).alias("s")
    rows = places.select("k", "id", "n", *axes, level).select("s.level", "k", "id", "n", "s.bound", *axes, *[F.floor(F.col(a) / (F.col("s.radius") * (1 + 1e-9))).alias(c) for a, c in zip(axes, cells, strict=True)], *[F.floor(F.col(a) / F.col("s.side")).alias(f) for a, f in zip(axes, fine, strict=True)])
    rows = materialize(rows, "cells")
    here = [*at, "id", "n", "bound", *axes, *cells, *fine]
    within = metric([F.col(f"b.{a}") - F.col(f"a.{a}") for a in axes]) <= F.col("a.bound")
    met = lambda keys: [F.col(f"a.{c}") == F.col(f"b.{c}") for c in keys]

    held = rows.groupBy(*at, *fine).agg(F.sum("n").alias("held"))
    rows = materialize(rows.join(held.hint("merge"), [*at, *fine]), "held")
    poor = _around(rows.where(F.col("held") < least).select(*here), cells).hint("merge")
    near = poor.alias("a").join(rows.alias("b"), met([*at, *cells])).where(within)
    found = materialize(near.groupBy("a.level", "a.k", "a.id").agg(F.sum("b.n").alias("near")).where(F.col("near") >= least).select(*at, "id"), "found")
    dense = rows.where(F.col("held") >= least).select(*here).unionByName(rows.where(F.col("held") < least).join(found.hint("merge"), [*at, "id"], "left_semi").select(*here))
    dense = materialize(dense, "dense")
    sparse = rows.where(F.col("held") < least).join(found.hint("merge"), [*at, "id"], "left_anti").select(*here)

    hubs = dense.groupBy(*at, *fine).agg(F.min(F.struct("id", "bound", *axes, *cells)).alias("h")).select(*at, *fine, "h.*")
    hubs = materialize(hubs, "hubs")
    node = lambda c: F.struct(F.col(f"{c.split('.')[0]}.level").alias("level"), F.col(f"{c.split('.')[0]}.k").alias("k"), F.col(c).alias("id"))
    links = _around(hubs, cells).hint("merge").alias("a").join(hubs.alias("b"), met([*at, *cells])).where(F.col("a.id") < F.col("b.id")).where(within)
    linked = lambda f: f.select(F.col("node.level").alias("level"), F.col("node.k").alias("k"), F.col("node.id").alias("id"), F.col("component.id").alias("root"))
    first = linked(components(links.select(node("a.id").alias("u"), node("b.id").alias("v"))))
    group = hubs.join(first.hint("merge"), [*at, "id"], "left").select(*at, *fine, F.coalesce("root", "id").alias("root"))
    member = materialize(dense.join(group.hint("merge"), [*at, *fine]), "grouped")

    # cells around that hold another group
    parts = materialize(member.select(*at, *cells, "root").distinct(), "parts")
    to = [f"t{n}" for n in range(len(axes))]
    moved = parts.withColumns({t: F.col(c) for t, c in zip(to, cells, strict=True)})
    live = _around(moved, to).hint("merge").alias("a").join(parts.alias("b"), [*met(at), *[F.col(f"a.{t}") == F.col(f"b.{c}") for t, c in zip(to, cells, strict=True)]])
    live = materialize(live.where("a.root < b.root").select(*[F.col(f"a.{c}").alias(c) for c in (*at, *cells, *to, "root")], F.col("b.root").alias("other")), "live")
    small = member.select(*at, *cells, "root", "bound", *axes)
    ask = small.join(live.hint("merge"), [*at, *cells, "root"]).hint("merge")
    across = ask.alias("a").join(small.alias("b"), [*met(at), *[F.col(f"a.{t}") == F.col(f"b.{c}") for t, c in zip(to, cells, strict=True)], F.col("a.other") == F.col("b.root")]).where(within)
    more = materialize(across.select(node("a.root").alias("u"), node("b.root").alias("v")).distinct(), "across")
    if not more.isEmpty():
        second = linked(components(more)).select(*at, F.col("id").alias("root"), F.col("root").alias("wider"))
        member = member.join(second.hint("merge"), [*at, "root"], "left").withColumn("root", F.coalesce("wider", "root")).drop("wider")
        member = materialize(member, "grouped")
    return member.select(*here, "root"), sparse


def touched(sparse: DataFrame, dense: DataFrame, axes: list[str], value: str, metric: Metric = euclid) -> DataFrame:
    """level, k, id of positions that aren't dense but within the radius of dense ones, with the least `value` of these."""
    cells, at = [f"c{n}" for n in range(len(axes))], ["level", "k"]
    within = metric([F.col(f"b.{a}") - F.col(f"a.{a}") for a in axes]) <= F.col("a.bound")
    near = _around(sparse, cells).hint("merge").alias("a").join(dense.alias("b"), [F.col(f"a.{c}") == F.col(f"b.{c}") for c in (*at, *cells)]).where(within)
    return near.groupBy("a.level", "a.k", "a.id").agg(F.min(f"b.{value}").alias(value))
