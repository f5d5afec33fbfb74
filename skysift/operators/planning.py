"""Observing plans: grids of pointings, transits, steps locked to a grid; and priorities among searches."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from skysift.functions import sky
from skysift.operators import joins
from skysift.stored import materialize

#: Distinct elevations that visits may have.
STRIPS = 2000


def plane_grid(spark: SparkSession, step: float, latitudes: list[float]) -> DataFrame:
    """Galactic longitudes each `step` degrees at each latitude, with equatorial positions."""
    rows = spark.range(int(round(360 / step))).select((F.col("id") * step).alias("gl"), F.explode(F.array(*[F.lit(float(b)) for b in latitudes])).alias("gb"))
    p, sp, cp = sky.POLE_RA, math.sin(math.radians(sky.POLE_DEC)), math.cos(math.radians(sky.POLE_DEC))
    b, a = F.radians("gb"), F.radians(F.lit(sky.NODE) - F.col("gl"))
    dec = F.asin(sp * F.sin(b) + cp * F.cos(b) * F.cos(a))
    ra = p + F.degrees(F.atan2(F.cos(b) * F.sin(a), cp * F.sin(b) - sp * F.cos(b) * F.cos(a)))
    return rows.select("gl", "gb", F.pmod(ra, F.lit(360.0)).alias("ra"), F.degrees(dec).alias("dec"))


def altitude_at(ra: F.Column, dec: F.Column, mjd: F.Column) -> F.Column:
    h, d, p = F.radians(sky.sidereal(mjd) - ra), F.radians(dec), math.radians(sky.LATITUDE)
    return F.degrees(F.asin(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), math.sin(p) * F.sin(d) + math.cos(p) * F.cos(d) * F.cos(h)))))


def transits(targets: DataFrame, key: str, start_mjd: float, steps: tuple[int, ...] = (24, 60, 60)) -> DataFrame:
    """When each target (ra, dec) is highest within a day: hours first, then minutes about the best, then seconds."""
    width, best = 1.0, targets.withColumn("mjd", F.lit(start_mjd + 0.5))
    for count in steps:
        width /= count
        offsets = F.explode(F.sequence(F.lit(-(count // 2) if width < 1 / 24 else -12), F.lit(count // 2 if width < 1 / 24 else 11)))
        tried = best.withColumn("__k", offsets).withColumn("mjd", F.col("mjd") + F.col("__k") * width)
        tried = tried.withColumn("alt", altitude_at(F.col("ra"), F.col("dec"), F.col("mjd")))
        top = tried.groupBy(key).agg(F.max(F.struct(F.round("alt", 9).alias("a"), (-F.col("__k")).alias("k"), F.col("mjd").alias("m"))).alias("t"))
        best = targets.join(top, key).withColumn("mjd", F.col("t.m")).withColumn("alt", F.col("t.a")).drop("t")
    return best


def lock_to_grid(df: DataFrame, time: str, value: str, step: float) -> DataFrame:
    """Values at each multiple of `step` between two rows in time, interpolated linearly.

    Rows lie in stored range partitions by time; the last of each meets the first of the next partition that has rows,
    from a table with one row a partition. Rows without a time are left out; of rows of one time, that with the
    greatest value begins the next stretch and that with the least ends the one before.
    """
    row = F.struct(F.col(time).alias("t"), F.col(value).alias("v"))
    rows = materialize(df.where(F.col(time).isNotNull()).select(time, value).repartitionByRange(time).withColumn("__p", F.spark_partition_id()), "plan")
    firsts = rows.groupBy("__p").agg(F.min(row).alias("__first"))
    # one row a partition, in one window: their number is set by the session, not by the data
    after = firsts.select("__p", F.lead("__first").over(Window.orderBy("__p")).alias("__after"))
    following = F.coalesce(F.lead(row).over(Window.partitionBy("__p").orderBy(time, value)), F.col("__after"))
    pair = rows.join(F.broadcast(after), "__p").select(F.col(time).alias("t0"), F.col(value).alias("v0"), following.alias("n"))
    pair = pair.select("t0", "v0", F.col("n.t").alias("t1"), F.col("n.v").alias("v1"))
    inside = pair.where((F.col("t1") > F.col("t0")) & (F.floor(F.col("t1") / step) >= F.ceil(F.col("t0") / step)))
    at = inside.select("*", F.explode(F.sequence(F.ceil(F.col("t0") / step).cast("bigint"), F.floor(F.col("t1") / step).cast("bigint"))).alias("k"))
    t = F.col("k") * step
    return at.where(t < F.col("t1")).select(t.alias(time), (F.col("v0") + (F.col("v1") - F.col("v0")) * (t - F.col("t0")) / (F.col("t1") - F.col("t0"))).alias(value))


def anchored_windows(df: DataFrame, keys: list[str], gulp: str, size: int, value: str) -> DataFrame:
    """Windows of `size` gulps that start at the first gulp seen of a key; only those with all gulps."""
    first = df.groupBy(*keys).agg(F.min(gulp).alias("__first"))
    number = F.floor((F.col(gulp) - F.col("__first")) / size).cast("int")
    return df.join(first, keys).groupBy(*keys, number.alias("window")).agg(F.countDistinct(gulp).alias("gulps"), F.avg(value).alias(value)).where(F.col("gulps") == size)


def forfeit(requests: DataFrame, tick: str, kind: str, ranked: list[str]) -> DataFrame:
    """One search a tick: the kind that stands first in `ranked` goes, the others are given up."""
    rank = F.array_position(F.array(*[F.lit(k) for k in ranked]), F.col(kind))
    best = requests.where(rank > 0).groupBy(tick).agg(F.min(rank).alias("__r"), F.count("*").alias("asked"))
    return best.select(tick, F.element_at(F.array(*[F.lit(k) for k in ranked]), F.col("__r").cast("int")).alias(kind), (F.col("asked") - 1).alias("given_up"))


def acknowledged(acks: DataFrame, key: str, node: str, nodes: int, time: str) -> DataFrame:
    """Messages that every node has acknowledged, and when the last one did."""
    return acks.groupBy(key).agg(F.countDistinct(node).alias("n"), F.max(time).alias("at")).where(F.col("n") == nodes).drop("n")


def next_visits(visits: DataFrame, rate: float) -> DataFrame:
    """id and next_id of visits (id, start, length above 0, elevation): the one that can begin first once a visit is over and the dish has
    slewed, at `rate` in elevation a unit of time, to where that one is; the least id at ties. Visits that none can follow have no row.

    Elevations are strips of a survey, a fixed number (STRIPS at most). A visit asks its own strip first, where no slew is
    needed; then, of the others, only those that the dish can reach before what it found there begins.
    """
    strips = materialize(visits.select(F.col("elevation").alias("strip")).distinct(), "strips")
    if strips.count() > STRIPS:
        raise ValueError(f"more than {STRIPS} distinct elevations")
    known = materialize(visits.where("start is not null and elevation is not null").groupBy(F.col("elevation").alias("strip"), "start").agg(F.min("id").alias("first")), "known")
    ready = F.col("start") + F.col("length") + F.abs(F.col("strip") - F.col("elevation")) / rate
    own = visits.select("id", F.col("elevation").alias("strip"), (F.col("start") + F.col("length")).alias("ready"))
    here = materialize(joins.forward_by(own, known, "strip", "ready", "start", ["first"]).select("id", "strip", "ready", "found.at", "found.first"), "own")
    away = here.select("id", F.col("strip").alias("elevation"), F.col("ready").alias("start"), F.lit(0.0).alias("length"), "at").join(F.broadcast(strips), ~F.col("strip").eqNullSafe(F.col("elevation")))  # STRIPS rows at most
    asks = away.select("id", "strip", ready.alias("ready"), "at").where("coalesce(ready <= at, true)").drop("at")
    found = joins.forward_by(asks, known, "strip", "ready", "start", ["first"]).where("found is not null").select("id", "found.at", "found.first")
    other = found.groupBy("id").agg(F.min(F.struct("at", "first")).alias("m"))
    mine = F.when(F.col("at").isNotNull(), F.struct("at", "first"))
    return here.join(other, "id", "left").select("id", F.least(mine, "m").alias("m")).where("m is not null").groupBy("id").agg(F.min("m").alias("m")).select("id", F.col("m.first").alias("next_id"))


def chains(starts: DataFrame, jumps: DataFrame, steps: int) -> DataFrame:
    """(first, step, id): what each start (id) leads to by jumps (id, next_id), itself as step 0, up to `steps` visits in all.

    Jumps have one row an id. A visit's path is columns of one row, so a round moves each visit once; each doubles the paths, over
    stored tables, and the last takes no more than `steps`.
    """
    step = lambda n: F.col(f"s{n}")
    known = starts.select("id").distinct()
    if steps > 1:
        path, reach = materialize(jumps.select("id", F.col("next_id").alias("s1")), "jumps"), 1
        while reach + 1 < steps:
            more = min(reach, steps - 1 - reach)
            ahead = path.select(F.col("id").alias(f"s{reach}"), *[step(n).alias(f"s{reach + n}") for n in range(1, more + 1)])
            path = path.join(ahead, f"s{reach}", "left").select("id", *[f"s{n}" for n in range(1, reach + more + 1)])
            path, reach = materialize(path, "paths"), reach + more
        known = known.join(path, "id", "left")
    each = F.explode(F.array(*[F.struct(F.lit(n).alias("step"), (step(n) if n else F.col("id")).alias("to")) for n in range(steps)])).alias("s")
    return known.select(F.col("id").alias("first"), each).where("s.to is not null or s.step = 0").select("first", "s.step", F.col("s.to").alias("id"))
