"""Imaging algebra on visibilities: gridding, weights, direct transforms, complex products."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Points that a direct transform takes.
TARGETS = 1000


def grid_index(u: Column, cell: float, size: int) -> Column:
    """Cell number of a coordinate: truncated toward zero, from the grid's middle."""
    return (u / cell + size // 2).cast("int")


def grid(df: DataFrame, i: str, j: str, size: int, keys: list[str], weight: Column | None = None) -> DataFrame:
    """Sums of visibilities by cell, each with its conjugate in the mirrored cell; null ones are skipped."""
    weight = F.lit(1.0) if weight is None else weight
    both = F.array(
        F.struct(F.col(i).cast("int").alias("i"), F.col(j).cast("int").alias("j"), (weight * F.col("re")).alias("re"), (weight * F.col("im")).alias("im")),
        F.struct((size - 1 - F.col(i)).cast("int").alias("i"), (size - 1 - F.col(j)).cast("int").alias("j"), (weight * F.col("re")).alias("re"), (-weight * F.col("im")).alias("im")),
    )
    cells = df.where(F.col("re").isNotNull() & F.col("im").isNotNull()).select(*keys, F.inline(both))
    return cells.groupBy(*keys, "i", "j").agg(F.sum("re").alias("re"), F.sum("im").alias("im"))


def briggs(df: DataFrame, i: str, j: str, robust: float) -> DataFrame:
    """df with a robust weight for each row, normalised to a sum of 1. The sum of squares runs over cells."""
    cells = df.groupBy(i, j).agg(F.count("*").cast("double").alias("w"))
    total = cells.agg(F.sum(F.col("w") * F.col("w")).alias("__ww"), F.sum("w").alias("__n"))  # one row
    f2 = (5 * 10**-robust) ** 2 / (F.col("__ww") / F.col("__n"))
    raw = cells.join(F.broadcast(total)).withColumn("__raw", 1 / (1 + F.col("w") * f2))
    norm = raw.agg(F.sum(F.col("__raw") * F.col("w")).alias("__norm"))  # one row
    weights = raw.join(F.broadcast(norm)).select(i, j, (F.col("__raw") / F.col("__norm")).alias("weight"))
    return df.join(weights, [i, j])


def direct_transform(df: DataFrame, targets: DataFrame, keys: list[str]) -> DataFrame:
    """The image at target points: sum of re cos(phase) - im sin(phase). targets are TARGETS rows at most (more are an error), and are
    broadcast: each row meets each target, summed before the shuffle."""
    if targets.limit(TARGETS + 1).count() > TARGETS:
        raise ValueError(f"more than {TARGETS} targets: image them by the grid")
    phase = 2 * math.pi * (F.col("u") * F.col("l") + F.col("v") * F.col("m"))
    return df.join(F.broadcast(targets)).groupBy(*keys, "target").agg(F.sum(F.col("re") * F.cos(phase) - F.col("im") * F.sin(phase)).alias("value"))


def complex_product(a_re: Column, a_im: Column, b_re: Column, b_im: Column) -> Column:
    return F.struct((a_re * b_re - a_im * b_im).alias("re"), (a_re * b_im + a_im * b_re).alias("im"))


def complex_quotient(a_re: Column, a_im: Column, b_re: Column, b_im: Column) -> Column:
    size = F.nullif(b_re * b_re + b_im * b_im, F.lit(0.0))
    return F.struct(((a_re * b_re + a_im * b_im) / size).alias("re"), ((a_im * b_re - a_re * b_im) / size).alias("im"))


def baselines(antennas: DataFrame) -> DataFrame:
    """All pairs of antennas (idx, x, y, z), lower number first. Antennas are at most a few hundred."""
    a, b = antennas.alias("a"), antennas.alias("b")
    return a.join(b, F.col("a.idx") < F.col("b.idx")).select(
        F.col("a.idx").alias("ant1"), F.col("b.idx").alias("ant2"), *((F.col(f"b.{c}") - F.col(f"a.{c}")).alias(c) for c in ("x", "y", "z"))
    )


def uvw(df: DataFrame, hour_angle: float, dec: float) -> DataFrame:
    """u, v, w of baselines (x, y, z) toward an hour angle and a declination in radians."""
    sh, ch, sd, cd = math.sin(hour_angle), math.cos(hour_angle), math.sin(dec), math.cos(dec)
    x, y, z = F.col("x"), F.col("y"), F.col("z")
    return df.withColumns({"u": sh * x + ch * y, "v": -sd * ch * x + sd * sh * y + cd * z, "w": cd * ch * x - cd * sh * y + sd * z})


def stack(images: DataFrame, width: int) -> DataFrame:
    """The mean of images (image, i, j, offset, value) over the columns that all of them have after their offsets."""
    edge = images.agg(F.max("offset").alias("hi"), F.min("offset").alias("lo")).first()
    moved = images.withColumn("i", F.col("i") - F.col("offset"))
    return moved.where((F.col("i") >= -(edge.lo or 0)) & (F.col("i") < width - (edge.hi or 0))).groupBy("i", "j").agg(F.avg("value").alias("value"))
