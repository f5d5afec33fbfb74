"""Elliptical Gaussians fitted to groups of pixels by iterated least squares.

A round is one pass over the pixels: each is compared with its group's model, and the 21 products and 6 gradients of the normal
equations are sums by group that Spark adds up. The small systems are then solved one a group, with a damping that
rises where a step made things worse. Rounds are a fixed number, each a stored table with a row a group.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skysift.operators import imaging
from skysift.stored import materialize

#: Parameters: height, centre, and the inverse covariance; and the pairs of them in the normal equations.
NAMES = ("height", "x0", "y0", "a", "b", "c")
PAIRS = [(i, j) for i in range(6) for j in range(i, 6)]


def ellipse_radius(angle: Column, major: Column, minor: Column, tilt: Column) -> Column:
    """The distance from the centre to the edge of an ellipse in a direction; angles in radians, tilt from the x axis."""
    along, across = F.cos(angle - tilt), F.sin(angle - tilt)
    return major * minor / F.sqrt(minor * minor * along * along + major * major * across * across)


def covariance(major: Column, minor: Column, tilt: Column) -> tuple[Column, Column, Column]:
    """Variances along x and y, and covariance, of a Gaussian with these deviations."""
    c, s = F.cos(tilt), F.sin(tilt)
    return major * major * c * c + minor * minor * s * s, major * major * s * s + minor * minor * c * c, (major * major - minor * minor) * s * c


def _model(p: str) -> tuple[Column, list[Column]]:
    """A pixel's value under the parameters p, and its derivatives by them."""
    dx, dy = F.col("x") - F.col(f"{p}.x0"), F.col("y") - F.col(f"{p}.y0")
    a, b, c = (F.col(f"{p}.{n}") for n in "abc")
    shape = F.exp(-(a * dx * dx + 2 * b * dx * dy + c * dy * dy) / 2)
    value = F.col(f"{p}.height") * shape
    return value, [shape, value * (a * dx + b * dy), value * (b * dx + c * dy), -value * dx * dx / 2, -value * dx * dy, -value * dy * dy / 2]


def fit_ellipses(pixels: DataFrame, keys: list[str], rounds: int = 15) -> DataFrame:
    """keys, height, x, y, major, minor (deviations), tilt (of the major axis, -pi/2 to pi/2) and rms of pixels (keys, x, y, value).

    keys are one at least. The start is the moments of the positive values. Null values are left out. A group whose moments have no extent, or with fewer
    than seven pixels, gets nulls.
    """
    pixels = materialize(pixels.select(*keys, F.col("x").cast("double").alias("x"), F.col("y").cast("double").alias("y"), F.col("value").cast("double").alias("value")).where("value is not null"), "pixels")
    first = imaging.moments(pixels.withColumn("value", F.greatest("value", F.lit(0.0))), keys)
    top = pixels.groupBy(*keys).agg(F.max("value").alias("height"), F.count("*").alias("n"))
    start = top.join(first, keys, "left")
    kinds = "".join(f"{k} {pixels.schema[k].dataType.simpleString()}, " for k in keys)
    params = "struct<" + ", ".join(f"{n}: double" for n in NAMES) + ">"
    good = (F.col("n") > 6) & (F.col("major") > 0) & (F.col("minor") > 0) & (F.col("height") > 0)
    round_start = F.struct("height", F.col("x").alias("x0"), F.col("y").alias("y0"), (1 / (F.col("major") * F.col("minor"))).alias("a"), F.lit(0.0).alias("b"), (1 / (F.col("major") * F.col("minor"))).alias("c"))
    groups = start.select(*keys, "n", good.alias("good"))
    state = start.where(good).select(*keys, round_start.cast(params).alias("trial"), round_start.cast(params).alias("best"), F.lit(float("inf")).alias("rss"), F.lit(1e-3).alias("damping"), F.array().cast("array<double>").alias("sums"))
    schema = kinds + f"trial {params}, best {params}, rss double, damping double, sums array<double>"

    def step(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            out = []
            for r in rows.to_dict("records"):
                trial = np.array([r["trial"][n] for n in NAMES])
                best = np.array([r["best"][n] for n in NAMES])
                damping, rss, sums = r["damping"], r["rss"], np.asarray(r["sums"], float)
                new = np.asarray(r["new"], float)
                if np.isfinite(new).all() and new[0] < rss:
                    best, rss, sums, damping = trial, float(new[0]), new, max(damping / 8, 1e-9)
                else:
                    damping = min(damping * 6, 1e9)
                if len(sums):
                    normal = np.zeros((6, 6))
                    for (i, j), v in zip(PAIRS, sums[7:], strict=True):
                        normal[i, j] = normal[j, i] = v
                    try:
                        trial = best + np.linalg.solve(normal + damping * np.diag(np.diag(normal) + 1e-12), sums[1:7])
                    except np.linalg.LinAlgError:
                        trial = best
                    if not (trial[3] > 0 and trial[5] > 0 and trial[3] * trial[5] > trial[4] ** 2):
                        trial = best + (trial - best) / 16
                out.append({**{k: r[k] for k in keys}, "trial": dict(zip(NAMES, trial.tolist(), strict=True)), "best": dict(zip(NAMES, best.tolist(), strict=True)), "rss": rss, "damping": damping, "sums": sums.tolist()})
            frame = pd.DataFrame(out, columns=[*keys, "trial", "best", "rss", "damping", "sums"])
            yield frame.astype({k: object for k in keys}) if len(frame) else frame

    for _ in range(rounds):
        value, slopes = _model("trial")
        rest = F.col("value") - value
        terms = [rest * rest, *[rest * s for s in slopes], *[slopes[i] * slopes[j] for i, j in PAIRS]]
        each = pixels.join(state.select(*keys, "trial"), keys).select(*keys, *[t.alias(f"s{n}") for n, t in enumerate(terms)])
        sums = each.groupBy(*keys).agg(*[F.sum(f"s{n}").alias(f"s{n}") for n in range(len(terms))]).select(*keys, F.array(*[f"s{n}" for n in range(len(terms))]).alias("new"))
        state = materialize(state.join(sums, keys).mapInPandas(step, schema), "fits")
    a, b, c = (F.col(f"best.{n}") for n in "abc")
    area = a * c - b * b
    xx, yy, xy = c / area, a / area, -b / area
    wide = F.sqrt((xx - yy) * (xx - yy) / 4 + xy * xy)
    out = state.select(*keys, F.col("best.height").alias("height"), F.col("best.x0").alias("x"), F.col("best.y0").alias("y"), F.sqrt((xx + yy) / 2 + wide).alias("major"), F.sqrt((xx + yy) / 2 - wide).alias("minor"), (F.atan2(2 * xy, xx - yy) / 2).alias("tilt"), "rss")
    return groups.join(out, keys, "left").withColumn("rms", F.sqrt(F.col("rss") / F.col("n"))).drop("rss", "good", "n")
