"""Offline jobs put together: from visibilities to candidates as one plan, and the modes of the periodicity search.

Time is global (gulp * samples + sample), so a gulp's history is the samples before it and needs no carried state.
Visibilities: t, chan, ant1, ant2, u, v, re, im.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skysift.operators import filters, folding, gridding, imaging, search
from skysift.operators.summary import normalize
from skysift.stored import materialize

PIXEL = ["y", "x"]


@dataclass(frozen=True)
class Settings:
    """size: pixels a side; cell: grid step of u and v; samples: of a gulp; channels: their number before flagging."""

    size: int
    cell: float
    samples: int
    channels: int
    least_length: float = 0.0
    below_length: float = float("inf")
    robust: float = 0.5
    flagged_channels: tuple[int, ...] = ()


def flagged(vis: DataFrame, antennas: DataFrame, job: Settings) -> DataFrame:
    """What is left of the visibilities without flagged antennas (idx), baselines of other lengths and flagged channels."""
    kept = filters.drop_antennas(vis, antennas, ["ant1", "ant2"], "idx")
    kept = filters.length_between(kept, "u", "v", job.least_length, job.below_length)
    return kept.where(~F.col("chan").isin(*job.flagged_channels)) if job.flagged_channels else kept


def imaged(kept: DataFrame, job: Settings) -> DataFrame:
    """Image cube (t, chan, y, x, value): robust weights by cell, gridding and one transform a sample and channel. Visibilities
    out of the grid are left out. Channels that are left make up for flagged ones."""
    cells = kept.withColumns({"i": gridding.grid_index(F.col("u"), job.cell, job.size), "j": gridding.grid_index(F.col("v"), job.cell, job.size)})
    cells = cells.where(F.col("i").between(0, job.size - 1) & F.col("j").between(0, job.size - 1))
    weighted = gridding.briggs(cells, "i", "j", job.robust)
    image = imaging.dirty_image(gridding.grid(weighted, "i", "j", job.size, ["t", "chan"], F.col("weight")), ["t", "chan"], job.size)
    return image.withColumn("value", F.col("value") * job.channels / (job.channels - len(job.flagged_channels)))


def searched(image: DataFrame, delays: DataFrame, widths: list[int], job: Settings, steps: int) -> DataFrame:
    """S/N and toa by gulp, place, width and dispersion. The noise of a width is the median over places of the deviation over
    time without dispersion. Steps without an image count as 0, so that the windows of the boxcars are gapless.
    Images and shifted series are stored, as each is read twice."""
    flat = search.subtract_median(materialize(image, "images"), [*PIXEL, "chan"])
    shifted = materialize(search.dedisperse(flat, delays, PIXEL, steps), "shifted")
    keys = [*PIXEL, "dm_idx"]
    gapless = search.spine(shifted, keys, steps).join(shifted, [*keys, "t"], "left").fillna(0.0, ["value"])
    boxes = search.boxcar(gapless, widths, keys)
    noise = search.nested_noise(boxes, "wid_idx", PIXEL, rows=F.col("dm_idx") == 0)
    return search.detect(boxes.withColumn("gulp", F.floor(F.col("t") / job.samples).cast("int")), noise, ["gulp", *keys, "wid_idx"], "wid_idx")


def best_of_gulps(found: DataFrame, least: float, most: int) -> DataFrame:
    """The candidates to be saved: up to `most` of each gulp that reach the threshold."""
    order = Window.partitionBy("gulp").orderBy(F.desc("snr"), *PIXEL, "wid_idx", "dm_idx")
    return search.threshold(found, least).withColumn("place", F.row_number().over(order)).where(F.col("place") <= most)


def incoherent(vis: DataFrame, samples: int) -> DataFrame:
    """Series (t, value) of mean amplitudes over baselines, each channel normalised in its gulp, averaged over channels."""
    level = vis.groupBy("t", "chan").agg(F.avg(F.hypot("re", "im")).alias("level")).withColumn("gulp", F.floor(F.col("t") / samples))
    return normalize(level, ["gulp", "chan"], "level").groupBy("t").agg(F.avg("z").alias("value"))


def beams(vis: DataFrame, targets: DataFrame, samples: int) -> DataFrame:
    """Series (target, t, value) of beams toward targets (target, l, m; a few rows), each normalised in its gulp and channel."""
    formed = gridding.direct_transform(vis, targets, ["t", "chan"]).withColumn("gulp", F.floor(F.col("t") / samples))
    return normalize(formed, ["target", "gulp", "chan"], "value").groupBy("target", "t").agg(F.avg("z").alias("value"))


def folded_images(image: DataFrame, period: int) -> DataFrame:
    """Mean image (y, x, phase, value) at each phase of a period."""
    return image.groupBy(*PIXEL, (F.col("t") % period).cast("int").alias("phase")).agg(F.avg("value").alias("value"))


def folded_grid(kept: DataFrame, period: int, job: Settings) -> DataFrame:
    """The fast form: visibilities are folded before the one transform a phase and channel; means over visibilities of a phase."""
    phase = kept.withColumn("t", (F.col("t") % period).cast("int"))
    image = imaged(phase, job)
    many = phase.groupBy("t").agg(F.count("*").alias("n"))
    return image.groupBy(F.col("t"), *PIXEL).agg(F.sum("value").alias("value")).join(many, "t").select(*PIXEL, F.col("t").alias("phase"), (F.col("value") / F.col("n")).alias("value"))


def all_pixels(image: DataFrame, periods: list[int], steps: int) -> DataFrame:
    """The best period of every pixel of the cube."""
    series = image.groupBy(*PIXEL, "t").agg(F.sum("value").alias("value"))
    return folding.best_trial(folding.fold(series, periods, steps, PIXEL), PIXEL, "snr", ["period"])
