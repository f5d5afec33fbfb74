"""Whole searches put together from the operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skysift import trials
from skysift.operators import folding, learned, search

PIXEL = ["dec_idx", "ra_idx"]


def search_gulp(cube: DataFrame, steps: int = trials.SAMPLES, noise: DataFrame | None = None, mask_limit: float | None = None, wrap: bool = True) -> DataFrame:
    """S/N and TOA for every pixel, width and dispersion of a cube (dec_idx, ra_idx, t, chan, flux).

    Missing samples are null and add nothing. Without a noise table (wid_idx, noise) the cube's own is
    used: the deviation over time without dispersion, its median over the declinations, then the other axis.
    """
    spark = cube.sparkSession
    flat = search.subtract_median(cube.withColumnRenamed("flux", "value").where(F.col("value").isNotNull() & ~F.isnan("value")), [*PIXEL, "chan"])
    delays = trials.delay_table(spark, trials.delay_rows(trials.dispersion_trials(), trials.frequencies()))
    shifted = search.dedisperse(flat, delays, PIXEL, steps, wrap=wrap)
    boxes = search.boxcar_circular(shifted, list(trials.WIDTHS), [*PIXEL, "dm_idx"], steps)
    if noise is None:
        spread = boxes.where("dm_idx = 0").groupBy("wid_idx", *PIXEL).agg(F.stddev_pop("value").alias("s"))
        noise = spread.groupBy("wid_idx", "ra_idx").agg(F.median("s").alias("s")).groupBy("wid_idx").agg(F.median("s").alias("noise"))
    keys = [*PIXEL, "wid_idx", "dm_idx"]
    if mask_limit is None:
        return search.detect(boxes, noise, keys, "wid_idx")
    middle = boxes.groupBy(*keys).agg(F.median("value").alias("middle"))
    masked = boxes.join(middle, keys).join(F.broadcast(noise.withColumnRenamed("noise", "past")), "wid_idx")
    kept = search.sample_mask(F.col("value"), F.col("middle"), F.col("past"), mask_limit)
    return search.detect(masked, noise, keys, "wid_idx", mask=kept)


def candidates(searched: DataFrame, least: float, most: int | None = None, **filters) -> DataFrame:
    return search.select_candidates(search.threshold(searched, least), most, **filters)


def clustered(cands: DataFrame, gulp: str, radius: float, least: int) -> DataFrame:
    """Candidates with their cluster by place, width and dispersion."""
    named = cands.withColumn("cand", F.concat_ws(":", "dec_idx", "ra_idx", "wid_idx", "dm_idx"))
    found = learned.cluster(named, gulp, ["dec_idx", "ra_idx", "wid_idx", "dm_idx"], "cand", radius, least)
    return named.join(found, [gulp, "cand"])


def periodicity(series: DataFrame, periods: list[int], steps: int, keys: list[str], least: float) -> DataFrame:
    """The best period of each series whose folded S/N reaches the threshold, with the phase of the least timing residual."""
    best = folding.best_trial(folding.fold(series, periods, steps, keys), keys, "snr", ["period"]).where(F.col("snr") >= least)
    timed = folding.fold_timing(series.join(best.select(*keys), keys, "left_semi"), periods, max(periods), steps, keys)
    phase = folding.best_trial(timed.withColumn("__s", -F.col("rms")), [*keys, "period"], "__s", ["phase"]).drop("__s")
    return best.join(phase, [*keys, "period"])
