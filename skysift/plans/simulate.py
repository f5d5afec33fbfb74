"""Simulated inputs: noise, bursts, pulse trains, candidates, injections. Every draw is a hash of its key."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skysift import trials


def uniform(seed: int, *keys: Column) -> Column:
    """A draw from (0, 1) that depends on its keys alone, so a task that is run again draws the same."""
    return (F.pmod(F.xxhash64(F.lit(seed), *keys), F.lit(1 << 53)) + F.lit(0.5)) / float(1 << 53)


def normal(seed: int, *keys: Column) -> Column:
    return F.sqrt(-2 * F.log(uniform(seed, *keys))) * F.cos(2 * math.pi * uniform(seed + 1, *keys))


def image_cube(spark: SparkSession, size: int, steps: int, channels: int, noise: float, seed: int = 1) -> DataFrame:
    """dec_idx, ra_idx, t, chan, flux of Gaussian noise."""
    n = spark.range(size * size * steps * channels)
    at = lambda unit, mod: (F.floor(F.col("id") / unit) % mod).cast("int")
    return n.select(at(size * steps * channels, size).alias("dec_idx"), at(steps * channels, size).alias("ra_idx"), at(channels, steps).alias("t"), at(1, channels).alias("chan"), (noise * normal(seed, F.col("id"))).alias("flux"))


def with_burst(cube: DataFrame, place: tuple[int, int], at: int, width: int, dm: float, flux: float, sample_ms: float = trials.SAMPLE_MS) -> DataFrame:
    """A burst of some samples at one pixel, later in lower channels as its dispersion says (whole samples)."""
    ghz = trials.frequencies()
    late = F.element_at(F.array(*[F.lit(-round(-trials.delay_ms(dm, f, min(ghz)) / sample_ms)) for f in ghz]), F.col("chan") + 1)
    hit = (F.col("dec_idx") == place[0]) & (F.col("ra_idx") == place[1]) & F.col("t").between(at + late, at + late + width - 1)
    return cube.withColumn("flux", F.col("flux") + F.when(hit, F.lit(flux)).otherwise(0.0))


def pulse_train(spark: SparkSession, steps: int, period: float, width: float, height: float, noise: float, seed: int = 3) -> DataFrame:
    """t, value: Gaussian pulses each period, and noise."""
    phase = F.col("id") - period * F.rint(F.col("id") / period)
    return spark.range(steps).select(F.col("id").cast("int").alias("t"), (height * F.exp(-phase * phase / (2 * width * width)) + noise * normal(seed, F.col("id"))).alias("value"))


def injections(spark: SparkSession, count: int, seed: int = 5) -> DataFrame:
    """Parameters of injections: dispersion and width from the trials, S/N from 10 to 100."""
    dms = F.array(*[F.lit(d) for d in trials.dispersion_trials()])
    pick = lambda values, s: F.element_at(values, F.floor(uniform(s, F.col("id")) * F.size(values)).cast("int") + 1)
    return spark.range(count).select(F.col("id").alias("injection"), pick(dms, seed).alias("dm"), pick(F.array(*[F.lit(w) for w in trials.WIDTHS]), seed + 10).alias("width"), (10 + 90 * uniform(seed + 20, F.col("id"))).alias("snr"))


def fake_candidates(spark: SparkSession, size: int, limit: float, seed: int = 9) -> DataFrame:
    """Uniform S/N up to a little over the threshold in every cell of a result cube."""
    widths, dms = len(trials.WIDTHS), 16
    at = lambda unit, mod: (F.floor(F.col("id") / unit) % mod).cast("int")
    return spark.range(size * size * widths * dms).select(at(size * widths * dms, size).alias("dec_idx"), at(widths * dms, size).alias("ra_idx"), at(dms, widths).alias("wid_idx"), at(1, dms).alias("dm_idx"), ((limit + 1) * uniform(seed, F.col("id"))).alias("snr"), (F.col("id") % trials.SAMPLES).cast("int").alias("toa"))
