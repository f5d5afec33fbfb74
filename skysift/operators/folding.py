"""Periodicity operators over a series (keys, t, value). Trial periods are lists of a few numbers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _each(values: list[int], name: str) -> Column:
    return F.explode(F.array(*[F.lit(v) for v in values])).alias(name)


def fold(df: DataFrame, periods: list[int], steps: int, keys: list[str], value: str = "value") -> DataFrame:
    """snr of each period: the largest phase mean times the root of the folds, over the series' deviation. An incomplete last fold is left out."""
    noise = df.groupBy(*keys).agg(F.stddev_pop(value).alias("noise"))
    each = df.select(*keys, "t", value, _each(periods, "period")).where(F.col("t") < F.lit(steps) - F.lit(steps) % F.col("period"))
    phases = each.groupBy(*keys, "period", (F.col("t") % F.col("period")).alias("phase")).agg(F.avg(value).alias("mean"))
    best = phases.groupBy(*keys, "period").agg(F.max("mean").alias("best"))
    folds = F.floor(F.lit(steps) / F.col("period"))
    return best.join(noise, keys).select(*keys, "period", (F.col("best") * F.sqrt(folds) / F.nullif(F.col("noise"), F.lit(0.0))).alias("snr"))


def fold_weighted(df: DataFrame, periods: list[int], keys: list[str], value: str = "value") -> DataFrame:
    """The largest phase sum over the count to the power 3/2, the incomplete fold included."""
    each = df.select(*keys, "t", value, _each(periods, "period"))
    phases = each.groupBy(*keys, "period", (F.col("t") % F.col("period")).alias("phase")).agg((F.sum(value) / F.pow(F.count(value), F.lit(1.5))).alias("s"))
    return phases.groupBy(*keys, "period").agg(F.max("s").alias("score"))


def fold_timing(df: DataFrame, periods: list[int], reference: int, steps: int, keys: list[str], value: str = "value") -> DataFrame:
    """RMS distance between the times of the k largest samples, in order, and a grid of each period and phase (k: the grid's length)."""
    length = steps - steps % reference
    order = Window.partitionBy(*keys).orderBy(F.desc(value), "t")
    ranked = df.where(F.col("t") < length).select(*keys, "t", F.row_number().over(order).alias("place"))
    each = ranked.select(*keys, "t", "place", _each(periods, "period")).where(F.col("place") <= F.floor(F.lit(length) / F.col("period")))
    nth = each.withColumn("n", F.row_number().over(Window.partitionBy(*keys, "period").orderBy("t")) - 1)
    off = nth.select(*keys, "period", "t", "n", F.explode(F.sequence(F.lit(0), F.lit(reference - 1))).alias("phase"))
    grid = F.least(F.col("phase") + F.col("n") * F.col("period"), F.lit(length))
    return off.groupBy(*keys, "period", "phase").agg(F.sqrt(F.avg(F.pow(F.col("t") - grid, F.lit(2.0)))).alias("rms"))


def fast_fold(df: DataFrame, periods: list[int], phases: int, keys: list[str], value: str = "value") -> DataFrame:
    """The mean of the samples at each stride, starting at each of `phases` offsets of the period."""
    each = df.select(*keys, "t", value, _each(periods, "period"), ).select("*", F.explode(F.sequence(F.lit(0), F.lit(phases - 1))).alias("phase"))
    start = F.floor(F.col("phase") * F.col("period") / phases)
    hits = each.where((F.col("t") >= start) & ((F.col("t") - start) % F.col("period") == 0))
    return hits.groupBy(*keys, "period", "phase").agg(F.avg(value).alias("score"))


def spectrum_fold(df: DataFrame, periods: list[int], harmonics: int, steps: int, keys: list[str], value: str = "value") -> DataFrame:
    """Mean power at a period's harmonics, from explicit cosine and sine sums, so no series is gathered."""
    each = df.select(*keys, "t", value, _each(periods, "period")).select("*", F.explode(F.sequence(F.lit(1), F.lit(harmonics))).alias("h"))
    bin_ = F.rint(F.lit(float(steps)) * F.col("h") / F.col("period"))
    angle = F.lit(2 * 3.141592653589793) * bin_ * F.col("t") / F.lit(float(steps))
    waves = each.groupBy(*keys, "period", "h").agg(F.sum(F.col(value) * F.cos(angle)).alias("re"), F.sum(F.col(value) * F.sin(angle)).alias("im"))
    return waves.groupBy(*keys, "period").agg(F.avg(F.col("re") * F.col("re") + F.col("im") * F.col("im")).alias("power"))


def best_trial(df: DataFrame, keys: list[str], score: str, ties: list[str]) -> DataFrame:
    """The row of the largest score for each key; ties go to the least of `ties`."""
    order = Window.partitionBy(*keys).orderBy(F.desc(score), *ties)
    return df.withColumn("__n", F.row_number().over(order)).where("__n = 1").drop("__n")


def refine_period(period: Column, points: int = 10) -> Column:
    """`points` fine trials from one step below a period to one above."""
    return F.transform(F.sequence(F.lit(0), F.lit(points - 1)), lambda k: period - 1 + k * 2.0 / (points - 1))
