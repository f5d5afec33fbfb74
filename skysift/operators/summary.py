"""Summaries: normalisation, histograms, completeness, calibration slopes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def normalize(df: DataFrame, keys: list[str], value: str, out: str = "z") -> DataFrame:
    """(value - median) / deviation of its group."""
    of = df.groupBy(*keys).agg(F.median(value).alias("__m"), F.stddev_pop(value).alias("__s"))
    return df.join(of, keys).withColumn(out, (F.col(value) - F.col("__m")) / F.nullif(F.col("__s"), F.lit(0.0))).drop("__m", "__s")


def clamped_bins(value: Column, width: float, most: int) -> Column:
    """Bin number, at least 0 and at most `most`."""
    return F.least(F.greatest(F.floor(value / width), F.lit(0)), F.lit(most)).cast("int")


def completeness(df: DataFrame, magnitude: Column, found: Column, step: float) -> DataFrame:
    """Share found in each bin of log10 of a magnitude; an empty bin has no row."""
    bin_ = F.floor(F.log10(magnitude) / step).cast("int")
    return df.where(magnitude > 0).groupBy(bin_.alias("bin")).agg(F.count("*").alias("total"), F.sum(found.cast("bigint")).alias("found")).withColumn("share", F.col("found") / F.col("total"))


def slopes(df: DataFrame, keys: list[str], x: str, y: str) -> DataFrame:
    """The ratio of the brightest source, and the zero-intercept fit with weights x^2."""
    return df.groupBy(*keys).agg(
        F.max(F.struct(F.col(x), F.col(y))).alias("top"),
        (F.sum(F.pow(x, F.lit(3.0)) * F.col(y)) / F.sum(F.pow(x, F.lit(4.0)))).alias("fit"),
    ).select(*keys, (F.col(f"top.{y}") / F.col(f"top.{x}")).alias("slope"), "fit")


def offsets(df: DataFrame, keys: list[str], error: str, weight: str) -> DataFrame:
    """Mean offset and weighted RMS about zero."""
    return df.groupBy(*keys).agg(F.avg(error).alias("mean"), F.sqrt(F.sum(F.col(weight) * F.pow(error, F.lit(2.0))) / F.sum(weight)).alias("rms"))


def median_of_medians(df: DataFrame, outer: list[str], inner: list[str], value: str) -> DataFrame:
    """The median of group medians with its standard error."""
    each = df.groupBy(*outer, *inner).agg(F.median(value).alias("m"))
    return each.groupBy(*outer).agg(F.median("m").alias("median"), (F.stddev_pop("m") / F.sqrt(F.count("m"))).alias("error"))
