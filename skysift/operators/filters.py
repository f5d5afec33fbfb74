"""Flagging: baselines and channels that are left out or masked."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def drop_antennas(df: DataFrame, flagged: DataFrame, columns: list[str], id_col: str) -> DataFrame:
    """Rows none of whose antenna columns is flagged."""
    for c in columns:
        df = df.join(flagged.select(F.col(id_col).alias(c)).distinct(), c, "left_anti")
    return df


def length_between(df: DataFrame, u: str, v: str, least: float, below: float) -> DataFrame:
    """least <= sqrt(u^2 + v^2) < below."""
    length = F.hypot(F.col(u).cast("double"), F.col(v).cast("double"))
    return df.where((length >= least) & (length < below))


def mask_channels(df: DataFrame, chan: str, flagged: list[int], values: list[str]) -> DataFrame:
    """Values of flagged channels become null; the rows stay."""
    return df.withColumns({v: F.when(~F.col(chan).isin(flagged), F.col(v)) for v in values})


def high_mean(df: DataFrame, by: str, value: str, times: float = 5.0) -> DataFrame:
    """Channels whose mean exceeds `times` the median of all channels' means."""
    means = df.groupBy(by).agg(F.avg(value).alias("level"))
    limit = means.agg((F.median("level") * times).alias("limit"))
    return means.join(F.broadcast(limit), F.col("level") > F.col("limit")).select(by, "level")  # the limit is one row


def bursts(df: DataFrame, by: str, t: str, value: str, times: float = 10.0) -> DataFrame:
    """Channels whose maximum less median over time exceeds `times` the median of all channels'."""
    each = df.groupBy(by, t).agg(F.avg(value).alias("v")).groupBy(by).agg((F.max("v") - F.median("v")).alias("level"))
    limit = each.agg((F.median("level") * times).alias("limit"))
    return each.join(F.broadcast(limit), F.col("level") > F.col("limit")).select(by, "level")


def sloped(df: DataFrame, by: str, x: str, value: str, slope: float, most_rms: float, most_spread: float) -> DataFrame:
    """Channels whose residual about a line of fixed slope, and whose relative deviation, are small."""
    fit = df.groupBy(by).agg(F.avg(F.col(value) - slope * F.col(x)).alias("a"), (F.stddev_pop(value) / F.avg(value)).alias("spread"))
    off = df.join(fit, by).groupBy(by, "spread").agg(F.sqrt(F.sum(F.pow(F.col(value) - slope * F.col(x) - F.col("a"), F.lit(2.0)))).alias("rms"))
    return off.where((F.col("rms") < most_rms) & (F.col("spread") < most_spread)).select(by, "rms", "spread")


def top_channels(df: DataFrame, chan: str, channels: int, count: int) -> DataFrame:
    """The band template: the `count` highest channel numbers."""
    return df.where(F.col(chan) >= channels - count).select(chan).distinct()


def peak_outliers(df: DataFrame, pixel: list[str], chan: str, value: str, times: float = 10.0) -> DataFrame:
    """Channels at the brightest pixel whose value is out of `times` the median there, either way."""
    total = df.groupBy(*pixel).agg(F.sum(value).alias("s"))
    best = total.orderBy(F.desc("s"), *pixel).limit(1).select(*pixel)
    there = df.join(F.broadcast(best), pixel)
    middle = there.agg(F.median(value).alias("m"))
    return there.join(F.broadcast(middle), F.abs(F.col(value)) > times * F.abs(F.col("m"))).select(chan, value)


def rescale_flagged(df: DataFrame, chan: str, flagged: list[int], channels: int, value: str) -> DataFrame:
    """Flagged channels become 0 and the others make up for them."""
    return df.withColumn(value, F.when(F.col(chan).isin(flagged), F.lit(0.0)).otherwise(F.col(value) * channels / (channels - len(flagged))))


#: Channel templates by name; each takes a table and returns the flagged channels.
TEMPLATES: dict[str, Callable[..., DataFrame]] = {"band": top_channels, "level": high_mean, "burst": bursts, "slope": sloped, "peak": peak_outliers}
