"""Search operators over long tables (series keys, t, chan, value): shifts, boxcars, noise, detection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def subtract_median(df: DataFrame, keys: list[str], value: str = "value") -> DataFrame:
    """value minus its median over the rows of the keys; the medians join back, no window holds a series."""
    middle = df.groupBy(*keys).agg(F.median(value).alias("__median"))
    return df.join(middle, keys).withColumn(value, F.col(value) - F.col("__median")).drop("__median")


def spine(df: DataFrame, keys: list[str], steps: int, t: str = "t") -> DataFrame:
    """Every step from 0 for each distinct key of df."""
    return df.select(*keys).distinct().withColumn(t, F.explode(F.sequence(F.lit(0), F.lit(steps - 1))))


def dedisperse(df: DataFrame, delays: DataFrame, keys: list[str], steps: int, wrap: bool = False, value: str = "value") -> DataFrame:
    """out(keys, dm_idx, t) = sum over channels of weight * value at t + shift.

    The shift changes the key of each sample, so one exchange for the sum is all; the delay table is a
    fixed number of rows and is broadcast. Linear: samples outside are dropped; wrap: modulo steps.
    """
    moved = df.join(F.broadcast(delays.where("weight <> 0")), "chan")
    at = F.col("t") - F.col("shift")
    moved = moved.withColumn("t", F.pmod(at, F.lit(steps))) if wrap else moved.withColumn("t", at).where(F.col("t").between(0, steps - 1))
    return moved.groupBy(*keys, "dm_idx", "t").agg(F.sum(F.col("weight") * F.col(value)).alias(value))


def boxcar(df: DataFrame, widths: DataFrame | list[int], keys: list[str], value: str = "value") -> DataFrame:
    """Trailing sums of each width over a gapless series, one row a width (wid_idx, width)."""
    widths = list(widths) if isinstance(widths, (list, tuple)) else [r.width for r in widths.orderBy("wid_idx").collect()]
    order = Window.partitionBy(*keys).orderBy("t")
    sums = [F.struct(F.lit(n).alias("wid_idx"), F.lit(w).alias("width"), F.sum(value).over(order.rowsBetween(1 - w, 0)).alias(value)) for n, w in enumerate(widths)]
    return df.select(*keys, "t", F.array(*sums).alias("s")).select(*keys, "t", F.inline("s"))


def boxcar_circular(df: DataFrame, widths: list[int], keys: list[str], steps: int, value: str = "value") -> DataFrame:
    """The circular moving sum, rotated by half the series: sum over k < width of value at (t + steps // 2 - k) mod steps.

    Each sample is dealt to the outputs that it adds to, then summed by output.
    """
    each = F.array(*[F.struct(F.lit(n).alias("wid_idx"), F.lit(w).alias("width"), F.lit(k).alias("k")) for n, w in enumerate(widths) for k in range(w)])
    dealt = df.select(*keys, "t", F.col(value), F.inline(each))
    return dealt.groupBy(*keys, "wid_idx", "width", F.pmod(F.col("t") - steps // 2 + F.col("k"), F.lit(steps)).alias("t")).agg(F.sum(value).alias(value))


def boxcar_mean(df: DataFrame, width: int, keys: list[str], value: str = "value") -> DataFrame:
    """A centred mean with zeros beyond the edges (a sum over the width, whatever is there)."""
    order = Window.partitionBy(*keys).orderBy("t").rowsBetween(-(width // 2), width - 1 - width // 2)
    return df.withColumn(value, F.sum(value).over(order) / width)


def nested_noise(df: DataFrame, outer: str, inner: list[str], value: str = "value", rows: Column | None = None) -> DataFrame:
    """Deviation over time, then its median over the positions, for each `outer`."""
    rows = F.lit(True) if rows is None else rows
    spread = df.where(rows).groupBy(outer, *inner).agg(F.stddev_pop(value).alias("spread"))
    return spread.groupBy(outer).agg(F.median("spread").alias("noise"))


def sample_mask(value: Column, median: Column, noise: Column, limit: float) -> Column:
    """Samples that count: finite and below limit * noise above the median; all where the noise is 0."""
    finite = value.isNotNull() & ~F.isnan(value) & (F.abs(value) < float("inf"))
    return (finite & (value - median < limit * noise)) | (noise == 0)


def detect(df: DataFrame, noise: DataFrame, keys: list[str], by: str, value: str = "value", mask: Column | None = None) -> DataFrame:
    """snr = |max - median of masked samples (0 where masked out)| / noise, and toa, the first time of the maximum."""
    kept = F.col(value) if mask is None else F.when(mask, F.col(value)).otherwise(0.0)
    peak = df.groupBy(*keys).agg(F.max(F.struct(F.col(value).alias("v"), (-F.col("t")).alias("t"))).alias("p"), F.median(kept).alias("m"))
    return peak.join(F.broadcast(noise), by).select(*keys, (F.abs(F.col("p.v") - F.col("m")) / F.nullif(F.col("noise"), F.lit(0.0))).alias("snr"), (-F.col("p.t")).alias("toa"))


def detect_below_quantile(df: DataFrame, keys: list[str], by: list[str], quantile: float = 0.9, value: str = "value") -> DataFrame:
    """keys, snr of series (keys, t, value) as the older search has it: what reaches a quantile of the series' peaks (of its `by`) is masked.

    A series' noise is the deviation (sample) of its values with 0 where masked, times sqrt(samples / unmasked ones); the lower
    median of that over the series of a `by` is the noise. snr = (peak - lower median of the masked values) / noise. `by` are some of
    the keys; a `by` has one series a pixel. Null where nothing is unmasked or the noise is 0.
    """
    peaks = df.groupBy(*keys).agg(F.max(value).alias("__peak"))
    limits = peaks.groupBy(*by).agg(F.percentile("__peak", F.lit(quantile)).alias("__limit"))
    below = F.col(value) < F.col("__limit")
    masked = df.join(limits, by).withColumn("__m", F.when(below, F.col(value)).otherwise(0.0)).withColumn("__in", below.cast("int"))
    low = lambda c: F.expr(f"percentile_disc(0.5) WITHIN GROUP (ORDER BY {c})")
    each = masked.groupBy(*keys).agg(F.max(value).alias("__peak"), low("__m").alias("__low"), (F.stddev_samp("__m") * F.sqrt(F.count("*") / F.nullif(F.sum("__in"), F.lit(0)))).alias("__noise"))
    noise = each.where("__noise is not null").groupBy(*by).agg(low("__noise").alias("noise"))
    return each.join(noise, by, "left").select(*keys, ((F.col("__peak") - F.col("__low")) / F.nullif(F.col("noise"), F.lit(0.0))).alias("snr"))


def threshold(df: DataFrame, least: float) -> DataFrame:
    return df.where(F.col("snr") >= least)


def open_gulps(df: DataFrame, gulp: str, above: float) -> DataFrame:
    """The rows of gulps with any value strictly above the gate."""
    best = df.groupBy(gulp).agg(F.max("snr").alias("best")).where(F.col("best") > above).select(gulp)
    return df.join(best, gulp, "left_semi")


def select_candidates(df: DataFrame, most: int | None = None, zero_dm: str = "any", narrow_only: bool = False, centre: tuple[int, int] | None = None, radius: int | None = None) -> DataFrame:
    """The candidate filters in their fixed order: the limit comes before those on DM, width and place."""
    if most is not None:
        df = df.orderBy(F.desc("snr"), "dec_idx", "ra_idx", "wid_idx", "dm_idx").limit(most)
    if zero_dm == "only":
        df = df.where("dm_idx = 0")
    elif zero_dm == "without":
        df = df.where("dm_idx > 0")
    if narrow_only:
        df = df.where("wid_idx = 0")
    if centre and radius is not None:
        df = df.where((F.abs(F.col("ra_idx") - centre[0]) < radius) & (F.abs(F.col("dec_idx") - centre[1]) < radius))
    return df


def running_mean(df: DataFrame, keys: list[str], order: str, value: str) -> DataFrame:
    """The mean of all values so far, as folding each new one into (count, mean) gives it."""
    so_far = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn("n", F.count(value).over(so_far)).withColumn("noise", F.avg(value).over(so_far))


def rebin(df: DataFrame, keys: list[str], size: int, value: str = "value") -> DataFrame:
    """Means of `size` consecutive samples."""
    return df.groupBy(*keys, F.floor(F.col("t") / size).cast("int").alias("t")).agg(F.avg(value).alias(value))
