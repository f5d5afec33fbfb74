"""Trial axes: dispersion measures, widths, and delay tables."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values of the instrument.
SAMPLE_MS = 134.2182159423828
SAMPLES = 25
CHANNELS = 16
TOP_MHZ, STEP_MHZ = 1492.90625, 11.71875
DM_LEAST, DM_MOST, DM_TOLERANCE = 171.0, 4000.0, 1.6
WIDTHS = (1, 2, 4, 8, 16)
#: ms GHz^2 of delay for each unit of dispersion measure.
DISPERSION = 4.15
#: Samples of a slow bin, and gulps of an image-difference bin.
SLOW_BIN, DIFF_BIN = 5, 3


def frequencies() -> list[float]:
    """Channel frequencies in GHz, from the highest down."""
    return [(TOP_MHZ - k * STEP_MHZ) / 1000 for k in range(CHANNELS)]


def delay_ms(dm: float, ghz: float, lowest_ghz: float) -> float:
    """Arrival at a frequency after the lowest one's (negative: earlier)."""
    return -DISPERSION * dm * (lowest_ghz**-2 - ghz**-2)


def dispersion_trials(least: float = DM_LEAST, most: float = DM_MOST, sample_ms: float = SAMPLE_MS) -> list[float]:
    """0 and the trials from `least` on, each as far as the smearing between neighbours may grow.

    A step from d to the next one e solves (e - a d)^2 = b d^2 + c, where a = n^2 / (16 + n^2) for n
    channels and c is the sample time's share. The last one passes `most`; trials whose delay across
    the band needs more samples than a gulp has are left out.
    """
    n2 = CHANNELS**2
    centre = (TOP_MHZ - STEP_MHZ * (CHANNELS - 1) / 2) / 1000
    a = n2 / (16 + n2)
    b = 16 / (16 + n2) * (DM_TOLERANCE**2 - a)
    c = 16 / (16 + n2) * (DM_TOLERANCE**2 - 1) * (sample_ms * centre**3 / (8.3 * STEP_MHZ)) ** 2
    low, high = centre - STEP_MHZ * CHANNELS / 2000, centre + STEP_MHZ * CHANNELS / 2000
    out, dm = [0.0], least
    while dm < most:
        dm = a * dm + math.sqrt(b * dm * dm + c)
        if math.ceil(DISPERSION * dm * (low**-2 - high**-2) / sample_ms) < SAMPLES:
            out.append(dm)
    return out


@dataclass(frozen=True)
class Delay:
    dm_idx: int
    chan: int
    shift: int
    weight: float


def delay_rows(dms: list[float], ghz: list[float], sample_ms: float = SAMPLE_MS) -> list[Delay]:
    """Two rows for each trial and channel: the whole sample below the delay and the one above, weighted."""
    out = []
    for d, dm in enumerate(dms):
        for c, f in enumerate(ghz):
            delay = delay_ms(dm, f, min(ghz)) / sample_ms
            below = math.floor(delay)
            out += [Delay(d, c, below, 1 - (delay - below)), Delay(d, c, math.ceil(delay), delay - below)]
    return out


def delay_table(spark: SparkSession, rows: list[Delay]) -> DataFrame:
    """Delays as a table: as many rows as trials times channels times two, so it may be broadcast."""
    return spark.createDataFrame([(r.dm_idx, r.chan, r.shift, r.weight) for r in rows], "dm_idx int, chan int, shift int, weight double")


def linear_delays(spark: SparkSession, trials: int, channels: int, slope: float) -> DataFrame:
    """A proxy axis: trial d delays channel c by slope * d * (channels - 1 - c) samples."""
    grid = spark.range(trials).select(F.col("id").cast("int").alias("dm_idx")).select("dm_idx", F.explode(F.array(*[F.lit(c) for c in range(channels)])).alias("chan"))
    delay = F.lit(slope) * F.col("dm_idx") * (channels - 1 - F.col("chan"))
    both = F.array(F.struct(F.floor(delay).cast("int").alias("shift"), (1 - (delay - F.floor(delay))).alias("weight")), F.struct(F.ceil(delay).cast("int").alias("shift"), (delay - F.floor(delay)).alias("weight")))
    return grid.select("dm_idx", "chan", F.inline(both))


def width_table(spark: SparkSession, widths: tuple[int, ...] = WIDTHS) -> DataFrame:
    return spark.createDataFrame([(n, w) for n, w in enumerate(widths)], "wid_idx int, width int")
