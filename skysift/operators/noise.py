"""Noise state: running means kept for each key."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema


def reject_and_fold(df: DataFrame, keys: list[str], order: str, value: str, limit: float | None = 3.0) -> DataFrame:
    """(count, mean) after folding each key's values in order; one over limit times a mean that isn't 0 is left out.

    Each mean depends on the one before, so a key's values pass one task; it sees them in order, batch by batch, and holds the
    last mean, however many there are. Equal orders fold by value.
    """
    rows = df.where(F.col(value).isNotNull()).select(*keys, F.col(order).alias("__o"), F.col(value).cast("double").alias("__x"))
    schema = T.StructType([*rows.select(*keys).schema.fields, T.StructField("n", T.LongType()), T.StructField("noise", T.DoubleType())])

    out = to_arrow_schema(schema)

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: tuple | None = None
        n, noise = 0, 0.0
        done: list[tuple] = []
        for batch in batches:
            for *key, x in zip(*(batch.column(c).to_pylist() for c in (*keys, "__x")), strict=True):
                if known != tuple(key):
                    if known is not None:
                        done.append((*known, n, noise))
                    known, n, noise = tuple(key), 0, 0.0
                if limit is None or not (n and noise and x > limit * noise):
                    noise, n = (noise * n + x) / (n + 1), n + 1
            if done:
                yield _batch(done)
                done = []
        if known is not None:
            yield _batch([(*known, n, noise)])

    def _batch(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], f.type) for k, f in enumerate(out)], schema=out)

    return rows.repartition(*keys).sortWithinPartitions(*keys, "__o", "__x").mapInArrow(fold, schema)


def merge(state: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """The keyed upsert of (n, noise) state by new values x: null and NaN values leave a key as it is."""
    fresh = new.where(F.col("x").isNotNull() & ~F.isnan("x")).groupBy(*keys).agg(F.count("*").alias("k"), F.avg("x").alias("m"))
    both = state.join(fresh, keys, "full")
    n, k = F.coalesce("n", F.lit(0)), F.coalesce("k", F.lit(0))
    mean = (F.coalesce("noise", F.lit(0.0)) * n + F.coalesce("m", F.lit(0.0)) * k) / F.nullif(n + k, F.lit(0))
    return both.select(*keys, (n + k).cast("bigint").alias("n"), F.coalesce(mean, F.lit(0.0)).alias("noise"))


def initial(spark: SparkSession, trials: int, widths: list[int], slope: float = 0.0, visibility_noise: float = 0.0) -> DataFrame:
    """State before any data: 0, or slope * visibility noise * sqrt(width)."""
    rows = [(d, w) for d in range(trials) for w in widths]
    return spark.createDataFrame(rows, "dm_idx int, width int").select("dm_idx", "width", F.lit(0).cast("bigint").alias("n"), (F.lit(slope * visibility_noise) * F.sqrt("width")).alias("noise"))


def from_visibilities(visibilities: DataFrame, band: str, trials: int, widths: list[int], slope: float) -> DataFrame:
    """State (dm_idx, width, n, noise) before any search: slope * the visibilities' noise * sqrt(width), where the noise is the mean over the
    bands of the deviation of their samples (re; null ones are left out). Without samples it is 0."""
    spread = visibilities.groupBy(band).agg(F.stddev_pop("re").alias("s")).agg(F.coalesce(F.avg("s"), F.lit(0.0)).alias("s"))  # one row
    table = initial(visibilities.sparkSession, trials, widths).drop("noise")
    return table.join(F.broadcast(spread)).select("dm_idx", "width", "n", (F.lit(slope) * F.col("s") * F.sqrt("width")).alias("noise"))
