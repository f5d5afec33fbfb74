"""Array operators at the edges of the long tables: FFT imaging, w-stacking, resampling, moments.

Each works on one image of fixed size a group, in NumPy within Arrow or pandas batches.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def dirty_image(cells: DataFrame, keys: list[str], size: int) -> DataFrame:
    """Images of gridded cells (i, j, re, im): the real part of the inverse transform, origin in the middle."""
    schema = ", ".join(f"{k} {cells.schema[k].dataType.simpleString()}" for k in keys) + ", y int, x int, value double"

    def run(name: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        plane = np.zeros((size, size), complex)
        np.add.at(plane, (rows["i"].to_numpy(), rows["j"].to_numpy()), rows["re"].to_numpy() + 1j * rows["im"].to_numpy())
        image = np.fft.fftshift(np.fft.ifft2(np.fft.ifftshift(plane))).real
        y, x = np.indices(image.shape)
        out = {k: v for k, v in zip(keys, name)}
        return pd.DataFrame(out | {"y": y.ravel().astype("int32"), "x": x.ravel().astype("int32"), "value": image.ravel()})

    return cells.groupBy(*keys).applyInPandas(run, schema)


def to_cells(image: DataFrame, keys: list[str], size: int) -> DataFrame:
    """The transform back: cells (i, j, re, im) of images (y, x, value)."""
    schema = ", ".join(f"{k} {image.schema[k].dataType.simpleString()}" for k in keys) + ", i int, j int, re double, im double"

    def run(name: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        plane = np.zeros((size, size))
        plane[rows["y"].to_numpy(), rows["x"].to_numpy()] = rows["value"].to_numpy()
        cells = np.fft.fftshift(np.fft.fft2(np.fft.ifftshift(plane)))
        i, j = np.indices(cells.shape)
        return pd.DataFrame({k: v for k, v in zip(keys, name)} | {"i": i.ravel().astype("int32"), "j": j.ravel().astype("int32"), "re": cells.real.ravel(), "im": cells.imag.ravel()})

    return image.groupBy(*keys).applyInPandas(run, schema)


def long_rows(df: DataFrame, keys: list[str], values: str, shape: list[int], names: list[str]) -> DataFrame:
    """One row a value of an array in row-major order, with its index on each axis; what is past the shape is left out."""
    each = df.select(*keys, F.posexplode(values).alias("__at", "value"))
    step, index = int(np.prod(shape)), {}
    each = each.where(F.col("__at") < step)
    for name, length in zip(names, shape, strict=True):
        step //= length
        index[name] = (F.floor(F.col("__at") / step) % length).cast("int")
    return each.select(*keys, *[c.alias(n) for n, c in index.items()], "value")


def w_layer(w: Column, l: Column, m: Column) -> Column:  # noqa: E741
    """The phase factor of a w layer at direction cosines: exp(2 pi i w (sqrt(1 - l^2 - m^2) - 1))."""
    angle = 2 * np.pi * w * (F.sqrt(1 - l * l - m * m) - 1)
    return F.struct(F.cos(angle).alias("re"), F.sin(angle).alias("im"))


def w_stack(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Values (re, im, w, l, m) corrected by their w layer and summed."""
    f = w_layer(F.col("w"), F.col("l"), F.col("m"))
    return rows.groupBy(*keys).agg(F.sum(F.col("re") * f["re"] - F.col("im") * f["im"]).alias("value"))


def resize(image: DataFrame, keys: list[str], size: int, new: int) -> DataFrame:
    """Bilinear resampling with both edges kept: each output pixel is a weighted sum of four inputs, by joins."""
    scale = (size - 1) / max(1, new - 1)
    spark = image.sparkSession
    axis = spark.range(new).select(F.col("id").cast("int").alias("o"), F.explode(F.array(*[F.struct((F.floor(F.col("id") * scale) + d).cast("int").alias("i"), F.abs(1 - d - (F.col("id") * scale - F.floor(F.col("id") * scale))).alias("w")) for d in (0, 1)])).alias("s"))
    axis = axis.select("o", "s.i", "s.w").where("w > 0")
    ys = axis.select(F.col("o").alias("oy"), F.col("i").alias("y"), F.col("w").alias("wy"))
    xs = axis.select(F.col("o").alias("ox"), F.col("i").alias("x"), F.col("w").alias("wx"))
    both = image.join(F.broadcast(ys), "y").join(F.broadcast(xs), "x")
    return both.groupBy(*keys, F.col("oy").alias("y"), F.col("ox").alias("x")).agg(F.sum(F.col("value") * F.col("wx") * F.col("wy")).alias("value"))


def moments(image: DataFrame, keys: list[str]) -> DataFrame:
    """Centre and Gaussian axes of the positive part of an image, from its moments."""
    w = F.greatest(F.col("value"), F.lit(0.0))
    mean = lambda e: F.sum(w * e) / F.nullif(F.sum(w), F.lit(0.0))
    m = image.groupBy(*keys).agg(mean(F.col("x")).alias("x"), mean(F.col("y")).alias("y"), mean(F.col("x") * F.col("x")).alias("xx"), mean(F.col("y") * F.col("y")).alias("yy"), mean(F.col("x") * F.col("y")).alias("xy"))
    a, b, c = F.col("xx") - F.col("x") ** 2, F.col("yy") - F.col("y") ** 2, F.col("xy") - F.col("x") * F.col("y")
    mid, half = (a + b) / 2, F.sqrt(F.pow((a - b) / 2, F.lit(2.0)) + c * c)
    root = lambda e: F.sqrt(F.greatest(e, F.lit(0.0)))
    return m.select(*keys, "x", "y", root(mid + half).alias("major"), root(mid - half).alias("minor"), F.degrees(F.atan2(2 * c, a - b) / 2).alias("angle"))


def matched_filter(image: DataFrame, psf: DataFrame, keys: list[str]) -> DataFrame:
    """The image convolved with a point-spread function (dy, dx, psf) of few cells: values dealt to shifted keys."""
    dealt = image.join(F.broadcast(psf)).withColumns({"y": F.col("y") - F.col("dy"), "x": F.col("x") - F.col("dx")})
    inside = image.select(*keys, "y", "x")
    return dealt.groupBy(*keys, "y", "x").agg(F.sum(F.col("value") * F.col("psf")).alias("value")).join(inside, [*keys, "y", "x"], "left_semi")
