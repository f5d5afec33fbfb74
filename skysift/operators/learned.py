"""Density clustering by joins, and small convolutional classifiers on one batch of cut-outs at a time."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skysift.operators import reach
from skysift.stored import materialize


def density_labels(points: np.ndarray, radius: float, least: int) -> np.ndarray:
    """Cluster numbers by density: points with `least` neighbours within the radius link up; -1 is noise."""
    order = np.argsort(points[:, 0], kind="stable")
    sorted_first = points[order, 0]
    near = []
    for p in points:
        a, b = np.searchsorted(sorted_first, [p[0] - radius, p[0] + radius], side="left")
        b = np.searchsorted(sorted_first, p[0] + radius, side="right")
        rows = order[a:b]
        near.append(rows[((points[rows] - p) ** 2).sum(1) <= radius * radius])
    core = np.array([len(n) >= least for n in near])
    label, current = np.full(len(points), -1), 0
    for start in range(len(points)):
        if core[start] and label[start] < 0:
            label[start], todo = current, [start]
            while todo:
                at = todo.pop()
                for n in near[at]:
                    if label[n] < 0:
                        label[n] = current
                        if core[n]:
                            todo.append(int(n))
            current += 1
    return label


def cluster(cands: DataFrame, key: str, axes: list[str], id_col: str, radius: float, least: int) -> DataFrame:
    """cluster of each candidate within its gulp, as density_labels numbers them; ids are unique within a gulp.

    Groups of dense points are found as in reach.dense_groups, so a gulp may have any size and points may lie as close as they like; a
    border point goes to the least cluster that it touches. Points with a null or NaN axis are noise.
    """
    names = [f"x{n}" for n in range(len(axes))]
    rows = materialize(cands.select(F.col(key).alias("k"), F.col(id_col).alias("id"), *[F.col(a).cast("double").alias(x) for a, x in zip(axes, names, strict=True)]), "points")
    square = lambda o: sum((d * d for d in o[1:]), o[0] * o[0])
    dense, sparse = reach.dense_groups(reach.positions(rows, names), names, [radius], least, square, [radius * radius])
    numbers = dense.select("k", "root").distinct().withColumn("cluster", F.row_number().over(Window.partitionBy("k").orderBy("root")) - 1)
    numbered = materialize(dense.join(numbers.hint("merge"), ["k", "root"]), "numbered")
    border = sparse.join(reach.touched(sparse, numbered, names, "cluster", square).hint("merge"), ["level", "k", "id"])
    labels = numbered.select("k", *names, "cluster").unionByName(border.select("k", *names, "cluster"))
    out = rows.join(labels.hint("merge"), ["k", *names], "left")
    return materialize(out.select(F.col("k").alias(key), F.col("id").alias(id_col), F.coalesce("cluster", F.lit(-1)).cast("int").alias("cluster")), "clusters")


def iterate_clusters(cands: DataFrame, key: str, axes: list[str], id_col: str, radius: float, least: int, rounds: int = 3) -> DataFrame:
    """Rounds of clustering on what is still noise, with least, least // 2, ... (2 at least) members; round -1 is noise."""
    left, out = cands, None
    for r in range(rounds):
        got = cluster(left, key, axes, id_col, radius, max(least // (r + 1), 2)).withColumn("round", F.lit(r))
        found = got.where("cluster >= 0")
        out = found if out is None else out.unionByName(found)
        left = left.join(got.where("cluster < 0").select(key, id_col).hint("merge"), [key, id_col], "left_semi")
    return out.unionByName(left.select(key, id_col, F.lit(-1).alias("cluster"), F.lit(-1).alias("round")))


def convolve(x: np.ndarray, weights: np.ndarray, bias: np.ndarray) -> np.ndarray:
    """Valid correlation of (n, c, ...) with (k, c, ...), over any number of space axes."""
    axes = tuple(range(2, x.ndim))
    view = np.lib.stride_tricks.sliding_window_view(x, weights.shape[2:], axis=axes)
    letters = "abc"[: len(axes)]
    inner = "uvw"[: len(axes)]
    return np.einsum(f"nz{letters}{inner},kz{inner}->nk{letters}", view, weights) + bias.reshape(1, -1, *[1] * len(axes))


def features(cubes: np.ndarray, layers: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """Cut-outs through convolutions with rectifiers and a mean over space: one row of numbers each."""
    x = (cubes - cubes.mean(axis=tuple(range(1, cubes.ndim)), keepdims=True)) / (cubes.std(axis=tuple(range(1, cubes.ndim)), keepdims=True) + 1e-9)
    for weights, bias in layers:
        x = np.maximum(convolve(x, weights, bias), 0)
    return x.mean(axis=tuple(range(2, x.ndim)))


def score(cubes: np.ndarray, layers: list[tuple[np.ndarray, np.ndarray]], head: tuple[np.ndarray, float]) -> np.ndarray:
    """Probabilities of cut-outs: their features, a linear head, a sigmoid."""
    return 1 / (1 + np.exp(-(features(cubes, layers) @ head[0] + head[1])))


def fit_head(cutouts: DataFrame, shape: tuple[int, ...], layers: list, rounds: int = 12, ridge: float = 1.0) -> tuple[np.ndarray, float]:
    """The head of a network by logistic regression on labelled cut-outs (pixels, label 0 or 1): Newton steps, each a sum over
    all rows of matrices as wide as the last layer, one a task. Rows without a label are left out; (0, 0) where there are none."""
    width = len(layers[-1][1]) + 1
    shared = cutouts.sparkSession.sparkContext.broadcast(layers)

    def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            if len(rows):
                cubes = np.nan_to_num(np.stack([np.asarray(p, float).reshape(shape) for p in rows["pixels"]]))
                yield pd.DataFrame({"x": list(features(cubes, shared.value)), "label": rows["label"].astype(float)})

    known = materialize(cutouts.where("label is not null and pixels is not null").select("pixels", "label").mapInPandas(measure, "x array<double>, label double"), "features")
    beta = np.zeros(width)
    for _ in range(rounds):

        def sums(batches: Iterator[pd.DataFrame], beta: np.ndarray = beta) -> Iterator[pd.DataFrame]:
            slope, curve = np.zeros(width), np.zeros((width, width))
            for rows in batches:
                if len(rows):
                    x = np.column_stack([np.stack(rows["x"]), np.ones(len(rows))])
                    p = 1 / (1 + np.exp(-x @ beta))
                    slope += x.T @ (rows["label"].to_numpy() - p)
                    curve += (x * (p * (1 - p))[:, None]).T @ x
            yield pd.DataFrame({"at": np.arange(width * (width + 1)), "v": np.concatenate([slope, curve.ravel()])})

        total = {r["at"]: r["v"] for r in known.mapInPandas(sums, "at int, v double").groupBy("at").agg(F.sum("v").alias("v")).collect()}  # width * (width + 1) rows
        if not total:
            break
        flat = np.array([total[k] for k in range(width * (width + 1))])
        step = np.linalg.solve(flat[width:].reshape(width, width) + ridge * np.eye(width), flat[:width] - ridge * beta)
        beta = beta + step
        if np.abs(step).max() < 1e-8:
            break
    return beta[:-1], float(beta[-1])


def classify(cutouts: DataFrame, shape: tuple[int, ...], layers: list, head: tuple, cut: float = 0.5) -> DataFrame:
    """cand_id, prob and predict (1: interference) of cut-outs (cand_id, pixels array<double> in row-major order).

    Weights go to each executor once, as a broadcast variable. Null pixels count as 0.
    """
    shared = cutouts.sparkSession.sparkContext.broadcast((layers, head))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            if not len(rows):
                continue
            cubes = np.nan_to_num(np.stack([np.asarray(p, float).reshape(shape) for p in rows["pixels"]]))
            p = score(cubes, *shared.value)
            yield pd.DataFrame({"cand_id": rows["cand_id"], "prob": p, "predict": (p > cut).astype("int32")})

    return cutouts.select("cand_id", "pixels").mapInPandas(run, "cand_id bigint, prob double, predict int")


def two_stage(first: DataFrame, second: DataFrame, cut: float = 0.5) -> DataFrame:
    """The product of two classifiers' probabilities through one more sigmoid, as the cut expects it."""
    both = first.select("cand_id", F.col("prob").alias("a")).join(second.select("cand_id", F.col("prob").alias("b")), "cand_id")
    p = 1 / (1 + F.exp(-F.col("a") * F.col("b")))
    return both.select("cand_id", p.alias("prob"), (p > cut).cast("int").alias("predict"))
