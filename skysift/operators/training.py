"""Convolutional classifiers trained by back-propagation over distributed cut-outs.

Each round is one pass: tasks sum the gradient of their rows, a sum by place over the tasks' rows adds them up, and the driver takes a
step of bounded size with moments of the gradient. The weights are a fixed number, whatever the table; they go to tasks
as a broadcast variable. The number of rounds is fixed, so a run is repeatable but for the order of sums.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skysift.operators.learned import convolve
from skysift.stored import materialize

#: Step length, decays of the moments and the weight of the squared weights in the loss.
STEP, DECAY, RIDGE = 0.03, (0.9, 0.99), 1e-4


def normalized(cubes: np.ndarray) -> np.ndarray:
    """Each cut-out less its mean, over its deviation."""
    axes = tuple(range(1, cubes.ndim))
    return (cubes - cubes.mean(axis=axes, keepdims=True)) / (cubes.std(axis=axes, keepdims=True) + 1e-9)


@dataclass(frozen=True)
class Network:
    """Valid convolutions with rectifiers, means over blocks of `pool` places a side, a linear head, a sigmoid. shape: of a cut-out,
    channels first, with two or three axes of space."""

    shape: tuple[int, ...]
    kernels: tuple[tuple[int, ...], ...]
    pool: int

    def sizes(self) -> list[tuple[int, ...]]:
        """The shapes of all weights in the order of the vector that holds them: kernel and bias of each layer, head and its bias."""
        out, channels, space = [], self.shape[0], self.shape[1:]
        for count, *side in self.kernels:
            out += [(count, channels, *side), (count,)]
            channels, space = count, tuple(s - k + 1 for s, k in zip(space, side, strict=True))
        return [*out, (channels * int(np.prod([s // self.pool for s in space])),), (1,)]

    def split(self, weights: np.ndarray) -> list[np.ndarray]:
        out, at = [], 0
        for size in self.sizes():
            n = int(np.prod(size))
            out.append(weights[at : at + n].reshape(size))
            at += n
        return out

    def start(self, seed: int) -> np.ndarray:
        r = np.random.default_rng(seed)
        parts = [r.normal(0, 1 / np.sqrt(max(1, np.prod(s[1:]) if len(s) > 1 else s[0])), s) if len(s) > 1 or s == self.sizes()[-2] else np.zeros(s) for s in self.sizes()]
        return np.concatenate([p.ravel() for p in parts])

    def _pooled(self, x: np.ndarray) -> np.ndarray:
        p = self.pool
        x = x[(slice(None), slice(None), *[slice(0, s // p * p) for s in x.shape[2:]])]
        blocks = [n for s in x.shape[2:] for n in (s // p, p)]
        return x.reshape(*x.shape[:2], *blocks).mean(axis=tuple(range(3, 3 + 2 * len(self.shape[1:]), 2)))

    def _spread(self, d: np.ndarray, like: np.ndarray) -> np.ndarray:
        """The gradient before the means of one behind them."""
        p = self.pool
        out = np.zeros_like(like)
        for axis in range(2, d.ndim):
            d = np.repeat(d, p, axis=axis)
        out[(slice(None), slice(None), *[slice(0, s) for s in d.shape[2:]])] = d / p ** (d.ndim - 2)
        return out

    def probabilities(self, weights: np.ndarray, cubes: np.ndarray) -> np.ndarray:
        """Of cut-outs (n, *shape) that are interference."""
        *layers, head, bias = self.split(weights)
        x = normalized(cubes)
        for w, b in zip(layers[::2], layers[1::2], strict=True):
            x = np.maximum(convolve(x, w, b), 0)
        return 1 / (1 + np.exp(-np.clip(self._pooled(x).reshape(len(x), -1) @ head + bias, -30, 30)))

    def gradient(self, weights: np.ndarray, cubes: np.ndarray, labels: np.ndarray) -> tuple[float, np.ndarray]:
        """The sum of the rows' logistic loss, and its gradient."""
        *layers, head, bias = self.split(weights)
        seen = [normalized(cubes)]
        for w, b in zip(layers[::2], layers[1::2], strict=True):
            seen.append(np.maximum(convolve(seen[-1], w, b), 0))
        means = self._pooled(seen[-1])
        flat = means.reshape(len(cubes), -1)
        z = np.clip(flat @ head + bias, -30, 30)
        p = 1 / (1 + np.exp(-z))
        loss = float((np.logaddexp(0, z) - labels * z).sum())
        d = p - labels
        parts = [d @ flat, np.array([d.sum()])]
        d = self._spread(np.outer(d, head).reshape(means.shape), seen[-1])
        letters, inner = "abc"[: d.ndim - 2], "uvw"[: d.ndim - 2]
        for n in reversed(range(len(layers) // 2)):
            w, x = layers[2 * n], seen[n]
            d = d * (seen[n + 1] > 0)
            axes = tuple(range(2, x.ndim))
            view = np.lib.stride_tricks.sliding_window_view(x, w.shape[2:], axis=axes)
            parts = [np.einsum(f"nz{letters}{inner},nk{letters}->kz{inner}", view, d, optimize=True).ravel(), d.sum(axis=(0, *axes)), *parts]
            if n:
                wide = np.pad(d, [(0, 0), (0, 0), *[(k - 1, k - 1) for k in w.shape[2:]]])
                d = convolve(wide, np.flip(w, axis=axes).swapaxes(0, 1), np.zeros(w.shape[1]))
        return loss, np.concatenate([p.ravel() for p in parts])


def _cubes(pixels: pd.Series, shape: tuple[int, ...]) -> np.ndarray:
    return np.nan_to_num(np.stack([np.asarray([np.nan if v is None else v for v in p], float).reshape(shape) for p in pixels]))


def train(cutouts: DataFrame, network: Network, rounds: int, seed: int = 0) -> tuple[np.ndarray, list[float]]:
    """Weights after so many rounds over labelled cut-outs (pixels, label 0 or 1), and the mean loss of each round. Rows without a label
    or pixels are left out; without any the weights are those of the start. Null pixels count as 0."""
    spark = cutouts.sparkSession
    known = materialize(cutouts.where("label is not null and pixels is not null").select(F.col("pixels").cast("array<double>").alias("pixels"), F.col("label").cast("double").alias("label")), "labelled")
    weights = network.start(seed)
    first, second, losses = np.zeros_like(weights), np.zeros_like(weights), []
    for turn in range(1, rounds + 1):
        shared = spark.sparkContext.broadcast(weights)

        def sums(batches: Iterator[pd.DataFrame], shared=shared) -> Iterator[pd.DataFrame]:
            total, loss, count = np.zeros(len(shared.value)), 0.0, 0
            for rows in batches:
                if len(rows):
                    part, slope = network.gradient(shared.value, _cubes(rows["pixels"], network.shape), rows["label"].to_numpy(float))
                    total, loss, count = total + slope, loss + part, count + len(rows)
            yield pd.DataFrame({"at": np.arange(len(total) + 2), "v": np.concatenate([total, [loss, count]])})

        found = {r["at"]: r["v"] for r in known.mapInPandas(sums, "at int, v double").groupBy("at").agg(F.sum("v").alias("v")).collect()}  # a row a weight
        shared.destroy()
        count = found.get(len(weights) + 1, 0.0)
        if not count:
            break
        losses.append(found[len(weights)] / count)
        slope = np.array([found[k] for k in range(len(weights))]) / count + RIDGE * weights
        first = DECAY[0] * first + (1 - DECAY[0]) * slope
        second = DECAY[1] * second + (1 - DECAY[1]) * slope**2
        weights = weights - STEP * (first / (1 - DECAY[0] ** turn)) / (np.sqrt(second / (1 - DECAY[1] ** turn)) + 1e-8)
    return weights, losses


def classify(cutouts: DataFrame, network: Network, weights: np.ndarray, cut: float = 0.5) -> DataFrame:
    """cand_id, prob and predict (1: interference) of cut-outs (cand_id, pixels); without pixels all are null but the id."""
    shared = cutouts.sparkSession.sparkContext.broadcast(weights)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            there = rows["pixels"].notna().to_numpy()
            p = np.full(len(rows), np.nan)
            if there.any():
                p[there] = network.probabilities(shared.value, _cubes(rows["pixels"][there], network.shape))
            yield pd.DataFrame({"cand_id": rows["cand_id"], "prob": p})

    out = cutouts.select("cand_id", F.col("pixels").cast("array<double>").alias("pixels")).mapInPandas(run, "cand_id bigint, prob double")
    prob = F.when(~F.isnan("prob"), F.col("prob"))
    return out.select("cand_id", prob.alias("prob"), (prob > cut).cast("int").alias("predict"))
