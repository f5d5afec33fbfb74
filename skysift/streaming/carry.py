"""De-dispersion of a stream, gulp by gulp: the samples that later gulps need stay in keyed state.

State of a key: the number of the next gulp, the last `reach` samples of each channel, and the gulps that are open. A gulp is given
out when it is the next one and all its samples are there, or when the watermark passes its end; then with what
came. Only so many gulps are open as the watermark's delay spans, so state has a bound however long the stream runs.
"""

from __future__ import annotations

import contextlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"


@contextlib.contextmanager
def keyed_state(spark: SparkSession):
    """Streams started inside keep their state in RocksDB, as state with several variables and timers needs it."""
    before = spark.conf.get(_PROVIDER)
    spark.conf.set(_PROVIDER, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        yield
    finally:
        spark.conf.set(_PROVIDER, before)


class Dedisperser:
    """The arithmetic on plain arrays: trials of a gulp from the samples before it and its own."""

    def __init__(self, delays: list[tuple[int, int, int, float]], nchan: int, nsamps: int):
        """delays: (dm_idx, chan, shift, weight), all shifts at or before the sample."""
        if any(shift > 0 for _, _, shift, _ in delays):
            raise ValueError("a trial needs later samples: shift the reference channel")
        self.nchan, self.nsamps = nchan, nsamps
        self.delays = sorted(d for d in delays if d[3])
        self.reach = max((-d[2] for d in self.delays), default=0)
        self.trials = sorted({d[0] for d in self.delays})

    def series(self, history: np.ndarray, gulp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Values and numbers of samples in them, (trial, time), of (chan, reach) and (chan, nsamps); a missing sample is NaN."""
        x = np.concatenate([history, gulp], axis=1)
        there = ~np.isnan(x)
        x = np.where(there, x, 0.0)
        value, count = np.zeros((len(self.trials), self.nsamps)), np.zeros((len(self.trials), self.nsamps), np.int64)
        row = {dm: n for n, dm in enumerate(self.trials)}
        for dm, chan, shift, weight in self.delays:
            at = slice(self.reach + shift, self.reach + shift + self.nsamps)
            value[row[dm]] += weight * x[chan, at]
            count[row[dm]] += there[chan, at]
        return value, count

    def carried(self, history: np.ndarray, gulp: np.ndarray) -> np.ndarray:
        """The history that the next gulp needs."""
        return np.concatenate([history, gulp], axis=1)[:, self.nsamps :] if self.reach else history


class _Carry(StatefulProcessor):
    def __init__(self, key: str, sums: Dedisperser, gulp_ms: int, origin_ms: int):
        self.key, self.sums, self.gulp_ms, self.origin_ms = key, sums, gulp_ms, origin_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.head = handle.getValueState("head", "gulp bigint, history array<double>")
        self.open = handle.getMapState("open", "gulp bigint", "cells array<double>, filled int")

    def _end(self, gulp: int) -> int:
        return self.origin_ms + (gulp + 1) * self.gulp_ms

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        nchan, nsamps = self.sums.nchan, self.sums.nsamps
        next_gulp = self.head.get()[0] if self.head.exists() else None
        for frame in rows:
            for gulp, part in frame.groupby("gulp"):
                gulp = int(gulp)
                if next_gulp is not None and gulp < next_gulp:
                    continue  # closed
                if self.open.containsKey((gulp,)):
                    cells = np.array(self.open.getValue((gulp,))[0], float)
                else:
                    cells = np.full(nchan * nsamps, np.nan)
                    self.handle.registerTimer(self._end(gulp))
                at = part["chan"].to_numpy(np.int64) * nsamps + part["t"].to_numpy(np.int64) - gulp * nsamps
                fresh = np.isnan(cells[at]) & part["value"].notna().to_numpy()  # of a sample that comes twice the first counts
                first = np.unique(at[fresh], return_index=True)
                cells[first[0]] = part["value"].to_numpy(float)[fresh][first[1]]
                self.open.updateValue((gulp,), (cells.tolist(), int((~np.isnan(cells)).sum())))
        if next_gulp is not None:
            whole, last = nchan * nsamps, None
            while self.open.containsKey((next_gulp if last is None else last + 1,)):
                at = next_gulp if last is None else last + 1
                if self.open.getValue((at,))[1] < whole:
                    break
                last = at
            if last is not None:
                yield from self._give_out(key, last, True)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        gulp = (expiredTimerInfo.getExpiryTimeInMs() - self.origin_ms) // self.gulp_ms - 1
        if self.open.containsKey((gulp,)):
            yield from self._give_out(key, gulp, False)

    def _give_out(self, key, upto: int, timed: bool) -> Iterator[pd.DataFrame]:
        """All gulps up to this one, in order; a gulp between them of which nothing came counts as missing samples."""
        sums = self.sums
        shape = (sums.nchan, sums.nsamps)
        known = {g[0]: c[0] for g, c in self.open.iterator() if g[0] <= upto}
        if self.head.exists():
            gulp, history = self.head.get()
            history = np.array(history, float).reshape(sums.nchan, sums.reach)
        else:
            gulp, history = min(known), np.full((sums.nchan, sums.reach), np.nan)
        out = []
        while gulp <= upto:
            block = np.array(known[gulp], float).reshape(shape) if gulp in known else np.full(shape, np.nan)
            value, count = sums.series(history, block)
            trial, t = np.nonzero(count)
            if len(trial):
                out.append((np.array(sums.trials)[trial], t + gulp * sums.nsamps, value[trial, t]))
            history = sums.carried(history, block)
            if gulp in known:
                self.open.removeKey((gulp,))
                if timed:
                    self.handle.deleteTimer(self._end(gulp))
            gulp += 1
            if np.isnan(history).all():  # nothing is left to carry over the gap
                gulp = min((g for g in known if g >= gulp), default=upto + 1)
        self.head.update((upto + 1, history.ravel().tolist()))
        if out:
            dm_idx, t, value = (np.concatenate(x) for x in zip(*out, strict=True))
            yield pd.DataFrame({self.key: pd.Series([key[0]] * len(t), dtype=object), "dm_idx": dm_idx, "t": t, "value": value})

    def close(self) -> None:
        pass


def dedisperse(stream: DataFrame, delays: DataFrame, key: str, nchan: int, nsamps: int, gulp_seconds: float, wait: str, origin_us: int = 0) -> DataFrame:
    """(key, dm_idx, t, value) of rows (key, chan, t, value) with t counted from origin_us in samples, `nsamps` a gulp.

    As operators.search.dedisperse gives it over all samples that came in time: a gulp waits for its samples until the watermark
    (`wait` behind the newest gulp's end) passes its end. delays: the trials' table, a fixed number of rows; no shift may
    be above 0. A key begins with the first gulp that closes. Null values are missing samples.
    """
    table = [(r.dm_idx, r.chan, r.shift, r.weight) for r in delays.collect()]
    gulp = F.floor(F.col("t") / nsamps).cast("bigint")
    gulp_ms = int(gulp_seconds * 1000)
    at = F.timestamp_micros((F.lit(origin_us) + (gulp + 1) * gulp_ms * 1000).cast("bigint"))
    rows = stream.select(F.col(key), F.col("chan").cast("int").alias("chan"), F.col("t").cast("bigint").alias("t"), F.col("value").cast("double").alias("value"), gulp.alias("gulp"), at.alias("at"))
    kind = stream.schema[key].dataType.simpleString()
    work = _Carry(key, Dedisperser(table, nchan, nsamps), gulp_ms, origin_us // 1000)
    return rows.withWatermark("at", wait).groupBy(key).transformWithStateInPandas(work, f"{key} {kind}, dm_idx int, t bigint, value double", "Append", "EventTime")
