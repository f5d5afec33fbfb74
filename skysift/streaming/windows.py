"""Windows of gulps that begin with a gulp, may overlap, and take what is nearest to each of their times.

Gulps are taken in the order of their times, when the watermark passes them, so late order within its delay changes nothing. A
gulp joins every open window that has a place within half a gulp of it; a place that is filled stays as it is. It begins a
window of its own where it joins none, or where it is `stride` places into the newest. A window is given out when it is full,
or, with what is missing, when the watermark passes its end.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle


class Windows:
    """The rules on plain values: windows [anchor, values by place, given out], oldest first; times in microseconds."""

    def __init__(self, gulp: int, gulps: int, stride: int):
        if not 0 < stride <= gulps:
            raise ValueError("a stride is 1 to the number of gulps")
        self.gulp, self.gulps, self.stride = gulp, gulps, stride
        self.open: list[list] = []

    def end(self, anchor: int) -> int:
        """From here on nothing is nearest to the window's last place."""
        return anchor + self.gulps * self.gulp - self.gulp // 2

    def close(self, now: int) -> list[tuple[int, list]]:
        """Windows that end by now and were not given out."""
        ended = [w for w in self.open if self.end(w[0]) <= now]
        self.open = [w for w in self.open if self.end(w[0]) > now]
        return [(anchor, places) for anchor, places, out in ended if not out]

    def take(self, at: int, value: float) -> list[tuple[int, list]]:
        """Windows that end before this gulp, and those that it fills. Gulps come in the order of their times."""
        done = self.close(at)
        place = None
        for w in self.open:
            place = (at - w[0] + self.gulp // 2) // self.gulp
            if w[1][place] is None:
                w[1][place] = value
        if place is None or place >= self.stride:
            self.open.append([at, [value, *[None] * (self.gulps - 1)], False])
        for w in self.open:
            if not w[2] and None not in w[1]:
                w[2] = True
                done.append((w[0], w[1]))
        return done


class _Nearest(StatefulProcessor):
    def __init__(self, key: str, gulp: int, gulps: int, stride: int):
        self.key, self.rules = key, (gulp, gulps, stride)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getMapState("waiting", "us bigint, id bigint", "value double")
        self.open = handle.getValueState("open", "windows string")  # stride and gulps bound their number

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        for frame in rows:
            for us, id_, value in zip(frame["us"].tolist(), frame["id"].tolist(), frame["value"].tolist(), strict=True):
                self.waiting.updateValue((us, id_), (value,))
                self.handle.registerTimer(us // 1000)
        yield from ()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        now = timerValues.getCurrentWatermarkInMs()  # the first timer does the work of all that expire with it
        windows = Windows(*self.rules)
        if self.open.exists():
            windows.open = json.loads(self.open.get()[0])
        done = []
        ready = sorted((k[0], k[1], v[0]) for k, v in self.waiting.iterator() if k[0] // 1000 <= now)
        known = {w[0] for w in windows.open}
        for us, id_, value in ready:
            done += windows.take(us, value)
            self.waiting.removeKey((us, id_))
        done += windows.close(now * 1000)
        for w in windows.open:
            if w[0] not in known:
                self.handle.registerTimer(-(-windows.end(w[0]) // 1000))
        self.open.update((json.dumps(windows.open),))
        if done:
            filled = [[v for v in places if v is not None] for _, places in done]
            yield pd.DataFrame({
                self.key: pd.Series([key[0]] * len(done), dtype=object), "start": [anchor for anchor, _ in done],
                "missing": [sum(1 << n for n, v in enumerate(places) if v is None) for _, places in done],
                "mean": [sum(v) / len(v) for v in filled],
            })

    def close(self) -> None:
        pass


def nearest_windows(stream: DataFrame, key: str, gulp_seconds: float, gulps: int, stride: int, wait: str) -> DataFrame:
    """(key, start in microseconds, missing, mean of what is there) of rows (key, at, id, value), a row a gulp. missing has bit n for place n.

    stride = gulps: windows follow each other. Of gulps that fall on one place the first in time counts (at one time the least id).
    Rows behind the watermark are left out; rows without a time, a key or a value don't count.
    """
    rows = stream.where(F.col(key).isNotNull() & F.col("at").isNotNull() & F.col("value").isNotNull())
    rows = rows.select(key, "at", F.unix_micros("at").alias("us"), F.col("id").cast("bigint").alias("id"), F.col("value").cast("double").alias("value"))
    kind = stream.schema[key].dataType.simpleString()
    work = _Nearest(key, int(round(gulp_seconds * 1e6)), gulps, stride)
    return rows.withWatermark("at", wait).groupBy(key).transformWithStateInPandas(work, f"{key} {kind}, start bigint, missing int, mean double", "Append", "EventTime")
