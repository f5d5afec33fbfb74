"""Streams that are started again when they fail, but not again and again."""

from __future__ import annotations

import threading
import time
from collections.abc import Callable

from pyspark.errors import StreamingQueryException
from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener


class TooManyFailures(RuntimeError):
    """A query failed as often as it may within the time; its checkpoint is as the last good batch left it."""


class FailureCount(StreamingQueryListener):
    """Times of failed runs by the query's id, which a checkpoint keeps through restarts. Runs that end well don't count."""

    def __init__(self, clock: Callable[[], float] = time.monotonic):
        self.clock, self.failed, self.ended, self.news = clock, {}, set(), threading.Condition()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        with self.news:
            if event.exception:
                self.failed.setdefault(str(event.id), []).append(self.clock())
            self.ended.add(str(event.runId))
            self.news.notify_all()

    def recent(self, query: StreamingQuery, seconds: float) -> int:
        """Failures of the query in the last seconds, its run that has just ended included (events come a little later than the end)."""
        with self.news:
            self.news.wait_for(lambda: str(query.runId) in self.ended, timeout=30)
            now = self.clock()
            return sum(now - at <= seconds for at in self.failed.get(str(query.id), []))


def supervised(spark: SparkSession, start: Callable[[], StreamingQuery], most: int = 3, seconds: float = 600.0, pause: float = 0.0, clock: Callable[[], float] = time.monotonic) -> int:
    """Run start()'s query to its end, again after each failure, and return how many there were. With the `most`-th failure within
    the seconds it stays down: TooManyFailures. Each start goes on from the checkpoint, so no batch is lost or counted twice where the
    sink replaces what a batch wrote before."""
    count, total = FailureCount(clock), 0
    spark.streams.addListener(count)
    try:
        while True:
            query = start()
            try:
                query.awaitTermination()
                return total
            except StreamingQueryException as failure:
                total += 1
                if count.recent(query, seconds) >= most:
                    raise TooManyFailures(f"{most} failures within {seconds:g} s") from failure
                time.sleep(pause)
    finally:
        spark.streams.removeListener(count)
