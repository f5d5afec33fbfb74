"""Restarts after failures: no batch lost or doubled, and an end to them."""

import pytest
from pyspark.sql import functions as F

from skysift.streaming import supervise


class Sink:
    """Sums batches into a table of their own each, and fails when told to."""

    def __init__(self, base, failures):
        self.base, self.failures, self.tries = base, failures, []

    def put(self, batch, number):
        self.tries.append(number)
        batch.groupBy("k").count().write.mode("overwrite").parquet(f"{self.base}/out/batch={number}")
        if self.failures and self.failures[0] == number:
            self.failures.pop(0)
            raise ValueError("told to")


def started(spark, base, sink):
    def start():
        stream = spark.readStream.schema("k int, v int").option("maxFilesPerTrigger", 1).parquet(f"{base}/in")
        return stream.writeStream.option("checkpointLocation", f"{base}/state").foreachBatch(sink.put).trigger(availableNow=True).start()

    return start


@pytest.fixture
def base(spark, tmp_path):
    for n in range(3):
        spark.range(10).select((F.col("id") % 2).cast("int").alias("k"), F.lit(n).alias("v")).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    return str(tmp_path)


def test_two_failures_are_made_good(spark, base):
    sink = Sink(base, [0, 2])
    assert supervise.supervised(spark, started(spark, base, sink)) == 2
    assert sink.tries == [0, 0, 1, 2, 2]
    assert spark.read.parquet(f"{base}/out").agg(F.sum("count")).first()[0] == 30


def test_the_third_failure_stops_it_with_its_state_intact(spark, base):
    sink = Sink(base, [1, 1, 1, 1])
    with pytest.raises(supervise.TooManyFailures):
        supervise.supervised(spark, started(spark, base, sink))
    assert sink.tries == [0, 1, 1, 1]
    sink.failures.clear()
    assert supervise.supervised(spark, started(spark, base, sink)) == 0
    assert sink.tries[4:] == [1, 2] and spark.read.parquet(f"{base}/out").agg(F.sum("count")).first()[0] == 30


def test_failures_long_apart_do_not_add_up(spark, base):
    now = iter(range(0, 100_000, 1000))
    sink = Sink(base, [0, 0, 1, 1, 2])
    assert supervise.supervised(spark, started(spark, base, sink), seconds=500, clock=lambda: next(now)) == 5
