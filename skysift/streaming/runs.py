"""Streaming operators on event streams, and a helper that replays what is there and returns the result table."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from skysift.operators import noise
from skysift.sources import pages
from skysift.stored import materialize, new_folder

_EPOCH = 1704067200000000


def event_stream(spark: SparkSession, sf_dir: str, files: int = 1) -> DataFrame:
    """The events table as a stream; `at` is the moment (without zone in the file: taken as UTC)."""
    schema = spark.read.parquet(f"{sf_dir}/events.parquet").schema
    raw = spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(f"{sf_dir}/events.parquet*")
    us = F.timestamp_diff("MICROSECOND", F.lit("2024-01-01 00:00:00").cast("timestamp_ntz"), "ts") + _EPOCH
    return raw.withColumn("at", F.timestamp_micros(us))


def _run(stream: DataFrame, mode: str, base: str):
    """Run the stream over what is there now, from its checkpoint on; its last progress, None without any. Each micro-batch writes a folder of its own, named by
    its number, so one that is run again replaces its output; in complete mode the last one is the result."""

    def put(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{base}/out/batch={number if mode != 'complete' else 0}")

    query = stream.writeStream.outputMode(mode).option("checkpointLocation", f"{base}/state").foreachBatch(put).trigger(availableNow=True).start()
    query.awaitTermination()
    return query.lastProgress


def _result(spark: SparkSession, schema: T.StructType, base: str, written: bool, keys: list[str] | None = None) -> DataFrame:
    """All rows given out; with keys (of a stream in update mode) the last one of each."""
    if not written:
        return spark.createDataFrame([], schema)
    if keys:
        rest = [n for n in schema.names if n not in keys]
        rows = spark.read.option("basePath", f"{base}/out").schema(T.StructType([*schema.fields, T.StructField("batch", T.IntegerType())])).parquet(f"{base}/out")
        return rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), "batch").alias("last")).select(*keys, "last.*").select(*schema.names)
    return spark.read.option("basePath", f"{base}/out").schema(schema).parquet(f"{base}/out").select(*schema.names)


def replay(stream: DataFrame, mode: str) -> DataFrame:
    """The result table of a stream over what is there now."""
    base = new_folder(stream.sparkSession, "streams")
    return _result(stream.sparkSession, stream.schema, base, _run(stream, mode, base))


def feed(rows: DataFrame, slices: list[Column], build: Callable[[DataFrame], DataFrame], mode: str = "append", keys: list[str] | None = None) -> DataFrame:
    """The result table of build(stream) when the rows land slice by slice: after each landing the stream goes on from its
    checkpoint, as a scheduled job would. slices: a few conditions that part the rows, in order of arrival. In update mode the
    last row of each of the keys counts: an aggregate's state goes when the watermark passes it, its row stays."""
    spark = rows.sparkSession
    base, written = new_folder(spark, "streams"), False
    for landed in slices:
        rows.where(landed).write.mode("append").parquet(f"{base}/in")
        stream = build(spark.readStream.schema(rows.schema).parquet(f"{base}/in"))
        written = _run(stream, mode, base) or written
    return _result(spark, stream.schema, base, written, keys)


def through_pages(rows: DataFrame, slices: list[Column], order: str, page_bytes: int) -> DataFrame:
    """Pages (pages.SCHEMA) of image messages that land slice by slice: one stream appends them to a buffer, in the order of a column
    within a micro-batch, and another reads the buffer after each landing. Both go on from their checkpoints."""
    spark = rows.sparkSession
    spark.dataSource.register(pages.PageSource)
    base, written = new_folder(spark, "streams"), False
    for landed in slices:
        rows.where(landed).write.mode("append").parquet(f"{base}/in")
        stream = spark.readStream.schema(rows.schema).parquet(f"{base}/in")
        sink = pages.image_pages(stream.repartition(4, order)).writeStream.format("pages").option("path", f"{base}/buffer").option("page_bytes", page_bytes)
        sink.option("checkpointLocation", f"{base}/sink").trigger(availableNow=True).start().awaitTermination()
        source = spark.readStream.format("pages").option("path", f"{base}/buffer").load()
        written = _run(source, "append", base) or written
    return _result(spark, source.schema, base, written)


def tumbling(stream: DataFrame, size: str, late: str, keys: list[str], slide: str | None = None) -> DataFrame:
    """Counts and sums of windows of a size; with a slide the windows overlap. Rows later than `late` are left out."""
    window = F.window("at", size, slide) if slide else F.window("at", size)
    return stream.withWatermark("at", late).groupBy(window, *keys).agg(F.count("*").alias("n"), F.sum("value").alias("total")).select(F.unix_micros("window.start").alias("start"), *keys, "n", "total")


def sessions(stream: DataFrame, gap: str, late: str, keys: list[str]) -> DataFrame:
    """Runs of rows of a key without a gap as long as that; given out in append mode when the watermark passes the last row's gap."""
    windowed = stream.withWatermark("at", late).groupBy(F.session_window("at", gap), *keys).agg(F.count("*").alias("n"))
    return windowed.select(F.unix_micros("session_window.start").alias("start"), *keys, "n")


def throttle(rows: DataFrame, key: str, seconds: float) -> DataFrame:
    """Triggers of a key (with us, event_id), but none within `seconds` (above 0) of the last one that passed.

    rows is a table: which triggers pass depends on all earlier ones, in whatever order or files they came.
    The next one that would pass after each moment is found in time buckets of that length, and the chain from the
    first one is marked by doubling: with each round over stored tables, twice as many steps. A task of the search
    holds the distinct moments of one key in one bucket, or one row a bucket of one key. Null times or keys don't pass.
    """
    gap = int(round(seconds * 1e6))
    times = materialize(rows.select(F.col(key).alias("key"), F.unix_micros("at").alias("us"), "event_id").where("key is not null and us is not null").groupBy("key", "us").agg(F.min("event_id").alias("event_id")), "times")
    floor = lambda c: F.expr(f"cast({c} div {gap} - if({c} % {gap} < 0, 1, 0) as bigint)")
    at = times.select("key", "us", floor("us").alias("b"))
    by_bucket = Window.partitionBy("key").orderBy("b")
    after = at.groupBy("key", "b").agg(F.min("us").alias("f")).select("key", "b", *[F.lead(c, n).over(by_bucket).alias(f"{c}{n}") for c, n in (("b", 1), ("f", 1), ("f", 2))])
    # in the bucket of the moment `gap` later: the first row from then on; a row comes before a moment sought at its time
    sought = at.select("key", (F.col("b") + 1).alias("b"), (F.col("us") + gap).alias("t"), F.lit(1).alias("o"), F.lit(None).cast("bigint").alias("row"), "us")
    there = at.select("key", "b", F.col("us").alias("t"), F.lit(0).alias("o"), F.col("us").alias("row"), F.lit(None).cast("bigint").alias("us"))
    down = Window.partitionBy("key", "b").orderBy(F.desc("t"), "o").rowsBetween(Window.unboundedPreceding, 0)
    near = sought.unionByName(there).withColumn("found", F.last("row", ignorenulls=True).over(down)).where("us is not null").select("key", (F.col("b") - 1).alias("b"), "us", "found")
    later = F.when(F.col("b1") == F.col("b") + 1, F.col("f2")).otherwise(F.col("f1"))
    jump = materialize(near.join(after, ["key", "b"]).select("key", F.col("us").alias("a"), F.coalesce("found", later).alias("z")).where("z is not null"), "jumps")
    passed = materialize(times.groupBy("key").agg(F.min("us").alias("us")), "passed")
    many = passed.count()
    while True:
        step = passed.join(jump.withColumnRenamed("a", "us"), ["key", "us"]).select("key", F.col("z").alias("us"))
        passed = materialize(passed.unionByName(step).distinct(), "passed")
        if many == (many := passed.count()):
            break
        jump = materialize(jump.join(jump.select("key", F.col("a").alias("z"), F.col("z").alias("y")), ["key", "z"]).select("key", "a", F.col("y").alias("z")), "jumps")
    return passed.join(times, ["key", "us"]).select(F.col("key").alias(key), "event_id", "us")


def _closes(width: int, wait: int) -> Column:
    return (F.col("slot") + 1) * width + wait


def assemble(stream: DataFrame, parts: int, width: int, wait: int, late: str = "0 seconds") -> DataFrame:
    """Groups (slot, missing, total, fired) of rows (slot, part, value, id, arrived) that fire when all parts are there, or
    when the clock of arrivals passes their close: then with a mask of the missing parts.

    A slot is `width` long and closes `wait` after its end (microseconds). Of a part that comes more than once the first
    arrival counts (the least id at ties). What arrives at the close or after it is late: see late_rows(). State: a mask and
    a sum for each slot that hasn't closed.
    """

    def step(name: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        mask, total = state.get if state.exists else (0, 0.0)
        full = (1 << parts) - 1
        closes = int(name[0] + 1) * width + wait
        out = []
        if state.hasTimedOut:
            state.remove()
            out = [(name[0], full - mask, total, closes)] if mask < full else []
        else:
            first: dict[int, tuple] = {}  # of each part that is missing, the first arrival of this micro-batch
            for rows in batches:
                for key in zip(rows["us"].tolist(), rows["id"].tolist(), rows["part"].tolist(), rows["value"].tolist(), strict=True):
                    if not mask >> key[2] & 1 and (key[2] not in first or key[:2] < first[key[2]][:2]):
                        first[key[2]] = key
            for at, _, part, value in sorted(first.values()):
                mask, total = mask | 1 << part, total + value
                if mask == full:
                    out.append((name[0], 0, total, at))
            state.update((mask, total))
            state.setTimeoutTimestamp(closes // 1000)
        yield pd.DataFrame(out, columns=["slot", "missing", "total", "fired"])

    in_time = stream.withWatermark("arrived", late).withColumn("us", F.unix_micros("arrived")).where(F.col("us") < _closes(width, wait))
    return in_time.groupBy("slot").applyInPandasWithState(step, "slot bigint, missing int, total double, fired bigint", "mask int, total double", "append", GroupStateTimeout.EventTimeTimeout)


def late_rows(stream: DataFrame, width: int, wait: int) -> DataFrame:
    """The side table of assemble(): rows that arrive when their slot has closed. No state."""
    us = F.unix_micros("arrived")
    return stream.where(us >= _closes(width, wait)).withColumn("late_by", us - _closes(width, wait))


def gulp_windows(stream: DataFrame, gulp: str, gulps: int, late: str, keys: list[str]) -> DataFrame:
    """Slow windows of so many gulps (rows: keys, at, gulp number, value) that have all of them: (start, *keys, mean). They are
    given out when the watermark passes their end; one that lacks a gulp by then is dropped."""
    length = f"{gulps * int(pd.Timedelta(gulp).total_seconds())} seconds"
    held = stream.withWatermark("at", late).groupBy(F.window("at", length), *keys).agg(F.avg("value").alias("mean"), F.size(F.collect_set("gulp")).alias("gulps"))  # at most `gulps` numbers
    return held.where(F.col("gulps") == gulps).select(F.unix_micros("window.start").alias("start"), *keys, "mean")


def forfeit(stream: DataFrame, tick: str, late: str, ranked: list[str]) -> DataFrame:
    """One search a tick (rows: kind, at): the kind that stands first in `ranked` goes, the other requests are given up. The
    choice is made when the watermark passes the tick's end."""
    order = F.array(*[F.lit(k) for k in ranked])
    rank = F.array_position(order, F.col("kind"))
    best = stream.withWatermark("at", late).where(rank > 0).groupBy(F.window("at", tick)).agg(F.min(rank).alias("rank"), F.count("*").alias("asked"))
    return best.select(F.unix_micros("window.start").alias("start"), F.element_at(order, F.col("rank").cast("int")).alias("kind"), (F.col("asked") - 1).alias("given_up"))


def acknowledged(stream: DataFrame, tick: str, late: str, nodes: int) -> DataFrame:
    """Messages (rows: key, node, at) that all nodes acknowledged within their tick, and when the last one did; given out at
    its end. The set kept for a message has `nodes` members at most."""
    held = stream.withWatermark("at", late).groupBy(F.window("at", tick), "key").agg(F.size(F.collect_set("node")).alias("n"), F.max(F.unix_micros("at")).alias("done"))
    return held.where(F.col("n") == nodes).select("key", "done")


def running_noise(rows: DataFrame, slices: list[Column], keys: list[str]) -> DataFrame:
    """(keys, n, noise) state after all slices of rows (keys, x) have landed: each micro-batch merges its means into the
    version before and writes the next. A version is named by its batch, so a batch that is run again replaces its own."""
    spark = rows.sparkSession
    base = new_folder(spark, "streams")
    state = rows.select(*keys, F.lit(0).cast("bigint").alias("n"), F.lit(0.0).alias("noise")).schema
    last = -1

    def put(batch: DataFrame, number: int) -> None:
        nonlocal last
        before = spark.read.schema(state).parquet(f"{base}/version={number - 1}") if number else spark.createDataFrame([], state)
        noise.merge(before, batch, keys).write.mode("overwrite").parquet(f"{base}/version={number}")
        last = number

    for landed in slices:
        rows.where(landed).write.mode("append").parquet(f"{base}/in")
        stream = spark.readStream.schema(rows.schema).parquet(f"{base}/in")
        stream.writeStream.option("checkpointLocation", f"{base}/state").foreachBatch(put).trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(state).parquet(f"{base}/version={last}") if last >= 0 else spark.createDataFrame([], state)


def batch_metrics(rows: DataFrame, slices: list[Column], metrics: list[Column]) -> DataFrame:
    """(batch, *metrics) of each micro-batch of rows that land slice by slice, as they are observed while it is written: aggregates
    without a pass of their own. A batch that is run again replaces its row."""
    spark = rows.sparkSession
    base = new_folder(spark, "streams")
    shape = rows.agg(*metrics).schema

    def put(batch: DataFrame, number: int) -> None:
        seen = Observation()
        batch.observe(seen, *metrics).write.mode("overwrite").parquet(f"{base}/out/batch={number}")
        spark.createDataFrame([tuple(seen.get[c] for c in shape.names)], shape).coalesce(1).write.mode("overwrite").parquet(f"{base}/metrics/batch={number}")

    for landed in slices:
        rows.where(landed).write.mode("append").parquet(f"{base}/in")
        stream = spark.readStream.schema(rows.schema).parquet(f"{base}/in")
        stream.writeStream.option("checkpointLocation", f"{base}/state").foreachBatch(put).trigger(availableNow=True).start().awaitTermination()
    known = T.StructType([*shape.fields, T.StructField("batch", T.IntegerType())])
    try:
        return spark.read.schema(known).parquet(f"{base}/metrics")
    except AnalysisException:  # no batch came
        return spark.createDataFrame([], known)


def publish(stream: DataFrame, key: str, send: Callable[[dict], int], folder: str, tries: int = 3):
    """A started query that sends each row once and keeps a ledger (key, status, tries) in the folder. send() gives a status
    of bits, 0 when all is well; what fails is tried again, `tries` times in all. Keys in the ledger of earlier batches aren't
    sent again, and a batch that is run again replaces its own part of it."""
    spark = stream.sparkSession
    kind = stream.schema[key].dataType.simpleString()
    ledger = f"{key} {kind}, status int, tries int"

    def sent(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            out = []
            for record in rows.to_dict("records"):
                for turn in range(1, tries + 1):
                    if not (status := send(record)):
                        break
                out.append((record[key], status, turn))
            yield pd.DataFrame(out, columns=[key, "status", "tries"])

    def put(batch: DataFrame, number: int) -> None:
        new = batch.dropDuplicates([key])
        if number:
            known = spark.read.schema(f"{ledger}, batch int").option("basePath", f"{folder}/ledger").parquet(f"{folder}/ledger").where(F.col("batch") < number)
            new = new.join(known.select(key), key, "left_anti")
        new.mapInPandas(sent, ledger).write.mode("overwrite").parquet(f"{folder}/ledger/batch={number}")

    return stream.writeStream.option("checkpointLocation", f"{folder}/state").foreachBatch(put).trigger(availableNow=True).start()


def dumps(triggers: DataFrame, samples: DataFrame, seconds: int, late: str) -> DataFrame:
    """Samples (sample_id, s_at) of up to `seconds` before a trigger (trigger_id, t_at): an interval join of two streams.

    A trigger has one bucket of that length; a sample is dealt to its own and to the next.
    """
    bucket = lambda c: F.floor(F.unix_micros(c) / (seconds * 1_000_000))
    a = triggers.withWatermark("t_at", late).withColumn("bucket", bucket("t_at"))
    b = samples.withWatermark("s_at", late).withColumn("bucket", F.explode(F.array(bucket("s_at"), bucket("s_at") + 1)))
    near = F.expr(f"s_at <= t_at AND s_at >= t_at - INTERVAL {seconds} SECONDS")
    return a.join(b, (a["bucket"] == b["bucket"]) & near).select("trigger_id", "sample_id")
