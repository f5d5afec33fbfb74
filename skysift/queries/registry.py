"""Registered queries with their SQL twins, and the views of the driver tables that they share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

#: Hours from the events' first day that the series cover.
HOURS = 720
KINDS = ("click", "error", "purchase", "signup", "view")


def query(sql: str | None = None):
    """Register a function under its own name, with the SQL that gives the same rows where there is one."""

    def put(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            SQL[f.__name__] = sql
        return f

    return put


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def r6(x: Column | str) -> Column:
    """Rounded to 6 places, without a negative zero."""
    x = F.col(x) if isinstance(x, str) else x
    return F.round(x.cast("double"), 6) + F.lit(0.0)


def r9(x: Column | str) -> Column:
    """Rounded to 9 places: for values that end in a 5 at the seventh."""
    x = F.col(x) if isinstance(x, str) else x
    return F.round(x.cast("double"), 9) + F.lit(0.0)


def micros(ts: Column | str) -> Column:
    """Microseconds from 2024-01-01 of a timestamp without zone."""
    return F.timestamp_diff("MICROSECOND", F.lit("2024-01-01 00:00:00").cast("timestamp_ntz"), F.col(ts) if isinstance(ts, str) else ts)


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """pix, chan, t (hours), day, value of each event."""
    kind = F.coalesce(*[F.when(F.col("event_type") == k, F.lit(n)) for n, k in enumerate(KINDS[:-1])], F.lit(len(KINDS) - 1))
    hour = F.floor(micros("ts") / 3_600_000_000).cast("int")
    return table(spark, sf_dir, "events").select((F.col("user_id") % 8).cast("int").alias("pix"), kind.cast("int").alias("chan"), hour.alias("t"), F.floor(hour / 24).cast("int").alias("day"), "value", "event_id", "user_id", "ts")


EV = """ev AS (
  SELECT CAST(user_id % 8 AS INTEGER) AS pix,
         CAST(CASE event_type WHEN 'click' THEN 0 WHEN 'error' THEN 1 WHEN 'purchase' THEN 2 WHEN 'signup' THEN 3 ELSE 4 END AS INTEGER) AS chan,
         CAST(floor((epoch_us(ts) - 1704067200000000) / CAST(3600000000 AS DOUBLE)) AS INTEGER) AS t,
         CAST(floor(floor((epoch_us(ts) - 1704067200000000) / CAST(3600000000 AS DOUBLE)) / 24) AS INTEGER) AS day,
         value, event_id, user_id, ts
  FROM events
)"""


def cube(spark: SparkSession, sf_dir: str) -> DataFrame:
    """pix, chan, t, value: hourly means less their median over the series, 0 where an hour has no event."""
    # said here, and so on both sides of the join: then one exchange of the means serves both
    means = events(spark, sf_dir).where("pix is not null and chan is not null and t is not null").groupBy("pix", "chan", "t").agg(F.avg("value").alias("v"))
    middle = means.groupBy("pix", "chan").agg(F.median("v").alias("m"))
    full = middle.withColumn("t", F.explode(F.sequence(F.lit(0), F.lit(HOURS - 1))))
    return full.join(means, ["pix", "chan", "t"], "left").select("pix", "chan", "t", F.coalesce(F.col("v") - F.col("m"), F.lit(0.0)).alias("value"))


CUBE = EV + """, means AS (SELECT pix, chan, t, avg(value) AS v FROM ev GROUP BY ALL),
middle AS (SELECT pix, chan, median(v) AS m FROM means GROUP BY ALL),
cube AS (
  SELECT m.pix, m.chan, CAST(h.t AS INTEGER) AS t, coalesce(v - m, CAST(0 AS DOUBLE)) AS value
  FROM middle m CROSS JOIN range(720) h(t) LEFT JOIN means USING (pix, chan, t)
)"""
SERIES = CUBE + ", series AS (SELECT pix, t, sum(value) AS value FROM cube GROUP BY ALL)"


def series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """pix, t, value: the channels' sum."""
    return cube(spark, sf_dir).groupBy("pix", "t").agg(F.sum("value").alias("value"))
