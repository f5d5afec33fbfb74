"""Streaming queries: the events replayed to the end."""

from __future__ import annotations

from pyspark.sql import functions as F

from skysift import trials
from skysift.queries import searching  # noqa: F401  (its SQL is used below)
from skysift.queries.registry import CUBE, HOURS, SQL, cube, micros, query, r6, table
from skysift.sources import pages
from skysift.stored import materialize
from skysift.streaming import carry, runs, windows


@query("SELECT CAST(floor(epoch_us(ts) / CAST(21600000000 AS DOUBLE)) * 21600000000 AS BIGINT) AS start, event_type, count(*) AS n, round(sum(value), 6) + 0 AS total FROM events GROUP BY 1, 2")
def stream_tumble(spark, sf_dir):
    """Windows of six hours in update mode: each landing hands on the windows it touched, and those that the watermark has passed leave the state."""
    build = lambda s: runs.tumbling(s.withColumnRenamed("kind", "event_type"), "6 hours", "0 seconds", ["event_type"])
    out = runs.feed(_moments(spark, sf_dir), _in_time(2), build, "update", ["start", "event_type"])
    return out.select("start", "event_type", "n", r6("total").alias("total"))


@query("SELECT CAST((floor(epoch_us(ts) / CAST(3600000000 AS DOUBLE)) - k.k) * 3600000000 AS BIGINT) AS start, count(*) AS n FROM events, range(2) k(k) GROUP BY 1")
def stream_slide(spark, sf_dir):
    return runs.feed(_moments(spark, sf_dir), _in_time(2), lambda s: runs.tumbling(s, "2 hours", "0 seconds", [], "1 hour"), "update", ["start"]).select("start", "n")


@query("""WITH g AS (SELECT user_id, epoch_us(ts) AS us, CASE WHEN epoch_us(ts) - lag(epoch_us(ts)) OVER (PARTITION BY user_id ORDER BY ts) < 14400000000 THEN 0 ELSE 1 END AS fresh FROM events),
s AS (SELECT user_id, us, sum(fresh) OVER (PARTITION BY user_id ORDER BY us ROWS UNBOUNDED PRECEDING) AS k FROM g)
SELECT min(us) AS start, user_id, count(*) AS n FROM s GROUP BY user_id, k HAVING (max(us) + 14400000000) // 1000 <= (SELECT max(epoch_us(ts)) // 1000 FROM events)""")
def stream_session(spark, sf_dir):
    """Sessions that have ended: one is given out, and leaves the state, when the watermark passes the gap behind its last row."""
    rows = _moments(spark, sf_dir, "user_id")
    return runs.feed(rows, _in_time(2), lambda s: runs.sessions(s, "4 hours", "0 seconds", ["user_id"]))


@query("""WITH RECURSIVE t AS (SELECT event_type, event_id, epoch_us(ts) AS us, row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) AS k FROM events WHERE value > 60),
r AS (SELECT event_type, k, us AS last, event_id, true AS passed FROM t WHERE k = 1
UNION ALL SELECT t.event_type, t.k, CASE WHEN t.us - r.last >= 7200000000 THEN t.us ELSE r.last END, t.event_id, t.us - r.last >= 7200000000 FROM r JOIN t ON t.event_type = r.event_type AND t.k = r.k + 1)
SELECT event_type, event_id, last AS us FROM r WHERE passed""")
def stream_throttle(spark, sf_dir):
    """Triggers at least two hours apart for each kind: the stream lands as it comes, then the whole is throttled."""
    strong = runs.event_stream(spark, sf_dir).where("value > 60").select("event_type", "event_id", "at")
    return runs.throttle(runs.replay(strong, "append"), "event_type", 7200.0)


_HOUR, _WAIT = 3_600_000_000, 6 * 3_600_000_000
_ARRIVALS = """e AS (SELECT event_id, CAST(floor(epoch_us(ts) / CAST(3600000000 AS DOUBLE)) AS BIGINT) AS slot, value,
CASE event_type WHEN 'error' THEN 1 WHEN 'purchase' THEN 2 WHEN 'signup' THEN 3 WHEN 'view' THEN 4 ELSE 0 END AS part,
epoch_us(ts) + (event_id % 5) * 420000000 + CASE WHEN event_id % 40 = 0 THEN 108000000000 ELSE 0 END AS us FROM events)"""


def _arrivals(spark, sf_dir):
    """Events as parts of their hour. They arrive some minutes after they happen, and every fortieth thirty hours after."""
    kinds = ["click", "error", "purchase", "signup", "view"]
    part = F.coalesce(*[F.when(F.col("event_type") == k, F.lit(n)) for n, k in enumerate(kinds)], F.lit(0)).cast("int")
    us = micros("ts") + 1_704_067_200_000_000
    delay = (F.col("event_id") % 5) * 420_000_000 + F.when(F.col("event_id") % 40 == 0, 108_000_000_000).otherwise(0)
    return table(spark, sf_dir, "events").select(F.floor(us / _HOUR).cast("bigint").alias("slot"), part.alias("part"), "value", F.col("event_id").alias("id"), F.timestamp_micros(us + delay).alias("arrived"))


def _by_week(count: int = 5):
    """Conditions that part arrivals into weeks, in order; the last one has all that is left."""
    week = F.floor((F.unix_micros("arrived") - 1_704_067_200_000_000) / (7 * 24 * _HOUR))
    return [*[F.greatest(week, F.lit(0)) == k for k in range(count - 1)], week >= count - 1]


@query(f"""WITH {_ARRIVALS}, firsts AS (SELECT slot, part, arg_min(value, us::HUGEINT * 1000000000 + event_id) AS v, min(us) AS us FROM e WHERE us < (slot + 1) * 3600000000 + 21600000000 GROUP BY slot, part),
g AS (SELECT slot, count(*) AS n, sum(v) AS total, max(us) AS done, sum(1 << part) AS mask, (slot + 1) * 3600000000 + 21600000000 AS closes FROM firsts GROUP BY slot)
SELECT slot, CAST(CASE WHEN n = 5 THEN 0 ELSE 31 - mask END AS INTEGER) AS missing, round(total, 6) + 0 AS total, CASE WHEN n = 5 THEN done ELSE closes END AS fired FROM g
WHERE n = 5 OR closes // 1000 < (SELECT max(us) // 1000 FROM e)""")
def stream_assemble_timeout(spark, sf_dir):
    """Hours assembled from their five kinds, or given up six hours after their end with a mask of what is missing."""
    out = runs.feed(_arrivals(spark, sf_dir), _by_week(), lambda s: runs.assemble(s, 5, _HOUR, _WAIT))
    return out.select("slot", "missing", r6("total").alias("total"), "fired")


@query(f"WITH {_ARRIVALS} SELECT slot, CAST(part AS INTEGER) AS part, event_id AS id, us - ((slot + 1) * 3600000000 + 21600000000) AS late_by FROM e WHERE us >= (slot + 1) * 3600000000 + 21600000000")
def stream_late_rows(spark, sf_dir):
    """The rows that came after their hour had closed."""
    out = runs.feed(_arrivals(spark, sf_dir), _by_week(), lambda s: runs.late_rows(s, _HOUR, _WAIT))
    return out.select("slot", "part", "id", "late_by")


def _moments(spark, sf_dir, *more):
    us = micros("ts") + 1_704_067_200_000_000
    return table(spark, sf_dir, "events").select(*more, F.col("event_type").alias("kind"), "event_id", "value", F.floor(us / _HOUR).cast("bigint").alias("gulp"), F.timestamp_micros(us).alias("at"))


def _in_time(count: int = 4):
    """Conditions that part moments into spans of nine days, in order."""
    span = F.floor((F.unix_micros("at") - 1_704_067_200_000_000) / (9 * 24 * _HOUR))
    return [*[F.greatest(span, F.lit(0)) == k for k in range(count - 1)], span >= count - 1]


@query("""WITH w AS (SELECT CAST(floor(epoch_us(ts) / CAST(18000000000 AS DOUBLE)) AS BIGINT) * 18000000000 AS start, avg(value) AS mean, count(DISTINCT floor(epoch_us(ts) / CAST(3600000000 AS DOUBLE))) AS gulps FROM events GROUP BY 1)
SELECT start, round(mean, 6) + 0 AS mean FROM w WHERE gulps = 5 AND (start + 18000000000) // 1000 <= (SELECT max(epoch_us(ts)) // 1000 FROM events)""")
def stream_slow_windows(spark, sf_dir):
    """Means over five gulps of an hour, where all five came."""
    out = runs.feed(_moments(spark, sf_dir), _in_time(), lambda s: runs.gulp_windows(s, "1 hour", 5, "0 seconds", []))
    return out.select("start", r6("mean").alias("mean"))


@query("""WITH w AS (SELECT CAST(floor(epoch_us(ts) / CAST(3600000000 AS DOUBLE)) AS BIGINT) * 3600000000 AS start, min(CASE event_type WHEN 'signup' THEN 1 WHEN 'error' THEN 2 WHEN 'click' THEN 3 END) AS r, count(*) AS n FROM events WHERE event_type IN ('signup', 'error', 'click') GROUP BY 1)
SELECT start, CASE r WHEN 1 THEN 'signup' WHEN 2 THEN 'error' ELSE 'click' END AS kind, n - 1 AS given_up FROM w WHERE (start + 3600000000) // 1000 <= (SELECT max(epoch_us(ts)) // 1000 FROM events WHERE event_type IN ('signup', 'error', 'click'))""")
def stream_forfeit(spark, sf_dir):
    """The search of each hour by priority; requests alone move the clock."""
    return runs.feed(_moments(spark, sf_dir), _in_time(), lambda s: runs.forfeit(s, "1 hour", "0 seconds", ["signup", "error", "click"]))


@query("""WITH w AS (SELECT floor(epoch_us(ts) / CAST(86400000000 AS DOUBLE)) AS day, event_id % 10 AS key, count(DISTINCT event_type) AS n, max(epoch_us(ts)) AS done FROM events GROUP BY ALL)
SELECT CAST(day AS BIGINT) * 10 + key AS key, done FROM w WHERE n = 5 AND CAST(day + 1 AS BIGINT) * 86400000 <= (SELECT max(epoch_us(ts)) // 1000 FROM events)""")
def stream_handshake(spark, sf_dir):
    """Ten messages a day that all five kinds acknowledged."""
    acks = _moments(spark, sf_dir).select((F.floor(F.col("gulp") / 24) * 10 + F.col("event_id") % 10).cast("bigint").alias("key"), F.col("kind").alias("node"), "at")
    return runs.feed(acks, _in_time(), lambda s: runs.acknowledged(s, "1 day", "0 seconds", 5))


@query("SELECT event_type AS kind, count(*) AS n, round(avg(value), 6) + 0 AS noise FROM events GROUP BY 1")
def stream_noise_state(spark, sf_dir):
    """The running mean of each kind, merged batch by batch."""
    out = runs.running_noise(_moments(spark, sf_dir).withColumn("x", F.col("value")), _in_time(), ["kind"])
    return out.select("kind", "n", r6("noise").alias("noise"))


@query("SELECT t.event_id AS trigger_id, s.event_id AS sample_id FROM events t JOIN events s ON s.ts <= t.ts AND s.ts >= t.ts - INTERVAL 10 MINUTE WHERE t.event_type = 'purchase' AND t.value > 60 AND s.event_type = 'view'")
def stream_dump_interval(spark, sf_dir):
    """Views of the ten minutes before a strong purchase."""
    triggers = runs.event_stream(spark, sf_dir).where("event_type = 'purchase' and value > 60").select(F.col("event_id").alias("trigger_id"), F.col("at").alias("t_at"))
    samples = runs.event_stream(spark, sf_dir).where("event_type = 'view'").select(F.col("event_id").alias("sample_id"), F.col("at").alias("s_at"))
    return runs.replay(runs.dumps(triggers, samples, 600, "31 days"), "append")


@query(SQL["dedisperse_linear"])
def stream_dedisperse(spark, sf_dir):
    """The linear de-dispersion of gulps of a day that land six at a time, with the samples that later ones need in state."""
    samples = materialize(cube(spark, sf_dir), "samples")
    delays = trials.linear_delays(spark, 8, 5, -0.75)
    landings = [F.floor(F.col("t") / 144) == k for k in range(HOURS // 144)]
    with carry.keyed_state(spark):
        out = runs.feed(samples, landings, lambda s: carry.dedisperse(s, delays, "pix", 5, 24, 86400.0, "0 seconds"))
    return out.select("pix", "dm_idx", F.col("t").cast("int").alias("t"), r6("value").alias("value"))


@query(f"WITH {CUBE} SELECT CAST(t // 24 AS BIGINT) AS page, pix, chan, t, round(value, 6) + 0 AS value FROM cube")
def stream_page_buffer(spark, sf_dir):
    """A day's samples as one image message: written page by page to a buffer by one stream, and read from it by another."""
    shape = (24, 8, 5)
    place = F.col("t") * 40 + F.col("pix") * 5 + F.col("chan")
    every = spark.range(HOURS * 40).join(cube(spark, sf_dir).select(place.cast("bigint").alias("id"), "value"), "id", "left")
    days = every.groupBy(F.floor(F.col("id") / 960).cast("int").alias("day")).agg(F.array_sort(F.collect_list(F.struct("id", "value"))).alias("v"))  # 960 values, whatever the table
    rows = days.select(
        "day", F.lit(1).alias("node"), (F.lit(60310.0) + F.col("day")).alias("mjd"), F.lit(1.0).alias("uv_diag"), F.lit(0.5).alias("dec"), F.lit(8080).alias("port"),
        F.array(*[F.lit(n) for n in shape]).alias("shape"), F.col("v.value").alias("values"), (F.col("day") == HOURS // 24 - 1).alias("last"),
    )
    buffered = runs.through_pages(materialize(rows, "days"), [F.floor(F.col("day") / 10) == k for k in range(3)], "day", 8 * (pages.MESSAGE + 24 * 40))
    place = pages.images(buffered).where("status = 0").select("mjd", F.posexplode("values").alias("at", "value")).where("value is not null")
    day = (F.col("mjd") - 60310.0).cast("int")
    return place.select(
        day.cast("bigint").alias("page"), (F.floor(F.col("at") / 5) % 8).cast("int").alias("pix"), (F.col("at") % 5).alias("chan"), (day * 24 + F.floor(F.col("at") / 40)).cast("int").alias("t"), r6("value").alias("value")
    )


_GULPS = """g AS (SELECT event_type || '/' || (user_id % 8) AS kind, CAST(floor(epoch_us(ts) / CAST(3600000000 AS DOUBLE)) AS BIGINT) AS id, min(epoch_us(ts)) AS us, avg(value) AS value FROM events GROUP BY ALL)"""


@query(f"""WITH RECURSIVE {_GULPS}, o AS (SELECT *, row_number() OVER (PARTITION BY kind ORDER BY us, id) AS k FROM g),
r AS (SELECT kind, k, us AS anchor, true AS fresh FROM o WHERE k = 1
UNION ALL SELECT o.kind, o.k, CASE WHEN o.us - r.anchor >= 5400000000 THEN o.us ELSE r.anchor END, o.us - r.anchor >= 5400000000 FROM r JOIN o ON o.kind = r.kind AND o.k = r.k + 1),
m AS (SELECT a.kind, a.anchor, (o.us - a.anchor + 1800000000) // 3600000000 AS place, arg_min(o.value, o.k) AS value, min(o.us) AS us FROM r a JOIN o ON o.kind = a.kind AND o.k >= a.k AND o.us < a.anchor + 16200000000 WHERE a.fresh GROUP BY ALL),
w AS (SELECT kind, anchor AS start, CAST(31 - sum(1 << CAST(place AS INTEGER)) AS INTEGER) AS missing, avg(value) AS mean FROM m GROUP BY ALL)
SELECT kind, start, missing, round(mean, 6) + 0 AS mean FROM w WHERE missing = 0 OR (start + 16200000000 + 999) // 1000 <= (SELECT max(us) // 1000 FROM g)""")
def stream_nearest_windows(spark, sf_dir):
    """Five gulps each, a new window every two; a gulp is an hour of a kind and place, at the time of its first event."""
    us = micros("ts") + 1_704_067_200_000_000
    kind = F.concat_ws("/", "event_type", (F.col("user_id") % 8).cast("string"))
    gulps = table(spark, sf_dir, "events").groupBy(kind.alias("kind"), F.floor(us / _HOUR).cast("bigint").alias("id")).agg(F.timestamp_micros(F.min(us)).alias("at"), F.avg("value").alias("value"))
    with carry.keyed_state(spark):
        out = runs.feed(materialize(gulps, "gulps"), _in_time(), lambda s: windows.nearest_windows(s, "kind", 3600.0, 5, 2, "0 seconds"))
    return out.select("kind", "start", "missing", r6("mean").alias("mean"))
