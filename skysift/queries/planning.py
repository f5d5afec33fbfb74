"""Queries on plans, records and the remaining filters and variants."""

from __future__ import annotations

from pyspark.sql import functions as F

from skysift import sinks, trials
from skysift.operators import planning, search
from skysift.queries.joining import _cands
from skysift.queries.registry import CUBE, EV, HOURS, cube, events, query, r6, r9, table
from skysift.stored import materialize


@query("SELECT l_orderkey * 10 + l_linenumber AS cand, round(CAST(-16 AS DOUBLE) + (l_partkey % 64) * CAST(32 AS DOUBLE) / 63, 6) + 0 AS ra, CAST(pow(2, l_linenumber % 3) AS INTEGER) AS width, CAST(l_suppkey % 64 + 10 AS INTEGER) AS dec_idx FROM lineitem WHERE l_quantity >= 45")
def axis_lookup(spark, sf_dir):
    """Index to axis value, and an index with an offset."""
    axis = F.transform(F.sequence(F.lit(0), F.lit(63)), lambda k: F.lit(-16.0) + k * 32.0 / 63)
    widths = F.array(*[F.lit(w) for w in trials.WIDTHS])
    return _cands(spark, sf_dir).select("cand", r6(F.element_at(axis, F.col("ra_idx") + 1)).alias("ra"), F.element_at(widths, F.col("dm_idx") + 1).alias("width"), (F.col("dec_idx") + 10).alias("dec_idx"))


@query(f"WITH {EV} SELECT chan, count(*) AS n, round(avg(value), 6) + 0 AS noise FROM ev WHERE t NOT IN (SELECT t FROM ev WHERE chan = 2 AND value > 60) GROUP BY chan")
def injection_exclusion(spark, sf_dir):
    """Noise without the times of injections."""
    e = events(spark, sf_dir)
    injected = e.where("chan = 2 and value > 60").select("t").distinct()
    return e.join(injected, "t", "left_anti").groupBy("chan").agg(F.count("*").alias("n"), r6(F.avg("value")).alias("noise"))


@query(f"WITH {EV} SELECT chan, count(*) AS n FROM ev WHERE (SELECT max(t) FROM ev) - t < 13 GROUP BY chan")
def freshness_gate(spark, sf_dir):
    e = events(spark, sf_dir)
    now = e.agg(F.max("t").alias("now"))
    return e.join(F.broadcast(now), F.col("now") - F.col("t") < 13).groupBy("chan").agg(F.count("*").alias("n"))


@query("SELECT s_suppkey, round(abs(s_acctbal) * sqrt(CAST(1 + s_suppkey % 9 AS DOUBLE)) / 100, 6) + 0 AS expected FROM supplier WHERE abs(s_acctbal) * sqrt(CAST(1 + s_suppkey % 9 AS DOUBLE)) / 100 >= 20")
def expected_snr(spark, sf_dir):
    """Sources whose flux and pulses promise enough S/N."""
    promised = F.abs("s_acctbal") * F.sqrt((1 + F.col("s_suppkey") % 9).cast("double")) / 100
    return table(spark, sf_dir, "supplier").withColumn("e", promised).where("e >= 20").select("s_suppkey", r6("e").alias("expected"))


@query("SELECT o_orderpriority, count(*) AS n FROM orders WHERE o_orderkey % 13 <> 0 AND NOT (o_orderkey % 17 = 0 AND o_orderstatus = 'F') GROUP BY 1")
def exclusion_table(spark, sf_dir):
    """Rows that no exclusion names, by (status, key) or for every status."""
    o = table(spark, sf_dir, "orders")
    every = o.where("o_orderkey % 13 = 0").select(F.lit("ALL").alias("o_orderstatus"), "o_orderkey")
    some = o.where("o_orderkey % 17 = 0").select(F.lit("F").alias("o_orderstatus"), "o_orderkey")
    return sinks.exclude(o, every.unionByName(some), "o_orderstatus", "o_orderkey").groupBy("o_orderpriority").agg(F.count("*").alias("n"))


@query("SELECT count(*) AS n, min(o_orderkey) AS first FROM orders WHERE o_orderdate >= TIMESTAMP '1996-06-01' OR o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_quantity >= 49)")
def retention(spark, sf_dir):
    """What a clean-up leaves: recent files and those on the keep list."""
    keep = table(spark, sf_dir, "lineitem").where("l_quantity >= 49").select(F.col("l_orderkey").alias("o_orderkey"))
    left = sinks.retained(table(spark, sf_dir, "orders"), "o_orderdate", F.lit("1996-06-01").cast("timestamp_ntz"), keep, "o_orderkey")
    return left.agg(F.count("*").alias("n"), F.min("o_orderkey").alias("first"))


@query("SELECT c_custkey, CASE WHEN c_custkey % 10 = 0 THEN CAST(0 AS DOUBLE) ELSE c_acctbal END AS bal FROM customer")
def calibration_upsert(spark, sf_dir):
    """A keyed merge: new rows replace those of their key."""
    old = table(spark, sf_dir, "customer").select("c_custkey", F.col("c_acctbal").alias("bal"))
    return sinks.upsert(old, old.where("c_custkey % 10 = 0").withColumn("bal", F.lit(0.0)), ["c_custkey"])


@query(f"WITH {CUBE} SELECT pix, CAST(t - s.shift AS INTEGER) AS t, round(sum(value) / 5, 9) + 0 AS value FROM cube JOIN (SELECT CAST(c AS INTEGER) AS chan, CAST(floor(CAST(-1.5 AS DOUBLE) * (4 - c)) AS INTEGER) AS shift FROM range(5) r(c)) s USING (chan) WHERE t - s.shift BETWEEN 0 AND 719 GROUP BY 1, 2")
def dedisperse_integer(spark, sf_dir):
    """Whole-sample shifts, zeros beyond the edges, divided by the channels."""
    rows = [trials.Delay(0, c, int((-1.5 * (4 - c)) // 1), 1.0) for c in range(5)]
    out = search.dedisperse(cube(spark, sf_dir), trials.delay_table(spark, rows), ["pix"], HOURS)
    return out.select("pix", F.col("t").cast("int").alias("t"), r9(F.col("value") / 5).alias("value"))


@query(f"WITH {EV}, m AS (SELECT pix, chan, t, avg(value) AS v FROM ev GROUP BY ALL), s AS (SELECT pix, t, sum(v) AS v FROM m GROUP BY ALL), n AS (SELECT median(x) AS noise FROM (SELECT pix, stddev_pop(v) AS x FROM s GROUP BY pix)) SELECT pix, round(max(v) / any_value(noise), 6) + 0 AS snr FROM s, n GROUP BY pix")
def completeness_search(spark, sf_dir):
    """The variant for completeness: no medians are taken off, before the sum or from the peak."""
    raw = events(spark, sf_dir).groupBy("pix", "chan", "t").agg(F.avg("value").alias("value")).groupBy("pix", "t").agg(F.sum("value").alias("value"))
    noise = search.nested_noise(raw.withColumn("one", F.lit(0)), "one", ["pix"])
    return raw.groupBy("pix").agg(F.max("value").alias("v")).join(F.broadcast(noise)).select("pix", r6(F.col("v") / F.col("noise")).alias("snr"))


@query(f"WITH {EV}, f AS (SELECT pix, min(t) AS first FROM ev GROUP BY pix), w AS (SELECT pix, CAST(floor((t - first) / CAST(5 AS DOUBLE)) AS INTEGER) AS win, t, value FROM ev JOIN f USING (pix)) SELECT pix, win AS \"window\", round(avg(value), 6) + 0 AS value FROM w GROUP BY pix, win HAVING count(DISTINCT t) = 5")
def anchored_windows(spark, sf_dir):
    out = planning.anchored_windows(events(spark, sf_dir), ["pix"], "t", 5, "value")
    return out.select("pix", "window", r6("value").alias("value"))


@query("WITH r AS (SELECT CAST(floor(epoch_us(ts) / CAST(60000000 AS DOUBLE)) AS BIGINT) AS tick, CASE event_type WHEN 'purchase' THEN 1 WHEN 'signup' THEN 2 WHEN 'view' THEN 3 END AS rank FROM events WHERE event_type IN ('purchase', 'signup', 'view')) SELECT tick, CASE min(rank) WHEN 1 THEN 'purchase' WHEN 2 THEN 'signup' ELSE 'view' END AS event_type, count(*) - 1 AS given_up FROM r GROUP BY tick")
def forfeit_priority(spark, sf_dir):
    from skysift.queries.registry import micros

    asked = table(spark, sf_dir, "events").select(F.floor((micros("ts") + 1704067200000000) / 60_000_000).cast("bigint").alias("tick"), "event_type")
    return planning.forfeit(asked, "tick", "event_type", ["purchase", "signup", "view"])


@query(f"WITH {EV} SELECT t, max(event_id) AS at FROM ev GROUP BY t HAVING count(DISTINCT pix) = 8")
def handshake(spark, sf_dir):
    """Times that all eight positions have acknowledged."""
    return planning.acknowledged(events(spark, sf_dir), "t", "pix", 8, "event_id")


@query("""WITH p AS (SELECT CAST(s_suppkey * 7 + s_suppkey % 3 AS DOUBLE) AS t0, s_acctbal AS v0 FROM supplier), q AS (SELECT t0, v0, lead(t0) OVER (ORDER BY t0) AS t1, lead(v0) OVER (ORDER BY t0) AS v1 FROM p), g AS (SELECT CAST(unnest(range((SELECT CAST(max(t0) / 5 AS BIGINT) + 1 FROM p))) * 5 AS DOUBLE) AS t)
SELECT t, round(v0 + (v1 - v0) * (t - t0) / (t1 - t0), 6) + 0 AS v FROM q JOIN g ON t >= t0 AND t < t1""")
def lock_to_grid(spark, sf_dir):
    plan = table(spark, sf_dir, "supplier").select((F.col("s_suppkey") * 7 + F.col("s_suppkey") % 3).cast("double").alias("t"), F.col("s_acctbal").alias("v"))
    return planning.lock_to_grid(plan, "t", "v", 5.0).select("t", r6("v").alias("v"))


@query("""SELECT gl, gb, round((CAST(192.85948 AS DOUBLE) + degrees(atan2(cos(radians(gb)) * sin(radians(CAST(122.93192 AS DOUBLE) - gl)), cos(radians(CAST(27.12825 AS DOUBLE))) * sin(radians(gb)) - sin(radians(CAST(27.12825 AS DOUBLE))) * cos(radians(gb)) * cos(radians(CAST(122.93192 AS DOUBLE) - gl)))) + 360) % 360, 6) + 0 AS ra,
round(degrees(asin(sin(radians(CAST(27.12825 AS DOUBLE))) * sin(radians(gb)) + cos(radians(CAST(27.12825 AS DOUBLE))) * cos(radians(gb)) * cos(radians(CAST(122.93192 AS DOUBLE) - gl)))), 6) + 0 AS dec
FROM (SELECT CAST(k * 10 AS DOUBLE) AS gl FROM range(36) r(k)), (VALUES (CAST(-5 AS DOUBLE)), (0), (5)) b(gb)""")
def galactic_grid(spark, sf_dir):
    grid = planning.plane_grid(spark, 10.0, [-5.0, 0.0, 5.0])
    return grid.select("gl", "gb", r6("ra").alias("ra"), r6("dec").alias("dec"))


@query()
def transit_times(spark, sf_dir):
    """When each supplier's proxy position is highest: hours, minutes, seconds."""
    s = table(spark, sf_dir, "supplier").select("s_suppkey", ((F.col("s_suppkey") * 71) % 360).cast("double").alias("ra"), ((F.col("s_suppkey") * 29) % 120 - 40).cast("double").alias("dec"))
    return planning.transits(s, "s_suppkey", 60310.0).select("s_suppkey", r6("mjd").alias("mjd"), r6("alt").alias("alt"))


@query("SELECT trigname, '{\"mjds\":' || mjds || ',\"snr\":' || snr || '}' AS record FROM (SELECT 't' || o_orderkey AS trigname, CAST(60310 + o_orderkey % 7 AS INTEGER) AS mjds, CAST(o_orderkey % 50 AS INTEGER) AS snr FROM orders)")
def trigger_records(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    mjd, snr = (60310 + F.col("o_orderkey") % 7).cast("int"), (F.col("o_orderkey") % 50).cast("int")
    return o.select(F.concat(F.lit("t"), F.col("o_orderkey")).alias("trigname"), F.to_json(F.struct(mjd.alias("mjds"), snr.alias("snr"))).alias("record"))


@query("SELECT vec_id, round(list_sum(list_transform(embedding[1:4], lambda x: CAST(x AS DOUBLE) * x)), 6) + 0 AS power, CAST(len(embedding) AS INTEGER) AS n, round(CAST(embedding[64] AS DOUBLE), 6) + 0 AS last FROM embeddings")
def array_steps(spark, sf_dir):
    """Slices, transforms and sums of arrays."""
    x = F.col("embedding")
    power = F.aggregate(F.slice(x, 1, 4), F.lit(0.0), lambda a, v: a + v.cast("double") * v.cast("double"))
    return table(spark, sf_dir, "embeddings").select("vec_id", r6(power).alias("power"), F.size(x).alias("n"), r6(F.element_at(x, 64).cast("double")).alias("last"))


@query("SELECT vec_id, CAST(list_position(embedding, list_max(embedding)) - 1 AS INTEGER) AS peak FROM embeddings")
def cutout_peak(spark, sf_dir):
    """The brightest pixel of each cut-out."""
    x = F.col("embedding")
    return table(spark, sf_dir, "embeddings").select("vec_id", (F.array_position(x, F.array_max(x)) - 1).cast("int").alias("peak"))


@query()
def injection_draws(spark, sf_dir):
    from skysift.plans import simulate

    return simulate.injections(spark, 500)


@query()
def cube_search(spark, sf_dir):
    """The instrument's own search on a simulated cube with a burst."""
    from skysift.plans import search as plans
    from skysift.plans import simulate

    noisy = simulate.image_cube(spark, 8, trials.SAMPLES, trials.CHANNELS, 1.0)
    found = plans.candidates(plans.search_gulp(simulate.with_burst(noisy, (3, 4), 21, 2, 213.722, 20.0)), 6.0, 200)
    return found.select("dec_idx", "ra_idx", "wid_idx", "dm_idx", F.col("toa").cast("int").alias("toa"), r6("snr").alias("snr"))


@query("""WITH RECURSIVE v AS (SELECT o_orderkey AS id, CAST((o_orderkey * 7919) % 2592000 AS DOUBLE) AS start, CAST(600 + (o_custkey % 5) * 300 AS DOUBLE) AS len, CAST((o_custkey % 12) * 10 + 30 AS DOUBLE) AS elev FROM orders),
known AS (SELECT elev AS strip, start, min(id) AS first FROM v GROUP BY ALL),
asks AS (SELECT id, s.elev AS strip, start + len + abs(s.elev - v.elev) / CAST(0.05 AS DOUBLE) AS ready FROM v, (SELECT DISTINCT elev FROM v) s),
line AS (SELECT id, strip, ready AS t, 0 AS o, CAST(NULL AS DOUBLE) AS s FROM asks UNION ALL SELECT CAST(NULL AS BIGINT), strip, start, 1, start FROM known),
found AS (SELECT id, strip, min(s) OVER (PARTITION BY strip ORDER BY t DESC, o DESC ROWS UNBOUNDED PRECEDING) AS start FROM line),
nxt AS (SELECT f.id, k.first AS next_id FROM found f JOIN known k USING (strip, start) WHERE f.id IS NOT NULL QUALIFY row_number() OVER (PARTITION BY f.id ORDER BY start, k.first) = 1),
c AS (SELECT id AS first, CAST(0 AS INTEGER) AS step, id FROM v UNION ALL SELECT c.first, c.step + 1, n.next_id FROM c JOIN nxt n ON c.id = n.id WHERE c.step < 5)
SELECT first, step, id FROM c""")
def survey_chain(spark, sf_dir):
    """From each visit the next five that can be made, each as soon as the one before is over and the dish has slewed."""
    visits = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id"), ((F.col("o_orderkey") * 7919) % 2592000).cast("double").alias("start"), (600 + (F.col("o_custkey") % 5) * 300).cast("double").alias("length"), ((F.col("o_custkey") % 12) * 10 + 30).cast("double").alias("elevation")
    )
    visits = materialize(visits, "visits")
    return planning.chains(visits.select("id"), planning.next_visits(visits, 0.05), 6)


_TRIALS = "delays(dm_idx, chan, shift, weight) AS (VALUES " + ", ".join(f"(CAST({r.dm_idx} AS INTEGER), CAST({r.chan} AS INTEGER), CAST({r.shift} AS INTEGER), CAST({r.weight!r} AS DOUBLE))" for r in trials.delay_rows(trials.dispersion_trials(), trials.frequencies()) if r.weight) + ")"


@query(f"""WITH {EV}, {_TRIALS}, c AS (SELECT CAST(user_id % 8 AS INTEGER) AS dec_idx, CAST(user_id // 8 % 8 AS INTEGER) AS ra_idx, CAST((t * 5) // 144 AS INTEGER) AS t, CAST(event_id % 16 AS INTEGER) AS chan, avg(value) AS flux FROM ev WHERE t BETWEEN 0 AND 719 GROUP BY ALL),
flat AS (SELECT dec_idx, ra_idx, t, chan, flux - median(flux) OVER (PARTITION BY dec_idx, ra_idx, chan) AS value FROM c),
shifted AS (SELECT dec_idx, ra_idx, dm_idx, ((t - shift) % 25 + 25) % 25 AS t, sum(weight * value) AS value FROM flat JOIN delays USING (chan) GROUP BY ALL),
boxes AS (SELECT dec_idx, ra_idx, dm_idx, wid_idx, ((t - 12 + k.k) % 25 + 25) % 25 AS t, sum(value) AS value FROM shifted, (VALUES {", ".join(f"(CAST({n} AS INTEGER), {w})" for n, w in enumerate(trials.WIDTHS))}) w(wid_idx, width), range(16) k(k) WHERE k.k < width GROUP BY 1, 2, 3, 4, 5),
noise AS (SELECT wid_idx, median(s) AS noise FROM (SELECT wid_idx, ra_idx, median(s) AS s FROM (SELECT wid_idx, dec_idx, ra_idx, stddev_pop(value) AS s FROM boxes WHERE dm_idx = 0 GROUP BY ALL) GROUP BY ALL) GROUP BY wid_idx)
SELECT dec_idx, ra_idx, wid_idx, dm_idx, round(abs(max(value) - median(value)) / nullif(any_value(noise), 0), 6) + 0 AS snr FROM boxes JOIN noise USING (wid_idx) GROUP BY ALL""")
def event_cube_search(spark, sf_dir):
    """The instrument's own search, with its trials and widths, over a cube of 8 x 8 places, 25 samples and 16 channels made of all events; cells
    without one are missing samples."""
    from skysift.plans import search as plans

    e = events(spark, sf_dir).where(F.col("t").between(0, HOURS - 1))
    place = [(F.col("user_id") % 8).cast("int").alias("dec_idx"), (F.floor(F.col("user_id") / 8) % 8).cast("int").alias("ra_idx"), F.floor(F.col("t") * 5 / 144).cast("int").alias("t"), (F.col("event_id") % 16).cast("int").alias("chan")]
    cells = e.groupBy(*place).agg(F.avg("value").alias("flux"))
    return plans.search_gulp(cells).select("dec_idx", "ra_idx", "wid_idx", "dm_idx", r6("snr").alias("snr"))
