"""Search queries on hourly event series."""

from __future__ import annotations

from pyspark.sql import functions as F

from skysift import trials
from skysift.operators import folding, search
from skysift.queries.registry import CUBE, EV, HOURS, SERIES, cube, events, query, r6, r9, series

WIDTHS = [1, 2, 4, 8, 16]
PERIODS = [5, 10, 15, 30, 45]
_DELAYS = """delays AS (
  SELECT dm_idx, chan, CAST(floor(x) AS INTEGER) AS shift, 1 - (x - floor(x)) AS weight FROM raw
  UNION ALL SELECT dm_idx, chan, CAST(ceil(x) AS INTEGER), x - floor(x) FROM raw
)"""
_RAW = "raw AS (SELECT CAST(d AS INTEGER) AS dm_idx, CAST(c AS INTEGER) AS chan, CAST(-0.75 AS DOUBLE) * d * (4 - c) AS x FROM range(8) a(d), range(5) b(c))"
_DEDISP = f"WITH {CUBE}, {_RAW}, {_DELAYS}, dedisp AS (SELECT pix, dm_idx, t - shift AS t, sum(weight * value) AS value FROM cube JOIN delays USING (chan) WHERE weight <> 0 AND t - shift BETWEEN 0 AND 719 GROUP BY ALL)"
_BOX = """boxes AS (
  SELECT pix, dm_idx, t, u.wid_idx, u.width, u.value FROM (
    SELECT *, """ + ", ".join(f"sum(value) OVER (PARTITION BY pix, dm_idx ORDER BY t ROWS BETWEEN {w - 1} PRECEDING AND CURRENT ROW) AS s{n}" for n, w in enumerate(WIDTHS)) + """ FROM dedisp
  ), LATERAL (VALUES """ + ", ".join(f"(CAST({n} AS INTEGER), CAST({w} AS INTEGER), s{n})" for n, w in enumerate(WIDTHS)) + """) u(wid_idx, width, value)
)"""
_NOISE = "noise AS (SELECT wid_idx, median(s) AS noise FROM (SELECT wid_idx, pix, stddev_pop(value) AS s FROM boxes WHERE dm_idx = 0 GROUP BY ALL) GROUP BY wid_idx)"
_SNR = """found AS (
  SELECT b.pix, b.dm_idx, b.wid_idx, abs((max(value) - median(value)) / any_value(noise)) AS snr, min(t) FILTER (WHERE value = top) AS toa
  FROM (SELECT *, max(value) OVER (PARTITION BY pix, dm_idx, wid_idx) AS top FROM boxes) b JOIN noise USING (wid_idx) GROUP BY ALL
)"""


def _searched(spark, sf_dir):
    delays = trials.linear_delays(spark, 8, 5, -0.75)
    shifted = search.dedisperse(cube(spark, sf_dir), delays, ["pix"], HOURS)
    boxes = search.boxcar(shifted, WIDTHS, ["pix", "dm_idx"])
    noise = search.nested_noise(boxes, "wid_idx", ["pix"], rows=F.col("dm_idx") == 0)
    return search.detect(boxes, noise, ["pix", "dm_idx", "wid_idx"], "wid_idx")


@query(f"{_DEDISP}, {_BOX}, {_NOISE}, {_SNR} SELECT pix, dm_idx, wid_idx, toa, round(snr, 6) + 0 AS snr FROM found WHERE snr >= 3 ORDER BY found.snr DESC, pix, wid_idx, dm_idx LIMIT 20")
def search_single_pulse(spark, sf_dir):
    """Single-pulse search: de-dispersion, boxcars, noise, S/N, threshold and the 20 best."""
    best = search.threshold(_searched(spark, sf_dir), 3.0).orderBy(F.desc("snr"), "pix", "wid_idx", "dm_idx").limit(20)
    return best.select("pix", "dm_idx", "wid_idx", "toa", r6("snr").alias("snr"))


@query(f"{_DEDISP}, {_BOX}, {_NOISE}, {_SNR} SELECT pix, dm_idx, wid_idx, toa, round(snr, 6) + 0 AS snr FROM found")
def snr_toa(spark, sf_dir):
    return _searched(spark, sf_dir).select("pix", "dm_idx", "wid_idx", "toa", r6("snr").alias("snr"))


@query(f"{_DEDISP}, {_BOX}, {_NOISE}, {_SNR} SELECT pix, count(*) AS n, round(max(snr), 6) + 0 AS best FROM found WHERE pix IN (SELECT pix FROM found GROUP BY pix HAVING max(snr) > 4) GROUP BY pix")
def gulp_gate(spark, sf_dir):
    """All results of those positions that have any above the gate."""
    kept = search.open_gulps(_searched(spark, sf_dir), "pix", 4.0)
    return kept.groupBy("pix").agg(F.count("*").alias("n"), r6(F.max("snr")).alias("best"))


@query(f"{_DEDISP} SELECT pix, dm_idx, t, round(value, 6) + 0 AS value FROM dedisp")
def dedisperse_linear(spark, sf_dir):
    out = search.dedisperse(cube(spark, sf_dir), trials.linear_delays(spark, 8, 5, -0.75), ["pix"], HOURS)
    return out.select("pix", "dm_idx", F.col("t").cast("int").alias("t"), r6("value").alias("value"))


@query(f"WITH {CUBE}, {_RAW}, {_DELAYS} SELECT pix, dm_idx, CAST(((t - shift) % 720 + 720) % 720 AS INTEGER) AS t, round(sum(weight * value), 6) + 0 AS value FROM cube JOIN delays USING (chan) WHERE weight <> 0 GROUP BY ALL")
def dedisperse_wrap(spark, sf_dir):
    out = search.dedisperse(cube(spark, sf_dir), trials.linear_delays(spark, 8, 5, -0.75), ["pix"], HOURS, wrap=True)
    return out.select("pix", "dm_idx", F.col("t").cast("int").alias("t"), r6("value").alias("value"))


@query(f"WITH {SERIES} SELECT pix, w.width, CAST((t - 360 + k.k + 720) % 720 AS INTEGER) AS t, round(sum(value), 6) + 0 AS value FROM series, (VALUES (CAST(1 AS INTEGER)), (2), (4), (8), (16)) w(width), range(16) k(k) WHERE k.k < w.width GROUP BY 1, 2, 3")
def boxcar_circular(spark, sf_dir):
    out = search.boxcar_circular(series(spark, sf_dir), WIDTHS, ["pix"], HOURS)
    return out.select("pix", "width", F.col("t").cast("int").alias("t"), r6("value").alias("value"))


@query(f"WITH {SERIES} SELECT pix, t, round(sum(value) OVER (PARTITION BY pix ORDER BY t ROWS BETWEEN 4 PRECEDING AND 3 FOLLOWING) / 8, 9) + 0 AS value FROM series")
def boxcar_linear(spark, sf_dir):
    return search.boxcar_mean(series(spark, sf_dir), 8, ["pix"]).select("pix", "t", r9("value").alias("value"))


@query(f"WITH {CUBE} SELECT chan, round(median(s), 6) + 0 AS noise FROM (SELECT chan, pix, stddev_pop(value) AS s FROM cube GROUP BY ALL) GROUP BY chan")
def noise_nested(spark, sf_dir):
    return search.nested_noise(cube(spark, sf_dir), "chan", ["pix"]).select("chan", r6("noise").alias("noise"))


_DAILY = f"WITH {EV}, daily AS (SELECT chan, day, stddev_pop(value) AS x FROM ev GROUP BY ALL)"


def _daily(spark, sf_dir):
    return events(spark, sf_dir).groupBy("chan", "day").agg(F.stddev_pop("value").alias("x"))


@query(f"{_DAILY} SELECT chan, day, count(x) OVER w AS n, round(avg(x) OVER w, 6) + 0 AS noise FROM daily WINDOW w AS (PARTITION BY chan ORDER BY day)")
def noise_running(spark, sf_dir):
    return search.running_mean(_daily(spark, sf_dir), ["chan"], "day", "x").select("chan", "day", "n", r6("noise").alias("noise"))


@query(
    _DAILY.replace("WITH", "WITH RECURSIVE", 1)
    + """, d AS (SELECT *, row_number() OVER (PARTITION BY chan ORDER BY day) AS k FROM daily), r AS (
  SELECT chan, k, CAST(1 AS BIGINT) AS n, x AS noise FROM d WHERE k = 1
  UNION ALL
  SELECT d.chan, d.k, CASE WHEN r.noise <> 0 AND d.x > CAST(1.02 AS DOUBLE) * r.noise THEN r.n ELSE r.n + 1 END,
         CASE WHEN r.noise <> 0 AND d.x > CAST(1.02 AS DOUBLE) * r.noise THEN r.noise ELSE (r.noise * r.n + d.x) / (r.n + 1) END
  FROM r JOIN d ON d.chan = r.chan AND d.k = r.k + 1
) SELECT r.chan, r.n, round(r.noise, 6) + 0 AS noise FROM r JOIN (SELECT chan, max(k) AS k FROM d GROUP BY chan) USING (chan, k)"""
)
def noise_outlier_reject(spark, sf_dir):
    """The running mean that leaves out values over a multiple of what it is (days in order: a month at most)."""
    from skysift.operators.noise import reject_and_fold

    return reject_and_fold(_daily(spark, sf_dir), ["chan"], "day", "x", 1.02).select("chan", "n", r6("noise").alias("noise"))


@query(f"WITH {CUBE}, b AS (SELECT pix, chan, CAST(floor(t / CAST(5 AS DOUBLE)) AS INTEGER) AS t, avg(value) AS v FROM cube GROUP BY ALL) SELECT pix, chan, t, round(v - median(v) OVER (PARTITION BY pix, chan), 6) + 0 AS value FROM b")
def slow_bin(spark, sf_dir):
    out = search.subtract_median(search.rebin(cube(spark, sf_dir), ["pix", "chan"], trials.SLOW_BIN), ["pix", "chan"])
    return out.select("pix", "chan", "t", r6("value").alias("value"))


@query(f"WITH {CUBE}, g AS (SELECT pix, CAST(floor(t / CAST(24 AS DOUBLE)) AS INTEGER) AS day, avg(value) AS v FROM cube GROUP BY ALL) SELECT pix, CAST(floor(day / CAST(3 AS DOUBLE)) AS INTEGER) AS t, round(avg(v), 6) + 0 AS value FROM g GROUP BY 1, 2")
def imgdiff_bin(spark, sf_dir):
    gulps = search.rebin(cube(spark, sf_dir), ["pix"], 24)
    return search.rebin(gulps, ["pix"], trials.DIFF_BIN).select("pix", "t", r6("value").alias("value"))


@query(f"WITH {SERIES}, n AS (SELECT median(s) AS noise FROM (SELECT pix, stddev_pop(value) AS s FROM series GROUP BY pix)), b AS (SELECT pix, t, sum(value) OVER (PARTITION BY pix ORDER BY t ROWS BETWEEN 3 PRECEDING AND CURRENT ROW) AS v FROM series) SELECT pix, round(abs((max(v) - median(v)) / any_value(noise)), 6) + 0 AS snr FROM b, n GROUP BY pix")
def image_difference_search(spark, sf_dir):
    """The search without de-dispersion on a one-channel stack, with one width."""
    flat = series(spark, sf_dir).withColumn("wid_idx", F.lit(0))
    noise = search.nested_noise(flat, "wid_idx", ["pix"])
    boxes = search.boxcar(flat.drop("wid_idx"), [4], ["pix"])
    return search.detect(boxes, noise, ["pix", "wid_idx"], "wid_idx").select("pix", r6("snr").alias("snr"))


@query(f"WITH {EV} SELECT event_id, chan, day, round((value - median(value) OVER (PARTITION BY day, chan)) / nullif(stddev_pop(value) OVER (PARTITION BY day, chan), 0), 6) + 0 AS z FROM ev")
def gulp_normalize(spark, sf_dir):
    from skysift.operators.summary import normalize

    return normalize(events(spark, sf_dir), ["day", "chan"], "value").select("event_id", "chan", "day", r6("z").alias("z"))


_P = "(VALUES " + ", ".join(f"(CAST({p} AS INTEGER))" for p in PERIODS) + ") p(period)"


@query(f"WITH {SERIES}, n AS (SELECT pix, stddev_pop(value) AS noise FROM series GROUP BY pix), f AS (SELECT pix, period, t % period AS phase, avg(value) AS m FROM series, {_P} WHERE t < 720 - 720 % period GROUP BY ALL) SELECT pix, period, round(max(m) * sqrt(floor(720 / CAST(period AS DOUBLE))) / any_value(noise), 6) + 0 AS snr FROM f JOIN n USING (pix) GROUP BY pix, period")
def fold_periods(spark, sf_dir):
    return folding.fold(series(spark, sf_dir), PERIODS, HOURS, ["pix"]).select("pix", "period", r6("snr").alias("snr"))


@query(f"WITH {SERIES}, f AS (SELECT pix, period, t % period AS phase, sum(value) / pow(count(*), CAST(1.5 AS DOUBLE)) AS s FROM series, {_P} GROUP BY ALL) SELECT pix, period, round(max(s), 6) + 0 AS score FROM f GROUP BY pix, period")
def fold_weighted(spark, sf_dir):
    return folding.fold_weighted(series(spark, sf_dir), PERIODS, ["pix"]).select("pix", "period", r6("score").alias("score"))


@query(f"""WITH {SERIES}, ranked AS (SELECT pix, t, row_number() OVER (PARTITION BY pix ORDER BY value DESC, t) AS place FROM series WHERE t < 720),
picked AS (SELECT pix, period, t, row_number() OVER (PARTITION BY pix, period ORDER BY t) - 1 AS n FROM ranked, {_P} WHERE place <= floor(720 / CAST(period AS DOUBLE)))
SELECT pix, period, CAST(q.q AS INTEGER) AS phase, round(sqrt(avg(pow(t - least(q.q + n * period, 720), CAST(2 AS DOUBLE)))), 6) + 0 AS rms FROM picked, range(10) q(q) GROUP BY 1, 2, 3""")
def fold_timing(spark, sf_dir):
    return folding.fold_timing(series(spark, sf_dir), PERIODS, 10, HOURS, ["pix"]).select("pix", "period", "phase", r6("rms").alias("rms"))


@query(f"WITH {SERIES} SELECT pix, period, CAST(j.j AS INTEGER) AS phase, round(avg(value), 9) + 0 AS score FROM series, {_P}, range(4) j(j) WHERE t >= floor(j.j * period / CAST(4 AS DOUBLE)) AND (t - CAST(floor(j.j * period / CAST(4 AS DOUBLE)) AS INTEGER)) % period = 0 GROUP BY 1, 2, 3")
def fast_fold(spark, sf_dir):
    return folding.fast_fold(series(spark, sf_dir), PERIODS, 4, ["pix"]).select("pix", "period", "phase", r9("score").alias("score"))


@query(f"""WITH {SERIES}, w AS (
  SELECT pix, period, h.h AS h, sum(value * cos(2 * pi() * round_even(CAST(720 AS DOUBLE) * h.h / period, 0) * t / CAST(720 AS DOUBLE))) AS re, sum(value * sin(2 * pi() * round_even(CAST(720 AS DOUBLE) * h.h / period, 0) * t / CAST(720 AS DOUBLE))) AS im
  FROM series, {_P}, range(1, 4) h(h) GROUP BY ALL
) SELECT pix, period, round(avg(re * re + im * im) / 1000000, 5) + 0 AS power FROM w GROUP BY pix, period""")
def spec_fold(spark, sf_dir):
    out = folding.spectrum_fold(series(spark, sf_dir), PERIODS, 3, HOURS, ["pix"])
    return out.select("pix", "period", (F.round(F.col("power") / 1e6, 5) + F.lit(0.0)).alias("power"))


@query(f"WITH {SERIES}, n AS (SELECT pix, stddev_pop(value) AS noise FROM series GROUP BY pix), f AS (SELECT pix, period, t % period AS phase, avg(value) AS m FROM series, {_P} WHERE t < 720 - 720 % period GROUP BY ALL), s AS (SELECT pix, period, round(max(m) * sqrt(floor(720 / CAST(period AS DOUBLE))) / any_value(noise), 6) + 0 AS snr FROM f JOIN n USING (pix) GROUP BY pix, period) SELECT pix, period, snr, CAST(k.k AS INTEGER) AS point, round(period - 1 + k.k * CAST(2 AS DOUBLE) / 9, 6) + 0 AS fine FROM (SELECT *, row_number() OVER (PARTITION BY pix ORDER BY snr DESC, period) AS place FROM s), range(10) k(k) WHERE place = 1")
def best_period_refined(spark, sf_dir):
    """The best period of each position and fine trials around it."""
    scored = folding.fold(series(spark, sf_dir), PERIODS, HOURS, ["pix"]).withColumn("snr", r6("snr"))
    best = folding.best_trial(scored, ["pix"], "snr", ["period"])
    return best.select("pix", "period", "snr", F.posexplode(folding.refine_period(F.col("period"))).alias("point", "f")).select("pix", "period", "snr", "point", r6("f").alias("fine"))


@query("SELECT * FROM (VALUES " + ", ".join(f"(CAST({n} AS INTEGER), CAST({d:.6f} AS DOUBLE))" for n, d in enumerate([0, 213.722, 267.112, 333.834, 417.22, 521.431, 651.668, 814.433, 1017.851, 1272.073, 1589.79, 1986.86, 2483.103, 3103.288, 3878.372, 4847.041])) + ") v(dm_idx, dm)")
def dm_trials(spark, sf_dir):
    """The instrument's dispersion trials."""
    return spark.createDataFrame([(n, round(d, 3)) for n, d in enumerate(trials.dispersion_trials())], "dm_idx int, dm double")


@query(f"WITH {SERIES} SELECT pix, count(*) AS n, round(sum(value * (1 + last)), 4) + 0 AS total FROM (SELECT pix, t, value, CASE WHEN t >= 700 THEN 1 ELSE 0 END AS last FROM series WHERE t >= 100) GROUP BY pix")
def cutoff_and_carry(spark, sf_dir):
    """A cut-off edge, and the last samples appended once more as the next gulp's history."""
    kept = series(spark, sf_dir).where("t >= 100")
    both = kept.unionByName(kept.where(F.col("t") >= HOURS - 20))
    return both.groupBy("pix").agg(F.countDistinct("t").alias("n"), (F.round(F.sum("value"), 4) + F.lit(0.0)).alias("total"))


@query("SELECT CAST(d.d AS INTEGER) AS dm_idx, w.w AS width, CAST(0 AS BIGINT) AS n, round(CAST(1.5 AS DOUBLE) * v.s * sqrt(w.w), 6) + 0 AS noise FROM (SELECT avg(s) AS s FROM (SELECT l_linenumber, stddev_pop(l_quantity) AS s FROM lineitem GROUP BY 1)) v, range(16) d(d), (VALUES (CAST(1 AS INTEGER)), (2), (4), (8), (16)) w(w)")
def noise_from_visibilities(spark, sf_dir):
    """Noise state before any search, from the deviation of visibilities by sub-band."""
    from skysift.operators.noise import from_visibilities

    samples = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select(F.col("l_linenumber").alias("sb"), F.col("l_quantity").cast("double").alias("re"))
    return from_visibilities(samples, "sb", 16, WIDTHS, 1.5).select("dm_idx", "width", "n", r6("noise").alias("noise"))


@query(f"""{_DEDISP}, {_BOX}, peaks AS (SELECT pix, dm_idx, wid_idx, max(value) AS peak FROM boxes GROUP BY ALL), limits AS (SELECT dm_idx, wid_idx, quantile_cont(peak, CAST(0.9 AS DOUBLE)) AS top FROM peaks GROUP BY ALL),
m AS (SELECT pix, dm_idx, wid_idx, value, CASE WHEN value < top THEN value ELSE CAST(0 AS DOUBLE) END AS m, value < top AS below FROM boxes JOIN limits USING (dm_idx, wid_idx)),
e AS (SELECT pix, dm_idx, wid_idx, max(value) AS peak, quantile_disc(m, 0.5) AS low, stddev_samp(m) * sqrt(CAST(count(*) AS DOUBLE) / nullif(count(*) FILTER (WHERE below), 0)) AS s FROM m GROUP BY ALL),
n AS (SELECT dm_idx, wid_idx, quantile_disc(s, 0.5) AS noise FROM e WHERE s IS NOT NULL GROUP BY ALL)
SELECT pix, dm_idx, wid_idx, round((peak - low) / nullif(noise, 0), 6) + 0 AS snr FROM e JOIN n USING (dm_idx, wid_idx)""")
def snr_below_quantile(spark, sf_dir):
    """The older S/N, with what reaches the 0.9 quantile of the positions' peaks masked."""
    delays = trials.linear_delays(spark, 8, 5, -0.75)
    boxes = search.boxcar(search.dedisperse(cube(spark, sf_dir), delays, ["pix"], HOURS), WIDTHS, ["pix", "dm_idx"])
    out = search.detect_below_quantile(boxes, ["pix", "dm_idx", "wid_idx"], ["dm_idx", "wid_idx"])
    return out.select("pix", "dm_idx", "wid_idx", r6("snr").alias("snr"))
