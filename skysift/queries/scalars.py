"""Scalar functions, summaries, calibration and grouping queries."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from skysift.functions import codes, sky
from skysift.operators import summary
from skysift.queries.registry import EV, events, micros, query, r6, r9, table

_EPOCH = 1704067200000000


def _micros(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", (micros("ts") + _EPOCH).alias("us"), "value", "event_type", "props")


@query("SELECT event_id, round(epoch_us(ts) / CAST(86400000000 AS DOUBLE) + 40587, 6) + 0 AS mjd, strftime(ts, '%Y-%m-%dT%H:%M:%S.') || lpad(CAST(CAST(floor((epoch_us(ts) % 1000000) / CAST(1000 AS DOUBLE)) AS INTEGER) AS VARCHAR), 3, '0') AS isot, epoch_us(ts) AS us FROM events")
def mjd_convert(spark, sf_dir):
    """MJD and ISO text of each time, and the microseconds back from the text's moment."""
    e = _micros(spark, sf_dir)
    return e.select("event_id", r6(sky.mjd_of_micros(F.col("us"))).alias("mjd"), sky.isot_of_micros(F.col("us")).alias("isot"), "us")


@query("SELECT event_id, CAST(floor((epoch_us(ts) / CAST(86400000000 AS DOUBLE) + 40587 - 60310) * 86400 / CAST(10 AS DOUBLE)) AS BIGINT) AS specnum, CAST(ceil(value / 8) AS BIGINT) AS ibox, CAST(floor((epoch_us(ts) / CAST(86400000000 AS DOUBLE) + 40587 - 60310) * 86400 / CAST(10 AS DOUBLE)) AS BIGINT) % 25 AS itime FROM events")
def specnum(spark, sf_dir):
    n = sky.spectrum_number(sky.mjd_of_micros(F.col("us")), 60310.0, 10.0)
    return _micros(spark, sf_dir).select("event_id", n.alias("specnum"), F.ceil(F.col("value") / 8).cast("bigint").alias("ibox"), (n % 25).alias("itime"))


@query("SELECT page_id, regexp_extract(url, '^[a-z]+', 0) AS scheme, CAST(nullif(regexp_extract(url, '/([0-9]+)', 1), '') AS BIGINT) AS num, regexp_extract(url, '://([^/?#]+)', 1) AS host FROM pages")
def parse_name(spark, sf_dir):
    return table(spark, sf_dir, "pages").select(
        "page_id", F.regexp_extract("url", "^[a-z]+", 0).alias("scheme"), F.nullif(F.regexp_extract("url", "/([0-9]+)", 1), F.lit("")).cast("bigint").alias("num"), F.regexp_extract("url", "://([^/?#]+)", 1).alias("host")
    )


@query("SELECT CAST(s AS INTEGER) AS status, count(*) AS n, CAST(any_value((s | 4) & ~CAST(1 AS INTEGER)) AS INTEGER) AS changed FROM (SELECT CAST((CASE WHEN value > 50 THEN 1 ELSE 0 END) | (CASE WHEN event_type = 'error' THEN 2 ELSE 0 END) AS INTEGER) AS s FROM events) WHERE s & 2 <> 0 OR s & 1 <> 0 GROUP BY s")
def bitflags(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    s = codes.set_flag(F.when(F.col("value") > 50, codes.PARSE).otherwise(0), 0)
    s = F.when(F.col("event_type") == "error", codes.set_flag(s, codes.SIZE)).otherwise(s).cast("int")
    rows = e.select(s.alias("status")).where(codes.has_flag(F.col("status"), codes.SIZE) | codes.has_flag(F.col("status"), codes.PARSE))
    changed = codes.set_flag(codes.set_flag(F.col("status"), codes.SHAPE), codes.PARSE, False)
    return rows.groupBy("status").agg(F.count("*").alias("n"), F.max(changed).alias("changed"))


@query("SELECT p_partkey, lower(hex(p_name)) AS coded, p_name AS decoded FROM part")
def hex_roundtrip(spark, sf_dir):
    p = table(spark, sf_dir, "part").withColumn("coded", F.lower(F.hex("p_name")))
    return p.select("p_partkey", "coded", F.decode(F.unhex("coded"), "UTF-8").alias("decoded"))


@query("SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k, '{\"id\":' || event_id || ',\"kind\":\"' || event_type || '\"}' AS record FROM events")
def json_props(spark, sf_dir):
    k = F.from_json("props", "k int")["k"]
    return table(spark, sf_dir, "events").select("event_id", k.alias("k"), F.to_json(F.struct(F.col("event_id").alias("id"), F.col("event_type").alias("kind"))).alias("record"))


_SKY = "FROM (SELECT c_custkey, CAST((c_custkey * 37) % 360 AS DOUBLE) AS ra, CAST((c_custkey * 53) % 120 - 40 AS DOUBLE) AS dec FROM customer)"


def _points(spark, sf_dir):
    return table(spark, sf_dir, "customer").select("c_custkey", ((F.col("c_custkey") * 37) % 360).cast("double").alias("ra"), ((F.col("c_custkey") * 53) % 120 - 40).cast("double").alias("dec"))


@query(f"""SELECT c_custkey,
round(((122.93192 - degrees(atan2(cos(radians(dec)) * sin(radians(ra) - radians(CAST(192.85948 AS DOUBLE))), cos(radians(CAST(27.12825 AS DOUBLE))) * sin(radians(dec)) - sin(radians(CAST(27.12825 AS DOUBLE))) * cos(radians(dec)) * cos(radians(ra) - radians(CAST(192.85948 AS DOUBLE))))) + 720) % 360), 6) + 0 AS gl,
round(degrees(asin(greatest(-1, least(1, sin(radians(CAST(27.12825 AS DOUBLE))) * sin(radians(dec)) + cos(radians(CAST(27.12825 AS DOUBLE))) * cos(radians(dec)) * cos(radians(ra) - radians(CAST(192.85948 AS DOUBLE))))))), 6) + 0 AS gb,
round(degrees(asin(sin(radians(dec)) * cos(radians(CAST(23.4392911 AS DOUBLE))) - cos(radians(dec)) * sin(radians(CAST(23.4392911 AS DOUBLE))) * sin(radians(ra)))), 6) + 0 AS eb {_SKY}""")
def sky_frames(spark, sf_dir):
    gl, gb = sky.galactic(F.col("ra"), F.col("dec"))
    return _points(spark, sf_dir).select("c_custkey", r6(gl).alias("gl"), r6(gb).alias("gb"), r6(sky.ecliptic_latitude(F.col("ra"), F.col("dec"))).alias("eb"))


@query("SELECT event_id, round(((280.46061837 + 360.98564736629 * (epoch_us(ts) / CAST(86400000000 AS DOUBLE) + 40587 - 51544.5) - 118.2834) % 360 + 360) % 360, 5) + 0 AS ra FROM events")
def meridian_ra(spark, sf_dir):
    ra = sky.sidereal(sky.mjd_of_micros(F.col("us")))
    return _micros(spark, sf_dir).select("event_id", (F.round(ra, 5) + F.lit(0.0)).alias("ra"))


@query(f"SELECT c_custkey, CASE WHEN dec + 60 > 90 THEN 180 - (dec + 60) ELSE dec + 60 END AS alt, CASE WHEN dec + 60 > 90 THEN CAST(0 AS DOUBLE) ELSE 180 END AS az, CAST(ceil(cos(radians(dec)) * (3355.455 / 1000 * 15.041 / 3600) / CAST(0.004 AS DOUBLE)) AS INTEGER) AS drift, round(sin(radians(CAST(0.5 AS DOUBLE) + 30)) * cos(radians(30)) - cos(radians(CAST(0.5 AS DOUBLE) + 30)) * sin(radians(30)), 9) + 0 AS m {_SKY}")
def pointing(spark, sf_dir):
    """Altitude and azimuth of an elevation, the drift in a gulp, and a direction cosine."""
    alt, az = sky.altitude(F.col("dec") + 60)
    return _points(spark, sf_dir).select("c_custkey", alt.alias("alt"), az.alias("az"), sky.drift_pixels(F.col("dec"), 3355.455, 0.004).alias("drift"), r9(sky.direction_cosine(30.0, F.lit(0.5))).alias("m"))


@query(f"""WITH p AS (SELECT *, radians(dec) AS d, radians(ra - 180) AS a {_SKY}), q AS (SELECT *, sin(radians(20)) * sin(d) + cos(radians(20)) * cos(d) * cos(a) AS f FROM p WHERE abs(ra - 180) < 30 AND abs(dec - 20) < 30)
SELECT c_custkey, round(150 - cos(d) * sin(a) / f / radians(CAST(0.1 AS DOUBLE)), 6) + 0 AS x, round(150 + (cos(radians(20)) * sin(d) - sin(radians(20)) * cos(d) * cos(a)) / f / radians(CAST(0.1 AS DOUBLE)), 6) + 0 AS y FROM q""")
def sky_to_pixel(spark, sf_dir):
    x, y = sky.tangent(F.col("ra"), F.col("dec"), 180.0, 20.0, 0.1, 300)
    near = (F.abs(F.col("ra") - 180) < 30) & (F.abs(F.col("dec") - 20) < 30)
    return _points(spark, sf_dir).where(near).select("c_custkey", r6(x).alias("x"), r6(y).alias("y"))


@query("SELECT l_linenumber, round(sum(l_quantity * cos(2 * pi() * l_discount) - l_tax * sin(2 * pi() * l_discount)), 5) + 0 AS re, round(sum(l_quantity * pow(CAST(1.4 AS DOUBLE) / 1.5, -0.7)), 5) + 0 AS flux FROM lineitem GROUP BY 1")
def phase_and_spectrum(spark, sf_dir):
    v = sky.phase_shift(F.col("l_quantity"), F.col("l_tax"), F.col("l_discount"))
    r5 = lambda c: F.round(F.sum(c), 5) + F.lit(0.0)
    return table(spark, sf_dir, "lineitem").groupBy("l_linenumber").agg(r5(v["re"]).alias("re"), r5(sky.spectral_index(F.col("l_quantity"), F.lit(1.4), 1.5, -0.7)).alias("flux"))


@query("WITH s(k, txt) AS (VALUES (1, '12:30:00'), (2, '-00:30:36'), (3, '05:00:01.5')) SELECT CAST(k AS INTEGER) AS k, round(CASE WHEN starts_with(txt, '-') THEN -1 ELSE 1 END * (abs(CAST(split_part(txt, ':', 1) AS DOUBLE)) + CAST(split_part(txt, ':', 2) AS DOUBLE) / 60 + CAST(split_part(txt, ':', 3) AS DOUBLE) / 3600), 6) + 0 AS deg FROM s")
def sexagesimal(spark, sf_dir):
    s = spark.createDataFrame([(1, "12:30:00"), (2, "-00:30:36"), (3, "05:00:01.5")], "k int, txt string")
    return s.select("k", r6(codes.sexagesimal(F.col("txt"))).alias("deg"))


@query("SELECT CAST(floor(log10(o_totalprice) / CAST(0.25 AS DOUBLE)) AS INTEGER) AS bin, count(*) AS total, CAST(sum(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END) AS BIGINT) AS found, round(avg(CASE WHEN o_orderstatus = 'F' THEN CAST(1 AS DOUBLE) ELSE 0 END), 6) + 0 AS share FROM orders WHERE o_totalprice > 0 GROUP BY 1")
def completeness_curve(spark, sf_dir):
    out = summary.completeness(table(spark, sf_dir, "orders"), F.col("o_totalprice"), F.col("o_orderstatus") == "F", 0.25)
    return out.select("bin", "total", "found", r6("share").alias("share"))


@query("SELECT l_returnflag, round(sum(pow(l_quantity, 3) * l_extendedprice) / sum(pow(l_quantity, 4)), 6) + 0 AS fit, round((SELECT max(m.l_extendedprice) FROM lineitem m WHERE m.l_returnflag = l.l_returnflag AND m.l_quantity = max(l.l_quantity)) / max(l_quantity), 6) + 0 AS slope FROM lineitem l GROUP BY l_returnflag")
def flux_slope(spark, sf_dir):
    out = summary.slopes(table(spark, sf_dir, "lineitem"), ["l_returnflag"], "l_quantity", "l_extendedprice")
    return out.select("l_returnflag", r6("fit").alias("fit"), r6("slope").alias("slope"))


@query("SELECT l_linestatus, round(avg(l_discount - l_tax), 6) + 0 AS mean, round(sqrt(sum(l_quantity * pow(l_discount - l_tax, 2)) / sum(l_quantity)), 6) + 0 AS rms FROM lineitem GROUP BY 1")
def astrom_offsets(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").withColumn("e", F.col("l_discount") - F.col("l_tax"))
    return summary.offsets(rows, ["l_linestatus"], "e", "l_quantity").select("l_linestatus", r6("mean").alias("mean"), r6("rms").alias("rms"))


@query(f"WITH {EV}, m AS (SELECT chan, day, median(value) AS m FROM ev GROUP BY ALL) SELECT chan, round(median(m), 6) + 0 AS median, round(stddev_pop(m) / sqrt(count(*)), 6) + 0 AS error FROM m GROUP BY chan")
def se_median(spark, sf_dir):
    return summary.median_of_medians(events(spark, sf_dir), ["chan"], ["day"], "value").select("chan", r6("median").alias("median"), r6("error").alias("error"))


@query(f"WITH {EV} SELECT CAST(least(greatest(floor(value / CAST(7.5 AS DOUBLE)), 0), 16) AS INTEGER) AS bin, count(*) AS n FROM ev GROUP BY 1")
def latency_hist(spark, sf_dir):
    return events(spark, sf_dir).groupBy(summary.clamped_bins(F.col("value"), 7.5, 16).alias("bin")).agg(F.count("*").alias("n"))


@query(f"WITH {EV} SELECT CAST(floor(pix / CAST(2 AS DOUBLE)) AS INTEGER) AS x, CAST(floor(t / CAST(48 AS DOUBLE)) AS INTEGER) AS y, round(max(value), 6) + 0 AS top FROM ev GROUP BY 1, 2")
def block_max(spark, sf_dir):
    return events(spark, sf_dir).groupBy(F.floor(F.col("pix") / 2).cast("int").alias("x"), F.floor(F.col("t") / 48).cast("int").alias("y")).agg(r6(F.max("value")).alias("top"))


@query(f"WITH {EV}, b AS (SELECT quantile_cont(value, 0.1) AS lo, quantile_cont(value, 0.9) AS hi FROM ev) SELECT event_id, round(least(greatest((value - lo) / (hi - lo), 0), 1) * 10, 6) + 0 AS v FROM ev, b")
def clip_norm(spark, sf_dir):
    """Values between the 10th and the 90th percentile, scaled to 0 to 10."""
    e = events(spark, sf_dir)
    edge = e.agg(F.percentile("value", F.lit(0.1)).alias("lo"), F.percentile("value", F.lit(0.9)).alias("hi"))
    scaled = F.least(F.greatest((F.col("value") - F.col("lo")) / (F.col("hi") - F.col("lo")), F.lit(0.0)), F.lit(1.0)) * 10
    return e.join(F.broadcast(edge)).select("event_id", r6(scaled).alias("v"))


@query("SELECT CAST(l.quality AS INTEGER) AS quality, count(*) AS n, round(avg(CASE WHEN (CASE WHEN d.n_chars > 200 THEN 1 ELSE 0 END) = l.quality THEN CAST(1 AS DOUBLE) ELSE 0 END), 6) + 0 AS accuracy FROM labels l JOIN documents d USING (doc_id) GROUP BY 1")
def accuracy_labels(spark, sf_dir):
    both = table(spark, sf_dir, "labels").join(table(spark, sf_dir, "documents").select("doc_id", "n_chars"), "doc_id")
    hit = (F.when(F.col("n_chars") > 200, 1).otherwise(0) == F.col("quality")).cast("double")
    return both.groupBy(F.col("quality").cast("int").alias("quality")).agg(F.count("*").alias("n"), r6(F.avg(hit)).alias("accuracy"))


@query("SELECT l_returnflag, l_linestatus, count(*) AS n, round(sum(l_quantity), 6) + 0 AS qty FROM lineitem GROUP BY CUBE (l_returnflag, l_linestatus)")
def cube_flags(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").cube("l_returnflag", "l_linestatus").agg(F.count("*").alias("n"), r6(F.sum("l_quantity")).alias("qty"))


@query("SELECT l_returnflag, l_linestatus, count(*) AS n FROM lineitem GROUP BY ROLLUP (l_returnflag, l_linestatus)")
def rollup_flags(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").rollup("l_returnflag", "l_linestatus").agg(F.count("*").alias("n"))


@query("SELECT l_returnflag, count(DISTINCT l_partkey) AS parts, count(DISTINCT l_suppkey) AS supps FROM lineitem GROUP BY 1")
def distinct_counts(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").groupBy("l_returnflag").agg(F.countDistinct("l_partkey").alias("parts"), F.countDistinct("l_suppkey").alias("supps"))


@query()
def distinct_approx(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").groupBy("l_returnflag").agg(F.approx_count_distinct("l_partkey").alias("parts"))


@query(f"WITH {EV}, e AS (SELECT day, round(avg(value), 9) AS v FROM ev GROUP BY day) SELECT day, round(v - lag(v) OVER (ORDER BY day), 6) + 0 AS step, round(avg(v) OVER (ORDER BY day ROWS BETWEEN 29 PRECEDING AND CURRENT ROW), 6) + 0 AS recent FROM e")
def last_values(spark, sf_dir):
    """Daily steps and the mean of the last 30 (a row a day)."""
    daily = events(spark, sf_dir).groupBy("day").agg(F.round(F.avg("value"), 9).alias("v"))
    order = Window.orderBy("day")
    return daily.select("day", r6(F.col("v") - F.lag("v").over(order)).alias("step"), r6(F.avg("v").over(order.rowsBetween(-29, 0))).alias("recent"))


@query(f"WITH {EV} SELECT chan, day, round(max(value), 6) + 0 AS peak FROM ev GROUP BY ALL")
def peak_ledger(spark, sf_dir):
    return events(spark, sf_dir).groupBy("chan", "day").agg(r6(F.max("value")).alias("peak"))


@query(f"WITH {EV}, n AS (SELECT chan, day, count(*) AS k FROM ev GROUP BY ALL) SELECT chan, day, CAST(sum(k) OVER (PARTITION BY chan ORDER BY day) AS BIGINT) AS gulps, round(sum(k) OVER (PARTITION BY chan ORDER BY day) * CAST(3.355455 AS DOUBLE), 6) + 0 AS seconds FROM n")
def integration_time(spark, sf_dir):
    """Gulps so far and the time that they cover."""
    n = events(spark, sf_dir).groupBy("chan", "day").agg(F.count("*").alias("k"))
    total = F.sum("k").over(Window.partitionBy("chan").orderBy("day"))
    return n.select("chan", "day", total.alias("gulps"), r6(total * 3.355455).alias("seconds"))


@query(f"WITH {EV}, n AS (SELECT chan, day, avg(value) AS x, stddev_pop(value) AS y FROM ev GROUP BY ALL) SELECT chan, round(regr_slope(y, x), 6) + 0 AS slope, round(regr_intercept(y, x), 5) + 0 AS intercept FROM n GROUP BY chan")
def calibration_fit(spark, sf_dir):
    n = events(spark, sf_dir).groupBy("chan", "day").agg(F.avg("value").alias("x"), F.stddev_pop("value").alias("y"))
    return n.groupBy("chan").agg(r6(F.regr_slope("y", "x")).alias("slope"), (F.round(F.regr_intercept("y", "x"), 5) + F.lit(0.0)).alias("intercept"))


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY md5(CAST(o_orderkey AS VARCHAR)), o_orderkey LIMIT 50")
def random_choice(spark, sf_dir):
    """A choice without replacement that is the same at each run: by hash order."""
    return table(spark, sf_dir, "orders").orderBy(F.md5(F.col("o_orderkey").cast("string").cast("binary")), "o_orderkey").limit(50).select("o_orderkey", "o_totalprice")


@query("SELECT o_orderpriority, count(*) AS n FROM orders WHERE o_orderdate >= TIMESTAMP '1995-01-01' AND o_orderdate <= TIMESTAMP '1996-12-31' AND o_orderkey NOT IN (1, 5, 9) GROUP BY 1")
def time_range_keep(spark, sf_dir):
    """Inclusive time range with an exempt list."""
    at = lambda s: F.lit(s).cast("timestamp_ntz")
    o = table(spark, sf_dir, "orders").where(F.col("o_orderdate").between(at("1995-01-01"), at("1996-12-31")) & ~F.col("o_orderkey").isin(1, 5, 9))
    return o.groupBy("o_orderpriority").agg(F.count("*").alias("n"))
