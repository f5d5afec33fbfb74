"""Join and candidate queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from skysift.operators import candidates, joins
from skysift.queries.registry import EV, events, micros, query, r6, table

_T = "t AS (SELECT event_id, event_type, (epoch_us(ts) - 1704067200000000) / CAST(1000000 AS DOUBLE) AS x FROM events)"
_O = "o AS (SELECT o_orderkey AS file, CAST((o_orderkey * 7919) % 2592000 AS DOUBLE) AS y FROM orders)"


def _times(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", "event_type", (micros("ts") / 1e6).alias("x"))


def _files(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("file"), ((F.col("o_orderkey") * 7919) % 2592000).cast("double").alias("y"))


@query(f"WITH {_T}, {_O} SELECT event_id, file, round(x - y, 6) + 0 AS diff FROM (SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY abs(x - y), file) AS n FROM t JOIN o ON abs(x - y) <= 600) WHERE n = 1")
def asof_nearest_tol(spark, sf_dir):
    best = joins.nearest(_times(spark, sf_dir), _files(spark, sf_dir), "x", "y", 600.0, "event_id", ["file"])
    return best.select("event_id", "file", r6(F.col("x") - F.col("y")).alias("diff"))


@query(f"WITH {_T}, {_O}, l AS (SELECT event_id, max(y) AS y FROM t LEFT JOIN o ON o.y < t.x GROUP BY event_id) SELECT event_id, y FROM l")
def asof_backward(spark, sf_dir):
    return joins.backward(_times(spark, sf_dir), _files(spark, sf_dir).groupBy("y").agg(F.min("file").alias("file")), "x", "y", ["file"]).select("event_id", "y")


@query(f"WITH {_T}, {_O}, l AS (SELECT event_id, max(y) AS y FROM t LEFT JOIN o ON o.y <= floor(t.x) GROUP BY event_id) SELECT event_id, y FROM l")
def asof_at_or_before(spark, sf_dir):
    """The latest file that starts by the second of each event, that second included."""
    times = _times(spark, sf_dir).withColumn("x", F.floor("x").cast("double"))
    return joins.backward(times, _files(spark, sf_dir).groupBy("y").agg(F.min("file").alias("file")), "x", "y", ["file"], strict=False).select("event_id", "y")


@query(f"WITH {_T}, {_O} SELECT event_type, count(*) AS n FROM t WHERE EXISTS (SELECT 1 FROM o WHERE t.x - o.y >= -60 AND t.x - o.y <= 300) GROUP BY event_type")
def interval_exists(spark, sf_dir):
    """Events with a file from 60 s after to 300 s before them: a semi-join on an interval."""
    hit = joins.within(_times(spark, sf_dir), _files(spark, sf_dir), "x", "y", 60.0, 300.0, "left_semi")
    return hit.groupBy("event_type").agg(F.count("*").alias("n"))


@query(f"WITH {_T}, {_O} SELECT event_id, min(file) AS file, CAST(floor((any_value(x) - arg_min(y, file)) / CAST(25 AS DOUBLE)) AS INTEGER) AS sample FROM t JOIN o ON x - y >= 0 AND x - y <= 302 GROUP BY event_id")
def file_range_offset(spark, sf_dir):
    """The first file that covers each event, and the sample in it."""
    times = _times(spark, sf_dir)
    first = joins.least_within(times, _files(spark, sf_dir), "x", "y", 302.0, "event_id", F.struct("file", "y"))
    return first.join(times, "event_id").select("event_id", F.col("least.file").alias("file"), F.floor((F.col("x") - F.col("least.y")) / 25).cast("int").alias("sample"))


@query(f"WITH {_T}, {_O}, a AS (SELECT event_id, CAST(floor(x / 60) AS BIGINT) AS k FROM t), b AS (SELECT DISTINCT CAST(floor(y / 60) AS BIGINT) AS k FROM o) SELECT event_id, bool_or(a.k - b.k = 1) AS postinjection FROM a JOIN b ON b.k = a.k OR b.k = a.k - 1 GROUP BY event_id")
def previous_gulp_match(spark, sf_dir):
    """Events in a file's minute or the minute after; the flag says that one of the latter kind was found."""
    gulp = _times(spark, sf_dir).select("event_id", F.floor(F.col("x") / 60).cast("bigint").alias("k"))
    minutes = _files(spark, sf_dir).select(F.floor(F.col("y") / 60).cast("bigint").alias("b")).distinct()
    spread = minutes.select("b", F.explode(F.array(F.col("b"), F.col("b") + 1)).alias("k"))
    return gulp.join(spread, "k").groupBy("event_id").agg(F.bool_or(F.col("k") - F.col("b") == 1).alias("postinjection"))


_SKY = "p AS (SELECT c_custkey, CAST((c_custkey * 37) % 360 AS DOUBLE) AS ra, CAST((c_custkey * 53) % 120 - 40 AS DOUBLE) AS dec FROM customer), c AS (SELECT s_suppkey, CAST((s_suppkey * 71) % 360 AS DOUBLE) + CAST(0.5 AS DOUBLE) AS c_ra, CAST((s_suppkey * 29) % 120 - 40 AS DOUBLE) + CAST(0.25 AS DOUBLE) AS c_dec, s_acctbal AS flux FROM supplier)"
_SEP = "degrees(2 * asin(sqrt(least(CAST(1 AS DOUBLE), pow(sin((radians(c_dec) - radians(dec)) / 2), 2) + cos(radians(dec)) * cos(radians(c_dec)) * pow(sin(radians(c_ra - ra) / 2), 2)))))"


def _sky(spark, sf_dir):
    p = table(spark, sf_dir, "customer").select("c_custkey", ((F.col("c_custkey") * 37) % 360).cast("double").alias("ra"), ((F.col("c_custkey") * 53) % 120 - 40).cast("double").alias("dec"))
    c = table(spark, sf_dir, "supplier").select("s_suppkey", (((F.col("s_suppkey") * 71) % 360).cast("double") + 0.5).alias("c_ra"), (((F.col("s_suppkey") * 29) % 120 - 40).cast("double") + 0.25).alias("c_dec"), F.col("s_acctbal").alias("flux"))
    return p, c


@query(f"WITH {_SKY} SELECT c_custkey, s_suppkey, round({_SEP}, 6) + 0 AS sep, row_number() OVER (PARTITION BY c_custkey ORDER BY flux DESC, s_suppkey) AS place FROM p, c WHERE {_SEP} < 4")
def cone_search(spark, sf_dir):
    """Catalog sources within 4 degrees of each pointing, brightest first."""
    p, c = _sky(spark, sf_dir)
    found = joins.ranked_cone(p, c, 4.0, "c_custkey", [F.desc("flux"), F.col("s_suppkey")], "place")
    return found.select("c_custkey", "s_suppkey", r6("sep").alias("sep"), F.col("place").cast("bigint").alias("place"))


@query(f"WITH {_SKY} SELECT c_custkey, count(*) AS n, round(max(flux), 6) + 0 AS best FROM p, c WHERE abs(dec - c_dec) < 1.5 GROUP BY c_custkey")
def dec_strip(spark, sf_dir):
    """Sources in the strip of declination about each pointing, and the brightest; distinct declinations meet, each with what lies there."""
    p, c = _sky(spark, sf_dir)
    there = c.groupBy("c_dec").agg(F.count("*").alias("n"), F.max("flux").alias("best"))
    strips = joins.strip(p.select("dec").distinct(), there, 1.5).groupBy("dec").agg(F.sum("n").alias("n"), F.max("best").alias("best"))
    return p.join(strips, "dec").groupBy("c_custkey").agg(F.sum("n").alias("n"), r6(F.max("best")).alias("best"))


@query(f"WITH {_SKY}, s AS (SELECT c_custkey, s_suppkey, {_SEP} AS sep FROM p, c) SELECT c_custkey, s_suppkey, round(sep, 6) + 0 AS sep FROM (SELECT *, row_number() OVER (PARTITION BY c_custkey ORDER BY round(sep, 9), s_suppkey) AS n FROM s WHERE sep < 30) WHERE n = 1")
def nearest_match(spark, sf_dir):
    """The nearest catalog source within 30 degrees."""
    p, c = _sky(spark, sf_dir)
    best = joins.nearest_on_sky(p, c, "c_custkey", [F.round("sep", 9), F.col("s_suppkey")], [1.0, 3.0, 10.0, 30.0])
    return best.select("c_custkey", "s_suppkey", r6("sep").alias("sep"))


@query(f"WITH {_SKY} SELECT c_custkey, s_suppkey FROM (SELECT c_custkey, s_suppkey, row_number() OVER (PARTITION BY c_custkey ORDER BY abs(dec - c_dec), s_suppkey) AS n FROM p, c WHERE abs(dec - c_dec) <= 1.5) WHERE n = 1")
def nearest_declination(spark, sf_dir):
    """The calibration nearest in declination within 1.5 degrees."""
    p, c = _sky(spark, sf_dir)
    return joins.nearest(p, c, "dec", "c_dec", 1.5, "c_custkey", ["s_suppkey"]).select("c_custkey", "s_suppkey")


@query(f"WITH {EV}, g AS (SELECT t, count(DISTINCT chan) AS parts, sum(value) FILTER (WHERE chan = 0) AS sb0, sum(value) FILTER (WHERE chan = 1) AS sb1, sum(value) FILTER (WHERE chan = 2) AS sb2, sum(value) FILTER (WHERE chan = 3) AS sb3, sum(value) FILTER (WHERE chan = 4) AS sb4 FROM ev GROUP BY t) SELECT t, " + ", ".join(f"round(sb{k}, 6) + 0 AS sb{k}" for k in range(5)) + " FROM g WHERE parts = 5")
def assemble_subbands(spark, sf_dir):
    """Hours with all five parts, one column each."""
    names = [f"sb{k}" for k in range(5)]
    full = joins.complete_groups(events(spark, sf_dir), ["t"], "chan", list(range(5)), "value", names)
    return full.select("t", *[r6(n).alias(n) for n in names])


@query(f"WITH {EV} SELECT day, count(*) AS hours FROM (SELECT day, t FROM ev GROUP BY ALL HAVING count(DISTINCT chan) = 5) GROUP BY day")
def completeness_gate(spark, sf_dir):
    full = events(spark, sf_dir).groupBy("day", "t").agg(F.countDistinct("chan").alias("n")).where("n = 5")
    return full.groupBy("day").agg(F.count("*").alias("hours"))


@query(f"WITH {EV}, known AS (SELECT DISTINCT t FROM ev WHERE chan = 0), firsts AS (SELECT min(t) AS t0 FROM known) SELECT e.t, coalesce(k.t, (SELECT t0 FROM firsts)) AS slot, count(*) AS n FROM ev e LEFT JOIN known k USING (t) GROUP BY ALL")
def slot_or_first(spark, sf_dir):
    """The slot of a time where there is one, else the first slot."""
    e = events(spark, sf_dir)
    known = e.where("chan = 0").select("t").distinct().withColumn("k", F.col("t"))
    first = known.agg(F.min("t").alias("t0"))
    return e.join(known, "t", "left").join(F.broadcast(first)).groupBy("t", F.coalesce("k", "t0").alias("slot")).agg(F.count("*").alias("n"))


@query("SELECT count(*) AS missing, min(o_orderkey) AS first FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_quantity > 45)")
def ledger_missing(spark, sf_dir):
    """Files of the ledger that aren't in the store."""
    store = table(spark, sf_dir, "lineitem").where("l_quantity > 45").select(F.col("l_orderkey").alias("o_orderkey"))
    return table(spark, sf_dir, "orders").join(store, "o_orderkey", "left_anti").agg(F.count("*").alias("missing"), F.min("o_orderkey").alias("first"))


@query(f"WITH {EV}, i AS (SELECT event_id, t, value FROM ev WHERE chan = 2), r AS (SELECT DISTINCT t FROM ev WHERE chan = 4 AND value > 50) SELECT CAST(floor(value / 20) AS INTEGER) AS bin, count(*) AS injected, round(avg(CASE WHEN r.t IS NULL THEN CAST(0 AS DOUBLE) ELSE 1 END), 6) + 0 AS recovered FROM i LEFT JOIN r USING (t) GROUP BY 1")
def injection_recovery(spark, sf_dir):
    """The share of injections with a recovery at their time, by strength."""
    e = events(spark, sf_dir)
    found = e.where("chan = 4 and value > 50").select("t").distinct().withColumn("hit", F.lit(1.0))
    both = e.where("chan = 2").join(found, "t", "left")
    return both.groupBy(F.floor(F.col("value") / 20).cast("int").alias("bin")).agg(F.count("*").alias("injected"), r6(F.avg(F.coalesce("hit", F.lit(0.0)))).alias("recovered"))


_C = "c AS (SELECT l_orderkey * 10 + l_linenumber AS cand, CAST(l_orderkey % 50 AS INTEGER) AS gulp, CAST(l_partkey % 64 AS INTEGER) AS ra_idx, CAST(l_suppkey % 64 AS INTEGER) AS dec_idx, CAST(l_linenumber % 3 AS INTEGER) AS dm_idx, l_quantity AS snr FROM lineitem WHERE l_quantity >= 45)"
_PSF = "psf(d_dec, d_ra, psf) AS (VALUES " + ", ".join(f"(CAST({a} AS INTEGER), CAST({b} AS INTEGER), CAST({1 / (1 + a * a + b * b):.6f} AS DOUBLE))" for a in (-1, 0, 1) for b in (-1, 0, 1)) + ")"
_PAIRS = f"{_C}, {_PSF}, pairs AS (SELECT a.cand AS centre, b.dm_idx, b.snr, psf FROM c a JOIN c b ON a.gulp = b.gulp JOIN psf ON b.dec_idx - a.dec_idx = d_dec AND b.ra_idx - a.ra_idx = d_ra)"


def _cands(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").where("l_quantity >= 45").select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("cand"), (F.col("l_orderkey") % 50).cast("int").alias("gulp"), (F.col("l_partkey") % 64).cast("int").alias("ra_idx"),
        (F.col("l_suppkey") % 64).cast("int").alias("dec_idx"), (F.col("l_linenumber") % 3).cast("int").alias("dm_idx"), F.col("l_quantity").alias("snr"),
    )


def _around(spark, sf_dir, group):
    """Candidates, and the sums over the point-spread mask around each place."""
    psf = spark.createDataFrame([(a, b, round(1 / (1 + a * a + b * b), 6)) for a in (-1, 0, 1) for b in (-1, 0, 1)], "d_dec int, d_ra int, psf double")
    cands = _cands(spark, sf_dir)
    return cands, candidates.around(cands, psf, ["gulp"], group)


@query(f"WITH {_PAIRS} SELECT centre, count(*) AS members, round(sum(psf), 6) + 0 AS psf FROM pairs GROUP BY centre")
def psf_neighbours(spark, sf_dir):
    cands, sums = _around(spark, sf_dir, [])
    return candidates.centres(cands, sums, ["gulp"], []).select("centre", "members", r6("psf").alias("psf"))


@query(f"WITH {_PAIRS} SELECT centre, dm_idx, round(sum(snr), 6) + 0 AS snr, count(*) AS members FROM pairs GROUP BY ALL")
def psf_cluster_sum(spark, sf_dir):
    cands, sums = _around(spark, sf_dir, ["dm_idx"])
    return candidates.centres(cands, sums, ["gulp"], ["dm_idx"]).select("centre", "dm_idx", r6("snr").alias("snr"), "members")


@query(f"WITH {_PAIRS}, s AS (SELECT centre, dm_idx, round(sum(psf * snr) / sum(psf), 9) AS score FROM pairs GROUP BY ALL) SELECT centre, dm_idx, round(score, 6) + 0 AS score FROM (SELECT *, row_number() OVER (PARTITION BY dm_idx ORDER BY score DESC, centre) AS n FROM s) WHERE n = 1")
def psf_reduce(spark, sf_dir):
    """The best weighted centre of each trial."""
    cands, sums = _around(spark, sf_dir, ["dm_idx"])
    return candidates.best_centres(cands, sums, ["gulp"], ["dm_idx"]).select("centre", "dm_idx", r6("score").alias("score"))


@query(f"WITH {_C} SELECT gulp, count(*) AS members, round(sum(ra_idx * snr) / sum(snr), 6) + 0 AS ra_idx_mean, round(sum(dec_idx * snr) / sum(snr), 6) + 0 AS dec_idx_mean, max(snr) AS peak, arg_max(ra_idx, snr * 1000000 - ra_idx * 1000 - dec_idx) AS ra_idx_peak FROM c GROUP BY gulp")
def centroid_weighted(spark, sf_dir):
    out = candidates.centroids(_cands(spark, sf_dir), ["gulp"], ["ra_idx", "dec_idx"])
    return out.select("gulp", "members", r6("ra_idx_mean").alias("ra_idx_mean"), r6("dec_idx_mean").alias("dec_idx_mean"), "peak", "ra_idx_peak")


@query("SELECT l_returnflag, count(*) AS n, round(sum(l_extendedprice), 4) + 0 AS total FROM (SELECT * FROM lineitem ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber LIMIT 500) WHERE l_quantity < 49 AND l_linenumber <> 1 GROUP BY l_returnflag")
def topk_then_filter(spark, sf_dir):
    """The limit precedes the filters."""
    top = table(spark, sf_dir, "lineitem").orderBy(F.desc("l_extendedprice"), "l_orderkey", "l_linenumber").limit(500)
    return top.where("l_quantity < 49 and l_linenumber <> 1").groupBy("l_returnflag").agg(F.count("*").alias("n"), (F.round(F.sum("l_extendedprice"), 4) + F.lit(0.0)).alias("total"))


@query("SELECT o_custkey, o_orderkey, o_totalprice FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS n FROM orders) WHERE n <= 2")
def topk_per_group(spark, sf_dir):
    return candidates.best_per(table(spark, sf_dir, "orders"), ["o_custkey"], 2, [F.desc("o_totalprice"), F.col("o_orderkey")]).select("o_custkey", "o_orderkey", "o_totalprice")


@query("SELECT o_custkey, o_orderkey FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS n FROM orders) WHERE n BETWEEN 3 AND 5")
def skip_take(spark, sf_dir):
    return candidates.best_per(table(spark, sf_dir, "orders"), ["o_custkey"], 3, [F.desc("o_totalprice"), F.col("o_orderkey")], skip=2).select("o_custkey", "o_orderkey")


@query("SELECT o_orderkey, printf('cand%06d', 100 + row_number() OVER (ORDER BY o_orderdate, o_orderkey)) AS candname FROM orders")
def next_names(spark, sf_dir):
    """Names that go on from the last one, counted by day."""
    orders = table(spark, sf_dir, "orders").withColumn("day", F.to_date("o_orderdate"))
    return candidates.next_names(orders, [F.col("o_orderdate"), F.col("o_orderkey")], 100, "day").select("o_orderkey", "candname")


@query(f"""WITH {_C}, px AS (SELECT CAST(l_suppkey % 64 AS INTEGER) AS y, CAST(l_partkey % 64 AS INTEGER) AS x, avg(l_discount) AS v FROM lineitem GROUP BY ALL),
k AS (SELECT cand, least(greatest(dec_idx - 2, 0), 59) AS y0, least(greatest(ra_idx - 2, 0), 59) AS x0 FROM c)
SELECT cand, count(*) AS pixels, round(sum(v), 6) + 0 AS total FROM k JOIN px ON y BETWEEN y0 AND y0 + 4 AND x BETWEEN x0 AND x0 + 4 GROUP BY cand""")
def cutout_sums(spark, sf_dir):
    """5 x 5 cut-outs, moved inward at the edges."""
    pixels = table(spark, sf_dir, "lineitem").groupBy((F.col("l_suppkey") % 64).cast("int").alias("y"), (F.col("l_partkey") % 64).cast("int").alias("x")).agg(F.avg("l_discount").alias("v"))
    cut = candidates.cutouts(_cands(spark, sf_dir), pixels, [], 2, 64)
    return cut.groupBy("cand").agg(F.count("*").alias("pixels"), r6(F.sum("v")).alias("total"))


@query(f"WITH {EV}, p AS (SELECT pix, avg(value) AS v FROM ev GROUP BY pix) SELECT e.chan, arg_min(p.pix, abs(p.v - e.m) * 1000000 + p.pix) AS pix FROM (SELECT chan, avg(value) AS m FROM ev GROUP BY chan) e, p GROUP BY e.chan")
def nearest_pixel(spark, sf_dir):
    """The position whose level is nearest each channel's (eight positions against five channels)."""
    e = events(spark, sf_dir)
    p = e.groupBy("pix").agg(F.avg("value").alias("v"))
    c = e.groupBy("chan").agg(F.avg("value").alias("m"))
    near = c.join(F.broadcast(p)).groupBy("chan").agg(F.min(F.struct(F.abs(F.col("v") - F.col("m")).alias("d"), "pix")).alias("b"))
    return near.select("chan", F.col("b.pix").alias("pix"))


@query("SELECT o_custkey, max(o_orderkey) FILTER (WHERE o_orderdate = d) AS latest FROM (SELECT *, max(o_orderdate) OVER (PARTITION BY o_custkey) AS d FROM orders) GROUP BY o_custkey")
def most_recent(spark, sf_dir):
    """The latest file of each object."""
    return table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.max(F.struct("o_orderdate", "o_orderkey")).alias("m")).select("o_custkey", F.col("m.o_orderkey").alias("latest"))
