"""Flagging, set operations, gridding and imaging sums on line items and events."""

from __future__ import annotations

from pyspark.sql import functions as F

from skysift.operators import filters, gridding
from skysift.queries.registry import CUBE, EV, cube, events, query, r6, r9, table


def _visibilities(spark, sf_dir):
    """Line items as visibilities: antennas and cells from part and supplier keys."""
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", (F.col("l_partkey") % 32).cast("int").alias("i"), (F.col("l_suppkey") % 32).cast("int").alias("j"), F.col("l_quantity").alias("re"), F.col("l_discount").alias("im"), "l_suppkey", "l_partkey"
    )


@query("SELECT l_returnflag, count(*) AS n, round(sum(l_quantity), 6) + 0 AS qty FROM lineitem WHERE l_suppkey NOT IN (SELECT s_suppkey FROM supplier WHERE s_suppkey % 7 = 0) GROUP BY ALL")
def flag_antenna_anti(spark, sf_dir):
    flagged = table(spark, sf_dir, "supplier").where("s_suppkey % 7 = 0")
    kept = filters.drop_antennas(table(spark, sf_dir, "lineitem"), flagged, ["l_suppkey"], "s_suppkey")
    return kept.groupBy("l_returnflag").agg(F.count("*").alias("n"), r6(F.sum("l_quantity")).alias("qty"))


@query("SELECT l_linenumber, count(*) AS n FROM lineitem WHERE sqrt(CAST(l_partkey % 32 AS DOUBLE) * (l_partkey % 32) + CAST(l_suppkey % 32 AS DOUBLE) * (l_suppkey % 32)) >= 10 AND sqrt(CAST(l_partkey % 32 AS DOUBLE) * (l_partkey % 32) + CAST(l_suppkey % 32 AS DOUBLE) * (l_suppkey % 32)) < 30 GROUP BY 1")
def flag_length_range(spark, sf_dir):
    return filters.length_between(_visibilities(spark, sf_dir), "i", "j", 10.0, 30.0).groupBy("l_linenumber").agg(F.count("*").alias("n"))


@query(f"WITH {EV} SELECT chan, count(*) AS n, count(CASE WHEN chan NOT IN (1, 3) THEN value END) AS kept, round(avg(CASE WHEN chan NOT IN (1, 3) THEN value END), 6) + 0 AS mean FROM ev GROUP BY chan")
def mask_channels(spark, sf_dir):
    out = filters.mask_channels(events(spark, sf_dir), "chan", [1, 3], ["value"])
    return out.groupBy("chan").agg(F.count("*").alias("n"), F.count("value").alias("kept"), r6(F.avg("value")).alias("mean"))


@query(f"WITH {EV}, m AS (SELECT chan, avg(value) AS level FROM ev GROUP BY chan) SELECT chan, round(level, 6) + 0 AS level FROM m WHERE level > (SELECT median(level) FROM m) * CAST(1.01 AS DOUBLE)")
def flag_bpass(spark, sf_dir):
    return filters.high_mean(events(spark, sf_dir), "chan", "value", 1.01).select("chan", r6("level").alias("level"))


@query(f"WITH {EV}, e AS (SELECT chan, t, avg(value) AS v FROM ev GROUP BY ALL), m AS (SELECT chan, max(v) - median(v) AS level FROM e GROUP BY chan) SELECT chan, round(level, 6) + 0 AS level FROM m WHERE level > (SELECT median(level) FROM m) * CAST(0.99 AS DOUBLE)")
def flag_burst(spark, sf_dir):
    return filters.bursts(events(spark, sf_dir), "chan", "t", "value", 0.99).select("chan", r6("level").alias("level"))


@query(f"WITH {EV}, e AS (SELECT chan, day, avg(value) AS v FROM ev GROUP BY ALL), f AS (SELECT chan, avg(v - CAST(0.05 AS DOUBLE) * day) AS a, stddev_pop(v) / avg(v) AS spread FROM e GROUP BY chan), o AS (SELECT chan, spread, sqrt(sum(pow(v - CAST(0.05 AS DOUBLE) * day - a, CAST(2 AS DOUBLE)))) AS rms FROM e JOIN f USING (chan) GROUP BY ALL) SELECT chan, round(rms, 6) + 0 AS rms, round(spread, 6) + 0 AS spread FROM o WHERE rms < 1000 AND spread < 10")
def flag_swave(spark, sf_dir):
    daily = events(spark, sf_dir).groupBy("chan", "day").agg(F.avg("value").alias("v"))
    return filters.sloped(daily, "chan", "day", "v", 0.05, 1000.0, 10.0).select("chan", r6("rms").alias("rms"), r6("spread").alias("spread"))


@query(f"WITH {EV} SELECT DISTINCT chan FROM ev WHERE chan >= 5 - 2")
def flag_band(spark, sf_dir):
    return filters.top_channels(events(spark, sf_dir), "chan", 5, 2)


@query(f"WITH {EV}, p AS (SELECT pix, chan, avg(value) AS v FROM ev GROUP BY ALL), b AS (SELECT pix FROM p GROUP BY pix ORDER BY sum(v) DESC, pix LIMIT 1), spot AS (SELECT p.* FROM p JOIN b USING (pix)) SELECT chan, round(v, 6) + 0 AS v FROM spot WHERE abs(v) > CAST(1.001 AS DOUBLE) * abs((SELECT median(v) FROM spot))")
def flag_image_peak(spark, sf_dir):
    image = events(spark, sf_dir).groupBy("pix", "chan").agg(F.avg("value").alias("v"))
    return filters.peak_outliers(image, ["pix"], "chan", "v", 1.001).select("chan", r6("v").alias("v"))


@query(f"WITH {EV}, p AS (SELECT pix, chan, avg(value) AS v FROM ev GROUP BY ALL) SELECT pix, round(sum(CASE WHEN chan IN (0, 2) THEN CAST(0 AS DOUBLE) ELSE v * 5 / 3 END), 6) + 0 AS total FROM p GROUP BY pix")
def flag_rescale(spark, sf_dir):
    image = events(spark, sf_dir).groupBy("pix", "chan").agg(F.avg("value").alias("v"))
    return filters.rescale_flagged(image, "chan", [0, 2], 5, "v").groupBy("pix").agg(r6(F.sum("v")).alias("total"))


@query("SELECT s_suppkey FROM supplier EXCEPT SELECT s_suppkey FROM supplier WHERE s_nationkey < 5")
def set_difference(spark, sf_dir):
    s = table(spark, sf_dir, "supplier")
    return s.select("s_suppkey").subtract(s.where("s_nationkey < 5").select("s_suppkey"))


@query("SELECT c_nationkey AS k FROM customer WHERE c_acctbal > 5000 INTERSECT SELECT s_nationkey FROM supplier")
def set_intersect(spark, sf_dir):
    return table(spark, sf_dir, "customer").where("c_acctbal > 5000").select(F.col("c_nationkey").alias("k")).intersect(table(spark, sf_dir, "supplier").select("s_nationkey"))


@query("SELECT kind, count(*) AS n, round(sum(bal), 4) + 0 AS bal FROM (SELECT 'c' AS kind, c_acctbal AS bal FROM customer UNION ALL SELECT 's', s_acctbal FROM supplier) GROUP BY kind")
def set_concat(spark, sf_dir):
    a = table(spark, sf_dir, "customer").select(F.lit("c").alias("kind"), F.col("c_acctbal").alias("bal"))
    both = a.unionByName(table(spark, sf_dir, "supplier").select(F.lit("s").alias("kind"), F.col("s_acctbal").alias("bal")))
    return both.groupBy("kind").agg(F.count("*").alias("n"), (F.round(F.sum("bal"), 4) + F.lit(0.0)).alias("bal"))


_V = "vis AS (SELECT l_orderkey, l_linenumber, CAST(l_partkey % 32 AS INTEGER) AS i, CAST(l_suppkey % 32 AS INTEGER) AS j, l_quantity AS re, l_discount AS im, l_suppkey FROM lineitem)"


@query(f"WITH {_V}, both_ AS (SELECT i, j, re, im FROM vis UNION ALL SELECT CAST(31 - i AS INTEGER), CAST(31 - j AS INTEGER), re, -im FROM vis) SELECT i, j, round(sum(re), 6) + 0 AS re, round(sum(im), 6) + 0 AS im FROM both_ GROUP BY i, j")
def uv_grid(spark, sf_dir):
    return gridding.grid(_visibilities(spark, sf_dir), "i", "j", 32, []).select("i", "j", r6("re").alias("re"), r6("im").alias("im"))


@query(f"""WITH {_V}, c AS (SELECT i, j, CAST(count(*) AS DOUBLE) AS w FROM vis GROUP BY ALL),
f AS (SELECT pow(5 * pow(CAST(10 AS DOUBLE), CAST(-0.5 AS DOUBLE)), CAST(2 AS DOUBLE)) / (sum(w * w) / sum(w)) AS f2 FROM c), r AS (SELECT i, j, w, 1 / (1 + w * f2) AS raw FROM c, f)
SELECT i, j, CAST(w AS BIGINT) AS n, round(raw / (SELECT sum(raw * w) FROM r) * 1000000, 6) + 0 AS weight FROM r""")
def briggs_weights(spark, sf_dir):
    """Robust weights (in millionths) by cell."""
    out = gridding.briggs(_visibilities(spark, sf_dir), "i", "j", 0.5)
    return out.groupBy("i", "j").agg(F.count("*").alias("n"), r6(F.max("weight") * 1000000).alias("weight"))


@query(f"WITH {_V}, t(target, l, m) AS (VALUES (CAST(0 AS INTEGER), CAST(0 AS DOUBLE), CAST(0 AS DOUBLE)), (1, 0.1, 0.0), (2, 0.0, 0.1), (3, 0.05, -0.05)) SELECT l_linenumber, target, round(sum(re * cos(2 * pi() * (i * l + j * m)) - im * sin(2 * pi() * (i * l + j * m))), 5) + 0 AS value FROM vis, t GROUP BY ALL")
def direct_dft(spark, sf_dir):
    points = spark.createDataFrame([(0, 0.0, 0.0), (1, 0.1, 0.0), (2, 0.0, 0.1), (3, 0.05, -0.05)], "target int, l double, m double")
    out = gridding.direct_transform(_visibilities(spark, sf_dir).withColumns({"u": F.col("i"), "v": F.col("j")}), points, ["l_linenumber"])
    return out.select("l_linenumber", "target", (F.round("value", 5) + F.lit(0.0)).alias("value"))


@query("""SELECT l_linenumber, round(sum((l_quantity * b.re + l_discount * b.im) / (b.re * b.re + b.im * b.im)), 5) + 0 AS re, round(sum((l_discount * b.re - l_quantity * b.im) / (b.re * b.re + b.im * b.im)), 5) + 0 AS im,
round(sum(l_quantity * b.re - l_discount * b.im), 5) + 0 AS pre, round(sum(l_quantity * b.im + l_discount * b.re), 5) + 0 AS pim
FROM lineitem JOIN (SELECT s_suppkey, CAST(1 + s_suppkey % 5 AS DOUBLE) AS re, CAST(s_suppkey % 3 AS DOUBLE) AS im FROM supplier) b ON l_suppkey = s_suppkey GROUP BY 1""")
def complex_calibrate(spark, sf_dir):
    """Visibilities divided by, and multiplied with, the factors of their antenna."""
    factors = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), (1 + F.col("s_suppkey") % 5).cast("double").alias("b_re"), (F.col("s_suppkey") % 3).cast("double").alias("b_im"))
    both = _visibilities(spark, sf_dir).join(factors, "l_suppkey")
    args = [F.col(c) for c in ("re", "im", "b_re", "b_im")]
    out = both.select("l_linenumber", gridding.complex_quotient(*args).alias("q"), gridding.complex_product(*args).alias("p"))
    r5 = lambda c: F.round(F.sum(c), 5) + F.lit(0.0)
    return out.groupBy("l_linenumber").agg(r5("q.re").alias("re"), r5("q.im").alias("im"), r5("p.re").alias("pre"), r5("p.im").alias("pim"))


_ANT = "ant AS (SELECT s_suppkey % 32 AS idx, sum(s_acctbal) AS x, CAST(sum(s_suppkey) AS DOUBLE) AS y, CAST(sum(s_nationkey) AS BIGINT) AS n FROM supplier GROUP BY 1)"


def _antennas(spark, sf_dir):
    """All suppliers, summed into 32 antennas: pairs stay bounded and every row counts."""
    antenna = table(spark, sf_dir, "supplier").groupBy((F.col("s_suppkey") % 32).alias("idx"))
    return antenna.agg(F.sum("s_acctbal").alias("x"), F.sum("s_suppkey").cast("double").alias("y"), F.lit(0.0).alias("z"), F.sum("s_nationkey").cast("bigint").alias("n"))


@query(f"WITH {_ANT} SELECT a.idx AS ant1, b.idx AS ant2, round(b.x - a.x, 6) + 0 AS x FROM ant a JOIN ant b ON a.idx < b.idx")
def antenna_pairs(spark, sf_dir):
    return gridding.baselines(_antennas(spark, sf_dir)).select("ant1", "ant2", r6("x").alias("x"))


@query(f"WITH {_ANT} SELECT a.idx || '-' || b.idx AS bname, a.n AS n1, b.n AS n2 FROM ant a JOIN ant b ON a.idx < b.idx")
def name_split_join(spark, sf_dir):
    """The antennas' sums of nation keys, joined by the two halves of a baseline's name."""
    s = _antennas(spark, sf_dir)
    names = gridding.baselines(s).select(F.concat_ws("-", "ant1", "ant2").alias("bname"))
    ends = names.withColumns({"k1": F.split("bname", "-")[0].cast("bigint"), "k2": F.split("bname", "-")[1].cast("bigint")})
    return ends.join(s.select(F.col("idx").alias("k1"), F.col("n").alias("n1")), "k1").join(s.select(F.col("idx").alias("k2"), F.col("n").alias("n2")), "k2").select("bname", "n1", "n2")


@query(f"""WITH {_ANT} SELECT a.idx AS ant1, b.idx AS ant2,
round(sin(CAST(0.3 AS DOUBLE)) * (b.x - a.x) + cos(CAST(0.3 AS DOUBLE)) * (b.y - a.y), 6) + 0 AS u, round(-sin(CAST(0.7 AS DOUBLE)) * cos(CAST(0.3 AS DOUBLE)) * (b.x - a.x) + sin(CAST(0.7 AS DOUBLE)) * sin(CAST(0.3 AS DOUBLE)) * (b.y - a.y), 6) + 0 AS v, round(cos(CAST(0.7 AS DOUBLE)) * cos(CAST(0.3 AS DOUBLE)) * (b.x - a.x) - cos(CAST(0.7 AS DOUBLE)) * sin(CAST(0.3 AS DOUBLE)) * (b.y - a.y), 6) + 0 AS w
FROM ant a JOIN ant b ON a.idx < b.idx""")
def baseline_uvw(spark, sf_dir):
    return gridding.uvw(gridding.baselines(_antennas(spark, sf_dir)), 0.3, 0.7).select("ant1", "ant2", r6("u").alias("u"), r6("v").alias("v"), r6("w").alias("w"))


@query(f"WITH {_V}, m AS (SELECT l_linenumber, i, j, CAST(l_linenumber % 3 AS INTEGER) AS off, avg(re) AS v FROM vis GROUP BY ALL) SELECT CAST(i - off AS INTEGER) AS i, j, round(avg(v), 9) + 0 AS value FROM m WHERE i - off >= 0 AND i - off < 32 - 2 GROUP BY 1, 2")
def stack_images(spark, sf_dir):
    """Images with offsets 0 to 2 stacked over their common columns."""
    images = _visibilities(spark, sf_dir).groupBy(F.col("l_linenumber").alias("image"), "i", "j", (F.col("l_linenumber") % 3).alias("offset")).agg(F.avg("re").alias("value"))
    return gridding.stack(images, 32).select(F.col("i").cast("int").alias("i"), "j", r9("value").alias("value"))


@query(f"WITH {CUBE} SELECT chan, round(stddev_pop(value), 6) + 0 AS re, round(max(abs(value)), 6) + 0 AS top FROM cube GROUP BY chan")
def channel_noise(spark, sf_dir):
    return cube(spark, sf_dir).groupBy("chan").agg(r6(F.stddev_pop("value")).alias("re"), r6(F.max(F.abs("value"))).alias("top"))


@query(f"WITH {_V} SELECT round(max(sqrt(CAST(i AS DOUBLE) * i + CAST(j AS DOUBLE) * j)), 6) + 0 AS diag, count(DISTINCT i * 32 + j) AS cells FROM vis")
def uv_diagonal(spark, sf_dir):
    v = _visibilities(spark, sf_dir)
    return v.agg(r6(F.max(F.hypot(F.col("i").cast("double"), F.col("j").cast("double")))).alias("diag"), F.countDistinct(F.col("i") * 32 + F.col("j")).alias("cells"))


