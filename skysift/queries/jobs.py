"""Whole jobs: imaging with a search behind it, the periodicity modes, clusters of varying density, trained networks."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from skysift import trials
from skysift.operators import candidates, density, folding, hierarchy, imaging, learned, training
from skysift.plans import offline
from skysift.queries.registry import query, r6, r9, table
from skysift.queries.streams import _arrivals, _by_week
from skysift.streaming import runs

STEPS, SIZE, CHANNELS, PERIODS, WIDTHS = 100, 16, 7, [5, 10, 20, 25], [1, 2, 4]
JOB = offline.Settings(size=SIZE, cell=2.0, samples=trials.SAMPLES, channels=CHANNELS, least_length=1.0, below_length=18.0, flagged_channels=(6,))
TARGETS = [(0, 0.0, 0.0), (1, 0.02, 0.0), (2, 0.0, 0.02), (3, 0.03, -0.01)]


def _vis(spark, sf_dir):
    """Line items as visibilities of 100 samples (ship day) and 7 channels (line number)."""
    day = F.datediff(F.col("l_shipdate").cast("date"), F.lit("1992-01-01").cast("date"))
    return table(spark, sf_dir, "lineitem").select(
        (day % STEPS).alias("t"), (F.col("l_linenumber") - 1).alias("chan"), (F.col("l_suppkey") % 16).cast("int").alias("ant1"), (F.col("l_partkey") % 16).cast("int").alias("ant2"),
        (F.col("l_partkey") % 31 - 15).cast("double").alias("u"), (F.col("l_suppkey") % 29 - 14).cast("double").alias("v"), F.col("l_quantity").alias("re"), (F.col("l_discount") * 100).alias("im"),
    )


def _kept(spark, sf_dir):
    antennas = table(spark, sf_dir, "supplier").select((F.col("s_suppkey") % 16).cast("int").alias("idx")).where("idx in (3, 11)")
    return offline.flagged(_vis(spark, sf_dir), antennas, JOB)


_KEPT = """kept AS (SELECT * FROM (
  SELECT CAST(date_diff('day', DATE '1992-01-01', CAST(l_shipdate AS DATE)) % 100 AS INTEGER) AS t, CAST(l_linenumber - 1 AS INTEGER) AS chan, l_suppkey % 16 AS ant1, l_partkey % 16 AS ant2,
         CAST(l_partkey % 31 - 15 AS DOUBLE) AS u, CAST(l_suppkey % 29 - 14 AS DOUBLE) AS v, l_quantity AS re, l_discount * 100 AS im FROM lineitem)
  WHERE ant1 NOT IN (SELECT s_suppkey % 16 FROM supplier WHERE s_suppkey % 16 IN (3, 11)) AND ant2 NOT IN (SELECT s_suppkey % 16 FROM supplier WHERE s_suppkey % 16 IN (3, 11))
    AND sqrt(u * u + v * v) >= 1 AND sqrt(u * u + v * v) < 18 AND chan <> 6)"""


def _image_sql(kept: str) -> str:
    """Robust weights, both halves of the grid and the transform in two steps, of a table of visibilities."""
    turn = lambda a, b: f"2 * pi() * ({a} - 8) * ({b} - 8) / CAST(16 AS DOUBLE)"
    xs = "(SELECT CAST(b AS INTEGER) AS p FROM range(16) r(b))"
    x, y = turn("c.j", "x.p"), turn("h.i", "y.p")
    return f"""celled AS (SELECT *, CAST(trunc(u / 2 + 8) AS INTEGER) AS i, CAST(trunc(v / 2 + 8) AS INTEGER) AS j FROM {kept}),
many AS (SELECT i, j, CAST(count(*) AS DOUBLE) AS w FROM celled WHERE i BETWEEN 0 AND 15 AND j BETWEEN 0 AND 15 GROUP BY ALL),
raw_ AS (SELECT i, j, w, 1 / (1 + w * (SELECT pow(5 * pow(CAST(10 AS DOUBLE), CAST(-0.5 AS DOUBLE)), CAST(2 AS DOUBLE)) / (sum(w * w) / sum(w)) FROM many)) AS raw FROM many),
weighted AS (SELECT t, chan, c.i, c.j, re * raw / (SELECT sum(raw * w) FROM raw_) AS re, im * raw / (SELECT sum(raw * w) FROM raw_) AS im FROM celled c JOIN raw_ r ON c.i = r.i AND c.j = r.j),
cells AS (SELECT t, chan, i, j, sum(re) AS re, sum(im) AS im FROM (SELECT * FROM weighted UNION ALL SELECT t, chan, CAST(15 - i AS INTEGER), CAST(15 - j AS INTEGER), re, -im FROM weighted) GROUP BY ALL),
half AS (SELECT t, chan, i, x.p AS x, sum(re * cos({x}) - im * sin({x})) AS re, sum(re * sin({x}) + im * cos({x})) AS im FROM cells c, {xs} x GROUP BY ALL),
image AS (SELECT t, chan, y.p AS y, x, sum(re * cos({y}) - im * sin({y})) / 256 * 7 / 6 AS value FROM half h, {xs} y GROUP BY ALL)"""


_SEARCH = """middle AS (SELECT y, x, chan, median(value) AS m FROM image GROUP BY ALL),
raw AS (SELECT CAST(d AS INTEGER) AS dm_idx, CAST(c AS INTEGER) AS chan, CAST(0.5 AS DOUBLE) * d * (6 - c) AS z FROM range(4) a(d), range(7) b(c)),
delays AS (SELECT dm_idx, chan, CAST(floor(z) AS INTEGER) AS shift, 1 - (z - floor(z)) AS weight FROM raw UNION ALL SELECT dm_idx, chan, CAST(ceil(z) AS INTEGER), z - floor(z) FROM raw),
dedisp AS (SELECT y, x, dm_idx, t - shift AS t, sum(weight * (value - m)) AS value FROM image JOIN middle USING (y, x, chan) JOIN delays USING (chan) WHERE weight <> 0 AND t - shift BETWEEN 0 AND 99 GROUP BY ALL),
full_ AS (SELECT k.y, k.x, k.dm_idx, CAST(r.t AS INTEGER) AS t, coalesce(d.value, CAST(0 AS DOUBLE)) AS value FROM (SELECT DISTINCT y, x, dm_idx FROM dedisp) k CROSS JOIN range(100) r(t) LEFT JOIN dedisp d ON d.y = k.y AND d.x = k.x AND d.dm_idx = k.dm_idx AND d.t = r.t),
boxes AS (SELECT y, x, dm_idx, t, w.wid_idx, CASE w.wid_idx WHEN 0 THEN value WHEN 1 THEN s1 ELSE s2 END AS value FROM (SELECT *, sum(value) OVER (PARTITION BY y, x, dm_idx ORDER BY t ROWS 1 PRECEDING) AS s1, sum(value) OVER (PARTITION BY y, x, dm_idx ORDER BY t ROWS 3 PRECEDING) AS s2 FROM full_), (VALUES (CAST(0 AS INTEGER)), (1), (2)) w(wid_idx)),
noise AS (SELECT wid_idx, median(s) AS noise FROM (SELECT wid_idx, y, x, stddev_pop(value) AS s FROM boxes WHERE dm_idx = 0 GROUP BY ALL) GROUP BY wid_idx),
found AS (SELECT b.gulp, y, x, wid_idx, dm_idx, abs((max(value) - median(value)) / any_value(noise)) AS snr, min(t) FILTER (WHERE value = top) AS toa
  FROM (SELECT *, CAST(floor(t / CAST(25 AS DOUBLE)) AS INTEGER) AS gulp, max(value) OVER (PARTITION BY floor(t / CAST(25 AS DOUBLE)), y, x, wid_idx, dm_idx) AS top FROM boxes) b JOIN noise USING (wid_idx) GROUP BY ALL),
placed AS (SELECT *, CAST(row_number() OVER (PARTITION BY gulp ORDER BY snr DESC, y, x, wid_idx, dm_idx) AS INTEGER) AS place FROM found WHERE snr >= 2)"""


@query(f"WITH {_KEPT}, {_image_sql('kept')}, {_SEARCH} SELECT gulp, place, y, x, wid_idx, dm_idx, toa, round(snr, 6) + 0 AS snr FROM placed WHERE place <= 20")
def offline_candidates(spark, sf_dir):
    """From visibilities to the best candidates of each gulp: flags, weights, grid, images, de-dispersion, boxcars, S/N, threshold."""
    delays = trials.linear_delays(spark, 4, CHANNELS, 0.5)
    found = offline.searched(offline.imaged(_kept(spark, sf_dir), JOB), delays, WIDTHS, JOB, STEPS)
    return offline.best_of_gulps(found, 2.0, 20).select("gulp", "place", "y", "x", "wid_idx", "dm_idx", "toa", r6("snr").alias("snr"))


_Z = "(v - median(v) OVER w) / nullif(stddev_pop(v) OVER w, 0)"


@query(f"""WITH {_KEPT}, aims(target, l, m) AS (VALUES {", ".join(f"(CAST({n} AS INTEGER), CAST({a} AS DOUBLE), CAST({b} AS DOUBLE))" for n, a, b in TARGETS)}),
levels AS (SELECT CAST(-1 AS INTEGER) AS target, t, chan, avg(sqrt(re * re + im * im)) AS v FROM kept GROUP BY ALL
  UNION ALL SELECT target, t, chan, sum(re * cos(2 * pi() * (u * l + v * m)) - im * sin(2 * pi() * (u * l + v * m))) FROM kept, aims GROUP BY ALL),
series AS (SELECT target, t, avg(z) AS value FROM (SELECT target, t, {_Z} AS z FROM levels WINDOW w AS (PARTITION BY target, chan, floor(t / CAST(25 AS DOUBLE)))) GROUP BY ALL),
n AS (SELECT target, stddev_pop(value) AS noise FROM series GROUP BY target),
f AS (SELECT target, period, t % period AS phase, avg(value) AS mean FROM series, (VALUES (5), (10), (20), (25)) p(period) GROUP BY ALL)
SELECT target, period, round(max(mean) * sqrt(floor(100 / CAST(period AS DOUBLE))) / nullif(any_value(noise), 0), 6) + 0 AS snr FROM f JOIN n USING (target) GROUP BY target, period""")
def period_beams(spark, sf_dir):
    """Periods of the incoherent series (target -1) and of four beams."""
    kept = _kept(spark, sf_dir)
    aims = spark.createDataFrame(TARGETS, "target int, l double, m double")
    series = offline.incoherent(kept, JOB.samples).withColumn("target", F.lit(-1)).unionByName(offline.beams(kept, aims, JOB.samples))
    return folding.fold(series, PERIODS, STEPS, ["target"]).select("target", "period", r6("snr").alias("snr"))


@query(f"WITH {_KEPT}, {_image_sql('kept')} SELECT y, x, CAST(t % 10 AS INTEGER) AS phase, round(avg(value) * 1000000, 5) + 0 AS value FROM image GROUP BY 1, 2, 3")
def period_image_fold(spark, sf_dir):
    """Images (in millionths) folded at ten samples."""
    return offline.folded_images(offline.imaged(_kept(spark, sf_dir), JOB), 10).select("y", "x", "phase", (F.round(F.col("value") * 1e6, 5) + F.lit(0.0)).alias("value"))


@query(f"WITH {_KEPT}, folded AS (SELECT * REPLACE (CAST(t % 10 AS INTEGER) AS t) FROM kept), {_image_sql('folded')} SELECT y, x, t AS phase, round(sum(value) / (SELECT count(*) FROM folded f WHERE f.t = image.t) * 1000000000, 5) + 0 AS value FROM image GROUP BY y, x, t")
def period_fast_image_fold(spark, sf_dir):
    """Visibilities folded at ten samples before they are imaged; mean images in billionths."""
    return offline.folded_grid(_kept(spark, sf_dir), 10, JOB).select("y", "x", "phase", (F.round(F.col("value") * 1e9, 5) + F.lit(0.0)).alias("value"))


@query(f"""WITH {_KEPT}, {_image_sql('kept')}, series AS (SELECT y, x, t, sum(round(value * 1000000, 9)) AS value FROM image GROUP BY ALL), n AS (SELECT y, x, stddev_pop(value) AS noise FROM series GROUP BY ALL),
f AS (SELECT y, x, period, t % period AS phase, avg(value) AS mean FROM series, (VALUES (5), (10), (20), (25)) p(period) GROUP BY ALL),
s AS (SELECT y, x, period, max(mean) * sqrt(floor(100 / CAST(period AS DOUBLE))) / nullif(any_value(noise), 0) AS snr FROM f JOIN n USING (y, x) GROUP BY y, x, period)
SELECT y, x, period, round(snr, 6) + 0 AS snr FROM s QUALIFY row_number() OVER (PARTITION BY y, x ORDER BY s.snr DESC, period) = 1""")
def period_all_pixels(spark, sf_dir):
    """The best period of every pixel of the image cube, in millionths to 9 places: where mirrored cells cancel, values are 0."""
    image = offline.imaged(_kept(spark, sf_dir), JOB).withColumn("value", F.round(F.col("value") * 1e6, 9))
    return offline.all_pixels(image, PERIODS, STEPS).select("y", "x", "period", r6("snr").alias("snr"))


@query()
def cluster_nested(spark, sf_dir):
    """Embeddings' first four axes, clustered within each label at the density that suits each group."""
    axes = [f"a{k}" for k in range(4)]
    points = table(spark, sf_dir, "embeddings").select("vec_id", "label", *[F.col("embedding")[k].cast("double").alias(a) for k, a in enumerate(axes)])
    return density.nested_clusters(points, "label", axes, "vec_id", [0.2, 0.15, 0.1], 4, 5)


@query()
def cluster_psf(spark, sf_dir):
    """The same under the distance weighted by a point-spread function."""
    axes = [f"a{k}" for k in range(2)]
    points = table(spark, sf_dir, "embeddings").select("vec_id", "label", *[F.col("embedding")[k].cast("double").alias(a) for k, a in enumerate(axes)])
    spread = lambda offsets: 1 + sum(o * o for o in offsets)  # noqa: E731 at least 1: no pair beyond the radius is lost
    return density.nested_clusters(points, "label", axes, "vec_id", [0.06, 0.03], 4, 5, lambda o: density.psf_distance(spread, o))


@query()
def cnn_trained(spark, sf_dir):
    """Fixed filters of a whole 8 x 8 cut-out and a head fitted to whether their upper half is the brighter; rows with crc32(vec_id) mod 5 = 0
    are held out."""
    total = lambda a: F.aggregate(a, F.lit(0.0), lambda s, v: s + v.cast("double"))
    cut = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("cand_id"), F.col("embedding").cast("array<double>").alias("pixels"), (total(F.slice("embedding", 1, 32)) > total(F.slice("embedding", 33, 32))).cast("int").alias("label"))
    filters = np.random.default_rng(3).normal(0, 0.3, (96, 1, 8, 8))
    held = F.crc32(F.col("cand_id").cast("string")) % 5 == 0
    layers = [(filters, np.zeros(96))]
    head = learned.fit_head(cut.where(~held), (1, 8, 8), layers)
    return learned.classify(cut, (1, 8, 8), layers, head).join(cut.select("cand_id", "label", held.alias("held_out")), "cand_id").select("cand_id", "label", "held_out", "prob", "predict")


@query("""SELECT o_orderkey, round(coalesce(q, o_totalprice), 6) + 0 AS o_totalprice, coalesce(n, 0) AS n, CASE WHEN o_orderkey % 3 = 0 THEN 'fit' ELSE '' END AS note FROM orders
LEFT JOIN (SELECT l_orderkey, sum(l_extendedprice) AS q, count(*) AS n FROM lineitem WHERE l_linenumber > 2 GROUP BY 1) ON o_orderkey = l_orderkey""")
def merge_results(spark, sf_dir):
    """Orders with what two later steps found about them."""
    orders, line = table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem").where("l_linenumber > 2")
    first = line.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.sum("l_extendedprice").alias("o_totalprice"), F.count("*").alias("n"))
    second = orders.where("o_orderkey % 3 = 0").select("o_orderkey", F.lit("fit").alias("note"))
    return candidates.merge_results(orders.select("o_orderkey", "o_totalprice"), "o_orderkey", [first, second]).fillna(0, ["n"]).fillna("", ["note"]).select("o_orderkey", r6("o_totalprice").alias("o_totalprice"), "n", "note")


@query("SELECT vec_id, CAST((k - 1) // 8 AS INTEGER) AS y, CAST((k - 1) % 8 AS INTEGER) AS x, round(CAST(embedding[k] AS DOUBLE), 6) + 0 AS value FROM embeddings, range(1, 65) r(k) WHERE k <= len(embedding)")
def image_rows(spark, sf_dir):
    """Images as long rows of their row-major values."""
    return imaging.long_rows(table(spark, sf_dir, "embeddings"), ["vec_id"], "embedding", [8, 8], ["y", "x"]).select("vec_id", "y", "x", r6("value").alias("value"))


@query("""WITH a AS (SELECT floor(epoch_us(ts) / CAST(3600000000 AS DOUBLE)) AS slot, epoch_us(ts) + (event_id % 5) * 420000000 + CASE WHEN event_id % 40 = 0 THEN 108000000000 ELSE 0 END AS us FROM events),
b AS (SELECT least(greatest(floor((us - 1704067200000000) / CAST(604800000000 AS DOUBLE)), 0), 4) AS week, us - CAST(slot + 1 AS BIGINT) * 3600000000 AS wait FROM a)
SELECT CAST(rank() OVER (ORDER BY week) - 1 AS INTEGER) AS batch, n, dropped, longest FROM (SELECT week, count(*) AS n, count(CASE WHEN wait >= 21600000000 THEN 1 END) AS dropped, max(wait) AS longest FROM b GROUP BY week)""")
def stream_metrics(spark, sf_dir):
    """Rows, dropped ones and the longest latency (microseconds after the hour's end) of each micro-batch."""
    hour = 3_600_000_000
    wait = F.unix_micros("arrived") - (F.col("slot") + 1) * hour
    return runs.batch_metrics(_arrivals(spark, sf_dir), _by_week(), [F.count("*").alias("n"), F.count_if(wait >= 6 * hour).alias("dropped"), F.max(wait).alias("longest")]).select("batch", "n", "dropped", "longest")


def _axes(spark, sf_dir, count: int):
    axes = [f"a{k}" for k in range(count)]
    return axes, table(spark, sf_dir, "embeddings").select("vec_id", "label", *[F.col("embedding")[k].cast("double").alias(a) for k, a in enumerate(axes)])


@query()
def cluster_hierarchy(spark, sf_dir):
    """Embeddings' first four axes, clustered within each label by the stability of their whole density hierarchy."""
    axes, points = _axes(spark, sf_dir, 4)
    return hierarchy.clusters(points, "label", axes, "vec_id", 5)


@query()
def cluster_hierarchy_rounds(spark, sf_dir):
    """The same on two axes, and again on what is noise with smaller clusters."""
    axes, points = _axes(spark, sf_dir, 2)
    return hierarchy.rounds(points, "label", axes, "vec_id", 12, 3)


@query()
def cluster_hierarchy_psf(spark, sf_dir):
    """The same on two axes under the distance weighted by a point-spread function that grows with the offset."""
    axes, points = _axes(spark, sf_dir, 2)

    def weighted(p: np.ndarray, others: np.ndarray) -> np.ndarray:
        d = hierarchy.euclid(p, others)
        return d * (1 + d * d)

    return hierarchy.clusters(points, "label", axes, "vec_id", 5, metric=weighted)


@query("""WITH p AS (SELECT label, vec_id, CAST(embedding[1] AS DOUBLE) AS x, CAST(embedding[2] AS DOUBLE) AS y FROM embeddings),
d AS (SELECT a.label, a.vec_id, sqrt((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y)) AS d FROM p a JOIN p b ON a.label = b.label AND a.vec_id <> b.vec_id)
SELECT label, vec_id, round(d, 9) + 0 AS core FROM d QUALIFY row_number() OVER (PARTITION BY label, vec_id ORDER BY d.d) = 2""")
def core_distances(spark, sf_dir):
    """The distance of each point to its second neighbour within the label."""
    axes, points = _axes(spark, sf_dir, 2)
    return hierarchy.core_of_points(points, "label", axes, "vec_id", 2).select("label", "vec_id", r9("core").alias("core"))


def _learned(spark, sf_dir, network: training.Network, rounds: int):
    """A network trained on whether the upper half of a cut-out is the brighter; rows with crc32(vec_id) mod 5 = 0 are held out."""
    total = lambda a: F.aggregate(a, F.lit(0.0), lambda s, v: s + v.cast("double"))
    label = (total(F.slice("embedding", 1, 32)) > total(F.slice("embedding", 33, 32))).cast("int")
    held = F.crc32(F.col("vec_id").cast("string")) % 5 == 0
    cut = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("cand_id"), F.col("embedding").alias("pixels"), label.alias("label"), held.alias("held_out"))
    weights, _ = training.train(cut.where(~F.col("held_out")), network, rounds)
    return training.classify(cut, network, weights).join(cut.select("cand_id", "label", "held_out"), "cand_id").select("cand_id", "label", "held_out", "prob", "predict")


@query()
def cnn_learned(spark, sf_dir):
    """A 2-D network over 8 x 8 cut-outs, all its layers trained."""
    return _learned(spark, sf_dir, training.Network((1, 8, 8), ((6, 3, 3),), 3), 30)


@query()
def cnn_learned_3d(spark, sf_dir):
    """A 3-D network of two layers over 4 x 4 x 4 cut-outs, all its layers trained."""
    return _learned(spark, sf_dir, training.Network((1, 4, 4, 4), ((4, 2, 2, 2), (4, 2, 1, 1)), 1), 30)
