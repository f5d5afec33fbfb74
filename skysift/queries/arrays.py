"""Queries of the array operators; those without SQL are held against NumPy in the tests."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from skysift.operators import fitting, gridding, imaging, learned
from skysift.queries.flagging import _visibilities
from skysift.queries.registry import query, r6, r9, table


def _grid(spark, sf_dir):
    v = _visibilities(spark, sf_dir)
    return gridding.grid(v, "i", "j", 32, ["l_linenumber"])


_CELLS = """vis AS (SELECT l_linenumber, CAST(l_partkey % 32 AS INTEGER) AS i, CAST(l_suppkey % 32 AS INTEGER) AS j, l_quantity AS re, l_discount AS im FROM lineitem),
cells AS (SELECT l_linenumber, i, j, sum(re) AS re, sum(im) AS im FROM (SELECT * FROM vis UNION ALL SELECT l_linenumber, CAST(31 - i AS INTEGER), CAST(31 - j AS INTEGER), re, -im FROM vis) GROUP BY ALL)"""
_ALL_CELLS = "k AS (SELECT l_linenumber, CAST(a.a AS INTEGER) AS i, CAST(b.b AS INTEGER) AS j FROM (SELECT DISTINCT l_linenumber FROM cells), range(32) a(a), range(32) b(b))"


@query(f"""WITH {_CELLS}, {_ALL_CELLS}, half AS (SELECT l_linenumber, i, x.j AS x, sum(re * cos(2 * pi() * (c.j - 16) * (x.j - 16) / 32) - im * sin(2 * pi() * (c.j - 16) * (x.j - 16) / 32)) AS re,
sum(re * sin(2 * pi() * (c.j - 16) * (x.j - 16) / 32) + im * cos(2 * pi() * (c.j - 16) * (x.j - 16) / 32)) AS im FROM cells c, (SELECT CAST(b AS INTEGER) AS j FROM range(32) r(b)) x GROUP BY ALL)
SELECT l_linenumber, CAST(y.j AS INTEGER) AS y, x, round(sum(re * cos(2 * pi() * (i - 16) * (y.j - 16) / 32) - im * sin(2 * pi() * (i - 16) * (y.j - 16) / 32)), 6) + 0 AS value
FROM half, (SELECT CAST(b AS INTEGER) AS j FROM range(32) r(b)) y GROUP BY ALL""")
def fft_image(spark, sf_dir):
    """One dirty image for each line number, as a proxy of time; in units of a cell's share, so that no value ends in a 5 at the seventh place."""
    return imaging.dirty_image(_grid(spark, sf_dir), ["l_linenumber"], 32).select("l_linenumber", "y", "x", r6(F.col("value") * 1024).alias("value"))


@query(f"""WITH {_CELLS}, {_ALL_CELLS} SELECT k.l_linenumber, k.i, k.j, round((coalesce(p.re, 0) + coalesce(q.re, 0)) / CAST(2 AS DOUBLE), 6) + 0 AS re, round((coalesce(p.im, 0) - coalesce(q.im, 0)) / CAST(2 AS DOUBLE), 6) + 0 AS im
FROM k LEFT JOIN cells p ON p.l_linenumber = k.l_linenumber AND p.i = k.i AND p.j = k.j
LEFT JOIN cells q ON q.l_linenumber = k.l_linenumber AND q.i = (32 - k.i) % 32 AND q.j = (32 - k.j) % 32""")
def fft_inverse(spark, sf_dir):
    """The grid got back from its image: the part of it that a real image holds."""
    back = imaging.to_cells(imaging.dirty_image(_grid(spark, sf_dir), ["l_linenumber"], 32), ["l_linenumber"], 32)
    return back.select("l_linenumber", "i", "j", r6("re").alias("re"), r6("im").alias("im"))


@query("SELECT l_linenumber, round(sum(l_quantity * cos(2 * pi() * (l_partkey % 10) * (sqrt(CAST(1 - 0.01 - 0.04 AS DOUBLE)) - 1)) - l_discount * sin(2 * pi() * (l_partkey % 10) * (sqrt(CAST(1 - 0.01 - 0.04 AS DOUBLE)) - 1))), 5) + 0 AS value FROM lineitem GROUP BY 1")
def wstack(spark, sf_dir):
    v = _visibilities(spark, sf_dir).withColumns({"w": (F.col("l_partkey") % 10).cast("double"), "l": F.lit(0.1), "m": F.lit(0.2)})
    return imaging.w_stack(v, ["l_linenumber"]).select("l_linenumber", (F.round("value", 5) + F.lit(0.0)).alias("value"))


def _image(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").groupBy((F.col("l_suppkey") % 16).cast("int").alias("y"), (F.col("l_partkey") % 16).cast("int").alias("x")).agg(F.avg("l_quantity").alias("value"))


_IMG = "img AS (SELECT CAST(l_suppkey % 16 AS INTEGER) AS y, CAST(l_partkey % 16 AS INTEGER) AS x, avg(l_quantity) AS value FROM lineitem GROUP BY ALL)"


@query(f"""WITH {_IMG}, ax AS (SELECT CAST(o.o AS INTEGER) AS o, CAST(floor(o.o * CAST(15 AS DOUBLE) / 7) + d.d AS INTEGER) AS i, abs(1 - d.d - (o.o * CAST(15 AS DOUBLE) / 7 - floor(o.o * CAST(15 AS DOUBLE) / 7))) AS w FROM range(8) o(o), range(2) d(d))
SELECT a.o AS y, b.o AS x, round(sum(value * a.w * b.w), 6) + 0 AS value FROM img JOIN ax a ON img.y = a.i JOIN ax b ON img.x = b.i GROUP BY 1, 2""")
def resize_image(spark, sf_dir):
    return imaging.resize(_image(spark, sf_dir), [], 16, 8).select("y", "x", r6("value").alias("value"))


@query(f"WITH {_IMG}, m AS (SELECT sum(value * x) / sum(value) AS x, sum(value * y) / sum(value) AS y, sum(value * x * x) / sum(value) AS xx, sum(value * y * y) / sum(value) AS yy, sum(value * x * y) / sum(value) AS xy FROM img), e AS (SELECT *, xx - x * x AS a, yy - y * y AS b, xy - x * y AS c FROM m) SELECT round(x, 6) + 0 AS x, round(y, 6) + 0 AS y, round(sqrt((a + b) / 2 + sqrt(pow((a - b) / 2, 2) + c * c)), 6) + 0 AS major, round(sqrt((a + b) / 2 - sqrt(pow((a - b) / 2, 2) + c * c)), 6) + 0 AS minor FROM e")
def ellipse_moments(spark, sf_dir):
    return imaging.moments(_image(spark, sf_dir), []).select(*[r6(c).alias(c) for c in ("x", "y", "major", "minor")])


@query(f"WITH {_IMG}, k(dy, dx, psf) AS (VALUES (CAST(0 AS INTEGER), CAST(0 AS INTEGER), CAST(1 AS DOUBLE)), (0, 1, 0.5), (0, -1, 0.5), (1, 0, 0.5), (-1, 0, 0.5)) SELECT i.y, i.x, round(sum(n.value * psf), 6) + 0 AS value FROM img i, k JOIN img n ON n.y = i.y + dy AND n.x = i.x + dx GROUP BY i.y, i.x")
def psf_filter(spark, sf_dir):
    psf = spark.createDataFrame([(0, 0, 1.0), (0, 1, 0.5), (0, -1, 0.5), (1, 0, 0.5), (-1, 0, 0.5)], "dy int, dx int, psf double")
    return imaging.matched_filter(_image(spark, sf_dir), psf, []).select("y", "x", r6("value").alias("value"))


@query()
def cluster_density(spark, sf_dir):
    """Embeddings' first four axes, clustered within each label."""
    axes = [f"a{k}" for k in range(4)]
    points = table(spark, sf_dir, "embeddings").select("vec_id", "label", *[F.col("embedding")[k].cast("double").alias(a) for k, a in enumerate(axes)])
    return learned.cluster(points, "label", axes, "vec_id", 0.15, 4)


@query()
def cluster_rounds(spark, sf_dir):
    axes = [f"a{k}" for k in range(4)]
    points = table(spark, sf_dir, "embeddings").select("vec_id", "label", *[F.col("embedding")[k].cast("double").alias(a) for k, a in enumerate(axes)])
    return learned.iterate_clusters(points, "label", axes, "vec_id", 0.15, 6)


def _weights(seed: int, shape: tuple[int, ...]):
    r = np.random.default_rng(seed)
    return [(r.normal(0, 0.3, shape), np.zeros(shape[0]))], (r.normal(0, 1, shape[0]), 0.0)


@query()
def cnn_score(spark, sf_dir):
    """A 2-D network with fixed weights over 8 x 8 cut-outs made of the embeddings."""
    cut = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("cand_id"), F.col("embedding").cast("array<double>").alias("pixels"))
    return learned.classify(cut, (1, 8, 8), *_weights(1, (4, 1, 3, 3))).select("cand_id", r9("prob").alias("prob"), "predict")


@query()
def cnn_two_stage(spark, sf_dir):
    """A 2-D and a 3-D network combined."""
    cut = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("cand_id"), F.col("embedding").cast("array<double>").alias("pixels"))
    flat, deep = learned.classify(cut, (1, 8, 8), *_weights(1, (4, 1, 3, 3))), learned.classify(cut, (1, 4, 4, 4), *_weights(2, (3, 1, 2, 2, 2)))
    return learned.two_stage(flat, deep).select("cand_id", r9("prob").alias("prob"), "predict")


_ELLIPSE = "e AS (SELECT s_suppkey, 2 + s_suppkey % 7 + CAST(0.5 AS DOUBLE) AS a, 1 + s_suppkey % 2 + CAST(0.25 AS DOUBLE) AS b, (s_suppkey % 11) * CAST(0.25 AS DOUBLE) AS t FROM supplier)"


@query(f"""WITH {_ELLIPSE} SELECT s_suppkey, CAST(k.k AS INTEGER) AS k, round(a * b / sqrt(b * b * pow(cos(k.k * pi() / 8 - t), 2) + a * a * pow(sin(k.k * pi() / 8 - t), 2)), 6) + 0 AS radius,
round(a * a * cos(t) * cos(t) + b * b * sin(t) * sin(t), 6) + 0 AS xx, round((a * a - b * b) * sin(t) * cos(t), 6) + 0 AS xy FROM e, range(16) k(k)""")
def ellipse_edges(spark, sf_dir):
    """Edges of ellipses in sixteen directions, and their covariances."""
    n = F.col("s_suppkey")
    e = table(spark, sf_dir, "supplier").select(n, (2.5 + n % 7).alias("a"), (1.25 + n % 2).alias("b"), ((n % 11) * 0.25).alias("t"), F.explode(F.sequence(F.lit(0), F.lit(15))).alias("k"))
    xx, _, xy = fitting.covariance(F.col("a"), F.col("b"), F.col("t"))
    return e.select(n, "k", r6(fitting.ellipse_radius(F.col("k") * np.pi / 8, F.col("a"), F.col("b"), F.col("t"))).alias("radius"), r6(xx).alias("xx"), r6(xy).alias("xy"))


@query()
def ellipse_fits(spark, sf_dir):
    """Elliptical Gaussians fitted to the two-dimensional histograms of neighbouring components of the embeddings."""
    cell = lambda k: F.floor(F.get("embedding", k).cast("double") * 25).cast("int")
    pair = F.explode(F.sequence(F.lit(0), F.lit(31))).alias("pair")
    points = table(spark, sf_dir, "embeddings").select("embedding", pair).select("pair", cell(2 * F.col("pair")).alias("x"), cell(2 * F.col("pair") + 1).alias("y")).where("x between -15 and 15 and y between -15 and 15")
    counts = points.groupBy("pair", "x", "y").agg(F.count("*").alias("n"))
    axis = F.sequence(F.lit(-15), F.lit(15))
    grid = points.select("pair").distinct().select("pair", F.explode(axis).alias("x")).select("pair", "x", F.explode(axis).alias("y"))
    return fitting.fit_ellipses(grid.join(counts, ["pair", "x", "y"], "left").select("pair", "x", "y", F.coalesce("n", F.lit(0)).alias("value")), ["pair"])
