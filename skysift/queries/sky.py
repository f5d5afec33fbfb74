"""Apparent places, baselines and fringes of a date."""

from __future__ import annotations

from pyspark.sql import functions as F

from skysift.functions import apparent
from skysift.functions.sky import LONGITUDE
from skysift.operators import gridding
from skysift.queries.flagging import _ANT, _antennas
from skysift.queries.registry import query, r6, table
from skysift.stored import materialize


def _r5(c):
    """Rounded to 5 places: a turn of the sky is kept to some 1e-13 of itself."""
    return F.round(c, 5) + F.lit(0.0)


def _poly(coefficients, t="t"):
    return "(" + " + ".join(f"CAST({c!r} AS DOUBLE) * pow({t}, {n})" for n, c in enumerate(coefficients)) + ")"


_NUT = "nut(kd, km, kmp, kf, ko, s0, s1, c0, c1) AS (VALUES " + ", ".join("(" + ", ".join(f"CAST({v} AS DOUBLE)" for v in row) + ")" for row in apparent.NUTATION) + ")"


def _earth(times: str) -> str:
    """SQL of `earth` (mjd, t, psi, eps, e, sun, lst) for a table `times` (mjd)."""
    args = ", ".join(f"{_poly(c)} AS {k}" for k, c in apparent.ARGUMENTS.items())
    terms = "radians(kd * d + km * m + kmp * mp + kf * f + ko * o)"
    anomaly = f"radians({_poly(apparent.ANOMALY)})"
    sun = f"{_poly(apparent.SUN)} + " + " + ".join(f"{_poly(c)} * sin({n + 1} * {anomaly})" for n, c in enumerate(apparent.CENTRE))
    return f"""{_NUT}, args AS (SELECT mjd, t, {args} FROM (SELECT DISTINCT mjd, (mjd - CAST(51544.5 AS DOUBLE)) / 36525 AS t FROM {times})),
sums AS (SELECT mjd, any_value(t) AS t, sum((s0 + s1 * t) * sin({terms})) / 36000000 AS psi, sum((c0 + c1 * t) * cos({terms})) / 36000000 AS eps FROM args, nut GROUP BY mjd),
earth AS (SELECT mjd, t, psi, eps, radians({_poly(apparent.OBLIQUITY)} / 3600 + eps) AS e, radians({sun}) AS sun,
  CAST(280.46061837 AS DOUBLE) + 360 * (mjd - CAST(51544.5 AS DOUBLE) - floor(mjd - CAST(51544.5 AS DOUBLE))) + CAST(0.98564736629 AS DOUBLE) * (mjd - CAST(51544.5 AS DOUBLE)) + CAST(0.000387933 AS DOUBLE) * t * t - pow(t, 3) / 38710000 + psi * cos(radians({_poly(apparent.OBLIQUITY)} / 3600 + eps)) + CAST({LONGITUDE} AS DOUBLE) AS lst FROM sums)"""


def _place(places: str) -> str:
    """SQL of `place` (all columns of the table `places` with mjd, ra, dec; app_a and app_d in radians) beside `earth`."""
    k = f"radians(CAST({apparent.ABERRATION} AS DOUBLE) / 3600)"
    far, ecc = f"radians({_poly(apparent.PERIHELION)})", _poly(apparent.ECCENTRICITY)
    along_a = lambda x: f"(cos(a) * cos({x}) * cos(e) + sin(a) * sin({x})) / cos(d)"
    along_d = lambda x: f"(cos({x}) * cos(e) * (tan(e) * cos(d) - sin(a) * sin(d)) + cos(a) * sin(d) * sin({x}))"
    return f"""turned AS (SELECT p.*, e.* EXCLUDE (mjd), radians(ra + {_poly(apparent.ZETA)} / 3600) AS a0, radians(dec) AS d0, radians({_poly(apparent.THETA)} / 3600) AS th FROM {places} p JOIN earth e USING (mjd)),
mean AS (SELECT *, atan2(cos(d0) * sin(a0), cos(th) * cos(d0) * cos(a0) - sin(th) * sin(d0)) + radians({_poly(apparent.Z)} / 3600) AS a, asin(sin(th) * cos(d0) * cos(a0) + cos(th) * sin(d0)) AS d FROM turned),
place AS (SELECT *, a + radians((cos(e) + sin(e) * sin(a) * tan(d)) * psi - cos(a) * tan(d) * eps) - {k} * {along_a("sun")} + {ecc} * {k} * {along_a(far)} AS app_a,
  d + radians(sin(e) * cos(a) * psi + sin(a) * eps) - {k} * {along_d("sun")} + {ecc} * {k} * {along_d(far)} AS app_d FROM mean)"""


def _with_earth(times):
    """Distinct times with `earth`, stored: their series are summed once a time."""
    return materialize(apparent.with_earth(times.distinct(), "mjd"), "earth")


@query(f"""WITH p AS (SELECT c_custkey, CAST(50000 + c_custkey % 14000 AS DOUBLE) + CAST(0.25 AS DOUBLE) AS mjd, CAST((c_custkey * 37) % 360 AS DOUBLE) AS ra, CAST((c_custkey * 53) % 120 - 40 AS DOUBLE) AS dec FROM customer),
{_earth("p")}, {_place("p")} SELECT c_custkey, round((degrees(app_a) % 360 + 360) % 360, 6) + 0 AS ra, round(degrees(app_d), 6) + 0 AS dec FROM place""")
def apparent_place(spark, sf_dir):
    """J2000 places at the dates of their rows."""
    p = table(spark, sf_dir, "customer").select("c_custkey", (F.lit(50000.25) + F.col("c_custkey") % 14000).alias("mjd"), ((F.col("c_custkey") * 37) % 360).cast("double").alias("ra"), ((F.col("c_custkey") * 53) % 120 - 40).cast("double").alias("dec"))
    out = apparent.with_apparent(p.join(_with_earth(p.select("mjd")), "mjd"), "ra", "dec")
    return out.select("c_custkey", r6("apparent_ra").alias("ra"), r6("apparent_dec").alias("dec"))


@query(f"WITH p AS (SELECT DISTINCT CAST(51000 + o_orderkey % 10000 AS DOUBLE) AS mjd FROM orders), {_earth('p')} SELECT mjd, round((lst % 360 + 360) % 360, 7) + 0 AS lst, round(psi * 3600, 6) + 0 AS psi, round(eps * 3600, 6) + 0 AS eps FROM earth")
def apparent_sidereal(spark, sf_dir):
    """Local apparent sidereal time, and the nutation in arcseconds, of each date."""
    e = _with_earth(table(spark, sf_dir, "orders").select((F.lit(51000.0) + F.col("o_orderkey") % 10000).alias("mjd")))
    return e.select("mjd", (F.round("earth.lst", 7) + F.lit(0.0)).alias("lst"), r6(F.col("earth.psi") * 3600).alias("psi"), r6(F.col("earth.eps") * 3600).alias("eps"))


_UVW = f"""WITH {_ANT}, p AS (SELECT n_nationkey, CAST(60000 AS DOUBLE) + n_nationkey * CAST(0.375 AS DOUBLE) AS mjd, CAST(83.6332 AS DOUBLE) AS ra, CAST(22.0145 AS DOUBLE) AS dec FROM nation),
{_earth("p")}, {_place("p")}, bl AS (SELECT a.idx AS ant1, b.idx AS ant2, (b.x - a.x) / 1000 AS x, (b.y - a.y) / 1000 AS y FROM ant a JOIN ant b ON a.idx < b.idx),
uvw AS (SELECT n_nationkey AS step, ant1, ant2, sin(h) * x + cos(h) * y AS u, -sin(app_d) * cos(h) * x + sin(app_d) * sin(h) * y AS v, cos(app_d) * cos(h) * x - cos(app_d) * sin(h) * y AS w FROM (SELECT *, radians(lst) - app_a AS h FROM place), bl)"""


def _uvw(spark, sf_dir):
    """u, v and w in metres of all baselines at 25 times toward one place."""
    times = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("step"), (F.lit(60000.0) + F.col("n_nationkey") * 0.375).alias("mjd"), F.lit(83.6332).alias("ra"), F.lit(22.0145).alias("dec"))
    aimed = apparent.with_apparent(times.join(_with_earth(times.select("mjd")), "mjd"), "ra", "dec")
    pairs = gridding.baselines(_antennas(spark, sf_dir)).withColumns({c: F.col(c) / 1000 for c in "xyz"})
    return apparent.with_uvw(pairs.join(F.broadcast(aimed)))  # one row a nation


@query(f"{_UVW} SELECT step, ant1, ant2, round(u, 5) + 0 AS u, round(v, 5) + 0 AS v, round(w, 5) + 0 AS w FROM uvw")
def apparent_uvw(spark, sf_dir):
    return _uvw(spark, sf_dir).select("step", "ant1", "ant2", *[_r5(c).alias(c) for c in "uvw"])


@query(f"{_UVW} SELECT step, ant1, ant2, CAST(c.c AS INTEGER) AS chan, round(cos(2 * pi() * w * (CAST(1.3 AS DOUBLE) + c.c * CAST(0.03125 AS DOUBLE)) / CAST(0.299792458 AS DOUBLE)), 5) + 0 AS re, round(-sin(2 * pi() * w * (CAST(1.3 AS DOUBLE) + c.c * CAST(0.03125 AS DOUBLE)) / CAST(0.299792458 AS DOUBLE)), 5) + 0 AS im FROM uvw, range(8) c(c)")
def fringe_table(spark, sf_dir):
    """The factors that stop the fringes of each time, baseline and channel."""
    chans = _uvw(spark, sf_dir).withColumn("chan", F.explode(F.sequence(F.lit(0), F.lit(7))))
    f = apparent.fringe(F.col("w"), F.lit(1.3) + F.col("chan") * 0.03125)
    return chans.select("step", "ant1", "ant2", "chan", f.alias("f")).select("step", "ant1", "ant2", "chan", _r5("f.re").alias("re"), _r5("f.im").alias("im"))
