"""Apparent places: precession, nutation, aberration and apparent sidereal time as column expressions. Angles in degrees.

Series of J. Meeus, Astronomical Algorithms (2nd edition): precession of IAU 1976, the 22 largest terms of the IAU 1980 nutation,
annual aberration with the eccentricity of the orbit. Good to some 0.05 arcseconds within a few decades of 2000; proper
motion, parallax, refraction and the light's bending are left out. Times count as both UT1 and dynamical time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skysift.functions.sky import LONGITUDE

# Multiples of D, M, M', F and the node; sine coefficient of the longitude and its change a century, cosine
# coefficient of the obliquity and its change; in ten-thousandths of an arcsecond.
NUTATION = [
    (0, 0, 0, 0, 1, -171996, -174.2, 92025, 8.9),
    (-2, 0, 0, 2, 2, -13187, -1.6, 5736, -3.1),
    (0, 0, 0, 2, 2, -2274, -0.2, 977, -0.5),
    (0, 0, 0, 0, 2, 2062, 0.2, -895, 0.5),
    (0, 1, 0, 0, 0, 1426, -3.4, 54, -0.1),
    (0, 0, 1, 0, 0, 712, 0.1, -7, 0),
    (-2, 1, 0, 2, 2, -517, 1.2, 224, -0.6),
    (0, 0, 0, 2, 1, -386, -0.4, 200, 0),
    (0, 0, 1, 2, 2, -301, 0, 129, -0.1),
    (-2, -1, 0, 2, 2, 217, -0.5, -95, 0.3),
    (-2, 0, 1, 0, 0, -158, 0, 0, 0),
    (-2, 0, 0, 2, 1, 129, 0.1, -70, 0),
    (0, 0, -1, 2, 2, 123, 0, -53, 0),
    (2, 0, 0, 0, 0, 63, 0, 0, 0),
    (0, 0, 1, 0, 1, 63, 0.1, -33, 0),
    (2, 0, -1, 2, 2, -59, 0, 26, 0),
    (0, 0, -1, 0, 1, -58, -0.1, 32, 0),
    (0, 0, 1, 2, 1, -51, 0, 27, 0),
    (-2, 0, 2, 0, 0, 48, 0, 0, 0),
    (0, 0, -2, 2, 1, 46, 0, -24, 0),
    (2, 0, 0, 2, 2, -38, 0, 16, 0),
    (0, 0, 2, 2, 2, -31, 0, 13, 0),
]
#: Polynomials in centuries from J2000, constant first. Arguments of the nutation in degrees.
ARGUMENTS = {
    "d": (297.85036, 445267.111480, -0.0019142, 1 / 189474),
    "m": (357.52772, 35999.050340, -0.0001603, -1 / 300000),
    "mp": (134.96298, 477198.867398, 0.0086972, 1 / 56250),
    "f": (93.27191, 483202.017538, -0.0036825, 1 / 327270),
    "o": (125.04452, -1934.136261, 0.0020708, 1 / 450000),
}
#: Fixed values in arcseconds: the mean obliquity, and the three angles of precession from J2000.
OBLIQUITY = (84381.448, -46.8150, -0.00059, 0.001813)
ZETA, Z, THETA = (0, 2306.2181, 0.30188, 0.017998), (0, 2306.2181, 1.09468, 0.018203), (0, 2004.3109, -0.42665, -0.041833)
#: Fixed values in degrees: the Sun's mean longitude and anomaly, its equation of the centre, the orbit's eccentricity and perihelion, the constant of aberration in arcseconds.
SUN, ANOMALY = (280.46646, 36000.76983, 0.0003032), (357.52911, 35999.05029, -0.0001537)
CENTRE = ((1.914602, -0.004817, -0.000014), (0.019993, -0.000101), (0.000289,))
ECCENTRICITY, PERIHELION, ABERRATION = (0.016708634, -0.000042037, -0.0000001267), (102.93735, 1.71946, 0.00046), 20.49552


def _poly(coefficients: tuple, t: Column) -> Column:
    out = F.lit(float(coefficients[-1]))
    for c in reversed(coefficients[:-1]):
        out = out * t + float(c)
    return out


def centuries(mjd: Column) -> Column:
    return (mjd - 51544.5) / 36525.0


def nutation(t: Column) -> tuple[Column, Column]:
    """Nutation in longitude and in obliquity, in degrees."""
    angles = [_poly(ARGUMENTS[k], t) for k in ("d", "m", "mp", "f", "o")]
    psi, eps = F.lit(0.0), F.lit(0.0)
    for *multiples, s0, s1, c0, c1 in NUTATION:
        at = F.radians(sum((k * a for k, a in zip(multiples, angles, strict=True) if k), F.lit(0.0)))
        psi = psi + (s0 + s1 * t) * F.sin(at)
        eps = eps + (c0 + c1 * t) * F.cos(at)
    return psi / 36e6, eps / 36e6


def with_earth(df: DataFrame, mjd: str) -> DataFrame:
    """df with what a time alone decides, as the struct `earth`: t, psi and eps (nutation), e0 (mean obliquity), sun (true longitude), and
    lst, the local apparent sidereal time at the site. Join it to rows of that time, so that it is made once a time."""
    t = centuries(F.col(mjd))
    psi, eps = nutation(F.col("__t"))
    anomaly = F.radians(_poly(ANOMALY, F.col("__t")))
    sun = _poly(SUN, F.col("__t")) + sum((_poly(c, F.col("__t")) * F.sin((n + 2) * anomaly) for n, c in enumerate(CENTRE[1:])), _poly(CENTRE[0], F.col("__t")) * F.sin(anomaly))
    days = F.col(mjd) - 51544.5
    mean = 280.46061837 + 360.0 * (days - F.floor(days)) + 0.98564736629 * days + 0.000387933 * F.col("__t") * F.col("__t") - F.pow("__t", F.lit(3.0)) / 38710000
    out = df.withColumn("__t", t).withColumns({"__psi": psi, "__eps": eps, "__e0": _poly(OBLIQUITY, F.col("__t")) / 3600, "__sun": F.pmod(sun, F.lit(360.0))})
    lst = F.pmod(mean + F.col("__psi") * F.cos(F.radians(F.col("__e0") + F.col("__eps"))) + LONGITUDE, F.lit(360.0))
    return out.withColumn("earth", F.struct(F.col("__t").alias("t"), F.col("__psi").alias("psi"), F.col("__eps").alias("eps"), F.col("__e0").alias("e0"), F.col("__sun").alias("sun"), lst.alias("lst"))).drop("__t", "__psi", "__eps", "__e0", "__sun")


def precessed(ra: Column, dec: Column, t: Column) -> tuple[Column, Column]:
    """The mean place of the date of a J2000 place."""
    a, d, theta = F.radians(ra + _poly(ZETA, t) / 3600), F.radians(dec), F.radians(_poly(THETA, t) / 3600)
    x = F.cos(theta) * F.cos(d) * F.cos(a) - F.sin(theta) * F.sin(d)
    up = F.sin(theta) * F.cos(d) * F.cos(a) + F.cos(theta) * F.sin(d)
    return F.pmod(F.degrees(F.atan2(F.cos(d) * F.sin(a), x)) + _poly(Z, t) / 3600, F.lit(360.0)), F.degrees(F.asin(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), up))))


def corrections(ra: Column, dec: Column, earth: Column) -> tuple[Column, Column]:
    """What nutation and aberration add to a mean place of the date. Not for places within a degree of a pole."""
    a, d, e, sun = F.radians(ra), F.radians(dec), F.radians(earth["e0"] + earth["eps"]), F.radians(earth["sun"])
    far, lag = F.radians(_poly(PERIHELION, earth["t"])), _poly(ECCENTRICITY, earth["t"])
    turn_a = (F.cos(e) + F.sin(e) * F.sin(a) * F.tan(d)) * earth["psi"] - F.cos(a) * F.tan(d) * earth["eps"]
    turn_d = F.sin(e) * F.cos(a) * earth["psi"] + F.sin(a) * earth["eps"]
    k = ABERRATION / 3600
    along_a = lambda x: (F.cos(a) * F.cos(x) * F.cos(e) + F.sin(a) * F.sin(x)) / F.cos(d)
    along_d = lambda x: F.cos(x) * F.cos(e) * (F.tan(e) * F.cos(d) - F.sin(a) * F.sin(d)) + F.cos(a) * F.sin(d) * F.sin(x)
    return turn_a - k * along_a(sun) + lag * k * along_a(far), turn_d - k * along_d(sun) + lag * k * along_d(far)


def with_apparent(df: DataFrame, ra: str, dec: str) -> DataFrame:
    """df (with `earth`) with apparent_ra and apparent_dec of J2000 places."""
    mean_a, mean_d = precessed(F.col(ra), F.col(dec), F.col("earth.t"))
    out = df.withColumns({"__ra": mean_a, "__dec": mean_d})
    more_a, more_d = corrections(F.col("__ra"), F.col("__dec"), F.col("earth"))
    return out.withColumns({"apparent_ra": F.pmod(F.col("__ra") + more_a, F.lit(360.0)), "apparent_dec": F.col("__dec") + more_d}).drop("__ra", "__dec")


def with_uvw(df: DataFrame) -> DataFrame:
    """df (earth, apparent_ra, apparent_dec, and x, y, z of a baseline along the equator, east of it and the pole) with u, v and w."""
    h, d = F.radians(F.col("earth.lst") - F.col("apparent_ra")), F.radians("apparent_dec")
    x, y, z = F.col("x"), F.col("y"), F.col("z")
    return df.withColumns({
        "u": F.sin(h) * x + F.cos(h) * y,
        "v": -F.sin(d) * F.cos(h) * x + F.sin(d) * F.sin(h) * y + F.cos(d) * z,
        "w": F.cos(d) * F.cos(h) * x - F.cos(d) * F.sin(h) * y + F.sin(d) * z,
    })


def fringe(w: Column, ghz: Column) -> Column:
    """The factor that stops a baseline's fringe: exp(-2 pi i w / wavelength), w in metres."""
    turns = -w * ghz / 0.299792458
    angle = F.radians((turns - F.floor(turns)) * 360.0)
    return F.struct(F.cos(angle).alias("re"), F.sin(angle).alias("im"))
