"""Published worked examples of apparent places."""

import math

import pytest
from pyspark.sql import functions as F

from skysift.functions import apparent
from skysift.functions.sky import LONGITUDE


def earth(spark, mjd):
    return apparent.with_earth(spark.createDataFrame([(mjd,)], "mjd double"), "mjd")


def test_nutation_and_sidereal_time(spark):
    """1987 April 10, 0h: nutation -3.788 and +9.443 arcseconds, mean obliquity 23d26m27.407s, sidereal times at Greenwich
    13h10m46.3668s (mean) and 13h10m46.1351s (apparent)."""
    r = earth(spark, 46895.0).first().earth
    assert r.psi * 3600 == pytest.approx(-3.788, abs=0.01) and r.eps * 3600 == pytest.approx(9.443, abs=0.01)
    assert r.e0 == pytest.approx(23 + 26 / 60 + 27.407 / 3600, abs=1e-6)
    greenwich = (r.lst - LONGITUDE) % 360
    assert greenwich / 15 == pytest.approx(13 + 10 / 60 + 46.1351 / 3600, abs=2e-3 / 3600)


def test_the_suns_longitude(spark):
    """1992 October 13, 0h: 199.90988 degrees."""
    assert earth(spark, 48908.0).first().earth.sun == pytest.approx(199.90988, abs=2e-5)


def test_an_apparent_place(spark):
    """Theta Persei at 2028 November 13.19 (its proper motion applied): mean place 41.547214, 49.348483; nutation 15.843 and 6.218, aberration
    30.045 and 6.697 arcseconds; apparent place 2h46m14.390s, 49d21m07.45s."""
    years = (62088.19 - 51544.5) / 365.25
    ra, dec = 15 * (2 + 44 / 60 + (11.986 + 0.03425 * years) / 3600), 49 + 13 / 60 + (42.48 - 0.0895 * years) / 3600
    df = earth(spark, 62088.19).withColumns({"ra": F.lit(ra), "dec": F.lit(dec)})
    mean = apparent.precessed(F.col("ra"), F.col("dec"), F.col("earth.t"))
    m = df.select(*[c.alias(n) for c, n in zip(mean, "ad", strict=True)]).first()
    assert m.a == pytest.approx(41.547214, abs=3e-6) and m.d == pytest.approx(49.348483, abs=3e-6)
    more = apparent.corrections(*mean, F.col("earth"))
    c = df.select(*[x.alias(n) for x, n in zip(more, "ad", strict=True)]).first()
    assert c.a * 3600 == pytest.approx(15.843 + 30.045, abs=0.05) and c.d * 3600 == pytest.approx(6.218 + 6.697, abs=0.05)
    p = apparent.with_apparent(df, "ra", "dec").first()
    assert p.apparent_ra == pytest.approx(15 * (2 + 46 / 60 + 14.390 / 3600), abs=0.1 / 3600 / math.cos(math.radians(49)))
    assert p.apparent_dec == pytest.approx(49 + 21 / 60 + 7.45 / 3600, abs=0.1 / 3600)


def test_baselines_keep_their_length_and_fringes_their_size(spark):
    df = earth(spark, 60000.3).withColumns({"ra": F.lit(83.6), "dec": F.lit(22.0), "x": F.lit(300.0), "y": F.lit(-400.0), "z": F.lit(1200.0)})
    out = apparent.with_uvw(apparent.with_apparent(df, "ra", "dec")).withColumn("f", apparent.fringe(F.col("w"), F.lit(1.4))).first()
    assert math.hypot(out.u, out.v, out.w) == pytest.approx(1300.0)
    turns = out.w * 1.4 / 0.299792458
    assert out.f.re == pytest.approx(math.cos(2 * math.pi * turns), abs=1e-6) and out.f.im == pytest.approx(-math.sin(2 * math.pi * turns), abs=1e-6)
