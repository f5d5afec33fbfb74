"""Times and sky coordinates as column expressions. Angles are in degrees.

Right ascension from time is the mean sidereal time (error below 1.2 s of time: no nutation, UT1 = UTC);
pixel positions are a tangent projection.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the site: longitude and latitude in degrees; and of the sky: the galactic pole and node (J2000).
LONGITUDE, LATITUDE = -118.2834, 37.2334
POLE_RA, POLE_DEC, NODE = 192.85948, 27.12825, 122.93192
OBLIQUITY = 23.4392911


def mjd_of_micros(micros: Column) -> Column:
    """MJD of microseconds from 1970."""
    return micros / 86_400_000_000.0 + 40587.0


def micros_of_mjd(mjd: Column) -> Column:
    return F.round((mjd - 40587.0) * 86_400_000_000.0).cast("bigint")


def isot_of_micros(micros: Column) -> Column:
    """ISO time to milliseconds, independent of the session's zone."""
    day, rest = F.floor(micros / 86_400_000_000), F.pmod(micros, F.lit(86_400_000_000))
    ms = F.floor(rest / 1000)
    at = lambda size, mod: F.lpad(F.pmod(F.floor(ms / size), F.lit(mod)).cast("string"), 2, "0")
    date = F.date_format(F.date_add(F.lit("1970-01-01").cast("date"), day.cast("int")), "yyyy-MM-dd")
    return F.concat(date, F.lit("T"), at(3_600_000, 24), F.lit(":"), at(60_000, 60), F.lit(":"), at(1000, 60), F.lit("."), F.lpad(F.pmod(ms, F.lit(1000)).cast("string"), 3, "0"))


def spectrum_number(mjd: Column, start_mjd: float, sample_s: float) -> Column:
    return F.floor((mjd - start_mjd) * 86400 / sample_s).cast("bigint")


def sidereal(mjd: Column, longitude: float = LONGITUDE) -> Column:
    """Local mean sidereal time, in degrees: the right ascension on the meridian."""
    return F.pmod(280.46061837 + 360.98564736629 * (mjd - 51544.5) + longitude, F.lit(360.0))


def altitude(elevation: Column) -> tuple[Column, Column]:
    """Altitude and azimuth of a dish elevation that runs from the north horizon over the zenith to the south."""
    return F.when(elevation > 90, 180 - elevation).otherwise(elevation), F.when(elevation > 90, F.lit(0.0)).otherwise(F.lit(180.0))


def elevation(alt: Column, az: Column) -> Column:
    return F.when(F.cos(F.radians(az)) > 0, 180 - alt).otherwise(alt)


def drift_pixels(dec: Column, milliseconds: float, pixel_deg: float) -> Column:
    """Pixels that the sky drifts in a time at a declination, rounded up."""
    return F.ceil(F.cos(F.radians(dec)) * (milliseconds / 1000 * 15.041 / 3600) / pixel_deg).cast("int")


def tangent(ra: Column, dec: Column, ra0: float, dec0: float, pixel_deg: float, size: int) -> tuple[Column, Column]:
    """Pixel of a position in an image of size x size about (ra0, dec0)."""
    d, a = F.radians(dec), F.radians(ra - ra0)
    s0, c0 = math.sin(math.radians(dec0)), math.cos(math.radians(dec0))
    front = s0 * F.sin(d) + c0 * F.cos(d) * F.cos(a)
    scale = math.radians(pixel_deg)
    return size // 2 - F.cos(d) * F.sin(a) / front / scale, size // 2 + (c0 * F.sin(d) - s0 * F.cos(d) * F.cos(a)) / front / scale


def galactic(ra: Column, dec: Column) -> tuple[Column, Column]:
    """Galactic longitude and latitude."""
    p, sp, cp = math.radians(POLE_RA), math.sin(math.radians(POLE_DEC)), math.cos(math.radians(POLE_DEC))
    a, d = F.radians(ra) - p, F.radians(dec)
    b = F.asin(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), sp * F.sin(d) + cp * F.cos(d) * F.cos(a))))
    l = F.lit(NODE) - F.degrees(F.atan2(F.cos(d) * F.sin(a), cp * F.sin(d) - sp * F.cos(d) * F.cos(a)))  # noqa: E741
    return F.pmod(l, F.lit(360.0)), F.degrees(b)


def ecliptic_latitude(ra: Column, dec: Column) -> Column:
    e, a, d = math.radians(OBLIQUITY), F.radians(ra), F.radians(dec)
    return F.degrees(F.asin(F.sin(d) * math.cos(e) - F.cos(d) * math.sin(e) * F.sin(a)))


def direction_cosine(dec0: float, offset: Column) -> Column:
    """Cosine of the direction along declination for an offset from the centre."""
    return F.sin(F.radians(offset + dec0)) * math.cos(math.radians(dec0)) - F.cos(F.radians(offset + dec0)) * math.sin(math.radians(dec0))


def phase_shift(re: Column, im: Column, turns: Column) -> Column:
    """(re + i im) * exp(2 pi i turns)."""
    c, s = F.cos(2 * math.pi * turns), F.sin(2 * math.pi * turns)
    return F.struct((re * c - im * s).alias("re"), (re * s + im * c).alias("im"))


def spectral_index(flux: Column, frequency: Column, reference: float, index: float) -> Column:
    return flux * F.pow(frequency / reference, F.lit(index))
