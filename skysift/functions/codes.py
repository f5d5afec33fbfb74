"""Bit flags, hex, names and records as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# What each bit of a process status says.
PARSE, SIZE, SHAPE, INVALID = 1, 2, 4, 8


def set_flag(status: Column, flag: int, on: bool = True) -> Column:
    return status.bitwiseOR(F.lit(flag)) if on else status.bitwiseAND(F.bitwise_not(F.lit(flag)))


def reset_flag() -> Column:
    """A reset status is marked invalid until something is known."""
    return F.lit(INVALID)


def has_flag(status: Column, flag: int) -> Column:
    return status.bitwiseAND(F.lit(flag)) != 0


def name_parts(name: Column) -> dict[str, Column]:
    """Sub-band and time of a file name such as sb03_2024-01-02T03:04:05.vis."""
    return {"sb": F.nullif(F.regexp_extract(name, r"sb([0-9]{2})", 1), F.lit("")).cast("int"), "isot": F.nullif(F.regexp_extract(name, r"([0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9:.]+?)(?:\.vis|$)", 1), F.lit(""))}


def shape_of(header: Column) -> Column:
    """The numbers of an array header's shape entry, e.g. 'shape': (175, 175, 25)."""
    inner = F.regexp_extract(header, r"'shape': \(([0-9, ]*)\)", 1)
    return F.transform(F.filter(F.split(inner, r",\s*"), lambda x: x != ""), lambda x: x.cast("int"))


def packet_fields(head: Column) -> dict[str, Column]:
    """Time, diagonal, declination, node and shape of a packet's text header."""
    take = lambda key, kind: F.nullif(F.regexp_extract(head, rf"(?i)\b{key}:\s*([^\s;]+)", 1), F.lit("")).cast(kind)
    return {"isot": take("isot", "string"), "uv_diag": take("uv_diag", "double"), "dec": take("dec", "double"), "node": take("node", "int"), "shape": shape_of(head)}


def sexagesimal(text: Column) -> Column:
    """Degrees (or hours) of text such as -12:34:56.7."""
    parts = F.split(F.ltrim(text), ":")
    part = lambda k: F.coalesce(F.try_element_at(parts, F.lit(k + 1)).try_cast("double"), F.lit(0.0))
    return F.when(F.ltrim(text).startswith("-"), -1.0).otherwise(1.0) * (F.abs(part(0)) + part(1) / 60 + part(2) / 3600)
