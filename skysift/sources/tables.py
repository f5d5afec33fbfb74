"""Readers of text tables, all with explicit schemas."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skysift import schemas
from skysift.functions.codes import sexagesimal


def candidates(spark: SparkSession, path: str) -> DataFrame:
    """Candidate files, whatever optional columns they have; missing ones are null."""
    raw = spark.read.csv(path, header=True)  # every column as text: names vary, types are cast below
    kinds = {c.split()[0]: c.split()[1] for c in schemas.CANDIDATE.split(", ")}
    return raw.select(*[(F.col(f"`{head}`").cast("double").cast(kinds[name]) if kinds[name] == "int" else F.col(f"`{head}`").cast(kinds[name])).alias(name) if head in raw.columns else F.lit(None).cast(kinds[name]).alias(name) for head, name in schemas.CANDIDATE_NAMES.items()])


def antennas(spark: SparkSession, path: str, flagged: list[str] | None = None, preamble: int = 5) -> DataFrame:
    """Antenna coordinates below a preamble and a header line; flagged stations left out, a missing height is 0."""
    lines = spark.read.text(path, wholetext=True).select(F.posexplode(F.split("value", r"\r?\n")).alias("n", "line")).where((F.col("n") > preamble) & (F.trim("line") != ""))
    parts = F.split("line", ",")
    field = lambda k: F.nullif(F.trim(F.try_element_at(parts, F.lit(k + 1))), F.lit(""))
    rows = lines.select(field(1).alias("station"), field(2).try_cast("double").alias("lat"), field(3).try_cast("double").alias("lon"), F.coalesce(field(4).try_cast("double"), F.lit(0.0)).alias("elevation"))
    return rows.where(F.col("lat").isNotNull() & ~F.coalesce(F.col("station").isin(flagged or []), F.lit(False)))


def pulsars(spark: SparkSession, path: str) -> DataFrame:
    """A semicolon-separated pulsar catalog in which * is missing; positions in sexagesimal."""
    columns = "id string, name string, ra string, dec string, period double, period_dot double, dm double, width double, flux double, distance double"
    raw = spark.read.csv(path, sep=";", nullValue="*", schema=columns, comment="#", ignoreLeadingWhiteSpace=True, ignoreTrailingWhiteSpace=True)
    return raw.where("name is not null").select("name", (15 * sexagesimal(F.col("ra"))).alias("ra"), sexagesimal(F.col("dec")).alias("dec"), "period", "period_dot", "dm", "width", "flux", "distance")


def flagged_catalog(spark: SparkSession, path: str, schema: str, flags: list[str]) -> DataFrame:
    """A CSV catalog with Y/N columns as booleans (anything else is null)."""
    raw = spark.read.csv(path, header=True, schema=schema)
    return raw.withColumns({f: F.when(F.upper(F.trim(f)) == "Y", True).when(F.upper(F.trim(f)) == "N", False) for f in flags})


def columns_text(spark: SparkSession, path: str, columns: list[tuple[str, int, str]], missing: str = "-9.99") -> DataFrame:
    """White-space separated text: (name, place, type) of the wanted columns; `missing` is null, # starts a comment."""
    parts = F.split(F.trim("value"), r"\s+")
    lines = spark.read.text(path).where((F.trim("value") != "") & ~F.trim("value").startswith("#"))
    return lines.select(*[F.nullif(F.try_element_at(parts, F.lit(k + 1)), F.lit(missing)).try_cast(kind).alias(name) for name, k, kind in columns])


def calibrators(spark: SparkSession, path: str) -> DataFrame:
    """A JSON object of source name to (ra, dec, flux), flattened."""
    raw = spark.read.text(path, wholetext=True)
    entry = F.explode(F.from_json("value", "map<string,struct<ra:double,dec:double,flux:double>>")).alias("name", "s")
    return raw.select(entry).select("name", "s.*")


def plan(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.csv(path, schema=schemas.PLAN)


def by_file_name(spark: SparkSession, path: str, pattern: str, names: list[str]) -> DataFrame:
    """Files of a folder with what their names say: a group of the pattern for each name."""
    files = spark.read.format("binaryFile").load(path).select(F.col("path").alias("file"), "length", "modificationTime")
    last = F.element_at(F.split("file", "/"), -1)
    return files.select("file", "length", "modificationTime", *[F.nullif(F.regexp_extract(last, pattern, k + 1), F.lit("")).alias(n) for k, n in enumerate(names)]).where(F.col(names[0]).isNotNull())


def between(df: DataFrame, time: str, start: str, stop: str) -> DataFrame:
    """The time-range scan: start <= time < stop, pushed to the files' statistics."""
    kind = df.schema[time].dataType
    return df.where((F.col(time) >= F.lit(start).cast(kind)) & (F.col(time) < F.lit(stop).cast(kind)))
