"""Range, as-of, interval and cone joins. Each has an equality on a bucket, so that Spark can hash or sort."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skysift.stored import materialize

#: Points of one place that meet its ranked rows in one task.
SHARE = 4096


def _buckets(low: Column, high: Column, width: float) -> Column:
    return F.explode(F.sequence(F.floor(low / width).cast("bigint"), F.floor(high / width).cast("bigint")))


def within(left: DataFrame, right: DataFrame, x: str, y: str, before: float, after: float, how: str = "inner", on: list[str] | None = None) -> DataFrame:
    """Rows with -before <= x - y <= after (both inclusive). right is dealt to each bucket it reaches."""
    width = max(before + after, 1e-9)
    spread = right.withColumn("__b", _buckets(F.col(y) - before, F.col(y) + after, width))
    keyed = left.withColumn("__a", F.floor(F.col(x) / width).cast("bigint"))
    match = (F.col("__a") == F.col("__b")) & (F.col(x) - F.col(y) >= -before) & (F.col(x) - F.col(y) <= after)
    for c in on or []:
        match = match & (left[c] == right[c])
    out = keyed.join(spread, match, how)
    return out.drop("__a", "__b")


def _merged(left: DataFrame, right: DataFrame, x: str, y: str, carry: list[str], after: bool) -> DataFrame:
    """Both sides in one order of time, stored: (__t, __o, __r, __l, __p), of each row one side is null and __p is its partition.

    At one time right rows come before left ones, or after them. The order is range-partitioned and stored with the
    partitions' numbers: each plan that read it anew would number them in its own way.
    """
    tag = F.struct(F.col(y).alias("at"), *[F.col(c) for c in carry])
    a = left.select(F.col(x).cast("double").alias("__t"), F.lit(0 if after else 1).alias("__o"), F.lit(None).cast(right.select(tag.alias("s")).schema["s"].dataType).alias("__r"), F.struct(*left.columns).alias("__l"))
    b = right.select(F.col(y).cast("double").alias("__t"), F.lit(1 if after else 0).alias("__o"), tag.alias("__r"), F.lit(None).cast(a.schema["__l"].dataType).alias("__l"))
    return materialize(a.unionByName(b).repartitionByRange("__t", "__o").withColumn("__p", F.spark_partition_id()), "merged")


def _carried(merged: DataFrame, forward: bool) -> tuple[Column, DataFrame]:
    """The last right row up to each row (forward: the first from it on): a column within the partition, and a table (__p, __beyond)
    of what comes from the partitions before (behind), one row a partition."""
    # a frame to the end is made anew for each row; the same rows in falling order are a running one
    turn = F.desc if forward else F.asc
    here = F.last("__r", ignorenulls=True).over(Window.partitionBy("__p").orderBy(turn("__t"), turn("__o")).rowsBetween(Window.unboundedPreceding, 0))
    edge = (F.min if forward else F.max)(F.struct("__t", "__o", "__r"))
    ends = merged.where("__r is not null").groupBy("__p").agg(edge.alias("e")).select(F.col("__p").alias("__q"), F.col("e.__r").alias("__end"))
    # one row a partition, in one window: their number is set by the session, not by the data
    beyond = F.last("__end", ignorenulls=True).over(Window.orderBy(turn("__p")).rowsBetween(Window.unboundedPreceding, -1))
    return here, merged.select("__p").distinct().join(ends, F.col("__q") == F.col("__p"), "left").select("__p", beyond.alias("__beyond"))


def backward(left: DataFrame, right: DataFrame, x: str, y: str, carry: list[str], strict: bool = True) -> DataFrame:
    """The latest right row before each left row (strictly, or at the same time too).

    Within a partition of the common order the last right row carries forward; the last one of each partition before
    carries across, from a table with one row a partition.
    """
    merged = _merged(left, right, x, y, carry, strict)
    here, last = _carried(merged, False)
    out = merged.withColumn("__here", here).where("__l is not null").join(F.broadcast(last), "__p", "left")
    return out.select("__l.*", F.coalesce("__here", "__beyond").alias("found")).select(*left.columns, F.col("found.at").alias(y), *[F.col(f"found.{c}").alias(c) for c in carry])


def nearest(left: DataFrame, right: DataFrame, x: str, y: str, tolerance: float, id_col: str, ties: list[str], how: str = "inner") -> DataFrame:
    """Of right, the row nearest in y within the tolerance for each left row; ties by the columns named.

    The last right row up to each left row and the first one behind it are carried to it, and the nearer counts, so no
    row meets more than two. Of right rows at one time the first by `ties` stands for all. Column names of the sides differ.
    """
    rest = [c for c in right.columns if c != y and c not in ties]
    best = right.where(F.col(y).isNotNull() & ~F.isnan(F.col(y).cast("double"))).groupBy(y).agg(F.min(F.struct(*ties, F.struct(*rest) if rest else F.lit(0).alias("none"))).alias("b"))
    fields = best.schema["b"].dataType.names
    one = best.select(y, *[F.col(f"b.{t}").alias(t) for t in ties], *([F.col(f"b.{fields[-1]}.{c}").alias(c) for c in rest] if rest else []))
    carry = [*ties, *rest]
    merged = _merged(left.where(F.col(x).isNotNull()), one, x, y, carry, False)
    (up, before), (down, behind) = _carried(merged, False), _carried(merged, True)
    both = merged.withColumn("__up", up).withColumn("__down", down).where("__l is not null")
    both = both.join(F.broadcast(before.withColumnRenamed("__beyond", "__far")), "__p", "left").join(F.broadcast(behind), "__p", "left")
    each = [F.coalesce("__up", "__far"), F.coalesce("__down", "__beyond")]
    away = [F.abs(F.col("__t") - r["at"].cast("double")) for r in each]
    found = F.array_min(F.filter(F.array(*[F.struct(d.alias("d"), F.struct(*[r[t].alias(t) for t in ties]).alias("ties"), r.alias("r")) for d, r in zip(away, each, strict=True)]), lambda s: s["d"] <= tolerance))
    out = both.select("__l.*", found.alias("__f")).where("__f is not null")
    out = out.select(*left.columns, *[F.col(f"__f.r.{'at' if c == y else c}").alias(c) for c in right.columns])
    if how == "inner":
        return out
    return left.join(out.select(id_col, *[c for c in out.columns if c not in left.columns]), id_col, "left")


def forward_by(left: DataFrame, right: DataFrame, by: str, x: str, y: str, carry: list[str]) -> DataFrame:
    """left with `found`, the first right row of its group `by` at or after it: (by, y, carry); null without any.

    One order of group and time is range-partitioned, so a group may be of any size and share a partition with others: the next
    right row of the whole order is either of the same group, or there is none.
    """
    tag = F.struct(F.col(by).alias("g"), F.col(y).alias("at"), *[F.col(c) for c in carry])
    a = left.select(F.col(by).alias("__g"), F.col(x).cast("double").alias("__t"), F.lit(0).alias("__o"), F.lit(None).cast(right.select(tag.alias("s")).schema["s"].dataType).alias("__r"), F.struct(*left.columns).alias("__l"))
    b = right.select(F.col(by).alias("__g"), F.col(y).cast("double").alias("__t"), F.lit(1).alias("__o"), tag.alias("__r"), F.lit(None).cast(a.schema["__l"].dataType).alias("__l"))
    merged = materialize(a.unionByName(b).repartitionByRange("__g", "__t", "__o").withColumn("__p", F.spark_partition_id()), "merged")
    down = Window.partitionBy("__p").orderBy(F.desc("__g"), F.desc("__t"), F.desc("__o")).rowsBetween(Window.unboundedPreceding, 0)
    ends = merged.where("__r is not null").groupBy("__p").agg(F.min(F.struct("__g", "__t", "__o", "__r")).alias("e")).select(F.col("__p").alias("__q"), F.col("e.__r").alias("__end"))
    # one row a partition, in one window: their number is set by the session, not by the data
    beyond = F.last("__end", ignorenulls=True).over(Window.orderBy(F.desc("__p")).rowsBetween(Window.unboundedPreceding, -1))
    last = merged.select("__p").distinct().join(ends, F.col("__q") == F.col("__p"), "left").select("__p", beyond.alias("__beyond"))
    out = merged.withColumn("__here", F.last("__r", ignorenulls=True).over(down)).where("__l is not null").join(F.broadcast(last), "__p", "left")
    found = F.coalesce("__here", "__beyond")
    return out.select("__g", "__l", found.alias("found")).select("__l.*", F.when(F.col("found.g") == F.col("__g"), F.col("found")).alias("found"))


def least_within(left: DataFrame, right: DataFrame, x: str, y: str, before: float, id_col: str, value: Column) -> DataFrame:
    """id_col and `least`, the least value of right rows with 0 <= x - y <= before, where there are any; ids are unique.

    In buckets as long as the range, a range is the end of one bucket and the start of the next: a running minimum from
    either side answers both, so the work is linear in the rows however many meet a range.
    """
    bucket = lambda t: F.floor(t / before).cast("bigint")
    kind = right.select(value.alias("v")).schema["v"].dataType
    there = lambda o: right.where(F.col(y).isNotNull()).select(bucket(F.col(y)).alias("b"), F.col(y).cast("double").alias("t"), F.lit(o).alias("o"), F.lit(None).cast(left.schema[id_col].dataType).alias("id"), value.alias("v"))
    asked = lambda t, b, o: left.where(F.col(x).isNotNull()).select(b.alias("b"), t.cast("double").alias("t"), F.lit(o).alias("o"), F.col(id_col).alias("id"), F.lit(None).cast(kind).alias("v"))
    so_far = lambda *order: F.min("v").over(Window.partitionBy("b").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
    start = there(0).unionByName(asked(F.col(x), bucket(F.col(x)), 1)).withColumn("m", so_far("t", "o"))
    end = there(1).unionByName(asked(F.col(x) - before, bucket(F.col(x)) - 1, 0)).withColumn("m", so_far(F.desc("t"), F.desc("o")))
    return start.unionByName(end).where("id is not null and m is not null").groupBy(F.col("id").alias(id_col)).agg(F.min("m").alias("least"))


def separation(ra1: Column, dec1: Column, ra2: Column, dec2: Column) -> Column:
    """Great-circle distance in degrees, by haversines."""
    a, b = F.radians(dec1), F.radians(dec2)
    h = F.pow(F.sin((b - a) / 2), F.lit(2.0)) + F.cos(a) * F.cos(b) * F.pow(F.sin(F.radians(ra2 - ra1) / 2), F.lit(2.0))
    return F.degrees(2 * F.asin(F.sqrt(F.least(F.lit(1.0), h))))


def _ra_cells(band: Column, radius: float) -> Column:
    """Cells of right ascension in a declination band: each as wide at least as a cone about a point of the band; one at the poles."""
    r = radius * (1 + 1e-9)
    edge = F.greatest(F.abs(band * radius), F.abs((band + 1) * radius))
    wide = F.degrees(F.asin(F.least(F.lit(1.0), F.sin(F.radians(F.lit(r))) / F.cos(F.radians(edge)))))
    return F.when(edge + r >= 90, F.lit(1)).otherwise(F.greatest(F.lit(1), F.floor(360 / wide))).cast("bigint")


def cone(points: DataFrame, catalog: DataFrame, radius: float) -> DataFrame:
    """Catalog rows (c_ra, c_dec) within radius of points (ra, dec), with `sep`.

    They meet in cells: bands of declination as high as the radius, cut into cells of right ascension that widen with
    1 / cos(dec) and wrap at 360 degrees. A catalog row is dealt to nine cells at most; a radius below 90 degrees.
    """
    cell = lambda ra, count: F.least(F.floor(F.pmod(ra, F.lit(360.0)) / 360 * count), count - 1).cast("bigint")
    bands = catalog.withColumn("__b", F.explode(F.array(*[F.floor(F.col("c_dec") / radius).cast("bigint") + k for k in (-1, 0, 1)]))).withColumn("__m", _ra_cells(F.col("__b"), radius))
    at = F.array_distinct(F.transform(F.array(*[F.lit(k) for k in (-1, 0, 1)]), lambda k: F.pmod(cell(F.col("c_ra"), F.col("__m")) + k, F.col("__m"))))
    spread = bands.withColumn("__d", F.explode(at))
    keyed = points.withColumn("__a", F.floor(F.col("dec") / radius).cast("bigint"))
    keyed = keyed.withColumn("__n", _ra_cells(F.col("__a"), radius)).withColumn("__c", cell(F.col("ra"), F.col("__n")))
    both = keyed.join(spread, (F.col("__a") == F.col("__b")) & (F.col("__c") == F.col("__d")) & (F.abs(F.col("dec") - F.col("c_dec")) <= radius))
    return both.withColumn("sep", separation(F.col("ra"), F.col("dec"), F.col("c_ra"), F.col("c_dec"))).where(F.col("sep") < radius).drop("__a", "__b", "__c", "__d", "__m", "__n")


def nearest_on_sky(points: DataFrame, catalog: DataFrame, key: str, order: list[Column], radii: list[float]) -> DataFrame:
    """Of the catalog, the row nearest each point within the last of the radii, by `order`: terms of `sep` alone or of a catalog row alone.

    Places are matched, not rows: of catalog rows at one place the first by `order` stands for all, and each distinct place of the
    points is sought once. Only places without a row within a radius are sought in the next, so that few catalog rows meet each.
    """
    first = lambda rows, *by: rows.withColumn("__n", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where("__n = 1").drop("__n")
    sources = materialize(first(catalog.withColumn("sep", F.lit(0.0)), "c_ra", "c_dec").drop("sep"), "sources")
    out, left = None, materialize(points.select("ra", "dec").distinct(), "places")
    for n, radius in enumerate(radii):
        best = materialize(first(cone(left, sources, radius), "ra", "dec"), "nearest")
        out = best if out is None else out.unionByName(best)
        if n + 1 < len(radii):
            left = left.join(best.select("ra", "dec"), ["ra", "dec"], "left_anti")
    found = first(points.join(out, ["ra", "dec"]), key)
    return found.select(*points.columns, *catalog.columns, "sep")


def ranked_cone(points: DataFrame, catalog: DataFrame, radius: float, key: str, order: list[Column], place: str) -> DataFrame:
    """Catalog rows within radius of points, with `sep` and the place of each in its point's `order`, which is of catalog columns alone.

    Each distinct place of the points is searched and ranked once; then points meet the ranked rows of their place, many
    points of one place in shares of SHARE, so beyond the searched places the work is that of writing the result.
    """
    mine = Window.partitionBy(key)
    numbered = points.withColumn("__j", F.row_number().over(mine.orderBy("ra", "dec"))).withColumn("__copies", F.count("*").over(mine))
    spots = materialize(points.groupBy("ra", "dec").agg(F.ceil(F.count("*") / SHARE).alias("__shares")), "places")
    sources = materialize(catalog.select("c_ra", "c_dec").distinct(), "sources")
    near = materialize(cone(spots, sources, radius), "near")
    rank = F.row_number().over(Window.partitionBy("ra", "dec").orderBy(*order))
    ranked = near.join(catalog, ["c_ra", "c_dec"]).withColumn("__rank", rank)
    ranked = ranked.withColumn("__s", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("__shares") - 1))).drop("__shares")
    dealt = numbered.join(spots, ["ra", "dec"]).withColumn("__s", F.pmod(F.xxhash64(key), F.col("__shares"))).drop("__shares")
    # few points make many rows: a number said here is kept, where one set by the points' bytes would be small
    count = int(points.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    both = dealt.repartition(count, "ra", "dec", "__s").join(ranked.hint("merge"), ["ra", "dec", "__s"])
    # rows that repeat a key follow each other at every rank
    return both.withColumn(place, (F.col("__rank") - 1) * F.col("__copies") + F.col("__j")).select(*points.columns, *catalog.columns, "sep", place)


def strip(points: DataFrame, catalog: DataFrame, half: float) -> DataFrame:
    """Catalog rows whose declination is less than `half` away."""
    spread = catalog.withColumn("__b", F.explode(F.array(*[F.floor(F.col("c_dec") / half).cast("bigint") + k for k in (-1, 0, 1)])))
    keyed = points.withColumn("__a", F.floor(F.col("dec") / half).cast("bigint"))
    return keyed.join(spread, (F.col("__a") == F.col("__b")) & (F.abs(F.col("dec") - F.col("c_dec")) < half)).drop("__a", "__b")


def complete_groups(df: DataFrame, keys: list[str], part: str, parts: list, value: str, names: list[str]) -> DataFrame:
    """One row for each key with a column a part, where all parts are there."""
    cols = [F.sum(F.when(F.col(part) == p, F.col(value))).alias(n) for p, n in zip(parts, names, strict=True)]
    return df.where(F.col(part).isin(parts)).groupBy(*keys).agg(F.countDistinct(part).alias("parts"), *cols).where(F.col("parts") == len(parts))
