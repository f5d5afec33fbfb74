"""URL filters by host suffixes and path prefixes, matched on short hash prefixes.

Each distinct (host, path) expands into host-suffix and path-prefix expressions, only of the label
counts and path lengths that the rules have. Expressions and rules meet in an equi-join on the first
32 bits of SHA-256; the full digests confirm, and the longest rule wins (a block rule before an allow
rule of the same text).

Defined results: a null url, or one without "://", has an empty host and path and gets the default
verdict; repeated urls get equal verdicts, one for each row; an empty table gives an empty result; an
empty rule table leaves the default; a rule without a host fits nothing. Columns of the input with names
of the result are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rules up to this count are broadcast (at most 128 bytes each in the joined form: 13 MB).
BROADCAST_RULES = 100_000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host (lower-cased A-Z) and path of a url."""
    rest = F.coalesce(F.regexp_extract(url, r"(?s)^.*?://(.*)\z", 1), F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.translate(host, UPPER, LOWER), path


def rule_table(spark: SparkSession, rules: list[tuple[str, str, str]]) -> DataFrame:
    """(action, host, path) rows as a table of rules."""
    return spark.createDataFrame(rules, "action string, host string, path string")


def _digest(expression: Column) -> Column:
    return F.sha2(expression, 256)


def judge_urls(pages: DataFrame, rules: DataFrame, url_col: str = "url", default: str = "allow") -> DataFrame:
    """pages with host, path, rule and verdict."""
    kept = [c for c in pages.columns if c not in ("host", "path", "rule", "verdict", "__h", "__p")]
    host, path = url_parts(F.col(url_col))
    parts = pages.withColumn("__h", host).withColumn("__p", path).select(*kept, "__h", "__p")

    known = rules.select("action", F.col("host").alias("rh"), F.coalesce("path", F.lit("")).alias("rp")).where("rh <> '' and action is not null")
    # one rule for each (host, path): block before allow
    known = known.groupBy("rh", "rp").agg(F.max("action").alias("action"))
    known = known.select("action", F.concat("rh", "rp").alias("rule"), F.size(F.split("rh", r"\.")).alias("labels"), F.length("rp").alias("chars"))
    known = known.withColumn("digest", _digest(F.concat_ws("|", F.col("labels").cast("string"), F.col("chars").cast("string"), F.col("rule"))))
    known = known.withColumn("short", F.substring("digest", 1, 8))
    # the shapes are as few as the rules' label counts and path lengths
    shapes = known.groupBy("labels", "chars").count().collect()
    if not shapes:
        empty = F.lit(None).cast("string")
        return parts.select(*kept, F.col("__h").alias("host"), F.col("__p").alias("path"), empty.alias("rule"), F.lit(default).alias("verdict"))
    total = sum(s["count"] for s in shapes)

    keys = parts.where("__h <> ''").select("__h", "__p").distinct()
    labels = F.size(F.split("__h", r"\."))
    # one constant list, however many shapes there are
    listed = F.array(*[F.struct(F.lit(s.labels).alias("labels"), F.lit(s.chars).alias("chars")) for s in sorted(shapes, key=lambda s: (s.labels, s.chars))])
    reached = F.filter(listed, lambda s: (labels >= s["labels"]) & (F.length("__p") >= s["chars"]))
    expressions = F.transform(reached, lambda s: F.concat(s["labels"].cast("string"), F.lit("|"), s["chars"].cast("string"), F.lit("|"), F.call_function("substring_index", F.col("__h"), F.lit("."), -s["labels"]), F.substring("__p", F.lit(1), s["chars"])))
    expanded = (
        keys.select("__h", "__p", F.explode(expressions).alias("expression"))
        .withColumn("full", _digest(F.col("expression")))
        .withColumn("short", F.substring("full", 1, 8))
    )
    side = known.select("action", "rule", "digest", "short")
    hits = expanded.join(F.broadcast(side) if total <= BROADCAST_RULES else side, "short").where(F.col("full") == F.col("digest"))
    best = F.max_by(F.struct("rule", "action"), F.struct(F.length("rule"), F.col("action"), F.col("rule")))
    verdicts = hits.groupBy("__h", "__p").agg(best.alias("best"))
    # urls without a host have no rule: they don't meet in the join as one key
    judged = parts.where("__h <> ''").join(verdicts, ["__h", "__p"], "left").select(*kept, "__h", "__p", "best")
    bare = parts.where("__h = ''").withColumn("best", F.lit(None).cast(verdicts.schema["best"].dataType))
    return judged.unionByName(bare).select(
        *kept,
        F.col("__h").alias("host"),
        F.col("__p").alias("path"),
        F.col("best.rule").alias("rule"),
        F.coalesce(F.col("best.action"), F.lit(default)).alias("verdict"),
    )
