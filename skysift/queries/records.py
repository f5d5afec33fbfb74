"""Queries over files in the instrument's own formats: written by tasks, read back by data sources."""

from __future__ import annotations

from pyspark.sql import functions as F

from skysift import schemas, sinks
from skysift.operators import candidates
from skysift.queries.registry import CUBE, cube, events, query, r6, table
from skysift.sources import fits, packets, tables, visibility
from skysift.stored import materialize, new_folder


def _folder(spark, name: str) -> str:
    """A new folder in the shared one, as a path that files are opened by."""
    return new_folder(spark, name).removeprefix("file://").removeprefix("file:")


_COUNTS = f"""{CUBE}, counts AS (SELECT c.pix, c.chan, c.t, coalesce(n, 0) AS n FROM cube c LEFT JOIN (SELECT pix, chan, t, count(*) AS n FROM ev GROUP BY ALL) USING (pix, chan, t)),
samples AS (SELECT CAST(60310 + t // 240 * 10 AS DOUBLE) AS mjd, chan AS sb, CAST(t % 240 // 24 AS INTEGER) AS gulp, CAST(t % 240 AS INTEGER) AS t, pix AS bl, CAST(n AS DOUBLE) AS re, CAST(-n AS DOUBLE) + 0 AS im FROM counts)"""


def _raw_files(spark, sf_dir):
    """Events an hour as raw visibility files: a sub-band a kind, a baseline a place, ten days a file, a day a gulp. The glob of the files."""
    n = events(spark, sf_dir).groupBy("pix", "chan", "t").agg(F.count("*").alias("n"))
    every = cube(spark, sf_dir).select("pix", "chan", "t").join(n, ["pix", "chan", "t"], "left").withColumn("n", F.coalesce("n", F.lit(0)).cast("double"))
    rows = every.select((60310.0 + F.floor(F.col("t") / 240) * 10).alias("mjd"), F.col("chan").alias("sb"), F.lit(16.5).alias("dec"), F.pmod("t", F.lit(240)).alias("t"), F.col("pix").alias("bl"), F.lit(0).alias("chan"), F.lit(0).alias("pol"), F.col("n").alias("re"), (-F.col("n")).alias("im"))
    folder = _folder(spark, "raw")
    materialize(visibility.write(rows, folder, 24, 8, 1, 1), "raw-files")
    return f"{folder}/*.vis"


@query(f"WITH {_COUNTS} SELECT mjd, sb, gulp, t, bl, re, im FROM samples")
def visibility_round_trip(spark, sf_dir):
    """Raw files written by tasks and scanned again, a gulp a partition."""
    return visibility.scan(spark, _raw_files(spark, sf_dir), 24, 8, 1, 1).select("mjd", "sb", "gulp", "t", "bl", "re", (F.col("im") + 0.0).alias("im"))


@query(f"WITH {_COUNTS} SELECT mjd, sb, gulp, t, bl, re FROM samples WHERE mjd >= 60320 AND sb IN (1, 3) AND t BETWEEN 60 AND 130")
def visibility_scan_range(spark, sf_dir):
    """The scan of a range of times and two sub-bands, answered from headers and offsets: 4 gulps of 4 of the 15 files are read."""
    rows = visibility.scan(spark, _raw_files(spark, sf_dir), 24, 8, 1, 1)
    return rows.where((F.col("mjd") >= 60320) & F.col("sb").isin(1, 3) & F.col("t").between(60, 130)).select("mjd", "sb", "gulp", "t", "bl", "re")


def _catalog(spark, sf_dir):
    """Orders as FITS files. The glob of the files."""
    folder = _folder(spark, "fits")
    rows = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").cast("int").alias("o_custkey"), "o_totalprice", "o_orderstatus", F.trim("o_orderpriority").alias("o_orderpriority"), (F.col("o_orderkey") % 2 == 0).alias("even"))
    materialize(fits.write(rows, folder, {"o_orderstatus": 1, "o_orderpriority": 15}), "fits-files")
    return f"{folder}/*.fits"


@query("SELECT o_orderkey, CAST(o_custkey AS INTEGER) AS o_custkey, round(o_totalprice, 6) + 0 AS o_totalprice, o_orderstatus, trim(o_orderpriority) AS o_orderpriority, o_orderkey % 2 = 0 AS even FROM orders")
def fits_round_trip(spark, sf_dir):
    """A catalog written as FITS tables by tasks and read again by ranges of rows."""
    return fits.scan(spark, _catalog(spark, sf_dir), rows_per_task=5000).withColumn("o_totalprice", r6("o_totalprice"))


@query("SELECT o_orderkey, round(o_totalprice, 6) + 0 AS o_totalprice FROM orders WHERE o_orderstatus = 'F'")
def fits_single_sources(spark, sf_dir):
    """Rows of one code, with three of the columns decoded."""
    rows = fits.scan(spark, _catalog(spark, sf_dir), ["o_orderkey", "o_totalprice", "o_orderstatus"], rows_per_task=5000)
    return rows.where("o_orderstatus = 'F'").select("o_orderkey", r6("o_totalprice").alias("o_totalprice"))


_LEVELS = """c AS (SELECT l_orderkey * 10 + l_linenumber AS cand, l_orderkey % 50 AS gulp, CAST(l_partkey % 64 AS INTEGER) AS ra_idx, CAST(l_suppkey % 64 AS INTEGER) AS dec_idx, CAST(l_linenumber % 3 AS INTEGER) AS dm_idx, CAST(l_quantity AS DOUBLE) AS snr, CAST(l_discount AS DOUBLE) * 10 AS prob FROM lineitem),
kept AS (SELECT * FROM c WHERE prob <= 0.5), levels AS (SELECT 'raw' AS level, * FROM c UNION ALL SELECT 'classified', * FROM kept
UNION ALL SELECT 'final', * FROM kept QUALIFY row_number() OVER (PARTITION BY gulp ORDER BY snr DESC, cand) <= 3)"""


@query(f"WITH {_LEVELS} SELECT level, 'cand' || cand AS candname, ra_idx, dec_idx, dm_idx, snr, round(prob, 6) + 0 AS prob FROM levels")
def candidate_files(spark, sf_dir):
    """Candidates as CSV files of three levels (all; those that the classifier keeps; the three best of each gulp), read again."""
    line = table(spark, sf_dir, "lineitem")
    cand = line.select(
        F.concat(F.lit("cand"), F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("candname"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("cand"), (F.col("l_orderkey") % 50).alias("gulp"),
        (F.col("l_partkey") % 64).cast("int").alias("ra_idx"), (F.col("l_suppkey") % 64).cast("int").alias("dec_idx"), (F.col("l_linenumber") % 3).cast("int").alias("dm_idx"), F.col("l_quantity").cast("double").alias("snr"), (F.col("l_discount").cast("double") * 10).alias("prob"),
    )
    kept = cand.where("prob <= 0.5")
    folder = new_folder(spark, "candidates")
    for level, rows in (("raw", cand), ("classified", kept), ("final", candidates.best_per(kept, ["gulp"], 3, [F.desc("snr"), F.col("cand")]))):
        sinks.write_candidates(rows, folder, level)
    levels = [tables.candidates(spark, f"{folder}/level={level}").withColumn("level", F.lit(level)) for level in ("raw", "classified", "final")]
    both = levels[0].unionByName(levels[1]).unionByName(levels[2])
    return both.select("level", "candname", "ra_idx", "dec_idx", "dm_idx", "snr", r6("prob").alias("prob"))


def _text(spark, lines, name: str) -> str:
    """A folder of text files with these lines."""
    folder = new_folder(spark, name)
    lines.write.text(folder)
    return folder


@query("""SELECT 'B' || c_custkey AS name, round(15 * (c_custkey % 24 + CAST(c_custkey % 60 AS DOUBLE) / 60 + (c_custkey % 50 + CAST(0.25 AS DOUBLE)) / 3600), 9) + 0 AS ra,
round((CASE WHEN c_custkey % 2 = 0 THEN 1 ELSE -1 END) * (c_custkey % 80 + CAST(c_custkey % 59 AS DOUBLE) / 60 + CAST(30.5 AS DOUBLE) / 3600), 9) + 0 AS dec, CASE WHEN c_custkey % 7 <> 0 THEN CAST(c_custkey % 90 AS DOUBLE) / 8 END AS period, CASE WHEN c_custkey % 5 <> 0 THEN CAST(c_custkey % 300 AS DOUBLE) / 4 END AS dm FROM customer""")
def pulsar_catalog_text(spark, sf_dir):
    """A semicolon catalog with sexagesimal positions and * for what is missing, written and read."""
    n = F.col("c_custkey")
    two = lambda c: F.lpad(c.cast("string"), 2, "0")
    ra = F.concat(two(n % 24), F.lit(":"), two(n % 60), F.lit(":"), (n % 50 + 0.25).cast("string"))
    dec = F.concat(F.when(n % 2 == 0, "+").otherwise("-"), two(n % 80), F.lit(":"), two(n % 59), F.lit(":30.5"))
    star = lambda c, there: F.when(there, c.cast("string")).otherwise("*")
    line = F.concat_ws(";", n.cast("string"), F.concat(F.lit("B"), n), ra, dec, star((n % 90) / 8, n % 7 != 0), F.lit("*"), star((n % 300) / 4, n % 5 != 0), F.lit("*"), F.lit("*"), F.lit("*"))
    rows = tables.pulsars(spark, _text(spark, table(spark, sf_dir, "customer").select(line), "pulsars"))
    return rows.select("name", (F.round("ra", 9) + F.lit(0.0)).alias("ra"), (F.round("dec", 9) + F.lit(0.0)).alias("dec"), "period", "dm")


@query("SELECT 'J' || s_suppkey AS name, CAST(s_suppkey % 360 AS DOUBLE) AS ra, CASE WHEN s_suppkey % 6 <> 0 THEN CAST(s_suppkey % 50 AS DOUBLE) / 4 END AS flux FROM supplier")
def column_catalog_text(spark, sf_dir):
    """A white-space catalog in which -9.99 is missing, with comments and empty lines, written and read."""
    n = F.col("s_suppkey")
    flux = F.when(n % 6 != 0, ((n % 50) / 4).cast("string")).otherwise("-9.99")
    line = F.concat(F.lit("  J"), n, F.lit("   "), (n % 360).cast("string"), F.lit(" x  "), flux, F.when(n % 3 == 0, "\n# a comment\n\n").otherwise(""))
    folder = _text(spark, table(spark, sf_dir, "supplier").select(line), "columns")
    return tables.columns_text(spark, folder, [("name", 0, "string"), ("ra", 1, "double"), ("flux", 3, "double")])


@query("SELECT p_partkey AS id, p_size AS size, CASE p_partkey % 3 WHEN 0 THEN 'true' WHEN 1 THEN 'false' END AS confirmed FROM part")
def flagged_catalog_text(spark, sf_dir):
    """A CSV catalog with a Y/N column, in either case and with blanks, written and read."""
    flag = F.when(F.col("p_partkey") % 3 == 0, F.when(F.col("p_partkey") % 2 == 0, " y ").otherwise("Y")).when(F.col("p_partkey") % 3 == 1, "N").otherwise("unknown")
    folder = new_folder(spark, "flagged")
    table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), F.col("p_size").alias("size"), flag.alias("confirmed")).write.csv(folder, header=True)
    kind = table(spark, sf_dir, "part").schema["p_size"].dataType.simpleString()
    return tables.flagged_catalog(spark, folder, f"id bigint, size {kind}, confirmed string", ["confirmed"]).withColumn("confirmed", F.col("confirmed").cast("string"))


@query("SELECT 'S' || s_suppkey AS name, CAST(s_suppkey % 360 AS DOUBLE) AS ra, CAST(s_suppkey % 90 AS DOUBLE) / 2 AS dec, round(s_acctbal, 6) + 0 AS flux FROM supplier")
def calibrator_json(spark, sf_dir):
    """Calibrators as JSON objects of name to place and flux, a file a nation, written and read."""
    n = F.col("s_suppkey")
    entry = F.struct(F.concat(F.lit("S"), n).alias("k"), F.struct((n % 360).cast("double").alias("ra"), ((n % 90) / 2).alias("dec"), F.col("s_acctbal").cast("double").alias("flux")).alias("v"))
    objects = table(spark, sf_dir, "supplier").groupBy("s_nationkey", F.floor(n / 1000).alias("part")).agg(F.to_json(F.map_from_entries(F.collect_list(entry))).alias("value"))  # a thousand at most
    folder = new_folder(spark, "calibrators")
    objects.repartition("s_nationkey", "part").write.partitionBy("s_nationkey", "part").text(folder)
    return tables.calibrators(spark, f"{folder}/*/*").select("name", "ra", "dec", r6("flux").alias("flux"))


@query("SELECT 'file' || o_orderkey AS file, CAST(1 + o_orderkey % 4 AS INTEGER) AS n_processed, CASE WHEN o_orderkey % 2 = 0 THEN 'ok' END AS note FROM orders")
def ledger_appends(spark, sf_dir):
    """A recovery ledger that grows by two appends."""
    folder = new_folder(spark, "ledger")
    rows = table(spark, sf_dir, "orders").select(F.concat(F.lit("file"), F.col("o_orderkey")).alias("file"), (1 + F.col("o_orderkey") % 4).cast("int").alias("n_processed"), F.when(F.col("o_orderkey") % 2 == 0, "ok").alias("note"), "o_orderstatus")
    for some in (F.col("o_orderstatus") == "F", F.col("o_orderstatus") != "F"):
        sinks.append_ledger(rows.where(some), folder, schemas.LEDGER)
    return spark.read.schema(schemas.LEDGER).parquet(folder)


_CHUNKS = "c AS (SELECT l_orderkey AS k, l_linenumber AS n, min(CAST(l_quantity AS DOUBLE)) AS a, min(CAST(l_discount AS DOUBLE)) AS b FROM lineitem GROUP BY ALL)"


@query(f"WITH {_CHUNKS} SELECT k, CAST(7 - count(*) AS INTEGER) AS missing, round(sum(a), 6) + 0 AS a, round(sum(b), 6) + 0 AS b FROM c WHERE n BETWEEN 1 AND 7 GROUP BY k")
def incomplete_messages(spark, sf_dir):
    """Messages of seven chunks of two doubles, given out when their time is up: chunks that haven't come are NaN."""
    rows = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("k"), (F.col("l_linenumber") - 1).cast("int").alias("chunk_no")).agg(F.min(F.col("l_quantity").cast("double")).alias("a"), F.min(F.col("l_discount").cast("double")).alias("b"))
    chunks = packets.encode_doubles(rows.select("k", "chunk_no", F.array("a", "b").alias("v")), ["k", "chunk_no"], "v").withColumn("expected", F.lit(7))
    whole = materialize(packets.fill_chunks(chunks, "k", 16), "messages")
    values = packets.decode_doubles(whole, "k", "bytes").join(whole.select("k", F.size("missing").alias("missing")), "k").where(F.size("values") == 14)
    place = values.select("k", "missing", F.posexplode("values").alias("at", "v"))
    total = lambda odd: r6(F.sum(F.when(F.col("at") % 2 == odd, F.col("v"))))
    return place.groupBy("k", "missing").agg(total(0).alias("a"), total(1).alias("b"))


@query("SELECT 'v' || vec_id AS name, CAST((k - 1) // 8 AS INTEGER) AS y, CAST((k - 1) % 8 AS INTEGER) AS x, round(CAST(embedding[k] AS DOUBLE), 6) + 0 AS value FROM embeddings, range(1, 65) r(k) WHERE k <= len(embedding)")
def image_dump_fits(spark, sf_dir):
    """Images as units of FITS files, a file a task, written and read."""
    rows = table(spark, sf_dir, "embeddings").select(F.concat(F.lit("v"), F.col("vec_id")).alias("name"), F.array(F.lit(8), F.lit(8)).alias("shape"), F.col("embedding").cast("array<double>").alias("values"))
    folder = _folder(spark, "images")
    materialize(fits.write_images(rows.repartition(4, "name"), folder), "image-files")
    place = fits.images(spark, f"{folder}/*.fits").select("name", F.posexplode("values").alias("at", "value"))
    return place.select("name", F.floor(F.col("at") / 8).cast("int").alias("y"), (F.col("at") % 8).alias("x"), r6("value").alias("value"))
