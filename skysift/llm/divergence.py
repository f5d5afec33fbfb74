"""How far the sources of a language are apart in their word use: exact L1 distances by a heavy-light split.

Terms are counted per group (language, source) while texts are read, and summed by Spark. Kept terms that are in
more than LIGHT groups of their language are heavy: chunks of them become dense tiles (a block of groups by a chunk of
terms), and each pair of tiles gives the sums of absolute differences of its groups. The others are light. For
them a group's value is p0, that of no occurrence, but for a few postings, so over the light terms

    sum |p - q|  =  V_light |p0 - q0|  +  sum over g's postings of (|p - q0| - |p0 - q0|)  +  the same for h's
                    +  for terms in both: |p - q| - |p - q0| - |p0 - q| + |p0 - q0|

The first two kinds need no term: they are taken from each group's histogram of p. The last needs the pairs of a
posting list, of LIGHT groups at most. All three sums are of integers, so they add up exactly.

Defined results: a null text, language or source is the empty one; rows that repeat count each; a group without terms, or a
language without kept ones, has pairs (0 where none is kept) and no term rows; a language with one source has no pairs;
equal values rank by the item in UTF-8 order; an empty table gives an empty result; only these columns are read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skysift.llm.support import materialize, short_batches

#: Documents of its language that a kept term is in, what is added to each count, the scale of p, term rows of a group.
LEAST_DOCS, ADDED, SCALE, TERM_ROWS = 30, 5, 1_000_000_000, 50
#: Groups that a light term is in at most; groups of a block and terms of a chunk of a dense tile; counts that a task holds.
LIGHT, BLOCK, CHUNK, HELD = 8, 64, 4096, 300_000
#: Bytes that are no letter become spaces; A to Z become small; bytes from 0x80 on (parts of other letters) stay.
_LETTERS = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 97 <= c <= 122 else 32 for c in range(256))


def terms(text: bytes) -> list[bytes]:
    """The terms of a UTF-8 text."""
    return text.translate(_LETTERS).split()


def term_counts(docs: DataFrame) -> DataFrame:
    """lang, source, term, n (occurrences) and docs (documents that have it) of whole texts. A row with an empty
    term and the documents of the group for each group, even without terms."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups: dict[tuple[str, str], tuple[Counter, Counter]] = {}
        held = 0

        def handed() -> Iterator[pa.RecordBatch]:
            for (lang, source), (n, d) in groups.items():
                names = list(n)
                many = len(names)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * many, pa.string()), pa.array([source] * many, pa.string()), pa.array(names, pa.binary()).cast(pa.string()), pa.array(list(n.values()), pa.int64()), pa.array([d[t] for t in names], pa.int64())],
                    names=["lang", "source", "term", "n", "docs"],
                )
            groups.clear()

        for batch in batches:
            columns = (batch.column("lang").to_pylist(), batch.column("source").to_pylist(), batch.column("text").cast(pa.binary()))
            for lang, source, text in zip(*columns, strict=True):
                n, d = groups.setdefault((lang or "", source or ""), (Counter(), Counter()))
                before = len(n)
                found = Counter(terms(text.as_py() or b""))
                n.update(found)
                d.update(found.keys())
                n[b""] += 1
                d[b""] += 1
                held += len(n) - before
                if held > HELD:
                    yield from handed()
                    held = 0
        yield from handed()

    short_batches(docs.sparkSession)
    parts = docs.select("lang", "source", "text").mapInArrow(count, "lang string, source string, term string, n bigint, docs bigint")
    return parts.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def p_of(count: Column | str, total: Column | str, kept: Column | str) -> Column:
    """1 + floor(SCALE (count + ADDED) / (total + ADDED kept)), in decimals that hold every intermediate."""
    wide = lambda c: (F.col(c) if isinstance(c, str) else c).cast("decimal(20,0)")
    top = (F.lit(SCALE).cast("decimal(10,0)") * (wide(count) + ADDED)).cast("decimal(36,0)")
    return (F.call_function("div", top, (wide(total) + wide(kept) * ADDED).cast("decimal(36,0)")) + 1).cast("bigint")


def _tiled(rows: DataFrame, blocks: DataFrame) -> DataFrame:
    """rows of a group (lang, g) for each pair of blocks that its own block is in: (bi, bj), bi <= bj."""
    own = F.floor(F.col("g") / BLOCK).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    return rows.join(blocks, "lang").withColumn("__o", other).withColumn("bi", F.least(own, "__o")).withColumn("bj", F.greatest(own, "__o")).drop("__o", "blocks")


def heavy_sums(dense: DataFrame, base: DataFrame, widths: DataFrame, blocks: DataFrame) -> DataFrame:
    """(lang, g, h, part) with g < h: sums of |p - q| over the heavy terms, by tiles. dense: (lang, chunk, at, g, p); base: (lang, g,
    p0); widths: (lang, chunk, width). A tile starts from p0 of each of its groups, for terms that a group lacks."""
    start = base.join(widths, "lang").select("lang", "chunk", F.lit(None).cast("int").alias("at"), "g", F.col("p0").alias("p"), "width")
    dense = dense.select("lang", "chunk", "at", "g", "p", F.lit(None).cast("bigint").alias("width"))
    rows = _tiled(dense.unionByName(start), blocks)

    def sums(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        lang, _, bi, bj = key
        start = rows[rows["at"].isna()]
        given = rows[rows["at"].notna()]
        at = given["at"].to_numpy(np.int64)
        g = np.sort(start["g"].to_numpy(np.int64))
        tile = np.repeat(start.sort_values("g")["p"].to_numpy(np.int64)[:, None], int(start["width"].iloc[0]), axis=1)
        tile[np.searchsorted(g, given["g"].to_numpy(np.int64)), at] = given["p"].to_numpy(np.int64)
        left, right = np.flatnonzero(g // BLOCK == bi), np.flatnonzero(g // BLOCK == bj)
        out = [(g[a], g[right[right > a]], np.abs(tile[right[right > a]] - tile[a]).sum(1)) for a in left]
        return pd.DataFrame({"lang": lang, "g": np.concatenate([np.full(len(h), a) for a, h, _ in out]), "h": np.concatenate([h for _, h, _ in out]), "part": np.concatenate([v for _, _, v in out])})

    return rows.groupBy("lang", "chunk", "bi", "bj").applyInPandas(sums, "lang string, g int, h int, part bigint")


def light_sums(light: DataFrame, base: DataFrame, blocks: DataFrame) -> DataFrame:
    """(lang, g, h, part) with g < h: what histograms give of the light terms. light: (lang, g, p); base: (lang, g, p0, n_light)."""
    histogram = light.groupBy("lang", "g", "p").agg(F.count("*").alias("m"))
    start = base.select("lang", "g", F.col("p0").alias("p"), F.lit(None).cast("bigint").alias("m"), "n_light")
    rows = _tiled(histogram.select("lang", "g", "p", "m", F.lit(None).cast("bigint").alias("n_light")).unionByName(start), blocks)

    def sums(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        lang, bi, bj = key
        start = rows[rows["m"].isna()].sort_values("g")
        g, p0 = start["g"].to_numpy(np.int64), start["p"].to_numpy(np.int64)
        total = np.abs(p0[:, None] - p0[None, :]) * int(start["n_light"].max())
        postings = rows[rows["m"].notna()].sort_values(["g", "p"])
        own, p, m = (postings[c].to_numpy(np.int64) for c in ("g", "p", "m"))
        edge = np.searchsorted(own, np.append(g, g[-1] + 1))
        for k in range(len(g)):
            a, b = edge[k], edge[k + 1]
            # sum of m |p - q0| for every q0, from sorted p: what is below counts one way, what is above the other
            many, mass = np.concatenate([[0], np.cumsum(m[a:b])]), np.concatenate([[0], np.cumsum(m[a:b] * p[a:b])])
            at = np.searchsorted(p[a:b], p0)
            gain = (2 * many[at] - many[-1]) * p0 + mass[-1] - 2 * mass[at] - many[-1] * np.abs(p0[k] - p0)
            total[k, :] += gain
            total[:, k] += gain
        left, right = np.flatnonzero(g // BLOCK == bi), np.flatnonzero(g // BLOCK == bj)
        i, j = (x.ravel() for x in np.meshgrid(left, right, indexing="ij"))
        i, j = i[i < j], j[i < j]
        return pd.DataFrame({"lang": lang, "g": g[i], "h": g[j], "part": total[i, j]})

    return rows.groupBy("lang", "bi", "bj").applyInPandas(sums, "lang string, g int, h int, part bigint")


def shared_light(light: DataFrame) -> DataFrame:
    """(lang, g, h, part) with g < h: corrections for light terms that two groups share. light: (lang, term, g, p, p0)."""
    lists = light.groupBy("lang", "term").agg(F.sort_array(F.collect_list(F.struct("g", "p", "p0"))).alias("l")).where(F.size("l") > 1)  # LIGHT at most
    one = lists.select("lang", "l", F.posexplode("l").alias("k", "a")).select("lang", "a", F.explode(F.slice("l", F.col("k") + 2, F.greatest(F.size("l") - F.col("k") - 1, F.lit(0)))).alias("b"))
    gap = lambda x, y: F.abs(F.col(x) - F.col(y))
    part = gap("a.p", "b.p") - gap("a.p", "b.p0") - gap("a.p0", "b.p") + gap("a.p0", "b.p0")
    return one.select("lang", F.col("a.g").alias("g"), F.col("b.g").alias("h"), part.alias("part")).groupBy("lang", "g", "h").agg(F.sum("part").alias("part"))


def audit(docs: DataFrame) -> DataFrame:
    """lang, source, part, item, value, rank: the distances of each source to the others of its language, and the terms that it has
    more of than the language, the largest first."""
    counts = materialize(term_counts(docs), "term-counts")
    by_term = counts.where("term <> ''").groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("lang_n"), F.count("*").alias("groups")).where(F.col("docs") >= LEAST_DOCS)
    kept_terms = materialize(by_term.select("lang", "term", "lang_n", (F.col("groups") > LIGHT).alias("heavy")), "kept-terms")
    groups = counts.where("term = ''").select("lang", "source", (F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1).alias("g"))
    langs = kept_terms.groupBy("lang").agg(F.count("*").alias("v"), F.sum("lang_n").alias("lang_total"), F.count_if("heavy").alias("heavies"))
    kept = materialize(counts.where("term <> ''").select("lang", "source", "term", "n").join(kept_terms, ["lang", "term"]), "kept-counts")
    totals = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    base = groups.join(langs, "lang", "left").join(totals, ["lang", "source"], "left").na.fill(0, ["v", "lang_total", "heavies", "total"])
    p0 = F.when(F.col("v") > 0, p_of(F.lit(0), "total", "v")).otherwise(F.lit(0))  # without terms nothing is summed
    base = materialize(base.select("lang", "source", "g", "v", "total", "lang_total", p0.alias("p0"), (F.col("v") - F.col("heavies")).alias("n_light")), "groups")
    valued = kept.join(base, ["lang", "source"]).select(
        "lang", "source", "g", "term", "heavy", "p0", p_of("n", "total", "v").alias("p"), p_of("lang_n", "lang_total", "v").alias("q")
    )
    valued = materialize(valued, "valued")

    # a heavy term's place in its chunk: terms go to chunks by hash and are numbered there
    chunked = kept_terms.where("heavy").join(langs.select("lang", F.ceil(F.col("heavies") / CHUNK).alias("chunks")), "lang").select("lang", "term", F.pmod(F.xxhash64("term"), F.col("chunks")).cast("int").alias("chunk"))
    place = chunked.withColumn("at", F.row_number().over(Window.partitionBy("lang", "chunk").orderBy("term")) - 1)
    blocks = base.groupBy("lang").agg((F.floor(F.max("g") / BLOCK) + 1).cast("int").alias("blocks"))
    dense = valued.where("heavy").join(place, ["lang", "term"])
    light = valued.where("not heavy")
    widths = place.groupBy("lang", "chunk").agg(F.count("*").alias("width"))
    whole = heavy_sums(dense, base, widths, blocks).unionByName(light_sums(light, base, blocks)).unionByName(shared_light(light))
    pairs = materialize(whole.groupBy("lang", "g", "h").agg(F.sum("part").alias("value")), "pairs")
    both = pairs.unionByName(pairs.select("lang", F.col("h").alias("g"), F.col("g").alias("h"), "value"))
    names = base.select("lang", "g", "source")
    named = both.join(names, ["lang", "g"]).join(names.select("lang", F.col("g").alias("h"), F.col("source").alias("item")), ["lang", "h"]).select("lang", "source", F.lit("pair").alias("part"), "item", "value")
    more = valued.where("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    return named.withColumn("rank", rank).unionByName(more.withColumn("rank", rank).where(F.col("rank") <= TERM_ROWS))
