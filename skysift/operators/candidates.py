"""Candidate operators: point-spread neighbours, reductions, centroids, naming."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def around(cands: DataFrame, psf: DataFrame, keys: list[str], group: list[str]) -> DataFrame:
    """For each place (keys, c_dec, c_ra) and group the candidates whose offset from it (d_dec, d_ra) lies in the point-spread mask:
    members, and the sums snr, psf and weighted (psf * snr).

    Candidates of a cell are summed first; then a cell's sums, not its candidates, are dealt to the places that see it, as many as
    the mask has. So work grows with the cells and their mask, whatever a cell holds.
    """
    cells = cands.groupBy(*keys, *group, "dec_idx", "ra_idx").agg(F.sum("snr").alias("snr"), F.count("*").alias("n"))
    dealt = cells.join(F.broadcast(psf)).withColumns({"c_dec": F.col("dec_idx") - F.col("d_dec"), "c_ra": F.col("ra_idx") - F.col("d_ra")})
    weighted = F.sum(F.col("psf") * F.col("snr")).alias("weighted")
    return dealt.groupBy(*keys, "c_dec", "c_ra", *group).agg(F.sum("n").alias("members"), F.sum("snr").alias("snr"), F.sum(F.col("psf") * F.col("n")).alias("psf"), weighted)


def centres(cands: DataFrame, sums: DataFrame, keys: list[str], group: list[str]) -> DataFrame:
    """The sums of around() for each candidate as `centre` and each group; those of rows that repeat an id are added up."""
    each = cands.select(*keys, F.col("cand").alias("centre"), F.col("dec_idx").alias("c_dec"), F.col("ra_idx").alias("c_ra")).join(sums, [*keys, "c_dec", "c_ra"])
    return each.groupBy("centre", *group).agg(*[F.sum(c).alias(c) for c in ("members", "snr", "psf", "weighted")])


def best_centres(cands: DataFrame, sums: DataFrame, keys: list[str], group: list[str], places: int = 9) -> DataFrame:
    """The best centre of each group by sum(psf * snr) / sum(psf) (rounded to so many places), the least one at ties, and its score."""
    scored = centres(cands, sums, keys, group).withColumn("score", F.round(F.col("weighted") / F.col("psf"), places))
    return scored.groupBy(*group).agg(F.min(F.struct((-F.col("score")).alias("s"), "centre")).alias("b")).select(*group, F.col("b.centre").alias("centre"), (-F.col("b.s")).alias("score"))


def centroids(df: DataFrame, cluster: list[str], axes: list[str], weight: str = "snr") -> DataFrame:
    """S/N-weighted mean place, and the peak member's, of each cluster."""
    means = [(F.sum(F.col(a) * F.col(weight)) / F.sum(weight)).alias(f"{a}_mean") for a in axes]
    peak = F.max(F.struct(F.col(weight), *[(-F.col(a)).alias(a) for a in axes])).alias("p")
    out = df.groupBy(*cluster).agg(*means, peak, F.count("*").alias("members"))
    return out.select(*cluster, "members", *[f"{a}_mean" for a in axes], F.col(f"p.{weight}").alias("peak"), *[(-F.col(f"p.{a}")).alias(f"{a}_peak") for a in axes])


def best_per(df: DataFrame, keys: list[str], k: int, order: list[Column], skip: int = 0) -> DataFrame:
    """Rows skip + 1 to skip + k of each key in the order given."""
    return df.withColumn("__n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("__n").between(skip + 1, skip + k)).drop("__n")


def cutouts(cands: DataFrame, pixels: DataFrame, keys: list[str], half: int, size: int) -> DataFrame:
    """Pixels of a square of 2 * half + 1 about each candidate, moved inward at the edges so that all have that many."""
    low = lambda c: F.least(F.greatest(F.col(c) - half, F.lit(0)), F.lit(size - 2 * half - 1))
    span = lambda c: F.explode(F.sequence(low(c), low(c) + 2 * half))
    cells = cands.withColumn("y", span("dec_idx")).withColumn("x", span("ra_idx"))
    return cells.join(pixels, [*keys, "y", "x"])


def next_names(df: DataFrame, order: list[Column], last: int, batch: str) -> DataFrame:
    """Running names after `last`. Ranks are counted within `batch` and moved by the batches before, so no task numbers all rows."""
    sizes = df.groupBy(batch).agg(F.count("*").alias("__size"))
    before = Window.orderBy(batch).rowsBetween(Window.unboundedPreceding, -1)
    base = sizes.select(batch, F.coalesce(F.sum("__size").over(before), F.lit(0)).alias("__base"))
    ranked = df.withColumn("__n", F.row_number().over(Window.partitionBy(batch).orderBy(*order)))
    return ranked.join(base, batch).withColumn("candname", F.format_string("cand%06d", F.col("__base") + F.col("__n") + last)).drop("__n", "__base")


def merge_results(df: DataFrame, key: str, results: list[DataFrame]) -> DataFrame:
    """df with the columns that later steps found, one row a key in each: the last step that has a value for a column wins."""
    for r in results:
        new = [c for c in r.columns if c != key]
        joined = df.join(r.select(key, *[F.col(c).alias(f"__new_{c}") for c in new]), key, "left")
        df = joined.withColumns({c: F.coalesce(f"__new_{c}", c) if c in df.columns else F.col(f"__new_{c}") for c in new}).drop(*[f"__new_{c}" for c in new])
    return df
