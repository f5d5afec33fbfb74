"""Joins and reductions without pairs, against brute force."""

import random

import pytest
from pyspark.sql import functions as F

from skysift.operators import candidates, joins, noise


def sides(spark, seed):
    r = random.Random(seed)
    left = [(n, r.choice([r.uniform(0, 50), float(r.randrange(50)), None])) for n in range(300)]
    right = [(r.choice([r.uniform(0, 50), float(r.randrange(50))]), f"n{r.randrange(99):02d}", n) for n in range(120)] + [(None, "x", -1), (20.0, "a", 500), (20.0, "b", 501)]
    frames = spark.createDataFrame(left, "id int, x double").repartition(5), spark.createDataFrame(right, "y double, name string, k int").repartition(3)
    return left, [x for x in right if x[0] is not None], *frames


@pytest.mark.parametrize("tolerance", [0.0, 0.2, 3.0, 100.0])
def test_nearest(spark, tolerance):
    """Equal distances before and behind, equal times, nulls, rows without a partner; many partitions, some without right rows."""
    left, right, a, b = sides(spark, 1)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = {r.id: (r.y, r.name, r.k) for r in joins.nearest(a, b, "x", "y", tolerance, "id", ["name", "k"]).collect()}
        kept = joins.nearest(a, b, "x", "y", tolerance, "id", ["name", "k"], how="left").collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    want = {}
    for n, x in left:
        near = [(abs(x - y), name, k, y) for y, name, k in right if abs(x - y) <= tolerance] if x is not None else []
        if near:
            _, name, k, y = min(near)
            want[n] = (y, name, k)
    assert got == want and len(kept) == 300 and {r.id: (r.y, r.name, r.k) for r in kept if r.k is not None} == want


@pytest.mark.parametrize("before", [0.5, 4.0, 60.0])
def test_least_within(spark, before):
    left, right, a, b = sides(spark, 2)
    got = {r.id: tuple(r.least) for r in joins.least_within(a, b, "x", "y", before, "id", F.struct("name", "k")).collect()}
    want = {}
    for n, x in left:
        inside = [(name, k) for y, name, k in right if 0 <= x - y <= before] if x is not None else []
        if inside:
            want[n] = min(inside)
    assert got == want


def test_sums_around_places(spark):
    r = random.Random(3)
    rows = [(n, r.randrange(2), r.randrange(6), r.randrange(6), r.randrange(2), float(r.randrange(1, 9))) for n in range(200)]
    mask = [(a, b, 1.0 / (1 + a * a + b * b)) for a in (-1, 0, 1) for b in (-1, 0, 1) if (a, b) != (1, 1)]
    cands = spark.createDataFrame(rows, "cand int, gulp int, dec_idx int, ra_idx int, dm int, snr double")
    sums = candidates.around(cands, spark.createDataFrame(mask, "d_dec int, d_ra int, psf double"), ["gulp"], ["dm"])
    got = {(x.centre, x.dm): (x.members, x.snr, x.psf, x.weighted) for x in candidates.centres(cands, sums, ["gulp"], ["dm"]).collect()}
    want: dict = {}
    for c, g, d, a, *_ in rows:
        for _, g2, d2, a2, dm, snr in rows:
            for dd, da, psf in mask:
                if g == g2 and d2 - d == dd and a2 - a == da:
                    m = want.setdefault((c, dm), [0, 0.0, 0.0, 0.0])
                    m[:] = m[0] + 1, m[1] + snr, m[2] + psf, m[3] + psf * snr
    assert set(got) == set(want) and all(got[k] == pytest.approx(tuple(want[k])) for k in want)
    best = {x.dm: (x.centre, x.score) for x in candidates.best_centres(cands, sums, ["gulp"], ["dm"]).collect()}
    for dm in (0, 1):
        score, centre = min((-round(w[3] / w[2], 9), c) for (c, k), w in want.items() if k == dm)
        assert best[dm] == (centre, pytest.approx(-score))


def test_noise_folds_a_long_key_in_order(spark):
    """One key with most rows, over several batches of Arrow rows."""
    r = random.Random(4)
    rows = [("long", n, r.choice([1.0, 2.0, 50.0, None])) for n in range(30_000)] + [("short", n, float(n)) for n in range(5)] + [(None, 0, 3.0)]
    got = {x.k: (x.n, x.noise) for x in noise.reject_and_fold(spark.createDataFrame(rows, "k string, day int, x double").repartition(4), ["k"], "day", "x", 3.0).collect()}
    for k in ("long", "short", None):
        n, mean = 0, 0.0
        for key, _, x in rows:
            if key == k and x is not None and not (n and mean and x > 3 * mean):
                mean, n = (mean * n + x) / (n + 1), n + 1
        assert got[k] == (n, pytest.approx(mean))
