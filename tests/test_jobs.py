"""Whole jobs and what they are made of, against plain loops."""

import itertools

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from skysift import sinks
from skysift.operators import candidates, density, gridding, imaging, learned
from skysift.plans import offline
from skysift.sources import visibility
from skysift.streaming import runs


def groups(near: np.ndarray, rows: list[int], least: int, size: int) -> list[frozenset]:
    """Linked groups of dense points among all of them."""
    dense = [r for r in rows if near[r].sum() >= least]
    left, out = set(dense), []
    while left:
        todo, seen = [left.pop()], set()
        while todo:
            seen.add(at := todo.pop())
            new = [n for n in left if near[at, n]]
            left.difference_update(new)
            todo += new
        if len(seen) >= size:
            out.append(frozenset(seen))
    return out


def best_choice(levels: list[list[frozenset]], gains: list[float], group: frozenset, at: int) -> tuple[float, list]:
    """Weight and choice of the group and what lies below it."""
    weight, parts, level = len(group) * gains[at], [], at
    here = group
    while level + 1 < len(levels):
        parts = [g for g in levels[level + 1] if g <= here]
        level += 1
        if len(parts) != 1:
            break
        here = parts[0]
        weight += len(here) * gains[level]
        parts = []
    below = [best_choice(levels, gains, p, level) for p in parts]
    under = sum(w for w, _ in below)
    return (weight, [(at, group)]) if weight >= under else (under, list(itertools.chain(*[c for _, c in below])))


@pytest.mark.parametrize("weighted", [False, True])
def test_nested_clusters(spark, weighted):
    """Tight groups within a loose one, a loose one alone, and scatter; ties at equal places, a null axis."""
    rng = np.random.default_rng(11)
    x = np.concatenate([rng.normal(0, 0.03, (25, 2)), rng.normal((0.4, 0), 0.03, (25, 2)), rng.normal((3, 3), 0.2, (40, 2)), rng.uniform(-2, 5, (60, 2)), np.zeros((3, 2))])
    k, ids = rng.integers(0, 2, len(x)), rng.permutation(len(x))
    radii, least, size = [0.45, 0.25, 0.12, 0.06], 4, 6
    rows = [(int(a), int(b), float(p), float(q)) for a, b, (p, q) in zip(k, ids, x, strict=True)] + [(0, 1000, None, 0.0), (0, 1001, float("nan"), 0.0)]
    metric = (lambda o: density.psf_distance(lambda d: 1 + d[0] * d[0], o)) if weighted else None
    frame = spark.createDataFrame(rows, "g int, id int, p double, q double")
    got = {(r.g, r.id): r.cluster for r in density.nested_clusters(frame, "g", ["p", "q"], "id", radii, least, size, metric).collect()}
    want = {(r[0], r[1]): None for r in rows}
    for g in (0, 1):
        here = np.flatnonzero(k == g)
        off = x[here][:, None] - x[here][None]
        d = np.sqrt((off**2).sum(2)) * (1 + off[..., 0] ** 2 if weighted else 1)
        levels = [groups(d <= r, list(range(len(here))), least, size) for r in radii]
        gains = [1 / r - (1 / radii[n - 1] if n else 0) for n, r in enumerate(radii)]
        for top in levels[0]:
            for _, members in best_choice(levels, gains, top, 0)[1]:
                for m in members:
                    want[g, int(ids[here[m]])] = int(ids[here[list(members)]].min())
    assert got == want
    assert len(set(want.values())) > 3


def test_nested_clusters_of_nothing(spark):
    none = spark.createDataFrame([], "g int, id int, p double")
    assert density.nested_clusters(none, "g", ["p"], "id", [0.2, 0.1], 3, 3).count() == 0
    with pytest.raises(ValueError):
        density.nested_clusters(none, "g", ["p"], "id", [0.1, 0.2], 3, 3)


def test_a_head_is_learned(spark):
    """Bright spots in one corner or the other, a third of the cut-outs without a label or pixels."""
    rng = np.random.default_rng(2)
    label = rng.integers(0, 2, 300)
    cubes = rng.normal(0, 1, (300, 1, 4, 4))
    cubes[label == 1, 0, 0, 0] += 4
    cubes[label == 0, 0, 3, 3] += 4
    rows = [(n, c.ravel().tolist() if n % 7 else None, int(v) if n % 5 else None) for n, (c, v) in enumerate(zip(cubes, label, strict=True))]
    frame = spark.createDataFrame(rows, "cand_id bigint, pixels array<double>, label int")
    layers = [(rng.normal(0, 0.3, (24, 1, 4, 4)), np.zeros(24))]
    head = learned.fit_head(frame, (1, 4, 4), layers)
    p = learned.score(cubes, layers, head)
    assert ((p > 0.5) == (label == 1)).mean() > 0.9
    weights, bias = learned.fit_head(frame.where("false"), (1, 4, 4), layers)
    assert not weights.any() and bias == 0


def test_visibilities_stream(spark, tmp_path):
    """Files that land between two runs of a query are read once."""
    rng = np.random.default_rng(0)
    x = (rng.normal(size=(3, 4, 2, 3, 1)) + 1j).astype(np.complex64)
    folder = tmp_path / "vis"
    folder.mkdir()
    for landed in ([0], [1, 2]):
        for n in landed:
            (folder / f"a{n}.out").write_bytes(visibility.encode(60000.0 + n, n, 1.0, x[n]))
        stream = visibility.stream_blocks(spark, f"file://{folder}", 2, 2, 3, 1).select("mjd", "gulp", "t", "bl", "chan", "re")
        stream.writeStream.format("parquet").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/state").trigger(availableNow=True).start().awaitTermination()
    got = {(int(r.mjd) - 60000, r.t, r.bl, r.chan): r.re for r in spark.read.parquet(f"{tmp_path}/out").collect()}
    assert got == {(n, t, b, c): float(x[n, t, b, c, 0].real) for n in range(3) for t in range(4) for b in range(2) for c in range(3)}


def test_packed_baselines(spark):
    rng = np.random.default_rng(1)
    pairs = [(a, b) for a in range(100) for b in range(a + 1, 100)]
    uvw = rng.normal(size=(len(pairs), 3))
    frame = spark.createDataFrame([(a, b, *map(float, r)) for (a, b), r in zip(pairs, uvw, strict=True)], "ant1 int, ant2 int, u double, v double, w double").orderBy(F.rand(1))
    files = {}
    for r in sinks.packed_baselines(frame).orderBy("name", "block").collect():
        files[r["name"]] = files.get(r["name"], b"") + bytes(r["content"])
    for n, c in enumerate("uvw"):
        assert (np.frombuffer(files[c], "<f8") == uvw[:, n]).all()
    assert np.allclose(np.frombuffer(files["length"], "<f8"), np.hypot(uvw[:, 0], uvw[:, 1]))
    assert list(zip(files["ant1"], files["ant2"], strict=True)) == pairs


def test_later_results_win(spark):
    base = spark.createDataFrame([(1, 1.0), (2, 2.0), (3, None)], "id int, a double")
    first = spark.createDataFrame([(1, 10.0, "x"), (3, 30.0, None)], "id int, a double, b string")
    second = spark.createDataFrame([(1, None, "y")], "id int, a double, b string")
    got = candidates.merge_results(base, "id", [first, second]).orderBy("id").collect()
    assert [tuple(r) for r in got] == [(1, 10.0, "y"), (2, 2.0, None), (3, 30.0, None)]


def test_long_rows(spark):
    cube = np.arange(24.0).reshape(2, 3, 4)
    frame = spark.createDataFrame([(7, cube.ravel().tolist() + [99.0]), (8, [])], "id int, v array<double>")
    got = {(r.a, r.b, r.c): r.value for r in imaging.long_rows(frame, ["id"], "v", [2, 3, 4], ["a", "b", "c"]).collect()}
    assert got == {at: float(v) for at, v in np.ndenumerate(cube)}


def test_a_planted_pulse_is_found(spark):
    """A source off the middle that flashes once, dispersed, and the beam toward it with its period."""
    rng = np.random.default_rng(4)
    size, steps, chans = 16, 50, 3
    u, v = rng.integers(-7, 8, (2, 60)).astype(float)
    keep = np.hypot(u, v) > 1
    u, v = u[keep], v[keep]
    l, m = 3 / size, -2 / size  # noqa: E741
    rows = []
    for t in range(steps):
        for c in range(chans):
            on = 30.0 if t == 30 + 2 * (chans - 1 - c) or (t < 25 and t % 5 == 2) else 0.0
            z = on * np.exp(-2j * np.pi * (u * l + v * m)) + rng.normal(0, 1, len(u)) + 1j * rng.normal(0, 1, len(u))
            rows += [(t, c, n, n + 100, float(a), float(b), float(s.real), float(s.imag)) for n, (a, b, s) in enumerate(zip(u, v, z, strict=True))]
    vis = spark.createDataFrame(pd.DataFrame(rows, columns=["t", "chan", "ant1", "ant2", "u", "v", "re", "im"]))
    job = offline.Settings(size=size, cell=1.0, samples=25, channels=chans)
    delays = spark.createDataFrame([(d, c, d * (chans - 1 - c), 1.0) for d in range(3) for c in range(chans)], "dm_idx int, chan int, shift int, weight double")
    kept = offline.flagged(vis, spark.createDataFrame([(0,), (105,)], "idx int"), job)
    assert kept.count() == (len(u) - 2) * steps * chans
    found = offline.best_of_gulps(offline.searched(offline.imaged(kept, job), delays, [1, 2], job, steps), 3.0, 1)
    best = {r.gulp: r for r in found.collect()}
    assert (best[1].dm_idx, best[1].wid_idx, best[1].toa) == (2, 0, 30)
    place = (best[1].y - size // 2, best[1].x - size // 2)
    assert abs(place[0] - 3) <= 1 and abs(place[1] + 2) <= 1
    aims = spark.createDataFrame([(0, l, m), (1, -l, 0.2)], "target int, l double, m double")
    early = kept.where("t < 25")
    levels = {r.target: r.v for r in gridding.direct_transform(early.where("t % 5 = 2"), aims, []).groupBy("target").agg(F.avg("value").alias("v")).collect()}
    assert levels[0] > 2 * abs(levels[1])
    means = {r.on: r.v for r in offline.beams(early, aims.where("target = 0"), 25).groupBy((F.col("t") % 5 == 2).alias("on")).agg(F.avg("value").alias("v")).collect()}
    assert means[True] > means[False] + 1.5


def test_metrics_of_micro_batches(spark):
    rows = spark.createDataFrame([(1, 5.0), (2, 7.0), (2, 1.0)], "b int, v double")
    got = runs.batch_metrics(rows, [F.col("b") == 1, F.col("b") == 2], [F.count("*").alias("n"), F.max("v").alias("top")]).orderBy("batch").collect()
    assert [(r.n, r.top, r.batch) for r in got] == [(1, 5.0, 0), (2, 7.0, 1)]
