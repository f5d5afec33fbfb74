"""The density hierarchy against a plain top-down version on dense matrices."""

import numpy as np
import pytest

from skysift.operators import hierarchy

POINTS = "k string, id bigint, x double, y double, z double"


def reachability(x, neighbours):
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(2))
    core = np.sort(d, axis=1)[:, min(neighbours, len(x) - 1)]
    return np.maximum(np.maximum(d, core[:, None]), core[None]), core


def parts_below(m, points, threshold):
    left, out = set(points), []
    while left:
        part = {left.pop()}
        todo = list(part)
        while todo:
            near = {v for v in left if m[todo[-1], v] < threshold}
            todo.pop()
            left -= near
            part |= near
            todo += near
        out.append(part)
    return out


def plain_clusters(x, neighbours, size, whole=False):
    """cluster of each point: from the whole set down, what falls apart below each distance of the matrix."""
    m, _ = reachability(x, neighbours)

    def walk(now, birth):
        start, total = set(now), 0.0
        while True:
            steps = sorted({m[u, v] for u in now for v in now if u < v})
            split = max(t for t in steps if len(parts_below(m, now, t)) > 1)
            density = 1 / max(split, hierarchy.LEAST)
            large = [p for p in parts_below(m, now, split) if len(p) >= size]
            if len(large) != 1:
                return start, total + len(now) * (density - birth), [walk(p, density) for p in large]
            total += (len(now) - len(large[0])) * (density - birth)
            now = large[0]

    def choose(node, top):
        members, own, parts = node
        below = [choose(p, False) for p in parts]
        rest = sum(s for s, _ in below)
        if own >= rest - 1e-12 * abs(rest) and (whole or not top):
            return own, [members]
        return rest, [c for _, found in below for c in found]

    if len(x) < max(2, size):
        return {}
    return {n: min(c) for c in choose(walk(set(range(len(x))), 0.0), True)[1] for n in c}


def sets(seed):
    r = np.random.default_rng(seed)
    lumps = np.concatenate([r.normal(c, s, (14, 3)) for c, s in ((0, 0.1), (5, 1.0), (-4, 0.4))])
    return [lumps, np.rint(lumps), r.normal(0, 1, (40, 3)), np.repeat(r.normal(0, 1, (5, 3)), 4, axis=0), lumps[:2], lumps[:1]]


@pytest.mark.parametrize("whole", [False, True])
def test_condensed_tree(whole):
    for seed in range(4):
        for x in sets(seed):
            if len(x) > 1:
                _, core = reachability(x, 2)
                found = hierarchy.condensed(*hierarchy.spanning_tree(x, core), 4, whole)
                assert {n: c for n, (c, _) in found.items()} == plain_clusters(x, 2, 4, whole)


@pytest.mark.parametrize("block", [7, 1000])
def test_clusters_of_many_keys(spark, block):
    """Several keys of several densities at once; with small blocks the tree comes from pairs of blocks and Boruvka rounds."""
    data = {f"s{n}": x for n, x in enumerate(sets(9))}
    rows = [(k, n, *map(float, p)) for k, x in data.items() for n, p in enumerate(x)]
    rows += [("s0", 900, None, 0.0, 0.0), ("s0", 901, float("nan"), 0.0, 0.0)]
    got = hierarchy.clusters(spark.createDataFrame(rows, POINTS), "k", ["x", "y", "z"], "id", 4, block=block).collect()
    assert len(got) == len(rows)
    for k, x in data.items():
        assert {r.id: r.cluster for r in got if r.k == k and r.cluster is not None} == plain_clusters(x, 2, 4)
    core = hierarchy.core_of_points(spark.createDataFrame(rows, POINTS), "k", ["x", "y", "z"], "id", 2, block=block).collect()
    for k, x in data.items():
        want = reachability(x, 2)[1] if len(x) > 1 else [np.inf]
        assert {r.id: pytest.approx(r.core) for r in core if r.k == k} == dict(enumerate(want))


def test_no_points(spark):
    assert hierarchy.clusters(spark.createDataFrame([], POINTS), "k", ["x"], "id", 4).count() == 0


def test_rounds_end_when_one_finds_nothing(spark):
    r = np.random.default_rng(1)
    lump, thin = r.normal(0, 0.1, (20, 2)), np.concatenate([r.normal(c, 0.05, (4, 2)) for c in (30, 40)])
    x = np.concatenate([lump, r.normal(10, 0.1, (20, 2)), thin])
    rows = [("a", n, *map(float, p), 0.0) for n, p in enumerate(x)]
    out = hierarchy.rounds(spark.createDataFrame(rows, POINTS), "k", ["x", "y"], "id", 9, 5).collect()
    assert len(out) == len(rows)
    by_round = {n: {(r.cluster) for r in out if r.round == n} for n in (0, 1)}
    assert by_round[0] == {0, 20} and by_round[1] == {40, 44}


def test_distances_grow_with_the_points(spark, tmp_path, monkeypatch):
    """Twice the points of a lump with thin edges: the distances that are made don't grow with their square."""
    monkeypatch.setattr(hierarchy, "boruvka", lambda edges: edges)
    made = []
    for n in (800, 1600):
        file = str(tmp_path / str(n))

        def metric(p, others, file=file):
            with open(file, "a") as f:
                f.write(f"{len(others)}\n")
            return hierarchy.euclid(p, others)

        x = np.random.default_rng(2).normal(0, 1, (n, 2))
        frame = spark.createDataFrame([("a", i, float(p), float(q), 0.0) for i, (p, q) in enumerate(x)], POINTS)
        _, packed = hierarchy._cored(frame, "k", ["x", "y"], "id", 2, metric, 1.0, 32)
        hierarchy.reachability_tree(packed, 2, metric, 1.0).count()
        made.append(np.loadtxt(file).sum())
    assert made[1] < 2.6 * made[0], made


def test_a_forest_stores_one_table(spark, monkeypatch):
    """The least edges of parts are joined within tasks: the tables stored don't grow with the rounds; the forest is Kruskal's."""
    r = np.random.default_rng(4)
    edges = sorted({(float(w), *sorted((int(a), int(b)))) for w, a, b in zip(r.integers(0, 50, 900), r.integers(0, 200, 900), r.integers(0, 200, 900), strict=True) if a != b})
    up, want = list(range(200)), set()
    for w, a, b in edges:
        x, y = ([n for n in range(200) if up[n] == up[e]] for e in (a, b))
        if up[a] != up[b]:
            want.add((a, b, w))
            for n in y:
                up[n] = up[x[0]]
    stored = []
    store = hierarchy.materialize
    monkeypatch.setattr(hierarchy, "materialize", lambda df, name: stored.append(name) or store(df, name))
    rows = [(k, a, b, w) for k in ("a", "b") for w, a, b in edges]
    got = hierarchy.boruvka(spark.createDataFrame(rows, "k string, a bigint, b bigint, w double").repartition(3)).collect()
    assert {(x.k, min(x.a, x.b), max(x.a, x.b), x.w) for x in got} == {(k, *e) for k in ("a", "b") for e in want}
    assert len(got) == 2 * len(want) and len(stored) == 1
