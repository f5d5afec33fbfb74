"""Clusters at fixed radii over copies and lumps: the tables that are stored stay linear in the points."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from skysift.operators import density, learned, reach
from skysift.operators.components import components


@pytest.fixture()
def stored(monkeypatch):
    """Rows of each table that is stored."""
    rows = []
    for module in (density, learned, reach):
        real = module.materialize

        def counted(df, name, real=real):
            out = real(df, name)
            rows.append((name, out.count()))
            return out

        monkeypatch.setattr(module, "materialize", counted)
    return rows


def points(spark):
    """600 copies of one place, a lump, two lumps that only a thread of points joins, and scatter."""
    rng = np.random.default_rng(3)
    x = np.concatenate([np.full((600, 2), 0.5), rng.normal(0, 0.02, (300, 2)), np.column_stack([np.linspace(0, 0.45, 12), np.linspace(0, 0.45, 12)]), rng.uniform(-2, 2, (100, 2))])
    ids = rng.permutation(len(x))
    return spark.createDataFrame([(0, int(i), float(p), float(q)) for i, (p, q) in zip(ids, x, strict=True)], "g int, id int, p double, q double"), x[np.argsort(ids)]


def test_copies_make_no_pairs(spark, stored):
    frame, x = points(spark)
    got = learned.cluster(frame, "g", ["p", "q"], "id", 0.1, 4)
    assert {r.id: r.cluster for r in got.collect()} == dict(enumerate(learned.density_labels(x, 0.1, 4)))
    assert max(n for _, n in stored) <= 2 * len(x)


def test_rounds_over_copies(spark, stored):
    frame, x = points(spark)
    got = {r.id: (r.cluster, r.round) for r in learned.iterate_clusters(frame, "g", ["p", "q"], "id", 0.1, 6, 2).collect()}
    first = learned.density_labels(x, 0.1, 6)
    left = np.flatnonzero(first < 0)
    second = learned.density_labels(x[left], 0.1, 3)
    want = {n: (c, 0) for n, c in enumerate(first) if c >= 0} | {int(n): (c, 1 if c >= 0 else -1) for n, c in zip(left, second, strict=True)}
    assert got == want and max(n for _, n in stored) <= 2 * len(x)


def test_nested_over_copies(spark, stored):
    """Levels of nested groups as a plain matrix has them, and no table of pairs."""
    frame, x = points(spark)
    got = {r.id: r.cluster for r in density.nested_clusters(frame, "g", ["p", "q"], "id", [0.1, 0.05], 4, 5).collect()}
    assert len(got) == len(x) and len({got[n] for n in np.flatnonzero((x == 0.5).all(1))}) == 1
    assert max(n for _, n in stored) <= 2 * 2 * len(x)


def broadcasts(spark, query):
    """How many plans of what the query ran built a table on the driver."""
    store = spark._jsparkSession.sharedState().statusStore()
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    first = store.executionsCount()
    query()
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    runs = store.executionsList()
    plans = [runs.apply(n).physicalPlanDescription() for n in range(runs.size())][first:]
    assert plans
    return sum("BroadcastExchange" in p for p in plans)


def test_nested_clusters_broadcast_nothing(spark):
    """Groups, positions and links may be as many as the points: none of them passes through the driver."""
    frame, _ = points(spark)
    assert broadcasts(spark, lambda: density.nested_clusters(frame, "g", ["p", "q"], "id", [0.1, 0.05], 4, 5).collect()) == 0


def test_rounds_broadcast_nothing(spark):
    frame, _ = points(spark)
    assert broadcasts(spark, lambda: learned.iterate_clusters(frame, "g", ["p", "q"], "id", 0.1, 6, 2).collect()) == 0


def test_groups_under_a_metric_equal_all_pairs(spark):
    """A metric above the Euclidean one: dense positions and their groups at two radii."""
    frame, x = points(spark)
    metric = lambda o: (1 + o[0] * o[0] + o[1] * o[1]) * reach.euclid(o)
    places = reach.positions(frame.select(F.col("g").alias("k"), "id", F.col("p").alias("x0"), F.col("q").alias("x1")), ["x0", "x1"])
    dense, sparse = reach.dense_groups(places, ["x0", "x1"], [0.12, 0.06], 4, metric)
    off = x[:, None] - x[None]
    d = np.sqrt((off**2).sum(2)) * (1 + (off**2).sum(2))
    for level, radius in enumerate((0.12, 0.06)):
        core = (d <= radius).sum(1) >= 4
        links = [(int(u), int(v)) for u, v in zip(*np.nonzero(d <= radius), strict=True) if u < v and core[u] and core[v]]
        root = {r.node: r.component for r in components(spark.createDataFrame(links, "u int, v int")).collect()}
        first = {tuple(p): n for n, p in reversed(list(enumerate(x.tolist())))}
        want = {n: root.get(n, n) for n in first.values() if core[n]}
        assert {r.id: r.root for r in dense.where(F.col("level") == level).collect()} == want
        assert {r.id for r in sparse.where(F.col("level") == level).collect()} == {n for n in first.values() if not core[n]}
