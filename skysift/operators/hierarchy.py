"""Density clusters from a whole hierarchy: core distances, a minimum spanning tree of mutual reachability, a condensed tree.

No radius is given. Points of a key are packed in blocks along a space-filling order. Whatever needs pairs of points is done for
pairs of blocks in NumPy, at most BLOCK points each; no pair of points is a row, and a block meets another one only with those of
its points that are near enough to matter to it. Core distances ask the blocks that a point's own block can't rule out. For the tree,
neighbouring blocks of the order and points near a foreign block are linked first; those links bound how long an
edge of the tree between two points can be at most, and each point asks the foreign blocks within its bound only. At each threshold
the edges found connect what the complete graph connects, so the tree of them, by Boruvka rounds within tasks, has the complete graph's hierarchy.
The bounds and the condensed tree of a key are made from a few edges a point: that task holds a key's points in numbers, and a gulp
has one candidate a search cell at most.

Defined: points with a null or NaN axis are noise, and so is a key's only point; merges at equal distance are one merge; distances
below LEAST count as LEAST; ids are unique within a key.
"""

from __future__ import annotations

import contextlib
import pickle
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from skysift.stored import materialize

#: Points of a block, bits of an axis in the order, the distance that closer points count as, the core distances within which
#: points are linked first, and the edges of a key that a task gathers before it leaves out those of no tree.
BLOCK, BITS, LEAST, FIRST, EDGES = 2048, 10, 1e-9, 3.0, 1 << 16
Metric = Callable[[np.ndarray, np.ndarray], np.ndarray]


def _of_key(values: list) -> pd.Series:
    """Keys as plain objects: a batch of pandas strings may be in chunks, which Spark's struct batches can't take."""
    return pd.Series(values, dtype=object)


def euclid(p: np.ndarray, others: np.ndarray) -> np.ndarray:
    return np.sqrt(((others - p) ** 2).sum(1))


@contextlib.contextmanager
def _single_rows(spark: SparkSession):
    """Rows here are blocks: few of them go to Python at a time."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, "16")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def _order(axes: list[str]) -> Column:
    """The bits of the axes' cells (c0, c1, ... of BITS bits) in turn, the highest first."""
    out = F.lit(0).cast("bigint")
    for bit in reversed(range(BITS)):
        for c in axes:
            out = F.shiftleft(out, 1).bitwiseOR(F.shiftright(F.col(c), bit).bitwiseAND(F.lit(1)))
    return out


def blocks(points: DataFrame, axes: list[str], size: int = BLOCK) -> DataFrame:
    """k, block, n, lo, hi, points (pickled ids and coordinates) of points (k, id, axes)."""
    spans = points.groupBy("k").agg(*[F.min(a).alias(f"lo{n}") for n, a in enumerate(axes)], *[F.max(a).alias(f"hi{n}") for n, a in enumerate(axes)])
    cells = [f"c{n}" for n in range(len(axes))]
    share = lambda n, a: F.coalesce((F.col(a) - F.col(f"lo{n}")) / F.nullif(F.col(f"hi{n}") - F.col(f"lo{n}"), F.lit(0.0)), F.lit(0.0))
    placed = points.join(spans, "k").withColumns({c: F.least(F.floor(share(n, a) * (1 << BITS)), F.lit((1 << BITS) - 1)).cast("bigint") for n, (c, a) in enumerate(zip(cells, axes, strict=True))})
    ranged = placed.select("k", "id", *axes, _order(cells).alias("__o")).repartitionByRange("k", "__o", "id").sortWithinPartitions("k", "__o", "id")

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []
        made = 0

        def packed(rows: pd.DataFrame) -> pd.DataFrame:
            nonlocal made
            made += 1
            x = rows[axes].to_numpy(float)
            block = (TaskContext.get().partitionId() << 32) + made
            return pd.DataFrame({"k": _of_key([rows["k"].iloc[0]]), "block": [block], "n": [len(x)], "lo": [x.min(0)], "hi": [x.max(0)], "points": [pickle.dumps((rows["id"].to_numpy(np.int64), x))]})

        for batch in batches:
            for _, rows in batch.groupby("k", sort=False):
                if held and held[0]["k"].iloc[0] != rows["k"].iloc[0]:
                    yield packed(pd.concat(held))
                    held = []
                while sum(map(len, held)) + len(rows) >= size:
                    room = size - sum(map(len, held))
                    yield packed(pd.concat([*held, rows.iloc[:room]]))
                    held, rows = [], rows.iloc[room:]
                if len(rows):
                    held.append(rows)
        if held:
            yield packed(pd.concat(held))

    kind = points.schema["k"].dataType.simpleString()
    return ranged.mapInPandas(pack, f"k {kind}, block bigint, n int, lo array<double>, hi array<double>, points binary")


def _gap(a: str, b: str, axes: int) -> Column:
    """The least distance of two boxes."""
    each = [F.greatest(F.lit(0.0), F.col(f"{a}.lo")[n] - F.col(f"{b}.hi")[n], F.col(f"{b}.lo")[n] - F.col(f"{a}.hi")[n]) for n in range(axes)]
    return F.sqrt(sum((g * g for g in each[1:]), each[0] * each[0]))


def _nearest(metric: Metric, x: np.ndarray, y: np.ndarray, count: int, same: bool) -> np.ndarray:
    """For each of x the `count` least distances to y (padded with infinity), itself aside."""
    out = np.full((len(x), count), np.inf)
    for n, p in enumerate(x):
        d = metric(p, y)
        if same:
            d[n] = np.inf
        found = np.sort(np.partition(d, count - 1)[:count]) if len(d) > count else np.sort(d)
        out[n, : len(found)] = found
    return out


def _away(x: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """The least distance of each point to a box, a little less for rounding."""
    return np.sqrt((np.maximum(0.0, np.maximum(lo - x, x - hi)) ** 2).sum(1)) * (1 - 1e-9)


def _asked(own: DataFrame, wanted: DataFrame, packed: DataFrame, shrink: float) -> DataFrame:
    """k, i, j, some: the points of block i that block j may matter to (pickled places in i, and their greatest bound).

    own: k, i, points, bound (a distance for each point). wanted: k, i, j, the box of j (lo, hi) and pair, a bound of the pair; the greater
    bound counts.
    """
    kind = packed.schema["k"].dataType.simpleString()
    others = wanted.groupBy("k", "i").agg(F.collect_list(F.struct("j", "lo", "hi", "pair")).alias("others"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            for k, i, points, bound, near in zip(rows["k"], rows["i"], rows["points"], rows["bound"], rows["others"], strict=True):
                x, bound = pickle.loads(points)[1], np.asarray(bound, float)
                out = []
                for other in near:
                    within = np.maximum(bound, other["pair"])
                    at = np.flatnonzero(_away(x, np.asarray(other["lo"], float), np.asarray(other["hi"], float)) * shrink <= within)
                    if len(at):
                        out.append((other["j"], pickle.dumps((at, float(within[at].max())))))
                if out:
                    yield pd.DataFrame({"k": _of_key([k] * len(out)), "i": [i] * len(out), "j": [j for j, _ in out], "some": [s for _, s in out]})

    with _single_rows(packed.sparkSession):
        return materialize(own.join(others, ["k", "i"]).mapInPandas(run, f"k {kind}, i bigint, j bigint, some binary"), "asked")


def core_distances(packed: DataFrame, axes: int, neighbours: int, metric: Metric, shrink: float) -> DataFrame:
    """k, block, core: for each point of a block the distance to its `neighbours`-th nearest other point of the key (the
    farthest, where there are fewer)."""
    kind = packed.schema["k"].dataType.simpleString()
    spark = packed.sparkSession

    def own(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            near = [_nearest(metric, x, x, neighbours, True) for _, x in map(pickle.loads, rows["points"])]
            yield pd.DataFrame({"k": _of_key(rows["k"].tolist()), "block": rows["block"], "near": [d.ravel() for d in near], "bound": [d[:, -1] for d in near], "reach": [float(d[:, -1].max()) for d in near]})

    with _single_rows(spark):
        first = materialize(packed.mapInPandas(own, f"k {kind}, block bigint, near array<double>, bound array<double>, reach double"), "near")
    boxes = packed.select("k", "block", "lo", "hi").join(first.select("k", "block", "reach"), ["k", "block"])
    side = lambda name: boxes.select("k", F.struct("block", "lo", "hi", "reach").alias(name))
    wanted = side("a").join(side("b"), "k").where((F.col("a.block") != F.col("b.block")) & (_gap("a", "b", axes) * shrink * (1 - 1e-9) <= F.col("a.reach")))
    wanted = wanted.select("k", F.col("a.block").alias("i"), F.col("b.block").alias("j"), "b.lo", "b.hi", F.lit(0.0).alias("pair"))
    mine = packed.select("k", F.col("block").alias("i"), "points").join(first.select("k", F.col("block").alias("i"), "bound"), ["k", "i"])
    both = _with_points(_asked(mine, wanted, packed, shrink), packed, ["points"])

    def across(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            for k, i, some, a, b in zip(rows["k"], rows["i"], rows["some"], rows["points_i"], rows["points_j"], strict=True):
                at = pickle.loads(some)[0]
                yield pd.DataFrame({"k": _of_key([k]), "block": [i], "near": [_nearest(metric, pickle.loads(a)[1][at], pickle.loads(b)[1], neighbours, False).ravel()], "at": [at]})

    with _single_rows(spark):
        second = materialize(both.mapInPandas(across, f"k {kind}, block bigint, near array<double>, at array<bigint>"), "near")

    def merged(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        d = next(np.array(r, float).reshape(-1, neighbours) for r, at in zip(rows["near"], rows["at"], strict=True) if at is None)
        for r, at in zip(rows["near"], rows["at"], strict=True):
            if at is not None:
                at = np.asarray(at, np.int64)
                d[at] = np.sort(np.concatenate([d[at], np.asarray(r, float).reshape(-1, neighbours)], axis=1), axis=1)[:, :neighbours]
        known = np.isfinite(d).sum(1)
        core = np.where(known > 0, d[np.arange(len(d)), np.maximum(known, 1) - 1], np.inf)
        return pd.DataFrame({"k": _of_key([key[0]]), "block": [key[1]], "core": [core], "least": [float(core.min())]})

    whole = first.select("k", "block", "near", F.lit(None).cast("array<bigint>").alias("at"))
    return whole.unionByName(second).groupBy("k", "block").applyInPandas(merged, f"k {kind}, block bigint, core array<double>, least double")


def _with_points(pairs: DataFrame, packed: DataFrame, columns: list[str]) -> DataFrame:
    """Pairs (k, i, j) of blocks with what both hold."""
    side = lambda s: packed.select("k", F.col("block").alias(s), *[F.col(c).alias(f"{c}_{s}") for c in columns])
    return pairs.join(side("i"), ["k", "i"]).join(side("j"), ["k", "j"])


def spanning_tree(x: np.ndarray, core: np.ndarray, metric: Metric = euclid) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ends and weights of a minimum spanning tree of mutual reachability: the greatest of the distance and both core distances."""
    n = len(x)
    ends, best, near = np.zeros((max(n - 1, 0), 2), np.int64), np.full(n, np.inf), np.zeros(n, np.int64)
    weight, left = np.zeros(max(n - 1, 0)), np.ones(n, bool)
    at = 0
    for step in range(n - 1):
        left[at] = False
        d = np.maximum(np.maximum(metric(x[at], x), core), core[at])
        closer = left & (d < best)
        best[closer], near[closer] = d[closer], at
        at = int(np.where(left, best, np.inf).argmin()) if np.isfinite(best[left]).any() else int(np.flatnonzero(left)[0])
        ends[step], weight[step] = (near[at], at), best[at]
    return ends[:, 0], ends[:, 1], weight


def _forest(pairs: DataFrame, packed: DataFrame, metric: Metric) -> DataFrame:
    """Edges (k, a, b, w) of the trees of pairs (k, i, j) of blocks; of one block where i = j."""
    kind = packed.schema["k"].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            for r in rows.itertuples(index=False):
                (ids, x), core = pickle.loads(r.points_i), np.asarray(r.core_i, float)
                if r.i != r.j:
                    more, y = pickle.loads(r.points_j)
                    ids, x, core = np.concatenate([ids, more]), np.concatenate([x, y]), np.concatenate([core, np.asarray(r.core_j, float)])
                a, b, w = spanning_tree(x, core, metric)
                yield pd.DataFrame({"k": _of_key([r.k] * len(a)), "a": ids[a], "b": ids[b], "w": w})

    with _single_rows(packed.sparkSession):
        return materialize(_with_points(pairs, packed, ["points", "core"]).mapInPandas(run, f"k {kind}, a bigint, b bigint, w double"), "forest")


def least_edges(a: np.ndarray, b: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Places of the edges of a minimum spanning forest: in each round the least edge (by weight and ends) of every part, by which parts join."""
    order = np.lexsort((np.maximum(a, b), np.minimum(a, b), weight))
    ids, index = np.unique(np.concatenate([a[order], b[order]]), return_inverse=True)
    u, v = index[: len(order)], index[len(order) :]
    label, kept, left = np.arange(len(ids)), np.zeros(len(order), bool), np.arange(len(order))
    while True:
        left = left[label[u[left]] != label[v[left]]]
        if not len(left):
            return order[kept]
        best = np.full(len(ids), len(order))
        np.minimum.at(best, label[u[left]], left)
        np.minimum.at(best, label[v[left]], left)
        parts = np.flatnonzero(best < len(order))
        e = best[parts]
        kept[e] = True
        other = np.where(label[u[e]] == parts, label[v[e]], label[u[e]])
        up = np.arange(len(ids))
        up[parts] = other
        last = parts[(up[other] == parts) & (parts < other)]  # two parts with one least edge
        up[last] = last
        while (up[up] != up).any():
            up = up[up]
        label = up[label]


def boruvka(edges: DataFrame) -> DataFrame:
    """A minimum spanning forest of edges (k, a, b, w). Each task leaves the forest of its own edges, which holds what the whole one has of
    them; a key's forests, of some edges a point, then meet in one task, as the tree does afterwards."""

    def forest(rows: pd.DataFrame) -> pd.DataFrame:
        return rows.iloc[least_edges(rows["a"].to_numpy(np.int64), rows["b"].to_numpy(np.int64), rows["w"].to_numpy(float))]

    def thin(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[object, list[pd.DataFrame]] = {}
        most: dict[object, int] = {}
        for batch in batches:
            for k, rows in batch.groupby("k", sort=False):
                held.setdefault(k, []).append(rows)
                if sum(map(len, held[k])) > most.get(k, EDGES):
                    held[k] = [forest(pd.concat(held[k]))]
                    most[k] = max(EDGES, 2 * len(held[k][0]))
        for k in held:
            out = forest(pd.concat(held[k]))
            yield out.assign(k=_of_key(out["k"].tolist()).to_numpy())

    def of_key(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        out = forest(rows)
        return pd.DataFrame({"k": _of_key([key[0]] * len(out)), **{c: out[c].to_numpy() for c in ("a", "b", "w")}})

    kind = f"k {edges.schema['k'].dataType.simpleString()}, a bigint, b bigint, w double"
    thinned = materialize(edges.select("k", "a", "b", "w").mapInPandas(thin, kind), "thinned")
    return thinned.groupBy("k").applyInPandas(of_key, kind)


def _across(asked: DataFrame, packed: DataFrame, metric: Metric, shrink: float) -> DataFrame:
    """Edges (k, a, b, w) between two blocks, of the tree of the points of i that ask block j and of those of j within their bound."""
    kind = packed.schema["k"].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            for r in rows.itertuples(index=False):
                at, bound = pickle.loads(r.some)
                (ids, x), (more, y) = pickle.loads(r.points_i), pickle.loads(r.points_j)
                ids, x, core = ids[at], x[at], np.asarray(r.core_i, float)[at]
                near = _away(y, x.min(0), x.max(0)) * shrink <= bound
                if near.any():
                    a, b, w = spanning_tree(np.concatenate([x, y[near]]), np.concatenate([core, np.asarray(r.core_j, float)[near]]), metric)
                    two, ids = (a < len(at)) != (b < len(at)), np.concatenate([ids, more[near]])
                    yield pd.DataFrame({"k": _of_key([r.k] * int(two.sum())), "a": ids[a[two]], "b": ids[b[two]], "w": w[two]})

    with _single_rows(packed.sparkSession):
        return materialize(_with_points(asked, packed, ["points", "core"]).mapInPandas(run, f"k {kind}, a bigint, b bigint, w double"), "across")


class Bottlenecks:
    """Of a forest of edges the longest edge on the best path between two points (numbers below n); infinite without a path."""

    def __init__(self, n: int, a: np.ndarray, b: np.ndarray, weight: np.ndarray):
        # unions by size and without short cuts: a way up has log2(n) steps at most, each joined later than the one before
        up, count, joined, weights = list(range(n)), [1] * n, [n] * n, []
        for e in np.argsort(weight, kind="stable").tolist():
            u, v = int(a[e]), int(b[e])
            while up[u] != u:
                u = up[u]
            while up[v] != v:
                v = up[v]
            if u != v:
                if count[u] < count[v]:
                    u, v = v, u
                up[v], joined[v] = u, len(weights)
                count[u] += count[v]
                weights.append(float(weight[e]))
        self.up, self.joined = np.array(up, np.int64), np.array(joined, np.int64)
        self.weights = np.full(n + 1, np.inf)
        self.weights[: len(weights)] = weights

    def between(self, u: np.ndarray, v: np.ndarray) -> np.ndarray:
        u, v = np.broadcast_arrays(u, v)
        u, v, last = u.copy(), v.copy(), np.full(u.shape, -1)
        while len(apart := np.flatnonzero((u != v) & (last < len(self.up)))):
            first = self.joined[u[apart]] <= self.joined[v[apart]]
            last[apart] = np.where(first, self.joined[u[apart]], self.joined[v[apart]])
            u[apart], v[apart] = np.where(first, self.up[u[apart]], u[apart]), np.where(first, v[apart], self.up[v[apart]])
        return np.where(last < 0, 0.0, self.weights[last])


def _bounds(edges: DataFrame, packed: DataFrame, shrink: float) -> DataFrame:
    """k, i, bound, others (j, lo, hi, pair): no edge of the tree between a point of i and one of j is longer than the greatest of the
    pair's bound and those of both points, by the paths along the edges.

    Each block has a point that stands for it; a point's bound is that of its path to it, a pair's that of the path between both.
    """
    kind = packed.schema["k"].dataType.simpleString()

    def of_key(key: tuple, links: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
        each = [pickle.loads(p)[0] for p in held["points"]]
        ids = np.concatenate(each)
        order = np.argsort(ids)
        number = lambda c: order[np.searchsorted(ids, links[c].to_numpy(np.int64), sorter=order)]
        paths = Bottlenecks(len(ids), number("a"), number("b"), links["w"].to_numpy(float))
        ends = np.cumsum([len(p) for p in each])
        spans = [np.arange(e - len(p), e) for p, e in zip(each, ends, strict=True)]
        stands = np.array([s[paths.joined[s].argmax()] for s in spans])
        lo, hi = np.stack(held["lo"].tolist()), np.stack(held["hi"].tolist())
        names, least = held["block"].to_numpy(), held["least"].to_numpy(float)
        out = []
        for n, span in enumerate(spans):
            bound, pair = paths.between(span, stands[n]), paths.between(stands, stands[n])
            gap = np.sqrt((np.maximum(0.0, np.maximum(lo - hi[n], lo[n] - hi)) ** 2).sum(1)) * (1 - 1e-9)
            near = np.flatnonzero((np.maximum(gap * shrink, np.maximum(least, least[n])) <= np.maximum(pair, bound.max())) & (np.arange(len(names)) != n))
            out.append((key[0], int(names[n]), bound, names[near], lo[near].ravel(), hi[near].ravel(), pair[near]))
        return pd.DataFrame({"k": _of_key([r[0] for r in out]), **{c: [r[m] for r in out] for m, c in enumerate(("i", "bound", "j", "lo", "hi", "pair"), 1)}})

    boxes = packed.select("k", "block", "lo", "hi", "least", "points")
    found = edges.groupBy("k").cogroup(boxes.groupBy("k")).applyInPandas(of_key, f"k {kind}, i bigint, bound array<double>, j array<bigint>, lo array<double>, hi array<double>, pair array<double>")
    return materialize(found, "bounds")


def reachability_tree(packed: DataFrame, axes: int, metric: Metric, shrink: float) -> DataFrame:
    """Edges (k, a, b, w) of a minimum spanning tree of each key. packed: blocks with core distances and the least of them."""
    order = Window.partitionBy("k").orderBy("block")  # one row a block
    chain = materialize(packed.select("k", F.col("block").alias("i"), F.lead("block").over(order).alias("j"), F.count("*").over(Window.partitionBy("k")).alias("blocks")), "chain")
    alone = _forest(chain.where("blocks = 1").select("k", "i", F.col("i").alias("j")), packed, metric)
    first = _forest(chain.where("j is not null").select("k", "i", "j"), packed, metric)
    # links of points near a foreign block, so that paths don't have to follow the order of blocks
    own = packed.select("k", F.col("block").alias("i"), "points", F.transform("core", lambda c: c * FIRST).alias("bound"))
    side = lambda name: packed.select("k", F.struct("block", "lo", "hi", (F.array_max("core") * FIRST).alias("reach")).alias(name))
    close = side("a").join(side("b"), "k").where((F.col("a.block") != F.col("b.block")) & (_gap("a", "b", axes) * shrink * (1 - 1e-9) <= F.col("a.reach")))
    close = close.select("k", F.col("a.block").alias("i"), F.col("b.block").alias("j"), "b.lo", "b.hi", F.lit(0.0).alias("pair"))
    edges = first.unionByName(_across(_asked(own, close, packed, shrink), packed, metric, shrink))
    # each point asks what its paths so far don't rule out
    several = packed.join(chain.where("blocks > 1").select("k").distinct(), "k", "left_semi")
    bounds = _bounds(edges, several, shrink)
    own = packed.select("k", F.col("block").alias("i"), "points").join(bounds.select("k", "i", "bound"), ["k", "i"])
    parts = lambda c: F.slice(c, F.col("n") * axes + 1, axes).alias(c)
    left = bounds.select("k", "i", "lo", "hi", "pair", F.posexplode("j").alias("n", "j")).select("k", "i", "j", parts("lo"), parts("hi"), F.get("pair", F.col("n")).alias("pair"))
    return alone.unionByName(boruvka(edges.unionByName(_across(_asked(own, left, packed, shrink), packed, metric, shrink))))


def condensed(ids_a: np.ndarray, ids_b: np.ndarray, weight: np.ndarray, size: int, whole: bool = False) -> dict[int, tuple[int, float]]:
    """Of each clustered id its cluster (the least id of its members) and the cluster's stability.

    From the shortest edge up, parts join; all merges at one distance are one. A part of `size` points is a cluster. It
    lives on while smaller parts join it, and ends where parts of that size meet: they become parts of a new one. With
    1 / distance for density, a cluster's stability is the sum over its points of the density at which they leave it, less that at which it
    ends. Of a cluster and its parts the more stable choice counts (the cluster at ties). whole: a cluster that holds
    everything may be chosen.
    """
    ids, index = np.unique(np.concatenate([ids_a, ids_b]), return_inverse=True)
    a, b = index[: len(ids_a)], index[len(ids_a) :]
    order = np.argsort(weight, kind="stable")
    root = list(range(len(ids)))
    count = [1] * len(ids)
    members: list[list[int]] = [[n] for n in range(len(ids))]  # of parts that are no cluster yet
    cluster = [-1] * len(ids)  # of the part with this root
    gained: list[float] = []
    children: list[list[int]] = []
    held: list[list[int]] = []
    birth: list[float] = []

    def top(n: int) -> int:
        while root[n] != n:
            root[n] = root[root[n]]
            n = root[n]
        return n

    def new_cluster(parts: list[int]) -> int:
        gained.append(0.0)
        birth.append(0.0)
        held.append([])
        children.append(parts)
        return len(gained) - 1

    at = 0
    while at < len(order):
        stop = at
        while stop < len(order) and weight[order[stop]] == weight[order[at]]:
            stop += 1
        density = 1.0 / max(float(weight[order[at]]), LEAST)
        met: dict[int, set[int]] = {}
        for e in order[at:stop].tolist():
            u, v = top(int(a[e])), top(int(b[e]))
            if u == v:
                continue
            mine, other = met.pop(u, {u}), met.pop(v, {v})
            if len(mine) < len(other):
                mine, other = other, mine
            mine |= other
            big, small = (u, v) if count[u] >= count[v] else (v, u)
            root[small] = big
            met[big] = mine
            count[big] += count[small]
        for base, parts in met.items():
            total = count[base]
            grown = [p for p in parts if cluster[p] >= 0]
            loose = [p for p in parts if cluster[p] < 0]
            if len(grown) == 1:
                c = cluster[grown[0]]
            elif total >= size:
                c = new_cluster([cluster[p] for p in grown])
                for p in grown:
                    birth[cluster[p]] = density
            else:
                c = -1
            if c >= 0:
                for p in loose:
                    held[c] += members[p]
                    gained[c] += density * len(members[p])
                    members[p] = []
                if len(grown) > 1:
                    gained[c] += density * sum(strength(cluster[p], held, children) for p in grown)
                for p in parts:
                    cluster[p] = -1
                cluster[base] = c
            else:
                longest = max(parts, key=lambda p: len(members[p]))
                joined = members[longest]
                for p in parts:
                    if p != longest:
                        joined += members[p]
                        members[p] = []
                members[longest] = []
                members[base] = joined
        at = stop
    last = {cluster[top(n)] for n in range(len(ids))} - {-1}
    # bottom up: clusters are numbered after their parts
    points = [0] * len(gained)
    best, chosen = [0.0] * len(gained), [False] * len(gained)
    for c in range(len(gained)):
        points[c] = len(held[c]) + sum(points[p] for p in children[c])
        own = gained[c] - birth[c] * points[c]
        below = sum(best[p] for p in children[c])
        chosen[c] = own >= below and (whole or c not in last)
        best[c] = own if chosen[c] else below
    out: dict[int, tuple[int, float]] = {}
    stack = list(last)
    while stack:
        c = stack.pop()
        if not chosen[c]:
            stack += children[c]
            continue
        inside, todo = [], [c]
        while todo:
            n = todo.pop()
            inside += held[n]
            todo += children[n]
        name = int(ids[min(inside)])
        out |= {int(ids[n]): (name, best[c]) for n in inside}
    return out


def strength(c: int, held: list[list[int]], children: list[list[int]]) -> int:
    """Points of a cluster with all its parts."""
    total, todo = 0, [c]
    while todo:
        n = todo.pop()
        total += len(held[n])
        todo += children[n]
    return total


def _cored(cands: DataFrame, key: str, axes: list[str], id_col: str, neighbours: int, metric: Metric, shrink: float, block: int) -> tuple[DataFrame, DataFrame]:
    """All points (k, id, x0, x1, ...), and the blocks of those with whole coordinates with their core distances; both stored."""
    names = [f"x{n}" for n in range(len(axes))]
    every = materialize(cands.select(F.col(key).alias("k"), F.col(id_col).cast("bigint").alias("id"), *[F.col(a).cast("double").alias(x) for a, x in zip(axes, names, strict=True)]), "points")
    good = every.where(" and ".join(f"{x} is not null and not isnan({x})" for x in names) + " and k is not null and id is not null")
    packed = materialize(blocks(good, names, block), "blocks")
    core = materialize(core_distances(packed, len(axes), neighbours, metric, shrink), "core")
    return every, materialize(packed.join(core, ["k", "block"]), "cored")


def core_of_points(cands: DataFrame, key: str, axes: list[str], id_col: str, neighbours: int, metric: Metric = euclid, shrink: float = 1.0, block: int = BLOCK) -> DataFrame:
    """key, id, core: the distance of each point to its `neighbours`-th nearest other one of the key (infinite without any)."""
    _, packed = _cored(cands, key, axes, id_col, neighbours, metric, shrink, block)

    def unpack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            for k, points, core in zip(rows["k"], rows["points"], rows["core"], strict=True):
                ids = pickle.loads(points)[0]
                yield pd.DataFrame({"k": _of_key([k] * len(ids)), "id": ids, "core": np.asarray(core, float)})

    kind = packed.schema["k"].dataType.simpleString()
    return packed.select("k", "points", "core").mapInPandas(unpack, f"k {kind}, id bigint, core double").select(F.col("k").alias(key), F.col("id").alias(id_col), "core")


def clusters(cands: DataFrame, key: str, axes: list[str], id_col: str, size: int, neighbours: int = 2, metric: Metric = euclid, shrink: float = 1.0, whole: bool = False, block: int = BLOCK) -> DataFrame:
    """key, id, cluster (the least id of its members, null for noise) and its stability.

    metric gives the distances of one point to others; shrink is the least ratio of it to the Euclidean one (0: unknown, then no
    pair of blocks is left out).
    """
    every, packed = _cored(cands, key, axes, id_col, neighbours, metric, shrink, block)
    edges = materialize(reachability_tree(packed, len(axes), metric, shrink), "tree")
    kind = every.schema["k"].dataType.simpleString()

    def pick(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        found = condensed(rows["a"].to_numpy(np.int64), rows["b"].to_numpy(np.int64), rows["w"].to_numpy(float), size, whole)
        return pd.DataFrame({"k": _of_key([key[0]] * len(found)), "id": list(found), "cluster": [c for c, _ in found.values()], "stability": [s for _, s in found.values()]})

    labels = edges.groupBy("k").applyInPandas(pick, f"k {kind}, id bigint, cluster bigint, stability double")
    out = every.select("k", "id").join(labels, ["k", "id"], "left")
    return materialize(out.select(F.col("k").alias(key), F.col("id").alias(id_col), "cluster", "stability"), "clusters")


def rounds(cands: DataFrame, key: str, axes: list[str], id_col: str, size: int, most: int, **how) -> DataFrame:
    """Clusters of what is still noise, again and again with size, size // 2, ... (2 at least) members, until a round finds none;
    with the round that found each (null: noise)."""
    left, out = cands, None
    for r in range(most):
        got = clusters(left, key, axes, id_col, max(size // (r + 1), 2), **how).withColumn("round", F.lit(r))
        found = got.where("cluster is not null")
        if not found.limit(1).count():
            break
        out = found if out is None else out.unionByName(found)
        left = left.join(found.select(key, id_col), [key, id_col], "left_anti")
    noise = left.select(F.col(key), F.col(id_col).cast("bigint").alias(id_col), F.lit(None).cast("bigint").alias("cluster"), F.lit(None).cast("double").alias("stability"), F.lit(None).cast("int").alias("round"))
    return noise if out is None else out.unionByName(noise)
