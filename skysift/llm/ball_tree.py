"""Exact top-k by inner product: ball trees by shard, branch and bound, and a k-th score that shards share.

Vectors become integers, floor(1024 x). Cells around pivots (from a bounded sample; they only shape the shards) are cut into
shards of bounded size, and each shard is stored as one row with its ball tree: nodes have an integer centre and a radius
rounded up, so q.c + |q| r bounds every product below a node in exact arithmetic. A query goes first to the shards of the
cell that suits it best; its k-th score so far is stored and goes along to the shards of other cells, in rounds of more and more cells of
falling bound; cells and nodes whose bound is below it are left out. In a shard a query takes its leaves in
order of their bounds, blocks of queries at once.

Queries meet shards by an equality on (shard, block of queries): a task holds one shard and at most QUERY_BLOCK queries.

Defined results: a null vector, or one with a null or non-finite component, takes no part; nor does one without
an id, or whose squared integer length is above 2 ** 60 (its scores needn't fit a long). Equal rows count once; rows of
one id with other vectors are queries and candidates of their own, but never candidates of their own id. Vectors of
another length than the query's aren't compared with it; equal scores go to the smaller id; empty vectors score 0; an
empty table gives an empty result; only the id and vector columns are read.
"""

from __future__ import annotations

import math
import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skysift.llm.support import materialize, short_batches

#: Integer units of a component; the squared length that a vector may have.
SCALE, MOST_SQUARED = 1024, 1 << 60
#: Rows of a shard (about), of a leaf, of a block of queries; vectors sampled for pivots, pivots at most; tables of fewer rows
#: get up to FEW_SHARDS shards of FEW_ROWS.
SHARD_ROWS, LEAF_ROWS, QUERY_BLOCK = 32_768, 64, 8192
SAMPLE, PIVOTS, FEW_SHARDS, FEW_ROWS = 8192, 512, 24, 2048
#: Cells that a query tries in each round (the last one: all that are left).
ROUNDS = (1, 4, None)


def integers(rows: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """vec_id, dim, v (int32, little-endian) of the rows that take part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, dims, out = [], [], []
            for vec_id, vector in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                if vec_id is None or not vector.is_valid or vector.values.null_count:
                    continue
                x = np.floor(vector.values.to_numpy(zero_copy_only=False).astype(np.float64) * SCALE)
                if not np.isfinite(x).all() or float(x @ x) > MOST_SQUARED:
                    continue
                ids.append(vec_id)
                dims.append(len(x))
                out.append(x.astype("<i4").tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(dims, pa.int32()), pa.array(out, pa.binary())], names=["vec_id", "dim", "v"])

    short_batches(rows.sparkSession)
    return rows.select(id_col, vector_col).mapInArrow(run, "vec_id bigint, dim int, v binary").dropDuplicates(["vec_id", "v"])


def unpacked(raw: list[bytes], dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(raw), "<i4").reshape(len(raw), dim)


def _longest(x: np.ndarray) -> int:
    """The largest length of the rows, rounded up."""
    return math.isqrt(int((x.astype(np.int64) ** 2).sum(1).max(initial=0))) + 1


def _lengths(x: np.ndarray) -> np.ndarray:
    """The length of each row, rounded up."""
    return np.sqrt((x.astype(np.float64) ** 2).sum(1)).astype(np.int64) + 2


def products(a: np.ndarray, b: np.ndarray, most: int) -> np.ndarray:
    """a b' of integers, exactly. most: the largest length in a times that in b; it bounds every partial sum, so floats that hold it are exact."""
    kind = np.float32 if most < 1 << 24 else np.float64 if most < 1 << 53 else np.int64
    return (a.astype(kind) @ b.astype(kind).T).astype(np.int64)


def split(x: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two halves of rows along the line between two far points."""
    y = x[rows].astype(np.float64)
    far = y[((y - y[0]) ** 2).sum(1).argmax()]
    other = y[((y - far) ** 2).sum(1).argmax()]
    order = np.argsort(y @ (other - far), kind="stable")
    return rows[order[: len(order) // 2]], rows[order[len(order) // 2 :]]


def pivots(sample: np.ndarray, count: int) -> np.ndarray:
    """Centres of `count` parts at most of the sample, the largest part halved again and again."""
    parts = [np.arange(len(sample))]
    while len(parts) < count and len(parts[-1]) > 1:
        a, b = split(sample, parts.pop())
        parts = sorted([*parts, a, b], key=len)
    return np.stack([np.rint(sample[p].mean(0)) for p in parts]).astype(np.int64)


def ball(x: np.ndarray) -> tuple[np.ndarray, int]:
    """Integer centre and radius (rounded up) of a ball about the rows."""
    centre = np.rint(x.mean(0)).astype(np.int64)
    return centre, _longest(x.astype(np.int64) - centre)


@dataclass(frozen=True)
class BallTree:
    """Rows of one shard in leaf order; node k has children 2k+1 and 2k+2, leaves are all on the last level."""

    ids: np.ndarray
    x: np.ndarray
    centres: np.ndarray
    radii: np.ndarray
    starts: np.ndarray
    longest: int

    @staticmethod
    def of(ids: np.ndarray, x: np.ndarray) -> BallTree:
        levels = max(0, math.ceil(math.log2(max(1, len(ids)) / LEAF_ROWS)))
        parts = [np.arange(len(ids))]
        balls = [ball(x)]
        for _ in range(levels):
            parts = [half for part in parts for half in split(x, part)]
            balls += [ball(x[p]) for p in parts]
        order = np.concatenate(parts)
        return BallTree(ids[order], np.ascontiguousarray(x[order]), np.stack([c for c, _ in balls]), np.array([r for _, r in balls]), np.concatenate([[0], np.cumsum([len(p) for p in parts])]), _longest(x))

    def bounds(self, q: np.ndarray, longest: int, lengths: np.ndarray, nodes: np.ndarray) -> np.ndarray:
        """For each query and node what no product below the node exceeds."""
        c = self.centres[nodes]
        return products(q, c, longest * _longest(c)) + lengths[:, None] * self.radii[nodes][None, :]


class Best:
    """The k best (score, id) of each query so far, and the scores that others know."""

    def __init__(self, queries: int, k: int, floor: np.ndarray):
        self.k, self.floor = k, floor.copy()
        self.who, self.score, self.ids = (np.zeros(0, np.int64) for _ in range(3))
        self.queries = queries

    def add(self, who: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        who, score, ids = np.concatenate([self.who, who]), np.concatenate([self.score, score]), np.concatenate([self.ids, ids])
        order = np.lexsort((ids, -score, who))
        who, score, ids = who[order], score[order], ids[order]
        start = np.searchsorted(who, np.arange(self.queries))
        nth = np.arange(len(who)) - start[who]
        kept = nth < self.k
        last = nth == self.k - 1
        self.floor[who[last]] = np.maximum(self.floor[who[last]], score[last])
        self.who, self.score, self.ids = who[kept], score[kept], ids[kept]


def search(tree: BallTree, ids: np.ndarray, q: np.ndarray, floor: np.ndarray, k: int) -> tuple[Best, int]:
    """The best of one shard for a block of queries that know a k-th score each (floor), and how many products were made.

    From the root down, a node is left out for the queries whose k-th score its bound doesn't reach. Then each query takes its
    leaves by falling bound, ever more at a time, with its k-th score brought up to date in between.
    """
    best, made = Best(len(q), k, floor), 0
    longest = _longest(q)
    lengths = _lengths(q)
    leaves = len(tree.starts) - 1
    who, node = np.arange(len(q)), np.zeros(len(q), np.int64)
    first, width = 0, 1
    while True:
        bound = tree.bounds(q, longest, lengths, np.arange(first, first + width))[who, node - first]
        alive = bound >= best.floor[who]
        who, node, bound = who[alive], node[alive], bound[alive]
        if width == leaves or not len(who):
            break
        who, node = np.repeat(who, 2), np.stack([2 * node + 1, 2 * node + 2], 1).ravel()
        first, width = 2 * first + 1, 2 * width
    order = np.lexsort((node, -bound, who))
    who, leaf, bound = who[order], node[order] - first, bound[order]
    nth = np.arange(len(who)) - np.searchsorted(who, np.arange(len(q)))[who] if len(who) else who
    low, high = 0, 1
    while (nth >= low).any():
        now = (nth >= low) & (nth < high) & (bound >= best.floor[who])
        w, at = who[now], leaf[now]
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        by = np.argsort(at, kind="stable")
        for group in np.split(by, np.flatnonzero(np.diff(at[by])) + 1) if len(by) else []:
            a, b = tree.starts[at[group[0]]], tree.starts[at[group[0]] + 1]
            score = products(q[w[group]], tree.x[a:b], longest * tree.longest)
            made += score.size
            r, c = np.nonzero((score >= best.floor[w[group]][:, None]) & (tree.ids[a:b][None, :] != ids[w[group]][:, None]))
            if len(r):
                found.append((w[group][r], score[r, c], tree.ids[a:b][c]))
        if found:
            best.add(*(np.concatenate(x) for x in zip(*found, strict=True)))
        low, high = high, 3 * high
    return best, made


def celled(vectors: DataFrame, centres: dict[int, np.ndarray]) -> DataFrame:
    """vectors with the number of the nearest pivot of their length and the squared distance to it. The pivots go as a broadcast
    variable; a length that the sample lacks has one cell about 0."""
    shared = vectors.sparkSession.sparkContext.broadcast(centres)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = np.asarray(batch.column("dim"))
            cell, apart = np.zeros(len(dims), np.int64), np.zeros(len(dims), np.int64)
            for dim in np.unique(dims).tolist():
                at = np.flatnonzero(dims == dim)
                c = shared.value.get(dim, np.zeros((1, dim), np.int64))
                x = unpacked([batch.column("v")[k].as_py() for k in at.tolist()], dim).astype(np.int64)
                cell[at] = (x.astype(float) @ c.T.astype(float) - (c.astype(float) ** 2).sum(1) / 2).argmax(1)
                apart[at] = ((x - c[cell[at]]) ** 2).sum(1)
            yield batch.append_column("cell", pa.array(cell)).append_column("apart", pa.array(apart))

    return vectors.mapInArrow(run, "vec_id bigint, dim int, v binary, cell bigint, apart bigint")


def sampled_pivots(vectors: DataFrame, shards: int) -> dict[int, np.ndarray]:
    """Pivots for each length of vectors in a sample of SAMPLE vectors by hash order: PIVOTS and one a length at most."""
    sample = vectors.select("dim", "v").orderBy(F.xxhash64("vec_id", "v")).limit(SAMPLE).collect()
    out = {}
    for dim in sorted({r.dim for r in sample}):
        own = unpacked([r.v for r in sample if r.dim == dim], dim)
        out[dim] = pivots(own, max(1, min(PIVOTS, shards) * len(own) // len(sample)))
    return out


@dataclass(frozen=True)
class Index:
    """trees: a stored row for each shard (cell, shard, dim, tree); cells: (dim, cell, salts), how many shards a cell has; balls:
    for each length that has pivots its cells, their centres and radii."""

    trees: DataFrame
    cells: DataFrame
    balls: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]


def index(vectors: DataFrame) -> Index:
    """The stored shards of all vectors."""
    count = vectors.count()
    shards = max(-(-count // SHARD_ROWS), min(FEW_SHARDS, -(-count // FEW_ROWS)), 1)
    most = max(1, -(-count // shards))
    centres = sampled_pivots(vectors, shards)
    placed = materialize(celled(vectors, centres), "celled")
    # a cell with more rows than a shard should have is dealt over several
    cells = materialize(placed.groupBy("dim", "cell").agg(F.ceil(F.count("*") / most).cast("int").alias("salts"), F.max("apart").alias("apart")), "cells")
    dealt = placed.join(cells.select("dim", "cell", "salts"), ["dim", "cell"]).withColumn("shard", F.pmod(F.xxhash64("vec_id", "v"), F.col("salts").cast("bigint")))

    def make(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        cell, shard, dim = (int(k) for k in key)
        rows = rows.sort_values(["vec_id", "v"])
        tree = BallTree.of(rows["vec_id"].to_numpy(np.int64), unpacked(rows["v"].tolist(), dim))
        return pd.DataFrame({"cell": [cell], "shard": [shard], "dim": [dim], "tree": [pickle.dumps(tree, protocol=5)]})

    trees = dealt.select("cell", "shard", "dim", "vec_id", "v").groupBy("cell", "shard", "dim").applyInPandas(make, "cell bigint, shard bigint, dim int, tree binary")
    balls = {}
    found = cells.where(F.col("dim").isin(list(centres))).collect() if centres else []  # no more rows than pivots
    for dim, c in centres.items():
        own = sorted((r.cell, math.isqrt(r.apart) + 1) for r in found if r.dim == dim)
        at = np.array([k for k, _ in own])
        balls[dim] = (at, c[at], np.array([r for _, r in own]))
    return Index(materialize(trees, "ball-trees"), cells, balls)


def _reach(queries: DataFrame, made: Index, taken: int, upto: int | None) -> DataFrame:
    """A row for each query and shard of its turn: of the cells by falling bound those from place `taken` to `upto`, if the k-th
    score reaches them, with all shards of each."""
    shared = queries.sparkSession.sparkContext.broadcast(made.balls)
    names = ["query_id", "dim", "v", "floor", "block"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = np.asarray(batch.column("dim"))
            for dim in np.unique(dims).tolist():
                part = batch.filter(pa.array(dims == dim))
                if dim in shared.value:
                    cell, centre, radius = shared.value[dim]
                    q = unpacked(part.column("v").to_pylist(), dim)
                    bound = products(q, centre, _longest(q) * _longest(centre)) + _lengths(q)[:, None] * radius[None, :]
                    turn = np.argsort(-bound, axis=1, kind="stable")[:, taken:upto]
                    r, c = np.repeat(np.arange(len(q)), turn.shape[1]), turn.ravel()
                    keep = bound[r, c] >= np.asarray(part.column("floor"))[r]
                    r, at = r[keep], cell[c[keep]]
                else:
                    r = np.arange(0 if taken else part.num_rows)
                    at = np.zeros(len(r), np.int64)
                rows = part.take(pa.array(r))
                yield pa.RecordBatch.from_arrays([*(rows.column(c) for c in names), pa.array(at, pa.int64())], names=[*names, "cell"])

    reached = queries.select(*names).mapInArrow(run, "query_id bigint, dim int, v binary, floor bigint, block int, cell bigint")
    return reached.join(made.cells.select("dim", "cell", "salts"), ["dim", "cell"]).withColumn("shard", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("salts").cast("bigint") - 1))).drop("salts")


_FOUND = "query_id bigint, v binary, vec_id bigint, score bigint"


def _searched(asked: DataFrame, trees: DataFrame, blocks: int, k: int) -> DataFrame:
    """The best k of each asked query in each of its shards."""

    def run(key: tuple, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            return pd.DataFrame({c.split()[0]: [] for c in _FOUND.split(", ")})
        tree: BallTree = pickle.loads(right["tree"].iloc[0])
        q = unpacked(left["v"].tolist(), int(right["dim"].iloc[0]))
        best, _ = search(tree, left["query_id"].to_numpy(np.int64), q, left["floor"].to_numpy(np.int64), k)
        return pd.DataFrame({"query_id": left["query_id"].to_numpy()[best.who], "v": left["v"].to_numpy()[best.who], "vec_id": best.ids, "score": best.score})

    keys = ["cell", "shard", "dim", "block"]
    spread = trees.select("cell", "shard", "dim", "tree").withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    return asked.groupBy(*keys).cogroup(spread.groupBy(*keys)).applyInPandas(run, _FOUND)


def top_k(rows: DataFrame, queries: str, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: for each row that meets the condition (on vec_id) its k best other rows."""
    spark = rows.sparkSession
    vectors = materialize(integers(rows, id_col, vector_col), "vectors")
    made = index(vectors)
    asked = vectors.where(queries).select(F.col("vec_id").alias("query_id"), "dim", "v")
    blocks = max(1, -(-asked.count() // QUERY_BLOCK))
    least = -(1 << 62)
    asked = asked.withColumn("block", F.pmod(F.xxhash64("query_id", "v"), F.lit(blocks)).cast("int"))
    best: DataFrame | None = None
    taken = 0
    order = Window.partitionBy("query_id", "v").orderBy(F.desc("score"), "vec_id")
    for count in ROUNDS:
        if taken and taken >= max((len(b[0]) for b in made.balls.values()), default=0):
            break
        known = asked.withColumn("floor", F.lit(least).cast("bigint"))
        if best is not None:
            reached = best.where(F.col("rank") == k).select("query_id", "v", F.col("score").alias("floor"))
            known = asked.join(reached, ["query_id", "v"], "left").withColumn("floor", F.coalesce("floor", F.lit(least).cast("bigint")))
        upto = None if count is None else taken + count
        found = _searched(_reach(known, made, taken, upto), made.trees, blocks, k)
        every = found if best is None else found.unionByName(best.select("query_id", "v", "vec_id", "score"))
        best = materialize(every.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k), "best")
        taken = upto or taken
        if upto is None:
            break
    return best.select("query_id", "rank", "vec_id", "score")
