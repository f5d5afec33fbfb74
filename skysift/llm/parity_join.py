"""N-gram Jaccard join by parity sketches.

A set A of shingles can only reach Jaccard 0.8 with sets that differ from it in at most |A| / 4
shingles, and a pair of sizes a and b in at most (a + b) / 9. So that this bound can be joined on, the
hash range is split into blocks whose number depends on the size band alone, and each block of a set
is the XOR of its shingles' hashes (a parity sketch: one differing shingle changes one block at most,
so the count of unequal blocks bounds the symmetric difference from below). By the pigeonhole
principle, for one order of blocks that all sets share, two similar sets have an equal block among the
first |A| / 4 + 1 of either. The order puts blocks of rare shingles first and full ones before sparse
ones, so that passages that many texts share seldom make candidates; which shingles count as frequent is
read off a bounded sample and steers nothing but that order. Blocks are so many that a set has that
many of them: in the lowest bands each shingle is a block of its own, and above them a set that falls
short has odds below 1e-15, so no key is there that unrelated sets would share.

A set near the lower edge of its band is also registered in the band below, as its partners may be there;
so sets that share a block differ in size by a factor of 2.5 at most.

Candidates that share a block are first compared with one hub of the block (linear work, three rounds
with other hubs each), links merge into components, and only members of different components then
meet in pairs, past a second parity sketch of 512 bits whose Hamming distance must stay within the
bound. What passes is verified on whole sets. No link between different texts is lost, for pairs that
are skipped are in one component already.

Defined results: a null text, an empty one and one without words have no shingles and no links; equal
sets are one class and linked; rows that repeat are reported once each; where rows of one id differ in
their text, each has its own n_shingles, and the id's links are those of the set with the least digest; a
row without id is reported without component; an empty table gives an empty result; only id and text are
read. first_of_each() keeps one row of each id that stays (of rows with one id, the one with the least
hash of its text) and all rows without an id.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skysift.llm.components import components
from skysift.llm.shingles import mix, shingles
from skysift.llm.support import materialize, short_batches, text_rows

#: Bands are powers of 2. Shingles a block holds on average in a set at the upper edge of its band (a quarter
#: more in sets registered from the band above), blocks at least, and the highest band of one shingle a block.
LOAD, LEAST_BLOCKS, SINGLE = 2.5, 64, 4
WORDS = 8
#: Documents sampled for frequent shingles, hits that make one frequent, and how many are kept.
SAMPLE_DOCS, SAMPLE_HITS, FREQUENT = 4000, 5, 200_000
HUB_ROUNDS = 3

_SKETCH = [f"p{k}" for k in range(WORDS)]
_KEYS = "doc_id bigint, n bigint, k1 bigint, k2 bigint, " + ", ".join(f"{p} bigint" for p in _SKETCH) + ", blocks array<bigint>"


def bands(size: int) -> list[int]:
    """The band of a size, and the one below where partners may be in it."""
    band = size.bit_length() - 1
    return [band, band - 1] if band and 4 * size < 5 * 2**band else [band]


def blocks_of(found: np.ndarray, band: int) -> tuple[np.ndarray, np.ndarray]:
    """Parities and shingle counts of the blocks of a sorted set that aren't empty."""
    count = max(LEAST_BLOCKS, int(np.ceil(2 ** (band + 1) / LOAD))) if band > SINGLE else 1 << 32
    at = ((found >> np.uint64(32)) * np.uint64(count)) >> np.uint64(32)
    starts = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
    parity = np.bitwise_xor.reduceat(mix(found + np.uint64(band)), starts)
    return mix(parity ^ mix(at[starts] * np.uint64(64) + np.uint64(band + 1))), np.diff(np.append(starts, len(found)))


def signatures(found: np.ndarray, frequent: np.ndarray) -> np.ndarray:
    """The first size // 4 + 1 blocks of each band in the order that all sets share (see above: they don't run out)."""
    out = []
    if len(frequent):
        near = frequent[np.minimum(np.searchsorted(frequent, found), len(frequent) - 1)]
        families = [found[near != found], found[near == found]]
    else:
        families = [found]
    need = len(found) // 4 + 1
    for band in bands(len(found)):
        got = []
        for rank, family in enumerate(families):
            if len(family):
                parity, held = blocks_of(family, band)
                parity = mix(parity + np.uint64(rank))
                got.append(parity[np.lexsort((parity, -held))])
        out.append(np.concatenate(got)[:need])
    return np.concatenate(out)


def digest(found: np.ndarray) -> tuple[int, int]:
    """128 bits of a set that isn't empty, as two integers."""
    total = np.array([np.sum(found, dtype=np.uint64)], np.uint64)
    return int(mix(total).view(np.int64)[0]), int(np.bitwise_xor.reduce(mix(found)).view(np.int64))


def sketch(found: np.ndarray) -> np.ndarray:
    """Parity sketch of 64 * WORDS bits: each shingle flips one."""
    bit = (mix(found ^ np.uint64(0x9E3779B97F4A7C15)) & np.uint64(64 * WORDS - 1)).astype(np.int64)
    return np.packbits((np.bincount(bit, minlength=64 * WORDS) & 1).astype(np.uint8)).view("<i8")


def frequent_shingles(docs: DataFrame) -> np.ndarray:
    """Shingles of many documents of a sample (SAMPLE_DOCS by hash of the id): at most FREQUENT."""
    every = max(1, docs.count() // SAMPLE_DOCS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, texts in text_rows(batches):
            for text in texts:
                yield pa.RecordBatch.from_arrays([pa.array(shingles(text).view(np.int64))], names=["s"])

    short_batches(docs.sparkSession)
    sample = docs.where(F.pmod(F.xxhash64("doc_id"), F.lit(every)) == 0).select("text").mapInArrow(run, "s bigint")
    top = sample.groupBy("s").count().where(F.col("count") >= SAMPLE_HITS).orderBy(F.desc("count"), "s").limit(FREQUENT).select("s")
    return np.sort(np.array([r.s for r in top.collect()], np.int64).view(np.uint64))


def keyed(docs: DataFrame, frequent: np.ndarray) -> DataFrame:
    """One row a document: size and digest of its set, 512-bit sketch and block signatures."""
    shared = docs.sparkSession.sparkContext.broadcast(frequent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        often = shared.value
        for batch, texts in text_rows(batches):
            size, k1, k2, bits, sigs, at = [], [], [], np.zeros((len(texts), WORDS), np.int64), [], [0]
            for n, text in enumerate(texts):
                found = shingles(text)
                size.append(len(found))
                if len(found):
                    first, second = digest(found)
                    k1.append(first)
                    k2.append(second)
                    bits[n] = sketch(found)
                    sigs.append(signatures(found, often).view(np.int64))
                    at.append(at[-1] + len(sigs[-1]))
                else:
                    k1.append(None)
                    k2.append(None)
                    at.append(at[-1])
            flat = np.concatenate(sigs) if sigs else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").cast(pa.int64()), pa.array(size, pa.int64()), pa.array(k1, pa.int64()), pa.array(k2, pa.int64()), *(pa.array(bits[:, k]) for k in range(WORDS)), pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(flat))],
                names=["doc_id", "n", "k1", "k2", *_SKETCH, "blocks"],
            )

    short_batches(docs.sparkSession)
    return docs.select("doc_id", "text").mapInArrow(run, _KEYS)


def shingle_sets(docs: DataFrame) -> DataFrame:
    """node, digest and shingles (sorted 64-bit hashes, little-endian) of the rows of docs that have words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_rows(batches):
            sets = [shingles(t) for t in texts]
            keys = [digest(x) if len(x) else (None, None) for x in sets]
            columns = [batch.column("doc_id").cast(pa.int64()), *(pa.array([k[n] for k in keys], pa.int64()) for n in (0, 1)), pa.array([x.astype("<u8").tobytes() for x in sets], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["node", "k1", "k2", "shingles"])

    short_batches(docs.sparkSession)
    return docs.select("doc_id", "text").mapInArrow(run, "node bigint, k1 bigint, k2 bigint, shingles binary").where("k1 is not null")


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Those of pairs (u, v) whose sets have 100 * intersection >= 80 * union."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("x"), batch.column("y"), strict=True):
                a, b = np.frombuffer(x.as_buffer(), "<u8"), np.frombuffer(y.as_buffer(), "<u8")
                small, large = (a, b) if len(a) < len(b) else (b, a)
                both = int((large[np.minimum(np.searchsorted(large, small), len(large) - 1)] == small).sum())
                keep.append(100 * both >= 80 * (len(a) + len(b) - both))
            yield batch.select(["u", "v"]).filter(pa.array(keep, pa.bool_()))

    short_batches(pairs.sparkSession)
    left = sets.select(F.col("node").alias("u"), F.col("shingles").alias("x"))
    right = sets.select(F.col("node").alias("v"), F.col("shingles").alias("y"))
    return pairs.select("u", "v").join(left, "u").join(right, "v").select("u", "v", "x", "y").mapInArrow(run, "u bigint, v bigint")


def _distance(a: str, b: str) -> F.Column:
    total = F.lit(0)
    for p in _SKETCH:
        total = total + F.bit_count(F.col(f"{a}.{p}").bitwiseXOR(F.col(f"{b}.{p}")))
    return total


def _may_link(a: str, b: str) -> F.Column:
    """Within the bound on the symmetric difference, by sizes and by the Hamming distance of the sketches."""
    x, y = F.col(f"{a}.n"), F.col(f"{b}.n")
    return (5 * F.least(x, y) >= 4 * F.greatest(x, y)) & (9 * _distance(a, b) <= x + y)


def _grouped(members: DataFrame, found: DataFrame | None) -> DataFrame:
    if found is None:
        return members.withColumn("component", F.col("node"))
    return members.join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))


def _hub_pairs(members: DataFrame, nodes: DataFrame, turn: int) -> DataFrame:
    """For each member the likeliest hub of another component among the hubs of its blocks."""
    order = F.xxhash64("node", F.lit(turn)) if turn == 0 else F.xxhash64("sig", "node", F.lit(turn))
    hubs = members.groupBy("sig").agg(F.min(F.struct(order.alias("o"), "node", "component")).alias("h"), F.min("component").alias("lo"), F.max("component").alias("hi"))
    hubs = hubs.where("lo < hi").select("sig", F.col("h.node").alias("node"), F.col("h.component").alias("component"))
    hubs = hubs.join(nodes, "node").alias("h")
    met = members.alias("m").join(hubs, (F.col("m.sig") == F.col("h.sig")) & (F.col("m.component") != F.col("h.component")) & _may_link("m", "h"))
    close = (F.col("m.n") + F.col("h.n")) / (1 + _distance("m", "h"))
    best = met.select(F.col("m.node").alias("u"), F.col("h.node").alias("v"), close.alias("close"))
    return best.groupBy("u").agg(F.max(F.struct("close", "v")).alias("b")).select("u", F.col("b.v").alias("v"))


def _gathered(members: DataFrame) -> DataFrame:
    """lead and the nodes that meet there, each once: members of blocks that several components share, by the first node of the block
    in an order that all blocks have. Texts that are alike share many blocks but few first nodes."""
    live = members.groupBy("sig").agg(F.min(F.struct(F.xxhash64("node").alias("o"), "node")).alias("first"), F.min("component").alias("lo"), F.max("component").alias("hi"))
    live = live.where("lo < hi").select("sig", F.col("first.node").alias("lead"))
    return members.join(live, "sig").select("lead", "node", "component", "n", *_SKETCH).distinct()


def _close_pairs(gathered: DataFrame) -> DataFrame:
    """Pairs that meet, whose components differ and whose sizes and sketches allow a link; all pairs of one block are among them."""
    a, b = gathered.alias("a"), gathered.alias("b")
    met = a.join(b, (F.col("a.lead") == F.col("b.lead")) & (F.col("a.node") < F.col("b.node")) & (F.col("a.component") != F.col("b.component")) & _may_link("a", "b"))
    return met.select(F.col("a.node").alias("u"), F.col("b.node").alias("v")).distinct()


def _one_set_an_id(keys: DataFrame, again: DataFrame) -> DataFrame:
    """keys where all rows of an id carry its least digest, and only rows of that set have blocks."""
    joined = keys.join(again, "doc_id", "left")
    other = F.col("d1").isNotNull() & ~(F.col("k1").eqNullSafe(F.col("d1")) & F.col("k2").eqNullSafe(F.col("d2")))
    blocks = F.when(~other, F.col("blocks")).otherwise(F.array().cast("array<bigint>"))
    known = (F.col("n") > 0) & F.col("d1").isNotNull()
    return joined.select("doc_id", "n", F.when(known, F.col("d1")).otherwise(F.col("k1")).alias("k1"), F.when(known, F.col("d2")).otherwise(F.col("k2")).alias("k2"), *_SKETCH, blocks.alias("blocks"))


def jaccard_components(docs: DataFrame, hub_rounds: int = HUB_ROUNDS) -> DataFrame:
    """doc_id, n_shingles and component_id of every row."""
    docs = docs.select("doc_id", "text")
    keys = materialize(keyed(docs, frequent_shingles(docs)), "keys")
    again = keys.where("n > 0 and doc_id is not null").groupBy("doc_id").agg(F.count("*").alias("rows"), F.min(F.struct("k1", "k2")).alias("least")).where("rows > 1")
    again = materialize(again.select("doc_id", F.col("least.k1").alias("d1"), F.col("least.k2").alias("d2")), "repeated-ids")
    repeats = not again.isEmpty()
    if repeats:
        keys = materialize(_one_set_an_id(keys, again), "keys")
    # only sets that several documents have; stored, so that the join below can split a frequent set's rows
    classes = keys.where("n > 0 and doc_id is not null").groupBy("k1", "k2").agg(F.min("doc_id").alias("first"), F.count("*").alias("copies"))
    classes = materialize(classes.where("copies > 1").select("k1", "k2", "first"), "classes")
    node = F.when((F.col("n") > 0) & F.col("doc_id").isNotNull(), F.coalesce("first", "doc_id")).alias("node")
    ranks = materialize(keys.select("doc_id", "n", "k1", "k2").join(classes, ["k1", "k2"], "left").select("doc_id", "n", node), "ranks")

    # blocks of two documents or more
    rows = keys.where("doc_id is not null").select("doc_id", F.explode("blocks").alias("sig"))
    shared = materialize(rows.groupBy("sig").count().where("count > 1").select("sig"), "shared-blocks")
    met = materialize(rows.join(shared, "sig"), "met")
    firsts = ranks.where("doc_id = node").select("node").distinct()
    held = met.join(firsts, met.doc_id == firsts.node, "left_semi").select(F.col("doc_id").alias("node"), "sig").distinct()  # the two bands of a set may repeat a block
    several = held.groupBy("sig").count().where("count > 1").select("sig")
    held = materialize(held.join(several, "sig"), "held")
    used = held.select("node").distinct()
    nodes = keys.where(F.size("blocks") > 0).select(F.col("doc_id").alias("node"), "n", *_SKETCH)
    nodes = materialize((nodes.distinct() if repeats else nodes).join(used, "node"), "nodes")
    members = materialize(held.join(nodes, "node"), "members")
    sets = materialize(_sets_of(docs, used, repeats), "sets")

    links: DataFrame | None = None
    found: DataFrame | None = None
    for turn in range(hub_rounds + 1):
        grouped = _grouped(members, found)
        if turn < hub_rounds:
            pairs = _hub_pairs(grouped, nodes, turn)
        else:
            pairs = _close_pairs(materialize(_gathered(grouped), "unsettled"))
        new = materialize(verified(pairs, sets), "verified")
        if new.isEmpty():
            continue
        links = new if found is None else new.unionByName(found.select(F.col("node").alias("u"), F.col("component").alias("v")))
        found = components(links)

    out = ranks if found is None else ranks.join(found, "node", "left")
    component = F.coalesce(*(["component"] if found is not None else []), "node", "doc_id")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("doc_id").isNotNull(), component).alias("component_id"))


def _sets_of(docs: DataFrame, used: DataFrame, repeats: bool) -> DataFrame:
    """Sets of the nodes that share a block with another: their texts are read again."""
    need = docs.join(used.select(F.col("node").alias("doc_id")), "doc_id", "left_semi")
    sets = shingle_sets(need)
    if repeats:
        sets = sets.groupBy("node").agg(F.min_by("shingles", F.struct("k1", "k2")).alias("shingles"))
    return sets.select("node", "shingles")


def first_of_each(docs: DataFrame) -> DataFrame:
    """The rows of docs that have the least id of their component, one for each id; all columns stay."""
    found = jaccard_components(docs).where("doc_id is not null").groupBy("doc_id").agg(F.max(F.col("component_id") != F.col("doc_id")).alias("goes"), F.count("*").alias("rows"))
    marked = materialize(found.where("goes or rows > 1"), "marked")
    kept = docs.join(marked.select("doc_id"), "doc_id", "left_anti")
    again = marked.where("not goes").select("doc_id")
    if again.isEmpty():
        return kept
    whole, order = F.struct(*[F.col(c) for c in docs.columns]), F.struct(F.xxhash64("text"), F.xxhash64(*docs.columns))
    one = docs.join(again, "doc_id", "left_semi").groupBy("doc_id").agg(F.min_by(whole, order).alias("row"))
    return kept.unionByName(one.select("row.*"))
