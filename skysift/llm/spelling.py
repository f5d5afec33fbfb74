"""Spelling variants: words one edit apart, found by walking Levenshtein automata over broadcast trie shards.

Words are cut into shards of neighbouring spellings. Each shard becomes a compact trie in a task: arrays of
edges, and a word whose rest nobody shares ends in a leaf that keeps the rest as it is. Shards are broadcast in
groups of bounded bytes (GROUP_BYTES), so neither the driver nor a task holds more of the vocabulary than that at
once. Against each group every word runs its distance-one automaton depth-first: a state is (place in the word, node,
edits so far), and blocks of states of many words advance together as numpy arrays on a stack. Counts and
best forms of all groups are reduced by word, and roots follow forms by pointer doubling over stored tables.

Defined results: a null text has no words; a null id counts as an empty one in the hash; rows that repeat count
each; an empty table gives an empty result; words of any length take part (a long rest is a leaf's); of equally
frequent near words the first in code-point order is the form; only the id and text columns are read.
"""

from __future__ import annotations

import pickle
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skysift.llm.support import materialize, short_batches

#: Code points and occurrences that a word has at least; runs with a hash that this divides lose a letter; how many times
#: as frequent a form is.
LEAST_LENGTH, LEAST_COUNT, TYPO, RATIO = 7, 2, 31, 10
#: Words of a shard and bytes of its words (a longer word is a shard of its own); bytes of the tries that are broadcast at once.
SHARD_WORDS, SHARD_BYTES, GROUP_BYTES = 32_768, 4 << 20, 32 << 20
#: Words of one block of automata, states that advance at once, counts that a task holds before it hands them on.
BLOCK, STATES, HELD = 8192, 1 << 20, 400_000
#: Letters are Latin-1, one byte each; only A to Z have been lower-cased.
_RUN = re.compile(rb"[a-z\xc0-\xff]{%d,}" % LEAST_LENGTH)


def runs(text: str) -> list[bytes]:
    """The maximal letter runs of at least LEAST_LENGTH letters, A to Z lower-cased, as Latin-1."""
    return _RUN.findall(text.encode("latin-1", "replace").lower())


def spelled(doc_id: object, run: bytes, seed: int | None = None) -> bytes:
    """The run as the document spells it: where TYPO divides its hash, one letter is gone. seed: the hash of the id's part."""
    seed = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode()) if seed is None else seed
    h = zlib.crc32(run if run.isascii() else run.decode("latin-1").encode(), seed)
    if h % TYPO:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1 :]


def word_counts(docs: DataFrame) -> DataFrame:
    """word, n over whole texts; each task counts before it shuffles."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter[bytes] = Counter()

        def handed() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array([w.decode("latin-1") for w in total], pa.string()), pa.array(list(total.values()), pa.int64())], names=["word", "n"])
            total.clear()
            return out

        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                if not text:
                    continue
                seed = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
                for run, n in Counter(runs(text)).items():
                    if len(word := spelled(doc_id, run, seed)) >= LEAST_LENGTH:
                        total[word] += n
                if len(total) > HELD:
                    yield handed()
        yield handed()

    short_batches(docs.sparkSession)
    parts = docs.select("doc_id", "text").mapInArrow(count, "word string, n bigint")
    return parts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST_COUNT)


def _flat(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Letters of all words in one array, closed by a zero, and the offsets of the words."""
    size = np.fromiter(map(len, words), np.int64, len(words))
    return np.frombuffer(b"".join(words) + b"\0", np.uint8), np.concatenate([[0], np.cumsum(size)])


@dataclass(frozen=True)
class Trie:
    """Sorted words as a trie of arrays. Nodes are numbered level by level, so edge j leads to node j + 1.

    keys: parent * 256 + letter of each edge, ascending; first: a node's first edge; ends: the word that ends at an
    inner node, or -1; leaf: the one word below a node, or -1 for inner nodes.
    """

    letters: np.ndarray
    offsets: np.ndarray
    counts: np.ndarray
    keys: np.ndarray
    first: np.ndarray
    ends: np.ndarray
    leaf: np.ndarray

    @staticmethod
    def of(words: list[bytes], counts: list[int]) -> Trie:
        """words: distinct and in byte order."""
        letters, offsets = _flat(words)
        at, node = np.arange(len(words)), np.zeros(len(words), np.int64)
        keys, leaves, inner = [], [np.full(1, 0 if len(words) == 1 else -1)], []
        if len(words) == 1:
            at = at[:0]
        depth, known = 0, 1
        while len(at):
            over = offsets[at] + depth == offsets[at + 1]
            inner.append((node[over], at[over]))
            at, node = at[~over], node[~over]
            key = node * 256 + letters[offsets[at] + depth]
            fresh = np.concatenate([[True], key[1:] != key[:-1]]) if len(key) else np.zeros(0, bool)
            start = np.flatnonzero(fresh)
            size = np.diff(np.append(start, len(key)))
            keys.append(key[start])
            leaves.append(np.where(size == 1, at[start], -1))
            rank = np.cumsum(fresh) - 1
            many = size[rank] > 1 if len(key) else np.zeros(0, bool)
            at, node = at[many], (known + rank)[many]
            known += len(start)
            depth += 1
        key = np.concatenate([*keys, np.zeros(0, np.int64)])
        ends = np.full(known, -1)
        for nodes, found in inner:
            ends[nodes] = found
        return Trie(letters, offsets, np.array(counts, np.int64), key, np.searchsorted(key, np.arange(known + 1) * 256), ends, np.concatenate(leaves))

    def word(self, k: int) -> bytes:
        return self.letters[self.offsets[k] : self.offsets[k + 1]].tobytes()


def _deletions(letters: np.ndarray, at: np.ndarray, left: np.ndarray) -> np.ndarray:
    """States whose next letter may be skipped: there is one, and it is the last of a run of equal letters (skipping
    another of the run gives the same word)."""
    return (left > 0) & ((left == 1) | (letters[at] != letters[np.minimum(at + 1, len(letters) - 1)]))


def near_words(trie: Trie, letters: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (number of a given word, number of a word of the trie) at distance one.

    A state is a word w, the place p of its next letter, a node and the edits e so far. Blocks of states are on a stack;
    the last one advances by a letter of the trie, so the walk goes down before it goes on.
    """
    count = len(offsets) - 1
    out_w, out_x = [], []
    stop = offsets[1:]
    stack = [(0, np.arange(count), offsets[:-1].copy(), np.zeros(count, np.int64), np.zeros(count, np.int8))] if count and len(trie.counts) else []
    while stack:
        depth, w, p, node, e = stack.pop()
        if len(w) > STATES:
            stack.append((depth, w[STATES:], p[STATES:], node[STATES:], e[STATES:]))
            w, p, node, e = w[:STATES], p[:STATES], node[:STATES], e[:STATES]
        done = trie.leaf[node] >= 0
        if done.any():
            a, b = _along_rest(trie, letters, stop, w[done], p[done], trie.leaf[node[done]], depth, e[done])
            out_w.append(a)
            out_x.append(b)
            w, p, node, e = w[~done], p[~done], node[~done], e[~done]
        left = stop[w] - p
        skip = (e == 0) & _deletions(letters, p, left)
        w1, p1, node1 = np.concatenate([w[e == 1], w[skip]]), np.concatenate([p[e == 1], p[skip] + 1]), np.concatenate([node[e == 1], node[skip]])
        full = (p1 == stop[w1]) & (trie.ends[node1] >= 0)
        out_w.append(w1[full])
        out_x.append(trie.ends[node1[full]])
        # with the edit spent, the next letter names the edge
        go = p1 < stop[w1]
        w1, p1, node1 = w1[go], p1[go], node1[go]
        key = node1 * 256 + letters[p1]
        edge = np.searchsorted(trie.keys, key)
        hit = edge < len(trie.keys)
        hit[hit] = trie.keys[edge[hit]] == key[hit]
        w1, p1, node1 = w1[hit], p1[hit] + 1, edge[hit] + 1
        # without one, every edge: its letter is the next, stands for it, or comes in between
        zero = e == 0
        w0, p0, n0 = w[zero], p[zero], node[zero]
        fan = trie.first[n0 + 1] - trie.first[n0]
        each = np.repeat(np.arange(len(w0)), fan)
        edge = np.arange(len(each)) - np.repeat(np.cumsum(fan) - fan, fan) + trie.first[n0][each]
        w0, p0 = w0[each], p0[each]
        more = p0 < stop[w0]
        same = more & (letters[p0] == (trie.keys[edge] & 255))
        other, extra = more & ~same, ~same
        nodes = edge + 1
        w2 = np.concatenate([w1, w0[other], w0[extra], w0[same]])
        if len(w2):
            p2 = np.concatenate([p1, p0[other] + 1, p0[extra], p0[same] + 1])
            n2 = np.concatenate([node1, nodes[other], nodes[extra], nodes[same]])
            e2 = np.ones(len(w2), np.int8)
            e2[len(w2) - int(same.sum()) :] = 0
            stack.append((depth + 1, w2, p2, n2, e2))
    if not out_w:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    pairs = np.unique(np.concatenate(out_w) * len(trie.counts) + np.concatenate(out_x))
    return pairs // len(trie.counts), pairs % len(trie.counts)


def _along_rest(trie: Trie, letters: np.ndarray, stop: np.ndarray, w: np.ndarray, p: np.ndarray, x: np.ndarray, depth: int, e: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The same automaton along the unshared rests of leaves, states (w, p, e) against the rest q of word x."""
    out_w, out_x = [], []
    q, end = trie.offsets[x] + depth, trie.offsets[x + 1]
    while len(w):
        skip = (e == 0) & _deletions(letters, p, stop[w] - p)
        w, p, x, q, end = (np.concatenate([a, a[skip]]) for a in (w, p, x, q, end))
        e = np.concatenate([e, np.ones(int(skip.sum()), np.int8)])
        p[len(p) - int(skip.sum()) :] += 1
        full = (e == 1) & (p == stop[w]) & (q == end)
        out_w.append(w[full])
        out_x.append(x[full])
        more = p < stop[w]
        left = np.where(e == 1, stop[w] - p == end - q, np.abs((stop[w] - p) - (end - q)) <= 1) & (q < end)
        w, p, x, q, end, e, more = (a[left] for a in (w, p, x, q, end, e, more))
        same = more & (letters[p] == trie.letters[q])
        other, extra = more & ~same & (e == 0), ~same & (e == 0)
        p = np.concatenate([p[same] + 1, p[other] + 1, p[extra]])
        e = np.concatenate([e[same], np.ones(int(other.sum() + extra.sum()), np.int8)])
        w, x, end, q = (np.concatenate([a[same], a[other], a[extra]]) for a in (w, x, end, q))
        q = q + 1
    return np.concatenate([*out_w, np.zeros(0, np.int64)]), np.concatenate([*out_x, np.zeros(0, np.int64)])


def trie_shards(words: DataFrame) -> DataFrame:
    """shard, bytes, trie (pickled) of words (word, n): each partition of a range of words is cut into shards of bounded size."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, made = TaskContext.get().partitionId(), 0
        held: list[bytes] = []
        counts: list[int] = []
        size = 0

        def shard() -> pa.RecordBatch:
            nonlocal made, size
            raw = pickle.dumps(Trie.of(held, counts), protocol=5)
            row = pa.RecordBatch.from_arrays([pa.array([part], pa.int64()), pa.array([made], pa.int64()), pa.array([len(raw)], pa.int64()), pa.array([raw], pa.binary())], names=["part", "shard", "bytes", "trie"])
            made, size = made + 1, 0
            held.clear()
            counts.clear()
            return row

        for batch in batches:
            for word, n in zip(batch.column("word").to_pylist(), batch.column("n").to_pylist(), strict=True):
                raw = word.encode("latin-1")
                if held and (len(held) == SHARD_WORDS or size + len(raw) > SHARD_BYTES):
                    yield shard()
                held.append(raw)
                counts.append(n)
                size += len(raw)
        if held:
            yield shard()

    return words.mapInArrow(build, "part bigint, shard bigint, bytes bigint, trie binary")


def _near_in(words: DataFrame, tries: list[bytes], every: bool) -> DataFrame:
    """word, n, n_near and best (minus its count, spelling) of each word with near ones in these shards; with `every` of all words."""
    shared = words.sparkSession.sparkContext.broadcast(tries)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shards = [pickle.loads(t) for t in shared.value]
        for whole in batches:
            for start in range(0, whole.num_rows, BLOCK):
                batch = whole.slice(start, BLOCK)
                given = [w.encode("latin-1") for w in batch.column("word").to_pylist()]
                letters, offsets = _flat(given)
                near, top, best = np.zeros(len(given), np.int64), np.zeros(len(given), np.int64), [None] * len(given)
                for trie in shards:  # ascending, so that of equal counts the first stays
                    w, x = near_words(trie, letters, offsets)
                    if not len(w):
                        continue
                    near += np.bincount(w, minlength=len(given))
                    order = np.lexsort((x, -trie.counts[x], w))
                    lead = order[np.concatenate([[True], w[order][1:] != w[order][:-1]])]
                    for k, word in zip(w[lead].tolist(), x[lead].tolist(), strict=True):
                        n = int(trie.counts[word])
                        found = trie.word(word)
                        if n > top[k] or n == top[k] and found < best[k]:
                            top[k], best[k] = n, found
                keep = np.flatnonzero(near >= (0 if every else 1))
                rows = pa.table({"word": batch.column("word"), "n": batch.column("n")}).take(pa.array(keep))
                yield from pa.table(
                    {
                        "word": rows["word"], "n": rows["n"], "n_near": pa.array(near[keep]), "top": pa.array(-top[keep]),
                        "best": pa.array([None if best[k] is None else best[k].decode("latin-1") for k in keep.tolist()], pa.string()),
                    }
                ).combine_chunks().to_batches()

    return words.mapInArrow(search, "word string, n bigint, n_near bigint, top bigint, best string")


def groups(sizes: list[tuple[int, int, int]], most: int = GROUP_BYTES) -> list[list[tuple[int, int]]]:
    """Consecutive shards (part, shard, bytes) in groups of at most so many bytes; a larger one alone."""
    out: list[list[tuple[int, int]]] = []
    held = 0
    for part, shard, size in sorted(sizes):
        if not out or held + size > most:
            out.append([])
            held = 0
        out[-1].append((part, shard))
        held += size
    return out


def roots(forms: DataFrame) -> DataFrame:
    """word, root of words (word, form): the end of the chain of forms. Each form is RATIO times as frequent as its word, so
    a chain has as many steps as a count has digits, and doubling needs the logarithm of that in rounds."""
    at = materialize(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        step = at.select(F.col("word").alias("root"), F.col("root").alias("beyond"))
        moved = materialize(at.join(step, "root", "left").select("word", F.coalesce("beyond", "root").alias("root"), F.col("beyond").isNotNull().alias("moved")), "roots")
        at = moved.select("word", "root")
        if not moved.where("moved").limit(1).count():
            return at


def variants(docs: DataFrame) -> DataFrame:
    """word, form, root, n, n_near, form_n of each word."""
    spark = docs.sparkSession
    counted = materialize(word_counts(docs), "word-counts")
    parts = max(1, -(-counted.count() // SHARD_WORDS))
    shards = materialize(trie_shards(counted.repartitionByRange(parts, "word").sortWithinPartitions("word")), "tries")
    sizes = [(r.part, r.shard, r.bytes) for r in shards.select("part", "shard", "bytes").collect()]  # one row a shard
    # small tasks: a word's walk is dear beside its bytes
    spread = counted.repartition(max(parts, spark.sparkContext.defaultParallelism))
    found = None
    for number, group in enumerate(groups(sizes) or [[]]):
        mark = lambda at: F.struct(F.lit(at[0]).cast("bigint"), F.lit(at[1]).cast("bigint"))
        wanted = F.struct("part", "shard").between(mark(group[0]), mark(group[-1])) if group else F.lit(False)
        tries = [bytes(r.trie) for r in shards.where(wanted).orderBy("part", "shard").select("trie").collect()]  # GROUP_BYTES at most, or one shard
        near = materialize(_near_in(spread, tries, number == 0), "near-words")
        found = near if found is None else found.unionByName(near)
    whole = found.groupBy("word").agg(F.max("n").alias("n"), F.sum("n_near").alias("n_near"), F.min(F.when(F.col("best").isNotNull(), F.struct("top", "best"))).alias("b"))
    form = F.when(-F.col("b.top") >= RATIO * F.col("n"), F.col("b.best"))
    judged = materialize(whole.select("word", form.alias("form"), "n", "n_near", F.when(form.isNotNull(), -F.col("b.top")).alias("form_n")), "forms")
    ends = roots(judged.where("form is not null"))
    return judged.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
