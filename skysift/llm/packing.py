"""Best-fit packing by sums of squares.

Documents become id sequences (tokenizer ids and a closing 0); only those longer than a sequence are
cut, the first piece short. Sum-of-squares packing needs nothing but how many open sequences have each
level, so the plan is made from the histogram of piece lengths (at most one count for each length,
whatever the data's size): lengths from long to short, each piece goes to the open sequence for which
the sum of the squared counts per residual gap becomes smallest, and a new one opens only where no open
one has room. Frequent lengths are placed in blocks of 1/BLOCKS of their count. Spark ranks the pieces
of a length (salted, so that a length that many pieces share is dealt out) and joins ranks to the plan.

Defined results: a null or empty text is the one id 0; rows that repeat are packed once each; an empty
table gives an empty result; only id and text are read.
"""

from __future__ import annotations

import zlib
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skysift.llm.stable_bpe import word_encoder
from skysift.llm.support import materialize, short_batches, text_rows

#: Ids of a sequence.
CAPACITY = 2048
#: Blocks that the pieces of one length are placed in at most.
BLOCKS = 128
#: Parts that the pieces of one length are dealt out to for ranking: at least so many, and one for so many pieces.
SALTS, SALT_ROWS = 256, 1_000_000

PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"


def pieces(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY) -> DataFrame:
    """The pieces of every document, tokenized whole; no shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = word_encoder(tokenizer_path, "ids")
        for batch, texts in text_rows(batches):
            cols: tuple[list, ...] = ([], [], [], [], [])
            for doc_id, parts in zip(batch.column("doc_id").to_pylist(), encoder.encode(texts), strict=True):
                raw = memoryview(b"".join(parts) + bytes(4))
                total = len(raw) // 4
                start, stop, nth = 0, (total - 1) % capacity + 1, 0
                while start < total:
                    for col, value in zip(cols, (doc_id, nth, start, stop - start, zlib.crc32(raw[4 * start : 4 * stop])), strict=True):
                        col.append(value)
                    start, stop, nth = stop, stop + capacity, nth + 1
            types = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], names=["doc_id", "piece", "start", "length", "ids_crc32"])
            batch = texts = None
        encoder.forget()

    short_batches(docs.sparkSession)
    return docs.select("doc_id", "text").mapInArrow(run, PIECES)


def plan_sequences(histogram: dict[int, int], capacity: int = CAPACITY, blocks: int = BLOCKS) -> tuple[list[tuple[int, int, int, int, int]], int]:
    """Rows (length, first rank, count, first sequence, offset), and the number of sequences.

    Pieces of `length` with ranks from the first on go to as many sequences of running numbers.
    """
    counts = np.zeros(capacity + 1, np.int64)
    held: list[deque] = [deque() for _ in range(capacity + 1)]  # runs of sequence numbers at each level
    plan, made = [], 0
    for length in sorted((k for k in histogram if histogram[k]), reverse=True):
        rank, left = 0, histogram[length]
        block = -(-left // blocks)
        while left:
            most = min(block, left)
            room = capacity - length
            level = 0
            if room:
                here, there = counts[1 : room + 1], counts[length + 1 :].copy()
                there[-1] = 0  # a full sequence is no longer open
                fall = 2 * (here - there) - 2
                fall[-1] += 1
                fall = np.where(here > 0, fall, np.iinfo(np.int64).min)
                level = room - int(np.argmax(fall[::-1]))
                if not counts[level]:
                    level = 0
            if level:
                first, size = held[level].popleft()
                used = min(most, size)
                if used < size:
                    held[level].appendleft((first + used, size - used))
                counts[level] -= used
            else:
                first, used = made, most
                made += used
            if level + length < capacity:
                held[level + length].append((first, used))
                counts[level + length] += used
            plan.append((length, rank, used, first, level))
            rank, left = rank + used, left - used
    return plan, made


def pack(parts: DataFrame, capacity: int = CAPACITY, blocks: int = BLOCKS) -> DataFrame:
    """parts (a stored table of pieces) with sequence_id and offset."""
    spark = parts.sparkSession
    histogram = {r.length: r["count"] for r in parts.groupBy("length").count().collect()}
    plan, made = plan_sequences({k: v for k, v in histogram.items() if k < capacity}, capacity, blocks)

    salts = max(SALTS, sum(histogram.values()) // SALT_ROWS)
    salted = parts.withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(salts)).cast("int"))
    inside = Window.partitionBy("length", "salt").orderBy("doc_id", "piece", "ids_crc32")
    before = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    base = salted.groupBy("length", "salt").agg(F.count("*").alias("n")).select("length", "salt", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    ranked = salted.withColumn("nth", F.row_number().over(inside) - 1).join(base, ["length", "salt"]).withColumn("rank", F.col("base") + F.col("nth")).drop("salt", "nth", "base")

    # a plan row holds a run of ranks, no longer than its length's block: it meets the ranks of the blocks that it reaches
    names = ["length", "first_rank", "n", "first_sequence", "offset"]
    table = pa.table([pa.array([p[k] for p in plan], pa.int64()) for k in range(5)], names=names)
    width = {k: -(-v // blocks) for k, v in histogram.items()}
    wide = pa.table([pa.array(list(width), pa.int64()), pa.array(list(width.values()), pa.int64())], names=["length", "width"])
    widths = F.broadcast(spark.createDataFrame(wide))  # one row a length: at most `capacity`
    runs = spark.createDataFrame(table).join(widths, "length").withColumn("last", F.col("first_rank") + F.col("n") - 1)
    block = lambda c: F.expr(f"{c} div width")
    runs = runs.select("length", "first_rank", "last", "first_sequence", "offset", F.explode(F.sequence(block("first_rank"), block("last"))).alias("block"))
    short = ranked.where(F.col("length") < capacity).join(widths, "length").withColumn("block", block("rank"))
    short = short.join(runs, ["length", "block"]).where("rank between first_rank and last")
    short = short.withColumn("sequence_id", F.col("first_sequence") + F.col("rank") - F.col("first_rank"))
    full = ranked.where(F.col("length") == capacity).select("*", (F.lit(made) + F.col("rank")).alias("sequence_id"), F.lit(0).cast("bigint").alias("offset"))
    keep = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    return short.select(keep).unionByName(full.select(keep))


def pack_documents(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY) -> DataFrame:
    """Tokenizing is the costly part, so the narrow table of pieces is stored before it is read twice."""
    return pack(materialize(pieces(docs, tokenizer_path, capacity), "pieces"), capacity)
