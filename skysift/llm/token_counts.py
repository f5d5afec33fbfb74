"""Exact token counts of whole texts, huge ones in overlapping chunks.

A huge text is cut into chunks that overlap. Each is encoded with its pre-token boundaries in the
overlaps, and two neighbours are spliced at the first boundary that both have there. From a common
boundary on, both encodings agree, for a pre-tokenizer looks only ahead; the boundary must lie before
the last MARGIN bytes of the left chunk, so that nothing cut off at its end (a special string) can move
it. Where neighbours share no such boundary, the text is encoded anew with chunks and overlaps four
times as wide, at last as one chunk.

Other texts go word by word (see stable_bpe), without a shuffle. With a tokenizer whose settings aren't those
of stable_bpe no boundary is proven stable, and every text is encoded whole.

Defined results: a null text counts as empty, an empty text has 0 tokens; rows that repeat are counted
once each; an empty table gives an empty result; only id and text are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skysift.llm.stable_bpe import fast_coder, is_plain, tokenizer, word_encoder
from skysift.llm.support import materialize, short_batches, text_rows

#: Characters from which on a text is huge (and the step from chunk to chunk), and of an overlap.
CHUNK, OVERLAP = 32_768, 256
#: Bytes before a chunk's end where no splice may lie: longer than any special string.
MARGIN = 32
LIMIT = 1024

_BOUND = pa.list_(pa.struct([("at", pa.int64()), ("tokens", pa.int64())]))
_ENCODED = "doc_id bigint, hash bigint, n_bytes bigint, chunk int, last boolean, n_tokens bigint, head array<struct<at:bigint,tokens:bigint>>, tail array<struct<at:bigint,tokens:bigint>>"


def count_small(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """doc_id, n_bytes and n_tokens of each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = word_encoder(tokenizer_path, "count")
        for batch, texts in text_rows(batches):
            counts = [sum(c) for c in encoder.encode(texts)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), batch.column("n_bytes"), pa.array(counts, pa.int64())], names=["doc_id", "n_bytes", "n_tokens"])

    short_batches(docs.sparkSession)
    return docs.select("doc_id", "text", "n_bytes").mapInArrow(run, "doc_id bigint, n_bytes bigint, n_tokens bigint")


def cut(docs: DataFrame, chunk: int, overlap: int) -> DataFrame:
    """Chunk rows of huge texts: chunk k starts at character k * chunk and runs `overlap` into the next."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_rows(batches):
            for row, text in enumerate(texts):
                count = max(1, -(-(len(text) - overlap) // chunk))
                for k in range(count):
                    part = text[k * chunk : (k + 1) * chunk + overlap] if k < count - 1 else text[k * chunk :]
                    yield pa.RecordBatch.from_arrays(
                        [*(batch.column(c).slice(row, 1) for c in ("doc_id", "hash", "n_bytes")), pa.array([k], pa.int32()), pa.array([k == count - 1]), pa.array([part], pa.string())],
                        names=["doc_id", "hash", "n_bytes", "chunk", "last", "text"],
                    )

    short_batches(docs.sparkSession)
    return docs.select("doc_id", "hash", "n_bytes", "text").mapInArrow(run, "doc_id bigint, hash bigint, n_bytes bigint, chunk int, last boolean, text string")


def boundaries(text: str, path: str, overlap: int, first: bool, last: bool) -> tuple[int, list, list]:
    """Tokens of a chunk, and (byte in the overlap, tokens before it) of its pre-token boundaries there."""
    whole = tokenizer(path)
    coded = whole.encode(text, add_special_tokens=False)
    ids = np.asarray(coded.ids, np.int64)
    widths = fast_coder(path)[2].copy()
    for n, token in whole.get_added_tokens_decoder().items():
        widths[n] = len(token.content.encode())
    ends = np.cumsum(widths[ids])
    word = np.array([-1 - n if w is None else w for n, w in enumerate(coded.word_ids)])
    special = np.isin(ids, list(whole.get_added_tokens_decoder()))
    starts = np.flatnonzero(np.concatenate([[True], (word[1:] != word[:-1]) | special[1:] | special[:-1]])) if len(ids) else np.zeros(0, int)
    at = np.concatenate([[0], ends])[starts]
    size, head_bytes = len(text.encode("utf-8", "surrogatepass")), len(text[:overlap].encode("utf-8", "surrogatepass"))
    tail_from = size - len(text[-overlap:].encode("utf-8", "surrogatepass"))
    rows = lambda keep, base: [{"at": int(a - base), "tokens": int(s)} for a, s in zip(at[keep], starts[keep], strict=True)]
    head = [] if first else rows(at <= head_bytes, 0)
    tail = [] if last else rows((at >= tail_from) & (at <= size - MARGIN), tail_from)
    return len(ids), head, tail


def encode_chunks(chunks: DataFrame, tokenizer_path: str, overlap: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_rows(batches):
            rows = [boundaries(t, tokenizer_path, overlap, k == 0, end) for t, k, end in zip(texts, batch.column("chunk").to_pylist(), batch.column("last").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("doc_id", "hash", "n_bytes", "chunk", "last")), pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], _BOUND), pa.array([r[2] for r in rows], _BOUND)],
                names=["doc_id", "hash", "n_bytes", "chunk", "last", "n_tokens", "head", "tail"],
            )

    short_batches(chunks.sparkSession)
    return chunks.mapInArrow(run, _ENCODED)


def splice(encoded: DataFrame) -> DataFrame:
    """n_tokens of each text (null where two neighbours share no stable boundary).

    A chunk counts from its splice with the one before to its splice with the next, so sums of
    splices and last chunks are all it takes; no task gathers a text.
    """
    key = ["doc_id", "hash", "n_bytes"]
    once = encoded.groupBy(*key, "chunk").agg(*(F.first(c).alias(c) for c in ("last", "n_tokens", "head", "tail")))
    left = once.where(~F.col("last")).select(*key, (F.col("chunk") + 1).alias("chunk"), F.col("tail").alias("left"))
    # a row without an id has its chunks like any other
    same = F.col("a.doc_id").eqNullSafe(F.col("b.doc_id"))
    for c in (*key[1:], "chunk"):
        same = same & (F.col(f"a.{c}") == F.col(f"b.{c}"))
    both = once.alias("a").join(left.alias("b"), same, "left").select("a.*", "left")
    places = lambda c: F.transform(c, lambda x: x["at"])
    common = F.array_min(F.array_intersect(places("left"), places("head")))
    at = lambda c: F.get(F.filter(c, lambda x: x["at"] == F.col("common")), F.lit(0))["tokens"]
    part = both.withColumn("common", common).withColumn(
        "part", F.when(F.col("chunk") > 0, at("left") - at("head")).otherwise(0) + F.when(F.col("last"), F.col("n_tokens")).otherwise(0)
    )
    return part.groupBy(*key).agg(F.sum("part").alias("total"), F.count("part").alias("spliced"), F.count("*").alias("chunks")).select(*key, F.when(F.col("spliced") == F.col("chunks"), F.col("total")).alias("n_tokens"))


def count_huge(docs: DataFrame, tokenizer_path: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """doc_id, n_bytes and n_tokens of texts with the columns doc_id, hash, n_bytes, text."""
    key = ["doc_id", "hash", "n_bytes"]
    done: DataFrame | None = None
    rows: DataFrame | None = None
    while True:
        # rows of a text go to several tasks; equal chunks of repeated rows meet again in splice()
        tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # as many as set: chunks are small but dear
        spread = cut(docs, chunk, overlap).repartition(tasks, "doc_id", "hash", "chunk")
        encoded = materialize(encode_chunks(spread, tokenizer_path, overlap), "chunks")
        rows = encoded.where("chunk = 0").select(*key) if rows is None else rows
        counted = materialize(splice(encoded), "spliced")
        good = counted.where("n_tokens is not null")
        done = good if done is None else done.unionByName(good)
        if counted.where("n_tokens is null").isEmpty():
            break
        null_safe = [docs[c].eqNullSafe(F.col(f"again_{c}")) for c in key]
        again = counted.where("n_tokens is null").select(*(F.col(c).alias(f"again_{c}") for c in key))
        docs = docs.join(again, null_safe, "left_semi")
        chunk, overlap = chunk * 4, overlap * 4
    same = [rows[c].eqNullSafe(done[c]) for c in key]
    return rows.join(done, same, "left").select(rows["doc_id"], rows["n_bytes"], done["n_tokens"])


def count_tokens(docs: DataFrame, tokenizer_path: str, limit: int = LIMIT, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit of every row."""
    body = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    body = body.withColumn("n_bytes", F.octet_length("text").cast("bigint"))
    if not is_plain(tokenizer_path):
        return count_small(body, tokenizer_path).withColumn("over_limit", F.col("n_tokens") > limit)
    # a text of few bytes has few characters; the bytes decide, which every chunk still reaches
    huge = count_huge(body.where(F.col("n_bytes") > chunk).withColumn("hash", F.xxhash64("text")), tokenizer_path, chunk, overlap)
    small = count_small(body.where(F.col("n_bytes") <= chunk), tokenizer_path)  # last: it runs with the result, in full batches
    return small.unionByName(huge).withColumn("over_limit", F.col("n_tokens") > limit)
