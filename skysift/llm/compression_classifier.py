"""Quality classifier by compression.

One zstandard dictionary is built from good labelled text and one from bad. A text is compressed in
blocks under both; the normalised difference of the two sizes, with the compressed share of the text,
goes through a logistic calibration fitted on other labelled rows, which gives a score from 0 to 1.

The samples are bounded (DICT_BLOCKS, CALIBRATION_ROWS), picked by hash order; every text is scored
whole. Labels, language, source and id are no inputs of a score.

Defined results: a null text scores as an empty one, an empty one like text that compresses to
nothing; equal texts get equal scores; without labels of both classes every score is 0.5; an empty
table gives an empty result; columns besides id and text aren't read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skysift.llm.support import materialize, short_batches, text_rows

#: Bytes of a block. A dictionary helps the start of a block most, so blocks are short.
BLOCK = 512
#: Bytes of a dictionary.
DICT_BYTES = 131_072
#: Labelled rows taken for the dictionaries (of each class), and blocks of them at most.
DICT_ROWS, DICT_BLOCKS = 2000, 6000
#: The driver sees some times SPARE blocks before it picks DICT_BLOCKS.
SPARE = 2
#: Labelled rows for the calibration.
CALIBRATION_ROWS = 6000
#: Bytes added to the sum that the difference is divided by, so that a few bytes of a short text say little.
EVEN = 64
LEVEL = 1
#: From this score on a text counts as good.
CUT = 0.3


@dataclass(frozen=True)
class CompressionModel:
    good: bytes
    bad: bytes
    weights: tuple[float, ...]

    def score(self, features: np.ndarray) -> np.ndarray:
        if not self.weights:
            return np.full(len(features), 0.5)
        z = np.clip(_design(features) @ np.asarray(self.weights), -40, 40)
        return 1 / (1 + np.exp(-z))


class Sizes:
    """Compressed sizes of texts under the two dictionaries."""

    def __init__(self, good: bytes, bad: bytes):
        self.pair = [
            zstandard.ZstdCompressor(level=LEVEL, dict_data=zstandard.ZstdCompressionDict(d), write_content_size=False, write_checksum=False, write_dict_id=False).compress
            for d in (good, bad)
        ]

    def features(self, texts: list[str]) -> np.ndarray:
        """Difference over sum, and the mean compressed share, of each text."""
        out = np.zeros((len(texts), 2))
        good, bad = self.pair
        for n, text in enumerate(texts):
            raw = text.encode("utf-8", "surrogatepass")
            if not raw:
                continue
            blocks = [raw[k : k + BLOCK] for k in range(0, len(raw), BLOCK)]
            g, b = sum(len(good(x)) for x in blocks), sum(len(bad(x)) for x in blocks)
            out[n] = (b - g) / (b + g + EVEN), (b + g) / (2 * len(raw))
        return out


def _design(features: np.ndarray) -> np.ndarray:
    return np.column_stack([np.ones(len(features)), np.clip(features[:, 0], -0.2, 0.2), np.minimum(features[:, 1], 0.5)])


def build_dictionary(blocks: list[bytes], size: int = DICT_BYTES) -> bytes:
    """A trained dictionary, or the blocks themselves where they are too few to train on."""
    try:
        return zstandard.train_dictionary(size, blocks).as_bytes()
    except zstandard.ZstdError:
        return b"".join(blocks)[-size:]


def fit_logistic(features: np.ndarray, labels: np.ndarray, ridge: float = 1e-2, rounds: int = 50) -> tuple[float, ...]:
    """Calibration by Newton steps; a small ridge keeps separable samples finite."""
    x, w = _design(features), np.zeros(3)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -40, 40)))
        grad = x.T @ (p - labels) + ridge * w
        hess = (x * (p * (1 - p) + 1e-9)[:, None]).T @ x + ridge * np.eye(3)
        step = np.linalg.solve(hess, grad)
        w = w - step
        if np.abs(step).max() < 1e-9:
            break
    return tuple(w)


def learnable(labels: DataFrame, label: str = "quality") -> DataFrame:
    """Label rows that may be learned from: crc32 of the id as text, modulo 5, is not 0."""
    at = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5
    return labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull() & (at != 0)).groupBy("doc_id").agg(F.min(label).cast("int").alias("label"))


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality") -> CompressionModel:
    """The model from bounded samples of labelled rows; all other work stays on the executors."""
    spark = docs.sparkSession
    rows = learnable(labels, label).withColumn("order", F.xxhash64("doc_id"))
    part = F.pmod(F.shiftright("order", 7), F.lit(2))
    sample = rows.where((part == 0) & (F.col("label") == 1)).orderBy("order", "doc_id").limit(DICT_ROWS)
    sample = sample.unionByName(rows.where((part == 0) & (F.col("label") == 0)).orderBy("order", "doc_id").limit(DICT_ROWS))
    body = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    # of rows that share an id one text counts, that of the least hash: the samples are bounded by ids, so repeats don't add to them
    one = lambda known, *more: body.join(F.broadcast(known), "doc_id").groupBy("doc_id", "label", *more).agg(F.min_by("text", F.xxhash64("text")).alias("text"))
    texts = materialize(one(sample, "order"), "labelled")  # 2 * DICT_ROWS rows at most
    whole = F.encode("text", "UTF-8")
    count = F.ceil(F.octet_length("text") / BLOCK).cast("int")
    blocks = (
        texts.where(count > 0)
        .select("label", "doc_id", "order", F.explode(F.transform(F.sequence(F.lit(0), count - 1), lambda k: F.struct(k.alias("nth"), F.substring(whole, k * BLOCK + 1, F.lit(BLOCK)).alias("block")))).alias("b"))
        .select("label", F.xxhash64("doc_id", "b.nth").alias("order"), "doc_id", F.col("b.nth").alias("nth"), F.col("b.block").alias("block"))
    )
    held = {r.label: r.n for r in texts.groupBy("label").agg(F.sum(count).alias("n")).collect()}

    def picked(label: int) -> list[bytes]:
        """Blocks by hash order, of those whose hash falls under a bound that some SPARE times DICT_BLOCKS reach."""
        bound = F.lit(max(1, (held.get(label) or 0) // (SPARE * DICT_BLOCKS)))
        few = blocks.where((F.col("label") == label) & (F.pmod("order", bound) == 0))
        return [bytes(r.block) for r in few.orderBy("order", "doc_id", "nth").limit(DICT_BLOCKS).collect()]

    got = {y: picked(y) for y in (1, 0)}
    if not got[0] or not got[1]:
        return CompressionModel(b"", b"", ())
    good, bad = build_dictionary(got[1]), build_dictionary(got[0])

    other = rows.where(part == 1).orderBy("order", "doc_id").limit(CALIBRATION_ROWS).select("doc_id", "label")
    shared = spark.sparkContext.broadcast((good, bad))

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sizes = Sizes(*shared.value)
        for batch, texts in text_rows(batches):
            f = sizes.features(texts)
            yield pa.RecordBatch.from_arrays([pa.array(f[:, 0]), pa.array(f[:, 1]), batch.column("label").cast(pa.int32())], names=["s", "r", "label"])

    short_batches(spark)
    found = one(other).select("text", "label").mapInArrow(measure, "s double, r double, label int").collect()
    if len({r.label for r in found}) < 2:
        return CompressionModel(b"", b"", ())
    x, y = np.array([(r.s, r.r) for r in found]), np.array([r.label for r in found], float)
    return CompressionModel(good, bad, fit_logistic(x, y))


def scored(docs: DataFrame, model: CompressionModel) -> DataFrame:
    """doc_id and score of each row; no shuffle."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        sizes = Sizes(model.good, model.bad) if model.weights else None
        for batch, texts in text_rows(batches):
            f = sizes.features(texts) if sizes else np.zeros((len(texts), 2))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), pa.array(model.score(f))], names=["doc_id", "score"])

    short_batches(docs.sparkSession)
    return docs.select("doc_id", "text").mapInArrow(run, "doc_id bigint, score double")


def keep_good(docs: DataFrame, model: CompressionModel, cut: float = CUT) -> DataFrame:
    """The rows of docs whose score reaches the cut, with all their columns; no shuffle."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        sizes = Sizes(model.good, model.bad) if model.weights else None
        for batch, texts in text_rows(batches):
            f = sizes.features(texts) if sizes else np.zeros((len(texts), 2))
            yield batch.filter(pa.array(model.score(f) >= cut))

    short_batches(docs.sparkSession)
    return docs.mapInArrow(run, docs.schema)
