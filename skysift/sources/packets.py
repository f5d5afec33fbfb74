"""Messages: network packets parsed and put together from chunks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skysift.functions.codes import packet_fields


def parse(df: DataFrame, column: str = "packet") -> DataFrame:
    """Fields of a binary packet: a text header up to an empty line, and the body after it.

    A packet without the empty line has status 1, one with too few bytes for its shape 2.
    """
    text = F.decode(F.substring(column, 1, F.lit(4096)), "ISO-8859-1")
    at = F.instr(text, "\r\n\r\n")
    head = F.when(at > 0, F.substring(text, F.lit(1), at - 1))
    body = F.when(at > 0, F.substring(F.col(column), at + 4, F.octet_length(column)))
    out = df.withColumns({name: c for name, c in packet_fields(head).items()}).withColumn("body", body)
    need = F.aggregate("shape", F.lit(8), lambda a, x: a * x)
    return out.withColumn("status", F.when(F.col("body").isNull(), 1).when(F.octet_length("body") < need, 2).otherwise(0))


def join_chunks(chunks: DataFrame, key: str) -> DataFrame:
    """Messages of which all chunks (key, chunk_no, expected, bytes) are there, doubles counted once."""
    once = chunks.groupBy(key, "chunk_no").agg(F.first("bytes").alias("bytes"), F.max("expected").alias("expected"))
    whole = once.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("chunk_no", "bytes"))).alias("parts"), F.max("expected").alias("expected"))
    ordered = F.transform("parts", lambda p: F.hex(p["bytes"]))
    return whole.where(F.size("parts") == F.col("expected")).select(key, F.unhex(F.array_join(ordered, "")).alias("bytes"))


def fill_chunks(chunks: DataFrame, key: str, size: int) -> DataFrame:
    """key, bytes and missing (numbers of chunks) of messages whose time is up, from chunks (key, chunk_no from 0, expected, bytes) of `size`
    bytes, doubles counted once: what hasn't come, or has another length, is NaN doubles in its place."""
    good = chunks.where((F.octet_length("bytes") == size) & (F.col("chunk_no") >= 0) & (F.col("chunk_no") < F.col("expected")))
    once = good.groupBy(key, "chunk_no").agg(F.min("bytes").alias("bytes"))
    wanted = chunks.groupBy(key).agg(F.max("expected").alias("expected")).select(key, F.explode(F.sequence(F.lit(0), F.col("expected") - 1)).alias("chunk_no"))
    nan = F.unhex(F.repeat(F.lit("000000000000F87F"), F.lit(size // 8)))
    whole = wanted.join(once, [key, "chunk_no"], "left").select(key, "chunk_no", F.coalesce("bytes", nan).alias("bytes"), F.col("bytes").isNull().alias("gone"))
    parts = whole.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("chunk_no", "bytes", "gone"))).alias("parts"))
    return parts.select(key, F.unhex(F.array_join(F.transform("parts", lambda p: F.hex(p["bytes"])), "")).alias("bytes"), F.transform(F.filter("parts", lambda p: p["gone"]), lambda p: p["chunk_no"]).alias("missing"))


def encode_doubles(df: DataFrame, keys: list[str], column: str) -> DataFrame:
    """keys and `bytes`, the little-endian 64-bit floats of an array column; null is NaN."""
    kinds = ", ".join(f"{k} {df.schema[k].dataType.simpleString()}" for k in keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = [np.array([np.nan if v is None else v for v in row], "<f8").tobytes() for row in batch.column(column).to_pylist()]
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in keys), pa.array(raw, pa.binary())], names=[*keys, "bytes"])

    return df.select(*keys, column).mapInArrow(run, f"{kinds}, bytes binary")


def decode_doubles(df: DataFrame, key: str, column: str = "body") -> DataFrame:
    """Little-endian 64-bit floats of a binary column as an array; NaN is null."""
    kind = df.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for raw in batch.column(column).to_pylist():
                x = np.frombuffer(raw[: len(raw) // 8 * 8], "<f8") if raw else np.zeros(0)
                rows.append([None if v != v else v for v in x.tolist()])
            yield pa.RecordBatch.from_arrays([batch.column(key), pa.array(rows, pa.list_(pa.float64()))], names=[key, "values"])

    return df.select(key, column).mapInArrow(run, f"{key} {kind}, values array<double>")
