"""Helpers shared by the corpus operators: durable intermediates (of skysift.stored) and Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from skysift.stored import materialize, shared_dir  # noqa: F401

#: Rows and bytes of one Arrow batch handed to Python at most. Long texts make large rows, so the bytes bound it.
BATCH_ROWS, BATCH_BYTES = 1000, 16 << 20


def short_batches(spark: SparkSession) -> None:
    """Bound the memory of Python tasks. The settings are the session's and stay: each operator sets the same ones,
    as a plan that is returned runs under what the session has then."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def text_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Each batch with its `text` column as str; a null text counts as empty."""
    for batch in batches:
        yield batch, [x or "" for x in batch.column("text").to_pylist()]


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
