"""Raw visibility files: a data source whose partitions are gulps of files.

A file is a 16-byte header (time as MJD float64, sub-band uint32, declination float32, little-endian)
and complex64 samples, time by baseline by channel by polarisation. A gulp is found by its offset, so
a task reads no more than its part; with `header` only headers are read. Predicates on time, sub-band,
declination, gulp and sample are answered while the scan is planned, from headers and offsets, so what they rule out
is no partition (with the option `pruned`, which needs spark.sql.python.filterPushdown.enabled; scan() sets both). Paths must be in a folder that all executors mount; for object stores use read_blocks(), which goes through
Spark's binary files.
"""

from __future__ import annotations

import glob
import operator
import os
import struct
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, IsNotNull, LessThan, LessThanOrEqual

from skysift.schemas import VISIBILITY

HEADER = "<dIf"
HEADER_BYTES = struct.calcsize(HEADER)
HEADER_SCHEMA = "file string, mjd double, sb int, dec double, gulps int"


def encode(mjd: float, sb: int, dec: float, samples: np.ndarray) -> bytes:
    return struct.pack(HEADER, mjd, sb, dec) + np.ascontiguousarray(samples, "<c8").tobytes()


def rows_of(file: str, head: tuple[float, int, float], gulp: int, samples: np.ndarray) -> pa.RecordBatch:
    """Long rows of one gulp's samples (time, baseline, channel, polarisation); a sample that isn't finite is null."""
    t, bl, chan, pol = (x.ravel() for x in np.indices(samples.shape))
    n, flat = samples.size, samples.ravel()
    null = ~np.isfinite(flat.real) | ~np.isfinite(flat.imag)
    ints = lambda x: pa.array(np.broadcast_to(x, n).astype(np.int32))
    doubles = lambda x, mask=None: pa.array(np.broadcast_to(x, n).astype(float), mask=mask)
    return pa.RecordBatch.from_arrays(
        [pa.array([file] * n), doubles(head[0]), ints(head[1]), doubles(head[2]), ints(gulp), ints(t + gulp * samples.shape[0]), ints(bl), ints(chan), ints(pol), doubles(flat.real, null), doubles(flat.imag, null)],
        names=["file", "mjd", "sb", "dec", "gulp", "t", "bl", "chan", "pol", "re", "im"],
    )


class GulpPartition(InputPartition):
    def __init__(self, path: str, gulp: int):
        super().__init__((path, gulp))
        self.path, self.gulp = path, gulp


_COMPARED = {EqualTo: operator.eq, GreaterThan: operator.gt, GreaterThanOrEqual: operator.ge, LessThan: operator.lt, LessThanOrEqual: operator.le}


def _test(f: Filter) -> Callable | None:
    """A function that says whether a value passes; None for filters of other forms."""
    if isinstance(f, In):
        return lambda x: x in f.value
    if isinstance(f, IsNotNull):
        return lambda x: True
    compare = _COMPARED.get(type(f))
    return compare and f.value is not None and (lambda x: compare(x, f.value)) or None


def _may_hold(f: Filter, low: int, high: int) -> bool:
    """Whether some whole number from low to high passes."""
    if isinstance(f, EqualTo):
        return low <= f.value <= high
    if isinstance(f, In):
        return any(v is not None and low <= v <= high for v in f.value)
    return _test(f)(high if isinstance(f, (GreaterThan, GreaterThanOrEqual)) else low)


class VisibilityReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.path = options["path"]
        self.shape = tuple(int(options.get(k, d)) for k, d in (("nsamps", 25), ("nbase", 4656), ("nchan", 8), ("npol", 2)))
        self.header = options.get("header", "false").lower() == "true"
        #: Tests of a file's header by column, of a gulp's number, and filters on samples.
        self.of_file: list[tuple[str, Callable]] = []
        self.of_gulp: list[Callable] = []
        self.of_sample: list[Filter] = []

    def _gulps(self, path: str) -> int:
        return max(0, os.path.getsize(path) - HEADER_BYTES) // (8 * int(np.prod(self.shape)))

    def _wanted(self, path: str) -> bool:
        if not self.of_file:
            return True
        with open(path, "rb") as f:
            head = dict(zip(("mjd", "sb", "dec"), struct.unpack(HEADER, f.read(HEADER_BYTES)), strict=True))
        return all(test(head[column]) for column, test in self.of_file)

    def _has(self, gulp: int) -> bool:
        first = gulp * self.shape[0]
        return all(test(gulp) for test in self.of_gulp) and all(_may_hold(f, first, first + self.shape[0] - 1) for f in self.of_sample)

    def partitions(self) -> list[InputPartition]:
        files = [f for f in sorted(glob.glob(self.path)) if self._wanted(f)]
        return [GulpPartition(f, g) for f in files for g in ([-1] if self.header else filter(self._has, range(self._gulps(f))))]

    def read(self, partition: GulpPartition | None) -> Iterator[pa.RecordBatch]:
        if partition is None:  # what a scan without partitions gets
            return
        with open(partition.path, "rb") as f:
            head = struct.unpack(HEADER, f.read(HEADER_BYTES))
            if self.header:
                yield pa.RecordBatch.from_arrays([pa.array([partition.path]), pa.array([head[0]]), pa.array([head[1]], pa.int32()), pa.array([float(head[2])]), pa.array([self._gulps(partition.path)], pa.int32())], names=["file", "mjd", "sb", "dec", "gulps"])
                return
            size = 8 * int(np.prod(self.shape))
            f.seek(HEADER_BYTES + partition.gulp * size)
            yield rows_of(partition.path, head, partition.gulp, np.frombuffer(f.read(size), "<c8").reshape(self.shape))


class PrunedReader(VisibilityReader):
    """The reader that takes predicates; Spark refuses it where it hands none over."""

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """Filters that the scan can't answer alone go back to Spark; one on samples goes back too, as a gulp has others."""
        for f in filters:
            column, test = getattr(f, "attribute", (None,)), _test(f)
            if test is None or len(column) > 1:
                yield f
            elif column[0] in ("mjd", "sb", "dec"):
                self.of_file.append((column[0], test))
            elif column[0] == "gulp" and not self.header:
                self.of_gulp.append(test)
            else:
                if column[0] == "t" and not self.header and not isinstance(f, IsNotNull):
                    self.of_sample.append(f)
                yield f


class VisibilitySource(DataSource):
    """spark.read.format("visibility").options(nbase=..., nchan=..., npol=..., nsamps=..., header=..., pruned=...).load(glob)"""

    @classmethod
    def name(cls) -> str:
        return "visibility"

    def schema(self) -> str:
        return HEADER_SCHEMA if self.options.get("header", "false").lower() == "true" else VISIBILITY

    def reader(self, schema) -> VisibilityReader:
        return (PrunedReader if self.options.get("pruned", "false").lower() == "true" else VisibilityReader)(dict(self.options))


def scan(spark: SparkSession, path: str, nsamps: int, nbase: int, nchan: int, npol: int, header: bool = False) -> DataFrame:
    """Rows of files that match the path, with predicates handed to the source from now on in this session."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(VisibilitySource)
    return spark.read.format("visibility").options(nsamps=nsamps, nbase=nbase, nchan=nchan, npol=npol, header=str(header).lower(), pruned="true").load(path)


def write(rows: DataFrame, folder: str, nsamps: int, nbase: int, nchan: int, npol: int) -> DataFrame:
    """(file, gulps) of raw files written from rows (mjd, sb, dec, t, bl, chan, pol, re, im), one for each time and sub-band.

    A file's rows come to its task in order and leave it gulp by gulp, so memory holds one gulp. Samples that lack, gulps
    between others too, are NaN. A file appears under its name when it is whole, so a task may be run again.
    """
    shape = (nsamps, nbase, nchan, npol)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: list[tuple[str, int]] = []
        key, out, gulp, block = None, None, 0, None

        def next_gulp() -> None:
            nonlocal gulp, block
            out.write(block.tobytes())
            gulp, block = gulp + 1, np.full(shape, complex(np.nan, np.nan), "<c8")

        def finish() -> None:
            if out is not None:
                next_gulp()
                out.close()
                os.replace(out.name, name := out.name.rsplit(".", 1)[0])
                done.append((name, gulp))

        for batch in batches:
            cols = {c: np.asarray(batch.column(c).to_numpy(zero_copy_only=False)) for c in batch.schema.names}
            keys = np.rec.fromarrays([cols["mjd"], cols["sb"], cols["t"] // nsamps])
            for part in np.split(np.arange(len(keys)), np.flatnonzero(keys[1:] != keys[:-1]) + 1):
                mjd, sb, at = (keys[part[0]][k] for k in range(3))
                if (mjd, sb) != key:
                    finish()
                    key, gulp, block = (mjd, sb), 0, np.full(shape, complex(np.nan, np.nan), "<c8")
                    out = open(f"{folder}/{mjd:.6f}_sb{sb:02d}.vis.{os.getpid()}-{np.random.randint(1 << 30)}", "wb")  # noqa: SIM115
                    out.write(struct.pack(HEADER, mjd, sb, cols["dec"][part[0]]))
                while gulp < at:
                    next_gulp()
                block[tuple(cols[c][part] - (gulp * nsamps if c == "t" else 0) for c in ("t", "bl", "chan", "pol"))] = cols["re"][part] + 1j * cols["im"][part]
        finish()
        yield pa.RecordBatch.from_arrays([pa.array([f for f, _ in done], pa.string()), pa.array([g for _, g in done], pa.int32())], names=["file", "gulps"])

    os.makedirs(folder, exist_ok=True)
    kept = rows.select("mjd", F.col("sb").cast("int").alias("sb"), "dec", *[F.col(c).cast("int").alias(c) for c in ("t", "bl", "chan", "pol")], F.col("re").cast("double").alias("re"), F.col("im").cast("double").alias("im"))
    return kept.repartition("mjd", "sb").sortWithinPartitions("mjd", "sb", "t").mapInArrow(run, "file string, gulps int")


def _unpacked(files: DataFrame, shape: tuple[int, ...]) -> DataFrame:
    """Long rows of files (path, content)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, content in zip(batch.column("path").to_pylist(), batch.column("content"), strict=True):
                raw = content.as_buffer()
                head = struct.unpack(HEADER, raw[:HEADER_BYTES].to_pybytes())
                body = np.frombuffer(raw[HEADER_BYTES:], "<c8")
                size = int(np.prod(shape))
                for gulp in range(len(body) // size):
                    yield rows_of(file, head, gulp, body[gulp * size : (gulp + 1) * size].reshape(shape))

    return files.select("path", "content").mapInArrow(run, VISIBILITY)


def read_blocks(spark: SparkSession, path: str, nsamps: int, nbase: int, nchan: int, npol: int) -> DataFrame:
    """The same rows through Spark's own file access; a file is one record of at most 2 GB."""
    return _unpacked(spark.read.format("binaryFile").load(path), (nsamps, nbase, nchan, npol))


def stream_blocks(spark: SparkSession, path: str, nsamps: int, nbase: int, nchan: int, npol: int, files: int = 16) -> DataFrame:
    """The stream of rows of files as they land, so many files a micro-batch; which were read is kept in the query's checkpoint."""
    landed = spark.readStream.format("binaryFile").schema("path string, modificationTime timestamp, length bigint, content binary").option("maxFilesPerTrigger", files).load(path)
    return _unpacked(landed, (nsamps, nbase, nchan, npol))


def complete_files(headers: DataFrame, parts: int) -> DataFrame:
    """Times of which all sub-bands' files are there."""
    return headers.groupBy("mjd").agg(F.countDistinct("sb").alias("n")).where(F.col("n") == parts).select("mjd")
