"""A page buffer as a stream source and sink: fixed pages that one side appends and the other reads once each.

A buffer is a folder that all executors mount. Data files hold frames of one size: a header (time as MJD, sub-band,
declination, flags, bytes in use) and a payload of up to `page_bytes`. Which files count, and in which order, is in commit
files named by number, first page and pages, so the newest offset is one listing away. A commit file appears whole or not at
all; what a failed task or batch has written is in none. A page in use less than it could be is a short read; a
page with the end flag closes an observation.
"""

from __future__ import annotations

import json
import os
import struct
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, DataSourceStreamWriter, DataSourceWriter, InputPartition, WriterCommitMessage

from skysift.schemas import VISIBILITY
from skysift.sources.visibility import rows_of

FRAME = "<dIfIQ"
FRAME_BYTES = struct.calcsize(FRAME)
END = 1
SCHEMA = "page bigint, mjd double, sb int, dec double, last boolean, data binary"
#: What the sink takes; a null payload is an empty page.
ROWS = "mjd double, sb int, dec double, last boolean, data binary"


@dataclass
class Written(WriterCommitMessage):
    """A data file of one task; None where it had no rows."""

    file: str | None
    pages: int


@dataclass(frozen=True)
class Commit:
    number: int
    first: int
    pages: int
    path: str

    @property
    def until(self) -> int:
        return self.first + self.pages


def commits(folder: str) -> list[Commit]:
    """The commits of a buffer in order."""
    try:
        names = sorted(n for n in os.listdir(f"{folder}/commits") if n.endswith(".json"))
    except FileNotFoundError:
        return []
    return [Commit(*map(int, n[:-5].split("-")), f"{folder}/commits/{n}") for n in names]


def write_frames(folder: str, rows: Iterator, page_bytes: int) -> Written:
    """A data file of rows with the columns of ROWS; without rows none."""
    os.makedirs(f"{folder}/data", exist_ok=True)
    name, count = f"data/{uuid.uuid4().hex}.pages", 0
    try:
        f = None
        for r in rows:
            data = bytes(r.data or b"")
            if len(data) > page_bytes:
                raise ValueError(f"{len(data)} bytes are more than a page of {page_bytes}")
            f = f or open(f"{folder}/{name}", "wb")
            f.write(struct.pack(FRAME, r.mjd or 0.0, r.sb or 0, r.dec or 0.0, END if r.last else 0, len(data)) + data.ljust(page_bytes, b"\0"))
            count += 1
        if f:
            f.flush()
            os.fsync(f.fileno())
            f.close()
    except BaseException:
        if f:
            f.close()
            os.unlink(f"{folder}/{name}")
        raise
    return Written(name if count else None, count)


def publish(folder: str, written: list[Written | None], page_bytes: int, writer: str, batch: int) -> bool:
    """Append the files as one commit, unless this writer has committed the batch before (then its files go)."""
    os.makedirs(f"{folder}/commits", exist_ok=True)
    files = [w for w in written if w and w.file]
    known = commits(folder)
    for c in reversed(known):
        with open(c.path) as f:
            held = json.load(f)
        if held["writer"] == writer:
            if held["batch"] >= batch:
                discard(folder, files)
                return False
            break
    first = known[-1].until if known else 0
    count = sum(w.pages for w in files)
    draft = f"{folder}/commits/.{uuid.uuid4().hex}"
    with open(draft, "w") as f:
        json.dump({"writer": writer, "batch": batch, "page_bytes": page_bytes, "files": [[w.file, w.pages] for w in files]}, f)
    try:  # a link fails where another writer took the number
        os.link(draft, f"{folder}/commits/{(known[-1].number if known else -1) + 1:012d}-{first:016d}-{count:012d}.json")
    finally:
        os.unlink(draft)
    return True


def discard(folder: str, written: list[Written | None]) -> None:
    for w in written:
        if w and w.file and os.path.exists(f"{folder}/{w.file}"):
            os.unlink(f"{folder}/{w.file}")


class Pages(InputPartition):
    def __init__(self, file: str, page_bytes: int, index: int, count: int, page: int):
        super().__init__(page)
        self.file, self.page_bytes, self.index, self.count, self.page = file, page_bytes, index, count, page


def _parts(folder: str, start: int, end: int, at_once: int) -> list[InputPartition]:
    """Ranges of pages from start to before end, `at_once` pages of one file at most."""
    out: list[InputPartition] = []
    for c in commits(folder):
        if c.until <= start or c.first >= end:
            continue
        with open(c.path) as f:
            held = json.load(f)
        page = c.first
        for name, count in held["files"]:
            low, high = max(start, page), min(end, page + count)
            out += [Pages(f"{folder}/{name}", held["page_bytes"], at - page, min(at_once, high - at), at) for at in range(low, high, at_once)]
            page += count
    return out


def _read(part: Pages | None) -> Iterator[pa.RecordBatch]:
    if part is None:  # what a scan without partitions gets
        return
    with open(part.file, "rb") as f:
        f.seek(part.index * (FRAME_BYTES + part.page_bytes))
        for k in range(part.count):
            frame = f.read(FRAME_BYTES + part.page_bytes)
            mjd, sb, dec, flags, used = struct.unpack(FRAME, frame[:FRAME_BYTES])
            values = (part.page + k, mjd, sb, float(dec), bool(flags & END), frame[FRAME_BYTES : FRAME_BYTES + used])
            kinds = (pa.int64(), pa.float64(), pa.int32(), pa.float64(), pa.bool_(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, kinds, strict=True)], names=["page", "mjd", "sb", "dec", "last", "data"])


class _Options:
    def __init__(self, options: dict[str, str]):
        self.folder = options["path"].removeprefix("file:").replace("///", "/")
        self.at_once = int(options.get("pages_per_task", "16"))
        self.clear = options.get("clear", "false").lower() == "true"
        self.page_bytes = int(options.get("page_bytes", "14899200"))
        self.writer = options.get("writer", "stream")
        self.earliest = options.get("start", "earliest") != "latest"

    def newest(self) -> int:
        known = commits(self.folder)
        return known[-1].until if known else 0


class PageStream(DataSourceStreamReader):
    """Offsets are page numbers; with `clear`, pages are removed once a query has committed past them."""

    def __init__(self, options: dict[str, str]):
        self.at = _Options(options)

    def initialOffset(self) -> dict:
        return {"page": 0 if self.at.earliest else self.at.newest()}

    def latestOffset(self) -> dict:
        return {"page": self.at.newest()}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        return _parts(self.at.folder, start["page"], end["page"], self.at.at_once)

    def read(self, partition: Pages) -> Iterator[pa.RecordBatch]:
        return _read(partition)

    def commit(self, end: dict) -> None:
        if not self.at.clear:
            return
        for c in commits(self.at.folder)[:-1]:  # the last one has the newest offset
            if c.until <= end["page"]:
                with open(c.path) as f:
                    discard(self.at.folder, [Written(*x) for x in json.load(f)["files"]])
                os.unlink(c.path)


class PageReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.at = _Options(options)

    def partitions(self) -> list[InputPartition]:
        return _parts(self.at.folder, 0, self.at.newest(), self.at.at_once)

    def read(self, partition: Pages) -> Iterator[pa.RecordBatch]:
        return _read(partition)


class PageStreamWriter(DataSourceStreamWriter):
    """Each task writes a file of its own; a batch's files count from the commit on, once, however often the batch is run."""

    def __init__(self, options: dict[str, str]):
        self.at = _Options(options)

    def write(self, iterator: Iterator) -> Written:
        return write_frames(self.at.folder, iterator, self.at.page_bytes)

    def commit(self, messages: list[Written | None], batchId: int) -> None:
        publish(self.at.folder, messages, self.at.page_bytes, self.at.writer, batchId)

    def abort(self, messages: list[Written | None], batchId: int) -> None:
        discard(self.at.folder, messages)


class PageWriter(DataSourceWriter):
    """One batch from outside a stream: a commit of its own."""

    def __init__(self, options: dict[str, str]):
        self.at = _Options(options)

    def write(self, iterator: Iterator) -> Written:
        return write_frames(self.at.folder, iterator, self.at.page_bytes)

    def commit(self, messages: list[Written | None]) -> None:
        publish(self.at.folder, messages, self.at.page_bytes, uuid.uuid4().hex, 0)

    def abort(self, messages: list[Written | None]) -> None:
        discard(self.at.folder, messages)


class PageSource(DataSource):
    """format("pages") with options path, page_bytes, writer (to write), pages_per_task, start (earliest or latest), clear (to read)."""

    @classmethod
    def name(cls) -> str:
        return "pages"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> PageReader:
        return PageReader(dict(self.options))

    def streamReader(self, schema) -> PageStream:
        return PageStream(dict(self.options))

    def writer(self, schema, overwrite: bool) -> PageWriter:
        return PageWriter(dict(self.options))

    def streamWriter(self, schema, overwrite: bool) -> PageStreamWriter:
        return PageStreamWriter(dict(self.options))


def visibilities(pages: DataFrame, nsamps: int, nbase: int, nchan: int, npol: int) -> DataFrame:
    """Long rows of pages of complex64 samples; a page is a gulp of its number. Of a short page the whole samples count."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wide = nbase * nchan * npol
        for batch in batches:
            for row in batch.to_pylist():
                got = min(nsamps, len(row["data"]) // (8 * wide))
                block = np.full(nsamps * wide, np.nan, "<c8")
                block[: got * wide] = np.frombuffer(row["data"], "<c8", got * wide)
                yield rows_of(f"page {row['page']}", (row["mjd"], row["sb"], row["dec"]), row["page"], block.reshape(nsamps, nbase, nchan, npol)).slice(0, got * wide)

    return pages.select("page", "mjd", "sb", "dec", "data").mapInArrow(run, VISIBILITY)


#: Numbers before an image's samples: node, MJD, diagonal of the plane, declination, port, and three lengths.
MESSAGE = 8
IMAGES = "page bigint, node int, mjd double, uv_diag double, dec double, port int, shape array<int>, status int, values array<double>"


def images(pages: DataFrame) -> DataFrame:
    """Image messages of pages of doubles. status: 0, or 1 where the header is short, 2 where samples lack (then there are no values)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for page, data in zip(batch.column("page").to_pylist(), batch.column("data").to_pylist(), strict=True):
                x = np.frombuffer(data, "<f8", len(data) // 8)
                row = {"page": page, "status": 1, "values": None}
                if len(x) >= MESSAGE:
                    shape = [int(n) for n in x[5:MESSAGE]]
                    need = int(np.prod(shape))
                    row |= {"node": int(x[0]), "mjd": x[1], "uv_diag": x[2], "dec": x[3], "port": int(x[4]), "shape": shape, "status": 0 if len(x) >= MESSAGE + need else 2}
                    if not row["status"]:
                        row["values"] = [None if v != v else v for v in x[MESSAGE : MESSAGE + need].tolist()]
                rows.append(row)
            yield pa.RecordBatch.from_pylist(rows, pa.schema([("page", pa.int64()), ("node", pa.int32()), ("mjd", pa.float64()), ("uv_diag", pa.float64()), ("dec", pa.float64()), ("port", pa.int32()), ("shape", pa.list_(pa.int32())), ("status", pa.int32()), ("values", pa.list_(pa.float64()))]))

    return pages.select("page", "data").mapInArrow(run, IMAGES)


def image_pages(rows: DataFrame) -> DataFrame:
    """Pages (ROWS) of image messages (node, mjd, uv_diag, dec, port, shape, values, last); a null value is NaN."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [np.array([r["node"], r["mjd"], r["uv_diag"], r["dec"], r["port"], *r["shape"], *(np.nan if v is None else v for v in r["values"])], "<f8").tobytes() for r in batch.to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("mjd"), batch.column("node"), batch.column("dec"), batch.column("last"), pa.array(out, pa.binary())], names=["mjd", "sb", "dec", "last", "data"])

    return rows.select("node", "mjd", "uv_diag", "dec", "port", "shape", "values", "last").mapInArrow(run, ROWS)
