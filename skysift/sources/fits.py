"""FITS binary tables: a data source whose partitions are ranges of rows, and files written by tasks.

A file is a run of units, each a header of 80-character cards in blocks of 2,880 bytes and data filled up to such a block. The
table's header says how wide a row is and where its columns lie, so a task seeks to its rows. Numbers are big-endian. Paths must
be in a folder that all executors mount.
"""

from __future__ import annotations

import glob
import math
import os
import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

BLOCK, CARD = 2880, 80
#: Column letters: NumPy form (big-endian) and Spark type. Bits and variable-length arrays aren't read.
FORMS = {"L": ("S1", T.BooleanType()), "B": ("u1", T.ShortType()), "I": (">i2", T.ShortType()), "J": (">i4", T.IntegerType()), "K": (">i8", T.LongType()), "A": ("S", T.StringType()), "E": (">f4", T.FloatType()), "D": (">f8", T.DoubleType())}


def _padded(n: int) -> int:
    return -(-n // BLOCK) * BLOCK


def parse_cards(raw: bytes) -> dict[str, object]:
    """Values by keyword of a header's cards up to END; the first of a keyword counts, comments are left out."""
    out: dict[str, object] = {}
    for at in range(0, len(raw), CARD):
        card = raw[at : at + CARD].decode("ascii", "replace")
        name = card[:8].strip()
        if name == "END":
            break
        if card[8:10] != "= ":
            continue
        text = card[10:].strip()
        if text.startswith("'"):
            found = re.match(r"'((?:[^']|'')*)'", text)
            value: object = found[1].replace("''", "'").rstrip() if found else ""
        else:
            text = text.split("/", 1)[0].strip()
            try:
                value = {"T": True, "F": False, "": None}[text] if text in ("T", "F", "") else int(text) if re.fullmatch(r"[+-]?\d+", text) else float(text.replace("D", "E"))
            except ValueError:
                value = text
        out.setdefault(name, value)
    return out


def read_header(f) -> dict[str, object] | None:
    """The header at a file's place, which is then behind it; None at the end of the file."""
    raw = b""
    while True:
        block = f.read(BLOCK)
        if len(block) < BLOCK:
            return None
        raw += block
        if any(block[at : at + 8] == b"END     " for at in range(0, BLOCK, CARD)):
            return parse_cards(raw)


@dataclass(frozen=True)
class Column:
    name: str
    letter: str
    count: int
    offset: int
    scale: float
    zero: float
    null: int | None

    @property
    def scaled(self) -> bool:
        return (self.scale, self.zero) != (1, 0) and self.letter not in "AL"

    def field(self) -> T.StructField:
        kind = T.DoubleType() if self.scaled else FORMS[self.letter][1]
        return T.StructField(self.name, kind if self.letter == "A" or self.count == 1 else T.ArrayType(kind))

    def form(self) -> tuple:
        return (f"S{self.count}", ()) if self.letter == "A" else (FORMS[self.letter][0], (self.count,) if self.count > 1 else ())

    def array(self, values: np.ndarray) -> pa.Array:
        """The column's values as Arrow; TNULL and NaN are null, texts end at their first NUL and lose the blanks behind them."""
        kind = pa.list_(_arrow(self)) if self.count > 1 and self.letter != "A" else _arrow(self)
        if self.letter == "A":
            return pa.array([v.split(b"\0", 1)[0].decode("latin-1").rstrip() for v in values.tolist()], kind)
        if self.letter == "L":
            known = {b"T": True, b"F": False}
            return pa.array([known.get(v) for v in values.tolist()] if self.count == 1 else [[known.get(x) for x in v] for v in values.tolist()], kind)
        missing = values == self.null if self.null is not None else np.isnan(values) if values.dtype.kind == "f" else np.zeros(values.shape, bool)
        values = values.astype(np.float64) * self.scale + self.zero if self.scaled else values.astype(values.dtype.newbyteorder("="))
        flat = pa.array(values.ravel(), _arrow(self), mask=missing.ravel())
        return flat if self.count == 1 else pa.ListArray.from_arrays(pa.array(np.arange(0, values.size + 1, self.count), pa.int32()), flat)


def _arrow(c: Column) -> pa.DataType:
    return pa.float64() if c.scaled else {"L": pa.bool_(), "B": pa.int16(), "I": pa.int16(), "J": pa.int32(), "K": pa.int64(), "A": pa.string(), "E": pa.float32(), "D": pa.float64()}[c.letter]


@dataclass(frozen=True)
class Table:
    start: int
    width: int
    rows: int
    columns: tuple[Column, ...]


def find_table(path: str, unit: int) -> Table:
    """The binary table of a file that is its `unit`-th (from 0)."""
    with open(path, "rb") as f:
        seen = 0
        while (head := read_header(f)) is not None:
            axes = [int(head.get(f"NAXIS{n + 1}", 0)) for n in range(int(head.get("NAXIS", 0)))]
            size = abs(int(head.get("BITPIX", 8))) // 8 * int(head.get("GCOUNT", 1) or 1) * (int(head.get("PCOUNT", 0) or 0) + math.prod(axes)) if axes else 0
            if head.get("XTENSION") == "BINTABLE":
                if seen == unit:
                    return Table(f.tell(), axes[0], axes[1], tuple(_columns(head)))
                seen += 1
            f.seek(_padded(size), os.SEEK_CUR)
    raise ValueError(f"{path} has no binary table {unit}")


def _columns(head: dict[str, object]) -> Iterator[Column]:
    offset = 0
    for n in range(1, int(head["TFIELDS"]) + 1):
        form = re.match(r"(\d*)([A-Z])", str(head[f"TFORM{n}"]).strip())
        letter, count = form[2], int(form[1] or 1)
        if letter not in FORMS:
            raise ValueError(f"column {n}: form {head[f'TFORM{n}']} isn't read")
        if count:
            null = head.get(f"TNULL{n}")
            yield Column(str(head.get(f"TTYPE{n}", f"col{n}")).strip(), letter, count, offset, float(head.get(f"TSCAL{n}", 1)), float(head.get(f"TZERO{n}", 0)), None if null is None else int(null))
        offset += count * (1 if letter == "A" else np.dtype(FORMS[letter][0]).itemsize)


class Rows(InputPartition):
    def __init__(self, path: str, table: Table, first: int, count: int):
        super().__init__((path, first))
        self.path, self.table, self.first, self.count = path, table, first, count


class FitsReader(DataSourceReader):
    def __init__(self, options: dict[str, str], names: list[str]):
        self.files, self.unit = sorted(glob.glob(options["path"])), int(options.get("table", "0"))
        self.at_once, self.names = int(options.get("rows_per_task", "100000")), names

    def partitions(self) -> list[InputPartition]:
        tables = [(f, find_table(f, self.unit)) for f in self.files]
        return [Rows(f, t, at, min(self.at_once, t.rows - at)) for f, t in tables for at in range(0, t.rows, self.at_once)]

    def read(self, partition: Rows | None) -> Iterator[pa.RecordBatch]:
        if partition is None:  # what a scan without partitions gets
            return
        t = partition.table
        by_name = {c.name: c for c in t.columns}
        wanted = [by_name[n] for n in self.names]
        form = np.dtype({"names": [c.name for c in wanted], "formats": [c.form() for c in wanted], "offsets": [c.offset for c in wanted], "itemsize": t.width})
        with open(partition.path, "rb") as f:
            f.seek(t.start + partition.first * t.width)
            for at in range(0, partition.count, 10_000):
                many = min(10_000, partition.count - at)
                values = np.frombuffer(f.read(many * t.width), form, many)
                yield pa.RecordBatch.from_arrays([c.array(values[c.name]) for c in wanted], names=self.names)


class FitsSource(DataSource):
    """format("fits") with options path (a glob), table (which one of a file), columns (names by comma: others aren't decoded), rows_per_task."""

    @classmethod
    def name(cls) -> str:
        return "fits"

    def _names(self) -> list[str] | None:
        return [n.strip() for n in self.options["columns"].split(",")] if self.options.get("columns") else None

    def schema(self) -> T.StructType:
        files = sorted(glob.glob(self.options["path"]))
        if not files:
            raise FileNotFoundError(self.options["path"])
        fields = {c.name: c.field() for c in find_table(files[0], int(self.options.get("table", "0"))).columns}
        return T.StructType([fields[n] for n in self._names() or fields])

    def reader(self, schema: T.StructType) -> FitsReader:
        return FitsReader(dict(self.options), schema.names)


def scan(spark: SparkSession, path: str, columns: list[str] | None = None, table: int = 0, rows_per_task: int = 100_000) -> DataFrame:
    spark.dataSource.register(FitsSource)
    options = {"table": table, "rows_per_task": rows_per_task} | ({"columns": ",".join(columns)} if columns else {})
    return spark.read.format("fits").options(**options).load(path)


def _card(name: str, value: object) -> bytes:
    text = "T" if value is True else "F" if value is False else "'" + str(value).replace("'", "''").ljust(8) + "'" if isinstance(value, str) else str(value)
    return f"{name:8}= {text if isinstance(value, str) else text.rjust(20)}".ljust(CARD).encode("ascii")


def header(cards: list[tuple[str, object]]) -> bytes:
    raw = b"".join(_card(*c) for c in cards) + b"END".ljust(CARD)
    return raw.ljust(_padded(len(raw)), b" ")


def write(rows: DataFrame, folder: str, widths: dict[str, int] | None = None) -> DataFrame:
    """(file, rows) of the files written from rows, one a task that has any: an empty image and a binary table of long, int, short, double,
    float, boolean and text columns. widths: bytes of each text column (longer texts are an error). A null number is NaN, and for whole ones the
    least of their type (named in the header); a null text is empty. A file appears under its name when it is whole."""
    letters = {T.LongType: "K", T.IntegerType: "J", T.ShortType: "I", T.DoubleType: "D", T.FloatType: "E", T.BooleanType: "L", T.StringType: "A"}
    kinds = [(f.name, letters[type(f.dataType)], (widths or {}).get(f.name, 1)) for f in rows.schema.fields]
    form = np.dtype([(n, f"S{w}" if k == "A" else FORMS[k][0]) for n, k, w in kinds])
    least = {k: int(np.iinfo(np.dtype(FORMS[k][0])).min) for k in "IJK"}

    def table_header(count: int) -> bytes:
        cards: list[tuple[str, object]] = [("XTENSION", "BINTABLE"), ("BITPIX", 8), ("NAXIS", 2), ("NAXIS1", form.itemsize), ("NAXIS2", count), ("PCOUNT", 0), ("GCOUNT", 1), ("TFIELDS", len(kinds))]
        for n, (name, k, w) in enumerate(kinds, 1):
            cards += [(f"TTYPE{n}", name), (f"TFORM{n}", f"{w}A" if k == "A" else f"1{k}")] + ([(f"TNULL{n}", least[k])] if k in least else [])
        return header(cards)

    def packed(batch: pa.RecordBatch) -> np.ndarray:
        out = np.zeros(batch.num_rows, form)
        for name, k, w in kinds:
            values = batch.column(name).to_pylist()
            if k == "A":
                raw = [(v or "").encode("latin-1") for v in values]
                if any(len(v) > w for v in raw):
                    raise ValueError(f"a text of {name} is longer than {w} bytes")
                out[name] = raw
            elif k == "L":
                out[name] = [{True: b"T", False: b"F", None: b""}[v] for v in values]
            else:
                out[name] = [(least[k] if k in least else np.nan) if v is None else v for v in values]
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, count, f = f"{folder}/{uuid.uuid4().hex}.fits", 0, None
        start = header([("SIMPLE", True), ("BITPIX", 8), ("NAXIS", 0), ("EXTEND", True)])
        for batch in batches:
            if not batch.num_rows:
                continue
            if f is None:
                f = open(f"{name}.part", "wb")  # noqa: SIM115
                f.write(start + table_header(0))
            f.write(packed(batch).tobytes())
            count += batch.num_rows
        if f is not None:
            f.write(b"\0" * (_padded(count * form.itemsize) - count * form.itemsize))
            f.seek(len(start))
            f.write(table_header(count))
            f.close()
            os.replace(f"{name}.part", name)
            yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([count], pa.int64())], names=["file", "rows"])

    os.makedirs(folder, exist_ok=True)
    return rows.mapInArrow(run, "file string, rows bigint")


def write_images(rows: DataFrame, folder: str) -> DataFrame:
    """(file, images) of the files written from rows (name string, shape array<int> with the slowest axis first, values array<double>), one a
    task that has any: an image unit of doubles for each row, named by EXTNAME. A null value is NaN; a row whose values don't fill its
    shape is an error. A file appears under its name when it is whole."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, count, f = f"{folder}/{uuid.uuid4().hex}.fits", 0, None
        for batch in batches:
            for row in batch.to_pylist():
                values = np.array([np.nan if v is None else v for v in row["values"]], ">f8")
                if len(values) != math.prod(row["shape"]):
                    raise ValueError(f"{row['name']}: {len(values)} values for shape {row['shape']}")
                if f is None:
                    f = open(f"{name}.part", "wb")  # noqa: SIM115
                    f.write(header([("SIMPLE", True), ("BITPIX", 8), ("NAXIS", 0), ("EXTEND", True)]))
                axes = [(f"NAXIS{n + 1}", s) for n, s in enumerate(reversed(row["shape"]))]
                data = values.tobytes()
                f.write(header([("XTENSION", "IMAGE"), ("BITPIX", -64), ("NAXIS", len(axes)), *axes, ("PCOUNT", 0), ("GCOUNT", 1), ("EXTNAME", row["name"])]) + data.ljust(_padded(len(data)), b"\0"))
                count += 1
        if f is not None:
            f.close()
            os.replace(f"{name}.part", name)
            yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([count], pa.int64())], names=["file", "images"])

    os.makedirs(folder, exist_ok=True)
    return rows.select("name", "shape", "values").mapInArrow(run, "file string, images bigint")


def images(spark: SparkSession, path: str) -> DataFrame:
    """name, shape and values of the image units of files that match the path (a task a file; one unit is in memory at once). Whole numbers and
    floats are read, with BSCALE and BZERO; NaN is null, and so is BLANK."""
    kinds = {8: "u1", 16: ">i2", 32: ">i4", 64: ">i8", -32: ">f4", -64: ">f8"}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file in batch.column("file").to_pylist():
                with open(file, "rb") as f:
                    while (head := read_header(f)) is not None:
                        shape = [int(head[f"NAXIS{n}"]) for n in range(int(head.get("NAXIS", 0)), 0, -1)]
                        form = np.dtype(kinds[int(head["BITPIX"])])
                        extra = int(head.get("GCOUNT", 1) or 1) * (int(head.get("PCOUNT", 0) or 0) + math.prod(shape)) * form.itemsize if shape else 0
                        data = f.read(_padded(extra))
                        if not shape or head.get("XTENSION", "IMAGE") != "IMAGE":
                            continue
                        raw = np.frombuffer(data, form, math.prod(shape))
                        values = raw.astype(np.float64) * float(head.get("BSCALE", 1)) + float(head.get("BZERO", 0))
                        gone = np.isnan(values) | (raw == head["BLANK"] if head.get("BLANK") is not None else False)
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([str(head.get("EXTNAME", ""))]), pa.array([shape], pa.list_(pa.int32())), pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), pa.array(values, mask=gone))],
                            names=["name", "shape", "values"],
                        )

    files = sorted(glob.glob(path))
    listed = spark.createDataFrame([(f,) for f in files], "file string")
    return (listed.repartition(len(files)) if files else listed).mapInArrow(run, "name string, shape array<int>, values array<double>")
