"""Media columns with content-defined chunks.

A payload of 8-bit samples (a text's UTF-8 bytes, padded) is cut where a rolling gear hash of the last
32 bytes says so, hence equal passages give equal chunks wherever they stand. Spark joins on the chunk
digests give every digest one owner; the store keeps each chunk once, packed with the other chunks of
its owner's payload, and an ordered chunk list for every distinct payload. Reading puts the chunks in
order (those of other payloads come by a join on their digests), checks the payload's digest and
computes features.

Which chunks are shared is found on the narrow lists of digests. Compressed payloads are shuffled once, by
payload, which brings copies together and each to the list of its shared chunks; payloads whose chunks are
all their own are then read where they lie.

Chunks are compressed with one dictionary for the store, trained on blocks of DICT_ROWS sampled texts.

Defined results: a null or empty text is one unit of padding; rows that repeat get equal values; an
empty table gives an empty result; only id and text are read.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skysift.llm.compression_classifier import build_dictionary
from skysift.llm.support import materialize, short_batches, text_rows

#: A payload is padded with PAD to a positive multiple of UNIT bytes.
UNIT, PAD = 576, b"\xff"
#: Bytes of a chunk: at least, at most, and 2^BITS more than the least on average.
LEAST, MOST, BITS = 256, 8192, 10
#: Texts sampled for the store's dictionary, bytes of a block and blocks of each text; the dictionary's bytes; the level.
DICT_ROWS, DICT_BLOCK, DICT_BLOCKS, DICT_BYTES, LEVEL = 500, 1024, 4, 112_640, 6
#: The driver sees some times SPARE texts' blocks before it picks DICT_ROWS.
SPARE = 4
#: Bytes of a digest that names a chunk or payload; whole digests are reported.
NAME = 16
_GEAR = np.random.default_rng(577).integers(0, 2**32, 256, np.uint32)


def payload_of(text: str) -> bytes:
    raw = text.encode("utf-8", "surrogatepass")
    return raw + PAD * (max(1, -(-len(raw) // UNIT)) * UNIT - len(raw))


def cuts(payload: bytes) -> list[int]:
    """Ends of the chunks."""
    size = len(payload)
    if size <= LEAST:
        return [size]
    rolled = _GEAR[np.frombuffer(payload, np.uint8)]
    for step in (1, 2, 4, 8, 16):  # sums of 2, 4 ... 32 shifted values
        longer = rolled.copy()
        longer[step:] += rolled[:-step] << np.uint32(step)
        rolled = longer
    places = np.flatnonzero(rolled >> np.uint32(32 - BITS) == 0) + 1
    out, start = [], 0
    while size - start > LEAST:
        at = int(np.searchsorted(places, start + LEAST))
        start = min(int(places[at]) if at < len(places) else size, start + MOST, size)
        out.append(start)
    return out if out[-1] == size else [*out, size]


def chunks(payload: bytes) -> list[bytes]:
    ends = cuts(payload)
    return [payload[a:b] for a, b in zip([0, *ends], ends)]


def digest(chunk: bytes) -> bytes:
    return hashlib.sha256(chunk).digest()[:NAME]


def manifests(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, payload_bytes, payload (its digest) and the ordered chunk digests of each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_rows(batches):
            payloads = [payload_of(t) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").cast(pa.int64()),
                    pa.array([len(t.encode("utf-8", "surrogatepass")) for t in texts], pa.int64()),
                    pa.array([len(p) for p in payloads], pa.int64()),
                    pa.array([digest(p) for p in payloads], pa.binary()),
                    pa.array([[digest(c) for c in chunks(p)] for p in payloads], pa.list_(pa.binary())),
                ],
                names=["doc_id", "n_bytes", "payload_bytes", "payload", "digests"],
            )

    short_batches(docs.sparkSession)
    return docs.select("doc_id", "text").mapInArrow(run, "doc_id bigint, n_bytes bigint, payload_bytes bigint, payload binary, digests array<binary>")


_SHARED = "array<struct<at:int,digest:binary>>"


def shared_chunks(listed: DataFrame) -> DataFrame:
    """Which payload owns each chunk that several payloads hold: payload, foreign (digests that it must fetch, with
    their places among its distinct chunks) and lent (likewise those of its own that others fetch). Few payloads have a row."""
    refs = listed.select("payload", F.posexplode(F.array_distinct("digests")).alias("at", "digest"))
    owners = refs.groupBy("digest").agg(F.min("payload").alias("owner"), F.max("payload").alias("last")).where("owner <> last").select("digest", "owner")
    met = refs.join(materialize(owners, "owners"), "digest").withColumn("c", F.struct("at", "digest"))
    foreign, lent = (F.collect_set(F.when(own, F.col("c"))).cast(_SHARED) for own in (F.col("payload") != F.col("owner"), F.col("payload") == F.col("owner")))
    return met.groupBy("payload").agg(foreign.alias("foreign"), lent.alias("lent"))


def dictionary(docs: DataFrame) -> bytes:
    """The store's dictionary from blocks of a bounded sample: texts whose hash falls under a bound that some SPARE
    times DICT_ROWS reach, equal rows once, and of each the blocks at hashed places."""
    bound = F.lit(max(1, docs.count() // (SPARE * DICT_ROWS)))
    whole = F.encode(F.coalesce("text", F.lit("")), "UTF-8")
    few = docs.select(F.xxhash64("doc_id", "text").alias("o"), whole.alias("b")).where((F.pmod("o", bound) == 0) & (F.octet_length("b") >= 64))
    count = F.greatest(F.floor(F.octet_length("b") / DICT_BLOCK), F.lit(1)).cast("int")
    places = F.transform(F.sequence(F.lit(1), F.lit(DICT_BLOCKS)), lambda k: F.pmod(F.xxhash64("o", k), count) * DICT_BLOCK + 1)
    blocks = F.transform(F.array_distinct(places), lambda k: F.substring("b", k.cast("int"), F.lit(DICT_BLOCK)))
    rows = few.select("o", blocks.alias("blocks")).groupBy("o").agg(F.first("blocks").alias("blocks")).orderBy("o").limit(DICT_ROWS).collect()
    found = [bytes(x) for r in rows for x in r.blocks]
    return build_dictionary(found, DICT_BYTES) if found else b""


def _press(raw: bytes):
    """A function to compressed chunks; sizes and dictionary are known, so frames don't name them."""
    held = {"dict_data": zstandard.ZstdCompressionDict(raw)} if raw else {}
    return zstandard.ZstdCompressor(level=LEVEL, write_content_size=False, write_dict_id=False, write_checksum=False, **held).compress


def _open(raw: bytes):
    whole = zstandard.ZstdDecompressor(**({"dict_data": zstandard.ZstdCompressionDict(raw)} if raw else {}))
    return lambda blob: whole.decompress(blob, max_output_size=MOST)


def packs(docs: DataFrame, shared: DataFrame, raw: bytes) -> DataFrame:
    """payload, blobs of its distinct chunks (null where one is foreign), order (the chunk list as places among them;
    null where it is theirs), foreign and lent of each distinct payload."""
    held = docs.sparkSession.sparkContext.broadcast(raw)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press, seen = _press(held.value), set()
        for _, texts in text_rows(batches):
            rows: list[tuple] = []
            for text in texts:
                payload = payload_of(text)
                name = digest(payload)
                if name not in seen:
                    if len(seen) < 1_000_000:
                        seen.add(name)
                    parts = chunks(payload)
                    place = {c: k for k, c in enumerate(dict.fromkeys(parts))}
                    rows.append((name, list(map(press, place)), [place[c] for c in parts] if len(place) < len(parts) else None))
            types = (pa.binary(), pa.list_(pa.binary()), pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(types)], names=["payload", "blobs", "order"])

    short_batches(docs.sparkSession)
    pressed = docs.select("text").mapInArrow(run, "payload binary, blobs array<binary>, order array<int>").dropDuplicates(["payload"])
    none = F.array().cast(_SHARED)
    known = pressed.join(shared, "payload", "left").select("payload", "blobs", "order", F.coalesce("foreign", none).alias("foreign"), F.coalesce("lent", none).alias("lent"))
    # which places are foreign, as one byte a place up to the last: made from the gaps between them, and looked up at once; the
    # variable of the outer transform holds it, so it is made once a row
    known = known.withColumn("foreign", F.array_sort("foreign"))
    gap = lambda c, k: c["at"] - F.coalesce(F.get("foreign", k - 1)["at"], F.lit(-1)) - 1
    marks = F.array_join(F.transform("foreign", lambda c, k: F.concat(F.repeat(F.lit("0"), gap(c, k)), F.lit("1"))), "").cast("binary")
    left = F.transform(F.array(marks), lambda m: F.transform("blobs", lambda b, k: F.when(F.substring(m, k + 1, F.lit(1)) == F.lit(b"1"), None).otherwise(b)))
    own = F.when(F.size("foreign") == 0, F.col("blobs")).otherwise(F.get(left, F.lit(0)))
    return known.select("payload", own.alias("blobs"), "order", "foreign", "lent")


def describe(samples: bytes, parts: int) -> str:
    """Features of read samples: chunks, mean, deviation, and the shares of eight value ranges."""
    values = np.frombuffer(samples, np.uint8)
    shares = np.bincount(values >> 5, minlength=8) / len(values)
    return f"chunks={parts};mean={values.mean():.4f};std={values.std():.4f};bins=" + "/".join(f"{s:.4f}" for s in shares)


def read_back(stored: DataFrame, raw: bytes) -> DataFrame:
    """Digests, sizes and features of each stored payload, from the bytes in the store."""
    lent = stored.select("blobs", F.explode("lent").alias("c")).select("c.digest", F.get("blobs", "c.at").alias("fetched")).dropDuplicates(["digest"])
    parted = stored.where(F.size("foreign") > 0)
    needs = parted.select("payload", F.explode("foreign").alias("c")).select("payload", "c.at", "c.digest")
    fetched = needs.join(lent, "digest").groupBy("payload").agg(F.collect_list(F.struct("at", "fetched")).alias("got"))
    none = F.array().cast("array<struct<at:int,fetched:binary>>")
    filled = parted.join(fetched, "payload").select("payload", "blobs", "order", "got")
    complete = stored.where(F.size("foreign") == 0).select("payload", "blobs", "order", none.alias("got")).unionByName(filled)
    held = stored.sparkSession.sparkContext.broadcast(raw)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_ = _open(held.value)
        for batch in batches:
            cols: tuple[list, ...] = ([], [], [], [], [], [])
            for name, blobs, order, got in zip(*(batch.column(c).to_pylist() for c in ("payload", "blobs", "order", "got")), strict=True):
                for chunk in got:
                    blobs[chunk["at"]] = chunk["fetched"]
                blobs = [blobs[k] for k in order] if order else blobs
                samples = b"".join(map(open_, blobs))
                if digest(samples) != name:
                    raise ValueError(f"payload {name.hex()} does not match its digest")
                media = b"".join(struct.pack("<I", len(b)) + b for b in blobs)
                for col, value in zip(cols, (name, hashlib.sha256(samples).hexdigest(), zlib.crc32(samples[-32:]), len(media), hashlib.sha256(media).hexdigest(), describe(samples, len(blobs))), strict=True):
                    col.append(value)
            types = (pa.binary(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], names=["payload", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"])

    short_batches(stored.sparkSession)
    return complete.mapInArrow(run, "payload binary, payload_sha256 string, tail_crc32 bigint, media_bytes bigint, media_sha256 string, feature string")


def store_media(docs: DataFrame) -> tuple[DataFrame, DataFrame, bytes]:
    """The stored tables: one row for each document (its payload's digest and chunk list), one for each distinct payload; and the dictionary."""
    docs = docs.select("doc_id", "text")
    listed = materialize(manifests(docs), "manifests")
    shared = materialize(shared_chunks(listed), "shared-chunks")
    raw = dictionary(docs)
    return listed, materialize(packs(docs, shared, raw), "packs"), raw


def media_features(docs: DataFrame) -> DataFrame:
    listed, stored, raw = store_media(docs)
    read = materialize(read_back(stored, raw), "read-back")
    return listed.select("doc_id", "n_bytes", "payload_bytes", "payload").join(read, "payload").drop("payload")
