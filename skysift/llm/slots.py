"""Sharding by fixed virtual slots.

Rows hash into a fixed number of virtual slots. Bytes and rows are summed per slot, and a versioned
slot-to-shard map, far smaller than the data, says where each slot lives. The map is stored in a folder,
one version beside the other; a version is never changed. Rebalancing loads the latest version, edits
it and stores the next: slots move, rows never hash anew.

Defined results: a null text has size 8 and the CRC of no bytes; rows that repeat land in one slot and
get positions of their own; rows without an id hash by their text alone; an empty table gives an empty
result; only the id and text columns are read, so other columns of any name don't matter.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from skysift.llm.support import materialize
from skysift.stored import new_folder

#: Virtual slots; the map has one row for each, so its size never depends on the data.
SLOTS = 8192
#: Bytes that a row counts besides its text.
ROW_BYTES = 8


@dataclass(frozen=True)
class SlotMap:
    """One version of the slot-to-shard map with the totals it was made from."""

    version: int
    shards: int
    shard_of: list[int]
    bytes_of: list[int]
    rows_of: list[int]
    moved: list[int] = field(default_factory=list)

    def loads(self) -> list[int]:
        out = [0] * self.shards
        for slot, shard in enumerate(self.shard_of):
            out[shard] += self.bytes_of[slot]
        return out

    def frame(self, spark: SparkSession) -> DataFrame:
        """The map as a table: version, shards, slot, shard, the slot's bytes and rows, and base, the rows of its shard in lower slots."""
        base, filled = [], [0] * self.shards
        for slot, shard in enumerate(self.shard_of):
            base.append(filled[shard])
            filled[shard] += self.rows_of[slot]
        at = F.col("id").cast("int") + 1
        pick = lambda values, kind: F.element_at(F.split(F.lit(",".join(map(str, values))), ","), at).cast(kind)
        return spark.range(0, len(self.shard_of), 1, 1).select(
            F.lit(self.version).alias("version"),
            F.lit(self.shards).alias("shards"),
            F.col("id").cast("int").alias("virtual_slot"),
            pick(self.shard_of, "int").alias("shard"),
            pick(base, "bigint").alias("base"),
            pick(self.bytes_of, "bigint").alias("bytes"),
            pick(self.rows_of, "bigint").alias("rows"),
        )


_MAP = "version int, shards int, virtual_slot int, shard int, base bigint, bytes bigint, rows bigint"


def store_map(spark: SparkSession, made: SlotMap, folder: str) -> None:
    """Add a version to the folder; one that is there already is an error."""
    made.frame(spark).write.mode("errorifexists").parquet(f"{folder}/v{made.version:06d}")


def stored_map(spark: SparkSession, folder: str, version: int | None = None) -> DataFrame:
    """The rows of a version, or of the latest one; one row a slot."""
    versions = spark.read.schema(_MAP).option("recursiveFileLookup", "true").parquet(folder)
    latest = version if version is not None else versions.agg(F.max("version")).first()[0]
    return versions.where(F.col("version") == latest)


def load_map(spark: SparkSession, folder: str, version: int | None = None) -> SlotMap:
    """A stored version; a fixed number of rows."""
    rows = stored_map(spark, folder, version).orderBy("virtual_slot").collect()
    return SlotMap(rows[0].version, rows[0].shards, [r.shard for r in rows], [r.bytes for r in rows], [r.rows for r in rows])


def slot_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", slots: int = SLOTS) -> DataFrame:
    """id, size, text_crc32 and virtual_slot of each row."""
    body = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(
        F.col(id_col).alias("doc_id"),
        (F.octet_length(body) + ROW_BYTES).cast("bigint").alias("size"),
        F.crc32(body.cast("binary")).alias("text_crc32"),
    ).withColumn("virtual_slot", F.pmod(F.xxhash64("doc_id", "text_crc32"), F.lit(slots)).cast("int"))


def totals(rows: DataFrame, slots: int = SLOTS) -> tuple[list[int], list[int]]:
    """Bytes and rows of each slot. The driver gets one row for each slot (a fixed number), whatever the table's size."""
    bytes_of, rows_of = [0] * slots, [0] * slots
    for r in rows.groupBy("virtual_slot").agg(F.sum("size").alias("b"), F.count("*").alias("n")).collect():
        bytes_of[r.virtual_slot], rows_of[r.virtual_slot] = r.b, r.n
    return bytes_of, rows_of


def plan_map(rows: DataFrame, shards: int, slots: int = SLOTS) -> SlotMap:
    """Version 1: the largest slot goes to the lightest shard, again and again."""
    bytes_of, rows_of = totals(rows, slots)
    shard_of = [0] * slots
    heap = [(0, 0, s) for s in range(shards)]
    for slot in sorted(range(slots), key=lambda s: (-bytes_of[s], s)):
        load, held, shard = heapq.heappop(heap)
        shard_of[slot] = shard
        heapq.heappush(heap, (load + bytes_of[slot], held + 1, shard))
    return SlotMap(1, shards, shard_of, bytes_of, rows_of)


def rebalance(old: SlotMap, shards: int | None = None) -> SlotMap:
    """The next version. Slots move from the heaviest shard to the lightest while that narrows the gap.

    With more shards than before, only the new ones receive; a slot that needn't move stays.
    """
    count = shards or old.shards
    shard_of, load = list(old.shard_of), [*old.loads(), *[0] * (count - old.shards)]
    inside: list[list[int]] = [[] for _ in range(count)]
    for slot in sorted(range(len(shard_of)), key=lambda s: old.bytes_of[s]):
        inside[shard_of[slot]].append(slot)
    takers = list(range(old.shards, count)) or list(range(count))
    moved: set[int] = set()
    while True:
        light, heavy = min(takers, key=lambda s: (load[s], s)), max(range(count), key=lambda s: (load[s], -s))
        gap = load[heavy] - load[light]
        fits = [s for s in inside[heavy] if 0 < 2 * old.bytes_of[s] <= gap and s not in moved]
        if not fits or heavy == light:
            break
        slot = fits[-1]
        inside[heavy].remove(slot)
        inside[light].append(slot)
        shard_of[slot] = light
        load[heavy] -= old.bytes_of[slot]
        load[light] += old.bytes_of[slot]
        moved.add(slot)
    return SlotMap(old.version + 1, count, shard_of, old.bytes_of, old.rows_of, sorted(moved))


def assign(rows: DataFrame, slot_map: DataFrame) -> DataFrame:
    """shard and position (gapless from 0 in each shard) of each row, by a stored version made from these rows' totals.

    Positions count within a virtual slot, so no task holds a shard; the map's base does the rest.
    The map has a fixed number of rows (SLOTS) and may be broadcast.
    """
    order = Window.partitionBy("virtual_slot").orderBy("doc_id", "size", "text_crc32")
    at = F.broadcast(slot_map.select("virtual_slot", "shard", "base", "version"))
    return (
        rows.withColumn("nth", F.row_number().over(order) - 1)
        .join(at, "virtual_slot")
        .select("doc_id", "size", "text_crc32", "shard", (F.col("base") + F.col("nth")).alias("position"), "virtual_slot", "version")
    )


def shard_by_bytes(docs: DataFrame, shards: int = 24, slots: int = SLOTS, folder: str | None = None) -> tuple[DataFrame, SlotMap]:
    """Rows with their shards, sizes near equal, by the map in the folder (by default a new one in the shared folder, which goes with the process).

    Where the folder has no map, version 1 is planned. A map that is there is loaded; it gets the slots' new totals and
    the wanted number of shards, slots move where that evens out the sizes, and the outcome is the next version.
    """
    spark = docs.sparkSession
    rows = materialize(slot_rows(docs, slots=slots), "slot-rows")
    known = folder is not None and _exists(spark, folder)
    folder = folder or new_folder(spark, "tables/slot-map")
    if known:
        old = load_map(spark, folder)
        bytes_of, rows_of = totals(rows, len(old.shard_of))
        made = rebalance(SlotMap(old.version, old.shards, old.shard_of, bytes_of, rows_of), max(shards, old.shards))
    else:
        store_map(spark, plan_map(rows, shards, slots), folder)
        made = rebalance(load_map(spark, folder))
    if known or made.moved:
        store_map(spark, made, folder)
    return assign(rows, stored_map(spark, folder)), load_map(spark, folder)


def _exists(spark: SparkSession, folder: str) -> bool:
    where = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)
