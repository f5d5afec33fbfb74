"""Sinks: partitioned tables, candidate levels, trigger records, ledgers and keyed upserts."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skysift import schemas


def write_visibilities(df: DataFrame, path: str) -> None:
    """Parquet by day and sub-band, as later scans ask for them."""
    df.withColumn("day", F.floor("mjd").cast("int")).write.mode("append").partitionBy("day", "sb").parquet(path)


def write_candidates(df: DataFrame, path: str, level: str) -> None:
    """Candidate files of one level (raw, classified, final) with their fixed header; columns that are all absent stay out."""
    cols = [F.col(name).alias(head) for head, name in schemas.CANDIDATE_NAMES.items() if name in df.columns]
    df.select(*cols).write.mode("overwrite").csv(f"{path}/level={level}", header=True)


def trigger_json(df: DataFrame, start_mjd: float, sample_s: float) -> DataFrame:
    """Trigger records (mjds, isot, snr, width, dm, ra, dec, trigname, period) as JSON text; -1 stands for what isn't known."""
    spec = F.floor((F.col("mjds") - start_mjd) * 86400 / sample_s).cast("bigint")
    known: dict[str, Column] = {"ibox": F.ceil("width").cast("int"), "ibeam": F.lit(-1), "cntb": F.lit(-1), "cntc": F.lit(-1), "specnum": spec, "itime": spec, "period": F.coalesce("period", F.lit(-1.0))}
    fields = [f.split()[0] for f in schemas.TRIGGER.split(", ")]
    return df.select("trigname", F.to_json(F.struct(*[known.get(f, F.col(f)).alias(f) for f in fields])).alias("record"))


def packed_baselines(df: DataFrame) -> DataFrame:
    """(name, block, content): u, v, w and length as little-endian doubles and the antenna numbers as bytes, in the order of
    (ant1, ant2). A block has 4096 baselines, so a file is its blocks of one name strung together in order."""
    order = Window.orderBy("ant1", "ant2")  # pairs of a few hundred antennas
    numbered = df.withColumn("length", F.hypot("u", "v")).withColumn("__n", F.row_number().over(order) - 1)
    formats = {"u": "<f8", "v": "<f8", "w": "<f8", "length": "<f8", "ant1": "u1", "ant2": "u1"}

    def pack(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("__n")
        return pd.DataFrame({"name": list(formats), "block": int(rows["__n"].iloc[0]) // 4096, "content": [rows[c].to_numpy().astype(f).tobytes() for c, f in formats.items()]})

    return numbered.select("__n", *formats).groupBy(F.floor(F.col("__n") / 4096)).applyInPandas(pack, "name string, block int, content binary")


def append_ledger(df: DataFrame, path: str, schema: str) -> None:
    names = [f.split()[0] for f in schema.split(", ")]
    df.select(*names).write.mode("append").parquet(path)


def upsert(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """old without the keys of new, and new: the merge of a calibration table."""
    return old.join(new.select(*keys).distinct(), keys, "left_anti").unionByName(new.select(*old.columns))


def exclude(df: DataFrame, table: DataFrame, name: str = "name", mjd: str = "mjd") -> DataFrame:
    """Rows that no exclusion (name or ALL, mjd) names."""
    every = table.where(F.upper(F.col(name)) == "ALL").select(mjd).distinct()
    some = table.where(F.upper(F.col(name)) != "ALL").select(name, mjd).distinct()
    return df.join(every, mjd, "left_anti").join(some, [name, mjd], "left_anti")


def retained(df: DataFrame, time: str, cutoff: Column, keep: DataFrame, key: str) -> DataFrame:
    """What a clean-up leaves: rows from the cutoff on, and those on the keep list."""
    return df.where(F.col(time) >= cutoff).unionByName(df.where(F.col(time) < cutoff).join(keep.select(key).distinct(), key, "left_semi"))
