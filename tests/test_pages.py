"""The page buffer: each page once through restarts, failures and repeated batches."""

import os
import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

from skysift.sources import pages
from skysift.streaming import runs


class Row:
    def __init__(self, data, last=False, mjd=60000.5, sb=3, dec=0.25):
        self.data, self.last, self.mjd, self.sb, self.dec = data, last, mjd, sb, dec


def add(folder, *data, batch=0, writer="w", last=False, page_bytes=16):
    return pages.publish(folder, [pages.write_frames(folder, [Row(d, last) for d in part], page_bytes) for part in data], page_bytes, writer, batch)


def read(spark, folder, **options):
    spark.dataSource.register(pages.PageSource)
    return spark.read.format("pages").options(path=folder, **options).load()


def test_ranges_short_pages_and_the_end(spark, tmp_path):
    at = str(tmp_path)
    add(at, [b"a" * 16, b"b"], [], [b""], batch=0)
    add(at, [bytes([n]) for n in range(5)], batch=1, last=True)
    rows = read(spark, at, pages_per_task="2").orderBy("page").collect()
    assert [bytes(r.data) for r in rows] == [b"a" * 16, b"b", b"", *[bytes([n]) for n in range(5)]]
    assert [r.page for r in rows] == list(range(8)) and [r.last for r in rows] == [False] * 3 + [True] * 5
    assert {(r.mjd, r.sb, r.dec) for r in rows} == {(60000.5, 3, 0.25)}
    parts = pages._parts(at, 1, 7, 2)
    assert [(p.page, p.count) for p in parts] == [(1, 1), (2, 1), (3, 2), (5, 2)]


def test_a_repeated_batch_adds_nothing(tmp_path):
    at = str(tmp_path)
    assert add(at, [b"x"], batch=0) and add(at, [b"y"], batch=1)
    assert not add(at, [b"y"], batch=1) and not add(at, [b"x"], batch=0)
    assert add(at, [b"z"], batch=0, writer="other")
    assert [c.first for c in pages.commits(at)] == [0, 1, 2] and len(os.listdir(f"{at}/data")) == 3


def test_a_failed_task_leaves_no_page(spark, tmp_path):
    """One row is too long for a page: the batch fails, and neither pages nor files of the other tasks are left."""
    spark.dataSource.register(pages.PageSource)
    rows = spark.range(6).select(F.lit(1.0).alias("mjd"), F.col("id").cast("int").alias("sb"), F.lit(0.0).alias("dec"), F.lit(False).alias("last"), F.expr("cast(repeat('x', if(id = 5, 40, 4)) as binary)").alias("data"))
    with pytest.raises(Exception, match="more than a page"):
        rows.repartition(3).write.format("pages").mode("append").options(path=str(tmp_path), page_bytes="8").save()
    assert pages.commits(str(tmp_path)) == [] and read(spark, str(tmp_path)).count() == 0
    rows.where("sb < 5").write.format("pages").mode("append").options(path=str(tmp_path), page_bytes="8").save()
    assert sorted(r.sb for r in read(spark, str(tmp_path)).collect()) == list(range(5))


def test_a_restarted_reader_takes_each_page_once(spark, tmp_path):
    """Pages come between runs of the query, and the buffer is cleared behind it."""
    at, base = f"{tmp_path}/buffer", f"{tmp_path}/query"
    spark.dataSource.register(pages.PageSource)
    for batch in range(3):
        add(at, [bytes([batch, n]) for n in range(4)], batch=batch)
        stream = spark.readStream.format("pages").options(path=at, clear="true", pages_per_task="3").load()
        runs._run(stream, "append", base)
    got = spark.read.parquet(f"{base}/out").orderBy("page").collect()
    assert [(r.page, bytes(r.data)) for r in got] == [(4 * b + n, bytes([b, n])) for b in range(3) for n in range(4)]
    assert len(pages.commits(at)) < 3 and pages.commits(at)[-1].until == 12


def test_a_stream_that_failed_goes_on_without_doubles(spark, tmp_path):
    """The sink fails in its second batch, once; after a restart every page is there once."""
    spark.dataSource.register(pages.PageSource)
    at, schema = str(tmp_path), "mjd double, sb int, dec double, last boolean, data binary"
    for n in range(2):
        spark.createDataFrame([(1.0, 10 * n + k, 0.0, False, b"x" * (4 + 30 * n * (k == 1))) for k in range(3)], schema).coalesce(1).write.mode("append").parquet(f"{at}/in")

    def run(page_bytes):
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{at}/in")
        stream.writeStream.format("pages").options(path=f"{at}/buffer", page_bytes=page_bytes).option("checkpointLocation", f"{at}/state").trigger(availableNow=True).start().awaitTermination()

    with pytest.raises(Exception, match="page"):
        run("8")
    run("64")
    run("64")
    rows = read(spark, f"{at}/buffer").collect()
    assert sorted(r.sb for r in rows) == [0, 1, 2, 10, 11, 12] and sorted(r.page for r in rows) == list(range(6))


def test_visibilities_of_whole_samples(spark, tmp_path):
    at = str(tmp_path)
    block = (np.arange(24) + 1j * np.arange(24)[::-1]).astype("<c8").reshape(4, 3, 2, 1)
    block[1, 1, 1, 0] = np.nan
    add(at, [block.tobytes(), block.tobytes()[: 8 * 6 * 2 + 11]], page_bytes=8 * 24)
    rows = pages.visibilities(read(spark, at), 4, 3, 2, 1).collect()
    assert len(rows) == 24 + 12 and {r.t for r in rows if r.gulp == 1} == {4, 5}
    for r in rows:
        want = block[r.t % 4, r.bl, r.chan, r.pol]
        assert (r.re, r.im) == ((None, None) if np.isnan(want) else (want.real, want.imag))


def test_image_messages(spark, tmp_path):
    at = str(tmp_path)
    head = [7, 60000.25, 12.5, -3.5, 8080, 1, 2, 2]
    add(at, [struct.pack("<12d", *head, 1.5, float("nan"), 3, 4), struct.pack("<10d", *head, 1, 2), b"\0" * 24], page_bytes=128)
    rows = pages.images(read(spark, at)).orderBy("page").collect()
    assert [r.status for r in rows] == [0, 2, 1] and rows[0]["values"] == [1.5, None, 3, 4] and rows[1]["values"] is None
    assert tuple(rows[0])[1:7] == (7, 60000.25, 12.5, -3.5, 8080, [1, 2, 2])
    back = pages.image_pages(pages.images(read(spark, at)).where("status = 0").withColumn("last", F.lit(True))).first()
    assert bytes(back.data) == struct.pack("<12d", *head, 1.5, float("nan"), 3, 4) and back.last
