"""Sources, sinks, imaging and record operators."""

import struct
import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from skysift import sinks
from skysift.operators import candidates, gridding, imaging, joins, learned
from skysift.plans import search as plans
from skysift.plans import simulate
from skysift.sources import fits, packets, tables, visibility


def test_visibility_source(spark, tmp_path):
    r = np.random.default_rng(1)
    data = {sb: (r.normal(size=(6, 3, 2, 2)) + 1j * r.normal(size=(6, 3, 2, 2))).astype("<c8") for sb in range(3)}
    data[1][0, 0, 0, 0] = np.nan
    for sb, x in data.items():
        (tmp_path / f"sb{sb:02d}.vis").write_bytes(visibility.encode(60000.5, sb, 16.25, x))
    spark.dataSource.register(visibility.VisibilitySource)
    options = {"nsamps": 2, "nbase": 3, "nchan": 2, "npol": 2}
    df = spark.read.format("visibility").options(**options).load(f"{tmp_path}/*.vis")
    assert df.rdd.getNumPartitions() == 9
    rows = df.collect()
    assert len(rows) == 3 * 6 * 3 * 2 * 2 and {x.mjd for x in rows} == {60000.5}
    for x in rows:
        want = data[x.sb][x.t, x.bl, x.chan, x.pol]
        assert (x.re is None and np.isnan(want)) or (x.re, x.im) == (pytest.approx(want.real), pytest.approx(want.imag))
    heads = spark.read.format("visibility").options(header="true", **options).load(f"{tmp_path}/*.vis")
    assert sorted((h.sb, h.gulps) for h in heads.collect()) == [(0, 3), (1, 3), (2, 3)]
    assert visibility.complete_files(heads, 3).count() == 1 and visibility.complete_files(heads, 4).count() == 0
    assert visibility.read_blocks(spark, str(tmp_path), 2, 3, 2, 2).exceptAll(df.withColumn("file", F.concat(F.lit("file:"), "file"))).count() == 0
    sinks.write_visibilities(df, f"{tmp_path}/table")
    assert spark.read.parquet(f"{tmp_path}/table").where("sb = 1").count() == 72


def test_text_tables(spark, tmp_path):
    (tmp_path / "cands.csv").write_text("candname,RA index,DEC index,WIDTH index,DM index,SNR\na,1,2,0,3,9.5\nb,4.0,5,1,0,7\n")
    got = tables.candidates(spark, f"{tmp_path}/cands.csv").orderBy("candname").collect()
    assert (got[0].ra_idx, got[0].snr, got[0].toa, got[1].ra_idx) == (1, 9.5, None, 4)
    (tmp_path / "ants.csv").write_text("p\n" * 5 + ",Station,Lat,Lon,Elev\n,1,37.1,-118.1,10\n,2,37.2,-118.2,\n,3,37.3,-118.3\n")
    assert [(a.station, a.elevation) for a in tables.antennas(spark, f"{tmp_path}/ants.csv", ["2"]).orderBy("station").collect()] == [("1", 10.0), ("3", 0.0)]
    (tmp_path / "psr.csv").write_text("1;J0000+00;12:00:00;-01:30:00;0.5;*;26.7;*;3;1.2\n")
    p = tables.pulsars(spark, f"{tmp_path}/psr.csv").first()
    assert (p.ra, p.dec, p.period_dot, p.dm) == (180.0, -1.5, None, 26.7)
    (tmp_path / "rfc.txt").write_text("# head\nX A 1.5 -9.99\nX B  2.5 0.25\n")
    t = tables.columns_text(spark, f"{tmp_path}/rfc.txt", [("name", 1, "string"), ("a", 2, "double"), ("b", 3, "double")]).orderBy("name").collect()
    assert [(x.name, x.a, x.b) for x in t] == [("A", 1.5, None), ("B", 2.5, 0.25)]
    (tmp_path / "cal.json").write_text(json.dumps({"3C1": {"ra": 1, "dec": 2, "flux": 3}}))
    assert tables.calibrators(spark, f"{tmp_path}/cal.json").first().flux == 3.0
    (tmp_path / "flags.csv").write_text("name,binary\nA,Y\nB,n\nC,?\n")
    assert [r.binary for r in tables.flagged_catalog(spark, f"{tmp_path}/flags.csv", "name string, binary string", ["binary"]).orderBy("name").collect()] == [True, False, None]
    (tmp_path / "psf_41_16.5.npy").write_bytes(b"x")
    assert tables.by_file_name(spark, f"{tmp_path}/psf*", r"psf_(\d+)_([\d.]+)\.npy", ["size", "dec"]).first()["dec"] == "16.5"


def test_packets(spark):
    body = np.array([1.0, np.nan, 3.0]).tobytes()
    head = b"PUT / HTTP/1.1\r\nisot: 2024-01-01T00:00:00; uv_diag: 12.5; dec: 16.1; node: 3\r\nx 'shape': (3,)"
    rows = [(1, head + b"\r\n\r\n" + body), (2, head), (3, head + b"\r\n\r\n" + body[:8]), (4, None)]
    got = {r.k: r for r in packets.parse(spark.createDataFrame(rows, "k bigint, packet binary")).collect()}
    assert (got[1].node, got[1].dec, got[1].shape, got[1].status) == (3, 16.1, [3], 0)
    assert (got[2].status, got[3].status, got[4].status) == (1, 2, 1)
    values = packets.decode_doubles(packets.parse(spark.createDataFrame(rows, "k bigint, packet binary")), "k").where("k = 1").first()
    assert values["values"] == [1.0, None, 3.0]
    parts = [("m", 1, 2, b"b"), ("m", 0, 2, b"a"), ("m", 0, 2, b"a"), ("n", 0, 2, b"z")]
    joined = packets.join_chunks(spark.createDataFrame(parts, "msg string, chunk_no int, expected int, bytes binary"), "msg").collect()
    assert [(r.msg, bytes(r.bytes)) for r in joined] == [("m", b"ab")]


def test_sinks(spark, tmp_path):
    c = spark.createDataFrame([("a", 1, 2, 0, 3, 9.5)], "candname string, ra_idx int, dec_idx int, wid_idx int, dm_idx int, snr double")
    sinks.write_candidates(c, str(tmp_path), "raw")
    assert tables.candidates(spark, f"{tmp_path}/level=raw").first().snr == 9.5
    t = spark.createDataFrame([(60310.5, "2024-01-01T12:00:00", 9.0, 3.2, 100.0, 1.0, 2.0, "t1", None)], "mjds double, isot string, snr double, width double, dm double, ra double, dec double, trigname string, period double")
    record = json.loads(sinks.trigger_json(t, 60310.0, 10.0).first().record)
    assert (record["specnum"], record["ibox"], record["period"], record["ibeam"]) == (4320, 4, -1.0, -1)
    old = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    assert sorted(sinks.upsert(old, spark.createDataFrame([("b", 9)], "k string, v int"), ["k"]).collect()) == [("a", 1), ("b", 9)]
    table = spark.createDataFrame([("ALL", 1.0), ("x", 2.0)], "name string, mjd double")
    rows = spark.createDataFrame([("x", 1.0), ("x", 2.0), ("y", 2.0)], "name string, mjd double")
    assert [tuple(r)[:2] for r in sinks.exclude(rows, table).select("name", "mjd").collect()] == [("y", 2.0)]
    kept = sinks.retained(spark.createDataFrame([(1, 5), (2, 1), (3, 1)], "id int, at int"), "at", F.lit(3), spark.createDataFrame([(3,)], "id int"), "id")
    assert sorted(r.id for r in kept.collect()) == [1, 3]


def test_imaging(spark):
    ones = spark.range(64).select(F.lit(0).alias("k"), (F.col("id") % 8).cast("int").alias("i"), F.floor(F.col("id") / 8).cast("int").alias("j"), F.lit(1.0).alias("re"), F.lit(0.0).alias("im"))
    image = imaging.dirty_image(ones, ["k"], 8)
    peak = image.orderBy(F.desc("value")).first()
    assert (peak.y, peak.x) == (4, 4) and peak.value > 10 * abs(image.agg(F.avg("value")).first()[0])
    spot = imaging.dirty_image(ones.where("i = 4 and j = 4"), ["k"], 8).agg(F.stddev_pop("value"), F.avg("value")).first()
    assert spot[0] == pytest.approx(0) and spot[1] == pytest.approx(1 / 64)
    back = imaging.to_cells(image, ["k"], 8).join(ones, ["k", "i", "j"]).count()
    assert back == 64
    uv = spark.createDataFrame([(10, 15), (20, 25), (20, 25), (30, 35)], "i int, j int").withColumns({"re": F.lit(1.0), "im": F.lit(0.0)})
    w = [r.weight for r in gridding.briggs(uv, "i", "j", 0.5).collect()]
    assert min(w) > 0 and sum(w) == pytest.approx(1)


def test_density_and_networks(spark):
    r = np.random.default_rng(2)
    points = np.concatenate([r.normal(0, 0.1, (20, 2)), r.normal(5, 0.1, (20, 2)), [[2.5, 2.5]]])
    labels = learned.density_labels(points, 0.5, 4)
    assert len(set(labels[:20])) == 1 and len(set(labels[20:40])) == 1 and labels[0] != labels[20] and labels[40] == -1
    x, w, b = r.normal(size=(2, 1, 5, 5)), r.normal(size=(3, 1, 2, 2)), r.normal(size=3)
    y = learned.convolve(x, w, b)
    assert y.shape == (2, 3, 4, 4) and y[1, 2, 3, 0] == pytest.approx((x[1, 0, 3:5, 0:2] * w[2, 0]).sum() + b[2])
    cut = spark.createDataFrame([(1, [0.0] * 16), (2, [float(k) for k in range(16)])], "cand_id bigint, pixels array<double>")
    out = learned.classify(cut, (1, 4, 4), [(w, b)], (r.normal(size=3), 0.0)).collect()
    assert all(0 <= o.prob <= 1 and o.predict in (0, 1) for o in out)


def test_clustered_fakes(spark):
    fakes = simulate.fake_candidates(spark, 4, 10.0).withColumn("gulp", F.lit(0))
    found = plans.clustered(plans.candidates(fakes, 9.0), "gulp", 1.5, 3)
    assert found.count() == fakes.where("snr >= 9").count()
    again = simulate.fake_candidates(spark, 4, 10.0).agg(F.sum("snr")).first()[0]
    assert again == pytest.approx(fakes.agg(F.sum("snr")).first()[0])


def test_joins_at_the_edges(spark):
    left = spark.createDataFrame([(1, 9.9), (2, 10.0), (3, 13.355455), (4, 13.355456), (5, None)], "id bigint, x double")
    right = spark.createDataFrame([(10.0, "a")], "y double, name string")
    assert sorted(r.id for r in joins.within(left, right, "x", "y", 0.0, 3.355455, "left_semi").collect()) == [2, 3]
    assert sorted((r.id, r.y) for r in joins.backward(left.where("x is not null"), right, "x", "y", ["name"]).collect()) == [(1, None), (2, None), (3, 10.0), (4, 10.0)]
    assert sorted((r.id, r.y) for r in joins.backward(left.where("x is not null"), right, "x", "y", ["name"], strict=False).collect())[1] == (2, 10.0)
    near = joins.nearest(left.where("x is not null"), right, "x", "y", 0.2, "id", ["name"], how="left")
    assert sorted((r.id, r.name) for r in near.collect()) == [(1, "a"), (2, "a"), (3, None), (4, None)]
    c = spark.createDataFrame([(1, 5.0, 3, 4), (1, 7.0, 5, 4)], "g int, snr double, ra_idx int, dec_idx int")
    m = candidates.centroids(c, ["g"], ["ra_idx", "dec_idx"]).first()
    assert m.ra_idx_mean == pytest.approx(50 / 12) and m.ra_idx_peak == 5


# predicates pushed into the visibility source, and raw files written by tasks


def test_scan_leaves_out_what_headers_rule_out(spark, tmp_path):
    x = (np.arange(48) + 1j).astype("<c8").reshape(12, 2, 2, 1)
    for day in range(3):
        for sb in range(4):
            (tmp_path / f"{day}_{sb}.vis").write_bytes(visibility.encode(60000.5 + day, sb, 16.25, x))
    rows = visibility.scan(spark, f"{tmp_path}/*.vis", 3, 2, 2, 1)
    assert rows.rdd.getNumPartitions() == 48
    cases = {
        "mjd >= 60001.5": 32, "sb in (1, 2)": 24, "gulp = 2": 12, "gulp > 1 and sb = 3 and mjd < 60002": 4, "t between 4 and 5": 12, "t < 3 and dec = 16.25": 12,
        "t = 7 and mjd = 60000.5": 4, "dec > 20": 1, "sb + 1 = 2": 48, "sb = 1 or t = 2": 48, "re > 5": 48, "sb is not null": 48, "mjd <= 60000.5 and re > 5": 16,
    }
    every = spark.createDataFrame(rows.collect(), rows.schema)
    for where, partitions in cases.items():
        found = rows.where(where)
        assert found.rdd.getNumPartitions() == partitions, where
        assert sorted(found.collect()) == sorted(every.where(where).collect()), where
    heads = visibility.scan(spark, f"{tmp_path}/*.vis", 3, 2, 2, 1, header=True).where("sb = 1 and mjd > 60001")
    assert heads.rdd.getNumPartitions() == 2 and [r.gulps for r in heads.collect()] == [4, 4]
    assert visibility.scan(spark, f"{tmp_path}/none*.vis", 3, 2, 2, 1).count() == 0


def test_raw_files_written_by_tasks(spark, tmp_path):
    """Missing samples and a missing gulp are NaN in the file and null when read; a file written twice is there once."""
    rows = [(60000.0 + m, s, 1.5, t, b, 0, 0, float(t), float(b)) for m in range(2) for s in range(2) for t in (0, 1, 3, 9, 10) for b in range(2) if (t, b) != (3, 1)]
    df = spark.createDataFrame(rows, "mjd double, sb int, dec double, t int, bl int, chan int, pol int, re double, im double").repartition(5)
    for _ in range(2):
        files = visibility.write(df, str(tmp_path), 4, 2, 1, 1).collect()
    assert len(files) == 4 and {r.gulps for r in files} == {3} and len(list(tmp_path.iterdir())) == 4
    back = visibility.scan(spark, f"{tmp_path}/*.vis", 4, 2, 1, 1)
    assert back.count() == 4 * 24
    assert sorted(tuple(r) for r in back.where("re is not null").select("mjd", "sb", "dec", "t", "bl", "chan", "pol", "re", "im").collect()) == sorted(rows)


# FITS tables


def fits_file(path, columns, rows, extra=b""):
    """A file with an image of one block, and a table whose rows are given as bytes."""
    image = fits.header([("SIMPLE", True), ("BITPIX", -32), ("NAXIS", 2), ("NAXIS1", 3), ("NAXIS2", 2)]) + struct.pack(">6f", *range(6)).ljust(2880, b"\0")
    cards = [("XTENSION", "BINTABLE"), ("BITPIX", 8), ("NAXIS", 2), ("NAXIS1", len(rows[0])), ("NAXIS2", len(rows)), ("PCOUNT", 0), ("GCOUNT", 1), ("TFIELDS", len(columns))]
    for n, c in enumerate(columns, 1):
        cards += [(f"{k}{n}", v) for k, v in c.items()]
    data = b"".join(rows)
    path.write_bytes(image + fits.header(cards) + data.ljust(fits._padded(len(data)), b"\0") + extra)


def test_fits_columns(spark, tmp_path):
    columns = [
        {"TTYPE": "name", "TFORM": "6A"}, {"TTYPE": "skip", "TFORM": "0J"}, {"TTYPE": "flux", "TFORM": "E"}, {"TTYPE": "n", "TFORM": "1I", "TNULL": -9}, {"TTYPE": "pos", "TFORM": "2D"},
        {"TTYPE": "scaled", "TFORM": "J", "TSCAL": 0.5, "TZERO": 10}, {"TTYPE": "ok", "TFORM": "L"}, {"TTYPE": "b", "TFORM": "B"}, {"TTYPE": "SCode", "TFORM": "A"}, {"TTYPE": "big", "TFORM": "K"},
    ]
    rows = [struct.pack(">6sfh2di1sB1sq", f"s{k}".encode() + b" \0x", k / 4 if k % 3 else float("nan"), -9 if k == 5 else k, k, -k, k, b"TF\0"[k % 3 : k % 3 + 1], k % 200, b"SM"[k % 2 : k % 2 + 1], k << 40) for k in range(25_000)]
    for n in range(2):
        fits_file(tmp_path / f"{n}.fits", columns, rows)
    df = fits.scan(spark, f"{tmp_path}/*.fits", rows_per_task=10_000)
    assert df.rdd.getNumPartitions() == 6 and df.count() == 50_000
    assert df.dtypes == [("name", "string"), ("flux", "float"), ("n", "smallint"), ("pos", "array<double>"), ("scaled", "double"), ("ok", "boolean"), ("b", "smallint"), ("SCode", "string"), ("big", "bigint")]
    got = {r.big >> 40: r for r in df.collect()}
    assert tuple(got[4]) == ("s4", 1.0, 4, [4.0, -4.0], 12.0, False, 4, "S", 4 << 40) and got[3].flux is None and got[5].n is None and got[2].ok is None and got[24_999].SCode == "M"
    few = fits.scan(spark, f"{tmp_path}/*.fits", ["SCode", "flux"])
    assert few.columns == ["SCode", "flux"] and few.where("SCode = 'S'").count() == 25_000


def test_fits_written_and_read(spark, tmp_path):
    rows = [(n, None if n % 5 == 0 else n / 3, "it's é" if n % 2 else None, n % 2 == 0 if n % 3 else None, None if n % 7 == 0 else n) for n in range(1000)]
    df = spark.createDataFrame(rows, "id bigint, x double, name string, flag boolean, k int").repartition(3)
    assert sum(r.rows for r in fits.write(df, str(tmp_path), {"name": 8}).collect()) == 1000
    back = fits.scan(spark, f"{tmp_path}/*.fits", rows_per_task=100)
    assert back.schema == df.schema and sorted(map(tuple, back.collect()), key=lambda r: r[0]) == [(a, b, c or "", d, e) for a, b, c, d, e in rows]
    with pytest.raises(Exception, match="longer than"):
        fits.write(df, str(tmp_path / "other"), {"name": 3}).collect()


def test_fits_headers():
    assert fits.parse_cards(fits.header([("A", 1), ("B", "it's"), ("C", True), ("D", -1.5), ("A", 2)])) == {"A": 1, "B": "it's", "C": True, "D": -1.5}
    assert fits.parse_cards(b"X       = 1.5D3 / comment".ljust(80) + b"COMMENT x".ljust(80) + b"Y       = 'a / b'  / text".ljust(80) + b"END".ljust(80)) == {"X": 1500.0, "Y": "a / b"}


def test_missing_chunks_are_nan(spark):
    """Doubles count once, chunks of another length or number don't count, a message without any whole chunk is all NaN."""
    two = lambda a, b: struct.pack("<2d", a, b)
    rows = [("a", 0, 3, two(1, 2)), ("a", 2, 3, two(5, 6)), ("a", 2, 3, two(5, 6)), ("b", 1, 2, b"short"), ("b", 7, 2, two(9, 9)), ("c", 0, 1, two(7, 8))]
    out = packets.fill_chunks(spark.createDataFrame(rows, "k string, chunk_no int, expected int, bytes binary"), "k", 16)
    got = {r.k: (r["values"], None) for r in packets.decode_doubles(out, "k", "bytes").collect()}
    assert {k: v[0] for k, v in got.items()} == {"a": [1, 2, None, None, 5, 6], "b": [None] * 4, "c": [7, 8]}
    assert {r.k: r.missing for r in out.collect()} == {"a": [1], "b": [0, 1], "c": []}
    coded = packets.encode_doubles(spark.createDataFrame([("x", [1.5, None])], "k string, v array<double>"), ["k"], "v").first()
    assert bytes(coded.bytes) == struct.pack("<2d", 1.5, float("nan"))


def test_direct_transform_refuses_many_targets(spark):
    rows = spark.createDataFrame([(0, 1.0, 0.0, 1.0, 1.0)], "k int, re double, im double, u double, v double")
    many = spark.range(gridding.TARGETS + 1).select(F.col("id").alias("target"), F.lit(0.0).alias("l"), F.lit(0.0).alias("m"))
    with pytest.raises(ValueError, match="targets"):
        gridding.direct_transform(rows, many, ["k"])


def test_fits_images(spark, tmp_path):
    """Images of several shapes in one file, scaled whole numbers with blanks, and tables between them."""
    rows = [("a", [2, 3], [1.0, None, 3.0, 4.0, 5.0, 6.0]), ("b", [2, 1, 2], [0.5] * 4), ("c", [1], [9.0])]
    df = spark.createDataFrame(rows, "name string, shape array<int>, values array<double>").coalesce(1)
    assert [(r.images) for r in fits.write_images(df, str(tmp_path)).collect()] == [3]
    assert sorted(tuple(r) for r in fits.images(spark, f"{tmp_path}/*.fits").collect()) == rows
    scaled = fits.header([("SIMPLE", True), ("BITPIX", 16), ("NAXIS", 1), ("NAXIS1", 3), ("BSCALE", 0.5), ("BZERO", 10), ("BLANK", -1)]) + struct.pack(">3h", 2, -1, 4).ljust(2880, b"\0")
    (tmp_path / "i.fit").write_bytes(scaled)
    assert fits.images(spark, f"{tmp_path}/*.fit").first()["values"] == [11.0, None, 12.0]
    fits_file(tmp_path / "t.fts", [{"TTYPE": "k", "TFORM": "K"}], [struct.pack(">q", 1)])
    assert [r["values"] for r in fits.images(spark, f"{tmp_path}/*.fts").collect()] == [[0, 1, 2, 3, 4, 5]]
    with pytest.raises(Exception, match="values for shape"):
        fits.write_images(spark.createDataFrame([("x", [3], [1.0])], df.schema), str(tmp_path / "bad")).collect()
    assert fits.images(spark, f"{tmp_path}/none*").count() == 0
