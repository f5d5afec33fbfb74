"""Queries that read every row, against plain loops over the same tables."""

import os

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from skysift.operators import joins, learned, planning
from skysift.streaming import runs

FOLDER = os.environ.get("SKYSIFT_TEST_DATA", "/root/testdata/sf0.001")
needs_tables = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


def read(name):
    return pd.read_parquet(f"{FOLDER}/{name}.parquet")


@needs_tables
def test_joins_see_every_file(spark):
    got = lambda name: entry.queries()[name](spark, FOLDER).toPandas()
    keys = read("orders")["o_orderkey"].to_numpy()
    y = (keys * 7919 % 2592000).astype(float)
    e = read("events")
    x = dict(zip(e["event_id"], (e["ts"] - pd.Timestamp("2024-01-01")) // pd.Timedelta("1us") / 1e6, strict=True))
    near, last, first, minute, n = {}, {}, {}, {}, {}
    for k, kind in zip(e["event_id"], e["event_type"], strict=True):
        d = x[k] - y
        if (hit := np.abs(d) <= 600).any():
            near[k] = min(zip(np.abs(d[hit]), keys[hit], strict=True))[1]
        last[k] = y[d > 0].max() if (d > 0).any() else None
        if (hit := (d >= 0) & (d <= 302)).any():
            first[k] = keys[hit].min()
        n[kind] = n.get(kind, 0) + int(((d >= -60) & (d <= 300)).any())
        step = x[k] // 60 - y // 60
        if ((step == 0) | (step == 1)).any():
            minute[k] = bool((step == 1).any())
    assert dict(got("asof_nearest_tol")[["event_id", "file"]].to_numpy(int).tolist()) == near
    assert {r.event_id: None if np.isnan(r.y) else r.y for r in got("asof_backward").itertuples()} == last
    assert dict(got("file_range_offset")[["event_id", "file"]].to_numpy(int).tolist()) == first
    assert {r.event_type: r.n for r in got("interval_exists").itertuples()} == n
    assert {r.event_id: r.postinjection for r in got("previous_gulp_match").itertuples()} == minute
    assert any(f % 10 for f in near.values()) and any(f % 10 for f in first.values())


def test_backward_over_many_partitions(spark):
    """Wide left rows and narrow right rows: read apart, they would be coalesced to different partitions."""
    conf = {"spark.sql.shuffle.partitions": "32", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256k", "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false"}
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        x = ((F.col("id") * 7919) % 200003).cast("double")
        left = spark.range(40000).select("id", x.alias("x"), F.concat(*[F.sha2((F.col("id") + k).cast("string"), 512) for k in range(4)]).alias("wide"))
        right = spark.range(40).select((F.col("id") * 5000 + 17).cast("double").alias("y"), F.col("id").alias("name"))
        got = joins.backward(left, right, "x", "y", ["name"]).select("id", "x", "y", "name").toPandas()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    number = np.floor((np.nextafter(got["x"], -np.inf) - 17) / 5000).clip(upper=39)
    want = number.where(number >= 0)
    assert len(got) == 40000 and got["name"].isna().equals(want.isna())
    assert (got["name"].dropna() == want.dropna()).all() and (got["y"].dropna() == want.dropna() * 5000 + 17).all()


def test_throttle_of_files_out_of_order(spark, tmp_path):
    """Files whose times overlap and go backward, ties, gaps of many buckets, and steps of just two hours."""
    rng = np.random.default_rng(3)
    hours = np.concatenate([rng.uniform(0, 60, 400), rng.uniform(200, 230, 60), np.arange(300, 330, 2.0), [300.0, 302.0, 500.0]])
    rows = pd.DataFrame({"event_id": np.arange(len(hours)), "event_type": rng.choice(["a", "b", "c"], len(hours)), "value": rng.uniform(40, 100, len(hours))})
    rows["ts"] = pd.Timestamp("2024-01-01") + pd.to_timedelta((hours * 3.6e9).round(), unit="us")
    rows["ts"] = rows["ts"].astype("datetime64[us]")
    (tmp_path / "events.parquet").mkdir()
    for k in range(5):
        rows.iloc[::-1].iloc[k::5].to_parquet(tmp_path / f"events.parquet/part-{k}.parquet")
    want, last = set(), {}
    for r in rows[rows["value"] > 60].sort_values(["ts", "event_id"]).itertuples():
        if r.event_type not in last or r.ts - last[r.event_type] >= pd.Timedelta("2h"):
            last[r.event_type] = r.ts
            want.add((r.event_type, r.event_id, r.ts.value // 1000))
    got = entry.queries()["stream_throttle"](spark, str(tmp_path)).collect()
    assert sorted(map(tuple, got)) == sorted(want)


def test_assembly_times_out_and_keeps_late_rows(spark):
    """Three parts an hour, closed an hour after its end: a full slot, one given up with its mask, one with a late part, one still open."""
    hour = 3_600_000_000
    # slot, part, value, id, arrival in minutes
    rows = [(0, 0, 1.0, 1, 5), (0, 1, 2.0, 2, 20), (0, 2, 4.0, 3, 70), (0, 2, 99.0, 4, 75), (1, 0, 8.0, 5, 61), (1, 2, 16.0, 6, 100), (1, 1, 32.0, 7, 185), (2, 1, 64.0, 8, 400), (9, 0, 1.0, 9, 500), (9, 1, 1.0, 10, 601)]
    events = spark.createDataFrame(rows, "slot bigint, part int, value double, id bigint, m bigint").select("slot", "part", "value", "id", F.timestamp_micros(F.col("m") * 60_000_000).alias("arrived"))
    minute = F.unix_micros("arrived") / 60_000_000
    slices = [minute < 65, (minute >= 65) & (minute < 150), (minute >= 150) & (minute < 450), minute >= 450]
    got = runs.feed(events, slices, lambda s: runs.assemble(s, 3, hour, hour)).collect()
    assert sorted(map(tuple, got)) == [(0, 0, 7.0, 70 * 60_000_000), (1, 2, 24.0, 3 * hour)]
    late = runs.feed(events, slices, lambda s: runs.late_rows(s, hour, hour)).collect()
    assert sorted((r.slot, r.id, r.late_by) for r in late) == [(1, 7, 5 * 60_000_000), (2, 8, 160 * 60_000_000)]


def test_triggers_are_published_once(spark, tmp_path):
    """Failures are tried again, what is in the ledger isn't sent again, and a lasting failure keeps its status."""
    log = tmp_path / "sent"

    def send(record):
        with open(log, "a") as out:
            out.write(f"{record['name']}\n")
        return 4 if record["name"] == "b" or (record["name"] == "c" and log.read_text().count("c") < 2) else 0

    for names in (["a", "b", "a"], ["a", "c"]):
        spark.createDataFrame([(n,) for n in names], "name string").coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        stream = spark.readStream.schema("name string").parquet(f"{tmp_path}/in")
        runs.publish(stream, "name", send, f"file://{tmp_path}/out").awaitTermination()
    rows = spark.read.parquet(f"{tmp_path}/out/ledger").collect()
    assert sorted((r.name, r.status, r.tries) for r in rows) == [("a", 0, 1), ("b", 4, 3), ("c", 0, 2)]
    assert sorted(log.read_text().split()) == ["a", "b", "b", "b", "c", "c"]


def test_cones_equal_all_pairs(spark):
    """Points over the whole sky, at the poles and at the wrap, and the nearest of each."""
    rng = np.random.default_rng(7)
    sky = lambda n: np.column_stack([np.concatenate([rng.uniform(0, 360, n), [0, 359.999, 0.001, 180, 10]]), np.concatenate([np.degrees(np.arcsin(rng.uniform(-1, 1, n))), [90, -90, 89.9, -89.5, 0]])])
    p, c = sky(400), sky(600)
    a, b = np.radians(p)[:, None, :], np.radians(c)[None, :, :]
    sep = np.degrees(2 * np.arcsin(np.sqrt(np.minimum(1, np.sin((b[..., 1] - a[..., 1]) / 2) ** 2 + np.cos(a[..., 1]) * np.cos(b[..., 1]) * np.sin((b[..., 0] - a[..., 0]) / 2) ** 2))))
    points = spark.createDataFrame(pd.DataFrame({"id": range(len(p)), "ra": p[:, 0], "dec": p[:, 1]}))
    catalog = spark.createDataFrame(pd.DataFrame({"cid": range(len(c)), "c_ra": c[:, 0], "c_dec": c[:, 1]}))
    for radius in (0.7, 4.0, 25.0):
        got = joins.cone(points, catalog, radius).select("id", "cid").collect()
        assert len(got) == len(set(got)) and {tuple(r) for r in got} == set(zip(*(x.tolist() for x in np.nonzero(sep < radius)), strict=True))
    near = joins.nearest_on_sky(points, catalog, "id", [F.col("sep"), F.col("cid")], [1.0, 5.0, 20.0]).collect()
    assert {r.id: r.cid for r in near} == {n: int(row.argmin()) for n, row in enumerate(sep) if row.min() < 20}


def test_throttle_of_nothing(spark):
    none = spark.createDataFrame([], "k string, event_id bigint, at timestamp")
    assert runs.throttle(none, "k", 60.0).count() == 0


@needs_tables
def test_queries_see_every_row(spark):
    got = lambda name: entry.queries()[name](spark, FOLDER).toPandas()
    orders, part, supplier, line = read("orders"), read("part"), read("supplier"), read("lineitem")
    assert set(got("hex_roundtrip")["p_partkey"]) == set(part["p_partkey"])
    assert set(got("trigger_records")["trigname"]) == {f"t{k}" for k in orders["o_orderkey"]}
    assert set(got("transit_times")["s_suppkey"]) == set(supplier["s_suppkey"])
    in_order = orders.sort_values(["o_orderdate", "o_orderkey"])["o_orderkey"]
    assert dict(got("next_names")[["o_orderkey", "candname"]].to_numpy().tolist()) == {k: f"cand{n:06d}" for n, k in enumerate(in_order, 101)}
    strong = line[line["l_quantity"] >= 45]
    assert set(got("cutout_sums")["cand"]) == set(strong["l_orderkey"] * 10 + strong["l_linenumber"])
    place = supplier.groupby(supplier["s_suppkey"] % 32)["s_acctbal"].sum().to_dict()
    pairs = {(r.ant1, r.ant2): r.x for r in got("antenna_pairs").itertuples()}
    assert pairs == pytest.approx({(a, b): place[b] - place[a] for a in place for b in place if a < b}, abs=1e-5)
    assert len(got("baseline_uvw")) == len(got("name_split_join")) == len(pairs)


def test_clusters_without_a_task_a_gulp(spark):
    """The labels of the plain method, by a plan that gives no Python task a whole gulp."""
    rng = np.random.default_rng(5)
    x = np.concatenate([rng.normal(0, 0.02, (60, 2)), rng.uniform(-1, 1, (240, 2))])
    rows = pd.DataFrame({"g": rng.integers(0, 2, 300), "id": rng.permutation(300), "p": x[:, 0], "q": x[:, 1]})
    frame = learned.cluster(spark.createDataFrame(rows), "g", ["p", "q"], "id", 0.1, 4)
    assert "FlatMapGroupsInPandas" not in frame._jdf.queryExecution().toString()
    want = {}
    for g, part in rows.sort_values("id").groupby("g"):
        want |= {(g, i): c for i, c in zip(part["id"], learned.density_labels(part[["p", "q"]].to_numpy(), 0.1, 4), strict=True)}
    assert len(set(want.values())) > 4
    assert {(r.g, r.id): r.cluster for r in frame.collect()} == want


def test_lock_to_grid_across_partitions(spark):
    r = np.random.default_rng(3)
    t = np.unique(r.integers(0, 200_000, 5000)).astype(float) / 4
    v = r.normal(size=len(t))
    frame = spark.createDataFrame(pd.DataFrame({"t": t, "v": v}).sample(frac=1, random_state=1)).unionByName(spark.sql("SELECT CAST(NULL AS DOUBLE) AS t, 1.0D AS v"))
    out = planning.lock_to_grid(frame, "t", "v", 5.0).orderBy("t").toPandas()
    grid = np.arange(np.ceil(t[0] / 5) * 5, t[-1], 5.0)
    assert np.array_equal(out["t"], grid) and np.allclose(out["v"], np.interp(grid, t, v))
    assert planning.lock_to_grid(frame.limit(0), "t", "v", 5.0).count() == 0
