"""Streams with keyed state against plain replays: restarts, late and missing rows, bounded state."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from skysift import trials
from skysift.operators import search
from skysift.streaming import carry, runs, windows

SAMPLES = "pix int, chan int, t int, value double"


def by_place(rows):
    return {(r.pix, r.dm_idx, r.t): r.value for r in rows}


def test_carry_over_equals_the_batch_with_a_restart_between_gulps(spark):
    """Missing samples, a whole missing gulp, and a sample that comes twice; the stream starts anew for each gulp."""
    r = random.Random(3)
    rows = [(p, c, t, r.random()) for p in range(2) for c in range(5) for t in range(60) if r.random() > 0.05 and not 24 <= t < 36]
    delays = trials.linear_delays(spark, 4, 5, -0.75)
    df = spark.createDataFrame([*rows, (rows[-1][0], rows[-1][1], rows[-1][2], None)], SAMPLES)
    landings = [F.col("t").between(12 * g, 12 * g + 11) for g in (0, 1, 3, 4)]
    with carry.keyed_state(spark):
        got = by_place(runs.feed(df, landings, lambda s: carry.dedisperse(s, delays, "pix", 5, 12, 12 * 3600, "0 seconds")).collect())
    want = by_place(search.dedisperse(df.where("value is not null"), delays, ["pix"], 60).collect())
    assert set(got) == set(want) and all(abs(got[k] - want[k]) < 1e-9 for k in want)


def test_carry_over_waits_for_stragglers_and_leaves_out_late_rows(spark):
    """With a wait of one gulp, samples a gulp late count, those of a closed gulp don't."""
    r = random.Random(5)
    every = [(0, c, t, r.random()) for c in range(3) for t in range(40)]
    straggler, late = every[5], every[2]
    first = [x for x in every if x[2] < 10 and x not in (straggler, late)]
    batches = [first, [*[x for x in every if 10 <= x[2] < 20], straggler], [x for x in every if x[2] >= 20], [late]]
    df = spark.createDataFrame([(*x, n) for n, b in enumerate(batches) for x in b], f"{SAMPLES}, batch int")
    delays = trials.linear_delays(spark, 3, 3, -0.5)
    with carry.keyed_state(spark):
        out = runs.feed(df, [F.col("batch") == n for n in range(4)], lambda s: carry.dedisperse(s, delays, "pix", 3, 10, 36000, "10 hours"))
        got = by_place(out.collect())
    kept = df.where((F.col("chan") != late[1]) | (F.col("t") != late[2])).drop("batch")
    want = by_place(search.dedisperse(kept, delays, ["pix"], 40).where("t < 40").collect())
    closed = {k: v for k, v in want.items() if k[2] < 40}
    assert set(got) == set(closed) and all(abs(got[k] - closed[k]) < 1e-9 for k in closed)


def test_trials_of_later_samples_are_refused():
    with pytest.raises(ValueError):
        carry.Dedisperser([(0, 0, 2, 1.0)], 1, 4)
    sums = carry.Dedisperser([(0, 0, 0, 1.0), (0, 1, -3, 1.0)], 2, 4)
    history = np.full((2, 3), np.nan)
    value, count = sums.series(history, np.array([[1.0, 2, 3, 4], [10, 20, np.nan, 40]]))
    assert value.tolist() == [[1, 2, 3, 14]] and count.tolist() == [[1, 1, 1, 2]]
    assert sums.carried(history, np.arange(8.0).reshape(2, 4)).tolist() == [[1, 2, 3], [5, 6, 7]]


# windows by nearest time


def plain_windows(rows, gulp, gulps, stride, end):
    """Gulps of one key in the order of time: (anchor, missing, mean) of windows that are full or end by `end`."""
    anchors, out = [], []
    for us, _, _ in sorted(rows):
        if not anchors or us >= anchors[-1] + (stride - 0.5) * gulp:
            anchors.append(us)
    for a in anchors:
        places = {}
        for us, _, value in sorted(rows):
            if a <= us < a + (gulps - 0.5) * gulp:
                places.setdefault(int((us - a + gulp / 2) // gulp), value)
        missing = sum(1 << n for n in range(gulps) if n not in places)
        if not missing or a + (gulps - 0.5) * gulp <= end:
            out.append((a, missing, pytest.approx(sum(places.values()) / len(places))))
    return out


@pytest.mark.parametrize("stride", [1, 2, 5])
def test_window_rules(stride):
    r = random.Random(stride)
    for _ in range(60):
        rows = [(1_000_000 * n + r.randrange(-300_000, 300_000), n, r.random()) for n in range(60) if r.random() < 0.8]
        rows += [(us + r.randrange(2000), 100 + n, 9.0) for us, n, _ in r.sample(rows, 5)]
        w, got = windows.Windows(1_000_000, 5, stride), []
        for us, _, value in sorted(rows):
            got += w.take(us, value)
            assert len(w.open) <= 5 // stride + 2
        last = max(rows)[0]
        got = [(a, sum(1 << n for n, v in enumerate(p) if v is None), np.mean([v for v in p if v is not None])) for a, p in [*got, *w.close(last)]]
        assert sorted(got) == plain_windows(rows, 1_000_000, 5, stride, last)


def test_nearest_windows_in_a_stream(spark):
    """Gulps out of order within the wait, doubles, gaps, late ones, and restarts: as the plain replay of what came in time."""
    r = random.Random(4)
    base, hour = 1_704_067_200_000_000, 3_600_000_000
    rows = [(k, base + n * hour + r.randrange(-10**9, 10**9), n, r.random()) for k in ("a", "b") for n in range(1, 60) if r.random() < 0.85 and not 30 < n < 38]
    rows += [(k, us + 5, 900 + n, 7.0) for k, us, n, _ in rows[::9]]
    landed = [(*x, min(max(0, (x[1] - base + r.choice([0, 0, 2]) * hour) // (20 * hour)), 2)) for x in rows]
    late = ("a", base + 3 * hour, 999, 50.0, 3)
    df = spark.createDataFrame([*landed, late], "k string, us bigint, id bigint, value double, batch bigint").withColumn("at", F.timestamp_micros("us"))
    with carry.keyed_state(spark):
        out = runs.feed(df, [F.col("batch") == n for n in range(4)], lambda s: windows.nearest_windows(s, "k", 3600.0, 5, 2, "3 hours"))
        got = out.collect()
    clock = max(x[1] for x in rows) - 3 * hour
    for k in ("a", "b"):
        passed = [x[1:] for x in rows if x[0] == k and x[1] // 1000 <= clock // 1000]
        assert sorted((x.start, x.missing, x.mean) for x in got if x.k == k) == plain_windows(passed, hour, 5, 2, clock)


# bounded state of aggregates, and assembly


@pytest.mark.parametrize("mode", ["update", "append"])
def test_state_of_windows_stays_small_while_input_grows(spark, tmp_path, mode):
    """Ten landings of a day: the rows in state are those of one day at most, and the results are whole."""
    rows = spark.range(10 * 24 * 6).select(F.timestamp_seconds(1_704_067_200 + F.col("id") * 600).alias("at"), (F.col("id") % 3).cast("string").alias("kind"), F.lit(1.0).alias("value"))
    held = []
    for day in range(10):
        rows.where(F.dayofmonth("at") == day + 1).write.mode("append").parquet(f"{tmp_path}/in")
        stream = spark.readStream.schema(rows.schema).parquet(f"{tmp_path}/in")
        build = runs.tumbling(stream, "6 hours", "0 seconds", ["kind"]) if mode == "update" else runs.sessions(stream, "2 hours", "0 seconds", ["kind"])
        held.append(runs._run(build, mode, str(tmp_path / "q"))["stateOperators"][0]["numRowsTotal"])
    assert max(held) <= 15 and held[-1] <= held[1]
    out = runs._result(spark, build.schema, str(tmp_path / "q"), True, ["start", "kind"] if mode == "update" else None)
    if mode == "update":
        assert out.count() == 10 * 4 * 3 and {r.n for r in out.collect()} == {12} and out.agg(F.sum("total")).first()[0] == 1440.0


def test_assembly_holds_one_arrival_a_part(spark):
    """Many rows of each part, in several micro-batches: of each the first arrival of the first micro-batch that has it counts."""
    r = random.Random(8)
    base, hour = 1_704_067_200_000_000, 3_600_000_000
    rows = [(n // 400, r.randrange(3), r.random(), n, base + (n // 400) * hour + r.randrange(hour)) for n in range(2000)]
    rows = [x for x in rows if x[:2] != (2, 1)]
    slot0 = base // hour
    df = spark.createDataFrame([(s + slot0, p, v, n, us) for s, p, v, n, us in rows], "slot bigint, part int, value double, id bigint, us bigint").withColumn("arrived", F.timestamp_micros("us")).drop("us")
    landings = [F.floor((F.col("slot") - slot0) / 2) == k for k in range(3)]
    got = {x.slot - slot0: (x.missing, x.total) for x in runs.feed(df, landings, lambda s: runs.assemble(s, 3, hour, 0)).collect()}
    for slot in range(5):
        first = {}
        for _, p, v, n, us in sorted((x for x in rows if x[0] == slot), key=lambda x: (x[4], x[3])):
            first.setdefault(p, v)
        missing = sum(1 << p for p in range(3) if p not in first)
        assert got.get(slot) == (missing, pytest.approx(sum(first.values())))
