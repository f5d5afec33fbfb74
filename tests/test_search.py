"""Search operators against a NumPy restatement on small cubes."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from skysift import trials
from skysift.operators import folding, noise, search
from skysift.plans import search as plans
from skysift.plans import simulate

SIZE, STEPS = 4, 25


@pytest.fixture(scope="module")
def cube(spark):
    noise_cube = simulate.image_cube(spark, SIZE, STEPS, trials.CHANNELS, 1.0)
    return simulate.with_burst(noise_cube, (1, 2), 20, 1, 0.0, 30.0).cache()


def array(df, value="flux"):
    out = np.full((SIZE, SIZE, STEPS, trials.CHANNELS), np.nan)
    for r in df.collect():
        out[r.dec_idx, r.ra_idx, r.t, r.chan] = r[value]
    return out


def plain(x):
    """S/N and TOA of the search without history, by array algebra."""
    x = x - np.nanmedian(x, axis=2, keepdims=True)
    x = np.nan_to_num(x)
    rows = trials.delay_rows(trials.dispersion_trials(), trials.frequencies())
    count = max(r.dm_idx for r in rows) + 1
    shifted = np.zeros((SIZE, SIZE, count, STEPS))
    for r in rows:
        shifted[:, :, r.dm_idx] += r.weight * x[:, :, (np.arange(STEPS) + r.shift) % STEPS, r.chan]
    box = np.stack([sum(np.roll(shifted, k - STEPS // 2, axis=3) for k in range(w)) for w in trials.WIDTHS])
    level = np.median(np.median(box[:, :, :, 0].std(axis=3), axis=1), axis=1)
    snr = np.abs(box.max(axis=4) - np.median(box, axis=4)) / level[:, None, None, None]
    return snr, box.argmax(axis=4)


def test_trials():
    dms = trials.dispersion_trials()
    assert len(dms) == 16 and dms[0] == 0 and dms[-1] == pytest.approx(4847.041, abs=1e-3)
    slow = trials.dispersion_trials(5 * trials.DM_LEAST, 5 * trials.DM_MOST, 5 * trials.SAMPLE_MS)
    assert np.allclose(slow, 5 * np.array(dms))
    rows = trials.delay_rows(dms, trials.frequencies())
    assert len(rows) == 16 * 16 * 2
    for a, b in zip(rows[::2], rows[1::2]):
        assert a.weight + b.weight == pytest.approx(1) and b.shift - a.shift in (0, 1)
    assert min(r.shift for r in rows) == -20 and max(r.shift for r in rows) == 0


def test_search_equals_arrays(cube):
    snr, toa = plain(array(cube))
    got = plans.search_gulp(cube).collect()
    assert len(got) == snr.size
    for r in got:
        at = (r.wid_idx, r.dec_idx, r.ra_idx, r.dm_idx)
        assert r.snr == pytest.approx(snr[at], abs=1e-6)
        if np.sort(snr.ravel())[-1] == snr[at]:
            assert r.toa == toa[at]


def test_burst_is_found_and_indices_hold(cube):
    found = plans.candidates(plans.search_gulp(cube), 0.0)
    best = found.orderBy(F.desc("snr")).first()
    assert (best.dec_idx, best.ra_idx, best.dm_idx) == (1, 2, 0)
    assert found.count() == SIZE * SIZE * 5 * 16
    assert plans.candidates(plans.search_gulp(cube), best.snr + 1).count() == 0


def test_missing_samples_add_nothing(spark, cube):
    holes = cube.withColumn("flux", F.when((F.col("chan") == 3) & (F.col("t") % 2 == 0), None).when(F.col("chan") == 5, float("nan")).otherwise(F.col("flux")))
    x = array(holes)
    with np.errstate(all="ignore"):
        snr, _ = plain(np.where(np.isnan(x), np.nan, x))
    for r in plans.search_gulp(holes).where("ra_idx = 2").collect():
        assert r.snr == pytest.approx(snr[r.wid_idx, r.dec_idx, r.ra_idx, r.dm_idx], abs=1e-6)


def test_order_of_limit_and_filters(spark):
    rows = [(0, 0, 0, 1, 9.0), (0, 1, 0, 0, 5.0), (1, 0, 1, 0, 7.0)]
    df = spark.createDataFrame(rows, "dec_idx int, ra_idx int, wid_idx int, dm_idx int, snr double")
    assert [r.snr for r in search.select_candidates(df, 2, zero_dm="only").collect()] == [7.0]
    assert search.select_candidates(df, 1, zero_dm="only").count() == 0
    assert search.select_candidates(df, None, zero_dm="without").count() == 1
    assert search.select_candidates(df, None, narrow_only=True, centre=(0, 0), radius=1).count() == 1


def test_noise_state(spark):
    days = spark.createDataFrame([(0, d, x) for d, x in enumerate([1.0, 1.2, 9.0, 0.8, None])], "k int, day int, x double")
    got = noise.reject_and_fold(days, ["k"], "day", "x", 3.0).first()
    assert got.n == 3 and got.noise == pytest.approx(1.0)
    state = noise.initial(spark, 2, [1, 2], 2.0, 3.0)
    assert state.where("width = 2").first().noise == pytest.approx(6 * 2**0.5)
    new = spark.createDataFrame([(0, 1, 4.0), (0, 1, float("nan")), (1, 2, None)], "dm_idx int, width int, x double")
    merged = {(r.dm_idx, r.width): (r.n, r.noise) for r in noise.merge(state, new, ["dm_idx", "width"]).collect()}
    assert merged[0, 1] == (1, 4.0) and merged[1, 2][0] == 0


def test_mask_and_zero_noise(spark):
    df = spark.createDataFrame([(1.0, 0.0), (9.0, 1.0), (float("inf"), 1.0), (0.5, 1.0)], "v double, n double")
    mask = search.sample_mask(F.col("v"), F.lit(0.0), F.col("n"), 3.0)
    assert [r.m for r in df.select(mask.alias("m")).collect()] == [True, False, False, True]


def test_synthetic_pulsar(spark):
    train = simulate.pulse_train(spark, 600, 30.0, 1.0, 8.0, 1.0).withColumn("k", F.lit(0))
    best = plans.periodicity(train, [17, 23, 30, 41], 600, ["k"], 3.0).first()
    assert best.period == 30
    x = np.array([r.value for r in train.orderBy("t").collect()])
    for r in folding.fold(train, [17, 30], 600, ["k"]).collect():
        n = 600 // r.period
        assert r.snr == pytest.approx(x[: n * r.period].reshape(n, r.period).mean(0).max() * n**0.5 / x.std(), abs=1e-9)
