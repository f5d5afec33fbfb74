"""Planted ellipses under noise, and plans against a plain loop."""

import math
import random

import numpy as np
import pytest

from skysift.operators import fitting, planning


def test_planted_ellipses_are_recovered(spark):
    """Several groups at once: tilted, round, off centre, with noise and missing pixels; flat and tiny groups get nulls."""
    r = np.random.default_rng(5)
    planted = {0: (10.0, 12.3, 9.1, 4.0, 1.5, 0.6), 1: (3.0, 8.0, 14.5, 2.5, 2.0, -1.2), 2: (50.0, 15.2, 15.9, 6.0, 2.2, 1.4), 3: (1.0, 10.0, 10.0, 1.6, 1.1, 0.0)}
    rows = []
    for k, (height, x0, y0, major, minor, tilt) in planted.items():
        for y in range(28):
            for x in range(28):
                c, s = math.cos(tilt), math.sin(tilt)
                u, v = (x - x0) * c + (y - y0) * s, -(x - x0) * s + (y - y0) * c
                value = height * math.exp(-(u * u / major**2 + v * v / minor**2) / 2) + float(r.normal(0, 0.01 * height))
                rows.append((k, x, y, None if (x + 3 * y) % 17 == 0 else value))
    rows += [(8, n % 4, n // 4, 0.0) for n in range(16)] + [(9, 1, 1, 5.0), (9, 2, 1, 3.0)]
    got = {g.k: g for g in fitting.fit_ellipses(spark.createDataFrame(rows, "k int, x int, y int, value double"), ["k"]).collect()}
    assert set(got) == {0, 1, 2, 3, 8, 9} and got[8].major is None and got[9].major is None
    for k, (height, x0, y0, major, minor, tilt) in planted.items():
        g = got[k]
        assert (g.height, g.x, g.y, g.major, g.minor) == pytest.approx((height, x0, y0, major, minor), rel=0.02, abs=0.05)
        assert abs(math.remainder(g.tilt - tilt, math.pi)) < 0.05 and g.rms == pytest.approx(0.01 * height, rel=0.15)


def test_survey_chains(spark):
    r = random.Random(2)
    visits = [(n, float(r.randrange(2000)), float(r.choice([5, 20, 60])), float(r.choice([30, 40, 55, 90]))) for n in range(150)]
    df = spark.createDataFrame(visits, "id bigint, start double, length double, elevation double").repartition(4)
    jumps = planning.next_visits(df, 0.5)
    follow = {}
    for i, start, length, elevation in visits:
        can = [(s, j) for j, s, _, e in visits if s >= start + length + abs(e - elevation) / 0.5]
        if can:
            follow[i] = min(can)[1]
    assert {x.id: x.next_id for x in jumps.collect()} == follow
    for steps in (1, 2, 7, 40):
        want = set()
        for i, *_ in visits:
            at, n = i, 0
            while n < steps:
                want.add((i, n, at))
                n += 1
                if at not in follow:
                    break
                at = follow[at]
        assert {tuple(x) for x in planning.chains(df.select("id"), jumps, steps).collect()} == want


def test_a_visit_asks_few_strips(spark, monkeypatch):
    """Where strips are full of visits, hardly any but a visit's own is asked; a chain of one start runs on through visits that are no start."""
    r = random.Random(3)
    visits = [(n, float(r.randrange(3000)), 5.0, float(r.randrange(12) * 10)) for n in range(3000)]
    df = spark.createDataFrame(visits, "id bigint, start double, length double, elevation double").repartition(4)
    asked, real = [], planning.joins.forward_by

    def counted(left, *args):
        asked.append(left.count())
        return real(left, *args)

    monkeypatch.setattr(planning.joins, "forward_by", counted)
    jumps = planning.next_visits(df, 0.05)
    follow = {x.id: x.next_id for x in jumps.collect()}
    for i, start, length, elevation in visits[::50]:
        can = [(s, j) for j, s, _, e in visits if s >= start + length + abs(e - elevation) / 0.05]
        assert follow.get(i) == (min(can)[1] if can else None)
    assert sum(asked) < 2 * len(visits)
    want, at = [], 1
    while at is not None and len(want) < 12:
        want.append((1, len(want), at))
        at = follow.get(at)
    assert sorted(tuple(x) for x in planning.chains(df.select("id").where("id = 1"), jumps, 12).collect()) == want
