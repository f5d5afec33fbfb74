"""Sky joins over many rows of few places, against their SQL: what is searched grows with the places alone."""

import duckdb
import numpy as np
import pandas as pd
import pytest

import __spark_entry__ as entry
from skysift.operators import joins


@pytest.fixture()
def folder(tmp_path):
    """Many rows for each of 360 places; keys of both sides that repeat, a place of one side without a key."""
    rng = np.random.default_rng(4)
    customer = pd.DataFrame({"c_custkey": [*range(3000), 7, 7, 2999]}, dtype="int64")
    supplier = pd.DataFrame({"s_suppkey": [*range(900), 5, 5, 899], "s_acctbal": rng.integers(0, 40, 903) / 4})
    customer.to_parquet(tmp_path / "customer.parquet")
    supplier.to_parquet(tmp_path / "supplier.parquet")
    return str(tmp_path)


@pytest.mark.parametrize(("name", "step", "most"), [("nearest_match", "cone", 360 * 40), ("cone_search", "cone", 360 * 10), ("dec_strip", "strip", 120 * 4)])
def test_places_not_rows_are_searched(spark, folder, monkeypatch, name, step, most):
    made, real = [], getattr(joins, step)

    def counted(*args):
        out = real(*args)
        made.append(out.count())
        return out

    monkeypatch.setattr(joins, step, counted)
    got = entry.queries()[name](spark, folder).toPandas()
    con = duckdb.connect()
    for t in ("customer", "supplier"):
        con.execute(f"create view {t} as select * from '{folder}/{t}.parquet'")
    want = con.execute(entry.oracle_sql()[name]).df()[list(got.columns)]
    order = list(got.columns)
    pd.testing.assert_frame_equal(got.sort_values(order, ignore_index=True), want.sort_values(order, ignore_index=True), check_dtype=False)
    assert len(got) > 2000 and sum(made) <= most


def test_points_of_one_place_go_in_shares(spark, folder, monkeypatch):
    monkeypatch.setattr(joins, "SHARE", 3)
    whole = entry.oracle_sql()["cone_search"]
    con = duckdb.connect()
    for t in ("customer", "supplier"):
        con.execute(f"create view {t} as select * from '{folder}/{t}.parquet'")
    got = entry.queries()["cone_search"](spark, folder).toPandas()
    want = con.execute(whole).df()[list(got.columns)]
    order = list(got.columns)
    pd.testing.assert_frame_equal(got.sort_values(order, ignore_index=True), want.sort_values(order, ignore_index=True), check_dtype=False)
