"""Nearest fills against a plain loop, with wide gaps."""

import numpy as np

from brinework.operators import horizontal


def test_wide_gaps(spark):
    rng = np.random.default_rng(2)
    rows, want = [], {}
    for t in range(4):
        values = {(e, x): float(100 * e + x) for e in range(30) for x in range(34) if rng.random() < 0.97}
        land = {0: lambda e, x: x > 4, 1: lambda e, x: (e, x) != (29, 33), 2: lambda e, x: rng.random() < 0.6 or 8 < e < 28, 3: lambda e, x: True}[t]
        values |= {(29, 33): 7.0, (0, 0): 5.0}
        valid = {c: v for c, v in values.items() if not land(*c)}
        for (e, x) in values:
            rows.append((t, e, x, valid.get((e, x))))
            want[t, e, x] = valid[min(valid, key=lambda c: ((c[0] - e) ** 2 + (c[1] - x) ** 2, c))] if valid else None
    df = spark.createDataFrame(rows, "t int, eta int, xi int, v double")
    got = {(r.t, r.eta, r.xi): r.v for r in horizontal.fill_nearest(df, ["t"], "v").collect()}
    assert got == want


def exchanges(df):
    return df._jdf.queryExecution().optimizedPlan().toString().count("Aggregate [")


def test_one_valid_cell_and_random_masks(spark):
    """Up to one valid cell in 300 x 300, without a step of the plan more than for a narrow hole."""
    n = 300
    rows = [(0, e, x, 9.0 if (e, x) == (17, 288) else None) for e in range(n) for x in range(n)]
    df = spark.createDataFrame(rows, "t int, eta int, xi int, v double")
    out = horizontal.fill_nearest(df, ["t"], "v")
    assert {r.v for r in out.collect()} == {9.0} and out.count() == n * n
    rng = np.random.default_rng(3)
    for share in (0.5, 0.05, 0.002):
        field = np.where(rng.random((60, 70)) < share, np.arange(4200.0).reshape(60, 70), np.nan)
        field[59, 0] = -1.0
        good = np.argwhere(~np.isnan(field))
        want = {}
        for e in range(60):
            for x in range(70):
                gap = ((good - (e, x)) ** 2).sum(axis=1)
                want[e, x] = field[tuple(good[np.argmin(gap)])]  # argwhere is in (eta, xi) order
        small = spark.createDataFrame([(e, x, None if np.isnan(field[e, x]) else float(field[e, x]), "k") for e in range(60) for x in range(70)], "eta int, xi int, v double, other string")
        got = horizontal.fill_nearest(small, [], "v")
        assert got.columns == small.columns
        assert {(r.eta, r.xi): r.v for r in got.collect()} == want
        assert exchanges(horizontal.fill_nearest(small.withColumn("t", small.eta * 0), ["t"], "v")) == exchanges(out)


def test_nulls_and_empty(spark):
    rows = [(None, 0, 0, 1.0), (None, 0, 1, None), (1, 0, 0, None), (2, 0, None, None), (2, None, 3, 4.0), (2, 5, 5, 6.0), (2, 9, 5, None)]
    df = spark.createDataFrame(rows, "t int, eta int, xi int, v double")
    got = sorted(map(str, map(tuple, horizontal.fill_nearest(df, ["t"], "v").collect())))
    assert got == sorted(map(str, [(None, 0, 0, 1.0), (None, 0, 1, 1.0), (1, 0, 0, None), (2, 0, None, None), (2, None, 3, 4.0), (2, 5, 5, 6.0), (2, 9, 5, 6.0)]))
    assert horizontal.fill_nearest(df.limit(0), ["t"], "v").collect() == []
