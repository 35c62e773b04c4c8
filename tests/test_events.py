"""Detection and yearly statistics against a plain loop, and the identities that must hold."""

import datetime as dt
import math

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from brinework.operators import events, timeaxis

START = dt.date(2019, 12, 20)


def plain(series, cold):
    """Categories of one series of (temp, clim, thr90, thr10) by a loop."""
    t = [c if v is None else v for v, c, _, _ in series]
    n = len(series)
    out = [0] * n
    if all(v is None or v == 0 for v, *_ in series):
        return out
    limit = [x[3 if cold else 2] for x in series]
    over = [lim is not None and v is not None and (v < lim if cold else v > lim) for v, lim in zip(t, limit)]
    inside = list(over)
    at = [i for i in range(n) if over[i]]
    for a, b in zip(at, at[1:]):
        if b - a - 1 in (1, 2):
            inside[a:b] = [True] * (b - a)
    i = 0
    while i < n:
        j = i
        while j < n and inside[j]:
            j += 1
        if j - i >= 5:
            for k in range(i, j):
                if t[k] is None or limit[k] is None or series[k][1] is None:
                    out[k] = 1
                elif limit[k] == series[k][1]:
                    out[k] = 4 if over[k] else 1
                else:
                    out[k] = min(4, max(1, math.floor(1 + (t[k] - limit[k]) / (limit[k] - series[k][1]))))
        i = max(j, i + 1)
    return out


def frame(spark, many):
    rows = [(c, START + dt.timedelta(days=i), *x) for c, s in enumerate(many) for i, x in enumerate(s)]
    return spark.createDataFrame(rows, "cell int, day date, temp double, clim double, thr90 double, thr10 double")


def known(temps):
    return [(float(t) if t is not None else None, 10.0, 12.0, 8.0) for t in temps]


HAND = [
    known([13] * 4 + [10] * 3 + [13] * 5),
    known([13, 13, 10, 13, 13, 10, 10, 13, 13]),
    known([13, 13, 13, 10, 10, 10, 13, 13, 13]),
    known([17, 19, 30, 13, 13] + [10] * 10 + [3] * 6),
    known([None] * 8),
    known([0] * 8),
    known([13, 13, None, 13, 13]),
    [(13.0, 10.0, None, 8.0)] * 6,
    [(13.0, 10.0, 10.0, 10.0)] * 6,
    known([10] * 8 + [13] * 9),
    known([13] * 5),
    known([13] * 4),
]


def check(spark, many):
    got = events.detect(frame(spark, many), ["cell"]).orderBy("cell", "day").collect()
    hot = [x for s in many for x in plain(s, False)]
    cold = [x for s in many for x in plain(s, True)]
    assert [(r.hot, r.cold) for r in got] == list(zip(hot, cold))
    assert [r.category for r in got] == [h or -c for h, c in zip(hot, cold)]
    return got


def test_hand_made(spark):
    got = check(spark, HAND)
    assert [r.hot_run for r in got if r.cell == 9] == [0] * 8 + [9] + [0] * 8


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.lists(st.sampled_from([None, 0.0, 5.0, 7.5, 10.0, 12.0, 12.5, 15.0, 20.0]), min_size=1, max_size=40), min_size=1, max_size=12))
def test_random_series(spark, many):
    check(spark, [known(s) for s in many])


def test_year_statistics(spark):
    many = [known([10] * 8 + [13] * 9 + [10] * 5 + [5] * 7), known([10] * 400)]
    got = {(r.cell, r.year): r for r in events.year_stats(events.detect(frame(spark, many), ["cell"]), ["cell"]).collect()}
    assert sorted(got) == [(c, y) for c in (0, 1) for y in (2019, 2020, 2021)]
    first = got[0, 2019]
    assert (first.mhw_count, first.mhw_duration_max, first.mhw_days, first.mhw_days_moderate) == (1, 9, 4, 4)  # begins in 2019, ends in 2020
    assert (got[0, 2020].mhw_days, got[0, 2020].mhw_count, got[0, 2020].mhw_duration_mean) == (5, 0, None)
    assert (got[0, 2020].mcs_count, got[0, 2020].mcs_days_strong, got[0, 2020].mcs_intensity_max) == (1, 7, 5.0)
    empty = got[1, 2021]
    assert (empty.mhw_days, empty.mhw_intensity_mean, empty.mhw_count, empty.mcs_duration_max) == (0, None, 0, 0)


def test_month_with_context_equals_whole_record(spark):
    import random

    rng = random.Random(1)
    many = [known([rng.choice([9, 10, 13, 13, 13, 7]) for _ in range(120)]) for _ in range(8)]
    whole = frame(spark, many)
    days, target = events.restrict_with_context(whole, "2020-01-15", "2020-02-14")
    want = events.detect(whole, ["cell"]).where(target).select("cell", "day", "category")
    got = events.detect(days, ["cell"]).where(target).select("cell", "day", "category")
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty() and got.count() == 8 * 31


def test_date_gap_splits_only_when_asked(spark):
    rows = [(0, START + dt.timedelta(days=i + 10 * (i > 3)), 13.0, 10.0, 12.0, 8.0) for i in range(8)]
    df = spark.createDataFrame(rows, "cell int, day date, temp double, clim double, thr90 double, thr10 double")
    assert events.detect(df, ["cell"]).where("hot > 0").count() == 8
    assert events.detect(df, ["cell"], split_on_date_gap=True).where("hot > 0").count() == 0


def test_leap_day_falls_back(spark):
    daily = spark.createDataFrame([(0, dt.date(2020, 2, 29), 5.0), (1, dt.date(2020, 2, 29), 5.0)], "cell int, day date, temp double")
    clim = spark.createDataFrame([(0, 59, 1.0), (1, 60, 2.0)], "cell int, doy int, clim double")
    got = {r.cell: r.clim for r in events.join_climatology(daily, clim, ["cell"]).collect()}
    assert got == {0: 1.0, 1: 2.0}


def test_one_exchange_after_the_hash(spark):
    df = frame(spark, HAND).repartition(4, "cell")
    plan = events.detect(df, ["cell"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Python" not in plan


def test_part_days(spark):
    rows = [(0, dt.datetime(2020, 1, 1) + dt.timedelta(hours=3 * k), 1.0) for k in range(12)]
    readings = spark.createDataFrame(rows, "site int, time timestamp, value double")
    daily = timeaxis.daily_mean(readings, ["site"])
    assert [str(r.day) for r in timeaxis.drop_part_days(readings, daily, 0.9).collect()] == ["2020-01-01"]
    assert timeaxis.drop_part_days(readings, daily, 0).count() == 2
    with pytest.raises(ValueError):
        timeaxis.drop_part_days(readings, daily, 1.5)


def test_nearest_ties_go_to_the_earlier(spark):
    t = dt.datetime(2020, 1, 1)
    left = spark.createDataFrame([(0, t), (1, t)], "k int, time timestamp")
    right = spark.createDataFrame([(0, t - dt.timedelta(hours=1), 1), (0, t + dt.timedelta(hours=1), 2), (1, t, 3)], "k int, time timestamp, v int")
    got = {r.k: r.v for r in timeaxis.nearest_in_time(left, right, ["k"], "time", ["v"]).collect()}
    assert got == {0: 1, 1: 3}


def test_latest_forecast_wins(spark):
    rows = [(r, 0, h, k, 10 * r + k) for r in (1, 2, 3) for h in range(4 * (r - 1), 4 * (r - 1) + 6) for k in (0, 1) if (r, h) != (3, 9)]
    df = spark.createDataFrame(rows, "run int, cell int, valid_time int, k int, v int")
    got = {r.valid_time: (r.run, r.k) for r in timeaxis.latest_run_wins(df, ["cell"], order="k").collect()}
    assert got == {h: (1 if h < 4 else 2 if h < 8 else 3, 0) for h in range(14) if h != 9}


def test_deaccumulation(spark):
    means = [3.0, 5.0, 1.0, 0.0, 2.0, 7.0, 4.0, 6.0]
    running = [sum(means[6 * (i // 6) : i + 1]) / (i % 6 + 1) for i in range(8)]
    df = spark.createDataFrame([(0, i + 1, v) for i, v in enumerate(running)], "cell int, step_hours int, value double")
    got = [r.value for r in timeaxis.deaccumulate(df, ["cell"]).orderBy("step_hours").collect()]
    assert got == pytest.approx(means)


def test_masked_difference(spark):
    df = spark.createDataFrame([(0, i, v) for i, v in enumerate([1.0, 3.0, None, 6.0, 10.0, 15.0])] + [(0, 8, 1.0)], "k int, x int, v double")
    got = [r.d for r in timeaxis.masked_difference(df, ["k"], "x", "v", "d").orderBy("x").collect()]
    assert got == [2.0, 2.0, None, 4.0, 4.5, 5.0, None]
    assert df.select(F.lit(1)).count() == 7
