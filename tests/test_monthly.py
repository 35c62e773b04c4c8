"""A record that grows by files, month by month, against one run over the whole record."""

import datetime as dt
import os
import random

import pytest

from brinework.operators import events
from brinework.plans import monthly

DAYS = "cell int, day date, temp double"


@pytest.fixture(scope="module")
def record(spark):
    """Two years of two cells with long and short spells over the ends of months, a few days missing, and one cell that is land."""
    rng = random.Random(11)
    rows, first = [], dt.date(2001, 1, 1)
    for cell in (1, 2, None):
        spell, k = 0, 0
        while k < 730:
            spell = rng.choice([0, 0, 4, -4])
            for _ in range(rng.randint(1, 70 if spell and cell == 1 else 9)):
                if rng.random() < 0.97:
                    rows.append((cell, first + dt.timedelta(days=k), 15 + spell + rng.random()))
                k += 1
    rows += [(3, first + dt.timedelta(days=k), None if k % 2 else 0.0) for k in range(100)]
    clim = [(c, d, 15.5, 17.0, 14.0) for c in (1, 2, 3) for d in range(1, 367)]
    return rows, spark.createDataFrame(rows, DAYS), spark.createDataFrame(clim, "cell int, doy int, clim double, thr90 double, thr10 double")


def whole_run(spark, rows, clim):
    days = spark.createDataFrame(rows, DAYS)
    spans = {}
    for c, d, _ in rows:
        a, b = spans.get(c, (d, d))
        spans[c] = (min(a, d), max(b, d))
    spine = [(c, a + dt.timedelta(days=k)) for c, (a, b) in spans.items() for k in range((b - a).days + 1)]
    full = spark.createDataFrame(spine, "cell int, day date").join(days, ["cell", "day"], "left")
    return {(r.cell, r.day): r.category for r in events.detect(events.join_climatology(full, clim, ["cell"]), ["cell"]).collect()}


def runs(categories):
    out, last = [], {}
    for (c, d), k in sorted(categories.items(), key=lambda x: (str(x[0][0]), x[0][1])):
        if k:
            s = 1 if k > 0 else -1
            if last.get((c, s)) and last[c, s][1] == d - dt.timedelta(days=1):
                last[c, s][1] = d
            else:
                last[c, s] = [d, d]
                out.append((c, s, last[c, s]))
    return sorted(str((c, s, a, b)) for c, s, (a, b) in out)


def test_files_that_come_late(spark, record, tmp_path):
    rows, _, clim = record
    at = [str(tmp_path / n) for n in ("record", "products", "events")]
    rng = random.Random(12)
    late = [r for r in rows if (r[1].year, r[1].month) in ((2001, 3), (2001, 12), (2002, 1)) and rng.random() < 0.6]
    corrected = [(c, d, t + 9) for c, d, t in rows if c == 2 and d.month == 7 and d.year == 2002 and 3 < d.day < 12]
    first = [r for r in rows if r not in late]
    clim.write.parquet(str(tmp_path / "clim"))
    clim = spark.read.parquet(str(tmp_path / "clim"))
    all_months = monthly.update_months(spark.createDataFrame(first, DAYS), clim, *at, ["cell"])
    assert len(all_months) == 26  # with those right before and after the record, which hold no day
    before = {f: os.path.getmtime(f) for f in monthly.files_of(monthly.read_months(spark, at[1]))}
    changed = monthly.update_months(spark.createDataFrame(late + corrected, DAYS), clim, *at, ["cell"])
    month = lambda y, m: 12 * y + m
    assert changed == [month(2001, m) for m in (2, 3, 4, 11, 12)] + [month(2002, m) for m in (1, 2, 6, 7)]
    kept = [f for f in before if os.path.exists(f)]
    assert {tuple(p.split("=")[1] for p in f.split("/") if "=" in p) for f in before if f not in kept} <= {(str((m - 1) // 12), str((m - 1) % 12 + 1)) for m in changed}
    assert len(kept) >= 24 - len(changed)
    now = {(c, d): t for c, d, t in rows} | {(c, d): t for c, d, t in corrected}
    want = whole_run(spark, [(c, d, t) for (c, d), t in now.items()], clim)
    got = monthly.read_months(spark, at[1])
    assert {(r.cell, r.day): r.category for r in got.collect()} == {k: want[k] for k in now}
    found = monthly.stored_events(spark, at[2], ["cell"]).collect()
    assert sorted(str((r.cell, r.sign, r.first, r.last)) for r in found) == runs(want)
    assert any(r.first.month != r.last.month for r in found) and all(r.length == (r.last - r.first).days + 1 for r in found)


def test_only_the_months_asked_for_are_read(spark, record, tmp_path):
    _, days, clim = record
    at = [str(tmp_path / n) for n in ("record", "products", "events")]
    monthly.update_months(days, clim, *at, ["cell"])
    some = monthly.read_months(spark, at[0], [12 * 2001 + 5])
    assert all("year=2001/month=5/" in f for f in monthly.files_of(some)) and monthly.files_of(some)
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "= 24017)], PushedFilters" in plan


def test_nothing_new_and_events_that_go(spark, tmp_path):
    at = [str(tmp_path / n) for n in ("record", "products", "events")]
    clim = spark.createDataFrame([(1, d, 15.0, 17.0, 13.0) for d in range(1, 367)], "cell int, doy int, clim double, thr90 double, thr10 double")
    hot = [(1, dt.date(2001, 5, k), 20.0) for k in range(1, 9)]
    assert monthly.update_months(spark.createDataFrame(hot, DAYS), clim, *at, ["cell"])
    assert len(monthly.stored_events(spark, at[2], ["cell"]).collect()) == 1
    assert monthly.update_months(spark.createDataFrame([], DAYS), clim, *at, ["cell"]) == []
    assert monthly.update_months(spark.createDataFrame([(1, None, 3.0)], DAYS), clim, *at, ["cell"]) == []
    monthly.update_months(spark.createDataFrame([(c, d, 15.0) for c, d, _ in hot], DAYS), clim, *at, ["cell"])
    assert monthly.stored_events(spark, at[2], ["cell"]).collect() == []
