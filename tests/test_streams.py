"""Streams over several files that are not sorted by time, upserts over several batches, gaps by position."""

import datetime as dt
import os
import random

from test_jobs import T0, finish, stream_of

from brinework.plans import registry
from brinework.streaming import jobs


def test_layout_of_files(spark, sf, tmp_path):
    registry.load()
    events = spark.read.parquet(f"{sf}/events.parquet")
    for k, part in enumerate(("ts >= '{}'", "ts < '{}'")):  # the newest rows come in the first file
        cut = events.selectExpr("percentile_approx(ts, 0.5) AS c").first().c
        events.where(part.format(cut)).coalesce(1).write.mode("append").parquet(str(tmp_path / "sf" / "events.parquet"))
    assert len([f for f in os.listdir(tmp_path / "sf" / "events.parquet") if f.endswith(".parquet")]) == 2
    for name in ("stream_daily_means", "stream_upsert"):
        rows = lambda d: sorted(map(str, registry.QUERIES[name](spark, d).collect()))  # noqa: B023, E731
        assert rows(str(tmp_path / "sf")) == rows(sf)


def test_upsert_keeps_earlier_batches(spark, tmp_path):
    df = stream_of(spark, tmp_path, [[(1, 10, 1.0), (2, 10, 2.0), (3, 20, 3.0)], [(2, 10, 5.0), (4, 10, 4.0)]], "event_id bigint, user_id bigint, value double")
    jobs.upsert(df, str(tmp_path / "out"), str(tmp_path / "state"), "user_id", ["event_id"], ["value"]).awaitTermination()
    assert sorted(map(tuple, spark.read.parquet(str(tmp_path / "out")).select("event_id", "user_id", "value").collect())) == [(1, 10, 1.0), (2, 10, 5.0), (3, 20, 3.0), (4, 10, 4.0)]


def test_gaps_are_days(spark, tmp_path):
    """Three low readings of one day are no gap of three days; missing days are a gap."""
    series = [(0, 1), (1, 1), (2, -1), (2, -1), (2, -1), (3, 1), (6, -1), (6, 1), (10, 1), (11, 1), (20, -1)]
    rows = [("s", p, float(x), T0 + dt.timedelta(days=p, minutes=k)) for k, (p, x) in enumerate(series)]
    df = stream_of(spark, tmp_path, [rows], "site string, position bigint, excess double, ts timestamp").withWatermark("ts", "0 days")
    got = sorted((r.first, r.last, r.length) for r in finish(spark, jobs.event_runs(df, "site", 2, 2, "2020-01-01"), tmp_path))
    assert got == [(0, 6, 7), (10, 11, 2)]


def test_days_in_any_order_within_the_lateness(spark, tmp_path):
    """Shuffled over many batches, the runs are those of the sorted series; a late day joins or bridges runs."""
    rng = random.Random(4)
    want, rows = [], []
    for site in ("a", "b", None):
        hits = sorted({p for p in range(60) if rng.random() < 0.45})
        for p in range(60):
            rows += [(site, p, rng.random() + 0.1 if p in hits else -1.0, T0 + dt.timedelta(days=p, hours=h)) for h in rng.sample(range(24), rng.randint(1, 2))]
        runs = [[hits[0]]]
        for p in hits[1:]:
            runs.append([p]) if p - runs[-1][-1] > 3 else runs[-1].append(p)
        want += [(site, r[0], r[-1], r[-1] - r[0] + 1) for r in runs if r[-1] - r[0] >= 4]
    rng.shuffle(rows)
    batches = [rows[k::7] for k in range(7)] + [[(s, 500, -1.0, T0 + dt.timedelta(days=500)) for s in ("a", None)] + [(None, None, 1.0, T0 + dt.timedelta(days=499)), ("a", 499, None, T0 + dt.timedelta(days=499))]]
    df = stream_of(spark, tmp_path, batches, "site string, position bigint, excess double, ts timestamp").withWatermark("ts", "90 days")
    got = finish(spark, jobs.event_runs(df, "site", 5, 2, "2020-01-01"), tmp_path)
    assert sorted(map(str, ((r.site, r.first, r.last, r.length) for r in got))) == sorted(map(str, want))


def test_a_late_day_keeps_the_open_run(spark, tmp_path):
    at = lambda p, x=1.0: ("s", p, x, T0 + dt.timedelta(days=p))
    batches = [[at(p) for p in range(10, 15)], [at(2)], [at(p, -1.0) for p in range(15, 30)], [at(60, -1.0)]]
    df = stream_of(spark, tmp_path, batches, "site string, position bigint, excess double, ts timestamp").withWatermark("ts", "20 days")
    got = [(r.first, r.last, r.length) for r in finish(spark, jobs.event_runs(df, "site", 5, 2, "2020-01-01"), tmp_path)]
    assert got == [(10, 14, 5)]


def test_upsert_repeats_and_nulls(spark, tmp_path):
    batches = [
        [(1, 10, 1, "a"), (1, 10, 2, "b"), (5, None, 1, "x"), (None, 10, 1, "k")],
        [(6, None, 1, "y"), (1, 10, 1, "late"), (2, 20, 1, "c"), (2, 20, 1, "c")],
        [(5, None, 3, "z"), (2, 20, None, "unordered"), (None, 10, 2, "l")],
    ]
    df = stream_of(spark, tmp_path, batches, "event_id bigint, user_id bigint, version int, what string")
    jobs.upsert(df, str(tmp_path / "out"), str(tmp_path / "state"), "user_id", ["event_id"], ["version"]).awaitTermination()
    got = spark.read.parquet(str(tmp_path / "out"))
    rows = lambda: sorted(str((r.event_id, r.user_id, r.what)) for r in got.collect())
    want = sorted(map(str, [(1, 10, "b"), (5, None, "z"), (6, None, "y"), (2, 20, "c"), (None, 10, "l")]))
    assert rows() == want
    again = spark.createDataFrame(batches[0], "event_id bigint, user_id bigint, version int, what string")
    jobs.merge_batch(again, str(tmp_path / "out"), "user_id", ["event_id"], ["version"])
    got = spark.read.parquet(str(tmp_path / "out"))
    assert rows() == want
