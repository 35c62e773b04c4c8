"""Crossings, reachable water, long rings, runs by stamp and parts of the potential vorticity against plain loops."""

import collections
import datetime as dt
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from brinework.operators import forcing, geo, horizontal, timeaxis
from brinework.plans import workloads
from brinework.sources import io


def test_crossings_of_a_row(spark):
    row = [0.0, 2.0, 1.0, 1.0, 1.0, 3.0, None, 0.0, 1.0]
    cells = spark.createDataFrame([(0, k, v, 10.0 * k) for k, v in enumerate(row)] + [(1, 0, 1.0, 0.0), (1, 2, 0.0, 20.0), (1, 3, 2.0, 30.0)], "eta int, xi int, v double, x double")
    got = [(r.eta, r.number, r.position, r.x) for r in horizontal.crossings(cells, ["eta"], "xi", "v", [1.0], ["x"]).orderBy("eta", "number").collect()]
    # up between 0 and 1; a plateau once, at its end; a value right at the target before a gap; the end of a row
    assert got == [(0, 1, 0.5, 5.0), (0, 2, 4.0, 40.0), (0, 3, 8.0, 80.0), (1, 1, 0.0, 0.0), (1, 2, 2.5, 25.0)]
    assert horizontal.crossings(cells.limit(0), ["eta"], "xi", "v", [1.0], ["x"]).collect() == []


def test_crossings_along_levels_and_eta(spark):
    rng = np.random.default_rng(1)
    field = rng.normal(size=(7, 9))
    cells = spark.createDataFrame([(int(e), int(s), float(field[e, s])) for e in range(7) for s in range(9)], "eta int, level int, v double")
    for axis, other, rows in (("level", "eta", field), ("eta", "level", field.T)):
        want = {(k, t): [j + (r[j] - t) / (r[j] - r[j + 1]) for j in range(len(r) - 1) if (r[j] - t) * (r[j + 1] - t) < 0] for k, r in enumerate(rows) for t in (-0.5, 0.4)}
        got = collections.defaultdict(list)
        for r in horizontal.crossings(cells, [other], axis, "v", [-0.5, 0.4], ["v"]).orderBy("number").collect():
            got[r[other], r.target].append(r.position)
            assert r.v == pytest.approx(r.target)
        assert {k: v for k, v in want.items() if v} == {k: pytest.approx(v) for k, v in got.items()}


def flooded(picture, seed):
    cells = {(j, i) for j, line in enumerate(picture) for i, c in enumerate(line) if c == "."}
    water, todo = {seed}, [seed]
    while todo:
        j, i = todo.pop()
        for c in ((j + 1, i), (j - 1, i), (j, i + 1), (j, i - 1)):
            if c in cells and c not in water:
                water.add(c)
                todo.append(c)
    ny, nx = len(picture), len(picture[0])
    while True:
        score = {(j, i): sum((8 if 0 in (a, b) else 1) for a in (-1, 0, 1) for b in (-1, 0, 1) if (a, b) != (0, 0) and (j + a, i + b) in water) for j, i in water}
        gone = {(j, i) for (j, i), s in score.items() if s < 12 and 0 < j < ny - 1 and 0 < i < nx - 1}
        if not gone:
            return water
        water -= gone


BAY = ["..xxxxx...", "...xxxx.x.", "......ox..", "..xxxxx.xx", "..x..xx...", "..x..xx.xx", "...xxxxx.."]


def test_reachable_water(spark):
    rng = np.random.default_rng(2)
    random = ["".join("." if x < 0.66 else "x" for x in row) for row in rng.random((40, 45))]
    spiral = [".........", "xxxxxxxx.", ".......x.", ".xxxxx.x.", ".x...x.x.", ".x.xxx.x.", ".x.....x.", ".xxxxxxx.", "........."]
    for picture in ([line.replace("o", ".") for line in BAY], random, spiral):
        seed = next((j, i) for j in range(len(picture)) for i in range(len(picture[0])) if picture[j][i] == ".")
        df = spark.createDataFrame([(j, i, int(c == ".")) for j, line in enumerate(picture) for i, c in enumerate(line)], "eta int, xi int, mask int")
        got = forcing.reachable_water(df, seed)
        assert got.count() == df.count()
        assert {(r.eta, r.xi) for r in got.where("mask = 1").collect()} == flooded(picture, seed)
    with pytest.raises(ValueError):
        forcing.reachable_water(df, (1, 0))


def test_rings_of_any_shape(spark):
    """A jagged star, edges as tall as the ring, a hole, level edges; points on the outside, without a place, repeated."""
    rng = np.random.default_rng(3)
    star = [(3 * math.cos(a) * r, 2 * math.sin(a) * r) for a, r in zip(np.linspace(0, 2 * math.pi, 3000, endpoint=False), rng.uniform(0.3, 1, 3000))]
    comb = [(x / 50, -2.0 if x % 2 else 2.0) for x in range(-100, 101)] + [(2.1, 3.0), (-2.1, 3.0)]
    box, hole = [(-2.0, -1.0), (2.0, -1.0), (2.0, 1.0), (-2.0, 1.0)], [(-0.5, -0.5), (0.5, -0.5), (0.5, 0.5), (-0.5, 0.5)]
    points = [(k, float(x), float(y)) for k, (x, y) in enumerate(rng.uniform(-3, 3, (400, 2)))] + [(900, None, 0.0), (901, 0.0, 9.0), (902, 0.0, 0.0), (902, 0.0, 0.0)]
    df = spark.createDataFrame(points, "site int, lon double, lat double")
    for rings in ([star], [comb], [box, hole]):
        edges = [(*a, *b) for ring in rings for a, b in zip(ring, ring[1:] + ring[:1])]
        got = {r.site: r.inside for r in geo.in_ring(df, spark.createDataFrame([tuple(map(float, e)) for e in edges], "lon0 double, lat0 double, lon1 double, lat1 double"), "site").collect()}
        for k, x, y in points:
            want = None if x is None else sum((b > y) != (d > y) and x < (c - a) * (y - b) / (d - b) + a for a, b, c, d in edges) % 2 == 1
            assert got[k] == want
    assert {r.inside for r in geo.in_ring(df.where("site = 1"), df.limit(0).selectExpr("lon lon0", "lat lat0", "lon lon1", "lat lat1"), "site").collect()} == {False}


def test_a_ring_of_many_edges(spark):
    """100,000 edges and 200,000 points meet within bands: no more than a few edges for each point."""
    n = 100_000
    turn = 2 * F.pi() * F.col("id") / n
    ring = geo.ring_edges(spark.range(n).select("id", (2 * F.cos(turn)).alias("lon"), F.sin(turn).alias("lat")), "id")
    points = spark.range(200_000).select("id", (F.pmod(F.xxhash64("id"), F.lit(6000)) / 1000 - 3).alias("lon"), (F.pmod(F.xxhash64("id", F.lit(1)), F.lit(3000)) / 1000 - 1.5).alias("lat"))
    got = geo.in_ring(points, ring, "id").join(points, "id").where(F.abs(F.col("lon") ** 2 / 4 + F.col("lat") ** 2 - 1) > 1e-4)
    assert got.where("inside <> (lon * lon / 4 + lat * lat < 1)").isEmpty() and got.count() > 190_000


def test_numbers_without_gaps(spark):
    rows = spark.range(1000).select((F.col("id") * 7919 % 10007).alias("k")).repartition(5)
    got = [(r.k, r.n) for r in timeaxis.numbered(rows, "k", "n").collect()]
    assert sorted(n for _, n in got) == list(range(1000)) and [k for k, _ in sorted(got, key=lambda r: r[1])] == sorted(k for k, _ in got)


def test_runs_by_stamp(spark, tmp_path):
    """Only the files of the window are opened; the age is that of the names."""
    for d in range(1, 11):
        spark.createDataFrame([(d, float(d))], "d int, v double").coalesce(1).write.parquet(str(tmp_path / f"run_202001{d:02d}06"))
    (tmp_path / "notes").mkdir()
    spark.createDataFrame([(99, 1.0)], "d int, v double").coalesce(1).write.parquet(str(tmp_path / "notes" / "other"))
    got = io.read_runs(spark, str(tmp_path), "d int, v double", "2020-01-10 12:00:00", 2)
    rows = got.collect()
    assert sorted((r.d, r.run) for r in rows) == [(d, dt.datetime(2020, 1, d, 6)) for d in (8, 9, 10)]
    plan = got._jdf.queryExecution().executedPlan()
    plan.execute().count()
    scan = plan.collectLeaves().apply(0)
    assert scan.metrics().get("numFiles").get().value() == 3
    with pytest.raises(ValueError):
        io.read_runs(spark, str(tmp_path), "d int, v double", "2020-01-12 06:00:00", 2)


def test_parts_of_layers_at_rest(spark):
    """Level, resting layers have the part upwards only; the parts add up to the whole."""
    rows = [(s, e, x, 0.0, 0.0, 0.0, 1020.0 - s, -50.0 + 10 * s, 1e-4, 1e-3, 1e-3) for s in range(4) for e in range(4) for x in range(4)]
    schema = "level int, eta int, xi int, u double, v double, w double, rho double, z double, f double, pm double, pn double"
    for r in workloads.ertel_pv_parts(spark.createDataFrame(rows, schema), [], 1025.0).collect():
        assert r.pv_i == r.pv_j == 0 and r.pv_k == r.pv == pytest.approx(1e-4 * 0.1 / 1025)
    rng = np.random.default_rng(4)
    moving = [(s, e, x, *map(float, rng.normal(size=3)), 1020.0 - s + float(rng.normal()) / 9, -50.0 + 10 * s + e / 3, 1e-4, 1e-3, 1e-3) for s in range(4) for e in range(4) for x in range(4)]
    got = workloads.ertel_pv_parts(spark.createDataFrame(moving, schema), []).collect()
    assert all(r.pv == pytest.approx(r.pv_i + r.pv_j + r.pv_k) and r.pv_i and r.pv_j for r in got)
    still = workloads.ertel_pv(spark.createDataFrame(moving, schema).drop("w"), []).collect()
    assert len(still) == 64
