"""Whole jobs on fields whose answers are known, and streams against their batch forms."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from brinework.functions import vertical
from brinework.operators import filters, geo
from brinework.plans import workloads
from brinework.streaming import jobs

T0 = dt.datetime(2020, 1, 1)


def grid(spark, ny=6, nx=7, angle=0.0):
    rows = [(j, i, 20 + 0.1 * i, -35 + 0.1 * j, 1, 80.0, angle, 1e-3, 1e-3, -8e-5) for j in range(ny) for i in range(nx)]
    return spark.createDataFrame(rows, "eta int, xi int, lon double, lat double, mask int, h double, angle double, pm double, pn double, f double")


def test_tiers(spark):
    g = grid(spark, angle=1.5707963267948966)
    n = 5
    profile = lambda v: F.array(*[F.lit(float(v))] * n)
    scalars = g.select(F.lit(0).alias("time"), "eta", "xi", F.lit(0.0).alias("zeta"), F.array(*[F.col("xi") + F.col("eta") + 10.0 + k for k in range(n)]).alias("temp"))
    u = g.where("xi < 6").select(F.lit(0).alias("time"), "eta", F.col("xi").alias("xi_u"), profile(2).alias("u"))
    v = g.where("eta < 5").select(F.lit(0).alias("time"), F.col("eta").alias("eta_v"), "xi", profile(1).alias("v"))
    one = workloads.tier1(scalars, u, v, g, 5.0, 0.5, 10.0, n)
    row = one.where("eta = 2 and xi = 3").first()
    assert one.count() == 42 and row.u == pytest.approx([-1.0] * n) and row.v == pytest.approx([2.0] * n)
    two = workloads.tier2(one, ["temp", "u"], [row.z[2], -500.0], ["time", "eta", "xi"])
    got = {r.depth: r.temp for r in two.where("eta = 2 and xi = 3").collect()}
    assert got[row.z[2]] == pytest.approx(17.0) and got[-500.0] is None
    three = workloads.tier3(two.where("depth > -400"), g, 0.05, ["temp"], ["time", "depth"])
    for r in three.collect():
        assert r.temp == pytest.approx(12 + (r.lon - 20) * 10 + (r.lat + 35) * 10, abs=1e-6)
    near = workloads.tier3(two.where("depth > -400"), g, 0.1, ["temp"], ["time", "depth"], "nearest", 0.3)
    assert near.count() == 42
    with pytest.raises(ValueError):
        workloads.tier3(two, g, 0.1, ["temp"], [], "cubic")


def test_section_of_a_plane(spark):
    g = grid(spark, 30, 40).withColumns({"pm": F.lit(1 / 9112.0), "pn": F.lit(1 / 11113.0)}).withColumn("q", F.col("xi") + 2.0 * F.col("eta"))
    rows = workloads.section(spark, g, g, (20.5, -34.5, 22.0, -33.0), 20_000.0, ["q"], []).orderBy("point").collect()
    assert len(rows) > 5
    for r in rows:
        assert r.q == pytest.approx((r.lon - 20) * 10 + 2 * (r.lat + 35) * 10, abs=0.3)
    flow = workloads.section_velocity(spark.createDataFrame([(1.0, 0.0, 0.0)], "u double, v double, bearing double")).first()
    assert (flow.across, flow.along) == (-1.0, 0.0)


def test_potential_vorticity_of_resting_layers(spark):
    cells = grid(spark).withColumn("level", F.explode(F.array(*map(F.lit, range(5))))).withColumns(
        {"u": F.lit(0.0), "v": F.lit(0.0), "z": -50.0 + 10 * F.col("level"), "rho": 1026.0 - 0.1 * F.col("level")}
    )
    got = workloads.ertel_pv(cells, []).collect()
    assert all(r.pv == pytest.approx(-(-8e-5) * (-0.01) / vertical.RHO0) for r in got) and len(got) == 210


def test_gradient_on_sloping_levels(spark):
    """A field of depth alone has no gradient at constant depth."""
    cells = grid(spark).withColumn("level", F.explode(F.array(*map(F.lit, range(6))))).withColumn("z", -(60.0 + 2 * F.col("xi")) * (1 - F.col("level") / 6)).withColumn("q", 3 * F.col("z"))
    got = workloads.horizontal_gradient(cells, [], "q", "xi", "pm").collect()
    assert all(r.gradient is None or abs(r.gradient) < 1e-9 for r in got) and any(r.gradient is not None for r in got)


def test_model_levels_and_initial_state(spark):
    g = grid(spark)
    rows = [(t, d, j, i, None if (j + i) % 7 == 0 else 20 - d / 10 + t) for t in (0, 1) for d in (0.0, 50.0, 100.0) for j in range(9) for i in range(10)]
    source = spark.createDataFrame(rows, "t int, depth double, j int, i int, temp double")
    out = workloads.regrid_to_model(source, g, ["temp"], ["t"], 19.95, -35.05, 0.1, 5.0, 0.5, 10.0, 4)
    assert out.count() == 84
    for r in out.collect():
        assert r.temp == pytest.approx([20 + z / 10 + r.t for z in r.z])
    timed = out.withColumn("time", F.lit(T0) + F.make_dt_interval(F.col("t")))
    mid = workloads.initial_state(timed, "2020-01-01 06:00:00", ["temp"]).where("eta = 1 and xi = 1").first()
    first = out.where("eta = 1 and xi = 1 and t = 0").first()
    assert mid.temp == pytest.approx([x + 0.25 for x in first.temp])


def test_wind_onto_forcing(spark):
    base = spark.createDataFrame([(T0 + dt.timedelta(hours=h), 0, x, 1.0, 0.0, 0.0, 0.0) for h in (0, 6) for x in (0, 1)], "time timestamp, eta int, xi int, tair double, uwnd double, vwnd double, wspd double")
    wind = spark.createDataFrame([(T0 + dt.timedelta(hours=h), 5, k, float(h), 2.0) for h in (1, 5) for k in (0, 1)], "time timestamp, eta int, xi int, uwnd double, vwnd double")
    weights = spark.createDataFrame([(0, 5, 0, 1.0), (1, 5, 0, 0.5), (1, 5, 1, 0.5)], "out_cell bigint, eta int, xi int, w double")
    angle = spark.createDataFrame([(0, 0, 0.0, 0), (0, 1, 1.5707963267948966, 1)], "eta int, xi int, angle double, out_cell bigint")
    got = {(r.time.hour, r.xi): r for r in workloads.wind_onto_forcing(wind, base, weights, angle).collect()}
    assert (got[0, 0].uwnd, got[0, 0].vwnd) == (1.0, 2.0) and got[6, 0].uwnd == 5.0
    assert got[6, 1].uwnd == pytest.approx(2.0) and got[6, 1].vwnd == pytest.approx(-5.0) and got[6, 1].wspd == pytest.approx(29**0.5)


def test_filters(spark):
    assert filters.partition_variables(["temp", "u", "v", "zeta"]) == (["temp", "zeta"], [("u", "v")])
    assert filters.partition_variables(["ubar"], True) == ([], [("ubar", "vbar")])
    with pytest.raises(ValueError):
        filters.partition_variables(["u"])
    runs = spark.createDataFrame([(T0 - dt.timedelta(days=d), d) for d in range(6)], "run timestamp, d int")
    assert sorted(r.d for r in filters.run_window(runs, "run", "2020-01-01 06:00:00", 2).collect()) == [0, 1, 2]
    with pytest.raises(ValueError):
        filters.run_window(runs, "run", "2020-01-05", 2)
    one = spark.range(1)
    ask = lambda c: one.select(c.alias("x")).first().x
    assert ask(filters.stamp_of(F.lit("a/b_2020010206.nc"))) == dt.datetime(2020, 1, 2, 6) and ask(filters.stamp_of(F.lit("no.nc"))) is None
    assert ask(filters.parse_list(F.lit(" a, b,,c "))) == ["a", "b", "c"]
    assert ask(filters.level_slice(F.array(*map(F.lit, range(5))), (1, 3))) == [1, 2, 3]
    cut = filters.inside_cut(spark.createDataFrame([(0.5, 0.5, 1), (2.0, 0.5, 1)], "lon double, lat double, q int"), [(0, 0), (1, 0), (1, 1), (0, 1)], ["q"])
    assert [r.q for r in cut.collect()] == [None, 1]
    assert ask(geo.shift_longitude(F.lit(-10.0), 0.0)) == 350.0


def stream_of(spark, tmp_path, batches, schema):
    for k, rows in enumerate(batches):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(tmp_path / "in" / f"{k}"))
    return jobs.read_stream(spark, str(tmp_path / "in" / "*"), spark.createDataFrame([], schema).schema)


def finish(spark, df, tmp_path):
    jobs.run_to_table(df, str(tmp_path / "out"), str(tmp_path / "state"))
    return spark.read.schema(df.schema).parquet(str(tmp_path / "out")).collect()


def test_late_rows_are_dropped(spark, tmp_path):
    at = lambda day, hour, v: ("s", T0 + dt.timedelta(days=day, hours=hour), v)
    batches = [[at(0, 1, 1.0), at(0, 2, 3.0)], [at(5, 0, 9.0)], [at(5, 1, 9.0)], [at(0, 3, 100.0), at(9, 0, 1.0)]]
    events = jobs.as_events(stream_of(spark, tmp_path, batches, "site string, ts timestamp, v double"), "ts", "1 day")
    got = {r.day: (r.v, r.n) for r in finish(spark, jobs.daily_means(events, ["site"], "ts", "v"), tmp_path)}
    assert got == {"2020-01-01": (2.0, 2), "2020-01-06": (9.0, 2)}


def test_event_runs_in_a_stream(spark, tmp_path):
    series = [1] * 6 + [0] * 3 + [1] * 3 + [0, 1, 1, 0, 0, 1] + [0] * 7
    rows = [("s", k, float(2 * x - 1), T0 + dt.timedelta(days=k)) for k, x in enumerate(series)]
    batches = [rows[:4], rows[4:11], rows[11:20], rows[20:]]
    events = stream_of(spark, tmp_path, batches, "site string, position bigint, excess double, ts timestamp").withWatermark("ts", "0 days")
    got = sorted((r.first, r.last, r.length) for r in finish(spark, jobs.event_runs(events, "site", origin="2020-01-01"), tmp_path))
    assert got == [(0, 5, 6), (9, 17, 9)]


def test_model_records(spark):
    """A product that is uniform in space keeps its values on the levels, its direction on the grid and its depth mean."""
    depths = (5.0, 20.0, 60.0, 200.0)
    rows = [(t, d, j, i, 10.0 + t, 0.3 - d / 1000, 0.1) for t in (0, 1) for d in depths for j in range(12) for i in range(12)]
    source = spark.createDataFrame(rows, "t int, depth double, j int, i int, temp double, u double, v double")
    g = grid(spark, angle=1.5707963267948966)
    out = workloads.model_records(source, g, ["temp"], "u", "v", ["t"], 19.95, -35.05, 0.1, 5.0, 0.5, 10.0, 6)
    weights = {5.0: 12.5, 20.0: 27.5, 60.0: 90.0, 200.0: 70.0}
    mean = sum((0.3 - d / 1000) * w for d, w in weights.items()) / sum(weights.values())
    got = out.withColumn("um", vertical.depth_mean("u", "z_w")).withColumn("vm", vertical.depth_mean("v", "z_w")).collect()
    assert len(got) == 84 and {r.t for r in got} == {0, 1}
    for r in got:
        assert r.temp == pytest.approx([10.0 + r.t] * 6) and r.um == pytest.approx(0.1) and r.vm == pytest.approx(-mean)
    edge = workloads.boundary_records(out, 5, 6, ("north", "east"))
    assert {(r.side, n) for r, n in ((r, r["count"]) for r in edge.groupBy("side").count().collect())} == {("north", 14), ("east", 12)}
