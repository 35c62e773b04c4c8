"""Vertical profiles, stencils, sites and forcing against numpy and plain Python."""

import datetime as dt
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from brinework.functions import physics, vertical
from brinework.operators import forcing, geo, horizontal, validate
from brinework.sources import io

RNG = np.random.default_rng(0)


def one(spark, **columns):
    df = spark.range(1)
    return lambda c: df.select(*[F.array(*map(F.lit, v)).alias(k) if isinstance(v, list) else F.lit(v).alias(k) for k, v in columns.items()]).select(c.alias("r")).first().r


@pytest.mark.parametrize("vtransform", [1, 2])
@pytest.mark.parametrize("points", ["rho", "w"])
def test_level_depths(spark, vtransform, points):
    h, zeta, ts, tb, hc, n = 80.0, 0.4, 6.0, 0.8, 10.0, 12
    sc = np.linspace(-1, 0, n + 1) if points == "w" else (np.arange(1, n + 1) - n - 0.5) / n
    if vtransform == 2:
        c = (1 - np.cosh(ts * sc)) / (np.cosh(ts) - 1)
        c = (np.exp(tb * (c + 1)) - 1) / (np.exp(tb) - 1) - 1
        part = hc * sc + c * h
        want = part * h / (h + hc) + zeta * (1 + part / (h + hc))
    else:
        c = (1 - tb) * np.sinh(ts * sc) / np.sinh(ts) + tb * (np.tanh(ts * (sc + 0.5)) / (2 * np.tanh(0.5 * ts)) - 0.5)
        part = hc * (sc - c) + c * h
        want = part + zeta * (1 + part / h)
    got = one(spark, h=h, zeta=zeta)(vertical.level_depths("h", "zeta", ts, tb, hc, n, points, vtransform))
    assert got == pytest.approx(want)
    if points == "w":
        assert got[0] == pytest.approx(-h) and got[-1] == pytest.approx(zeta)


def test_interpolation_at_depths(spark):
    ask = one(spark, v=[1.0, 3.0, 7.0, 4.0], z=[-40.0, -20.0, -10.0, -1.0])
    for depth, want in ((-50, None), (-40, 1.0), (-30, 2.0), (-20, 3.0), (-15, 5.0), (-1, 4.0), (0, 4 - 1 / 3)):
        got = ask(vertical.at_depth("v", "z", float(depth)))
        assert got == (None if want is None else pytest.approx(want))
    assert ask(vertical.at_depth("v", "z", -50.0, bottom=True)) == 1.0
    assert ask(vertical.at_depth("v", "z", -15.0, "nearest")) == 7.0
    assert ask(vertical.at_depth_strict("v", "z", 0.0)) is None and ask(vertical.at_depth_strict("v", "z", -40.0)) is None
    assert ask(vertical.at_surface_of("z", "v", 5.0)) == pytest.approx(-15.0)
    assert ask(vertical.z_to_sigma("v", "z", F.array(*map(F.lit, (-60.0, -30.0, 5.0))))) == pytest.approx([1.0, 2.0, 4.0])
    assert ask(vertical.gradient("v", "z")) == pytest.approx([0.1, 0.4, -1 / 3])
    assert ask(vertical.to_w("v")) == pytest.approx([1, 2, 5, 5.5, 4])


def test_integrals_and_transport(spark):
    ask = one(spark, v=[1.0, 3.0, 7.0], w=[-30.0, -20.0, -5.0, 0.0])
    assert ask(vertical.integral("v", "w")) == 10 + 45 + 35
    part, thick = vertical.integral_between("v", "w", -25.0, -2.0)
    assert (ask(part), ask(thick)) == (5 + 45 + 21, 23)
    moved = ask(vertical.conserve_transport("v", "w", 4.0))
    assert sum(m * d for m, d in zip(moved, (10, 15, 5))) / 30 == pytest.approx(4.0)


def test_mixed_water_has_no_stratification(spark):
    ask = one(spark, t=[15.0] * 4, s=[35.0] * 4, z=[-60.0, -40.0, -10.0, -1.0])
    rho = lambda a, b: physics.eos80_density(a, b, F.lit(0.0))
    assert ask(vertical.stratification(rho, "t", "s", "z")) == pytest.approx(0, abs=1e-9)


def test_density_check_values(spark):
    """Published check values of the equation of state."""
    ask = one(spark, x=1.0)
    for t, s, p, want in ((5, 0, 0, 999.96675), (5, 35, 0, 1027.67547), (25, 35, 10000, 1062.53817), (5, 35, 10000, 1069.48914)):
        assert ask(physics.eos80_density(float(t), float(s), float(p))) == pytest.approx(want, abs=1e-4)
    split = ask(physics.model_density(10.0, 35.0, -100.0))
    full = ask(physics.model_density(10.0, 35.0, -100.0, split=False))
    assert 1.9 < split < 3 and 1.9 < full < 3


def test_uniform_pressure(spark):
    """A uniform density gives g z (1 + rho / rho0) from the surface down."""
    df = spark.createDataFrame([([5.0] * 4, [-35.0, -25.0, -15.0, -5.0], [-40.0, -30.0, -20.0, -10.0, 0.0])], "rho array<double>, z array<double>, w array<double>")
    got = vertical.with_pressure(df, "rho", "z", "w").first().pressure
    assert got == pytest.approx([9.81 / 1027 * 5 * d for d in (35, 25, 15, 5)], rel=1e-6)


def test_vectors(spark):
    ask = one(spark, u=1.3, v=-0.4, a=0.7)
    e, n = physics.rotate("u", "v", "a")
    back = physics.rotate_to_grid(e, n, "a")
    assert (ask(back[0]), ask(back[1])) == (pytest.approx(1.3), pytest.approx(-0.4))
    assert ask(physics.great_circle(0.0, 170.0, 0.0, -170.0)) == pytest.approx(physics.RADIUS_SECTION * math.radians(20))
    assert ask(physics.haversine(10.0, 20.0, -5.0, 40.0)) == pytest.approx(ask(physics.arc_cosine_distance(10.0, 20.0, -5.0, 40.0)))
    re, im = physics.to_real_imaginary(2.0, 30.0)
    amp, phase = physics.to_amplitude_phase(re, im)
    assert (ask(amp), ask(phase)) == (pytest.approx(2.0), pytest.approx(30.0))
    got = physics.tidal_ellipse(1.0, 0.0, 1.0, 90.0)
    assert (ask(got["semi_major"]), abs(ask(got["eccentricity"]))) == (pytest.approx(1.0), pytest.approx(1.0))
    assert ask(physics.unpack(F.lit(-32000), 0.1, 5.0, -32767.0)) is None and ask(physics.unpack(F.lit(10), 0.1, 5.0, -32767.0)) == 6.0


def cells(spark, ny=4, nx=5, land=((0, 0), (3, 4))):
    rows = [(j, i, 20 + 0.5 * i, -35 + 0.4 * j, 0 if (j, i) in land else 1, 100.0 + j + i, 0.0, 1e-3, 1e-3, float(j * j + 2 * i)) for j in range(ny) for i in range(nx)]
    return spark.createDataFrame(rows, "eta int, xi int, lon double, lat double, mask int, h double, angle double, pm double, pn double, value double")


def test_stencils(spark):
    g = cells(spark)
    u = spark.createDataFrame([(j, i, float(i)) for j in range(4) for i in range(4)], "eta int, xi_u int, value double")
    got = {(r.eta, r.xi): r.value for r in horizontal.staggered_to_rho(u, ["eta"], "xi_u", "xi", F.lit(4)).collect()}
    assert [got[1, i] for i in range(5)] == [0, 0.5, 1.5, 2.5, 3]
    arrays = u.select("eta", "xi_u", F.array("value", F.col("value") + 1).alias("value"))
    got = {(r.eta, r.xi): r.value for r in horizontal.arrays_to_rho(arrays, ["eta"], "xi_u", "xi").collect()}
    assert got[2, 1] == [0.5, 1.5] and got[2, 4] == [3, 4]
    psi = horizontal.rho_to_staggered(g.select("eta", "xi", "value"), [], "psi")
    back = {(r.eta, r.xi): r.value for r in horizontal.psi_to_rho(psi, g, 3, 4).collect()}
    assert len(back) == 20 and back[0, 0] == back[1, 1] and back[3, 4] == back[2, 3]
    near = {(r.eta, r.xi): r.land for r in horizontal.land_neighbours(g).collect()}
    assert near[0, 1] == near[1, 0] == near[3, 3] == 1 and near[1, 1] == 0
    eight = {(r.eta, r.xi): r.land for r in horizontal.land_neighbours(g, corners=True).collect()}
    assert eight[1, 1] == 1


def test_linear_regridding_is_exact_on_planes(spark):
    g = cells(spark, 8, 9, ()).withColumn("value", 3 * F.col("lon") - 2 * F.col("lat") + 1)
    targets = horizontal.regular_cells(horizontal.regular_axis(g, 0.3), 0.3)
    weights = horizontal.triangle_weights(g, targets, 0.7)
    got = horizontal.apply_weights(g, weights, [], ["value"]).join(targets, "out_cell").collect()
    assert len(got) > 50 and all(r.value == pytest.approx(3 * r.lon - 2 * r.lat + 1) for r in got)


def test_nearest_cell(spark):
    g = cells(spark)
    sites = spark.createDataFrame([(1, 20.0, -35.0), (2, 20.25, -34.6), (3, 50.0, -35.0), (4, 21.1, -34.9)], "site int, lon double, lat double")
    plain = {}
    grid_rows = g.collect()
    for s in sites.collect():
        plain[s.site] = min(((round(math.hypot(r.lon - s.lon, r.lat - s.lat), 12), r.eta, r.xi) for r in grid_rows if r.mask == 1))[1:]
    got = {r.site: (r.eta, r.xi) for r in geo.nearest_cell(sites, g).collect()}
    assert got == plain
    with pytest.raises(ValueError):
        geo.nearest_cell(sites, g, min_depth=1e6)


def test_bilinear(spark):
    g = cells(spark)
    p = spark.createDataFrame([(1, 1.0, 2.0), (2, 1.5, 2.5), (3, 3.5, 1.0), (4, 3.0, 4.0)], "k int, eta_frac double, xi_frac double")
    got = {r.k: r.value for r in geo.bilinear(p, g, "value", ["k"]).collect()}
    assert got[1] == 5.0 and got[2] == pytest.approx((5 + 7 + 8 + 10) / 4) and got[3] is None and got[4] == 17.0


def test_ring_and_strips(spark):
    ring = [(r.eta, r.xi) for r in geo.boundary_ring(cells(spark)).orderBy("ring").collect()]
    assert ring[:4] == [(0, 0), (1, 0), (2, 0), (3, 0)] and len(ring) == 14 and ring[-1] == (0, 1)
    strips = geo.open_boundaries(cells(spark), 3, 4, ("south", "east")).collect()
    assert sorted((r.side, r.eta, r.xi) for r in strips if r.side == "east") == [("east", j, 4) for j in range(4)]
    assert sum(r.side == "south" for r in strips) == 5


def test_section(spark):
    pts = geo.section_points(spark, 15.0, -35.0, 18.0, -33.0, 40_000.0).orderBy("point").collect()
    assert len(pts) == int(geo.great_circle_length(15.0, -35.0, 18.0, -33.0) // 40_000) + 1
    assert (pts[0].lon, pts[0].lat) == (pytest.approx(15.0), pytest.approx(-35.0))
    for a, b in zip(pts, pts[1:]):
        assert geo.great_circle_length(a.lon, a.lat, b.lon, b.lat) == pytest.approx(40_000, rel=1e-6)
    with pytest.raises(ValueError):
        geo.section_points(spark, 15.0, -35.0, 15.001, -35.0, 40_000.0)


def test_connected_groups(spark):
    picture = ["##.....#", "..#....#", "........", "#.#.####", "#......."]
    rows = [(j, i, float(j * 10 + i)) for j, line in enumerate(picture) for i, c in enumerate(line) if c == "#"]
    flow = spark.createDataFrame(rows, "eta int, xi int, flow double")
    got = forcing.connected_groups(flow).collect()
    sizes = sorted(sum(r.group == g for r in got) for g in {r.group for r in got})
    assert sizes == [1, 2, 2, 3, 4]
    assert len(forcing.mouths_of_groups(flow).collect()) == 5


def test_rivers(spark):
    g = cells(spark, 6, 6, tuple((j, 0) for j in range(6)))
    rivers = spark.createDataFrame([("on land", 20.0, -34.2), ("coast", 20.5, -33.8), ("open", 21.6, -34.2), ("far", 60.0, 0.0)], "river string, lon double, lat double")
    got = {r.river: (r.eta, r.xi, r.axis, r.sign) for r in forcing.river_mouths(rivers, g).collect()}
    assert sorted(got) == ["coast", "on land", "open"]
    assert got["coast"] == (3, 1, 0, 1) and got["on land"][1] == got["open"][1] == 1
    t0 = dt.datetime(2020, 1, 1)
    flow = spark.createDataFrame([("r", t0 + dt.timedelta(hours=6 * k), float(k)) for k in range(9)], "river string, time timestamp, flow double")
    hourly = forcing.river_on_axis(flow, ["river"], "2019-12-31 22:00:00", "2020-01-01 12:00:00", "hourly").orderBy("time").collect()
    assert hourly[0].flow == 0.0 and hourly[2 + 3].flow == pytest.approx(0.5)
    daily = forcing.river_on_axis(flow, ["river"], "2020-01-01", "2020-01-03", "daily").orderBy("time").collect()
    assert [r.flow for r in daily] == [0.5, 4.0, 7.5]


def test_tides(spark):
    f = {r.wave: r for r in forcing.nodal_factors(spark, "2020-03-01").collect()}
    assert f["s2"].pf == 1 and f["s2"].pu == 0
    assert 0.96 < f["m2"].pf < 1.04 and 0.8 < f["o1"].pf < 1.2 and f["m4"].pf == pytest.approx(f["m2"].pf ** 2)
    h = spark.createDataFrame([("s2", 2.0, 10.0), ("m2", 1.0, 350.0)], "wave string, amp double, phase double")
    got = {r.wave: r for r in forcing.corrected_tides(h, forcing.nodal_factors(spark, "2020-03-01"), 0.0).collect()}
    assert got["s2"].amp == 2.0 and got["s2"].phase == pytest.approx(10.0) and 0 <= got["m2"].phase < 360


def test_statistics(spark):
    x, y = RNG.normal(size=50), RNG.normal(size=50)
    df = spark.createDataFrame([(0, float(a), float(b)) for a, b in zip(x, y)] + [(0, None, 1.0), (1, 1.0, 2.0)], "k int, model double, obs double")
    got = {r.k: r for r in validate.paired_statistics(df, ["k"]).collect()}
    d = (x - x.mean()) - (y - y.mean())
    assert got[0].rmse == pytest.approx(math.sqrt((d**2).mean())) and got[0].corr == pytest.approx(np.corrcoef(x, y)[0, 1]) and got[0].n == 50
    assert got[0].mae == pytest.approx(np.abs(x - y).mean()) and got[1].n == 1 and got[1].rmse is None


def test_spectrum(spark):
    """The transform times the spacing, squared; trends and windows only when asked for."""
    x = RNG.normal(size=(3, 16))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "series int, v array<double>").union(
        spark.createDataFrame([(9, [1.0]), (10, None), (11, [1.0, None])], "series int, v array<double>")
    )
    got = horizontal.power_spectrum(df, ["series"], "v", 0.5).orderBy("series", "k").collect()
    want = np.fft.fftshift(np.abs(np.fft.fft(x, axis=1)) ** 2 * 0.25, axes=1)
    assert [r.power for r in got] == pytest.approx(want.ravel().tolist())
    assert [r.frequency for r in got[:16]] == pytest.approx(np.fft.fftshift(np.fft.fftfreq(16, 0.5)).tolist())
    t = np.arange(16)
    plain = x - np.array([np.polyval(np.polyfit(t, v, 1), t) for v in x])
    hann = 0.5 - 0.5 * np.cos(2 * np.pi * t / 16)
    got = horizontal.power_spectrum(df, ["series"], "v", detrend="linear", window="hann", true_amplitude=False).orderBy("series", "k").collect()
    assert [r.power for r in got] == pytest.approx(np.fft.fftshift(np.abs(np.fft.fft(plain * hann, axis=1)) ** 2, axes=1).ravel().tolist())
    with pytest.raises(ValueError):
        horizontal.power_spectrum(df, ["series"], "v", window="box")


def test_spectrum_of_fields(spark):
    x = RNG.normal(size=(2, 6, 5))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)] + [(7, [[1.0], [1.0, 2.0]])], "f int, v array<array<double>>")
    got = horizontal.power_spectrum_2d(df, ["f"], "v", (2.0, 3.0)).orderBy("f", "j", "i").collect()
    assert [r.power for r in got] == pytest.approx(np.fft.fftshift(np.abs(np.fft.fft2(x)) ** 2 * 36, axes=(1, 2)).ravel().tolist())
    j, i = np.meshgrid(np.arange(6), np.arange(5), indexing="ij")
    plane = spark.createDataFrame([(0, (1 + 2.0 * j - 0.5 * i).tolist())], "f int, v array<array<double>>")
    assert max(r.power for r in horizontal.power_spectrum_2d(plane, ["f"], "v", detrend="linear").collect()) < 1e-18


def test_files(spark, tmp_path):
    (tmp_path / "sites.csv").write_text("# name, lon, lat\nA, 18.1, -34\n\n B ,18.2,-34.5\n")
    assert sorted(tuple(r) for r in io.read_sites(spark, str(tmp_path / "sites.csv")).collect()) == [("A", 18.1, -34.0), ("B", 18.2, -34.5)]
    for bad in ("A,1\n", "A,1,2\nA,3,4\n", "# none\n", "A,x,2\n"):
        (tmp_path / "bad.csv").write_text(bad)
        with pytest.raises(ValueError):
            io.read_sites(spark, str(tmp_path / "bad.csv"))
    (tmp_path / "river.txt").write_text("2020-01-05 00:00:00 3.5\n06/01/2020 12:00:00 4\nno\n2021-01-05 00:00:00 9\n")
    assert sorted(r.flow for r in io.read_river(spark, str(tmp_path / "river.txt"), "2020-01-01", "2020-02-01").collect()) == [3.5, 4.0]
    df = spark.createDataFrame([(dt.date(2020, 1, 1), 1.0), (dt.date(2020, 2, 1), 2.0)], "day date, v double")
    path = str(tmp_path / "out")
    io.write_products(df, path)
    io.write_products(df.where("day > '2020-01-15'").withColumn("v", F.lit(9.0)), path)
    assert sorted(r.v for r in spark.read.parquet(path).collect()) == [1.0, 9.0]
    with pytest.raises(ValueError):
        io.append_columns(df, df.limit(1), ["day"])
    assert io.append_columns(df, df.select("day", F.lit(1).alias("n")), ["day"]).columns == ["day", "v", "n"]
    with pytest.raises(ValueError):
        io.rename_product(df, "none")
    with pytest.raises(ValueError):
        io.read_fields(spark, path, ["w"], ["day"])
    clean = io.nulls_for_fills(spark.createDataFrame([(float("nan"), -127), (1.0, 2)], "a double, b int"), ["a", "b"]).collect()
    assert [tuple(r) for r in clean] == [(None, None), (1.0, 2)]
