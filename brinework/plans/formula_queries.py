"""Registered queries of formulas, profiles and cross-checks. Each stands beside its DuckDB SQL."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brinework.functions import functions_in_sql, physics, vertical
from brinework.operators import forcing, horizontal
from brinework.plans import workloads
from brinework.plans.field_queries import _cells, _with_levels
from brinework.plans.series_queries import query, r6
from brinework.sources.adaptors import GRID, HC, LEVELS, PROFILES, SITES, THETA_B, THETA_S, WIDTH, grid, profiles, sites, table

# the z_w levels of the profiles, as in the adaptors' SQL for the centres
W_LEVELS = """wc AS (SELECT k, k / 64::DOUBLE - 1 AS s FROM (SELECT unnest(range(65)) AS k)), wc1 AS (SELECT k, s, (exp(2 * ((1 - cosh(5 * s)) / (cosh(5) - 1) + 1)) - 1) / (exp(2) - 1) - 1 AS c FROM wc),
zw AS (SELECT cell, k, (20 * s + c * h) * h / (h + 20) + greatest(zeta, CAST(0.01 AS DOUBLE) - h) * (1 + (20 * s + c * h) / (h + 20)) AS z FROM profiles, wc1)"""


def _power(coefficients: tuple[float, ...], x: str) -> str:
    """A polynomial in plain powers."""
    return "(" + " + ".join(f"({c!r}::DOUBLE) * {x} ** {k}" for k, c in enumerate(coefficients)) + ")"


def _eos_sql(t: str, s: str, z: str, split: bool) -> str:
    """The model's equation of state as one expression."""
    e = {n: _power(c, t) for n, c in physics.MODEL_EOS.items()}
    ref = {n: _power(physics.MODEL_EOS[n], "3.8::DOUBLE") for n in ("k0", "k1", "ks")}
    rho = f"({e['r0']} - 1025 + {s} * {e['r1']} + {s} ** 1.5 * {e['rs']} + {s} ** 2 * {e['r2']})"
    k0 = f"({e['k0']} + {s} * {e['k1']} + {s} ** 1.5 * {e['ks']})"
    k_ref = f"({ref['k0']} + 34.5 * {ref['k1']} + 34.5::DOUBLE ** 1.5 * {ref['ks']})"
    if split:
        return f"{rho} + 0.1 * (1025 + {rho}) * (1 / (19092.56 + {k0}) - 1 / (19092.56 + {k_ref})) * {z} * (1 - 1.72e-5 * {z})"
    k1 = f"({e['b0']} + {s} * {e['b1']} + {s} ** 1.5 * {e['bs']})"
    return f"{rho} / (1 - 0.1 * {z} / (19092.56 + {k0} + {k1} * {z} + ({e['e0']} + {s} * {e['e1']}) * {z} ** 2))"


@query(f"WITH {PROFILES} SELECT cell, CAST(i AS INT) AS level, round({_eos_sql('temp', 'salt', 'z', True)}, 6) AS split, round({_eos_sql('temp', 'salt', 'z', False)}, 6) AS whole FROM water")
def model_densities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Density anomalies by the model's equation of state, with and without the split of compressibility."""
    rows = _with_levels(spark, sf_dir).select("cell", F.posexplode(F.arrays_zip("temp", "salt", "z")).alias("level", "v"))
    return rows.select("cell", "level", *[r6(physics.model_density("v.temp", "v.salt", "v.z", split=s), n) for s, n in ((True, "split"), (False, "whole"))])


@query(
    """SELECT event_id, round(value - 273.15, 6) AS celsius, round(value / 100, 6) AS fraction, round(CASE WHEN abs(value * 1e-7 * 8640) < 1e-4 THEN 0 ELSE value * 1e-7 * 8640 END, 6) AS rain_flux, round(value * 2.4::DOUBLE, 6) AS rain_mm,
round(CASE WHEN value - user_id < 1e-10 THEN 0 ELSE value - user_id END, 6) AS shortwave, round(value * 0.94::DOUBLE, 6) AS by_albedo, round(user_id - value, 6) AS longwave, round(0.0012 * 1.22 * value * user_id, 6) AS stress,
round(value * 111000 * cos(radians(-user_id / 5)), 4) AS dx, CAST(user_id * 111000 AS DOUBLE) AS dy FROM events"""
)
def forcing_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Units, net fluxes, wind stress and degrees to metres."""
    v, u = F.col("value"), F.col("user_id")
    dx, dy = physics.degrees_to_metres(v, u, -u / 5)
    return table(spark, sf_dir, "events").select(
        "event_id", r6(physics.kelvin_to_celsius(v), "celsius"), r6(physics.percent_to_fraction(v), "fraction"), r6(physics.rain_cm_per_day(v * 1e-7), "rain_flux"),
        r6(physics.rain_from_mm_per_hour(v), "rain_mm"), r6(physics.net_shortwave(v, u), "shortwave"), r6(physics.net_shortwave_by_albedo(v), "by_albedo"),
        r6(physics.net_longwave(u, v), "longwave"), r6(physics.wind_stress(v, u, F.lit(0.0012), F.lit(1.22)), "stress"), F.round(dx, 4).alias("dx"), F.round(dy, 4).alias("dy"),
    )


def _nodal_sql() -> str:
    """Corrected tides from the published formulas, each constituent by itself."""
    m = "sqrt((1 - 0.03731 * c + 0.00052 * c2) ** 2 + (0.03731 * s - 0.00052 * s2) ** 2)"
    mu = "atan((-0.03731 * s + 0.00052 * s2) / (1 - 0.03731 * c + 0.00052 * c2))"
    k1 = "sqrt((1 + 0.1158 * c - 0.0029 * c2) ** 2 + (0.1554 * s - 0.0029 * s2) ** 2)"
    k1u = "atan((-0.1554 * s + 0.0029 * s2) / (1 + 0.1158 * c - 0.0029 * c2))"
    waves = {
        "m2": (m, mu, 1.731557546, 12.4206), "s2": ("1", "0", 0.0, 12.0), "k1": (k1, k1u, 0.173003674, 23.9345),
        "o1": ("sqrt((1 + 0.189 * c - 0.0058 * c2) ** 2 + (0.189 * s - 0.0058 * s2) ** 2)", "radians(10.8 * s - 1.3 * s2 + 0.2 * s3)", 1.558553872, 25.8193),
        "mf": ("1.043 + 0.414 * c", "radians(-23.7 * s + 2.7 * s2 - 0.4 * s3)", 1.756042456, 327.8599),
        "m4": (f"({m}) ** 2", f"2 * {mu}", 3.463115091, 6.2103),
    }
    rows = " UNION ALL ".join(f"SELECT '{w}' AS wave, {f}::DOUBLE AS pf, {u}::DOUBLE AS pu, {a}::DOUBLE AS argument, {p}::DOUBLE AS period FROM n2" for w, (f, u, a, p) in waves.items())
    return f"""WITH n1 AS (SELECT radians((125.0445 - 0.05295377 * d) - 360 * floor((125.0445 - 0.05295377 * d) / 360)) AS n FROM (SELECT datediff('day', DATE '1858-11-17', DATE '2013-05-17') - 51544.4993 AS d)),
n2 AS (SELECT sin(n) AS s, cos(n) AS c, sin(2 * n) AS s2, cos(2 * n) AS c2, sin(3 * n) AS s3 FROM n1), w AS ({rows}), {SITES},
t AS (SELECT site, wave, (site % 40 + 1) / 10 * pf AS amp, site % 360 - degrees(argument + pu) - 360 * 24 * 7807 / period AS phase FROM sites, w)
SELECT site, wave, round(amp, 6) AS amp, round(phase - 360 * floor(phase / 360), 4) AS phase FROM t"""


@query(_nodal_sql())
def nodal_tides(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tides of six constituents at the sites, corrected for a date."""
    waves = ["m2", "s2", "k1", "o1", "mf", "m4"]
    factors = forcing.nodal_factors(spark, "2013-05-17", waves)
    k = F.col("site")
    rows = sites(spark, sf_dir).select("site", F.explode(F.array(*map(F.lit, waves))).alias("wave"), ((k % 40 + 1) / 10).alias("amp"), (k % 360).cast("double").alias("phase"))
    return forcing.corrected_tides(rows, factors, 24.0 * 7807).select("site", "wave", r6("amp"), F.round("phase", 4).alias("phase"))


@query(f"WITH {SITES}, c AS (SELECT site, (site % 40 + 1) / 10 AS a, site % 360 AS p FROM sites) SELECT site, round(a * cos(radians(p)), 6) + 0::DOUBLE AS re, round(a * sin(radians(p)), 6) + 0::DOUBLE AS im, round(a, 6) AS amplitude, CAST(p AS BIGINT) AS phase FROM c")
def amplitudes_and_phases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """To real and imaginary parts and back."""
    k = F.col("site")
    re, im = physics.to_real_imaginary((k % 40 + 1) / 10, (k % 360).cast("double"))
    rows = sites(spark, sf_dir).select("site", re.alias("re"), im.alias("im"))
    amplitude, phase = physics.to_amplitude_phase("re", "im")
    return rows.select("site", (F.round("re", 6) + 0.0).alias("re"), (F.round("im", 6) + 0.0).alias("im"), r6(amplitude, "amplitude"), (F.round(phase).cast("bigint") % 360).alias("phase"))


# profiles
@query(
    f"""WITH {PROFILES}, b AS (SELECT cell, count_if(z < -30) AS k, max(z) AS top FROM water GROUP BY ALL)
SELECT b.cell, round(CASE WHEN k > 0 AND top >= -30 THEN l.temp + (u.temp - l.temp) * (-30 - l.z) / (u.z - l.z) END, 6) AS temp
FROM b LEFT JOIN water l ON l.cell = b.cell AND l.i = k - 1 LEFT JOIN water u ON u.cell = b.cell AND u.i = k"""
)
def one_depth(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The strict form: null where no level lies below or none above."""
    return _with_levels(spark, sf_dir).select("cell", r6(vertical.at_depth_strict("temp", "z", F.lit(-30.0)), "temp"))


@query(
    f"""WITH {PROFILES}, g AS (SELECT cell, count(*) OVER () AS n, i, temp, -400 + 400 * i / 63::DOUBLE AS z FROM water), t AS (SELECT cell, i, z FROM water),
m AS (SELECT t.cell, t.i, t.z, least(greatest(CAST(ceil((t.z + 400) * 63 / 400) AS INT), 1), 63) AS k FROM t)
SELECT m.cell, CAST(m.i AS INT) AS level, round(CASE WHEN m.z <= -400 THEN lo.temp WHEN m.z >= 0 THEN hi.temp ELSE a.temp + (b.temp - a.temp) * (m.z - a.z) / (b.z - a.z) END, 6) AS temp
FROM m JOIN g a ON a.cell = m.cell AND a.i = m.k - 1 JOIN g b ON b.cell = m.cell AND b.i = m.k JOIN g lo ON lo.cell = m.cell AND lo.i = 0 JOIN g hi ON hi.cell = m.cell AND hi.i = 63"""
)
def depths_to_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Profiles on fixed depths moved to the model's levels; the end layers repeat."""
    fixed = F.transform(F.sequence(F.lit(0), F.lit(LEVELS - 1)), lambda i: -400 + 400 * i / (LEVELS - 1.0))
    moved = _with_levels(spark, sf_dir).withColumn("fixed", fixed).withColumn("moved", vertical.z_to_sigma("temp", "fixed", "z"))
    return moved.select("cell", F.posexplode("moved").alias("level", "temp")).select("cell", "level", r6("temp"))


@query(
    f"""WITH {PROFILES}, n AS (SELECT cell, i, temp, z, lead(temp) OVER w AS t1, lead(z) OVER w AS z1 FROM water WINDOW w AS (PARTITION BY cell ORDER BY i)),
g AS (SELECT cell, sum((t1 - temp) / (z1 - z)) AS gradient, sum((t1 + temp) / 2) AS middle FROM n WHERE t1 IS NOT NULL GROUP BY ALL),
e AS (SELECT cell, max(temp) FILTER (i = 0) + max(temp) FILTER (i = 63) AS ends, min(z) FILTER (i >= cell % 5) AS deepest FROM water GROUP BY ALL)
SELECT cell, round(middle, 6) AS at_rho, round(middle + ends, 6) AS at_w, round(gradient, 6) AS gradient, round(deepest - 0.5, 6) AS bottom FROM g JOIN e USING (cell)"""
)
def level_moves(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sums over a column of means between levels, of the same with ends, of gradients; the deepest level with a value."""
    total = lambda a: F.aggregate(a, F.lit(0.0), lambda x, y: x + y)
    holes = F.transform("temp", lambda x, i: F.when(i >= F.col("cell") % 5, x))
    return _with_levels(spark, sf_dir).select(
        "cell", r6(total(vertical.to_rho("temp")), "at_rho"), r6(total(vertical.to_w("temp")), "at_w"), r6(total(vertical.gradient("temp", "z")), "gradient"), r6(vertical.bottom_depth(holes, "z", 0.5), "bottom")
    )


@query(
    f"""WITH {PROFILES}, {W_LEVELS}, t AS (SELECT w.cell, w.i, w.temp, b.z - a.z AS d FROM water w JOIN zw a ON a.cell = w.cell AND a.k = w.i JOIN zw b ON b.cell = w.cell AND b.k = w.i + 1),
m AS (SELECT cell, sum(temp * d) / sum(d) AS mean FROM t GROUP BY ALL)
SELECT t.cell, CAST(i AS INT) AS level, round(temp - mean + h / 100, 6) AS moved FROM t JOIN m USING (cell) JOIN profiles USING (cell)"""
)
def conserved_transport(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Profiles less their depth mean, plus that of another source."""
    p = _with_levels(spark, sf_dir).withColumn("moved", vertical.conserve_transport("temp", "z_w", F.col("h") / 100))
    return p.select("cell", F.posexplode("moved").alias("level", "moved")).select("cell", "level", r6("moved"))


@query(
    f"""WITH {PROFILES}, m AS (SELECT vec_id % 50 AS cell, avg(vec_id % 7 / 10 - 0.3::DOUBLE) AS zeta FROM embeddings GROUP BY ALL),
k AS (SELECT cell, cell % 400 + 20::DOUBLE AS h, zeta, i, (20 * s + c * (cell % 400 + 20)) AS part FROM m, curve2)
SELECT CAST(cell AS INT) AS xi, CAST(i AS INT) AS level, round(part * h / (h + 20) + greatest(zeta, 0.01 - h) * (1 + part / (h + 20)), 6) AS z FROM k"""
)
def mean_level_depths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Levels under the mean sea surface of the records of each cell."""
    p = profiles(spark, sf_dir).select(F.lit(0).alias("eta"), (F.col("cell") % 50).cast("int").alias("xi"), "zeta")
    g = p.select("eta", "xi", (F.col("xi") % 400 + 20).cast("double").alias("h")).distinct()
    got = workloads.mean_level_depths(p, g, THETA_S, THETA_B, HC, LEVELS)
    return got.select("xi", F.posexplode("z").alias("level", "z")).select("xi", "level", r6("z"))


@query(
    f"""WITH {PROFILES}, {W_LEVELS}, r AS (SELECT cell, i, z, (999.842594 + 6.793952e-2 * temp - 9.095290e-3 * temp ** 2 + 1.001685e-4 * temp ** 3 - 1.120083e-6 * temp ** 4 + 6.536332e-9 * temp ** 5
+ (8.24493e-1 - 4.0899e-3 * temp + 7.6438e-5 * temp ** 2 - 8.2467e-7 * temp ** 3 + 5.3875e-9 * temp ** 4) * salt + (-5.72466e-3 + 1.0227e-4 * temp - 1.6546e-6 * temp ** 2) * salt ** 1.5 + 4.8314e-4 * salt ** 2) AS rho FROM water),
d AS (SELECT *, lead(z) OVER w - z AS dz, lead(rho) OVER w - rho AS dr, z - lag(z) OVER w AS bz, rho - lag(rho) OVER w AS br FROM r WINDOW w AS (PARTITION BY cell ORDER BY i)),
a AS (SELECT *, CASE WHEN bz IS NULL THEN dz WHEN dz IS NULL THEN bz ELSE 2 * dz * bz / (dz + bz) END AS hz, CASE WHEN br IS NULL THEN dr WHEN dr IS NULL THEN br WHEN dr + br = 0 THEN 0 ELSE 2 * dr * br / (dr + br) END AS hr FROM d),
s AS (SELECT cell, i, 0.5 * 9.81 / 1027 * ((rho + lead(rho) OVER w) * dz - 0.2 * ((lead(hr) OVER w - hr) * (dz - (lead(hz) OVER w + hz) / 24) - (lead(hz) OVER w - hz) * (dr - (lead(hr) OVER w + hr) / 24))) AS step FROM a WINDOW w AS (PARTITION BY cell ORDER BY i)),
t AS (SELECT r.cell, 9.81 * zw.z + 9.81 / 1027 * (r.rho + 0.5 * (r.rho - q.rho) * (zw.z - r.z) / (r.z - q.z)) * (zw.z - r.z) AS top FROM r JOIN r q ON q.cell = r.cell AND q.i = 62 JOIN zw ON zw.cell = r.cell AND k = 64 WHERE r.i = 63)
SELECT s.cell, CAST(s.i AS INT) AS level, round(top + coalesce(sum(step) OVER (PARTITION BY s.cell ORDER BY s.i DESC), 0), 6) AS pressure FROM s JOIN t USING (cell)"""
)
def pressure_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pressure over reference density at the levels, summed from the surface down."""
    p = vertical.with_pressure(_with_levels(spark, sf_dir), "rho", "z", "z_w")
    return _cells(p, pressure=F.col("pressure"))


@query(
    """WITH v AS (SELECT vec_id AS cell, i, CAST(embedding[i + 1] AS DOUBLE) AS x FROM embeddings, (SELECT unnest(range(64)) AS i)), k AS (SELECT unnest(range(64)) AS k),
f AS (SELECT cell, k, sum(x * cos(2 * pi() * i * (k - 32) / 64)) AS re, sum(x * sin(2 * pi() * i * (k - 32) / 64)) AS im FROM v, k GROUP BY ALL)
SELECT cell, k, round((k - 32) / 64::DOUBLE / 2, 6) AS frequency, round((re * re + im * im) * 4, 4) AS power FROM f"""
)
def profile_spectrum(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The spectrum of evenly spaced values two metres apart."""
    v = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("cell"), "embedding")
    return horizontal.power_spectrum(v, ["cell"], "embedding", 2.0).select("cell", "k", r6("frequency"), F.round("power", 4).alias("power"))


@query(
    """WITH v AS (SELECT vec_id AS cell, y, x, CAST(embedding[8 * y + x + 1] AS DOUBLE) AS v FROM embeddings, (SELECT unnest(range(8)) AS y), (SELECT unnest(range(8)) AS x)), m AS (SELECT cell, avg(v) AS m FROM v GROUP BY ALL),
k AS (SELECT j, i FROM (SELECT unnest(range(8)) AS j), (SELECT unnest(range(8)) AS i)),
f AS (SELECT cell, j, i, sum((v - m) * cos(2 * pi() * (y * (j - 4) + x * (i - 4)) / 8)) AS re, sum((v - m) * sin(2 * pi() * (y * (j - 4) + x * (i - 4)) / 8)) AS im FROM v JOIN m USING (cell), k GROUP BY ALL)
SELECT cell, j, i, round((j - 4) / 8::DOUBLE, 6) AS frequency_y, round((i - 4) / 8::DOUBLE / 3, 6) AS frequency_x, round((re * re + im * im) * 9, 4) AS power FROM f"""
)
def field_spectrum(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The spectrum of small fields over both axes, less their means."""
    rows = F.transform(F.sequence(F.lit(0), F.lit(7)), lambda j: F.slice("embedding", j * 8 + 1, 8))
    v = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("cell"), rows.alias("rows"))
    got = horizontal.power_spectrum_2d(v, ["cell"], "rows", (1.0, 3.0), "constant")
    return got.select("cell", "j", "i", r6("frequency_y"), r6("frequency_x"), F.round("power", 4).alias("power"))


@query(
    f"""WITH {PROFILES}, {W_LEVELS}, c AS (SELECT w.cell, CAST(w.cell // {WIDTH} AS INT) AS eta, CAST(w.cell % {WIDTH} AS INT) AS xi, w.i, 0.01 * (w.cell // {WIDTH}) AS angle, p.h, temp / 10 AS u, salt / 100 AS v, b.z - a.z AS d
FROM water w JOIN profiles p USING (cell) JOIN zw a ON a.cell = w.cell AND a.k = w.i JOIN zw b ON b.cell = w.cell AND b.k = w.i + 1),
t AS (SELECT *, u * cos(angle) + v * sin(angle) AS uu, v * cos(angle) - u * sin(angle) AS vv FROM c), m AS (SELECT cell, sum(uu * d) / sum(d) AS um, sum(vv * d) / sum(d) AS vm FROM t GROUP BY ALL),
s AS (SELECT *, unnest(list_filter([CASE WHEN eta = 0 THEN 'south' END, CASE WHEN xi = {WIDTH - 1} THEN 'east' END, CASE WHEN xi = 0 THEN 'west' END], lambda x: x IS NOT NULL)) AS side FROM t)
SELECT side, eta, xi, CAST(i AS INT) AS level, round(uu - um + h / 1000, 6) AS u, round(vv - vm - h / 1000, 6) AS v FROM s JOIN m USING (cell)"""
)
def boundary_velocities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Velocities at three open boundaries, turned to the grid and shifted to given depth means."""
    p = _with_levels(spark, sf_dir).select(
        F.floor(F.col("cell") / WIDTH).cast("int").alias("eta"), (F.col("cell") % WIDTH).cast("int").alias("xi"), (0.01 * F.floor(F.col("cell") / WIDTH)).alias("angle"), "z_w",
        F.transform("temp", lambda x: x / 10).alias("u"), F.transform("salt", lambda x: x / 100).alias("v"), (F.col("h") / 1000).alias("ubar"), (-F.col("h") / 1000).alias("vbar"),
    )
    edge = workloads.boundary_records(p, -1, WIDTH - 1, ("south", "east", "west"))
    got = workloads.turned_and_corrected(edge, ubar="ubar", vbar="vbar")
    return got.select("side", "eta", "xi", F.posexplode(F.arrays_zip("u", "v")).alias("level", "x")).select("side", "eta", "xi", "level", r6("x.u", "u"), r6("x.v", "v"))


@query(
    f"""WITH {GRID}, s AS (SELECT eta AS j, xi AS i, d AS depth, CASE WHEN mask = 1 OR d < 50 THEN value - d / 100 END AS temp FROM grid, (SELECT unnest([5.0, 20.0, 60.0, 200.0]::DOUBLE[]) AS d)),
w AS (SELECT *, (coalesce(lead(depth) OVER k, depth) - coalesce(lag(depth) OVER k, -depth)) / 2 AS d FROM s WINDOW k AS (PARTITION BY j, i ORDER BY depth))
SELECT j, i, round(sum(temp * d) / sum(CASE WHEN temp IS NOT NULL THEN d END), 6) AS temp FROM w GROUP BY ALL"""
)
def product_depth_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Means of a product over its own depths."""
    d = F.col("depth")
    source = grid(spark, sf_dir).withColumn("depth", F.explode(F.array(*map(F.lit, (5.0, 20.0, 60.0, 200.0))))).select(
        F.col("eta").alias("j"), F.col("xi").alias("i"), "depth", F.when((F.col("mask") == 1) | (d < 50), F.col("value") - d / 100).alias("temp")
    )
    return workloads.depth_means(source, ["temp"], []).select("j", "i", r6("temp"))


# stencils and groups
@query(
    f"""WITH {GRID}, m AS (SELECT max(eta) AS e, max(xi) AS x FROM grid), p AS (SELECT eta AS eta_v, xi AS xi_u, value FROM grid, m WHERE eta < e AND xi < x),
i AS (SELECT g.eta, g.xi, avg(p.value) AS value FROM grid g JOIN p ON p.eta_v IN (g.eta - 1, g.eta) AND p.xi_u IN (g.xi - 1, g.xi), m WHERE g.eta BETWEEN 1 AND e - 1 AND g.xi BETWEEN 1 AND x - 1 GROUP BY ALL)
SELECT g.eta, g.xi, round(i.value, 6) AS value FROM grid g, m JOIN i ON i.eta = greatest(1, least(e - 1, g.eta)) AND i.xi = greatest(1, least(x - 1, g.xi))"""
)
def psi_to_centres(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Corner points to centres; border cells copy the nearest inner one."""
    g = grid(spark, sf_dir)
    m = g.agg(F.max("eta").alias("e"), F.max("xi").alias("x")).first()
    psi = g.where((F.col("eta") < m.e) & (F.col("xi") < m.x)).select(F.col("eta").alias("eta_v"), F.col("xi").alias("xi_u"), "value")
    return horizontal.psi_to_rho(psi, g, m.e, m.x).select("eta", "xi", r6("value"))


@query(
    f"""WITH RECURSIVE {GRID}, c AS (SELECT eta, xi, eta * 4294967296 + xi AS node FROM grid WHERE mask = 0),
e AS (SELECT a.node AS a, b.node AS b FROM c a JOIN c b ON abs(a.eta - b.eta) <= 1 AND abs(a.xi - b.xi) <= 1),
r(a, b) AS (SELECT a, b FROM e UNION SELECT r.a, e.b FROM r JOIN e ON e.a = r.b)
SELECT c.eta, c.xi, min(r.b) AS "group" FROM c JOIN r ON r.a = c.node GROUP BY ALL"""
)
def wet_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of connected land cells of the grid."""
    return forcing.connected_groups(grid(spark, sf_dir).where("mask = 0").select("eta", "xi"))


# cross-checks of the ways to run a formula
@query(
    """WITH d AS (SELECT user_id, value, event_id % 97 AS other FROM events) SELECT user_id, round(corr(value, other), 6) AS built_in, round(corr(value, other), 6) AS grouped FROM d GROUP BY ALL HAVING count(*) > 2"""
)
def correlation_two_ways(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A grouped pandas_udf beside the built-in aggregate: the cross-check of a statistic."""

    @F.pandas_udf("double")
    def by_pandas(x: pd.Series, y: pd.Series) -> float:
        return x.corr(y)

    d = table(spark, sf_dir, "events").select("user_id", "value", (F.col("event_id") % 97).cast("double").alias("other"))
    many = d.groupBy("user_id").agg(F.count(F.lit(1)).alias("n"), F.corr("value", "other").alias("built_in"))
    grouped = d.groupBy("user_id").agg(by_pandas("value", "other").alias("grouped"))
    return many.where("n > 2").join(grouped, "user_id").select("user_id", r6("built_in"), r6("grouped"))


@query(
    f"""WITH {SITES}, p AS (SELECT site, unnest(range(5)) AS point, radians(lat) AS a, radians(lon) AS o FROM sites),
h AS (SELECT site, point, a, o, atan2(cos(radians(-30)) * sin(radians(20) - o), cos(a) * sin(radians(-30)) - sin(a) * cos(radians(-30)) * cos(radians(20) - o)) AS h, point * 25000 / 6367442.76 AS s FROM p),
l AS (SELECT *, asin(sin(a) * cos(s) + cos(a) * sin(s) * cos(h)) AS y FROM h)
SELECT site, CAST(point AS INT) AS point, round(degrees(o + atan2(sin(h) * sin(s) * cos(a), cos(s) - sin(a) * sin(y))), 6) AS lon, round(degrees(y), 6) AS lat FROM l"""
)
def paths_by_table_function(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The points of a path from every site by a table function in SQL."""
    functions_in_sql.register(spark)
    sites(spark, sf_dir).createOrReplaceTempView("path_starts")
    got = spark.sql("SELECT site, p.point, p.lon, p.lat FROM path_starts, LATERAL path_points(path_starts.lon, path_starts.lat, 20D, -30D, 25000D, 5) p")
    return got.select("site", "point", r6("lon"), r6("lat"))


@query(f"WITH {PROFILES} SELECT cell, CAST(i AS INT) AS level, round(999.842594 + 6.793952e-2 * temp - 9.095290e-3 * temp ** 2 + 1.001685e-4 * temp ** 3 - 1.120083e-6 * temp ** 4 + 6.536332e-9 * temp ** 5"
    " + (8.24493e-1 - 4.0899e-3 * temp + 7.6438e-5 * temp ** 2 - 8.2467e-7 * temp ** 3 + 5.3875e-9 * temp ** 4) * salt + (-5.72466e-3 + 1.0227e-4 * temp - 1.6546e-6 * temp ** 2) * salt ** 1.5 + 4.8314e-4 * salt ** 2, 6) AS density FROM water")  # fmt: skip
def density_by_sql_function(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Surface density by the formula as a function in SQL."""
    functions_in_sql.register(spark)
    rows = profiles(spark, sf_dir).select("cell", F.posexplode(F.arrays_zip("temp", "salt")).alias("level", "v"))
    return rows.select("cell", "level", F.round(F.expr("eos80(v.temp, v.salt, 0D)"), 6).alias("density"))
