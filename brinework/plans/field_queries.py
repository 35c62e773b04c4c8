"""Registered queries on grids, profiles and sites. Each stands beside its DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brinework.functions import physics, vertical
from brinework.operators import forcing, geo, horizontal
from brinework.plans.series_queries import query, r6
from brinework.sources.adaptors import (
    GRID,
    HC,
    LEVELS,
    PROFILES,
    SITES,
    THETA_B,
    THETA_S,
    WIDTH,
    grid,
    profiles,
    sites,
    table,
)

NEAREST = f"""{GRID}, {SITES},
pairs AS (SELECT s.site, s.lon, s.lat, g.eta, g.xi, round(sqrt((g.lon - s.lon) ** 2 + (g.lat - s.lat) ** 2), 12) AS d FROM sites s, grid g WHERE g.mask = 1),
near AS (SELECT site, lon, lat, eta, xi, d FROM pairs QUALIFY row_number() OVER (PARTITION BY site ORDER BY d, eta, xi) = 1)"""


def _nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return geo.nearest_cell(sites(spark, sf_dir), grid(spark, sf_dir))


@query(f"WITH {NEAREST} SELECT site, eta, xi, round(d, 6) AS dist FROM near")
def nearest_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _nearest(spark, sf_dir).select("site", "eta", "xi", r6("dist"))


@query(f"WITH {NEAREST} SELECT n.site, CAST(k AS INT) AS time, round(g.value + k, 6) AS value FROM near n JOIN grid g USING (eta, xi), (SELECT unnest(range(3)) AS k)")
def series_at_sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    field = grid(spark, sf_dir).select("eta", "xi", "value").withColumn("time", F.explode(F.array(*map(F.lit, range(3))))).withColumn("value", F.col("value") + F.col("time"))
    return geo.series_at_sites(field, _nearest(spark, sf_dir)).select("site", "time", r6("value"))


@query(
    f"""WITH {NEAREST}, c AS (SELECT CAST(min(eta) - 1 AS INT) AS eta_from, CAST(max(eta) + 1 AS INT) AS eta_to, CAST(min(xi) - 1 AS INT) AS xi_from, CAST(max(xi) + 1 AS INT) AS xi_to
FROM near WHERE site IN (10, 20, 30, 40)) SELECT * FROM c"""
)
def subdomain_box(spark: SparkSession, sf_dir: str) -> DataFrame:
    corners = sites(spark, sf_dir).where("site in (10, 20, 30, 40)")  # the four corners of a subdomain
    box = geo.index_box(geo.nearest_cell(corners, grid(spark, sf_dir)))
    return box.select(*[F.col(c).cast("int").alias(c) for c in box.columns])


RING = [(15.5, -35.8), (18.9, -35.2), (19.4, -33.1), (16.2, -32.4), (15.2, -34.0)]


def _ring_sql() -> str:
    edges = ", ".join(
        f"({a}::DOUBLE, {b}::DOUBLE, {c}::DOUBLE, {d}::DOUBLE)" for (a, b), (c, d) in zip(RING, RING[1:] + RING[:1])
    )
    return f"""WITH {SITES}, edges(a, b, c, d) AS (VALUES {edges}),
x AS (SELECT site, count_if((b > lat) <> (d > lat) AND lon < (c - a) * (lat - b) / (d - b) + a) AS n FROM sites, edges GROUP BY ALL) SELECT site, n % 2 = 1 AS inside FROM x"""


@query(_ring_sql())
def inside_domain(spark: SparkSession, sf_dir: str) -> DataFrame:
    edges = spark.createDataFrame([(*a, *b) for a, b in zip(RING, RING[1:] + RING[:1])], "lon0 double, lat0 double, lon1 double, lat1 double")
    return geo.in_ring(sites(spark, sf_dir), edges, "site")


@query(
    f"""WITH {GRID}, p AS (SELECT c_custkey AS site, CAST((c_custkey * 7) % 390 AS DOUBLE) / 10 AS ef, CAST((c_custkey * 11) % 490 AS DOUBLE) / 10 AS xf FROM customer),
c AS (SELECT site, CAST(floor(ef) + de AS INT) AS eta, CAST(floor(xf) + dx AS INT) AS xi,
  (CASE WHEN de = 1 THEN ef - floor(ef) ELSE 1 - (ef - floor(ef)) END) * (CASE WHEN dx = 1 THEN xf - floor(xf) ELSE 1 - (xf - floor(xf)) END) AS w
  FROM p, (SELECT unnest([0, 1]) AS de), (SELECT unnest([0, 1]) AS dx)),
n AS (SELECT site, count(*) AS need FROM c WHERE w > 0 GROUP BY ALL),
g AS (SELECT c.site, sum(w * value) AS value, count(*) AS have FROM c JOIN grid USING (eta, xi) WHERE w > 0 GROUP BY ALL)
SELECT site, round(CASE WHEN have = need THEN value END, 6) AS value FROM g JOIN n USING (site)"""
)
def bilinear_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("site"), ((F.col("c_custkey") * 7) % 390 / 10).alias("eta_frac"), ((F.col("c_custkey") * 11) % 490 / 10).alias("xi_frac")
    )
    return geo.bilinear(points, grid(spark, sf_dir), "value", ["site"]).select("site", r6("value"))


@query(
    f"""WITH {GRID}, u AS (SELECT eta, xi AS xi_u, value FROM grid WHERE xi < {WIDTH - 1}),
s AS (SELECT eta, xi_u + k AS xi, value FROM u, (SELECT unnest([0, 1]) AS k)) SELECT eta, CAST(xi AS INT) AS xi, round(avg(value), 6) AS value FROM s GROUP BY ALL"""
)
def u_to_centres(spark: SparkSession, sf_dir: str) -> DataFrame:
    u = grid(spark, sf_dir).where(F.col("xi") < WIDTH - 1).select("eta", F.col("xi").alias("xi_u"), "value")
    return horizontal.staggered_to_rho(u, ["eta"], "xi_u", "xi", F.lit(WIDTH - 1)).select("eta", "xi", r6("value"))


@query(
    f"""WITH {GRID} SELECT a.eta AS eta_v, a.xi AS xi_u, round((a.value + b.value + c.value + d.value) / 4, 6) AS value FROM grid a
JOIN grid b ON b.eta = a.eta AND b.xi = a.xi + 1 JOIN grid c ON c.eta = a.eta + 1 AND c.xi = a.xi JOIN grid d ON d.eta = a.eta + 1 AND d.xi = a.xi + 1"""
)
def centres_to_psi(spark: SparkSession, sf_dir: str) -> DataFrame:
    return horizontal.rho_to_staggered(grid(spark, sf_dir).select("eta", "xi", "value"), [], "psi").select("eta_v", "xi_u", r6("value"))


@query(
    f"""WITH {GRID} SELECT a.eta, a.xi AS xi_u, a.mask * b.mask AS mask FROM grid a JOIN grid b ON b.eta = a.eta AND b.xi = a.xi + 1"""
)
def u_mask(spark: SparkSession, sf_dir: str) -> DataFrame:
    return horizontal.staggered_masks(grid(spark, sf_dir), "u").select("eta", "xi_u", "mask")


@query(
    f"""WITH {GRID}, s AS (SELECT eta, xi, pm, pn, CASE WHEN mask = 1 THEN value END AS v FROM grid),
d AS (SELECT s.*, e.v - s.v AS fx, s.v - w.v AS bx, n.v - s.v AS fy, s.v - o.v AS b_y FROM s
LEFT JOIN s e ON e.eta = s.eta AND e.xi = s.xi + 1 LEFT JOIN s w ON w.eta = s.eta AND w.xi = s.xi - 1
LEFT JOIN s n ON n.xi = s.xi AND n.eta = s.eta + 1 LEFT JOIN s o ON o.xi = s.xi AND o.eta = s.eta - 1)
SELECT eta, xi, round(sqrt((coalesce((fx + bx) / 2, fx, bx) * pm) ** 2 + (coalesce((fy + b_y) / 2, fy, b_y) * pn) ** 2) * 1000, 6) AS front FROM d"""
)
def front_magnitude(spark: SparkSession, sf_dir: str) -> DataFrame:
    field = grid(spark, sf_dir).withColumn("value", F.when(F.col("mask") == 1, F.col("value")))
    return horizontal.front_magnitude(field, [], "value").select("eta", "xi", r6("front"))


@query(
    f"""WITH {GRID}, m AS (SELECT a.eta AS eta_v, a.xi AS xi_u, (a.pm + b.pm + c.pm + d.pm) / 4 AS pm, (a.pn + b.pn + c.pn + d.pn) / 4 AS pn,
(b.h - a.h) AS dv, (c.value - a.value) AS du FROM grid a JOIN grid b ON b.eta = a.eta AND b.xi = a.xi + 1 JOIN grid c ON c.eta = a.eta + 1 AND c.xi = a.xi JOIN grid d ON d.eta = a.eta + 1 AND d.xi = a.xi + 1)
SELECT eta_v, xi_u, round(dv * pm - du * pn, 6) AS vorticity FROM m WHERE xi_u < {WIDTH - 1}"""
)
def relative_vorticity(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = grid(spark, sf_dir)
    u = g.select("eta", F.col("xi").alias("xi_u"), F.col("value").alias("u"))
    v = g.select(F.col("eta").alias("eta_v"), "xi", F.col("h").alias("v"))
    return horizontal.relative_vorticity(u, v, g, []).select("eta_v", "xi_u", r6("vorticity"))


@query(
    f"""WITH {GRID} SELECT g.eta, g.xi, CAST(count(l.eta) AS BIGINT) AS land FROM grid g LEFT JOIN grid l ON l.mask = 0 AND abs(l.eta - g.eta) + abs(l.xi - g.xi) = 1 GROUP BY g.eta, g.xi"""
)
def land_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return horizontal.land_neighbours(grid(spark, sf_dir)).select("eta", "xi", F.col("land").cast("bigint").alias("land"))


@query(
    f"""WITH {GRID}, x AS (SELECT 'xi' AS axis, max(abs((b.h - a.h) / (b.h + a.h))) AS r FROM grid a JOIN grid b ON b.eta = a.eta AND b.xi = a.xi + 1),
e AS (SELECT 'eta' AS axis, max(abs((b.h - a.h) / (b.h + a.h))) AS r FROM grid a JOIN grid b ON b.xi = a.xi AND b.eta = a.eta + 1)
SELECT axis, round(r, 6) AS r_factor FROM (SELECT * FROM x UNION ALL SELECT * FROM e)"""
)
def steepness(spark: SparkSession, sf_dir: str) -> DataFrame:
    return horizontal.steepness(grid(spark, sf_dir)).select("axis", r6("r_factor"))


@query(
    f"""WITH {GRID}, e AS (SELECT max(eta) AS m FROM grid), s AS (SELECT eta, xi, value, unnest([CASE WHEN eta = 0 THEN 'south' END, CASE WHEN eta = m THEN 'north' END,
CASE WHEN xi = 0 THEN 'west' END, CASE WHEN xi = {WIDTH - 1} THEN 'east' END]) AS side FROM grid, e) SELECT side, eta, xi, value FROM s WHERE side IS NOT NULL"""
)
def open_boundaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = grid(spark, sf_dir)
    top = g.agg(F.max("eta").alias("m")).first().m  # one number
    return geo.open_boundaries(g, top, WIDTH - 1).select("side", "eta", "xi", "value")


@query(
    f"""WITH {GRID}, p AS (SELECT eta, xi, CASE WHEN mask = 1 THEN value END AS value FROM grid),
t AS (SELECT m.eta, m.xi, k.value, (m.eta - k.eta) ** 2 + (m.xi - k.xi) ** 2 AS d, k.eta AS e, k.xi AS x FROM p m JOIN p k ON m.value IS NULL AND k.value IS NOT NULL),
b AS (SELECT eta, xi, value FROM t QUALIFY row_number() OVER (PARTITION BY eta, xi ORDER BY d, e, x) = 1)
SELECT p.eta, p.xi, coalesce(p.value, b.value) AS value FROM p LEFT JOIN b ON p.eta = b.eta AND p.xi = b.xi"""
)
def filled_coast(spark: SparkSession, sf_dir: str) -> DataFrame:
    field = grid(spark, sf_dir).select("eta", "xi", F.when(F.col("mask") == 1, F.col("value")).alias("value"))
    return horizontal.fill_nearest(field, [], "value").select("eta", "xi", "value")


@query(
    f"""WITH {GRID}, p AS (SELECT lon, lat, value FROM grid), c AS (SELECT CAST(j * 20 + i AS BIGINT) AS cell, CAST(15 AS DOUBLE) + CAST(0.25 AS DOUBLE) * i AS lon, CAST(-36 AS DOUBLE) + CAST(0.25 AS DOUBLE) * j AS lat
FROM (SELECT unnest(range(20)) AS i), (SELECT unnest(range(16)) AS j)), d AS (SELECT cell, value, ((c.lon - p.lon) ** 2 + (c.lat - p.lat) ** 2) / CAST(0.3 AS DOUBLE) ** 2 AS r FROM c, p)
SELECT cell, round(sum((1 - r) ** 2 * value) / sum((1 - r) ** 2), 6) AS value, count(*) AS points FROM d WHERE r < 1 GROUP BY ALL"""
)
def coarsened(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = spark.range(320).select(
        F.col("id").alias("cell"), (15 + 0.25 * (F.col("id") % 20)).alias("lon"), (-36 + 0.25 * F.floor(F.col("id") / 20)).alias("lat")
    )
    return horizontal.coarsen(grid(spark, sf_dir), cells, 0.3, "value").select("cell", r6("value"), "points")


SPACING = 0.25


@query(
    f"""WITH {GRID}, s AS (SELECT floor(min(lon) / 0.25) * 0.25 AS lon0, floor(min(lat) / 0.25) * 0.25 AS lat0, CAST(round((ceil(max(lon) / 0.25) - floor(min(lon) / 0.25))) AS INT) + 1 AS nx, CAST(round(ceil(max(lat) / 0.25) - floor(min(lat) / 0.25)) AS INT) + 1 AS ny FROM grid),
c AS (SELECT CAST(j * nx + i AS BIGINT) AS out_cell, CAST(lon0 + i * 0.25 AS DOUBLE) AS lon, CAST(lat0 + j * 0.25 AS DOUBLE) AS lat FROM s, (SELECT unnest(range(200)) AS i), (SELECT unnest(range(500)) AS j) WHERE i < nx AND j < ny),
n AS (SELECT c.out_cell, g.value FROM c, grid g QUALIFY row_number() OVER (PARTITION BY out_cell ORDER BY round(sqrt((c.lon - g.lon) ** 2 + (c.lat - g.lat) ** 2), 12), g.eta, g.xi) = 1)
SELECT out_cell, value FROM n"""
)
def regridded_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = grid(spark, sf_dir)
    cells = horizontal.regular_cells(horizontal.regular_axis(g, SPACING), SPACING)
    near = geo.nearest_cell(cells, g, "out_cell", wet_only=False)
    weights = near.select("out_cell", "eta", "xi", F.lit(1.0).alias("w"))
    return horizontal.apply_weights(g, weights, [], ["value"]).select("out_cell", "value")


@query(
    f"""WITH {GRID}, s AS (SELECT floor(min(lon) / 0.25) * 0.25 AS lon0, floor(min(lat) / 0.25) * 0.25 AS lat0, CAST(round((ceil(max(lon) / 0.25) - floor(min(lon) / 0.25))) AS INT) + 1 AS nx, CAST(round(ceil(max(lat) / 0.25) - floor(min(lat) / 0.25)) AS INT) + 1 AS ny FROM grid),
c AS (SELECT CAST(j * nx + i AS BIGINT) AS out_cell, CAST((lon0 + i * 0.25 - 15) / 0.1 AS DOUBLE) AS x, CAST((lat0 + j * 0.25 + 36) / 0.1 AS DOUBLE) AS y FROM s, (SELECT unnest(range(200)) AS i), (SELECT unnest(range(500)) AS j) WHERE i < nx AND j < ny),
f AS (SELECT out_cell, least(CAST(floor(round(x, 6)) AS INT), {WIDTH - 2}) AS xi, least(CAST(floor(round(y, 6)) AS INT), (SELECT max(eta) - 1 FROM grid)) AS eta, x, y FROM c),
w AS (SELECT out_cell, eta, xi, x - xi AS a, y - eta AS b FROM f)
SELECT w.out_cell, round(CASE WHEN a + b <= 1 THEN (1 - a - b) * p.value + a * q.value + b * r.value ELSE (a + b - 1) * t.value + (1 - b) * q.value + (1 - a) * r.value END, 6) AS value
FROM w JOIN grid p USING (eta, xi) JOIN grid q ON q.eta = w.eta AND q.xi = w.xi + 1 JOIN grid r ON r.eta = w.eta + 1 AND r.xi = w.xi JOIN grid t ON t.eta = w.eta + 1 AND t.xi = w.xi + 1
WHERE a <= 1.000001 AND b <= 1.000001"""
)
def regridded_linear(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = grid(spark, sf_dir)
    cells = horizontal.regular_cells(horizontal.regular_axis(g, SPACING), SPACING)
    weights = horizontal.triangle_weights(g, cells, 0.5)
    return horizontal.apply_weights(g, weights, [], ["value"]).select("out_cell", r6("value"))


@query(
    """WITH e AS (SELECT n_nationkey AS section, CAST(15 + n_nationkey AS DOUBLE) AS lon0, CAST(-36 + n_nationkey AS DOUBLE) AS lat0, CAST(18 + n_nationkey AS DOUBLE) AS lon1, CAST(-33 + n_nationkey AS DOUBLE) AS lat1 FROM nation),
b AS (SELECT *, radians(lat0) AS a, radians(lon0) AS o, atan2(cos(radians(lat1)) * sin(radians(lon1 - lon0)), cos(radians(lat0)) * sin(radians(lat1)) - sin(radians(lat0)) * cos(radians(lat1)) * cos(radians(lon1 - lon0))) AS t FROM e),
p AS (SELECT section, a, o, t, CAST(k AS INT) AS point, k * 50000 / 6367442.76::DOUBLE AS s FROM b, (SELECT unnest(range(8)) AS k)),
q AS (SELECT section, point, o, t, s, a, asin(sin(a) * cos(s) + cos(a) * sin(s) * cos(t)) AS la FROM p)
SELECT section, point, round(degrees(o + atan2(sin(t) * sin(s) * cos(a), cos(s) - sin(a) * sin(la))), 6) AS lon, round(degrees(la), 6) AS lat, CAST(point * 50000 AS DOUBLE) AS distance FROM q"""
)
def section_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("n_nationkey").cast("double")
    ends = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("section"), (15 + k).alias("lon0"), (-36 + k).alias("lat0"), (18 + k).alias("lon1"), (-33 + k).alias("lat1"))
    return geo.explode_sections(ends, F.lit(8), F.lit(50_000.0)).select("section", "point", r6("lon"), r6("lat"), "distance")


SECTION_ROW = "l_orderkey, l_linenumber"


@query(
    """SELECT l_orderkey, l_linenumber,
round(l_quantity * cos(l_tax) - l_discount * sin(l_tax), 6) AS east, round(l_discount * cos(l_tax) + l_quantity * sin(l_tax), 6) AS north,
round(sqrt(l_quantity * l_quantity + l_discount * l_discount), 6) AS speed, round((l_quantity * l_quantity + l_discount * l_discount) / 2, 6) AS energy,
round(l_discount * sin(l_tax) - l_quantity * cos(l_tax), 6) AS across, round(l_quantity * sin(l_tax) + l_discount * cos(l_tax), 6) AS along,
round((270 - l_quantity) * pi() / 180, 6) AS direction, round(4 * pi() * sin(radians(-l_quantity)) * 366.25 / (24 * 3600 * 365.25) * 1e6, 6) AS coriolis,
round(0.020 * (l_quantity + l_tax) * 6.625 * 12, 6) AS chlorophyll FROM lineitem"""
)
def vectors_and_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = table(spark, sf_dir, "lineitem")
    east, north = physics.rotate("l_quantity", "l_discount", "l_tax")
    across, along = physics.across_along("l_quantity", "l_discount", "l_tax")
    return t.select(
        "l_orderkey", "l_linenumber", r6(east, "east"), r6(north, "north"), r6(physics.speed("l_quantity", "l_discount"), "speed"),
        r6(physics.kinetic_energy("l_quantity", "l_discount"), "energy"), r6(across, "across"), r6(along, "along"),
        r6(physics.wave_direction("l_quantity"), "direction"), r6(physics.coriolis(-F.col("l_quantity")) * 1e6, "coriolis"),
        r6(physics.chlorophyll("l_quantity", "l_tax"), "chlorophyll"),
    )


@query(
    f"""WITH {SITES} SELECT site, round(2 * 6371000 * asin(sqrt(sin((radians(lat) - radians(-34)) / 2) ** 2 + cos(radians(-34)) * cos(radians(lat)) * sin(radians(lon - 18) / 2) ** 2)), 3) AS haversine,
round(6367442.76 * atan2(sqrt((sin(radians(abs(lon - 18))) * cos(radians(lat))) ** 2 + (sin(radians(lat)) * cos(radians(-34)) - cos(radians(lat)) * sin(radians(-34)) * cos(radians(abs(lon - 18)))) ** 2),
sin(radians(lat)) * sin(radians(-34)) + cos(radians(lat)) * cos(radians(-34)) * cos(radians(abs(lon - 18)))), 3) AS spheric FROM sites"""
)
def distances(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sites(spark, sf_dir).select(
        "site", F.round(physics.haversine(-34.0, 18.0, "lat", "lon"), 3).alias("haversine"), F.round(physics.great_circle(-34.0, 18.0, "lat", "lon"), 3).alias("spheric")
    )


@query(
    """WITH a AS (SELECT p_partkey, p_size / 10::DOUBLE AS au, CAST(p_partkey % 360 AS DOUBLE) AS pu, p_retailprice / 1000 AS av, CAST(p_partkey * 7 % 360 AS DOUBLE) AS pv FROM part),
b AS (SELECT p_partkey, au * cos(radians(pu)) AS ur, -au * sin(radians(pu)) AS ui, av * cos(radians(pv)) AS vr, -av * sin(radians(pv)) AS vi FROM a),
c AS (SELECT p_partkey, sqrt(((ur - vi) / 2) ** 2 + ((ui + vr) / 2) ** 2) AS wp, sqrt(((ur + vi) / 2) ** 2 + ((vr - ui) / 2) ** 2) AS wm, atan2((ui + vr) / 2, (ur - vi) / 2) AS tp, atan2((vr - ui) / 2, (ur + vi) / 2) AS tm FROM b)
SELECT p_partkey, round(wp + wm, 6) AS semi_major, round((wp - wm) / (wp + wm), 6) AS eccentricity,
round(CASE WHEN tm + tp < 0 THEN degrees((tm + tp) / 2) + 360 ELSE degrees((tm + tp) / 2) END, 6) % 360 AS inclination, round(CASE WHEN tm - tp < 0 THEN degrees((tm - tp) / 2) + 360 ELSE degrees((tm - tp) / 2) END, 6) % 360 AS phase FROM c"""
)
def tidal_ellipses(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("p_partkey")
    got = physics.tidal_ellipse(F.col("p_size") / 10, (k % 360).cast("double"), F.col("p_retailprice") / 1000, (k * 7 % 360).cast("double"))
    turns = {n: F.round(got[n], 6) % 360 for n in ("inclination", "phase")}  # rounding may reach a whole turn
    return table(spark, sf_dir, "part").select("p_partkey", *[r6(c, n) for n, c in (got | turns).items()])


def _tide_sql() -> str:
    waves = ", ".join(f"('{w}', {a}::DOUBLE, {e}::DOUBLE, {p}::DOUBLE)" for w, (a, e, _, p) in forcing.CONSTITUENTS.items())
    return f"""WITH {GRID}, w(wave, amp, elas, hours) AS (VALUES {waves}),
s AS (SELECT eta, xi, wave, radians(lon) AS lon, CASE WHEN hours < 13 THEN 2 WHEN hours < 26 THEN 1 ELSE 0 END AS k,
amp * elas * CASE WHEN hours < 13 THEN cos(radians(lat)) ** 2 WHEN hours < 26 THEN sin(2 * radians(lat)) ELSE 0.5 - 1.5 * sin(radians(lat)) ** 2 END AS size FROM grid, w)
SELECT eta, xi, wave, round(size * cos(k * lon), 6) AS re, round(-size * sin(k * lon), 6) AS im FROM s"""


@query(_tide_sql())
def equilibrium_tide(spark: SparkSession, sf_dir: str) -> DataFrame:
    factors = forcing.nodal_factors(spark, "2020-03-01")
    return forcing.equilibrium(grid(spark, sf_dir), factors).select("eta", "xi", "wave", r6("re"), r6("im"))


def _eos_sql(t: str, s: str) -> str:
    """EOS-80 at the surface in the plain power form."""
    return (
        f"(999.842594 + 6.793952e-2 * {t} - 9.095290e-3 * {t} ** 2 + 1.001685e-4 * {t} ** 3 - 1.120083e-6 * {t} ** 4 + 6.536332e-9 * {t} ** 5"
        f" + (8.24493e-1 - 4.0899e-3 * {t} + 7.6438e-5 * {t} ** 2 - 8.2467e-7 * {t} ** 3 + 5.3875e-9 * {t} ** 4) * {s}"
        f" + (-5.72466e-3 + 1.0227e-4 * {t} - 1.6546e-6 * {t} ** 2) * {s} ** 1.5 + 4.8314e-4 * {s} ** 2)"
    )


def _with_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = profiles(spark, sf_dir)
    z = vertical.level_depths("h", "zeta", THETA_S, THETA_B, HC, LEVELS)
    w = vertical.level_depths("h", "zeta", THETA_S, THETA_B, HC, LEVELS, "w")
    rho = lambda t: F.zip_with("temp", "salt", lambda a, b: physics.eos80_density(a, b, F.lit(0.0)))
    return p.withColumns({"z": z, "z_w": w}).withColumn("rho", rho(None))


def _cells(df: DataFrame, **arrays) -> DataFrame:
    """Column layout to cell layout: one row per level."""
    return df.select("cell", F.posexplode(F.arrays_zip(*[a.alias(n) for n, a in arrays.items()])).alias("level", "v")).select(
        "cell", "level", *[r6(f"v.{n}", n) for n in arrays]
    )


@query(f"WITH {PROFILES} SELECT cell, CAST(i AS INT) AS level, round(z, 6) AS z, round({_eos_sql('temp', 'salt')}, 6) AS rho FROM water")
def level_depths_and_density(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _cells(_with_levels(spark, sf_dir), z=F.col("z"), rho=F.col("rho"))


def _depth_sql(d: float) -> str:
    return f"""d{int(d)} AS (SELECT cell, least(greatest(count_if(z < -{d}), 1), 63) AS k, min(z) AS lowest FROM water GROUP BY ALL),
v{int(d)} AS (SELECT cell, CASE WHEN -{d} < lowest THEN NULL ELSE ((u.temp - l.temp) * -{d} + l.temp * u.z - u.temp * l.z) / (u.z - l.z) END AS temp,
CASE WHEN -{d} < lowest THEN NULL ELSE ((u.salt - l.salt) * -{d} + l.salt * u.z - u.salt * l.z) / (u.z - l.z) END AS salt
FROM d{int(d)} d JOIN water u USING (cell) JOIN water l USING (cell) WHERE u.i = d.k AND l.i = d.k - 1)"""


@query(
    f"""WITH {PROFILES}, {_depth_sql(5.0)}, {_depth_sql(50.0)}, {_depth_sql(100.0)}
SELECT cell, 5.0::DOUBLE AS depth, round(temp, 6) AS temp FROM v5 UNION ALL SELECT cell, 50.0::DOUBLE, round(temp, 6) FROM v50 UNION ALL SELECT cell, 100.0::DOUBLE, round(temp, 6) FROM v100"""
)
def fixed_depths(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _with_levels(spark, sf_dir).withColumn("depth", F.explode(F.array(*map(F.lit, (5.0, 50.0, 100.0)))))
    return rows.select("cell", "depth", r6(vertical.at_depth("temp", "z", -F.col("depth")), "temp"))


@query(
    f"""WITH {PROFILES}, {_depth_sql(5.0)}, {_depth_sql(50.0)}, b AS (SELECT cell, temp, salt FROM water WHERE i = 0),
x AS (SELECT cell, v5.temp AS t, v5.salt AS s, coalesce(v50.temp, b.temp) AS dt, coalesce(v50.salt, b.salt) AS ds FROM v5 JOIN v50 USING (cell) JOIN b USING (cell))
SELECT cell, round({_eos_sql('dt', 'ds')} - {_eos_sql('t', 's')}, 6) AS stratification FROM x"""
)
def stratification(spark: SparkSession, sf_dir: str) -> DataFrame:
    rho = lambda t, s: physics.eos80_density(t, s, F.lit(0.0))
    return _with_levels(spark, sf_dir).select("cell", r6(vertical.stratification(rho, "temp", "salt", "z"), "stratification"))


@query(
    f"""WITH {PROFILES}, r AS (SELECT cell, i, z, temp, salt, {_eos_sql('temp', 'salt')} AS rho FROM water),
g AS (SELECT cell, i, -9.81 / 1027 * (rho - lag(rho) OVER w) / (z - lag(z) OVER w) AS n2,
((temp - lag(temp) OVER w) / (z - lag(z) OVER w)) ** 2 + ((salt - lag(salt) OVER w) / (z - lag(z) OVER w)) ** 2 AS s2 FROM r WINDOW w AS (PARTITION BY cell ORDER BY i))
SELECT cell, CAST(i - 1 AS INT) AS level, round(n2, 6) AS n2, round(CASE WHEN n2 * s2 > 0 THEN log10(n2 / s2) END, 6) AS richardson FROM g WHERE i > 0"""
)
def buoyancy_and_richardson(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = _with_levels(spark, sf_dir)
    n2 = vertical.buoyancy_frequency("rho", "z")
    return _cells(p, n2=F.slice(n2, 2, LEVELS - 1), richardson=vertical.richardson("rho", "temp", "salt", "z"))


@query(
    f"""WITH {PROFILES}, wc AS (SELECT k, k / 64::DOUBLE - 1 AS s FROM (SELECT unnest(range(65)) AS k)), wc1 AS (SELECT k, s, (exp(2 * ((1 - cosh(5 * s)) / (cosh(5) - 1) + 1)) - 1) / (exp(2) - 1) - 1 AS c FROM wc),
zw AS (SELECT cell, k, (20 * s + c * h) * h / (h + 20) + greatest(zeta, CAST(0.01 AS DOUBLE) - h) * (1 + (20 * s + c * h) / (h + 20)) AS z FROM profiles, wc1),
t AS (SELECT w.cell, w.temp, b.z - a.z AS d, greatest(least(b.z, -10) - greatest(a.z, -60), 0) AS p FROM water w JOIN zw a ON a.cell = w.cell AND a.k = w.i JOIN zw b ON b.cell = w.cell AND b.k = w.i + 1)
SELECT cell, round(sum(temp * d), 6) AS total, round(sum(temp * d) / sum(d), 6) AS mean, round(sum(temp * p), 6) AS part, round(sum(p), 6) AS thickness FROM t GROUP BY ALL"""
)
def vertical_integrals(spark: SparkSession, sf_dir: str) -> DataFrame:
    part, thickness = vertical.integral_between("temp", "z_w", -60.0, -10.0)
    return _with_levels(spark, sf_dir).select(
        "cell", r6(vertical.integral("temp", "z_w"), "total"), r6(vertical.depth_mean("temp", "z_w"), "mean"), r6(part, "part"), r6(thickness, "thickness")
    )


@query(
    f"""WITH {PROFILES}, n AS (SELECT cell, i, z AS za, temp AS ta, lead(z) OVER w AS zb, lead(temp) OVER w AS tb FROM water WINDOW w AS (PARTITION BY cell ORDER BY i)),
c AS (SELECT * FROM n WHERE (ta - 10) * (tb - 10) <= 0 AND ta <> tb QUALIFY row_number() OVER (PARTITION BY cell ORDER BY i) = 1)
SELECT p.cell, round(za + (10 - ta) * (zb - za) / (tb - ta), 6) AS depth FROM profiles p LEFT JOIN c USING (cell)"""
)
def isotherm_depth(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _with_levels(spark, sf_dir).select("cell", r6(vertical.at_surface_of("z", "temp", 10.0), "depth"))
