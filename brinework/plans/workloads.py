"""Whole jobs composed of operators: products, tiers, sections, profiles, validation, forcing on the model grid."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from brinework.functions import physics, vertical
from brinework.operators import events, forcing, geo, horizontal, timeaxis, validate


def heatwave_products(readings: DataFrame, clim: DataFrame, keys: list[str], time: str = "time", value: str = "temp", min_fraction: float = 0.0) -> DataFrame:
    """Daily means, anomalies and categories of a field: one hash by cell serves every step."""
    daily = timeaxis.daily_mean(readings, keys, time, (value,))
    daily = timeaxis.drop_part_days(readings, daily, min_fraction, time)
    dated = events.join_climatology(daily.repartition(*keys), clim, keys)
    return events.detect(events.anomalies(dated, value), keys, value=value)


def tier1(scalars: DataFrame, u: DataFrame, v: DataFrame, grid: DataFrame, theta_s: float, theta_b: float, hc: float, n: int, time: str = "time") -> DataFrame:
    """Cell centres: profiles of scalars with velocities averaged to the centres and rotated, and the depths of the levels.

    scalars is (time, eta, xi, zeta, arrays), u (time, eta, xi_u, u array), v (time, eta_v, xi, v array).
    """
    last = grid.agg(F.max("eta").alias("e"), F.max("xi").alias("x")).first()  # two numbers
    us = horizontal.arrays_to_rho(u.withColumnRenamed("u", "value"), [time, "eta"], "xi_u", "xi").where(F.col("xi") <= last.x).withColumnRenamed("value", "__u")
    vs = horizontal.arrays_to_rho(v.withColumnRenamed("v", "value"), [time, "xi"], "eta_v", "eta").where(F.col("eta") <= last.e).withColumnRenamed("value", "__v")
    cells = grid.select("eta", "xi", "h", "angle", "mask", "lon", "lat")
    joined = scalars.join(us, [time, "eta", "xi"]).join(vs, [time, "eta", "xi"]).join(cells, ["eta", "xi"]).where("mask = 1")
    turn = lambda k: F.zip_with("__u", "__v", lambda a, b: physics.rotate(a, b, F.col("angle"))[k])
    return joined.withColumns({"u": turn(0), "v": turn(1), "z": vertical.level_depths("h", "zeta", theta_s, theta_b, hc, n)}).drop("__u", "__v")


def tier2(columns: DataFrame, variables: list[str], depths: list[float], keys: list[str], nearest: tuple[str, ...] = ("category",)) -> DataFrame:
    """Profiles at fixed depths (negative down): one row per depth; classes by the nearest level."""
    rows = columns.withColumn("depth", F.explode(F.array(*map(F.lit, map(float, depths)))))
    return rows.select(*keys, "depth", *[vertical.at_depth(v, "z", F.col("depth"), "nearest" if v in nearest else "linear").alias(v) for v in variables])


def tier3(levels: DataFrame, grid: DataFrame, spacing: float, variables: list[str], by: list[str], method: str = "linear", tile: float = 1.0, ring: list[tuple[float, float]] | None = None) -> DataFrame:
    """A regular grid: the weights are built once and joined to every time and depth; cells outside the ring are missing."""
    cells = horizontal.regular_cells(horizontal.regular_axis(grid, spacing), spacing)
    if method == "nearest":
        weights = geo.nearest_cell(cells, grid, "out_cell", wet_only=False).select("out_cell", "eta", "xi", F.lit(1.0).alias("w"))
    elif method == "linear":
        weights = horizontal.triangle_weights(grid, cells, tile)
    else:
        raise ValueError(f"unknown method {method!r}: nearest or linear")
    out = horizontal.apply_weights(levels, weights, by, variables).join(cells, "out_cell")
    return out if ring is None else out.where(geo.in_polygon("lon", "lat", ring))


def section(spark: SparkSession, field: DataFrame, grid: DataFrame, ends: tuple[float, float, float, float], spacing: float, values: list[str], by: list[str]) -> DataFrame:
    """(by, point, lon, lat, distance, bearing, values) along a great circle, bilinear in index space; ``by`` holds time and level."""
    points = geo.section_points(spark, *ends, spacing)
    where = geo.fractional_index(points, grid, "point")
    path = timeaxis.distances_along(points.withColumn("__one", F.lit(1)), ["__one"], "point", "lon", "lat").drop("__one")
    out = None
    for v in values:
        got = geo.bilinear(where, field, v, ["point"], by)
        out = got if out is None else out.join(got, ["point", *by])
    return out.join(path, "point")


def section_velocity(rows: DataFrame, u: str = "u", v: str = "v") -> DataFrame:
    """Adds the components across and along the section."""
    across, along = physics.across_along(u, v, "bearing")
    return rows.withColumns({"across": across, "along": along})


def profiles_at_sites(columns: DataFrame, found: DataFrame, values: list[str], time: str = "time") -> DataFrame:
    """(site, time, level, z, values): every level of the columns at the sites' cells."""
    at = geo.series_at_sites(columns, found)
    zipped = F.arrays_zip(*[F.col(c) for c in ("z", *values)])
    return at.select("site", time, F.posexplode(zipped).alias("level", "v")).select("site", time, "level", *[F.col(f"v.{c}").alias(c) for c in ("z", *values)])


def model_against_observations(columns: DataFrame, obs: DataFrame, found: DataFrame, depth: float, value: str, first_time, step_seconds: int, time: str = "time") -> DataFrame:
    """Statistics per site of a model variable at a depth against observations binned to the model's times."""
    # the profiles are read at the depth once each, and met by the observations of their sites only
    micros = F.unix_micros(F.col(time).cast("timestamp")) - F.unix_micros(first_time)
    near = columns.join(found.select("eta", "xi").distinct(), ["eta", "xi"], "left_semi")
    model = near.select("eta", "xi", F.round(micros / (step_seconds * 1_000_000)).cast("bigint").alias("bin"), vertical.at_depth(value, "z", depth).alias("model"))
    binned = timeaxis.to_model_axis(obs, first_time, F.lit(step_seconds), time, ["obs"], ["site"])
    return validate.paired_statistics(validate.pair(model, binned.join(found.select("site", "eta", "xi"), "site"), ["eta", "xi", "bin"]), ["site"])


def horizontal_gradient(cells: DataFrame, by: list[str], value: str, axis: str, metric: str, z: str = "z", level: str = "level") -> DataFrame:
    """dq/dx at constant depth on sloping levels: dq/ds - dq/dz dz/ds between neighbours along an axis; cell layout."""
    other = "eta" if axis == "xi" else "xi"
    up = Window.partitionBy(*by, "eta", "xi").orderBy(level)
    slope = lambda c: F.coalesce(F.lead(c).over(up), F.col(c)) - F.coalesce(F.lag(c).over(up), F.col(c))
    q = cells.withColumn("__dqdz", F.try_divide(slope(value), slope(z)))
    along = Window.partitionBy(*by, level, other).orderBy(axis)
    nxt = lambda c: F.when(F.lead(axis).over(along) == F.col(axis) + 1, F.lead(c).over(along))
    m = (F.col(metric) + nxt(metric)) / 2
    grad = (nxt(value) - F.col(value)) * m - (F.col("__dqdz") + nxt("__dqdz")) / 2 * (nxt(z) - F.col(z)) * m
    return q.withColumn("gradient", grad).drop("__dqdz")


def ertel_pv(cells: DataFrame, by: list[str], rho0: float = vertical.RHO0) -> DataFrame:
    """(by, level, eta, xi, pv): -(f + v_x - u_y) rho_z + v_z rho_x - u_z rho_y over rho0, at cell centres of the cell layout.

    Needs u, v, rho, z, f, pm, pn; centred differences, one-sided at the edges.
    """
    return ertel_pv_parts(cells, by, rho0).select(*by, "level", "eta", "xi", "pv")


def ertel_pv_parts(cells: DataFrame, by: list[str], rho0: float = vertical.RHO0) -> DataFrame:
    """(by, level, eta, xi, pv_i, pv_j, pv_k, pv): the parts along xi, along eta and upwards, and their sum.

    k is -(f + v_x - u_y) rho_z, i is -(w_y - v_z) rho_x and j is -(u_z - w_x) rho_y, over rho0, with w
    taken as zero if the cells have none. Horizontal differences are those at constant depth, by
    the chain rule on sloping levels. Three exchanges: one for each axis, whatever the variables.
    """
    up = [*by, "eta", "xi"]
    row, col = [*by, "level", "eta"], [*by, "level", "xi"]
    d = cells
    upward = [c for c in ("w",) if c in cells.columns]
    for name in ("z", "rho", "u", "v", *upward):
        d = timeaxis.masked_difference(d, up, "level", name, f"__{name}z")
    for name in ("v", "rho", "z", *upward):
        d = timeaxis.masked_difference(d, row, "xi", name, f"__{name}x")
    for name in ("u", "rho", "z", *upward):
        d = timeaxis.masked_difference(d, col, "eta", name, f"__{name}y")
    c = F.col
    per = lambda n: F.try_divide(c(f"__{n}z"), c("__zz"))
    level_x = lambda n: (c(f"__{n}x") - per(n) * c("__zx")) * c("pm")
    level_y = lambda n: (c(f"__{n}y") - per(n) * c("__zy")) * c("pn")
    w_x, w_y = (level_x("w"), level_y("w")) if upward else (F.lit(0.0), F.lit(0.0))
    parts = {
        "pv_i": (per("v") - w_y) * level_x("rho") / rho0,
        "pv_j": (w_x - per("u")) * level_y("rho") / rho0,
        "pv_k": -(c("f") + level_x("v") - level_y("u")) * per("rho") / rho0,
    }
    out = d.select(*by, "level", "eta", "xi", *[p.alias(n) for n, p in parts.items()])
    return out.withColumn("pv", F.col("pv_k") + F.col("pv_i") + F.col("pv_j"))


def regrid_to_model(source: DataFrame, grid: DataFrame, values: list[str], by: list[str], lon0: float, lat0: float, step: float, theta_s: float, theta_b: float, hc: float, n: int) -> DataFrame:
    """A regular ocean product (by, depth, j, i, values) as columns on the model's levels.

    Missing cells take their nearest neighbour on the same depth, a depth with fewer than ten valid
    cells is their mean, then each depth is sampled at the model's cells, and each column moves to the model's levels (end layers repeat).
    """
    out = None
    for v in values:
        flat = source.select(*by, "depth", F.col("j").alias("eta"), F.col("i").alias("xi"), v)
        filled = horizontal.fill_or_mean(flat, [*by, "depth"], v).withColumnsRenamed({"eta": "j", "xi": "i"})
        at = forcing.regular_to_grid(filled, grid, lon0, lat0, step, v, [*by, "depth"])
        column = F.transform(F.array_sort(F.collect_list(F.when(F.col(v).isNotNull(), F.struct((-F.col("depth")).alias("z"), F.col(v).alias("v"))))), lambda s: s)
        stacked = at.groupBy(*by, "eta", "xi").agg(column.alias(f"__{v}"))
        out = stacked if out is None else out.join(stacked, [*by, "eta", "xi"])
    out = out.join(grid.select("eta", "xi", "h", "angle", "mask"), ["eta", "xi"]).withColumn(
        "z", vertical.level_depths("h", F.lit(0.0), theta_s, theta_b, hc, n)
    )
    moved = {v: vertical.z_to_sigma(F.transform(f"__{v}", lambda s: s["v"]), F.transform(f"__{v}", lambda s: s["z"]), F.col("z")) for v in values}
    return out.withColumns(moved).drop(*[f"__{v}" for v in values])


def turned_and_corrected(columns: DataFrame, u: str = "u", v: str = "v", ubar: str | None = None, vbar: str | None = None, z_w: str = "z_w") -> DataFrame:
    """Profiles of east and north velocities turned to the grid's axes by ``angle`` and, with targets, shifted to those depth means."""
    turn = lambda k: F.zip_with(u, v, lambda a, b: physics.rotate_to_grid(a, b, F.col("angle"))[k])
    out = columns.withColumns({"__u": turn(0), "__v": turn(1)}).drop(u, v).withColumnsRenamed({"__u": u, "__v": v})
    moved = {c: vertical.conserve_transport(c, z_w, F.col(t)) for c, t in ((u, ubar), (v, vbar)) if t}
    return out.withColumns(moved) if moved else out


def model_records(source: DataFrame, grid: DataFrame, scalars: list[str], u: str, v: str, by: list[str], lon0: float, lat0: float, step: float, theta_s: float, theta_b: float, hc: float, n: int) -> DataFrame:
    """Every record of a regular ocean product on the model's levels, as a climatology or nudging state needs it.

    Velocities are turned to the grid's axes and keep the depth mean that their source had on its
    own depths. (by, eta, xi, z, z_w, scalars, u, v).
    """
    columns = regrid_to_model(source, grid, [*scalars, u, v], by, lon0, lat0, step, theta_s, theta_b, hc, n)
    columns = columns.withColumn("z_w", vertical.level_depths("h", F.lit(0.0), theta_s, theta_b, hc, n, "w"))
    means = depth_means(source, [u, v], by).withColumnsRenamed({"j": "eta", "i": "xi"})
    at = None
    for c in (u, v):
        got = forcing.regular_to_grid(means.select(*by, F.col("eta").alias("j"), F.col("xi").alias("i"), F.col(c).alias(f"{c}bar")), grid, lon0, lat0, step, f"{c}bar", by)
        at = got if at is None else at.join(got, [*by, "eta", "xi"])
    joined = columns.join(at, [*by, "eta", "xi"], "left")
    ue, vn = physics.rotate_to_grid(f"{u}bar", f"{v}bar", "angle")
    both = joined.withColumns({"__ub": ue, "__vb": vn})
    return turned_and_corrected(both, u, v, "__ub", "__vb").drop("__ub", "__vb", f"{u}bar", f"{v}bar")


def depth_means(source: DataFrame, values: list[str], by: list[str], depth: str = "depth") -> DataFrame:
    """(by, j, i, values): means of a product over its own depths, each depth weighing half of the way to its neighbours; missing depths do not count."""
    w = Window.partitionBy(*by, "j", "i").orderBy(depth)
    here = F.col(depth)
    above, below = F.coalesce(F.lag(depth).over(w), -here), F.coalesce(F.lead(depth).over(w), here)
    d = source.withColumn("__d", (below - above) / 2)
    return d.groupBy(*by, "j", "i").agg(*[F.try_divide(F.sum(F.col(c) * F.col("__d")), F.sum(F.when(F.col(c).isNotNull(), F.col("__d")))).alias(c) for c in values])


def boundary_records(columns: DataFrame, eta_max: int, xi_max: int, sides: tuple[str, ...] = ("south", "east", "north", "west")) -> DataFrame:
    """The records of the open boundaries, one row for each cell, side and record: the edge strips are cut before any further work."""
    return geo.open_boundaries(columns, eta_max, xi_max, sides)


def initial_state(columns: DataFrame, at: str, values: list[str], time: str = "time") -> DataFrame:
    """State at a time from the two nearest times, linear between them; element-wise on profiles."""
    micros = lambda c: F.unix_micros(c.cast("timestamp"))
    times = timeaxis.nearest_times(columns.select(time).distinct(), at, 2, time).orderBy(time).collect()  # two times
    if len(times) == 1 or columns.where(F.col(time) == F.lit(at)).limit(1).count():
        return columns.where(F.col(time) == F.lit(times[0][0] if len(times) == 1 else at))
    a, b = (columns.where(F.col(time) == F.lit(t[0])) for t in times)
    ta, tb = (micros(F.lit(t[0])) for t in times)
    w = (micros(F.lit(at)) - ta) / (tb - ta)
    joined = a.select("eta", "xi", *values).join(b.select("eta", "xi", *[F.col(v).alias(f"__{v}") for v in values]), ["eta", "xi"])
    return joined.select("eta", "xi", F.lit(at).cast("timestamp").alias(time), *[F.zip_with(v, f"__{v}", lambda x, y: x + (y - x) * w).alias(v) for v in values])


def wind_onto_forcing(wind: DataFrame, base: DataFrame, weights: DataFrame, angle: DataFrame, time: str = "time") -> DataFrame:
    """A forcing table with the wind of another source: nearest time, weights in space, turned to the grid, speed anew."""
    steps = base.select(time).distinct().withColumn("__k", F.lit(1))
    match = timeaxis.nearest_in_time(steps, wind.select(time).distinct().withColumn("__k", F.lit(1)), ["__k"], time, [])
    on_axis = match.select(time, F.col("matched_time")).join(wind.withColumnRenamed(time, "matched_time"), "matched_time")
    at = horizontal.apply_weights(on_axis, weights, [time], ["uwnd", "vwnd"])
    cells = angle.select("eta", "xi", "angle", F.col("out_cell"))
    u, v = physics.rotate_to_grid("uwnd", "vwnd", "angle")
    turned = at.join(cells, "out_cell").select(time, "eta", "xi", u.alias("uwnd"), v.alias("vwnd"))
    out = base.drop("uwnd", "vwnd", "wspd").join(turned, [time, "eta", "xi"], "left")
    return out.withColumn("wspd", physics.speed("uwnd", "vwnd"))


def mean_level_depths(fields: DataFrame, grid: DataFrame, theta_s: float, theta_b: float, hc: float, n: int) -> DataFrame:
    """(eta, xi, z): depths of the levels under the mean sea surface."""
    mean = fields.groupBy("eta", "xi").agg(F.avg("zeta").alias("zeta"))
    return mean.join(grid.select("eta", "xi", "h"), ["eta", "xi"]).select("eta", "xi", vertical.level_depths("h", "zeta", theta_s, theta_b, hc, n).alias("z"))
