"""Vertical operators on profiles: parallel arrays ordered bottom to top, no shuffle.

Everything is a column expression over array columns, so a profile never leaves its row.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

G, RHO0 = 9.81, 1027.0


def _col(x) -> Column:
    return F.col(x) if isinstance(x, str) else x if isinstance(x, Column) else F.lit(float(x))


def stretching(theta_s: float, theta_b: float, n: int, points: str = "rho", vtransform: int = 2) -> tuple[list[float], list[float]]:
    """S coordinates and stretching of ``n`` levels (or ``n + 1`` w points), bottom first."""
    sc = [i / n - 1 for i in range(n + 1)] if points == "w" else [(i - n - 0.5) / n for i in range(1, n + 1)]
    if vtransform == 2:
        def curve(s: float) -> float:
            c = (1 - math.cosh(theta_s * s)) / (math.cosh(theta_s) - 1) if theta_s > 0 else -(s**2)
            return (math.exp(theta_b * (c + 1)) - 1) / (math.exp(theta_b) - 1) - 1 if theta_b > 0 else c
    else:
        def curve(s: float) -> float:
            a = math.sinh(theta_s * s) / math.sinh(theta_s)
            return (1 - theta_b) * a + theta_b * (math.tanh(theta_s * (s + 0.5)) / (2 * math.tanh(0.5 * theta_s)) - 0.5)
    return sc, [curve(s) for s in sc]


def level_depths(h, zeta, theta_s: float, theta_b: float, hc: float, n: int, points: str = "rho", vtransform: int = 2) -> Column:
    """Depths of the levels of a column of water: an array, bottom first."""
    sc, cs = stretching(theta_s, theta_b, n, points, vtransform)
    h = F.when(_col(h) == 0, 1e-2).otherwise(_col(h).cast("double"))
    zeta = F.greatest(_col(zeta).cast("double"), 0.01 - h)
    levels = F.arrays_zip(F.array(*map(F.lit, sc)).alias("s"), F.array(*map(F.lit, cs)).alias("c"))

    def depth(level: Column) -> Column:
        s, c = level["s"], level["c"]
        if vtransform == 2:
            part = hc * s + c * h
            return part * h / (h + hc) + zeta * (1 + part / (h + hc))
        part = hc * (s - c) + c * h
        return part + zeta * (1 + part / h)

    return F.transform(levels, depth)


def at_depth(values, z, depth, method: str = "linear", bottom: bool = False) -> Column:
    """Value of a profile at a depth. Below the lowest level: null, or with ``bottom`` the lowest value; above the highest: extrapolated."""
    v, z, d = _col(values), _col(z), _col(depth)
    n = F.size(z)
    # bracketing level, 1 .. n-1 from the bottom; a profile of one level has no bracket
    k = F.greatest(F.lit(1), F.least(F.size(F.filter(z, lambda x: x < d)), n - 1))
    zu, zd, vu, vd = F.get(z, k), F.get(z, k - 1), F.get(v, k), F.get(v, k - 1)
    if method == "nearest":
        found = F.when(F.abs(zu - d) <= F.abs(zd - d), vu).otherwise(vd)
    elif method == "linear":
        found = F.try_divide((vu - vd) * d + vd * zu - vu * zd, zu - zd)
    else:
        raise ValueError(f"unknown method {method!r}: linear or nearest")
    lowest = F.get(v, F.lit(0)) if bottom else F.lit(None).cast("double")
    return F.when(d < F.get(z, F.lit(0)), lowest).otherwise(found)


def at_depth_strict(values, z, depth) -> Column:
    """As ``at_depth``, but null where no level is below the depth or the depth is above the highest level."""
    z = _col(z)
    inside = F.exists(z, lambda x: x < _col(depth)) & (_col(depth) <= F.get(z, F.size(z) - 1))
    return F.when(inside, at_depth(values, z, depth))


def at_surface_of(values, other, target) -> Column:
    """Value where another profile crosses a target, lowest crossing first: depth of an isotherm, temperature on an isohaline."""
    v, o, t = _col(values), _col(other), _col(target)
    pairs = F.zip_with(
        F.slice(F.arrays_zip(v.alias("v"), o.alias("o")), 1, F.greatest(F.size(o) - 1, F.lit(0))),
        F.slice(F.arrays_zip(v.alias("v"), o.alias("o")), 2, F.greatest(F.size(o) - 1, F.lit(0))),
        lambda a, b: F.struct(a["v"].alias("va"), a["o"].alias("oa"), b["v"].alias("vb"), b["o"].alias("ob")),
    )
    crossing = F.filter(pairs, lambda p: ((p["oa"] - t) * (p["ob"] - t) <= 0) & (p["oa"] != p["ob"]))
    hit = F.get(crossing, F.lit(0))
    return hit["va"] + F.try_divide((t - hit["oa"]) * (hit["vb"] - hit["va"]), hit["ob"] - hit["oa"])


def _neighbours(values: Column, f: Callable[[Column, Column], Column]) -> Column:
    n = F.greatest(F.size(values) - 1, F.lit(0))
    return F.zip_with(F.slice(values, 1, n), F.slice(values, 2, n), f)


def to_rho(values) -> Column:
    """Means of adjacent w points."""
    return _neighbours(_col(values), lambda a, b: (a + b) / 2)


def to_w(values) -> Column:
    """Means of adjacent levels; the end points repeat the end levels."""
    v = _col(values)
    return F.concat(F.slice(v, 1, 1), _neighbours(v, lambda a, b: (a + b) / 2), F.slice(v, -1, 1))


def differences(values) -> Column:
    return _neighbours(_col(values), lambda a, b: b - a)


def gradient(values, z) -> Column:
    """Vertical derivative between adjacent levels."""
    return F.zip_with(differences(values), differences(z), lambda dv, dz: F.try_divide(dv, dz))


def _with_ends(inner: Column) -> Column:
    return F.concat(F.slice(inner, 1, 1), inner, F.slice(inner, -1, 1))


def buoyancy_frequency(rho, z, rho0: float = RHO0, g: float = G) -> Column:
    """Squared buoyancy frequency at w points; the ends repeat their neighbours."""
    return _with_ends(F.transform(gradient(rho, z), lambda x: -g / rho0 * x))


def richardson(rho, u, v, z) -> Column:
    """log10 of the gradient Richardson number between levels; null where it is not positive."""
    n2 = F.transform(gradient(rho, z), lambda x: -G / RHO0 * x)
    shear = F.zip_with(gradient(u, z), gradient(v, z), lambda a, b: a * a + b * b)
    return F.zip_with(n2, shear, lambda n, s: F.when(n * s > 0, F.log10(F.try_divide(n, s))))


def layer_thickness(z_w) -> Column:
    return differences(z_w)


def integral(values, z_w) -> Column:
    """Sum of value times thickness over a column."""
    return F.aggregate(F.zip_with(_col(values), layer_thickness(z_w), lambda v, d: v * d), F.lit(0.0), lambda a, x: a + x)


def integral_between(values, z_w, lower, upper) -> tuple[Column, Column]:
    """Integral over a depth range and the thickness covered, with part cells at the ends."""
    lo, hi = _col(lower), _col(upper)
    cells = F.zip_with(
        F.arrays_zip(F.slice(_col(z_w), 1, F.size(_col(z_w)) - 1).alias("a"), F.slice(_col(z_w), 2, F.size(_col(z_w)) - 1).alias("b")),
        _col(values),
        lambda e, v: F.struct(F.greatest(F.least(e["b"], hi) - F.greatest(e["a"], lo), F.lit(0.0)).alias("d"), v.alias("v")),
    )
    total = lambda f: F.aggregate(F.transform(cells, f), F.lit(0.0), lambda a, x: a + x)
    return total(lambda c: c["d"] * c["v"]), total(lambda c: c["d"])


def depth_mean(values, z_w) -> Column:
    z = _col(z_w)
    return F.try_divide(integral(values, z), F.get(z, F.size(z) - 1) - F.get(z, F.lit(0)))


def conserve_transport(values, z_w, target) -> Column:
    """A profile shifted so that its depth mean is the target."""
    shift = _col(target) - depth_mean(values, z_w)
    # as an element of an array the shift is worked out once, not for each level
    return F.element_at(F.transform(F.array(shift), lambda by: F.transform(_col(values), lambda x: x + by)), 1)


def z_to_sigma(values, z, target_z) -> Column:
    """A profile on fixed depths (bottom first) moved to other levels: linear, the end layers repeat."""
    v, z = _col(values), _col(z)
    lowest, highest = F.get(v, F.lit(0)), F.get(v, F.size(v) - 1)

    def one(d: Column) -> Column:
        inside = at_depth(v, z, d)
        return F.when(d <= F.get(z, F.lit(0)), lowest).when(d >= F.get(z, F.size(z) - 1), highest).otherwise(inside)

    return F.transform(_col(target_z), one)


def stratification(rho_of: Callable[[Column, Column], Column], temp, salt, z, target_depth: float = 5.0, deep_depth: float = 50.0) -> Column:
    """Surface-pressure density at depth less that near the surface; where the water is shallower, the lowest level stands for depth."""
    t, s = _col(temp), _col(salt)
    deep_t = F.coalesce(at_depth(t, z, -deep_depth), F.get(t, F.lit(0)))
    deep_s = F.coalesce(at_depth(s, z, -deep_depth), F.get(s, F.lit(0)))
    return rho_of(deep_t, deep_s) - rho_of(at_depth(t, z, -target_depth), at_depth(s, z, -target_depth))


def bottom_depth(values, z, half_thickness: float = 0.0) -> Column:
    """Depth of the deepest level that has a value."""
    pairs = F.filter(F.arrays_zip(_col(values).alias("v"), _col(z).alias("z")), lambda p: p["v"].isNotNull())
    return F.array_min(F.transform(pairs, lambda p: p["z"])) - half_thickness


def harmonic(values) -> Column:
    """Harmonic means of adjacent differences of a profile, at w points; the ends repeat the end differences."""
    d = differences(values)
    inner = _neighbours(d, lambda a, b: F.coalesce(F.try_divide(2 * a * b, a + b), F.lit(0.0)))
    return F.concat(F.slice(d, 1, 1), inner, F.slice(d, -1, 1))


def with_pressure(df: DataFrame, rho: str, z_r: str, z_w: str, out: str = "pressure", rho0: float = RHO0, g: float = G) -> DataFrame:
    """Adds pressure (over rho0) at levels, summed from the surface down with the cubic end corrections.

    The harmonic differences become columns first: a lambda would work them out anew for each level.
    """
    df = df.withColumns({"__dr": harmonic(rho), "__dz": harmonic(z_r)})
    r, zr, zw, dr, dz = map(F.col, (rho, z_r, z_w, "__dr", "__dz"))
    n = F.size(r)
    top = lambda a, k: F.get(a, F.size(a) - 1 - k)
    gr = g / rho0
    rise = top(zw, 0) - top(zr, 0)
    surface = g * top(zw, 0) + gr * (top(r, 0) + 0.5 * (top(r, 0) - top(r, 1)) * F.try_divide(rise, top(zr, 0) - top(zr, 1))) * rise

    def step(k: Column) -> Column:
        z, d = F.get(zr, k + 1) - F.get(zr, k), F.get(r, k + 1) - F.get(r, k)
        bend = (F.get(dr, k + 1) - F.get(dr, k)) * (z - (F.get(dz, k + 1) + F.get(dz, k)) / 24)
        bend -= (F.get(dz, k + 1) - F.get(dz, k)) * (d - (F.get(dr, k + 1) + F.get(dr, k)) / 24)
        return 0.5 * gr * ((F.get(r, k) + F.get(r, k + 1)) * z - 0.2 * bend)

    steps = F.transform(F.sequence(F.lit(0), n - 2), step)
    df = df.withColumn("__steps", F.when(n >= 2, F.concat(F.array(surface), F.reverse(steps))))
    summed = F.aggregate(
        "__steps",
        F.array().cast("array<double>"),
        lambda acc, x: F.concat(acc, F.array(x + F.coalesce(F.try_element_at(acc, F.lit(-1)), F.lit(0.0)))),
    )
    return df.withColumn(out, F.reverse(summed)).drop("__dr", "__dz", "__steps")
