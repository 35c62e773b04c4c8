"""Scalar formulas as column expressions: sea water, vectors, forcing units, tides, distances.

Every function takes and returns columns, so that the formulas stay in generated code. A null in
an input gives null.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

G = 9.81
RADIUS_SECTION, RADIUS_MEAN, RADIUS_RIVER = 6367442.76, 6371000.0, 6371000.0


def _col(x) -> Column:
    return F.col(x) if isinstance(x, str) else x if isinstance(x, Column) else F.lit(float(x))


def polynomial(x: Column, *coefficients: float) -> Column:
    """Horner form, lowest power first."""
    out = F.lit(coefficients[-1])
    for c in reversed(coefficients[:-1]):
        out = out * x + F.lit(c)
    return out


# Coefficients of the EOS-80 equation of state, lowest power of temperature first.
EOS80 = {
    "rho_w": (999.842594, 6.793952e-2, -9.095290e-3, 1.001685e-4, -1.120083e-6, 6.536332e-9),
    "b": (8.24493e-1, -4.0899e-3, 7.6438e-5, -8.2467e-7, 5.3875e-9),
    "c": (-5.72466e-3, 1.0227e-4, -1.6546e-6),
    "d": (4.8314e-4,),
    "kw": (19652.21, 148.4206, -2.327105, 1.360477e-2, -5.155288e-5),
    "f1": (54.6746, -0.603459, 1.09987e-2, -6.1670e-5),
    "f2": (7.944e-2, 1.6483e-2, -5.3009e-4),
    "aw": (3.239908, 1.43713e-3, 1.16092e-4, -5.77905e-7),
    "g1": (2.2838e-3, -1.0981e-5, -1.6078e-6),
    "g2": (1.91075e-4,),
    "bw": (8.50935e-5, -6.12293e-6, 5.2787e-8),
    "h1": (-9.9348e-7, 2.0816e-8, 9.1697e-10),
}


def eos80_density(temp, salt, pressure) -> Column:
    """In-situ density (kg/m3) from degC, PSU and dbar."""
    t, s, p = _col(temp), _col(salt), _col(pressure) / 10
    k = {name: polynomial(t, *c) for name, c in EOS80.items()}
    root = s * F.sqrt(s)
    surface = k["rho_w"] + k["b"] * s + k["c"] * root + k["d"] * s * s
    bulk = (
        k["kw"] + k["f1"] * s + k["f2"] * root
        + (k["aw"] + k["g1"] * s + k["g2"] * root) * p
        + (k["bw"] + k["h1"] * s) * p * p
    )
    return surface / (1 - p / bulk)


# Coefficients of the model's own equation of state, lowest power of temperature first.
MODEL_EOS = {
    "r0": (999.842594, 6.793952e-2, -9.095290e-3, 1.001685e-4, -1.120083e-6, 6.536332e-9),
    "r1": (0.824493, -4.08990e-3, 7.64380e-5, -8.24670e-7, 5.38750e-9),
    "rs": (-5.72466e-3, 1.02270e-4, -1.65460e-6),
    "r2": (4.8314e-4,),
    "k0": (0.0, 209.8925, -3.041638, -1.852732e-3, -1.361629e-5),
    "k1": (104.4077, -6.500517, 0.1553190, 2.326469e-4),
    "ks": (-5.587545, 0.7390729, -1.909078e-2),
    "b0": (0.4721788, 0.01028859, -2.512549e-4, -5.939910e-7),
    "b1": (-0.01571896, -2.598241e-4, 7.267926e-6),
    "bs": (2.042967e-3,),
    "e0": (1.045941e-5, -5.782165e-10, 1.296821e-7),
    "e1": (-2.595994e-7, -1.248266e-9, -3.508914e-9),
}
K00, T_REF, S_REF, QP2 = 19092.56, 3.8, 34.5, 1.72e-5


def model_density(temp, salt, z, rho0: float = 1025.0, split: bool = True) -> Column:
    """Density anomaly to ``rho0`` at depth z (negative); ``split`` separates the compressibility."""
    t, s, z = _col(temp), _col(salt), _col(z)

    def k0(t: Column, s: Column) -> Column:
        c = {n: polynomial(t, *MODEL_EOS[n]) for n in ("k0", "k1", "ks")}
        return c["k0"] + s * (c["k1"] + F.sqrt(s) * c["ks"])

    c = {n: polynomial(t, *v) for n, v in MODEL_EOS.items()}
    rho1 = c["r0"] - rho0 + s * (c["r1"] + F.sqrt(s) * c["rs"] + s * c["r2"])
    if split:
        at_reference = k0(F.lit(T_REF), F.lit(S_REF))
        qp1 = 0.1 * (rho0 + rho1) * (1 / (K00 + k0(t, s)) - 1 / (K00 + at_reference))
        return rho1 + qp1 * z * (1 - QP2 * z)
    k1 = c["b0"] + s * (c["b1"] + F.sqrt(s) * c["bs"])
    k2 = c["e0"] + s * c["e1"]
    return rho1 / (1 - 0.1 * z / (K00 + k0(t, s) + k1 * z + k2 * z * z))


def rotate(u, v, angle) -> tuple[Column, Column]:
    """Grid-aligned to east and north components."""
    u, v, a = _col(u), _col(v), _col(angle)
    return u * F.cos(a) - v * F.sin(a), v * F.cos(a) + u * F.sin(a)


def rotate_to_grid(u, v, angle) -> tuple[Column, Column]:
    u, v, a = _col(u), _col(v), _col(angle)
    return u * F.cos(a) + v * F.sin(a), v * F.cos(a) - u * F.sin(a)


def across_along(u, v, bearing) -> tuple[Column, Column]:
    """Components across (to the right turned to the left side) and along a section of a bearing."""
    u, v, b = _col(u), _col(v), _col(bearing)
    return v * F.sin(b) - u * F.cos(b), u * F.sin(b) + v * F.cos(b)


def speed(u, v) -> Column:
    return F.hypot(_col(u), _col(v))


def kinetic_energy(u, v) -> Column:
    u, v = _col(u), _col(v)
    return 0.5 * (u * u + v * v)


def chlorophyll(small, large) -> Column:
    """From nitrogen in small and large plankton; null where not positive."""
    c = 0.020 * (_col(small) + _col(large)) * 6.625 * 12
    return F.when(c > 0, c)


def kelvin_to_celsius(t) -> Column:
    return _col(t) - 273.15


def percent_to_fraction(x) -> Column:
    return _col(x) / 100


def rain_cm_per_day(flux) -> Column:
    """From kg m-2 s-1; traces below 1e-4 are zero."""
    p = _col(flux) * 0.1 * 86400
    return F.when(F.abs(p) < 1e-4, 0.0).otherwise(p)


def rain_from_mm_per_hour(x) -> Column:
    return _col(x) * 2.4


def net_shortwave(down, up) -> Column:
    n = _col(down) - _col(up)
    return F.when(n < 1e-10, 0.0).otherwise(n)


def net_shortwave_by_albedo(down, albedo: float = 0.06) -> Column:
    return _col(down) * (1 - albedo)


def net_longwave(up, down) -> Column:
    return _col(up) - _col(down)


def wind_stress(u, wind, drag, air_density) -> Column:
    return _col(drag) * _col(air_density) * _col(u) * _col(wind)


def coriolis(lat) -> Column:
    return 4 * math.pi * F.sin(F.radians(_col(lat))) * 366.25 / (24 * 3600 * 365.25)


def degrees_to_metres(dlon, dlat, lat) -> tuple[Column, Column]:
    metres = 111_000.0
    return _col(dlon) * metres * F.cos(F.radians(_col(lat))), _col(dlat) * metres


def wave_direction(nautical) -> Column:
    return (270 - _col(nautical)) * (math.pi / 180)


def great_circle(lat1, lon1, lat2, lon2, radius: float = RADIUS_SECTION) -> Column:
    """Distance by the two-argument arc tangent; longitudes may wrap."""
    l = F.abs(_col(lon2) - _col(lon1))
    l = F.radians(F.when(l > 180, 360 - l).otherwise(l))
    a, b = F.radians(_col(lat1)), F.radians(_col(lat2))
    y = F.hypot(F.sin(l) * F.cos(b), F.sin(b) * F.cos(a) - F.cos(b) * F.sin(a) * F.cos(l))
    return radius * F.atan2(y, F.sin(b) * F.sin(a) + F.cos(b) * F.cos(a) * F.cos(l))


def haversine(lat1, lon1, lat2, lon2, radius: float = RADIUS_MEAN) -> Column:
    a, b = F.radians(_col(lat1)), F.radians(_col(lat2))
    h = F.sin((b - a) / 2) ** 2 + F.cos(a) * F.cos(b) * F.sin(F.radians(_col(lon2) - _col(lon1)) / 2) ** 2
    return 2 * radius * F.asin(F.least(F.sqrt(h), F.lit(1.0)))


def arc_cosine_distance(lat1, lon1, lat2, lon2, radius: float = RADIUS_RIVER) -> Column:
    a, b = F.radians(_col(lat1)), F.radians(_col(lat2))
    c = F.sin(a) * F.sin(b) + F.cos(a) * F.cos(b) * F.cos(F.radians(_col(lon2) - _col(lon1)))
    return radius * F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), c)))


def tidal_ellipse(au, phu, av, phv) -> dict[str, Column]:
    """Semi-major axis, eccentricity, inclination and phase (degrees in [0, 360)) of a tidal current."""
    # u + iv turns both ways at once: (x, y) of its left-hand and of its right-hand rotation at time zero
    east, north = ((_col(a) * F.cos(F.radians(_col(p))), -_col(a) * F.sin(F.radians(_col(p)))) for a, p in ((au, phu), (av, phv)))
    left = ((east[0] - north[1]) / 2, (east[1] + north[0]) / 2)
    right = ((east[0] + north[1]) / 2, (north[0] - east[1]) / 2)
    (big, start), (small, end) = ((F.hypot(x, y), F.atan2(y, x)) for x, y in (left, right))
    wrap = lambda x: F.when(x < 0, x + 360).otherwise(x)
    return {
        "semi_major": big + small,
        "eccentricity": F.try_divide(big - small, big + small),
        "inclination": wrap(F.degrees((end + start) / 2)),
        "phase": wrap(F.degrees((end - start) / 2)),
    }


def to_real_imaginary(amplitude, phase) -> tuple[Column, Column]:
    a, p = _col(amplitude), F.radians(_col(phase))
    return a * F.cos(p), a * F.sin(p)


def to_amplitude_phase(re, im) -> tuple[Column, Column]:
    re, im = _col(re), _col(im)
    return F.hypot(re, im), F.pmod(F.degrees(F.atan2(im, re)) + 360, F.lit(360.0))


def equilibrium_tide(amplitude, elasticity, period_h, lat, lon) -> tuple[Column, Column]:
    """Real and imaginary potential of a constituent by its species: below 13 h twice a day, below 26 h once, else long."""
    p, lat, lon = _col(period_h), F.radians(_col(lat)), F.radians(_col(lon))
    species = F.when(p < 13, 2).when(p < 26, 1).otherwise(0)
    shape = F.when(p < 13, F.cos(lat) ** 2).when(p < 26, F.sin(2 * lat)).otherwise(0.5 - 1.5 * F.sin(lat) ** 2)
    size = _col(amplitude) * _col(elasticity) * shape
    return size * F.cos(species * lon), -size * F.sin(species * lon)


def unpack(packed, scale: float, offset: float, fill: float) -> Column:
    """Packed integers to values; what reaches nine tenths of a (negative) fill value is null."""
    v = _col(packed)
    return F.when(v <= 0.9 * fill, None).otherwise(v * scale + offset)


def blend_weight(distance_degrees) -> Column:
    """Weight of the parent depth by the distance from the boundary."""
    return 0.5 * F.tanh(50 * (_col(distance_degrees) - 0.06)) + 0.5


def runoff_direction(up, right, left, down) -> tuple[Column, Column]:
    """Axis (0 along xi, 1 along eta) and sign of river inflow from the land flags of the four neighbours; null in open water or on an enclosed cell.

    ``right`` and ``left`` name the flags in the order of the pattern table below.
    """
    pattern = 8 * _col(up) + 4 * _col(right) + 2 * _col(left) + _col(down)
    axis = sign = None
    for bits, (a, s) in RUNOFF.items():
        hit = pattern == bits
        axis = F.when(hit, a) if axis is None else axis.when(hit, a)
        sign = F.when(hit, s) if sign is None else sign.when(hit, s)
    return axis, sign


def runoff_shift(up, right, left, down) -> tuple[Column, Column]:
    """Steps along xi and eta from a river's coastal cell to the index of its source, by the same pattern: -1 where the land beside it is left of or below it."""
    pattern = 8 * _col(up) + 4 * _col(right) + 2 * _col(left) + _col(down)
    shift = lambda bits: F.when(pattern.isin(*bits), -1).when(pattern.between(0, 15), 0)
    return shift(RUNOFF_LEFT), shift(RUNOFF_DOWN)


# The land patterns whose source lies one cell to the left, or below.
RUNOFF_LEFT, RUNOFF_DOWN = (2, 3, 10, 13), (1, 7)
# Land pattern (up, right, left, down as bits 8, 4, 2, 1) to axis and sign.
RUNOFF = {
    4: (0, -1), 2: (0, 1), 8: (1, -1), 1: (1, 1), 9: (1, 1), 6: (0, 1), 12: (0, -1), 5: (0, -1),
    3: (0, 1), 10: (0, 1), 14: (1, -1), 7: (1, 1), 13: (0, 1), 11: (0, 1),
}
