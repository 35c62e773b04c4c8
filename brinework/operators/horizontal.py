"""Stencils and regridding on (eta, xi) tables.

Linear stencils emit each value to the cells that use it and aggregate once (one exchange);
stencils that look at missing neighbours use lag and lead along one axis.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from brinework.operators.timeaxis import masked_difference


def _emit(df: DataFrame, axis: str, shifts: tuple[int, ...], out: str) -> DataFrame:
    return df.withColumn(out, F.explode(F.array(*[F.col(axis) + k for k in shifts]))).drop(*([axis] if axis != out else []))


def staggered_to_rho(df: DataFrame, by: list[str], axis: str, out: str, last: Column, value: str = "value") -> DataFrame:
    """Mean of the two staggered neighbours along an axis; at the edges the one that exists.

    u on ``xi_u`` goes to ``xi`` (xi_u and xi_u + 1), v on ``eta_v`` to ``eta``; ``last`` is the
    largest index of the centre grid along the axis.
    """
    sent = _emit(df, axis, (0, 1), out).where(F.col(out) <= last)
    return sent.groupBy(*by, out).agg(F.avg(value).alias(value))


def arrays_to_rho(df: DataFrame, by: list[str], axis: str, out: str, value: str = "value") -> DataFrame:
    """The same for profiles: element-wise means of two arrays, one exchange for all levels."""
    sent = _emit(df, axis, (0, 1), out)
    pair = F.collect_list(value)  # two neighbours at most
    return sent.groupBy(*by, out).agg(pair.alias("__p")).select(
        *by, out,
        F.when(F.size("__p") == 1, F.get("__p", F.lit(0)))
        .otherwise(F.zip_with(F.get("__p", F.lit(0)), F.get("__p", F.lit(1)), lambda a, b: (a + b) / 2)).alias(value),
    )


def rho_to_staggered(df: DataFrame, by: list[str], points: str, value: str = "value") -> DataFrame:
    """Means at u (two along xi), v (two along eta) or psi (four) points; only where all neighbours exist and have a value."""
    along = {"u": [("xi", "xi_u")], "v": [("eta", "eta_v")], "psi": [("xi", "xi_u"), ("eta", "eta_v")]}[points]
    sent, names = df, {"eta": "eta", "xi": "xi"}
    for axis, out in along:
        sent = _emit(sent, axis, (0, -1), out)
        names[axis] = out
    need = 2 ** len(along)
    return sent.groupBy(*by, *names.values()).agg(F.avg(value).alias(value), F.count(value).alias("__n")).where(F.col("__n") == need).drop("__n")


def staggered_masks(grid: DataFrame, points: str) -> DataFrame:
    """Product of the masks of the neighbours."""
    means = rho_to_staggered(grid.select("eta", "xi", F.col("mask").cast("double").alias("value")), [], points)
    return means.select(*[c for c in means.columns if c != "value"], (F.col("value") == 1).cast("int").alias("mask"))


def psi_to_rho(psi: DataFrame, grid: DataFrame, eta_max: int, xi_max: int, by: list[str] | None = None, value: str = "value") -> DataFrame:
    """Mean of the four psi points around an inner cell; border cells copy the nearest inner cell."""
    by = by or []
    sent = _emit(_emit(psi, "xi_u", (0, 1), "xi"), "eta_v", (0, 1), "eta")
    inner = sent.where((F.col("eta").between(1, eta_max - 1)) & F.col("xi").between(1, xi_max - 1)).groupBy(*by, "eta", "xi").agg(F.avg(value).alias(value))
    clamp = lambda c, n: F.greatest(F.lit(1), F.least(F.lit(n - 1), F.col(c)))
    cells = grid.select("eta", "xi", clamp("eta", eta_max).alias("__e"), clamp("xi", xi_max).alias("__x"))
    return cells.join(inner.withColumnsRenamed({"eta": "__e", "xi": "__x"}), ["__e", "__x"]).select(*by, "eta", "xi", value)


def front_magnitude(field: DataFrame, by: list[str], value: str, out: str = "front") -> DataFrame:
    """Size of the horizontal gradient per kilometre from (eta, xi, pm, pn, value), beside missing neighbours one-sided."""
    d = masked_difference(field, [*by, "eta"], "xi", value, "__dx")
    d = masked_difference(d, [*by, "xi"], "eta", value, "__dy")
    return d.withColumn(out, F.hypot(F.col("__dx") * F.col("pm"), F.col("__dy") * F.col("pn")) * 1000).drop("__dx", "__dy")


def relative_vorticity(u: DataFrame, v: DataFrame, metrics: DataFrame, by: list[str]) -> DataFrame:
    """(by, eta_v, xi_u, vorticity) at psi points: dv/dx pm - du/dy pn with metrics averaged to psi.

    u is (by, eta, xi_u, u), v is (by, eta_v, xi, v).
    """
    dv = v.select(*by, "eta_v", F.explode(F.array(
        F.struct(F.col("xi").alias("xi_u"), (-F.col("v")).alias("d")), F.struct((F.col("xi") - 1).alias("xi_u"), F.col("v").alias("d"))
    )).alias("s")).select(*by, "eta_v", "s.*")
    du = u.select(*by, "xi_u", F.explode(F.array(
        F.struct(F.col("eta").alias("eta_v"), (-F.col("u")).alias("d")), F.struct((F.col("eta") - 1).alias("eta_v"), F.col("u").alias("d"))
    )).alias("s")).select(*by, "xi_u", "s.*")
    diff = lambda x, name: x.groupBy(*by, "eta_v", "xi_u").agg(F.sum("d").alias(name), F.count("d").alias("n")).where("n = 2").drop("n")
    psi = rho_to_staggered(metrics.select("eta", "xi", F.struct("pm", "pn").alias("m")).select("eta", "xi", F.col("m.pm").alias("value")), [], "psi").withColumnRenamed("value", "pm")
    psi_n = rho_to_staggered(metrics.select("eta", "xi", F.col("pn").alias("value")), [], "psi").withColumnRenamed("value", "pn")
    return (
        diff(dv, "dv").join(diff(du, "du"), [*by, "eta_v", "xi_u"]).join(psi, ["eta_v", "xi_u"]).join(psi_n, ["eta_v", "xi_u"])
        .select(*by, "eta_v", "xi_u", (F.col("dv") * F.col("pm") - F.col("du") * F.col("pn")).alias("vorticity"))
    )


def crossings(cells: DataFrame, by: list[str], axis: str, other: str, targets: list[float], values: list[str]) -> DataFrame:
    """(by, target, number, position, values): every place along an axis (eta, xi or level) at which a field takes a target value, numbered from the start.

    Between neighbours on either side of the target the place and the values are interpolated; a cell
    right at the target counts once, a stretch of such cells with its last one. A missing cell or
    value breaks the line. Values may be coordinates, so a line of constant longitude is a section.
    """
    w = Window.partitionBy(*by).orderBy(axis)
    beside = F.lead(axis).over(w) == F.col(axis) + 1
    nxt = lambda c: F.when(beside, F.lead(c).over(w))
    pairs = cells.where(F.col(other).isNotNull()).withColumns({"__o": nxt(other)} | {f"__n{k}": nxt(v) for k, v in enumerate(values)})
    rows = pairs.withColumn("target", F.explode(F.array(*[F.lit(float(t)) for t in targets])))
    a, b = F.col(other) - F.col("target"), F.col("__o") - F.col("target")
    rows = rows.where(((a == 0) & ~F.coalesce(b == 0, F.lit(False))) | (a * b < 0))
    part = F.when(a == 0, 0.0).otherwise(a / (a - b))
    out = [F.when(part == 0, F.col(v)).otherwise(F.col(v) + part * (F.col(f"__n{k}") - F.col(v))).alias(v) for k, v in enumerate(values)]
    number = F.row_number().over(Window.partitionBy(*by, "target").orderBy("position"))
    return rows.select(*by, "target", (F.col(axis) + part).alias("position"), *out).withColumn("number", number).select(*by, "target", "number", "position", *values)


def land_neighbours(grid: DataFrame, corners: bool = False) -> DataFrame:
    """(eta, xi, mask, land): how many of the four (or eight) neighbours are land, and which of the four as flags."""
    steps = {"up": (1, 0), "down": (-1, 0), "left": (0, -1), "right": (0, 1)}
    moves = list(steps.values()) + ([(1, 1), (1, -1), (-1, 1), (-1, -1)] if corners else [])
    # each land cell tells its neighbours; the move from the neighbour to the land names the side
    told = grid.where("mask = 0").select(
        F.explode(F.array(*[F.struct((F.col("eta") - de).alias("eta"), (F.col("xi") - dx).alias("xi"), F.lit(k).alias("k")) for k, (de, dx) in enumerate(moves)])).alias("s")
    ).select("s.*")
    sides = told.groupBy("eta", "xi").agg(
        F.count(F.lit(1)).alias("land"), *[F.max((F.col("k") == k).cast("int")).alias(f"land_{n}") for k, n in enumerate(steps)]
    )
    zero = {c: F.coalesce(c, F.lit(0)) for c in ["land", *[f"land_{n}" for n in steps]]}
    return grid.select("eta", "xi", "mask").join(sides, ["eta", "xi"], "left").withColumns(zero)


def apply_weights(field: DataFrame, weights: DataFrame, by: list[str], values: list[str]) -> DataFrame:
    """(by, out_cell, values): weighted sums of source cells; a missing source cell makes the result missing.

    ``weights`` (out_cell, eta, xi, w) is built once and reused for every time, depth and variable.
    """
    need = weights.groupBy("out_cell").agg(F.count(F.lit(1)).alias("__need"))
    got = field.join(weights, ["eta", "xi"]).groupBy(*by, "out_cell").agg(
        *[F.sum(F.col("w") * F.col(v)).alias(v) for v in values], *[F.count(v).alias(f"__{v}") for v in values]
    )
    return got.join(need, "out_cell").select(*by, "out_cell", *[F.when(F.col(f"__{v}") == F.col("__need"), F.col(v)).alias(v) for v in values])


def regular_axis(grid: DataFrame, spacing: float) -> DataFrame:
    """(lon0, lat0, nx, ny) of a regular grid whose ends are snapped outwards to the spacing."""
    down = lambda c: F.floor(F.min(c) / spacing) * spacing
    up = lambda c: F.ceil(F.max(c) / spacing) * spacing
    return grid.agg(
        down("lon").alias("lon0"), down("lat").alias("lat0"),
        (F.round((up("lon") - down("lon")) / spacing).cast("int") + 1).alias("nx"), (F.round((up("lat") - down("lat")) / spacing).cast("int") + 1).alias("ny"),
    )


def regular_cells(axis: DataFrame, spacing: float) -> DataFrame:
    """(out_cell, lon, lat) of a regular grid."""
    return (
        axis.withColumn("i", F.explode(F.sequence(F.lit(0), F.col("nx") - 1)))
        .withColumn("j", F.explode(F.sequence(F.lit(0), F.col("ny") - 1)))
        .select((F.col("j").cast("bigint") * F.col("nx") + F.col("i")).alias("out_cell"), (F.col("lon0") + F.col("i") * spacing).alias("lon"), (F.col("lat0") + F.col("j") * spacing).alias("lat"))
    )


def triangle_weights(grid: DataFrame, cells: DataFrame, tile: float) -> DataFrame:
    """Barycentric weights (out_cell, eta, xi, w) of regular cells in the two triangles of each grid quad.

    Quads and cells meet by tile: a quad is sent to the tiles that its box covers. A small
    vectorised helper finds the containing triangle among the quads of a tile; cells outside
    every triangle get no row.
    """
    g = grid.select("eta", "xi", "lon", "lat")
    corner = lambda de, dx, n: g.select((F.col("eta") - de).alias("eta"), (F.col("xi") - dx).alias("xi"), F.struct("lon", "lat").alias(n))
    quads = corner(0, 0, "a").join(corner(0, 1, "b"), ["eta", "xi"]).join(corner(1, 0, "c"), ["eta", "xi"]).join(corner(1, 1, "d"), ["eta", "xi"])
    span = lambda f, n: F.floor(f(*[F.col(f"{k}.{n}") for k in "abcd"]) / tile).cast("int")
    tiled = (
        quads.withColumn("tx", F.explode(F.sequence(span(F.least, "lon"), span(F.greatest, "lon"))))
        .withColumn("ty", F.explode(F.sequence(span(F.least, "lat"), span(F.greatest, "lat"))))
        .select("tx", "ty", "eta", "xi", *[F.col(f"{k}.{n}").alias(f"{k}_{n}") for k in "abcd" for n in ("lon", "lat")])
    )
    placed = cells.withColumn("tx", F.floor(F.col("lon") / tile).cast("int")).withColumn("ty", F.floor(F.col("lat") / tile).cast("int"))
    near = placed.join(tiled, ["tx", "ty"])

    def weigh(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in batches:
            found = []
            for corners, moves in (("abc", ((0, 0), (0, 1), (1, 0))), ("dbc", ((1, 1), (0, 1), (1, 0)))):
                x, y = ([p[f"{k}_{n}"].to_numpy() for k in corners] for n in ("lon", "lat"))
                det = (y[1] - y[2]) * (x[0] - x[2]) + (x[2] - x[1]) * (y[0] - y[2])
                with np.errstate(divide="ignore", invalid="ignore"):
                    w0 = ((y[1] - y[2]) * (p.lon - x[2]) + (x[2] - x[1]) * (p.lat - y[2])) / det
                    w1 = ((y[2] - y[0]) * (p.lon - x[2]) + (x[0] - x[2]) * (p.lat - y[2])) / det
                w = np.stack([w0, w1, 1 - w0 - w1])
                inside = (w >= -1e-9).all(axis=0)
                for k, (de, dx) in enumerate(moves):
                    found.append(pd.DataFrame({"out_cell": p.out_cell[inside], "triangle": (2 * (p.eta.astype("int64") * (1 << 31) + p.xi) + (corners == "dbc"))[inside], "eta": p.eta[inside] + de, "xi": p.xi[inside] + dx, "w": w[k][inside]}))
            yield pd.concat(found)

    hits = near.mapInPandas(weigh, "out_cell bigint, triangle bigint, eta int, xi int, w double")
    first = hits.groupBy("out_cell").agg(F.min("triangle").alias("triangle"))  # a cell on an edge lies in two
    return hits.join(first, ["out_cell", "triangle"]).drop("triangle")


def _envelope(rows: np.ndarray, squares: np.ndarray, wanted: np.ndarray) -> list[int]:
    """For each wanted row the position of the candidate row with the least (row distance squared + its square), of equals the first row.

    Candidates are parabolas over the rows; those that are lowest somewhere stay on a stack with the
    row from which they are, so the work is linear in the candidates. All numbers are integers.
    """
    order = np.argsort(rows, kind="stable")
    stack, begins = [], []
    for k in order.tolist():
        e, g = int(rows[k]), int(squares[k])
        begin = None
        while stack:
            at, low = int(rows[stack[-1]]), int(squares[stack[-1]])
            begin = (e * e + g - at * at - low) // (2 * (e - at)) + 1  # the first row where the later one is lower
            if begin > begins[-1]:
                break
            stack.pop()
            begins.pop()
        stack.append(k)
        begins.append(begin if len(stack) > 1 else -(1 << 62))
    return [stack[j] for j in (np.searchsorted(np.array(begins), wanted, side="right") - 1).tolist()] if stack else [None] * len(wanted)


def fill_nearest(df: DataFrame, by: list[str], value: str) -> DataFrame:
    """Missing cells take the value of the nearest valid cell of their group in index space; a group without one stays missing.

    Of equals the first in (eta, xi) order. A distance transform in two passes: within each row, every
    column that misses a value somewhere finds the row's nearest valid cell; within each such
    column, the least sum of the squared distances decides. The exchanges are the same for any hole.
    Rows without a place stay as they are.
    """
    group = F.struct(*by) if by else F.lit(0)
    placed = F.col("eta").isNotNull() & F.col("xi").isNotNull()
    cells = df.where(placed).withColumn("__g", group)
    known = cells.where(F.col(value).isNotNull())
    missing = cells.where(F.col(value).isNull())
    rows = known.groupBy("__g", F.col("eta").cast("bigint").alias("__e")).agg(F.sort_array(F.collect_list(F.struct(F.col("xi").cast("bigint").alias("x"), F.col(value).alias("v")))).alias("__k"))
    columns = missing.groupBy("__g").agg(F.sort_array(F.collect_set(F.col("xi").cast("bigint"))).alias("__c"))
    met = rows.join(columns, "__g") if by else rows.crossJoin(F.broadcast(columns.drop("__g")))  # one row, as long as the grid is wide

    @F.pandas_udf("array<int>")
    def beside(known: pd.Series, wanted: pd.Series) -> pd.Series:
        def one(k: np.ndarray, c: np.ndarray) -> np.ndarray:
            right = np.searchsorted(k, c)
            left = np.maximum(right - 1, 0)
            right = np.minimum(right, len(k) - 1)
            return np.where(np.abs(c - k[left]) <= np.abs(k[right] - c), left, right).astype(np.int32)

        return pd.Series([one(np.asarray(k), np.asarray(c)) for k, c in zip(known, wanted)])

    @F.pandas_udf("array<int>")
    def lowest(rows: pd.Series, squares: pd.Series, wanted: pd.Series) -> pd.Series:
        return pd.Series([_envelope(np.asarray(r, np.int64), np.asarray(s, np.int64), np.asarray(w, np.int64)) for r, s, w in zip(rows, squares, wanted)])

    picked = met.withColumn("__i", beside(F.transform("__k", lambda k: k["x"]), F.col("__c")))
    near = F.transform(F.arrays_zip("__c", "__i"), lambda z: F.struct(z["__c"].alias("x"), F.get("__k", z["__i"]).alias("k")))
    candidates = picked.select("__g", "__e", F.explode(near).alias("n")).select(
        "__g", F.col("n.x").alias("__x"), F.struct(F.col("__e").alias("e"), ((F.col("n.k.x") - F.col("n.x")) ** 2).cast("bigint").alias("s"), F.col("n.k.v").alias("v")).alias("__a"), F.lit(None).alias("__m")
    )
    targets = missing.select("__g", F.col("xi").cast("bigint").alias("__x"), F.lit(None).alias("__a"), F.struct(*df.columns).alias("__m"))
    typed = candidates.withColumn("__m", F.col("__m").cast(targets.schema["__m"].dataType)).unionByName(targets.withColumn("__a", F.col("__a").cast(candidates.schema["__a"].dataType)))
    whole = typed.groupBy("__g", "__x").agg(F.collect_list("__a").alias("__a"), F.collect_list("__m").alias("__m")).where(F.size("__m") > 0)
    pick = lowest(F.transform("__a", lambda a: a["e"]), F.transform("__a", lambda a: a["s"]), F.transform("__m", lambda m: m["eta"].cast("bigint")))
    filled = whole.withColumn("__i", pick).select("__a", F.explode(F.arrays_zip("__m", "__i")).alias("__z"))
    filled = filled.select(*[F.get("__a", F.col("__z.__i"))["v"].alias(c) if c == value else F.col(f"__z.__m.{c}").alias(c) for c in df.columns])
    return df.where(~placed | F.col(value).isNotNull()).unionByName(filled)


def fill_or_mean(df: DataFrame, by: list[str], value: str, few: int = 10) -> DataFrame:
    """``fill_nearest``, but a group with fewer than ``few`` valid cells is their mean everywhere; one without any stays missing."""
    group = F.struct(*by) if by else F.lit(0)
    facts = df.groupBy(group.alias("__g")).agg(F.count(value).alias("__n"), F.avg(value).alias("__mean"))
    filled = fill_nearest(df, by, value).withColumn("__g", group).join(facts, "__g")
    return filled.withColumn(value, F.when(F.col("__n").between(1, few - 1), F.col("__mean").cast(df.schema[value].dataType)).otherwise(F.col(value))).select(*df.columns)


def coarsen(points: DataFrame, cells: DataFrame, width: float, value: str) -> DataFrame:
    """Weighted means of points within ``width`` of each cell, with weight (1 - (r/w)^2)^2; tiles of the width meet."""
    t = lambda c: F.floor(F.col(c) / width)
    around = F.array(F.lit(-1), F.lit(0), F.lit(1))
    c = cells.withColumn("__x", F.explode(F.transform(around, lambda k: t("lon") + k))).withColumn("__y", F.explode(F.transform(around, lambda k: t("lat") + k)))
    p = points.select(t("lon").alias("__x"), t("lat").alias("__y"), F.col("lon").alias("__lon"), F.col("lat").alias("__lat"), value)
    r2 = ((F.col("lon") - F.col("__lon")) ** 2 + (F.col("lat") - F.col("__lat")) ** 2) / width**2
    w = (1 - r2) ** 2
    return c.join(p, ["__x", "__y"]).where(r2 < 1).groupBy("cell", "lon", "lat").agg((F.sum(w * F.col(value)) / F.sum(w)).alias(value), F.count(value).alias("points"))


def steepness(grid: DataFrame, value: str = "h") -> DataFrame:
    """Largest |difference over sum| of depth between neighbours along each axis: (axis, r_factor)."""
    def along(axis: str, other: str) -> DataFrame:
        nxt = grid.select(other, (F.col(axis) - 1).alias(axis), F.col(value).alias("__n"))
        r = F.abs(F.try_divide(F.col("__n") - F.col(value), F.col("__n") + F.col(value)))
        return grid.join(nxt, [axis, other]).agg(F.lit(axis).alias("axis"), F.max(r).alias("r_factor"))

    return along("xi", "eta").unionByName(along("eta", "xi"))


def power_spectrum(series: DataFrame, keys: list[str], values: str, spacing: float = 1.0, detrend: str | None = None, window: str | None = None, true_amplitude: bool = True) -> DataFrame:
    """(keys, k, frequency, power) of arrays over an even axis: the squared size of the transform, at the n frequencies in rising order.

    By default the series counts as periodic and the transform is multiplied by the spacing
    (``true_amplitude``). ``detrend`` is ``constant`` or ``linear``, ``window`` is ``hann``. Arrays
    with a null, and of fewer than two values, give no rows. Arrays of one batch and length go
    through one FFT.
    """
    return _spectrum(series, keys, values, (spacing,), detrend, window, true_amplitude)


def power_spectrum_2d(fields: DataFrame, keys: list[str], values: str, spacings: tuple[float, float] = (1.0, 1.0), detrend: str | None = None, window: str | None = None, true_amplitude: bool = True) -> DataFrame:
    """(keys, j, i, frequency_y, frequency_x, power) of arrays of equally long rows: the transform over both axes, else as ``power_spectrum``."""
    return _spectrum(fields, keys, values, spacings, detrend, window, true_amplitude)


def _without_trend(x: np.ndarray, detrend: str | None) -> np.ndarray:
    """Arrays less their mean or their plane of least squares over all axes but the first."""
    if detrend is None:
        return x
    if detrend not in ("constant", "linear"):
        raise ValueError(f"unknown detrend {detrend!r}: constant or linear")
    axes = tuple(range(1, x.ndim))
    x = x - x.mean(axis=axes, keepdims=True)
    for axis in axes if detrend == "linear" else ():
        t = np.arange(x.shape[axis]) - (x.shape[axis] - 1) / 2
        t = t.reshape([-1 if k == axis else 1 for k in range(x.ndim)])
        rest = x.size / x.shape[0] / x.shape[axis]
        x = x - (x * t).sum(axis=axes, keepdims=True) / ((t * t).sum() * rest) * t
    return x


def _spectrum(series: DataFrame, keys: list[str], values: str, spacings: tuple[float, ...], detrend: str | None, window: str | None, true_amplitude: bool) -> DataFrame:
    kinds = ", ".join(f"`{k}` {series.schema[k].dataType.simpleString()}" for k in keys)
    names = [("k", "frequency")] if len(spacings) == 1 else [("j", "frequency_y"), ("i", "frequency_x")]
    if window not in (None, "hann"):
        raise ValueError(f"unknown window {window!r}: hann")
    _without_trend(np.zeros((1, 2)), detrend)

    def shape(v) -> tuple[int, ...]:
        if v is None or len(v) < 2:
            return ()
        if len(spacings) == 1:
            return () if any(x is None or x != x for x in v) else (len(v),)
        n = {-1 if row is None or any(x is None or x != x for x in row) else len(row) for row in v}
        return (len(v), n.pop()) if len(n) == 1 and min(n) > 1 else ()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in batches:
            for size, part in p.groupby(p[values].map(shape)):
                if not size:
                    continue
                x = _without_trend(np.array([[list(r) for r in v] if len(size) > 1 else v for v in part[values]], float), detrend)
                axes = tuple(range(1, x.ndim))
                for axis in axes if window else ():
                    hann = np.hanning(x.shape[axis] + 1)[:-1]
                    x = x * hann.reshape([-1 if k == axis else 1 for k in range(x.ndim)])
                power = np.abs(np.fft.fftshift(np.fft.fftn(x, axes=axes), axes=axes)) ** 2
                if true_amplitude:
                    power = power * float(np.prod(spacings)) ** 2
                f = np.meshgrid(*[np.fft.fftshift(np.fft.fftfreq(n, d)) for n, d in zip(size, spacings)], indexing="ij")
                at = np.indices(size).reshape(len(size), -1)
                out = {k: np.repeat(part[k].to_numpy(), power[0].size) for k in keys}
                for axis, (number, frequency) in enumerate(names):
                    out |= {number: np.tile(at[axis], len(part)), frequency: np.tile(f[axis].ravel(), len(part))}
                yield pd.DataFrame(out | {"power": power.ravel()})

    rest = ", ".join([*(f"{n} bigint" for n, _ in names), *(f"{f} double" for _, f in names), "power double"])
    order = [*keys, *(n for n, _ in names), *(f for _, f in names), "power"]
    return series.select(*keys, values).mapInPandas(lambda it: (d[order] for d in run(it)), f"{kinds}, {rest}")


def scatter_to_grid(points: DataFrame, grid: DataFrame, value: str, low: float, high: float) -> DataFrame:
    """(eta, xi, value): each cell takes the value of the scattered point (lon, lat, value) nearest to it, clamped; of equals the first by position."""
    from brinework.operators import geo
    from brinework.operators.filters import clamped

    # the points are the grid here and the cells the sites; a point is named by its rank in (lat, lon)
    spots = points.where(F.col(value).isNotNull()).groupBy("lon", "lat").agg(F.min(value).alias(value))
    named = spots.select(F.col("lat").alias("eta"), F.col("lon").alias("xi"), "lon", "lat", F.lit(1).alias("mask"), value)
    cells = grid.select(F.struct("eta", "xi").alias("cell"), "lon", "lat")
    near = geo.nearest_cell(cells, named, "cell")
    out = near.join(named.select("eta", "xi", value), ["eta", "xi"])
    return out.select("cell.eta", "cell.xi", value).withColumn(value, clamped(value, low, high))
