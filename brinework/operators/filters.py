"""Selections and masks: variables, levels, boxes, run windows, stamps, calendar shifts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brinework.operators.geo import in_polygon

# Variables that are the two components of one vector.
VECTORS = (("u", "v"), ("ubar", "vbar"), ("sustr", "svstr"), ("bustr", "bvstr"))


def partition_variables(names: list[str], pair_single: bool = False) -> tuple[list[str], list[tuple[str, str]]]:
    """(scalars, vector pairs) of a list; half a pair is an error, or brings its partner with ``pair_single``."""
    scalars, pairs = [], []
    for name in names:
        pair = next((p for p in VECTORS if name in p), None)
        if pair is None:
            scalars.append(name)
        elif pair not in pairs:
            if not pair_single and not set(pair) <= set(names):
                raise ValueError(f"{name} needs both of {pair}")
            pairs.append(pair)
    return scalars, pairs


def level_slice(values, level) -> Column:
    """Levels of a profile: one index or an inclusive (first, last) range, from the bottom."""
    v = F.col(values) if isinstance(values, str) else values
    if isinstance(level, tuple):
        return F.slice(v, level[0] + 1, level[1] - level[0] + 1)
    return F.get(v, F.lit(level))


def land_masked(df: DataFrame, grid: DataFrame, columns: list[str]) -> DataFrame:
    """Values on land become missing; the grid joins by cell."""
    joined = df.join(grid.select("eta", "xi", F.col("mask").alias("__mask")), ["eta", "xi"])
    return joined.withColumns({c: F.when(F.col("__mask") == 1, F.col(c)) for c in columns}).drop("__mask")


def in_box(lon: str, lat: str, box: tuple[float, float, float, float], buffer: float = 0.0) -> Column:
    west, east, south, north = box
    return F.col(lon).between(west - buffer, east + buffer) & F.col(lat).between(south - buffer, north + buffer)


def in_index_box(box: tuple[int, int, int, int]) -> Column:
    """Half-open (eta_from, eta_to, xi_from, xi_to)."""
    e0, e1, x0, x1 = box
    return (F.col("eta") >= e0) & (F.col("eta") < e1) & (F.col("xi") >= x0) & (F.col("xi") < x1)


def inside_cut(df: DataFrame, ring: list[tuple[float, float]], columns: list[str], lon: str = "lon", lat: str = "lat") -> DataFrame:
    """Values inside a polygon (the child's area) become missing."""
    inside = in_polygon(lon, lat, ring)
    return df.withColumns({c: F.when(~inside, F.col(c)) for c in columns})


def run_window(df: DataFrame, run: str, run_date: str, days: int, max_age_hours: int = 12) -> DataFrame:
    """Records of runs from ``days + 1`` before the date on; no run within ``max_age_hours`` of the date is an error."""
    at = F.lit(run_date).cast("timestamp")
    newest = df.agg((F.max(F.col(run).cast("timestamp")) >= at - F.expr(f"interval {max_age_hours} hours")).alias("fresh")).first()
    if not newest.fresh:
        raise ValueError(f"the newest run is more than {max_age_hours} hours before {run_date}")
    return df.where(F.col(run).cast("timestamp") >= at - F.expr(f"interval {days + 1} days"))


def hindcast_forecast(df: DataFrame, day: str, today: str) -> DataFrame:
    """Flags of the two parts; today is in both."""
    return df.withColumns({"is_hindcast": F.col(day) <= F.lit(today).cast("date"), "is_forecast": F.col(day) >= F.lit(today).cast("date")})


def clamped(column: str, low: float, high: float) -> Column:
    """A missing value stays missing."""
    return F.when(F.col(column).isNotNull(), F.greatest(F.lit(low), F.least(F.lit(high), F.col(column))))


def wet_from_depth(h: str = "h") -> Column:
    return (F.col(h) > 0).cast("int")


def stamp_of(file: Column) -> Column:
    """The time of a file whose name ends in yyyyMMddHH and a suffix."""
    return F.try_to_timestamp(F.regexp_extract(file, r"(\d{10})\.\w+$", 1), F.lit("yyyyMMddHH"))


def parse_list(text: Column) -> Column:
    return F.filter(F.transform(F.split(text, ","), lambda x: F.trim(x)), lambda x: x != "")


def years_back(time: str, years: int) -> Column:
    """Shifted by exactly 365 days a year."""
    return F.col(time) - F.expr(f"interval {365 * years} days")


def resolution(grid: DataFrame) -> DataFrame:
    """(mean_dx, mean_dy, smallest) cell size in metres."""
    return grid.agg(F.avg(1 / F.col("pm")).alias("mean_dx"), F.avg(1 / F.col("pn")).alias("mean_dy"), F.min(F.least(1 / F.col("pm"), 1 / F.col("pn"))).alias("smallest"))
