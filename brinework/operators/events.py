"""Heatwave and cold-spell detection and their yearly statistics, both signs in one pass.

Cells are hashed once; detection, day statistics and event statistics all group by the cell, so
that one exchange serves them. Windows use bounded frames or running sums only.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

MAX_GAP, MIN_DURATION = 2, 5


def climatology(
    daily: DataFrame, keys: list[str], day: str = "day", value: str = "temp", half_window: int = 5, quantiles: tuple[float, float] = (0.9, 0.1)
) -> DataFrame:
    """(keys, doy, clim, thr90, thr10): mean and percentiles of the days within ``half_window`` of each day of the year.

    Day numbers run from 1 to 366 and wrap. Missing values are not counted; a day of the year
    without any near it has no row. A cell's values are gathered once, and its 366 windows are
    slices of them in order of the day, each sorted in the task that holds the cell.
    """
    known = daily.where(F.col(value).isNotNull()).select(*keys, F.struct(F.dayofyear(day).alias("d"), F.col(value).cast("double").alias("v")).alias("__s"))
    cells = known.groupBy(*keys).agg(F.collect_list("__s").alias("__l"))
    cells = cells.select(*keys, F.transform("__l", lambda s: s["d"]).alias("__d"), F.transform("__l", lambda s: s["v"]).alias("__v"))
    kinds = ", ".join(f"`{k}` {daily.schema[k].dataType.simpleString()}" for k in keys)

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, out = [], []
            for row, (d, v) in enumerate(zip(batch.column("__d"), batch.column("__v"))):
                found = _day_windows(d.values.to_numpy(zero_copy_only=False), v.values.to_numpy(zero_copy_only=False), half_window, quantiles)
                at.append(np.full(len(found), row))
                out.append(found)
            numbers = np.concatenate(out) if out else np.zeros((0, 4))
            rows = pa.array(np.concatenate(at) if at else np.zeros(0, int))
            columns = [batch.column(k).take(rows) for k in keys] + [pa.array(numbers[:, 0].astype(np.int32))] + [pa.array(numbers[:, c]) for c in (1, 2, 3)]
            yield pa.RecordBatch.from_arrays(columns, [*keys, "doy", "clim", "thr90", "thr10"])

    return cells.mapInArrow(windows, f"{kinds}, doy int, clim double, thr90 double, thr10 double")


def _day_windows(days: np.ndarray, values: np.ndarray, half_window: int, quantiles: tuple[float, float]) -> np.ndarray:
    """(day, mean, two quantiles) of the values around each day of the year that has any."""
    order = np.argsort(days, kind="stable")
    days, values = days[order], values[order]
    turns = range(-(half_window // 366) - 1, half_window // 366 + 2)
    days, values = np.concatenate([days + 366 * t for t in turns]), np.tile(values, len(turns))
    every = np.arange(1, 367)
    starts, ends = np.searchsorted(days, every - half_window), np.searchsorted(days, every + half_window, side="right")
    out = []
    for doy, a, b in zip(every, starts, ends):
        if a < b:
            x = np.sort(values[a:b])
            at = [(len(x) - 1) * q for q in quantiles]
            low = [int(p) for p in at]
            out.append((doy, x.sum() / len(x), *(x[k] if p == k else (k + 1 - p) * x[k] + (p - k) * x[k + 1] for p, k in zip(at, low))))
    return np.array(out).reshape(-1, 4)


def combined_baselines(clim: DataFrame, thresholds: DataFrame | None, keys: list[str], doy: str = "doy") -> DataFrame:
    """(keys, doy, clim, thr90, thr10) from a climatology and, if given, a table of thresholds, each from its own source.

    The climatology's value may be named ``temp``, ``climatology`` or ``clim``; its other variables
    go, but ``zeta`` stays. The thresholds may be named ``threshold_90`` and ``threshold_10`` or
    ``thr90`` and ``thr10``; days without them, or no table at all, have null ones.
    """
    named = next((c for c in ("temp", "climatology", "clim") if c in clim.columns), None)
    if named is None:
        raise ValueError("the climatology has none of temp, climatology, clim")
    base = clim.select(*keys, doy, F.col(named).alias("clim"), *[c for c in ("zeta",) if c in clim.columns])
    if thresholds is None:
        return base.withColumns({"thr90": F.lit(None).cast("double"), "thr10": F.lit(None).cast("double")})
    short = {n: next(c for c in (f"threshold_{n}", f"thr{n}") if c in thresholds.columns) for n in ("90", "10")}
    return base.join(thresholds.select(*keys, doy, *[F.col(c).alias(f"thr{n}") for n, c in short.items()]), [*keys, doy], "left")


def join_climatology(daily: DataFrame, clim: DataFrame, keys: list[str], day: str = "day") -> DataFrame:
    """Adds the baseline of the day of the year; day 60 falls back to 59 where a cell's baseline has no 60."""
    has_60 = clim.groupBy(*keys).agg(F.max((F.col("doy") == 60).cast("int")).alias("__has60"))
    doy = F.dayofyear(day)
    dated = daily.join(has_60, keys, "left").withColumn(
        "doy", F.when((doy == 60) & (F.coalesce("__has60", F.lit(0)) == 0), 59).otherwise(doy)
    )
    return dated.drop("__has60").join(clim, [*keys, "doy"], "left")


def anomalies(dated: DataFrame, value: str = "temp", clim: str = "clim", out: str = "temp_anom") -> DataFrame:
    return dated.withColumn(out, F.col(value) - F.col(clim))


def bridged(flag: Column, w, max_gap: int = MAX_GAP) -> Column:
    """A flag that also fills gaps of up to ``max_gap`` positions between two set flags."""
    before = [F.lag(flag, k, False).over(w) for k in range(1, max_gap + 1)]
    after = [F.lead(flag, k, False).over(w) for k in range(1, max_gap + 1)]
    out = flag
    for a in range(1, max_gap + 1):
        for b in range(1, max_gap + 2 - a):
            out = out | (before[a - 1] & after[b - 1])
    return out


def detect(
    dated: DataFrame,
    keys: list[str],
    day: str = "day",
    value: str = "temp",
    min_duration: int = MIN_DURATION,
    max_gap: int = MAX_GAP,
    split_on_date_gap: bool = False,
) -> DataFrame:
    """Adds hot and cold (category 1-4, 0 outside), category (signed, hot wins), and event lengths.

    Runs are counted by position; ``split_on_date_gap`` ends them at a missing day too. A missing
    value stands for the climatology, a missing threshold never exceeds, a series that is all
    missing or all zero has no events. hot_run and cold_run hold the event's length on its first
    row, else 0. A zero distance of threshold and climatology gives 4 above the threshold, else 1.
    """
    series = Window.partitionBy(*keys)
    w = series.orderBy(day)
    t = F.coalesce(F.col(value), F.col("clim"))
    out = dated.withColumn("__live", F.max(F.coalesce(F.col(value) != 0, F.lit(False))).over(series)).withColumn("__t", t)
    signs = (("hot", F.col("__t") > F.col("thr90"), "thr90"), ("cold", F.col("__t") < F.col("thr10"), "thr10"))
    for name, exceeds, _ in signs:
        out = out.withColumn(f"__{name}", F.col("__live") & F.coalesce(exceeds, F.lit(False)))
    for name, *_ in signs:
        out = out.withColumn(f"__{name}_in", bridged(F.col(f"__{name}"), w, max_gap))
    gap = F.coalesce(F.datediff(F.col(day), F.lag(day).over(w)) > 1, F.lit(False)) if split_on_date_gap else F.lit(False)
    for name, *_ in signs:
        inside = F.col(f"__{name}_in")
        start = inside & (~F.lag(inside, 1, False).over(w) | gap)
        # outside days get the number of the run before them, so the flag is a key too
        out = out.withColumn(f"__{name}_start", start).withColumn(f"__{name}_run", F.sum(start.cast("int")).over(w))
    for name, _, threshold in signs:
        run = Window.partitionBy(*keys, f"__{name}_run", f"__{name}_in")
        length = F.count(F.lit(1)).over(run)
        event = F.col(f"__{name}_in") & (length >= min_duration)
        over, apart = F.col("__t") - F.col(threshold), F.col(threshold) - F.col("clim")
        level = F.when(apart == 0, F.when((over > 0) if name == "hot" else (over < 0), 4).otherwise(1)).otherwise(
            F.greatest(F.lit(1), F.least(F.lit(4), F.floor(1 + F.try_divide(over, apart))))
        )
        out = out.withColumn(name, F.when(event, F.coalesce(level, F.lit(1))).otherwise(0).cast("byte"))
        out = out.withColumn(f"{name}_run", F.when(event & F.col(f"__{name}_start"), length).otherwise(0).cast("int"))
    out = out.withColumn("category", F.when(F.col("hot") != 0, F.col("hot")).otherwise(-F.col("cold")).cast("byte"))
    return out.select(*[c for c in out.columns if not c.startswith("__")])


def year_stats(events: DataFrame, keys: list[str], day: str = "day", value: str = "temp", years: DataFrame | None = None) -> DataFrame:
    """Eleven statistics for each sign, cell and year; every year of the record appears for every cell.

    ``years`` is one row (first, last) of the record; without it the days of ``events`` give it.

    The runs are those of the merged category, so that a day is in one state. An event belongs to
    the year of its first day. Without events counts are 0 and intensities and durations missing.
    """
    w = Window.partitionBy(*keys).orderBy(day)
    signs = {"mhw": F.col("category") > 0, "mcs": F.col("category") < 0}
    out = events.withColumn("__i", F.abs(F.col(value) - F.col("clim"))).withColumn("__m", F.abs("category"))
    for name, inside in signs.items():
        start = inside & ~F.lag(inside, 1, False).over(w)
        out = out.withColumn(f"__{name}", inside).withColumn(f"__{name}_s", start).withColumn(f"__{name}_r", F.sum(start.cast("int")).over(w))
    for name in signs:
        run = Window.partitionBy(*keys, f"__{name}_r", f"__{name}")
        out = out.withColumn(f"__{name}_n", F.when(F.col(f"__{name}_s"), F.count(F.lit(1)).over(run)))
    out = out.withColumn("year", F.year(day))
    measures = []
    for name in signs:
        inside, length = F.col(f"__{name}"), F.col(f"__{name}_n")
        measures += [
            F.count_if(inside).alias(f"{name}_days"),
            *(
                F.count_if(inside & (F.col("__m") == k)).alias(f"{name}_days_{label}")
                for k, label in enumerate(("moderate", "strong", "severe", "extreme"), 1)
            ),
            F.sum(F.when(inside, F.coalesce("__i", F.lit(0.0)))).alias(f"{name}_intensity_cumulative"),
            F.avg(F.when(inside, F.coalesce("__i", F.lit(0.0)))).alias(f"{name}_intensity_mean"),
            F.max(F.when(inside, F.coalesce("__i", F.lit(0.0)))).alias(f"{name}_intensity_max"),
            F.count(length).alias(f"{name}_count"),
            F.avg(length).alias(f"{name}_duration_mean"),
            F.coalesce(F.max(length), F.lit(0)).alias(f"{name}_duration_max"),
        ]
    if years is None:
        years = events.agg(F.min(F.year(day)).alias("first"), F.max(F.year(day)).alias("last"))
    stats = out.groupBy(*keys, "year").agg(*measures)
    names = [c for c in stats.columns if c not in (*keys, "year")]
    # the years of a cell are few: nested, the missing ones can be added without another exchange
    nested = stats.groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct("year", F.struct(*names)))).alias("__years"))
    filled = nested.crossJoin(F.broadcast(years)).withColumn("year", F.explode(F.sequence("first", "last")))  # one row
    filled = filled.withColumn("__s", F.try_element_at("__years", F.col("year")))
    counts = [c for c in names if c.endswith("_count") or "_days" in c or c.endswith("_duration_max")]
    return filled.select(*keys, "year", *[F.coalesce(f"__s.{c}", F.lit(0)).alias(c) if c in counts else F.col(f"__s.{c}") for c in names])


def restrict_with_context(daily: DataFrame, first: str, last: str, day: str = "day", min_duration: int = MIN_DURATION, max_gap: int = MAX_GAP) -> tuple[DataFrame, Column]:
    """Days of a partition with the context that makes detection there equal to detection on the whole record, and the condition that drops the context again."""
    pad = min_duration - 1 + max_gap
    d = F.to_date(day)
    padded = daily.where((d >= F.date_sub(F.lit(first).cast("date"), pad)) & (d <= F.date_add(F.lit(last).cast("date"), pad)))
    return padded, (d >= F.lit(first)) & (d <= F.lit(last))
