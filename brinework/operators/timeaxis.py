"""Operators along the time axis: binning, joins in time, fills, precedence, differences."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from brinework.session import cut


def decode_time(seconds, origin: str) -> Column:
    """Seconds since an origin (a timestamp text) as a timestamp."""
    s = F.col(seconds) if isinstance(seconds, str) else seconds
    return F.timestamp_seconds(F.unix_timestamp(F.lit(origin).cast("timestamp")) + s)


def daily_mean(readings: DataFrame, keys: list[str], time: str = "time", values: tuple[str, ...] = ("value",)) -> DataFrame:
    """(keys, day, means, n): means per calendar day; missing values are skipped."""
    return readings.groupBy(*keys, F.to_date(time).alias("day")).agg(
        *[F.avg(v).alias(v) for v in values], F.count(F.lit(1)).alias("n")
    )


def drop_part_days(readings: DataFrame, daily: DataFrame, min_fraction: float, time: str = "time", may_be_none: bool = False) -> DataFrame:
    """Days with at least a share of the records expected from the median spacing of the distinct times.

    A share of 0 or fewer than two times keeps every day; if every day would go, that is an error, or with ``may_be_none`` no rows.
    """
    times = cut(readings.select(F.col(time).alias("t")).where("t is not null").distinct())
    if min_fraction <= 0 or times.count() < 2:
        return daily
    # steps inside each day, and from the last time of a day to the first of the next: only the days are one list
    at = F.unix_micros(F.col("t").cast("timestamp"))
    inside = times.select((at - F.lag(at).over(Window.partitionBy(F.to_date("t")).orderBy("t"))).alias("d"))
    ends = times.groupBy(F.to_date("t").alias("day")).agg(F.min(at).alias("first"), F.max(at).alias("last"))
    between = ends.select((F.col("first") - F.lag("last").over(Window.orderBy("day"))).alias("d"))
    steps = inside.unionByName(between).where("d is not null").groupBy("d").agg(F.count(F.lit(1)).alias("n"))
    expected = 86_400e6 / steps.agg(F.percentile("d", F.lit(0.5), F.col("n")).alias("step")).first().step
    counts = times.groupBy(F.to_date("t").alias("day")).agg((F.count(F.lit(1)) / expected).alias("share"))
    kept = counts.where(F.col("share") >= min_fraction).select("day")
    if not may_be_none and kept.isEmpty():
        raise ValueError("every day is a part day")
    return daily.join(kept, "day", "left_semi")


def spine(df: DataFrame, keys: list[str], time: str, step: str) -> DataFrame:
    """Every step from the first to the last time of each key, with the record there or nulls."""
    ends = df.groupBy(*keys).agg(F.min(time).alias("__a"), F.max(time).alias("__b"))
    full = ends.select(*keys, F.explode(F.sequence("__a", "__b", F.expr(f"interval {step}"))).alias(time))
    return full.join(df, [*keys, time], "left")


def carry_forward(df: DataFrame, keys: list[str], time: str, values: list[str]) -> DataFrame:
    """A missing value becomes the latest one before it."""
    w = Window.partitionBy(*keys).orderBy(time).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumns({v: F.last(v, ignorenulls=True).over(w) for v in values})


def interpolate(df: DataFrame, keys: list[str], time: str, value: str, extrapolate: str | None = None) -> DataFrame:
    """Missing values by the line between the known ones around them; ends stay missing, are held ("hold"), or follow the line of the two nearest known values ("linear")."""
    w = Window.partitionBy(*keys).orderBy(time)
    known = F.when(F.col(value).isNotNull(), F.struct(F.unix_micros(F.col(time).cast("timestamp")).alias("t"), F.col(value).alias("v")))
    out = df.withColumn("__k", known)
    out = out.withColumn("__a", F.last("__k", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    back = Window.partitionBy(*keys).orderBy(F.desc(time)).rowsBetween(Window.unboundedPreceding, 0)
    out = out.withColumn("__b", F.last("__k", ignorenulls=True).over(back))
    at = F.unix_micros(F.col(time).cast("timestamp"))
    line = F.col("__a.v") + (F.col("__b.v") - F.col("__a.v")) * F.try_divide(at - F.col("__a.t"), F.col("__b.t") - F.col("__a.t"))
    ends = F.coalesce("__a.v", "__b.v") if extrapolate == "hold" else F.lit(None).cast("double")
    if extrapolate == "linear":
        every = (Window.unboundedPreceding, Window.unboundedFollowing)
        down = Window.partitionBy(*keys).orderBy(F.desc(time)).rowsBetween(*every)
        for name, over in (("__f", w.rowsBetween(*every)), ("__l", down)):
            out = out.withColumns({f"{name}{k}": F.nth_value("__k", k, True).over(over) for k in (1, 2)})
        along = lambda n: F.col(f"{n}1.v") + (F.col(f"{n}2.v") - F.col(f"{n}1.v")) * F.try_divide(at - F.col(f"{n}1.t"), F.col(f"{n}2.t") - F.col(f"{n}1.t"))
        ends = F.when(F.col("__a").isNull(), along("__f")).otherwise(along("__l"))
    filled = F.when(F.col(value).isNotNull(), F.col(value)).when(F.col("__a").isNotNull() & F.col("__b").isNotNull(), line).otherwise(ends)
    return out.withColumn(value, filled).drop("__k", "__a", "__b", "__f1", "__f2", "__l1", "__l2")


def nearest_in_time(left: DataFrame, right: DataFrame, keys: list[str], time: str, values: list[str]) -> DataFrame:
    """As-of join: for each left row the right row of its keys with the smallest time difference, the earlier of two.

    One union and one sort per key; no range join. Left rows without a partner keep nulls.
    """
    packed = F.struct(F.col(time).alias("t"), *values)
    both = left.select("*", F.lit(None).cast(right.select(packed.alias("r")).schema["r"].dataType).alias("__r"), F.lit(1).alias("__left")).unionByName(
        right.select(*keys, time, packed.alias("__r"), F.lit(0).alias("__left")), allowMissingColumns=True
    )
    w = Window.partitionBy(*keys).orderBy(time, "__left").rowsBetween(Window.unboundedPreceding, 0)
    # of rows at one time, the right ones come first on the way up, and the left ones first on the way down
    back = Window.partitionBy(*keys).orderBy(F.desc(time), F.desc("__left")).rowsBetween(Window.unboundedPreceding, 0)
    out = both.withColumn("__a", F.last("__r", ignorenulls=True).over(w)).withColumn("__b", F.last("__r", ignorenulls=True).over(back))
    micros = lambda c: F.unix_micros(F.col(c).cast("timestamp"))
    before, after = micros(time) - micros("__a.t"), micros("__b.t") - micros(time)
    best = F.when(F.col("__b").isNull() | (before <= after), F.col("__a")).otherwise(F.col("__b"))
    out = out.where("__left = 1").withColumn("__m", best)
    return out.select(*left.columns, F.col("__m.t").alias("matched_time"), *[F.col(f"__m.{v}").alias(v) for v in values])


def to_model_axis(obs: DataFrame, first_time: Column, step_seconds: Column, time: str, values: list[str], keys: list[str]) -> DataFrame:
    """Means of observations in (t - dt/2, t + dt/2] of a regular axis, by an arithmetic bin number; (keys, bin, values)."""
    micros = F.unix_micros(F.col(time).cast("timestamp"))
    start, step = F.unix_micros(first_time), step_seconds.cast("bigint") * 1_000_000
    number = (F.ceil((micros - start + step / 2) / step) - 1).cast("bigint")
    return obs.withColumn("bin", number).groupBy(*keys, "bin").agg(*[F.avg(v).alias(v) for v in values])


def deaccumulate(df: DataFrame, keys: list[str], step: str = "step_hours", value: str = "value", cycle: int = 6, mode: str = "exact") -> DataFrame:
    """Running means since the start of a cycle to means per step.

    With hour n in the cycle and the previous hour m, the mean of the hours between is
    (n a - m b)/(n - m); the first record of a cycle is itself. ``as_coded`` keeps the
    divisions of the operational form beyond hour 120.
    """
    n = F.pmod(F.col(step) - 1, F.lit(cycle)) + 1
    w = Window.partitionBy(*keys).orderBy(step)
    out = df.withColumn("__n", n)
    m, b = F.lag("__n").over(w), F.lag(value).over(w)
    first = m.isNull() | (m >= F.col("__n"))
    exact = F.when(first, F.col(value)).otherwise(F.try_divide(F.col("__n") * F.col(value) - m * b, F.col("__n") - m))
    if mode == "as_coded":
        late = F.when(F.col("__n") == 3, F.col(value) / 3).otherwise((6 * F.col(value) - 3 * b) / 3)
        exact = F.when(F.col(step) > 120, late).otherwise(exact)
    return out.withColumn(value, exact).drop("__n")


def latest_run_wins(df: DataFrame, keys: list[str], run: str = "run", time: str = "valid_time", order: str | None = None) -> DataFrame:
    """Merges overlapping forecasts: a run gives only the times before the first time of any newer run; of repeats in a run the first stays.

    The precedence is worked out on the short list of runs and broadcast.
    """
    starts = df.groupBy(run).agg(F.min(time).alias("__start"))
    newer = Window.orderBy(F.desc(run)).rowsBetween(Window.unboundedPreceding, -1)
    limits = starts.select(F.col(run).alias("__run"), F.min("__start").over(newer).alias("__limit"))
    kept = df.join(F.broadcast(limits), df[run] == limits["__run"]).where(F.col("__limit").isNull() | (F.col(time) < F.col("__limit")))
    w = Window.partitionBy(*keys, time, run).orderBy(order or time)
    return kept.withColumn("__k", F.row_number().over(w)).where("__k = 1").drop("__k", "__run", "__limit")


def context_days(target: DataFrame, others: list[DataFrame], keys: list[str], day: str = "day") -> DataFrame:
    """Days of a target and of context tables: the target's win, then those of the first table listed."""
    rows = target.withColumn("__p", F.lit(0))
    for k, other in enumerate(others, 1):
        rows = rows.unionByName(other.withColumn("__p", F.lit(k)))
    w = Window.partitionBy(*keys, day).orderBy("__p")
    return rows.withColumn("__k", F.row_number().over(w)).where("__k = 1").withColumn("is_target", F.col("__p") == 0).drop("__k", "__p")


def every_nth(df: DataFrame, n: int, order: list[str], keys: list[str]) -> DataFrame:
    """Records 0, n, 2n, ... of each key."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__k", F.row_number().over(w) - 1).where(F.col("__k") % n == 0).drop("__k")


def nearest_times(df: DataFrame, at: str, k: int, time: str) -> DataFrame:
    """The k records nearest to a time, the earlier of two first."""
    gap = F.abs(F.unix_micros(F.col(time).cast("timestamp")) - F.unix_micros(F.lit(at).cast("timestamp")))
    return df.orderBy(gap, time).limit(k)


def masked_difference(df: DataFrame, keys: list[str], order: str, value: str, out: str) -> DataFrame:
    """Mean of the differences to both neighbours, or the one that exists; only neighbours one index away count."""
    w = Window.partitionBy(*keys).orderBy(order)
    ahead = F.when(F.lead(order).over(w) == F.col(order) + 1, F.lead(value).over(w)) - F.col(value)
    behind = F.col(value) - F.when(F.lag(order).over(w) == F.col(order) - 1, F.lag(value).over(w))
    return df.withColumn(out, F.coalesce((ahead + behind) / 2, ahead, behind))


def moving_mean(df: DataFrame, keys: list[str], time: str, value: str, out: str, half_seconds: int) -> DataFrame:
    """Mean of the values in the open range of ``half_seconds`` around each record."""
    at = F.unix_micros(F.col(time).cast("timestamp"))
    span = half_seconds * 1_000_000 - 1
    w = Window.partitionBy(*keys).orderBy(at).rangeBetween(-span, span)
    return df.withColumn(out, F.avg(value).over(w))


def gap_count(df: DataFrame, day: str = "day") -> DataFrame:
    """Number of steps between the distinct days that are not one day."""
    days = df.select(F.to_date(day).alias("d")).where("d is not null").distinct()
    step = F.datediff("d", F.lag("d").over(Window.orderBy("d")))  # distinct days: few rows
    return days.select(step.alias("s")).agg(F.count_if(F.col("s") != 1).alias("gaps"), F.count(F.lit(1)).alias("days"))


def time_range(df: DataFrame, time: str, first: str, last: str) -> DataFrame:
    """Records between two times, both included."""
    return df.where(F.col(time).cast("timestamp").between(F.lit(first).cast("timestamp"), F.lit(last).cast("timestamp")))


def in_sequence(parts: list[DataFrame], keys: list[str], time: str, drop_first: bool = False) -> DataFrame:
    """Tables one after another in time; with ``drop_first`` each loses the first record of each key, as station files repeat their start.

    Each record gets its ``position`` in its key's series, so that no global sort is needed.
    """
    first = Window.partitionBy(*keys).orderBy(time)
    if drop_first:
        parts = [p.withColumn("__k", F.row_number().over(first)).where("__k > 1").drop("__k") for p in parts]
    return reduce(DataFrame.unionByName, parts).withColumn("position", F.row_number().over(first) - 1)


def merge_first(tables: list[DataFrame], keys: list[str]) -> DataFrame:
    """All variables of several tables on the union of their keys; of a variable in several, the first table with a value wins."""
    def both(a: DataFrame, b: DataFrame) -> DataFrame:
        twice = [c for c in b.columns if c in a.columns and c not in keys]
        joined = a.join(b.withColumnsRenamed({c: f"__{c}" for c in twice}), keys, "full")
        return joined.withColumns({c: F.coalesce(c, f"__{c}") for c in twice}).drop(*[f"__{c}" for c in twice])

    return reduce(both, tables)


def same_axis(a: DataFrame, b: DataFrame, cols: list[str]) -> bool:
    """Whether two tables hold the same rows of some columns, repeats included."""
    x, y = a.select(*cols), b.select(*cols)
    return x.exceptAll(y).isEmpty() and y.exceptAll(x).isEmpty()


def overlap_months(df: DataFrame, time: str, days: int) -> DataFrame:
    """Each record for its month, and for a neighbouring month if it is within ``days`` of it; column ``month``."""
    t = F.to_date(time)
    months = F.array_distinct(F.array(F.date_trunc("month", F.date_sub(t, days)), F.date_trunc("month", t), F.date_trunc("month", F.date_add(t, days))))
    return df.withColumn("month", F.explode(months)).withColumn("month", F.date_format("month", "yyyy-MM"))


def with_repeated_ends(df: DataFrame, time: str, days: int, ends: str = "repeat") -> DataFrame:
    """``overlap_months``, and for a month without a month of records before it (or after it) its first (last) records once more.

    They stand ``days`` before the month's start, or ``days`` after its end, and are marked in the
    column ``repeated``; with ``ends`` as ``error`` such a month raises instead.
    """
    if ends not in ("repeat", "error"):
        raise ValueError(f"unknown ends {ends!r}: repeat or error")
    t = F.to_date(time)
    # the list of months does not grow with the fields
    months = df.where(F.col(time).isNotNull()).groupBy(F.trunc(t, "month").alias("__m")).agg(F.min(time).alias("__a"), F.max(time).alias("__b"))
    w = Window.orderBy("__m")
    alone = months.select("__m", "__a", "__b", *[F.coalesce(step(F.col("__m")).over(w) != F.add_months("__m", k), F.lit(True)).alias(n) for n, step, k in (("__first", F.lag, -1), ("__last", F.lead, 1))])
    if ends == "error":
        bad = [r.m for r in alone.where("__first or __last").select(F.date_format("__m", "yyyy-MM").alias("m")).orderBy("m").limit(10).collect()]
        if bad:
            raise ValueError(f"months without a month of records beside them: {', '.join(bad)}")
    kind = df.schema[time].dataType
    out = overlap_months(df, time, days).withColumn("repeated", F.lit(False))
    marked = df.withColumn("__m", F.trunc(t, "month")).join(F.broadcast(alone), "__m")
    for flag, end, at in (("__first", "__a", F.date_sub("__m", days)), ("__last", "__b", F.date_add(F.last_day("__m"), days))):
        more = marked.where(F.col(flag) & (F.col(time) == F.col(end)))
        out = out.unionByName(more.select(*[at.cast(kind).alias(c) if c == time else c for c in df.columns], F.date_format("__m", "yyyy-MM").alias("month"), F.lit(True).alias("repeated")))
    return out


def distances_along(df: DataFrame, keys: list[str], order: str, lon: str, lat: str) -> DataFrame:
    """Bearing to the next point of a path; the last point repeats the one before."""
    w = Window.partitionBy(*keys).orderBy(order)
    a, b = F.radians(lat), F.radians(F.lead(lat).over(w))
    d = F.radians(F.lead(lon).over(w)) - F.radians(lon)
    bearing = F.atan2(F.cos(b) * F.sin(d), F.cos(a) * F.sin(b) - F.sin(a) * F.cos(b) * F.cos(d))
    out = df.withColumn("bearing", bearing)
    return out.withColumn("bearing", F.coalesce("bearing", F.lag("bearing").over(w)))


def numbered(rows: DataFrame, order: str, out: str) -> DataFrame:
    """Numbers from 0 without gaps in the order of a unique column, without one task that sees all rows: ranges are numbered each, from the counts of those before."""
    ranged = cut(rows.repartitionByRange(F.col(order)).withColumn("__part", F.spark_partition_id()))
    counts = ranged.groupBy("__part").agg(F.count(F.lit(1)).alias("__n"))  # a row for each range
    before = counts.withColumn("__from", F.sum("__n").over(Window.orderBy("__part")) - F.col("__n")).drop("__n")
    inside = F.row_number().over(Window.partitionBy("__part").orderBy(order)).cast("bigint") - 1
    return ranged.withColumn(out, inside).join(F.broadcast(before), "__part").withColumn(out, F.col(out) + F.col("__from")).drop("__part", "__from")
