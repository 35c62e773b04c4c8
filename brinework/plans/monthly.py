"""Detection on a record that is stored by month and grows: a new file rewrites the months that it can change, and no others.

The record and the products are folders with a partition for each year and month. A changed day
moves an event's days no farther than ``min_duration`` - 1 + ``max_gap`` days, so the months within
that of a new day are detected again, with as many days of context on each side; only these months
are read and overwritten. Events that cross a month are stored as fragments, one for each month, and
put together when they are read.
"""

from __future__ import annotations

import datetime as dt

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from brinework.operators import events
from brinework.session import cut
from brinework.sources.io import write_products


def month_number(day: str | Column) -> Column:
    """Months since year 0."""
    return F.year(day) * 12 + F.month(day)


def in_months(months: list[int]) -> Column:
    """A condition on the partition columns, so that other partitions are not read."""
    return (F.col("year") * 12 + F.col("month")).isin(months)


def read_months(spark: SparkSession, path: str, months: list[int] | None = None) -> DataFrame | None:
    """The partitions of some months (all with None), or None if there is no such folder yet."""
    try:
        held = spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    return held if months is None else held.where(in_months(months))


def months_near(rows: DataFrame, day: str, reach: int) -> list[int]:
    """The months that hold a day of the rows, or one within ``reach`` days of it; as many as the record has months at most."""
    near = F.explode(F.array(*[month_number(F.date_add(day, k)) for k in {-reach, 0, reach}]))
    return sorted(r.m for r in rows.where(F.col(day).isNotNull()).select(near.alias("m")).distinct().collect())


def blocks_of(months: list[int]) -> list[tuple[int, dt.date, dt.date]]:
    """(number, first day, last day) of each run of consecutive months."""
    out: list[list] = []
    for m in months:
        start = dt.date((m - 1) // 12, (m - 1) % 12 + 1, 1)
        end = dt.date(m // 12, m % 12 + 1, 1) - dt.timedelta(days=1)
        if out and out[-1][3] == m - 1:
            out[-1][2:] = [end, m]
        else:
            out.append([len(out), start, end, m])
    return [tuple(b[:3]) for b in out]


def merge_days(new: DataFrame, record: str, keys: list[str], day: str) -> list[int]:
    """Puts new days into the record, in place of those that it has of a cell and day; returns the months that they touch."""
    touched = months_near(new, day, 0)
    held = read_months(new.sparkSession, record, touched)
    if held is not None:
        pair = F.struct(*keys, day)  # nulls in a key are equal as parts of a struct
        held = held.drop("year", "month").withColumn("__k", pair).join(new.select(pair.alias("__k")).distinct(), "__k", "left_anti").drop("__k")
        new = held.unionByName(new)
    write_products(new.where(F.col(day).isNotNull()), record, day)
    return touched


def detected(days: DataFrame, clim: DataFrame, months: list[int], keys: list[str], day: str = "day", value: str = "temp", min_duration: int = events.MIN_DURATION, max_gap: int = events.MAX_GAP) -> DataFrame:
    """Events on the days of some months, and on the missing days between them that an event can hold (``real`` is false), as a run over the whole record finds them."""
    spark, pad = days.sparkSession, min_duration - 1 + max_gap
    blocks = F.broadcast(spark.createDataFrame(blocks_of(months), "__block int, __first date, __last date"))  # a row for each run of months
    window = days.join(blocks, F.col(day).between(F.date_sub("__first", pad), F.date_add("__last", pad)))
    # a missing day never exceeds: it counts only in a gap that can be bridged, and the first max_gap + 1 of a longer one part what lies around it
    gap = F.datediff(F.lead(day).over(Window.partitionBy(*keys, "__block").orderBy(day)), F.col(day)) - 1
    steps = window.withColumn("__gap", F.least(F.coalesce(gap, F.lit(0)), F.lit(max_gap + 1))).withColumn("__k", F.explode(F.sequence(F.lit(0), F.greatest(F.lit(0), "__gap"))))
    own = F.col("__k") == 0
    whole = steps.select(*keys, "__block", "__first", "__last", F.date_add(day, F.col("__k")).alias(day), F.when(own, F.col(value)).alias(value), own.alias("real"))
    dated = events.join_climatology(whole, clim, keys, day)
    out = events.detect(dated.withColumnsRenamed({"__block": "block", "__first": "first", "__last": "last"}), [*keys, "block"], day, value, min_duration, max_gap)
    return out.where(F.col(day).between(F.col("first"), F.col("last"))).drop("first", "last", "block", "hot_run", "cold_run")


def fragments(found: DataFrame, keys: list[str], day: str = "day", value: str = "temp") -> DataFrame:
    """(keys, sign, first, last, peak, year, month): the days in one state, cut at the ends of months; ``peak`` is the largest distance from the climatology."""
    inside = found.where("category <> 0").withColumns({"sign": F.signum("category").cast("int"), "year": F.year(day), "month": F.month(day)})
    w = Window.partitionBy(*keys, "sign", "year", "month").orderBy(day)
    island = F.date_sub(F.col(day), F.row_number().over(w))
    return inside.withColumn("__i", island).groupBy(*keys, "sign", "year", "month", "__i").agg(
        F.min(day).alias("first"), F.max(day).alias("last"), F.max(F.abs(F.col(value) - F.col("clim"))).alias("peak")
    ).drop("__i")


def joined_events(parts: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, sign, first, last, length, peak) of whole events: fragments that meet at the end of a month are one."""
    w = Window.partitionBy(*keys, "sign").orderBy("first")
    starts = F.coalesce(F.datediff("first", F.lag("last").over(w)) > 1, F.lit(True))
    numbered = parts.withColumn("__n", F.sum(starts.cast("int")).over(w))
    whole = numbered.groupBy(*keys, "sign", "__n").agg(F.min("first").alias("first"), F.max("last").alias("last"), F.max("peak").alias("peak")).drop("__n")
    return whole.withColumn("length", F.datediff("last", "first") + 1)


def update_months(
    new: DataFrame, clim: DataFrame, record: str, products: str, parts: str, keys: list[str], day: str = "day", value: str = "temp", min_duration: int = events.MIN_DURATION, max_gap: int = events.MAX_GAP
) -> list[int]:
    """Takes new days (keys, day, value) into the record, and brings the products and event fragments up to date; returns the months rewritten.

    Days that are new for a cell, corrections of old ones, and a first file that makes the record are
    all the same; days without a date are left out, and no new days change nothing. Products have a
    row for each day of the record, with the baseline and the categories.
    """
    spark, pad = new.sparkSession, min_duration - 1 + max_gap
    if not merge_days(new, record, keys, day):
        return []
    targets = months_near(new, day, pad)
    around = pad // 28 + 1
    within = sorted({m + k for m in targets for k in range(-around, around + 1)})
    days = read_months(spark, record, within).drop("year", "month")
    found = detected(days, clim, targets, keys, day, value, min_duration, max_gap)
    found = cut(found.where("real or category <> 0"))  # read for the products and for the events
    write_products(found.where("real").drop("real"), products, day)
    # months whose events went have no rows, so their old fragments are overwritten by name
    pieces = fragments(found, keys, day, value).select(*keys, "sign", "first", "last", "peak", "year", "month")
    held = read_months(spark, parts)
    empty = None if held is None else held.where(in_months(targets)).select("year", "month").distinct()
    rewrite_partitions(pieces, empty, parts)
    return targets


def rewrite_partitions(rows: DataFrame, present: DataFrame | None, path: str) -> None:
    """Overwrites the partitions (year, month) that the rows or ``present`` name; one without rows keeps a single row of nulls, which readers drop."""
    if present is not None:
        blank = present.join(rows.select("year", "month").distinct(), ["year", "month"], "left_anti")
        rows = rows.unionByName(blank, allowMissingColumns=True)
    rows.hint("rebalance", F.col("year"), F.col("month")).write.mode("overwrite").partitionBy("year", "month").option("partitionOverwriteMode", "dynamic").parquet(path)


def stored_events(spark: SparkSession, parts: str, keys: list[str]) -> DataFrame:
    """The whole events of the stored fragments."""
    return joined_events(read_months(spark, parts).where("first is not null"), keys)


def files_of(rows: DataFrame) -> list[str]:
    """The paths of the files that a pruned read opens."""
    return [r.f for r in rows.select(F.regexp_replace(F.input_file_name(), "^file:/+", "/").alias("f")).distinct().collect()]
