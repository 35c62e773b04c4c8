"""Structured Streaming forms of the operational loop.

Streams need a column of type timestamp for their watermark; ``as_events`` casts once.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.streaming.stateful_processor import ExpiredTimerInfo, TimerValues
from pyspark.sql.types import StructType


def read_stream(spark: SparkSession, path: str, schema: StructType, files_per_trigger: int | None = 1) -> DataFrame:
    """Files as a stream; with None all that are there make one batch, so that none is late beside another."""
    reader = spark.readStream.schema(schema)
    return (reader if files_per_trigger is None else reader.option("maxFilesPerTrigger", files_per_trigger)).parquet(path)


def as_events(df: DataFrame, time: str, late: str) -> DataFrame:
    return df.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, late)


def daily_means(events: DataFrame, keys: list[str], time: str, value: str, expected: int | None = None, min_fraction: float = 0.0) -> DataFrame:
    """Tumbling daily means; with ``expected`` records a day, only days that are whole enough."""
    days = events.groupBy(*keys, F.window(time, "1 day").alias("w")).agg(F.avg(value).alias(value), F.count(F.lit(1)).alias("n"))
    out = days.select(*keys, F.date_format("w.start", "yyyy-MM-dd").alias("day"), value, "n")
    return out if expected is None else out.where(F.col("n") >= min_fraction * expected)


def sliding_means(events: DataFrame, keys: list[str], time: str, value: str, length: str = "3 days", step: str = "1 day") -> DataFrame:
    got = events.groupBy(*keys, F.window(time, length, step).alias("w")).agg(F.avg(value).alias(value), F.count(F.lit(1)).alias("n"))
    return got.select(*keys, F.date_format("w.start", "yyyy-MM-dd").alias("start"), value, "n")


def sessions(events: DataFrame, keys: list[str], time: str, gap: str) -> DataFrame:
    got = events.groupBy(*keys, F.session_window(time, gap).alias("w")).agg(F.count(F.lit(1)).alias("n"))
    return got.select(*keys, F.unix_micros("w.start").alias("start_us"), F.unix_micros("w.end").alias("end_us"), "n")


def first_records(events: DataFrame, keys: list[str]) -> DataFrame:
    """The first of repeated records within the watermark."""
    return events.dropDuplicatesWithinWatermark(keys)


def against_climatology(daily: DataFrame, clim: DataFrame, keys: list[str], day: str, value: str) -> DataFrame:
    """Stream-static join on the day of the year: anomalies."""
    return daily.withColumn("doy", F.dayofyear(F.col(day).cast("date"))).join(clim, [*keys, "doy"]).withColumn("anomaly", F.col(value) - F.col("clim"))


class _OpenDays(StatefulProcessor):
    """The days of a key that exceed, until the watermark has passed the gap behind their run."""

    def __init__(self, key: str, origin_ms: int, step_ms: int, min_duration: int, max_gap: int):
        self.key, self.origin_ms, self.step_ms, self.min_duration, self.max_gap = key, origin_ms, step_ms, min_duration, max_gap

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.days = handle.getMapState("days", "position bigint", "peak double")

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: TimerValues) -> Iterator[pd.DataFrame]:
        held = {p: v for (p,), (v,) in self.days.iterator()}
        for part in rows:
            hits = part[part["excess"] > 0].dropna(subset=["position"])
            for position, peak in hits.groupby("position")["excess"].max().items():
                if peak > held.get(int(position), 0.0):
                    held[int(position)] = float(peak)
                    self.days.updateValue((int(position),), (float(peak),))
        return self._closed(key, held, timerValues.getCurrentWatermarkInMs())

    def handleExpiredTimer(self, key: tuple, timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo) -> Iterator[pd.DataFrame]:
        return self._closed(key, {p: v for (p,), (v,) in self.days.iterator()}, timerValues.getCurrentWatermarkInMs())

    def _closed(self, key: tuple, held: dict[int, float], watermark: int) -> Iterator[pd.DataFrame]:
        """Emits and forgets the runs that no later row can reach, and sets a timer for the others."""
        runs: list[list[int]] = []
        for position in sorted(held):
            if runs and position - runs[-1][-1] - 1 <= self.max_gap:
                runs[-1].append(position)
            else:
                runs.append([position])
        out = []
        for run in runs:
            # a row of the first position behind the gap comes before this time
            end = self.origin_ms + (run[-1] + self.max_gap + 2) * self.step_ms
            if end < watermark:
                length = run[-1] - run[0] + 1
                if length >= self.min_duration:
                    out.append((*key, run[0], run[-1], length, max(held[p] for p in run)))
                for position in run:
                    self.days.removeKey((position,))
            else:
                self.handle.registerTimer(end)
        yield pd.DataFrame(out, columns=[self.key, "first", "last", "length", "peak"])

    def close(self) -> None:
        pass


def event_runs(daily: DataFrame, key: str, min_duration: int = 5, max_gap: int = 2, origin: str = "1970-01-01", step: dt.timedelta = dt.timedelta(days=1)) -> DataFrame:
    """(key, first, last, length, peak) of each closed event in a stream of (key, position, excess, time) with a watermark.

    Position p stands for the times from ``origin`` + p steps (UTC) on. Gaps are counted in positions,
    so missing days count, days that do not exceed are gaps, and several readings of a day are one:
    it exceeds if any does. The state of a key are its exceeding days; a run is emitted, and its days
    forgotten, when the watermark has passed the first position behind its gap. So rows in any order
    within the allowed lateness, over any number of batches, give the runs of the whole series. A row
    without a position or an excess is none. The session's state store becomes RocksDB, which
    map states need.
    """
    daily.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    origin_ms = int(dt.datetime.fromisoformat(origin).replace(tzinfo=dt.timezone.utc).timestamp() * 1000)
    return daily.groupBy(key).transformWithStateInPandas(
        _OpenDays(key, origin_ms, int(step.total_seconds() * 1000), min_duration, max_gap),
        f"{key} {daily.schema[key].dataType.simpleString()}, first bigint, last bigint, length bigint, peak double",
        "append",
        "EventTime",
    )


def newest(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The last row of each key by the ordering columns, nulls first; null keys are one key."""
    (rank,) = [n for n in ("__rank", "__rank_") if n not in rows.columns][:1]
    w = Window.partitionBy(*keys).orderBy(*[F.col(c).desc_nulls_last() for c in order])
    return rows.withColumn(rank, F.row_number().over(w)).where(F.col(rank) == 1).drop(rank)


def merge_batch(batch: DataFrame, path: str, partition: str, keys: list[str], order: list[str]) -> None:
    """Writes the newest row of each key, of the batch and of what is stored, into the partitions that the batch holds.

    The partition must follow from the key. Nulls are values like others, in keys and partitions. A
    batch that comes twice, or a repeated or older row, changes nothing.
    """
    batch = batch.persist()
    try:
        held = batch.sparkSession.read.schema(batch.schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        rows = batch
    else:
        touched = batch.select(F.col(partition).alias("__p")).distinct()
        rows = batch.unionByName(held.join(touched, F.col(partition).eqNullSafe(F.col("__p")), "left_semi"))
    # a partition's rows meet before they are written, so that it has few files
    newest(rows, keys, order).hint("rebalance", F.col(partition)).write.partitionBy(partition).mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(path)
    batch.unpersist()


def upsert(df: DataFrame, path: str, checkpoint: str, partition: str, keys: list[str], order: list[str]):
    """Merges each batch by key into the partitions that it holds: the newest row of each key stays, whichever batch brings it."""
    write = lambda batch, _: merge_batch(batch, path, partition, keys, order)
    return df.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).outputMode("append").start()


def run_to_table(df: DataFrame, path: str, checkpoint: str) -> None:
    """Runs a stream over what is there now and writes it to a folder."""
    df.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).outputMode("append").start().awaitTermination()
