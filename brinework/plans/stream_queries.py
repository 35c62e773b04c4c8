"""Registered queries that run Structured Streaming over the events table, to its end, and read the result.

The oracle is the batch form over what the watermark has closed: a day or session that ends
after the last record less the allowed lateness is still open and is not in the result.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from brinework.plans.series_queries import query, r6
from brinework.session import shared_folder
from brinework.sources.adaptors import table
from brinework.streaming import jobs

LATE = "1 day"


def _folder(spark: SparkSession) -> str:
    """A new folder beside the session's checkpoints, which driver and executors share."""
    return f"{shared_folder(spark)}/stream-{uuid.uuid4().hex}"


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = table(spark, sf_dir, "events").schema
    stream = jobs.read_stream(spark, f"{sf_dir}/events.parque[t]", schema, None)
    return jobs.as_events(stream.select("event_id", "user_id", "ts", "value"), "ts", LATE)


def _finished(spark: SparkSession, stream: DataFrame) -> DataFrame:
    folder = _folder(spark)
    jobs.run_to_table(stream, f"{folder}/out", f"{folder}/state")
    return spark.read.schema(stream.schema).parquet(f"{folder}/out")


CLOSED = "mark AS (SELECT max(ts) - INTERVAL 1 DAY AS mark FROM events)"


@query(
    f"""WITH {CLOSED}, d AS (SELECT user_id, date_trunc('day', ts) AS day, avg(value) AS value, count(*) AS n FROM events GROUP BY ALL)
SELECT user_id, strftime(day, '%Y-%m-%d') AS day, round(value, 6) AS value, n FROM d, mark WHERE day + INTERVAL 1 DAY <= mark"""
)
def stream_daily_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _finished(spark, jobs.daily_means(_events(spark, sf_dir), ["user_id"], "ts", "value")).select("user_id", "day", r6("value"), "n")


@query(
    f"""WITH {CLOSED}, d AS (SELECT user_id, date_trunc('day', ts) AS day, avg(value) AS value, count(*) AS n FROM events GROUP BY ALL)
SELECT user_id, strftime(day, '%Y-%m-%d') AS day, round(value, 6) AS value, n FROM d, mark WHERE day + INTERVAL 1 DAY <= mark AND n >= 3"""
)
def stream_whole_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _finished(spark, jobs.daily_means(_events(spark, sf_dir), ["user_id"], "ts", "value", 6, 0.5)).select("user_id", "day", r6("value"), "n")


@query(
    f"""WITH {CLOSED}, w AS (SELECT user_id, value, unnest([date_trunc('day', ts), date_trunc('day', ts) - INTERVAL 1 DAY, date_trunc('day', ts) - INTERVAL 2 DAY]) AS start FROM events)
SELECT user_id, strftime(start, '%Y-%m-%d') AS start, round(avg(value), 6) AS value, count(*) AS n FROM w, mark WHERE start + INTERVAL 3 DAY <= mark GROUP BY user_id, w.start"""
)
def stream_sliding_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _finished(spark, jobs.sliding_means(_events(spark, sf_dir), ["user_id"], "ts", "value")).select("user_id", "start", r6("value"), "n")


@query(
    f"""WITH {CLOSED}, s AS (SELECT user_id, ts, CASE WHEN ts < lag(ts) OVER w + INTERVAL 6 HOUR THEN 0 ELSE 1 END AS new FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
g AS (SELECT user_id, ts, sum(new) OVER (PARTITION BY user_id ORDER BY ts) AS g FROM s),
e AS (SELECT user_id, min(ts) AS a, max(ts) + INTERVAL 6 HOUR AS b, count(*) AS n FROM g GROUP BY user_id, g)
SELECT user_id, epoch_us(a) AS start_us, epoch_us(b) AS end_us, n FROM e, mark WHERE b <= mark"""
)
def stream_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _finished(spark, jobs.sessions(_events(spark, sf_dir), ["user_id"], "ts", "6 hours"))


@query("SELECT count(DISTINCT user_id) AS users, count(DISTINCT user_id) AS kept FROM events")
def stream_first_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repeats within the watermark are dropped; every user keeps one record."""
    first = _finished(spark, jobs.first_records(_events(spark, sf_dir), ["user_id"]).select("user_id", "event_id"))
    return first.agg(F.count_distinct("user_id").alias("users"), F.count(F.lit(1)).alias("kept"))


@query(
    f"""WITH {CLOSED}, d AS (SELECT user_id, date_trunc('day', ts) AS day, avg(value) AS value FROM events GROUP BY ALL),
c AS (SELECT user_id, avg(value) AS clim FROM events GROUP BY ALL)
SELECT user_id, strftime(day, '%Y-%m-%d') AS day, round(value - (clim + dayofyear(day) / 100), 8) AS anomaly FROM d JOIN c USING (user_id), mark WHERE day + INTERVAL 1 DAY <= mark"""
)
def stream_anomalies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily means joined to a static baseline for each day of the year."""
    days = jobs.daily_means(_events(spark, sf_dir), ["user_id"], "ts", "value")
    clim = table(spark, sf_dir, "events").groupBy("user_id").agg(F.avg("value").alias("clim")).withColumn("doy", F.explode(F.sequence(F.lit(1), F.lit(366))))
    clim = clim.withColumn("clim", F.col("clim") + F.col("doy") / 100)
    return _finished(spark, jobs.against_climatology(days, clim, ["user_id"], "day", "value").select("user_id", "day", "anomaly")).select("user_id", "day", F.round("anomaly", 8).alias("anomaly"))


def _dealt(spark: SparkSession, rows: DataFrame, batch: Column, batches: int = 3) -> tuple[str, DataFrame]:
    """Rows dealt over files by the batch number of each, and the stream that reads them one file after the other."""
    folder = _folder(spark)
    kept = rows.withColumn("batch", batch)
    for k in range(batches):
        kept.where(F.col("batch") == k).drop("batch").coalesce(1).write.mode("append").parquet(f"{folder}/in")
    return folder, jobs.read_stream(spark, f"{folder}/in", rows.schema, 1)


#: Folders of the table that takes the upserts.
UPSERT_PARTS = 32
DEAL = "CAST('0x' || substr(md5(CAST({0} AS VARCHAR)), 1, 6) AS BIGINT)"
VERSIONS = f"""v AS (SELECT event_id, CASE WHEN event_id % 7 > 0 THEN user_id END AS user_id, value + k AS value, k AS version FROM events, (SELECT unnest(range(3)) AS k) WHERE k < 1 + {DEAL.format('event_id')} % 3)"""


@query(
    f"""WITH {VERSIONS}, n AS (SELECT * FROM v QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY version DESC) = 1)
SELECT user_id, count(*) AS n, count(DISTINCT event_id) AS events, round(max(value), 6) AS top, CAST(sum(version) AS BIGINT) AS versions FROM n GROUP BY ALL"""
)
def stream_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Versions of events, some repeated and some without a user, come shuffled in three batches; each is merged into the partitions of its events.

    A partition holds the events of one of ``UPSERT_PARTS`` numbers, so that folders are as many for any number of users.
    """
    e = table(spark, sf_dir, "events")
    number = lambda c: F.conv(F.substring(F.md5(c.cast("string").cast("binary")), 1, 6), 16, 10).cast("bigint")
    some = e.withColumn("version", F.explode(F.sequence(F.lit(0), (number(F.col("event_id")) % 3).cast("int"))))
    rows = some.select("event_id", F.when(F.col("event_id") % 7 > 0, F.col("user_id")).alias("user_id"), (F.col("value") + F.col("version")).alias("value"), "version")
    rows = rows.withColumn("twice", F.explode(F.array(F.lit(0), F.lit(1)))).where("twice = 0 or event_id % 5 = 0")
    rows = rows.drop("twice").withColumn("part", F.pmod(F.xxhash64("event_id"), F.lit(UPSERT_PARTS)).cast("int"))
    folder, stream = _dealt(spark, rows, F.pmod(F.xxhash64("event_id", "version"), F.lit(3)))
    jobs.upsert(stream, f"{folder}/out", f"{folder}/state", "part", ["event_id"], ["version"]).awaitTermination()
    got = spark.read.parquet(f"{folder}/out")
    return got.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("event_id").alias("events"), F.round(F.max("value"), 6).alias("top"), F.sum("version").alias("versions")
    )


@query(
    """WITH mark AS (SELECT max(ts) - INTERVAL 5 DAY AS mark FROM events), h AS (SELECT user_id, datediff('day', DATE '1970-01-01', CAST(ts AS DATE)) AS position, max(value - 20) AS peak FROM events WHERE value > 20 GROUP BY ALL),
s AS (SELECT *, CASE WHEN position - lag(position) OVER w - 1 <= 2 THEN 0 ELSE 1 END AS new FROM h WINDOW w AS (PARTITION BY user_id ORDER BY position)),
g AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY position) AS g FROM s),
r AS (SELECT user_id, min(position) AS first, max(position) AS last, max(position) - min(position) + 1 AS length, round(max(peak), 6) AS peak FROM g GROUP BY user_id, g)
SELECT r.* FROM r, mark WHERE length >= 2 AND DATE '1970-01-01' + CAST(last + 4 AS INT) < mark"""
)
def stream_event_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stateful detection: runs of positions whose value exceeds a threshold, with short gaps bridged, from three batches in which rows are up to four days out of order."""
    e = table(spark, sf_dir, "events").select("event_id", "user_id", F.col("ts").cast("timestamp").alias("ts"), "value")
    seen = F.unix_micros("ts") + F.pmod(F.xxhash64("event_id"), F.lit(96)) * 3_600_000_000
    ends = e.agg(F.min(seen), F.max(seen)).first()
    low, high = ends[0] or 0, (ends[1] or 0) + 1
    folder, stream = _dealt(spark, e, F.floor((seen - low) * 3 / (high - low)).cast("int"))
    daily = stream.withWatermark("ts", "5 days").select("user_id", F.unix_date(F.to_date("ts")).cast("bigint").alias("position"), (F.col("value") - 20).alias("excess"), "ts")
    return _finished(spark, jobs.event_runs(daily, "user_id", 2, 2)).select("user_id", "first", "last", "length", r6("peak"))
