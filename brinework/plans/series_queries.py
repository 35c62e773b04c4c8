"""Registered queries on series: heatwaves, validation, time axis. Each stands beside its DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from brinework.operators import events, timeaxis, validate
from brinework.plans.registry import ORACLE_SQL, QUERIES
from brinework.sources.adaptors import CELL_READINGS, SENSORS, cell_readings, sensors, table


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


def r6(c: str | Column, name: str | None = None) -> Column:
    return F.round(F.col(c) if isinstance(c, str) else c, 6).alias(name or c)


def text_day(c: str = "day") -> Column:
    return F.date_format(c, "yyyy-MM-dd").alias(c)


def text_time(c: str, name: str | None = None) -> Column:
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(name or c)


DAILY = f"""{CELL_READINGS},
daily AS (SELECT cell, CAST(time AS DATE) AS day, avg(temp) AS temp, count(*) AS n FROM cell_readings GROUP BY ALL)"""
CLIM = f"""{DAILY},
pooled AS (SELECT cell, temp, ((dayofyear(day) - 1 + k + 366) % 366) + 1 AS doy FROM daily, (SELECT unnest(range(-5, 6)) AS k)),
clim AS (SELECT cell, doy, avg(temp) AS clim, quantile_cont(temp, 0.9) AS thr90, quantile_cont(temp, 0.1) AS thr10 FROM pooled GROUP BY ALL)"""
DATED = f"""{CLIM},
dated AS (SELECT d.*, c.clim, c.thr90, c.thr10 FROM daily d LEFT JOIN clim c ON d.cell = c.cell AND dayofyear(d.day) = c.doy)"""


def _one_sign(name: str, op: str, threshold: str, sign: str) -> str:
    return f""",
{name}_x AS (SELECT *, coalesce(temp {op} {threshold}, false) AS x FROM dated),
{name}_l AS (SELECT *, coalesce(lag(x, 1) OVER w, false) AS b1, coalesce(lag(x, 2) OVER w, false) AS b2,
    coalesce(lead(x, 1) OVER w, false) AS a1, coalesce(lead(x, 2) OVER w, false) AS a2 FROM {name}_x WINDOW w AS (PARTITION BY cell ORDER BY day)),
{name}_b AS (SELECT *, x OR (b1 AND a1) OR (b1 AND a2) OR (b2 AND a1) AS inside FROM {name}_l),
{name}_g AS (SELECT *, row_number() OVER (PARTITION BY cell ORDER BY day) - row_number() OVER (PARTITION BY cell, inside ORDER BY day) AS g FROM {name}_b),
{name} AS (SELECT cell, day, CASE WHEN inside AND count(*) OVER (PARTITION BY cell, inside, g) >= 5 THEN
    coalesce(CASE WHEN thr90 IS NULL THEN 1 WHEN {threshold} = clim THEN CASE WHEN temp {op} {threshold} THEN 4 ELSE 1 END
    ELSE greatest(1, least(4, CAST(floor(1 + ({sign}(temp - {threshold})) / ({sign}({threshold} - clim))) AS INT))) END, 1) ELSE 0 END AS level FROM {name}_g)"""


EVENTS = (
    DATED
    + _one_sign("hot", ">", "thr90", "")
    + _one_sign("cold", "<", "thr10", "-")
    + """,
marked AS (SELECT d.*, CASE WHEN h.level <> 0 THEN h.level ELSE -c.level END AS category
    FROM dated d JOIN hot h ON d.cell = h.cell AND d.day = h.day JOIN cold c ON d.cell = c.cell AND d.day = c.day)"""
)


def _daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return timeaxis.daily_mean(cell_readings(spark, sf_dir), ["cell"], values=("temp",))


def _dated(spark: SparkSession, sf_dir: str) -> DataFrame:
    # the one exchange that all later steps share; with the same columns in both branches it runs once
    daily = _daily(spark, sf_dir).select("cell", "day", "temp").repartition("cell")
    return events.join_climatology(daily, events.climatology(daily, ["cell"]), ["cell"])


def _marked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events.detect(_dated(spark, sf_dir), ["cell"])


@query(f"WITH {DAILY} SELECT cell, strftime(day, '%Y-%m-%d') AS day, round(temp, 6) AS temp, n FROM daily")
def daily_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _daily(spark, sf_dir).select("cell", text_day(), r6("temp"), "n")


@query(f"WITH {CLIM} SELECT cell, CAST(doy AS INT) AS doy, round(clim, 6) AS clim, round(thr90, 6) AS thr90, round(thr10, 6) AS thr10 FROM clim")
def climatology_baseline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events.climatology(_daily(spark, sf_dir), ["cell"]).select("cell", F.col("doy").cast("int").alias("doy"), r6("clim"), r6("thr90"), r6("thr10"))


@query(f"WITH {DATED} SELECT cell, strftime(day, '%Y-%m-%d') AS day, round(temp - clim, 6) AS temp_anom FROM dated")
def daily_anomaly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events.anomalies(_dated(spark, sf_dir)).select("cell", text_day(), r6("temp_anom"))


@query(f"WITH {EVENTS} SELECT cell, strftime(day, '%Y-%m-%d') AS day, CAST(category AS INT) AS category FROM marked")
def heatwave_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _marked(spark, sf_dir).select("cell", text_day(), F.col("category").cast("int").alias("category"))


def _year_sql() -> str:
    runs, cols = "", []
    for n, op in (("mhw", ">"), ("mcs", "<")):
        runs += f""",
{n}_g AS (SELECT *, category {op} 0 AS inside, row_number() OVER (PARTITION BY cell ORDER BY day) - row_number() OVER (PARTITION BY cell, category {op} 0 ORDER BY day) AS g FROM marked),
{n}_e AS (SELECT cell, min(day) AS first, count(*) AS len FROM {n}_g WHERE inside GROUP BY cell, g),
{n}_ey AS (SELECT cell, year(first) AS year, count(*) AS c, avg(len) AS m, max(len) AS x FROM {n}_e GROUP BY ALL),
{n}_dy AS (SELECT cell, year(day) AS year, count_if(category {op} 0) AS days,
    {', '.join(f"count_if(category {op} 0 AND abs(category) = {k}) AS d{k}" for k in range(1, 5))},
    sum(CASE WHEN category {op} 0 THEN abs(temp - clim) END) AS s, avg(CASE WHEN category {op} 0 THEN abs(temp - clim) END) AS a,
    max(CASE WHEN category {op} 0 THEN abs(temp - clim) END) AS t FROM marked GROUP BY ALL)"""
        cols.append(
            f"coalesce({n}_dy.days, 0) AS {n}_days, "
            + ", ".join(f"coalesce({n}_dy.d{k}, 0) AS {n}_days_{w}" for k, w in enumerate(("moderate", "strong", "severe", "extreme"), 1))
            + f", round({n}_dy.s, 6) AS {n}_intensity_cumulative, round({n}_dy.a, 6) AS {n}_intensity_mean, round({n}_dy.t, 6) AS {n}_intensity_max,"
            f" coalesce({n}_ey.c, 0) AS {n}_count, round({n}_ey.m, 6) AS {n}_duration_mean, coalesce({n}_ey.x, 0) AS {n}_duration_max"
        )
    return f"""WITH {EVENTS}{runs},
span AS (SELECT min(year(day)) AS a, max(year(day)) AS b FROM marked),
spine AS (SELECT DISTINCT cell, CAST(unnest(range(a, b + 1)) AS INT) AS year FROM marked, span)
SELECT spine.cell, spine.year, {', '.join(cols)} FROM spine
{' '.join(f'LEFT JOIN {n}_dy ON spine.cell = {n}_dy.cell AND spine.year = {n}_dy.year LEFT JOIN {n}_ey ON spine.cell = {n}_ey.cell AND spine.year = {n}_ey.year' for n in ('mhw', 'mcs'))}"""


@query(_year_sql())
def heatwave_year_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    years = cell_readings(spark, sf_dir).agg(F.min(F.year("time")).alias("first"), F.max(F.year("time")).alias("last"))
    stats = events.year_stats(_marked(spark, sf_dir), ["cell"], years=years)
    return stats.select(
        "cell", F.col("year").cast("int").alias("year"),
        *[r6(c) if t == "double" else F.col(c).cast("bigint").alias(c) for c, t in stats.dtypes if c not in ("cell", "year")],
    )


@query(
    f"""WITH {EVENTS}, top AS (SELECT cell, max(greatest(category, 0)) AS h, max(greatest(-category, 0)) AS c FROM marked GROUP BY ALL)
SELECT cell, CASE WHEN h = 0 AND c = 0 THEN 'None' WHEN h >= c THEN 'MHW' ELSE 'MCS' END AS event, CAST(greatest(h, c) AS INT) AS level FROM top"""
)
def worst_event(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validate.worst_event(_marked(spark, sf_dir), ["cell"])


@query(
    f"""WITH {DATED}, best AS (SELECT year(day) AS year, cell, max(abs(temp - clim)) AS peak FROM dated GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY year ORDER BY round(peak, 9) DESC, cell) AS rank FROM best)
SELECT CAST(year AS INT) AS year, cell, round(peak, 6) AS peak, CAST(rank AS INT) AS rank FROM r WHERE rank <= 3"""
)
def strongest_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three cells with the largest anomaly in each year: a report."""
    best = events.anomalies(_dated(spark, sf_dir)).groupBy(F.year("day").alias("year"), "cell").agg(F.max(F.abs("temp_anom")).alias("peak"))
    return validate.ranked(best, ["year"], [F.round("peak", 9).desc(), "cell"], 3).select("year", "cell", r6("peak"), "rank")


STEP_DAY = "CAST(time AS DATE)"


@query(
    f"""WITH {SENSORS}, t AS (SELECT DISTINCT time FROM sensors), d AS (SELECT epoch_us(time) - lag(epoch_us(time)) OVER (ORDER BY time) AS d FROM t),
e AS (SELECT 86400000000.0 / quantile_cont(d, 0.5) AS expected FROM d),
k AS (SELECT CAST(time AS DATE) AS day FROM t, e GROUP BY 1, expected HAVING count(*) / expected >= 0.7)
SELECT site, strftime(CAST(time AS DATE), '%Y-%m-%d') AS day, round(avg(value), 6) AS value, count(*) AS n FROM sensors
WHERE CAST(time AS DATE) IN (SELECT day FROM k) GROUP BY ALL"""
)
def whole_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    readings = sensors(spark, sf_dir)
    daily = timeaxis.daily_mean(readings, ["site"])
    return timeaxis.drop_part_days(readings, daily, 0.7, may_be_none=True).select("site", text_day(), r6("value"), "n")


@query(
    f"""WITH {SENSORS}, b AS (SELECT *, CAST(ceil((epoch_us(time) - epoch_us(TIMESTAMP '2024-01-01') + 10800000000) / 21600000000.0) - 1 AS BIGINT) AS bin FROM sensors)
SELECT site, bin, round(avg(value), 6) AS value FROM b GROUP BY ALL"""
)
def observations_on_model_axis(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Six-hourly bins centred on the model's times."""
    start = F.lit("2024-01-01").cast("timestamp")
    return timeaxis.to_model_axis(sensors(spark, sf_dir), start, F.lit(21_600), "time", ["value"], ["site"]).select("site", "bin", r6("value"))


@query(
    f"""WITH {SENSORS}, l AS (SELECT * FROM sensors WHERE kind = 'click'), r AS (SELECT site, time, max(value) AS value FROM sensors WHERE kind = 'purchase' GROUP BY ALL),
b AS (SELECT l.id, l.site, l.time, r.time AS bt, r.value AS bv FROM l ASOF LEFT JOIN r ON l.site = r.site AND l.time >= r.time),
a AS (SELECT b.*, r.time AS nt, r.value AS nv FROM b ASOF LEFT JOIN r ON b.site = r.site AND b.time <= r.time)
SELECT id, site, round(CASE WHEN nt IS NULL OR (bt IS NOT NULL AND epoch_us(time) - epoch_us(bt) <= epoch_us(nt) - epoch_us(time)) THEN bv ELSE nv END, 6) AS value FROM a"""
)
def nearest_in_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For each click of a site the purchase nearest in time."""
    s = sensors(spark, sf_dir)
    right = s.where("kind = 'purchase'").groupBy("site", "time").agg(F.max("value").alias("value"))
    left = s.where("kind = 'click'").select("id", "site", "time")
    return timeaxis.nearest_in_time(left, right, ["site"], "time", ["value"]).select("id", "site", r6("value"))


MODEL_OBS = """m AS (SELECT CAST(o_orderdate AS DATE) AS day, avg(o_totalprice) AS model FROM orders GROUP BY ALL),
o AS (SELECT CAST(l_shipdate AS DATE) AS day, avg(l_extendedprice) AS obs FROM lineitem GROUP BY ALL)"""


def _model_obs(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = table(spark, sf_dir, "orders").groupBy(F.to_date("o_orderdate").alias("day")).agg(F.avg("o_totalprice").alias("model"))
    o = table(spark, sf_dir, "lineitem").groupBy(F.to_date("l_shipdate").alias("day")).agg(F.avg("l_extendedprice").alias("obs"))
    return m.join(o, "day", "left")


@query(
    f"""WITH {MODEL_OBS}, p AS (SELECT CAST(quarter(day) AS INT) AS season, model, obs FROM m JOIN o USING (day))
SELECT season, count(*) AS n, round(corr(model, obs), 6) AS corr, round(sqrt(avg((model - obs) * (model - obs)) - avg(model - obs) * avg(model - obs)), 3) AS rmse,
round(avg(model), 6) AS model_mean, round(min(model), 6) AS model_min, round(max(model), 6) AS model_max,
round(avg(obs), 6) AS obs_mean, round(min(obs), 6) AS obs_min, round(max(obs), 6) AS obs_max, round(avg(abs(model - obs)), 6) AS mae FROM p GROUP BY ALL"""
)
def model_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = _model_obs(spark, sf_dir).withColumn("season", F.quarter("day"))
    got = validate.paired_statistics(pairs, ["season"])
    return got.select(*[F.round(c, 3).alias(c) if c == "rmse" else r6(c) if t == "double" else F.col(c) for c, t in got.dtypes])


@query(
    """SELECT o_orderpriority AS site, ['JFM', 'AMJ', 'JAS', 'OND'][quarter(o_orderdate)] AS season, round(avg(o_totalprice), 6) AS value FROM orders GROUP BY ALL"""
)
def seasonal_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = table(spark, sf_dir, "orders").select(F.col("o_orderpriority").alias("site"), "o_orderdate", F.col("o_totalprice").alias("value"))
    return validate.seasonal_means(t, ["site"], "o_orderdate", "value").select("site", "season", r6("value"))


@query(
    """SELECT CAST(year(o_orderdate) AS INT) AS year, CAST(quarter(o_orderdate) AS INT) AS season, o_orderpriority AS site, count(*) AS n, round(avg(o_totalprice), 6) AS mean
FROM orders GROUP BY GROUPING SETS ((year(o_orderdate), quarter(o_orderdate), o_orderpriority), (year(o_orderdate), o_orderpriority), (o_orderpriority), ())"""
)
def statistics_by_level(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Year and season, year, record and whole: one pass."""
    t = table(spark, sf_dir, "orders").select(F.year("o_orderdate").alias("year"), F.quarter("o_orderdate").alias("season"), F.col("o_orderpriority").alias("site"), F.col("o_totalprice").alias("v"))
    y, s, p = F.col("year"), F.col("season"), F.col("site")
    return t.groupingSets([[y, s, p], [y, p], [p], []], y, s, p).agg(F.count(F.lit(1)).alias("n"), F.avg("v").alias("mean")).select("year", "season", "site", "n", r6("mean"))


@query(
    """WITH q AS (SELECT quantile_disc(o_totalprice, 0.01) AS a, quantile_disc(o_totalprice, 0.99) AS b FROM orders)
SELECT round(a / pow(10, floor(log10(abs(a))) - 1)) * pow(10, floor(log10(abs(a))) - 1) AS low, round(b / pow(10, floor(log10(abs(b))) - 1)) * pow(10, floor(log10(abs(b))) - 1) AS high FROM q"""
)
def colour_limits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validate.colour_limits(table(spark, sf_dir, "orders"), "o_totalprice")


@query(
    f"""WITH {SENSORS}, s AS (SELECT site, id, value, row_number() OVER (PARTITION BY site ORDER BY time, id) AS step FROM sensors),
n AS (SELECT *, (step - 1) % 6 + 1 AS n, lag(value) OVER w AS b, lag((step - 1) % 6 + 1) OVER w AS m FROM s WINDOW w AS (PARTITION BY site ORDER BY step))
SELECT site, id, round(CASE WHEN m IS NULL OR m >= n THEN value ELSE (n * value - m * b) / (n - m) END, 6) AS value FROM n"""
)
def deaccumulated(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = timeaxis.every_nth(sensors(spark, sf_dir), 1, ["time", "id"], ["site"])
    from pyspark.sql import Window

    s = s.withColumn("step", F.row_number().over(Window.partitionBy("site").orderBy("time", "id")))
    return timeaxis.deaccumulate(s, ["site"], "step").select("site", "id", r6("value"))


@query(
    f"""WITH {SENSORS}, f AS (SELECT *, CAST(floor(date_diff('day', DATE '2024-01-01', CAST(time AS DATE)) / 3) AS INT) AS block, date_trunc('hour', time) AS valid_time FROM sensors),
r AS (SELECT site, id, valid_time, value, block + k AS run FROM f, (SELECT unnest([0, -1]) AS k)),
s AS (SELECT run, min(valid_time) AS start FROM r GROUP BY ALL),
l AS (SELECT run, min(start) OVER (ORDER BY run DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS lim FROM s),
k AS (SELECT r.*, row_number() OVER (PARTITION BY site, valid_time, run ORDER BY id) AS rn FROM r JOIN l USING (run) WHERE lim IS NULL OR valid_time < lim)
SELECT site, strftime(valid_time, '%Y-%m-%d %H:%M:%S') AS valid_time, CAST(run AS INT) AS run, round(value, 6) AS value FROM k WHERE rn = 1"""
)
def merged_forecasts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of three days that overlap by three; the latest run wins."""
    block = F.floor(F.datediff(F.to_date("time"), F.lit("2024-01-01").cast("date")) / 3).cast("int")
    runs = sensors(spark, sf_dir).select("site", "id", "value", F.date_trunc("hour", "time").alias("valid_time"), F.explode(F.array(block, block - 1)).alias("run"))
    return timeaxis.latest_run_wins(runs, ["site"], order="id").select("site", text_time("valid_time"), "run", r6("value"))


SPINE = f"""{SENSORS}, d AS (SELECT site, CAST(time AS DATE) AS day, avg(value) AS value FROM sensors GROUP BY ALL),
e AS (SELECT site, min(day) AS a, max(day) AS b FROM d GROUP BY ALL),
full_days AS (SELECT site, CAST(unnest(range(a, b + INTERVAL 1 DAY, INTERVAL 1 DAY)) AS DATE) AS day FROM e),
j AS (SELECT f.site, f.day, d.value FROM full_days f LEFT JOIN d ON f.site = d.site AND f.day = d.day)"""


def _spine(spark: SparkSession, sf_dir: str) -> DataFrame:
    daily = timeaxis.daily_mean(sensors(spark, sf_dir), ["site"]).select("site", "day", "value")
    return timeaxis.spine(daily, ["site"], "day", "1 day")


@query(f"WITH {SPINE} SELECT site, strftime(day, '%Y-%m-%d') AS day, round(last_value(value IGNORE NULLS) OVER (PARTITION BY site ORDER BY day), 6) AS value FROM j")
def carried_forward(spark: SparkSession, sf_dir: str) -> DataFrame:
    return timeaxis.carry_forward(_spine(spark, sf_dir), ["site"], "day", ["value"]).select("site", text_day(), r6("value"))


@query(
    f"""WITH {SPINE}, k AS (SELECT *, last_value(CASE WHEN value IS NOT NULL THEN day END IGNORE NULLS) OVER w AS ad, last_value(value IGNORE NULLS) OVER w AS av,
first_value(CASE WHEN value IS NOT NULL THEN day END IGNORE NULLS) OVER x AS bd, first_value(value IGNORE NULLS) OVER x AS bv FROM j
WINDOW w AS (PARTITION BY site ORDER BY day), x AS (PARTITION BY site ORDER BY day ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))
SELECT site, strftime(day, '%Y-%m-%d') AS day, round(CASE WHEN value IS NOT NULL THEN value ELSE av + (bv - av) * (day - ad) / CAST(bd - ad AS DOUBLE) END, 6) AS value FROM k"""
)
def interpolated_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return timeaxis.interpolate(_spine(spark, sf_dir), ["site"], "day", "value").select("site", text_day(), r6("value"))


@query(
    f"""WITH {SENSORS} SELECT id, round(avg(value) OVER (PARTITION BY site ORDER BY epoch_us(time) RANGE BETWEEN 43199999999 PRECEDING AND 43199999999 FOLLOWING), 6) AS value FROM sensors"""
)
def moving_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return timeaxis.moving_mean(sensors(spark, sf_dir), ["site"], "time", "value", "value", 43_200).select("id", r6("value"))


@query(f"WITH {SENSORS}, k AS (SELECT *, row_number() OVER (PARTITION BY site ORDER BY time, id) - 1 AS k FROM sensors) SELECT id, site, round(value, 6) AS value FROM k WHERE k % 3 = 0")
def every_third(spark: SparkSession, sf_dir: str) -> DataFrame:
    return timeaxis.every_nth(sensors(spark, sf_dir), 3, ["time", "id"], ["site"]).select("id", "site", r6("value"))


@query(
    f"""WITH {CELL_READINGS}, d AS (SELECT DISTINCT CAST(time AS DATE) AS d FROM cell_readings), s AS (SELECT d - lag(d) OVER (ORDER BY d) AS s FROM d)
SELECT count_if(s <> 1) AS gaps, count(*) AS days FROM s"""
)
def time_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return timeaxis.gap_count(cell_readings(spark, sf_dir), "time")


@query(
    f"""WITH {SENSORS}, m AS (SELECT id, unnest([CAST(time AS DATE) - 2, CAST(time AS DATE), CAST(time AS DATE) + 2]) AS d FROM sensors)
SELECT DISTINCT id, strftime(d, '%Y-%m') AS month FROM m"""
)
def overlapping_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    return timeaxis.overlap_months(sensors(spark, sf_dir), "time", 2).select("id", "month")


@query(
    f"""WITH {DAILY}, a AS (SELECT cell, day, temp, 0 AS p FROM daily WHERE day >= DATE '1998-01-01' AND day < DATE '1998-02-01'),
b AS (SELECT cell, day, temp - 1 AS temp, 1 AS p FROM daily WHERE day >= DATE '1997-12-20' AND day < DATE '1998-02-10'),
u AS (SELECT *, row_number() OVER (PARTITION BY cell, day ORDER BY p) AS r FROM (SELECT * FROM a UNION ALL SELECT * FROM b))
SELECT cell, strftime(day, '%Y-%m-%d') AS day, round(temp, 6) AS temp, p = 0 AS is_target FROM u WHERE r = 1"""
)
def context_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = _daily(spark, sf_dir).select("cell", "day", "temp")
    target = d.where("day >= '1998-01-01' and day < '1998-02-01'")
    other = d.where("day >= '1997-12-20' and day < '1998-02-10'").withColumn("temp", F.col("temp") - 1)
    return timeaxis.context_days(target, [other], ["cell"]).select("cell", text_day(), r6("temp"), "is_target")


@query(f"WITH {CELL_READINGS} SELECT DISTINCT cell, strftime(CAST(time AS DATE), '%Y-%m-%d') AS day FROM cell_readings WHERE CAST(time AS DATE) NOT IN (SELECT CAST(o_orderdate AS DATE) + 2000 FROM orders)")
def days_without_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Anti join in time: the days of cells that are none of the other axis, shifted so that the two overlap in part."""
    mine = cell_readings(spark, sf_dir).select("cell", F.to_date("time").alias("day")).distinct()
    other = table(spark, sf_dir, "orders").select(F.date_add(F.to_date("o_orderdate"), 2000).alias("day")).distinct()
    return mine.join(other, "day", "left_anti").select("cell", text_day())


@query(
    f"""WITH {SENSORS}, t AS (SELECT id, site, time, value FROM sensors), n AS (SELECT id, time, abs(epoch_us(time) - epoch_us(TIMESTAMP '2024-01-15 12:00:00')) AS g FROM t)
SELECT id FROM n ORDER BY g, time LIMIT 2"""
)
def two_nearest_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return timeaxis.nearest_times(sensors(spark, sf_dir), "2024-01-15 12:00:00", 2, "time").select("id")


@query(
    """WITH a AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS day FROM orders), b AS (SELECT DISTINCT CAST(l_shipdate AS DATE) AS day FROM lineitem)
SELECT 'both' AS part, count(*) AS days FROM (SELECT * FROM a INTERSECT SELECT * FROM b) UNION ALL SELECT 'first only', count(*) FROM (SELECT * FROM a EXCEPT SELECT * FROM b)
UNION ALL SELECT 'any', count(*) FROM (SELECT * FROM a UNION SELECT * FROM b)"""
)
def axis_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = table(spark, sf_dir, "orders").select(F.to_date("o_orderdate").alias("day")).distinct()
    b = table(spark, sf_dir, "lineitem").select(F.to_date("l_shipdate").alias("day")).distinct()
    n = lambda df, name: df.agg(F.lit(name).alias("part"), F.count(F.lit(1)).alias("days"))
    return n(a.intersect(b), "both").unionByName(n(a.subtract(b), "first only")).unionByName(n(a.union(b).distinct(), "any"))


@query("SELECT event_id, CAST(json_extract_string(props, '$.k') AS VARCHAR) AS attribute FROM events")
def sensor_attribute(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", F.get_json_object("props", "$.k").alias("attribute"))
