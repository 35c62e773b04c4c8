"""Registered queries of reads, writes, selections and merges. Each stands beside its DuckDB SQL."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brinework.functions import physics
from brinework.operators import events, filters, forcing, geo, horizontal, timeaxis, validate
from brinework.plans.field_queries import RING
from brinework.plans.series_queries import query, r6, text_day, text_time
from brinework.session import shared_folder
from brinework.sources import io
from brinework.sources.adaptors import CELL_READINGS, GRID, SENSORS, SITES, cell_readings, grid, sensors, sites, table


def _new_folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/files-{uuid.uuid4().hex}"


# reads and writes
@query("SELECT l_linenumber, count(*) AS n, round(sum(l_quantity), 6) AS quantity FROM lineitem GROUP BY ALL")
def pruned_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Only the key and the variable asked for are read."""
    rows = io.read_fields(spark, [f"{sf_dir}/lineitem.parquet"], ["l_quantity"], ["l_linenumber"])
    return rows.groupBy("l_linenumber").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("l_quantity"), 6).alias("quantity"))


@query("SELECT DISTINCT l_suppkey, l_suppkey % 7 AS remainder FROM lineitem WHERE l_suppkey BETWEEN 3 AND 40")
def grid_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A variable that is fixed in time, once for each cell of a box."""
    box = F.col("l_suppkey").between(3, 40)
    return io.read_grid(spark, [f"{sf_dir}/lineitem.parquet"], ["l_suppkey"], [], box).withColumn("remainder", F.col("l_suppkey") % 7)


@query(
    """WITH t AS (SELECT o_orderkey, TIMESTAMP '2000-01-01' + to_seconds(o_orderkey) AS t FROM orders)
SELECT o_orderkey, strftime(t, '%Y-%m-%d %H:%M:%S') AS time FROM t WHERE t BETWEEN TIMESTAMP '2000-01-01 00:10:00' AND TIMESTAMP '2000-01-01 01:00:00'"""
)
def decoded_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Seconds since an origin as times, and a range with both of its ends."""
    rows = table(spark, sf_dir, "orders").select("o_orderkey", timeaxis.decode_time("o_orderkey", "2000-01-01").alias("time"))
    return timeaxis.time_range(rows, "time", "2000-01-01 00:10:00", "2000-01-01 01:00:00").select("o_orderkey", text_time("time"))


@query(f"WITH {SITES} SELECT 'site ' || site AS site, round(lon, 6) AS lon, round(lat, 6) AS lat FROM sites")
def site_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sites written as lines with a comment between, and read again."""
    folder = _new_folder(spark)
    line = F.concat_ws(", ", F.concat(F.lit("site "), F.col("site").cast("string")), "lon", "lat")
    sites(spark, sf_dir).select(F.explode(F.array(line, F.lit("# a comment"), F.lit(" "))).alias("value")).write.text(folder)
    return io.read_sites(spark, folder).select("site", r6("lon"), r6("lat"))


@query(
    f"""WITH {SENSORS} SELECT strftime(date_trunc('second', time), '%Y-%m-%d %H:%M:%S') AS time, round(value, 6) AS flow FROM sensors
WHERE date_trunc('second', time) BETWEEN TIMESTAMP '2024-02-10' - INTERVAL 1 MONTH AND TIMESTAMP '2024-02-20' + INTERVAL 1 MONTH"""
)
def river_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A river's series as text in its two forms of date, read for a period and a month around it."""
    folder = _new_folder(spark)
    s = sensors(spark, sf_dir)
    form = F.when(F.col("id") % 2 == 0, F.date_format("time", "dd/MM/yyyy HH:mm:ss")).otherwise(F.date_format("time", "yyyy-MM-dd HH:mm:ss"))
    s.select(F.concat_ws(" ", form, F.col("value").cast("string"))).write.text(folder)
    return io.read_river(spark, folder, "2024-02-10", "2024-02-20").select(text_time("time"), r6("flow"))


@query(f"WITH {GRID} SELECT round(lon, 6) AS x, round(lat, 6) AS y, round(-h, 6) AS z FROM grid")
def scatter_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = _new_folder(spark)
    grid(spark, sf_dir).select("lon", "lat", -F.col("h")).write.csv(folder)
    return io.read_scatter(spark, folder).select(r6("x"), r6("y"), r6("z"))


@query("SELECT p_partkey, CASE WHEN p_size > 5 THEN round(p_size * 10 * 0.01::DOUBLE + 5, 6) END AS value, CASE WHEN p_size <> 7 THEN p_size END AS size FROM part")
def unpacked_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Packed integers with a fill value, and a marker of missing values, to nulls."""
    packed = F.when(F.col("p_size") > 5, F.col("p_size") * 10).otherwise(-32767)
    rows = table(spark, sf_dir, "part").select("p_partkey", physics.unpack(packed, 0.01, 5.0, -32767.0).alias("value"), F.when(F.col("p_size") == 7, -127).otherwise(F.col("p_size")).alias("size"))
    return io.nulls_for_fills(rows, ["size"]).select("p_partkey", r6("value"), "size")


@query(
    f"""WITH {CELL_READINGS}, d AS (SELECT cell, CAST(time AS DATE) AS day, avg(temp) AS temp FROM cell_readings GROUP BY ALL)
SELECT p AS period, cell, count(*) AS n, count(DISTINCT CASE p WHEN 'month' THEN strftime(day, '%Y-%m') WHEN 'year' THEN strftime(day, '%Y') ELSE '' END) AS parts, round(sum(temp), 6) AS temp, round(sum(-temp), 6) AS anomaly
FROM d, (SELECT unnest(['month', 'year', 'full']) AS p) GROUP BY ALL"""
)
def written_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily means written by month, year and whole, with a variable appended to what is read again."""
    daily = timeaxis.daily_mean(cell_readings(spark, sf_dir), ["cell"], values=("temp",)).drop("n")
    out = None
    for period, part in (("month", F.date_format("day", "yyyy-MM")), ("year", F.date_format("day", "yyyy")), ("full", F.lit(""))):
        folder = _new_folder(spark)
        io.write_products(daily, folder, period=period)
        back = spark.read.parquet(folder).select("cell", "day", "temp")
        both = io.append_columns(back, daily.select("cell", "day", (-F.col("temp")).alias("anomaly")), ["cell", "day"])
        got = both.groupBy(F.lit(period).alias("period"), "cell").agg(
            F.count(F.lit(1)).alias("n"), F.count_distinct(part).alias("parts"), F.round(F.sum("temp"), 6).alias("temp"), F.round(F.sum("anomaly"), 6).alias("anomaly")
        )
        out = got if out is None else out.unionByName(got)
    return out


@query(
    f"""WITH {GRID} SELECT round((epoch_us(TIMESTAMP '2024-01-02 03:04:30') - epoch_us(TIMESTAMP '2000-01-01')) / 86400000000.0, 3) AS time, eta, xi,
round(CAST(CAST(coalesce(CASE WHEN mask = 1 THEN h END, 9999) AS FLOAT) AS DOUBLE), 2) AS zeta,
round(CAST(CAST(coalesce(CASE WHEN mask = 1 THEN value * cos(angle) - 0.5 * sin(angle) END, 9999) AS FLOAT) AS DOUBLE), 2) AS u,
round(CAST(CAST(coalesce(CASE WHEN mask = 1 THEN 0.5 * cos(angle) + value * sin(angle) END, 9999) AS FLOAT) AS DOUBLE), 2) AS v FROM grid"""
)
def exported_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Velocities turned to east and north, nulls as a fill value, times as days."""
    g = grid(spark, sf_dir)
    wet = lambda c: F.when(F.col("mask") == 1, c)
    fields = g.select(F.lit("2024-01-02 03:04:30").cast("timestamp").alias("time"), "eta", "xi", wet(F.col("h")).alias("zeta"), wet(F.col("value")).alias("u"), wet(F.lit(0.5)).alias("v"))
    out = forcing.export_fields(fields, g, "2000-01-01", [("u", "v")], ["zeta"])
    return out.select(F.round("time", 3).alias("time"), "eta", "xi", *[F.round(F.col(c).cast("double"), 2).alias(c) for c in ("zeta", "u", "v")])


@query("SELECT event_id, user_id AS depth, user_id / 10 AS lat, user_id / 20 AS lon, round(value, 6) AS temp FROM events")
def renamed_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = table(spark, sf_dir, "events").select("event_id", F.col("user_id").alias("depth"), (F.col("user_id") / 10).alias("latitude"), (F.col("user_id") / 20).alias("longitude"), F.col("value").alias("temperature"))
    return io.rename_product(raw, "mercator").select("event_id", "depth", "lat", "lon", r6("temp"))


@query(f"WITH {SITES} SELECT round(min(lon), 6) AS lon_min, round(max(lon), 6) AS lon_max, round(min(lat), 6) AS lat_min, round(max(lat), 6) AS lat_max, min(site) AS time_min, max(site) AS time_max FROM sites")
def covered_extent(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = validate.coverage(sites(spark, sf_dir).withColumnRenamed("site", "time"), "lon", "lat", "time")
    return got.select(*[r6(c) if t == "double" else c for c, t in got.dtypes])


# selections
@query("SELECT vec_id AS cell, round(CAST(embedding[4] AS DOUBLE), 6) AS one, round(list_sum(list_transform(embedding[3:6], lambda x: CAST(x AS DOUBLE))), 6) AS some FROM embeddings")
def level_picks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A level by its index, and the sum of an inclusive range of levels."""
    v = F.transform("embedding", lambda x: x.cast("double"))
    total = F.aggregate(filters.level_slice(v, (2, 5)), F.lit(0.0), lambda a, x: a + x)
    return table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("cell"), r6(filters.level_slice(v, 3), "one"), r6(total, "some"))


@query(f"WITH {SITES} SELECT site FROM sites WHERE lon BETWEEN 15.995 AND 18.005 AND lat BETWEEN -35.005 AND -33.995")
def buffered_box(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sites(spark, sf_dir).where(filters.in_box("lon", "lat", (16.0, 18.0, -35.0, -34.0), 0.005)).select("site")


@query(f"WITH {SENSORS} SELECT id FROM sensors WHERE time >= (SELECT max(CAST(time AS DATE)) FROM sensors) - INTERVAL 6 DAY")
def recent_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records of runs of the last days before a run date."""
    s = sensors(spark, sf_dir)
    last = s.agg(F.max(F.to_date("time")).cast("string").alias("d")).first().d
    return filters.run_window(s, "time", last, 5).select("id")


def _outside(lon: str, lat: str) -> str:
    edges = zip(RING, RING[1:] + RING[:1])
    return "(" + " + ".join(f"CAST(({b} > {lat}) <> ({d} > {lat}) AND {lon} < ({c} - ({a})) * ({lat} - ({b})) / ({d} - ({b})) + ({a}) AS INT)" for (a, b), (c, d) in edges) + ") % 2 = 0"


@query(f"WITH {GRID} SELECT eta, xi, CASE WHEN {_outside('lon', 'lat')} THEN value END AS value FROM grid")
def outer_area(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values inside of a polygon go."""
    return filters.inside_cut(grid(spark, sf_dir), RING, ["value"]).select("eta", "xi", "value")


@query(f"WITH {SITES}, a AS (SELECT site, lon * 20 - 400 AS lon FROM sites) SELECT site, round(lon - 360 * floor((lon + 180) / 360), 6) AS lon FROM a")
def shifted_longitudes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sites(spark, sf_dir).select("site", r6(geo.shift_longitude(F.col("lon") * 20 - 400, -180.0), "lon"))


@query("SELECT event_id, strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') AS stamp, 3 AS parts FROM events")
def stamps_and_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Times in file names, and lists written with blanks and empty items."""
    name = F.concat(F.lit("/runs/model_"), F.date_format("ts", "yyyyMMddHH"), F.lit(".nc"))
    listed = F.concat_ws(" , ", F.lit("a"), F.col("user_id").cast("string"), F.lit(""), F.lit("b "))
    return table(spark, sf_dir, "events").select("event_id", F.date_format(filters.stamp_of(name), "yyyy-MM-dd HH:mm:ss").alias("stamp"), F.size(filters.parse_list(listed)).alias("parts"))


# sites and grids
@query(
    f"""WITH {GRID}, {SITES}, s AS (SELECT site, lon, lat, CAST(site % 3 - 1 AS INT) AS di, CASE WHEN site % 4 > 0 THEN CAST(site % 4 AS INT) END AS dj, CASE WHEN site % 2 = 0 THEN 905.0::DOUBLE END AS bottom FROM sites),
p AS (SELECT s.site, di, dj, g.eta, g.xi, row_number() OVER (PARTITION BY s.site ORDER BY round(sqrt((g.lon - s.lon) ** 2 + (g.lat - s.lat) ** 2), 12), g.eta, g.xi) AS k
FROM s JOIN grid g ON g.mask = 1 AND (bottom IS NULL OR g.h >= bottom))
SELECT site, eta + coalesce(dj, 0) AS eta, xi + coalesce(di, 0) AS xi FROM p WHERE k = 1"""
)
def shifted_site_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each site with a depth and a shift of its own."""
    k = F.col("site")
    s = sites(spark, sf_dir).withColumns({"di": (k % 3 - 1).cast("int"), "dj": F.when(k % 4 > 0, (k % 4).cast("int")), "bottom": F.when(k % 2 == 0, 905.0)})
    return geo.sites_to_indices(s, grid(spark, sf_dir), "site", "di", "dj", "bottom")


@query(
    f"""WITH {CELL_READINGS}, d AS (SELECT cell, dayofyear(time) AS doy, avg(temp) AS a, max(temp) AS b, min(temp) AS c FROM cell_readings GROUP BY ALL)
SELECT cell, CAST(doy AS INT) AS doy, round(a, 6) AS clim, CASE WHEN cell % 2 = 0 THEN round(b, 6) END AS thr90, CASE WHEN cell % 2 = 0 THEN round(c, 6) END AS thr10 FROM d"""
)
def harmonised_baselines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A climatology and thresholds of half of the cells, from tables with names of their own."""
    by = cell_readings(spark, sf_dir).groupBy("cell", F.dayofyear("time").alias("doy"))
    clim = by.agg(F.avg("temp").alias("temp"))
    thresholds = by.agg(F.max("temp").alias("threshold_90"), F.min("temp").alias("threshold_10")).where("cell % 2 = 0")
    return events.combined_baselines(clim, thresholds, ["cell"]).select("cell", "doy", r6("clim"), r6("thr90"), r6("thr10"))


@query(
    """WITH a AS (SELECT CAST(o_orderdate AS DATE) AS day, avg(o_totalprice) AS price FROM orders GROUP BY ALL),
b AS (SELECT CAST(l_shipdate AS DATE) AS day, avg(l_extendedprice) AS price, sum(l_quantity) AS quantity FROM lineitem GROUP BY ALL)
SELECT strftime(coalesce(a.day, b.day), '%Y-%m-%d') AS day, round(coalesce(a.price, b.price), 6) AS price, round(quantity, 6) AS quantity FROM a FULL JOIN b ON a.day = b.day"""
)
def merged_variables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two tables on the union of their days; of the variable in both the first one's wins."""
    a = table(spark, sf_dir, "orders").groupBy(F.to_date("o_orderdate").alias("day")).agg(F.avg("o_totalprice").alias("price"))
    b = table(spark, sf_dir, "lineitem").groupBy(F.to_date("l_shipdate").alias("day")).agg(F.avg("l_extendedprice").alias("price"), F.sum("l_quantity").alias("quantity"))
    return timeaxis.merge_first([a, b], ["day"]).select(text_day(), r6("price"), r6("quantity"))


@query(
    f"""WITH {GRID}, c AS (SELECT eta, xi, lon * 0.5 + 7.613 AS lon, lat * 0.5 - 17.963 AS lat, 1 AS mask FROM grid), e AS (SELECT min(eta) AS a, max(eta) AS b, min(xi) AS c, max(xi) AS d FROM c),
m AS (SELECT c.*, eta < a + 2 OR eta > b - 2 OR xi < e.c + 2 OR xi > d - 2 AS edge FROM c, e),
p AS (SELECT m.eta, m.xi, g.mask, row_number() OVER (PARTITION BY m.eta, m.xi ORDER BY round(sqrt((g.lon - m.lon) ** 2 + (g.lat - m.lat) ** 2), 12), g.eta, g.xi) AS k FROM m, grid g WHERE edge)
SELECT m.eta, m.xi, coalesce(p.mask, m.mask) AS mask FROM m LEFT JOIN p ON m.eta = p.eta AND m.xi = p.xi AND k = 1"""
)
def transferred_mask(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A finer grid inside of the grid takes its mask at the two outer rows of each side."""
    g = grid(spark, sf_dir)
    child = g.select("eta", "xi", (F.col("lon") * 0.5 + 7.613).alias("lon"), (F.col("lat") * 0.5 - 17.963).alias("lat"), F.lit(1).alias("mask"))
    return geo.transfer_mask(child, g).select("eta", "xi", "mask")


@query(f"WITH {GRID} SELECT eta, xi, value, CASE WHEN eta % 2 = 0 THEN round(h + 1, 6) END AS h FROM grid")
def attached_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A separate grid's depths replace the field's own."""
    g = grid(spark, sf_dir)
    other = g.where("eta % 2 = 0").withColumn("h", F.col("h") + 1)
    return geo.attach_grid(g.select("eta", "xi", "value", "h"), other, ["h"]).select("eta", "xi", "value", r6("h"))


@query(
    f"""WITH {GRID}, p AS (SELECT lon + 0.013 AS lon, lat - 0.021 AS lat, value FROM grid WHERE xi % 4 = 1 AND eta % 3 = 0),
q AS (SELECT g.eta, g.xi, p.value, row_number() OVER (PARTITION BY g.eta, g.xi ORDER BY round(sqrt((g.lon - p.lon) ** 2 + (g.lat - p.lat) ** 2), 12), p.lat, p.lon) AS k FROM grid g, p)
SELECT eta, xi, greatest(10, least(40, value)) AS value FROM q WHERE k = 1"""
)
def scattered_to_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The value of the nearest of scattered points, clamped, at each cell."""
    g = grid(spark, sf_dir)
    points = g.where("xi % 4 = 1 and eta % 3 = 0").select((F.col("lon") + 0.013).alias("lon"), (F.col("lat") - 0.021).alias("lat"), "value")
    return horizontal.scatter_to_grid(points, g, "value", 10.0, 40.0)


@query(
    f"""WITH {GRID}, w AS (SELECT eta, xi, CAST(value > 20 AS INT) AS wet, h FROM grid), b AS (SELECT eta, xi, 0.01 * xi AS d FROM grid)
SELECT eta, xi, wet, round(h * (1 - (0.5 * (exp(100 * (d - 0.06)) - 1) / (exp(100 * (d - 0.06)) + 1) + 0.5)) + 1000 * (0.5 * (exp(100 * (d - 0.06)) - 1) / (exp(100 * (d - 0.06)) + 1) + 0.5), 6) AS blended FROM w JOIN b USING (eta, xi)"""
)
def blended_depths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A mask from depths, and depths that turn from one grid's to another's away from the edge."""
    w = physics.blend_weight(0.01 * F.col("xi"))
    return grid(spark, sf_dir).select("eta", "xi", (F.col("value") - 20).alias("depth"), "h", w.alias("w")).select(
        "eta", "xi", filters.wet_from_depth("depth").alias("wet"), r6(F.col("h") * (1 - F.col("w")) + 1000 * F.col("w"), "blended")
    )


# along time
@query(
    f"""WITH {SENSORS}, s AS (SELECT site, kind, time, id, value, row_number() OVER (PARTITION BY site, kind ORDER BY time, id) AS k FROM sensors)
SELECT site, id, CAST(row_number() OVER (PARTITION BY site ORDER BY time, id) - 1 AS INT) AS position FROM s WHERE k > 1"""
)
def station_sequence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A station table for each kind in sequence; each loses the first record of a site. Times stand for (time, id), which has no ties."""
    s = sensors(spark, sf_dir).withColumn("at", F.struct("time", "id"))
    kinds = sorted(r.kind for r in s.select("kind").distinct().collect())  # a few kinds
    parts = [s.where(F.col("kind") == k).select("site", "id", "at") for k in kinds]
    return timeaxis.in_sequence(parts, ["site"], "at", drop_first=True).select("site", "id", "position")


@query(
    f"""WITH {GRID}, v AS (SELECT eta, xi, CASE WHEN xi BETWEEN 5 AND 40 AND value > 10 THEN value END AS value FROM grid),
k AS (SELECT eta, xi AS x, value AS y FROM v WHERE value IS NOT NULL), n AS (SELECT *, row_number() OVER (PARTITION BY eta ORDER BY x) AS a, row_number() OVER (PARTITION BY eta ORDER BY x DESC) AS b FROM k),
f AS (SELECT eta, max(x) FILTER (a = 1) AS x1, max(x) FILTER (a = 2) AS x2, max(y) FILTER (a = 1) AS y1, max(y) FILTER (a = 2) AS y2,
    max(x) FILTER (b = 1) AS z1, max(x) FILTER (b = 2) AS z2, max(y) FILTER (b = 1) AS w1, max(y) FILTER (b = 2) AS w2 FROM n GROUP BY ALL),
m AS (SELECT v.*, f.*, (SELECT max(x) FROM k WHERE k.eta = v.eta AND x <= xi) AS xa, (SELECT min(x) FROM k WHERE k.eta = v.eta AND x >= xi) AS xb FROM v LEFT JOIN f ON v.eta = f.eta)
SELECT m.eta, m.xi, round(CASE WHEN m.value IS NOT NULL THEN m.value WHEN xa IS NULL THEN y1 + (y2 - y1) * (m.xi - x1) / (x2 - x1) WHEN xb IS NULL THEN w1 + (w2 - w1) * (m.xi - z1) / (z2 - z1)
ELSE a.y + (b.y - a.y) * (m.xi - xa) / (xb - xa) END, 6) AS value FROM m LEFT JOIN k a ON a.eta = m.eta AND a.x = xa LEFT JOIN k b ON b.eta = m.eta AND b.x = xb"""
)
def extrapolated_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Missing values along a row by the line between, and beyond the ends by the line of, the known ones around them."""
    v = grid(spark, sf_dir).select("eta", "xi", F.when(F.col("xi").between(5, 40) & (F.col("value") > 10), F.col("value")).alias("value"), F.timestamp_seconds("xi").alias("at"))
    return timeaxis.interpolate(v, ["eta"], "at", "value", "linear").select("eta", "xi", r6("value"))


@query(
    f"""WITH {SENSORS}, t AS (SELECT site, value, date_trunc('day', time + INTERVAL 12 HOUR) AS d, time FROM sensors)
SELECT site, strftime(d, '%Y-%m-%d') AS day, round(avg(value), 6) AS flow FROM t WHERE abs(epoch_us(time) - epoch_us(d)) < 43200000000 AND d BETWEEN TIMESTAMP '2024-01-05' AND TIMESTAMP '2024-01-20' GROUP BY ALL
UNION ALL SELECT site, strftime(date_trunc('month', time), '%Y-%m') AS day, round(avg(value), 6) FROM sensors WHERE time BETWEEN TIMESTAMP '2024-01-05' AND TIMESTAMP '2024-01-20' GROUP BY ALL"""
)
def river_axis(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flows on a daily and on a monthly axis."""
    flow = sensors(spark, sf_dir).select("site", "time", F.col("value").alias("flow"))
    day, month = (forcing.river_on_axis(flow, ["site"], "2024-01-05", "2024-01-20", o) for o in ("daily", "monthly"))
    shown = lambda df, form: df.select("site", F.date_format("time", form).alias("day"), r6("flow"))
    return shown(day, "yyyy-MM-dd").unionByName(shown(month, "yyyy-MM"))


@query(
    f"""WITH {GRID}, r AS (SELECT CAST(l_partkey // 50 AS INT) AS eta, CAST(l_partkey % 50 AS INT) AS xi, avg(l_quantity) AS flow FROM lineitem GROUP BY ALL HAVING avg(l_quantity) >= 20),
e AS (SELECT min(eta) AS a, max(eta) AS b, min(xi) AS c, max(xi) AS d FROM grid)
SELECT r.eta, r.xi, round(flow, 6) AS flow FROM r JOIN grid g USING (eta, xi), e WHERE g.mask = 1 AND g.eta > a AND g.eta < b AND g.xi > c AND g.xi < d
AND EXISTS (SELECT 1 FROM grid l WHERE l.mask = 0 AND abs(l.eta - g.eta) <= 1 AND abs(l.xi - g.xi) <= 1)"""
)
def coastal_discharge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean flows of coastal cells above a threshold."""
    k = F.col("l_partkey")
    flow = table(spark, sf_dir, "lineitem").select(F.floor(k / 50).cast("int").alias("eta"), (k % 50).cast("int").alias("xi"), F.col("l_quantity").alias("flow"))
    return forcing.coastal_discharge(flow, grid(spark, sf_dir), 20.0).select("eta", "xi", r6("flow"))
