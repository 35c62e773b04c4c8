"""Maps the driver's tables to ocean roles, each beside the DuckDB SQL of the same mapping.

Only this module and the query modules know the tables' names; operators take column names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

WIDTH = 50


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cell_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Multi-year series: (cell, time, temp)."""
    return table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("cell"), F.col("l_shipdate").alias("time"), F.col("l_quantity").alias("temp"))


CELL_READINGS = "cell_readings AS (SELECT l_suppkey AS cell, l_shipdate AS time, l_quantity AS temp FROM lineitem)"


def sensors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """High-rate sensors: (id, site, kind, time, value)."""
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("id"), F.col("user_id").alias("site"), F.col("event_type").alias("kind"), F.col("ts").alias("time"), "value"
    )


SENSORS = "sensors AS (SELECT event_id AS id, user_id AS site, event_type AS kind, ts AS time, value FROM events)"


def grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(eta, xi, lon, lat, h, mask, angle, pm, pn, value) of a grid of WIDTH columns."""
    k = F.col("p_partkey")
    eta, xi = F.floor(k / WIDTH).cast("int"), (k % WIDTH).cast("int")
    return table(spark, sf_dir, "part").select(
        eta.alias("eta"), xi.alias("xi"),
        (15 + 0.1 * xi).alias("lon"), (-36 + 0.1 * eta).alias("lat"),
        F.col("p_retailprice").alias("h"), (F.col("p_size") > 5).cast("int").alias("mask"),
        (0.01 * eta).alias("angle"), (1e-3 + 1e-6 * xi).alias("pm"), (1.1e-3 + 1e-6 * eta).alias("pn"),
        F.col("p_size").cast("double").alias("value"),
    )


GRID = f"""grid0 AS (SELECT CAST(p_partkey // {WIDTH} AS INT) AS eta, CAST(p_partkey % {WIDTH} AS INT) AS xi,
    p_retailprice AS h, p_size FROM part),
grid AS (SELECT eta, xi, 15 + CAST(0.1 AS DOUBLE) * xi AS lon, -36 + CAST(0.1 AS DOUBLE) * eta AS lat, h, CAST(p_size > 5 AS INT) AS mask,
    CAST(0.01 AS DOUBLE) * eta AS angle, CAST(1e-3 AS DOUBLE) + CAST(1e-6 AS DOUBLE) * xi AS pm,
    CAST(1.1e-3 AS DOUBLE) + CAST(1e-6 AS DOUBLE) * eta AS pn, CAST(p_size AS DOUBLE) AS value FROM grid0)"""


def sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(site, lon, lat) of points scattered over the grid and a little beyond."""
    k = F.col("c_custkey")
    return table(spark, sf_dir, "customer").select(
        k.alias("site"), (14.9 + 0.01 * ((k * 37) % 510)).alias("lon"), (-36.1 + 0.01 * ((k * 91) % 410)).alias("lat")
    )


SITES = """sites AS (SELECT c_custkey AS site, CAST(14.9 AS DOUBLE) + CAST(0.01 AS DOUBLE) * ((c_custkey * 37) % 510) AS lon,
    CAST(-36.1 AS DOUBLE) + CAST(0.01 AS DOUBLE) * ((c_custkey * 91) % 410) AS lat FROM customer)"""

LEVELS = 64


def profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(cell, h, zeta, temp, salt): profiles bottom to top in a plausible range."""
    e = F.transform("embedding", lambda x: x.cast("double"))
    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("cell"),
        (F.col("vec_id") % 400 + 20).cast("double").alias("h"),
        (F.col("vec_id") % 7 / 10 - 0.3).alias("zeta"),
        F.transform(e, lambda x, i: 4 + 0.2 * i + x).alias("temp"),
        F.transform(e, lambda x, i: 35.2 - 0.01 * i + 0.1 * x).alias("salt"),
    )


PROFILES = """profiles AS (SELECT vec_id AS cell, CAST(vec_id % 400 + 20 AS DOUBLE) AS h,
    CAST(vec_id % 7 AS DOUBLE) / 10 - CAST(0.3 AS DOUBLE) AS zeta, embedding FROM embeddings),
levels AS (SELECT cell, h, zeta, i, CAST(embedding[i + 1] AS DOUBLE) AS e FROM profiles, (SELECT unnest(range(64)) AS i)),
curve AS (SELECT i, (i + 1 - 64 - CAST(0.5 AS DOUBLE)) / 64 AS s FROM (SELECT unnest(range(64)) AS i)),
curve1 AS (SELECT i, s, (1 - cosh(5 * s)) / (cosh(5) - 1) AS c0 FROM curve),
curve2 AS (SELECT i, s, (exp(2 * (c0 + 1)) - 1) / (exp(2) - 1) - 1 AS c FROM curve1),
water AS (SELECT cell, i, CAST(4 AS DOUBLE) + CAST(0.2 AS DOUBLE) * i + e AS temp,
    CAST(35.2 AS DOUBLE) - CAST(0.01 AS DOUBLE) * i + CAST(0.1 AS DOUBLE) * e AS salt,
    (20 * s + c * h) * h / (h + 20) + greatest(zeta, CAST(0.01 AS DOUBLE) - h) * (1 + (20 * s + c * h) / (h + 20)) AS z
    FROM levels JOIN curve2 USING (i))"""
THETA_S, THETA_B, HC = 5.0, 2.0, 20.0
