"""Work that must stay in proportion to the input: rows that any step of a plan gives out, on tables that are long, repeated or crowded."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from brinework.operators import geo
from brinework.plans import registry

registry.load()


def most_rows(df):
    """The most rows that a step of the plan gave out, after a run."""
    df.collect()

    def of(node):
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            return of(node.executedPlan())
        if name.endswith("QueryStageExec"):
            return of(node.plan())
        m = node.metrics().get("numOutputRows")
        own = m.get().value() if m.isDefined() else 0
        return max([own] + [of(node.children().apply(k)) for k in range(node.children().size())])

    return of(df._jdf.queryExecution().executedPlan())


@pytest.fixture(scope="module")
def long_tables(spark, tmp_path_factory):
    """A folder whose grid has 50 columns and 600 rows, and 3,000 sites."""
    folder = tmp_path_factory.mktemp("long")
    for name, key, step, times in (("part", "p_partkey", 200, 150), ("customer", "c_custkey", 150, 20)):
        t = spark.read.parquet(f"/root/testdata/sf0.001/{name}.parquet")
        copies = t.crossJoin(spark.range(times).withColumnRenamed("id", "r")).withColumn(key, F.col(key) + F.col("r") * step).drop("r")
        copies.coalesce(1).write.parquet(str(folder / f"{name}.parquet"))
    (folder / "embeddings.parquet").symlink_to("/root/testdata/sf0.001/embeddings.parquet")
    return str(folder)


@pytest.mark.parametrize("name, times", [("nearest_cells", 12), ("profiles_at_sites", 12), ("scattered_to_grid", 12), ("series_at_sites", 12), ("shifted_site_cells", 12), ("vectors_at_sites", 12), ("transferred_mask", 12)])
def test_sites_on_a_long_grid(spark, long_tables, name, times):
    got = registry.QUERIES[name](spark, long_tables)
    assert most_rows(got) <= times * 30_000


def test_sites_of_one_place_search_once(spark):
    grid = spark.range(4000).selectExpr("CAST(id / 4 AS INT) AS eta", "CAST(id % 4 AS INT) AS xi", "0.1 * (id % 4) AS lon", "0.1 * CAST(id / 4 AS INT) AS lat", "1.0 AS h", "1 AS mask")
    sites = spark.range(5000).selectExpr("id AS site", "0.12D AS lon", "CASE WHEN id % 5 = 4 THEN CAST('NaN' AS DOUBLE) ELSE 1.0D * (id % 5) END AS lat")
    got = geo.nearest_cell(sites, grid)
    assert most_rows(got) <= 5000
    assert {(r.eta, r.xi, r["count"]) for r in got.groupBy("eta", "xi").count().collect()} == {(10 * k, 1, 1000) for k in range(4)}


def test_profiles_meet_observations_only(spark):
    """Forty profiles of one cell and 500 sites there, of which one is observed once."""
    from brinework.plans import workloads

    columns = spark.range(40).selectExpr("0 AS eta", "0 AS xi", "TIMESTAMP '2024-01-01' + make_dt_interval(0, CAST(6 * id AS INT)) AS time", "array(-20.0D, 0.0D) AS z", "array(4.0D, CAST(id AS DOUBLE)) AS temp")
    found = spark.range(500).selectExpr("id AS site", "0 AS eta", "0 AS xi", "1.0D AS lon", "1.0D AS lat", "1.0D AS cell_lon", "1.0D AS cell_lat")
    obs = spark.createDataFrame([(7, 12, 3.5)], "site bigint, hours int, obs double").selectExpr("site", "TIMESTAMP '2024-01-01' + make_dt_interval(0, hours) AS time", "obs")
    got = workloads.model_against_observations(columns, obs, found, -10.0, "temp", F.lit("2024-01-01").cast("timestamp"), 21_600)
    assert most_rows(got) <= 500
    assert [(r.site, r.n) for r in got.collect()] == [(7, 1)]


def test_no_whole_day(spark, tmp_path):
    """Times at random are closer than even ones in the median, so that each of many days falls short of 0.7."""
    for k in range(4):
        day = spark.range(3000).selectExpr("id AS event_id", "1L AS user_id", "'a' AS event_type", f"CAST(TIMESTAMP '2024-01-0{k + 1}' + make_dt_interval(0, 0, 0, 10 * (id + 1) + IF(id % 3 = 0, 9, 0)) AS TIMESTAMP_NTZ) AS ts", "1.0D AS value")
        day.write.mode("append").parquet(str(tmp_path / "events.parquet"))
    assert registry.QUERIES["whole_days"](spark, str(tmp_path)).collect() == []


def test_many_distinct_sites(spark, tmp_path):
    """An estimate is off beyond a few thousand sites; the query counts."""
    t = spark.range(60_000).selectExpr("id AS event_id", "id % 20000 AS user_id", "IF(id % 40000 < 20000, 'a', 'b') AS event_type", "CAST(TIMESTAMP '2024-01-31' + make_dt_interval(CAST(id / 30000 AS INT)) AS TIMESTAMP_NTZ) AS ts", "1.0D AS value")
    t.write.parquet(str(tmp_path / "events.parquet"))
    got = {(r.kind, r.month): r.n_distinct for r in registry.QUERIES["distinct_sites"](spark, str(tmp_path)).collect()}
    assert got == {("a", "2024-01"): 20_000, ("a", "2024-02"): 20_000, ("b", "2024-01"): 10_000, ("b", "2024-02"): 10_000, ("a", None): 20_000, ("b", None): 20_000}


def test_upsert_of_many_users_has_few_files(spark, tmp_path):
    from brinework.session import shared_folder

    t = spark.range(4000).selectExpr("id AS event_id", "id % 400 AS user_id", "'a' AS event_type", "CAST(TIMESTAMP '2024-01-01' AS TIMESTAMP_NTZ) AS ts", "1.0D * id AS value")
    t.write.parquet(str(tmp_path / "events.parquet"))
    streams = lambda: set(Path(shared_folder(spark).removeprefix("file:")).glob("stream-*"))
    before = streams()
    got = {r.user_id: (r.n, r.events) for r in registry.QUERIES["stream_upsert"](spark, str(tmp_path)).collect()}
    assert sum(n for n, _ in got.values()) == sum(e for _, e in got.values()) == 4000 and set(got) == {*range(400), None}
    (folder,) = streams() - before
    assert len(list((folder / "out").rglob("*.parquet"))) <= 64


def test_points_of_one_place_meet_edges_once(spark):
    """A comb of 400 tall teeth; 3,000 points at three places."""
    n = 400
    vertices = spark.range(2 * n + 2).selectExpr("id AS k", f"CASE WHEN id < 2 * {n} THEN 0.01 * id ELSE IF(id = 2 * {n}, 0.01 * id, 0.0) END AS lon", f"IF(id < 2 * {n}, 1.0 * (id % 2), -1.0) AS lat").selectExpr("k", "CAST(lon AS DOUBLE) AS lon", "CAST(lat AS DOUBLE) AS lat")
    points = spark.range(3000).selectExpr("id AS site", "4.005D AS lon", "element_at(array(-0.5D, 0.25D, 0.75D), CAST(id % 3 + 1 AS INT)) AS lat")
    got = geo.in_ring(points, geo.ring_edges(vertices, "k"), "site")
    assert most_rows(got) <= 10_000
    assert {(r.site % 3, r.inside) for r in got.collect()} == {(0, True), (1, True), (2, False)}


def test_missing_days_of_a_sparse_record_are_no_rows(spark):
    from brinework.plans import monthly

    days = spark.range(24).selectExpr("CAST(1 AS INT) AS cell", "date_add(DATE '2001-01-15', CAST(id * 30 AS INT)) AS day", "20.0D AS temp")
    clim = spark.range(1, 367).selectExpr("CAST(1 AS INT) AS cell", "CAST(id AS INT) AS doy", "15.0D AS clim", "17.0D AS thr90", "13.0D AS thr10")
    got = monthly.detected(days, clim, [12 * 2001 + m for m in range(1, 25)], ["cell"])
    assert most_rows(got) <= 24 * 24  # 24 rows of the record, 730 days
    assert got.where("real").count() == 24 and got.where("category <> 0").count() == 0
