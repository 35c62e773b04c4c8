"""Metadata, provenance, files without a variable, equal axes, whole product jobs."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from brinework.operators import events, timeaxis, validate
from brinework.plans import workloads
from brinework.sources import io


def test_metadata_and_provenance(spark):
    df = spark.createDataFrame([(1, 2.0)], "time int, temp double")
    told = io.with_metadata(df, {"temp": {"long_name": "temperature", "units": "degrees"}, "gone": {"units": "m"}})
    assert told.schema["temp"].metadata == {"long_name": "temperature", "units": "degrees"} and told.schema["time"].metadata == {}
    assert told.columns == df.columns and told.collect() == df.collect()
    assert [tuple(r) for r in io.provenance(df, "", "made").collect()] == [("time,temp", "made")]
    assert io.provenance(df, "made", "changed").first().history == "made\nchanged"


def test_files_without_a_variable(spark, tmp_path):
    schema = "time int, temp double, salt double"
    for name, rows in {"a": [(1, 1.0, 2.0)], "b": [(1, None, 2.0), (2, None, 3.0)], "c": [(1, 1.0, None)]}.items():
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(tmp_path / name))
    whole = spark.read.parquet(str(tmp_path / "a"))
    assert validate.incomplete_files(whole, ["temp", "salt"]) is None
    both = spark.read.parquet(str(tmp_path / "a"), str(tmp_path / "b"), str(tmp_path / "c"))
    with pytest.raises(ValueError) as found:
        validate.incomplete_files(both, ["temp", "salt"])
    assert "/b/" in str(found.value) and "/c/" in str(found.value) and "/a/" not in str(found.value)
    with pytest.raises(ValueError):
        validate.incomplete_files(both, ["temp"])


def test_equal_axes(spark):
    a = spark.createDataFrame([(1, "x"), (2, "y"), (2, "y"), (None, "z")], "t int, q string")
    assert timeaxis.same_axis(a, a.orderBy(F.desc("t")), ["t"]) and not timeaxis.same_axis(a, a.dropDuplicates(), ["t"])
    assert not timeaxis.same_axis(a, a.where("t is not null"), ["t"]) and timeaxis.same_axis(a.limit(0), a.limit(0), ["t"])


def test_repeated_ends(spark):
    rows = [(1, dt.datetime(2020, 1, 3)), (2, dt.datetime(2020, 1, 30)), (3, dt.datetime(2020, 2, 28)), (4, dt.datetime(2020, 5, 10)), (5, None)]
    df = spark.createDataFrame(rows, "id int, time timestamp")
    got = {(r.id, r.month, r.time) for r in timeaxis.with_repeated_ends(df, "time", 2).where("repeated").collect()}
    day = dt.datetime
    assert got == {(1, "2020-01", day(2019, 12, 30)), (3, "2020-02", day(2020, 3, 2)), (4, "2020-05", day(2020, 4, 29)), (4, "2020-05", day(2020, 6, 2))}
    with pytest.raises(ValueError, match="2020-01, 2020-02, 2020-05"):
        timeaxis.with_repeated_ends(df, "time", 2, "error")
    assert timeaxis.with_repeated_ends(df.limit(0), "time", 2).collect() == []


def test_the_product_job(spark):
    """Readings to daily means, anomalies and categories in one job: a warm week stands out of a flat year."""
    t0 = dt.datetime(2021, 1, 1)
    readings = spark.createDataFrame([(1, t0 + dt.timedelta(hours=12 * k), 25.0 if 200 <= k // 2 < 208 else 15.0 + (k % 2) * 0.2) for k in range(2 * 365)], "cell int, time timestamp, temp double")
    clim = spark.createDataFrame([(1, d, 15.1, 17.1, 13.1) for d in range(1, 367)], "cell int, doy int, clim double, thr90 double, thr10 double")
    out = {r.day: r for r in workloads.heatwave_products(readings, clim, ["cell"]).collect()}
    assert len(out) == 365
    for d, r in out.items():
        inside = 200 <= (d - t0.date()).days < 208
        assert (r.category, r.temp_anom) == ((4, pytest.approx(9.9)) if inside else (0, pytest.approx(0.0)))
    assert events.year_stats(workloads.heatwave_products(readings, clim, ["cell"]), ["cell"]).first().mhw_count == 1
