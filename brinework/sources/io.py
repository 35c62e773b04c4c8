"""Sources and sinks: pruned reads, site and river files, product renames, monthly output."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# Names of the variables in the known ocean products (standard name: product name).
PRODUCTS = {
    "glorys": {"time": "time", "depth": "depth", "lat": "latitude", "lon": "longitude", "zeta": "zos", "temp": "thetao", "salt": "so", "u": "uo", "v": "vo"},
    "mercator": {"time": "time", "depth": "depth", "lat": "latitude", "lon": "longitude", "zeta": "ssh", "temp": "temperature", "salt": "salinity", "u": "u", "v": "v"},
    "soda": {"time": "time", "depth": "depth", "lat": "lat", "lon": "lon", "zeta": "ssh", "temp": "temp", "salt": "salt", "u": "u", "v": "v"},
}


def read_fields(spark: SparkSession, paths: str | list[str], variables: list[str], keys: list[str]) -> DataFrame:
    """One or many files, folders or globs; only the keys and the variables asked for are read."""
    df = spark.read.parquet(*([paths] if isinstance(paths, str) else paths))
    lacking = [c for c in (*keys, *variables) if c not in df.columns]
    if lacking:
        raise ValueError(f"unknown variables: {', '.join(lacking)}")
    return df.select(*keys, *variables)


def read_runs(spark: SparkSession, path: str, schema: StructType | str, run_date: str, days: int, max_age_hours: int = 12, files: str = "*.parquet", stamp: str = r"(\d{10})[^0-9]*$") -> DataFrame:
    """The records of the runs from ``days + 1`` before a date on, with their ``run``; other files are not opened.

    A run's time is the stamp (yyyyMMddHH) at the end of its file's name, or of the folder's; files
    without one are left out. The age is checked on the listing: no run within ``max_age_hours``
    before the date, or later, is an error.
    """
    at = F.lit(run_date).cast("timestamp")
    time_of = lambda name: F.try_to_timestamp(F.regexp_extract(name, stamp, 1), F.lit("yyyyMMddHH"))
    own = lambda name: F.coalesce(time_of(F.regexp_extract(name, r"([^/]+)\.\w+$", 1)), time_of(F.regexp_extract(name, r"([^/]+)/[^/]+$", 1)))
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", files).load(path).select(own(F.col("path")).alias("run"))
    fresh = listed.agg((F.max("run") >= at - F.expr(f"interval {max_age_hours} hours")).alias("fresh")).first().fresh
    if not fresh:
        raise ValueError(f"the newest run is more than {max_age_hours} hours before {run_date}")
    runs = spark.read.schema(schema).option("recursiveFileLookup", "true").option("pathGlobFilter", files).parquet(path)
    run = own(F.col("_metadata.file_path"))
    return runs.where(run >= at - F.expr(f"interval {days + 1} days")).select("*", run.alias("run"))


def read_grid(spark: SparkSession, paths: str | list[str], keys: list[str], static: list[str], where: Column | None = None) -> DataFrame:
    """The variables that do not change in time, once for each cell: of the first file of a list, in an index box if one is asked for."""
    first = paths if isinstance(paths, str) else paths[0]
    df = read_fields(spark, first, static, keys)
    return (df if where is None else df.where(where)).dropDuplicates(keys)


def rename_product(df: DataFrame, product: str) -> DataFrame:
    """Standard names for a product's variables; an unknown product is an error."""
    if product not in PRODUCTS:
        raise ValueError(f"unknown product {product!r}: {', '.join(PRODUCTS)}")
    return df.withColumnsRenamed({there: here for here, there in PRODUCTS[product].items()})


def nulls_for_fills(df: DataFrame, columns: list[str], fills: tuple[float, ...] = (-127,)) -> DataFrame:
    """NaN and fill markers become null, once, at the source."""
    def clean(c: str) -> Column:
        x = F.col(c)
        missing = x.isin(*fills)
        if dict(df.dtypes)[c] in ("float", "double"):
            missing = missing | F.isnan(x)
        return F.when(~missing, x)

    return df.withColumns({c: clean(c) for c in columns})


def read_sites(spark: SparkSession, path: str) -> DataFrame:
    """(site, lon, lat) from lines ``name, lon, lat``; blanks and # lines are skipped.

    A line with fewer fields, a coordinate that is no number, no line at all and a repeated name
    are errors. A site list is short.
    """
    raw = spark.read.text(path).where(~F.trim("value").startswith("#") & (F.trim("value") != ""))
    part = F.split("value", ",")
    rows = raw.select(
        F.size(part).alias("n"),
        F.trim(F.get(part, F.lit(0))).alias("site"),
        F.expr("try_cast(trim(get(split(value, ','), 1)) as double)").alias("lon"),
        F.expr("try_cast(trim(get(split(value, ','), 2)) as double)").alias("lat"),
    )
    bad = rows.where("n < 3 or lon is null or lat is null").count()
    if bad:
        raise ValueError(f"{bad} site lines without a name and two coordinates")
    names = rows.groupBy("site").count()
    repeated = [r.site for r in names.where("count > 1").orderBy("site").limit(10).collect()]
    if repeated:
        raise ValueError(f"repeated sites: {', '.join(repeated)}")
    if names.isEmpty():
        raise ValueError("no sites")
    return rows.select("site", "lon", "lat")


def read_river(spark: SparkSession, path: str, first: str, last: str, pad: str = "1 month") -> DataFrame:
    """(time, flow) from lines of a 19-character timestamp in one of two formats and a number; the period and a month on each side."""
    line = F.col("value")
    stamp = F.substring(line, 1, 19)
    t = F.coalesce(F.try_to_timestamp(stamp, F.lit("yyyy-MM-dd HH:mm:ss")), F.try_to_timestamp(stamp, F.lit("dd/MM/yyyy HH:mm:ss")))
    rows = spark.read.text(path).select(t.alias("time"), F.expr("try_cast(trim(substring(value, 20)) as double)").alias("flow"))
    ends = (F.lit(first).cast("timestamp") - F.expr(f"interval {pad}"), F.lit(last).cast("timestamp") + F.expr(f"interval {pad}"))
    return rows.where(F.col("time").between(*ends))


def read_scatter(spark: SparkSession, path: str, sep: str = ",") -> DataFrame:
    return spark.read.csv(path, schema="x double, y double, z double", sep=sep)


def write_products(df: DataFrame, path: str, time: str = "day", period: str = "month") -> None:
    """Partitions by month or year, of which only those present are overwritten, or one whole (``full``)."""
    parts = {"month": {"year": F.year(time), "month": F.month(time)}, "year": {"year": F.year(time)}, "full": {}}
    if period not in parts:
        raise ValueError(f"unknown period {period!r}: month, year or full")
    if not parts[period]:
        df.write.mode("overwrite").parquet(path)
        return
    # rows of a partition meet, so that it is a few files of a good size and not one for each task
    whole = df.withColumns(parts[period]).hint("rebalance", *map(F.col, parts[period]))
    whole.write.mode("overwrite").partitionBy(*parts[period]).option("partitionOverwriteMode", "dynamic").parquet(path)


def append_columns(base: DataFrame, added: DataFrame, keys: list[str]) -> DataFrame:
    """A product with further variables: both must have the same keys; variables that exist are replaced."""
    a, b = base.select(*keys), added.select(*keys)
    if not (a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()):
        raise ValueError("the axes differ")
    new = [c for c in added.columns if c not in keys]
    return base.drop(*new).join(added, keys)


def with_metadata(df: DataFrame, attributes: dict[str, dict[str, str]]) -> DataFrame:
    """Attributes (long_name, units, standard_name) as column metadata."""
    return df.select(*[F.col(c).alias(c, metadata=attributes[c]) if c in attributes else F.col(c) for c in df.columns])


def provenance(df: DataFrame, history: str, line: str) -> DataFrame:
    """One row: the columns, and the history grown by a line."""
    return df.sparkSession.createDataFrame([(",".join(df.columns), f"{history}\n{line}".strip())], "columns string, history string")
