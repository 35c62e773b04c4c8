"""Model against observations, seasonal means, worst events, rankings and limits."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def paired_statistics(pairs: DataFrame, keys: list[str], model: str = "model", obs: str = "obs") -> DataFrame:
    """Per key: n, corr, centred rmse, mean/min/max of both, and mae over the pairs with both values; all but n missing below two pairs."""
    m, o = F.col(model).cast("double"), F.col(obs).cast("double")
    both = pairs.where(m.isNotNull() & o.isNotNull())
    enough = F.count(F.lit(1)) >= 2
    some = lambda c: F.when(enough, c)
    return both.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"),
        # a constant series has no correlation; the built-in one divides by zero there
        some(F.try_divide(F.covar_pop(m, o), F.stddev_pop(m) * F.stddev_pop(o))).alias("corr"),
        some(F.sqrt(F.var_pop(m - o))).alias("rmse"),
        *[some(f(c)).alias(f"{name}_{stat}") for c, name in ((m, "model"), (o, "obs")) for f, stat in ((F.avg, "mean"), (F.min, "min"), (F.max, "max"))],
        some(F.avg(F.abs(m - o))).alias("mae"),
    )


def pair(model: DataFrame, obs: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of both on their keys, and the model's rows without observations; a model without any value is an error."""
    if model.where("model is not null").isEmpty():
        raise ValueError("the model has no values at these sites")
    return model.join(obs, keys, "left")


def seasonal_means(df: DataFrame, keys: list[str], time: str, value: str) -> DataFrame:
    """(keys, season, value): means of JFM, AMJ, JAS and OND."""
    names = F.element_at(F.array(*map(F.lit, ("JFM", "AMJ", "JAS", "OND"))), F.quarter(time))
    return df.groupBy(*keys, names.alias("season")).agg(F.avg(value).alias(value))


def seasonal_speed(df: DataFrame, keys: list[str], time: str, u: str, v: str) -> DataFrame:
    return seasonal_means(df.withColumn("speed", F.hypot(u, v)), keys, time, "speed")


def worst_event(df: DataFrame, keys: list[str], category: str = "category") -> DataFrame:
    """(keys, event, level): the highest hot or cold category, hot if equal, ``None`` and 0 without events."""
    hot, cold = F.max(F.greatest(F.col(category), F.lit(0))), F.max(F.greatest(-F.col(category), F.lit(0)))
    return df.groupBy(*keys).agg(hot.alias("__h"), cold.alias("__c")).select(
        *keys,
        F.when((F.col("__h") == 0) & (F.col("__c") == 0), "None").when(F.col("__h") >= F.col("__c"), "MHW").otherwise("MCS").alias("event"),
        F.greatest("__h", "__c").cast("int").alias("level"),
    )


def colour_limits(df: DataFrame, value: str, symmetric: bool = False) -> DataFrame:
    """(low, high) at the 1st and 99th percentiles, or the 99th of |x| on both sides, rounded to two significant figures."""
    def two(c):
        scale = F.pow(F.lit(10.0), F.floor(F.log10(F.abs(c))) - 1)
        return F.when(c == 0, 0.0).otherwise(F.round(c / scale) * scale)

    x = F.abs(F.col(value)) if symmetric else F.col(value)
    # of a sketch, so that no task holds all values; its ranks are right to a millionth
    got = df.agg(F.percentile_approx(x, F.lit(0.01), 1_000_000).alias("a"), F.percentile_approx(x, F.lit(0.99), 1_000_000).alias("b"))
    return got.select((-two(F.col("b")) if symmetric else two(F.col("a"))).alias("low"), two(F.col("b")).alias("high"))


def ranked(df: DataFrame, within: list[str], order: list, k: int) -> DataFrame:
    """The strongest k rows of each group; ``order`` breaks ties."""
    w = Window.partitionBy(*within).orderBy(*order)
    return df.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def incomplete_files(df: DataFrame, columns: list[str], most: int = 10) -> None:
    """Raises, naming up to ``most`` files, if a file has no value at all of one of the columns."""
    counts = df.groupBy(F.input_file_name().alias("file")).agg(*[F.count(c).alias(c) for c in columns])
    lacking = counts.where(F.least(*columns) == 0 if len(columns) > 1 else F.col(columns[0]) == 0)
    bad = [r.file for r in lacking.select("file").orderBy("file").limit(most).collect()]
    if bad:
        raise ValueError(f"files without a needed variable: {', '.join(bad)}")


def coverage(df: DataFrame, lon: str, lat: str, time: str) -> DataFrame:
    return df.agg(*[f(c).alias(f"{c}_{n}") for c in (lon, lat, time) for f, n in ((F.min, "min"), (F.max, "max"))])
