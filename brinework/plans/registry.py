"""Every registered query and its DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return QUERIES["heatwave_year_stats"](spark, sf_dir)


def load() -> None:
    """Fills the registry; the query modules register on import."""
    from brinework.plans import field_queries, formula_queries, grid_queries, job_queries, selection_queries, series_queries, stream_queries  # noqa: F401
