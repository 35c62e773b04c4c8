"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

import re
import tempfile
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder of reliable checkpoints that driver and executors share: ``spark.checkpoint.dir``.

    A session that names none gets a temporary folder if its executors are on this machine (a
    local master, as in tests), and an error elsewhere.
    """
    sc = spark.sparkContext
    if not sc.getCheckpointDir():
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder and not re.match(r"local(\[|$)", sc.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        sc.setCheckpointDir(folder or tempfile.mkdtemp(prefix="spark-checkpoint-", dir="/tmp"))
    return sc.getCheckpointDir()


def free_names(df: DataFrame, *wanted: str) -> list[str]:
    """Column names like the wanted ones that the table does not have, upper or lower case."""
    taken = {c.lower() for c in df.columns}
    prefix = "__"
    while any(c.startswith(prefix) for c in taken):
        prefix += "_"
    return [prefix + w for w in wanted]


def checkpoint(df: DataFrame) -> DataFrame:
    """Cuts lineage through the shared checkpoint folder, which survives lost executors."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


def fingerprint_of(df: DataFrame, *cols: str) -> tuple:
    """Row count and order-free hash of a table; equal pairs mean an unchanged table."""
    row = df.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64(*cols)).alias("h")).first()
    return row.n, row.h


def split_join(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """An inner equi-join whose sides have exchanges of their own, so that adaptive execution can split a hot key.

    An aggregate by the same key would share its exchange with the join, which then cannot be
    split; a hash of the key as a second one keeps them apart.
    """
    (mark,) = free_names(left, "mark")
    return left.withColumn(mark, F.xxhash64(key)).join(right.withColumn(mark, F.xxhash64(key)), [key, mark]).drop(mark)


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Connected components of an edge table by alternating large-star and small-star rounds.

    Every round needs only minima per node and equi-joins, so a node with very many neighbours
    is combined on the map side and its join partition can be split. Returns
    (node, component): each node that has an edge, with the smallest node that it reaches.
    Nulls, self links and repeated edges are ignored.
    """
    stars = checkpoint(
        edges.where(F.col(a) != F.col(b))
        .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
        .distinct()
    )
    before = None
    while (now := fingerprint_of(stars, "u", "v")) != before:
        before = now
        both = stars.unionByName(stars.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
        large = (
            split_join(both.where("v > u"), low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        )
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = split_join(large, low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        stars = checkpoint(small.unionByName(low.withColumnRenamed("m", "v")).distinct())
    return stars.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        stars.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )


def pmod_hash(n: Column | int, *cols: str | Column) -> Column:
    return F.pmod(F.xxhash64(*cols), F.lit(n) if isinstance(n, int) else n)


def released(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The same function over batches, giving Arrow's unused memory back after each of them: a worker lives on between tasks."""

    def batches(incoming: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in run(incoming):
            yield batch
            del batch
            pa.default_memory_pool().release_unused()

    return batches
