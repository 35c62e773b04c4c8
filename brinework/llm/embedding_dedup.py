"""Embedding near-duplicates: spherical k-means cells and blocked cosine products.

Links are exact. Vectors are compared only where labels (and lengths) are equal. k-means on a
bounded sample gives unit centroids; each vector lives in the cell of its nearest centroid and
visits every later cell whose half-space comes within the angle of the threshold: a vector y
that is nearest to c' has y.(c'-c) >= 0, and no such y is within the angle t of x once
x.(c-c') > |c-c'| sin t. So each linked pair meets in one cell, the later of the two homes.
Cells with more than ``block_rows`` rows are compared block by block, each pair of blocks a task.
Exact copies are folded first and counted by weight. A row then carries a 128-bit hash of its vector
to its result instead of the vector (two vectors share one with probability 2^-128).
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brinework.llm.common import checkpoint, components, pmod_hash, split_join

THRESHOLD = 0.98
#: k-means is fitted on at most this many vectors, those with the smallest hashes.
MAX_SAMPLE = 20_000
#: Centroids: one for each CELL_ROWS vectors of the largest label, at most MAX_CELLS (every task holds them).
CELL_ROWS, MAX_CELLS = 1024, 4096
BLOCK_ROWS = 2048
#: Vectors that are assigned at once.
ASSIGN_ROWS = 1000


def spherical_kmeans(x: np.ndarray, k: int, rounds: int = 10, seed: int = 0) -> np.ndarray:
    """Unit centroids of unit rows; an empty cell takes the row that is farthest from its centroid."""
    rng = np.random.default_rng(seed)
    centres = x[rng.choice(len(x), size=min(k, len(x)), replace=False)]
    for _ in range(rounds):
        near = x @ centres.T
        home, best = near.argmax(axis=1), near.max(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, home, x)
        for c in np.flatnonzero(np.linalg.norm(sums, axis=1) < 1e-9):
            sums[c] = x[best.argmin()]
            best[best.argmin()] = 2
        centres = sums / np.linalg.norm(sums, axis=1, keepdims=True)
    return np.unique(centres, axis=0)


def _unit(column: pa.Array, dim: int) -> np.ndarray:
    x = np.asarray(column.flatten(), np.float64).reshape(-1, dim)
    x = x / np.abs(x).max(axis=1, keepdims=True)  # so that squares neither vanish nor overflow
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def fit_cells(vectors: DataFrame, max_sample: int = MAX_SAMPLE) -> dict[int, np.ndarray]:
    """Centroids for each vector length that a bounded sample of a table (node, label, dim, vector) holds.

    Lengths outside of the sample have one cell. Repeated vectors count each; an empty table gives
    no centroids; null labels and vectors are not expected.
    """
    sample = vectors.orderBy(F.xxhash64("vector"), "node").limit(max_sample).select("dim", "vector").toArrow()
    dims = sample["dim"].to_numpy()
    if not len(dims):
        return {}
    asked = vectors.sparkSession.createDataFrame([(int(d),) for d in np.unique(dims)], "dim int")
    largest = vectors.join(F.broadcast(asked), "dim").groupBy("dim", "label").count().groupBy("dim").agg(F.max("count").alias("rows")).collect()
    cells = {}
    for r in sorted(largest):
        own = sample.filter(pa.array(dims == r.dim))["vector"].combine_chunks()
        cells[r.dim] = spherical_kmeans(_unit(own, r.dim), min(MAX_CELLS, math.ceil(r.rows / CELL_ROWS), len(own)))
    return cells


def _assign(batches, cells: dict[int, np.ndarray], angle: float):
    """(node, label, dim, cell, home, weight, vector) for the home cell and each later cell that a link could reach."""
    reach: dict[int, np.ndarray] = {}  # by two centroids: how much nearer the home may be
    for whole in batches:
        for at in range(0, whole.num_rows, ASSIGN_ROWS):
            batch = whole.slice(at, ASSIGN_ROWS)
            dims = batch.column("dim").to_numpy()
            for dim in np.unique(dims).tolist():
                part = batch.filter(pa.array(dims == dim))
                x = _unit(part.column("vector"), dim)
                own = cells.get(dim, np.eye(1, dim))
                if dim not in reach:
                    reach = {dim: np.sqrt(np.maximum(2 - 2 * own @ own.T, 0)) * math.sin(angle) + 1e-9}
                near = x @ own.T
                home = near.argmax(axis=1)
                visit = near[np.arange(len(x)), home][:, None] - near <= reach[dim][home]
                visit &= np.arange(len(own))[None] >= home[:, None]
                row, cell = np.nonzero(visit)
                taken = part.take(pa.array(row))
                yield pa.RecordBatch.from_arrays(
                    [taken.column(c) for c in ("node", "label", "dim", "weight", "vector")]
                    + [pa.array(cell.astype(np.int32)), pa.array(cell == home[row])],
                    names=["node", "label", "dim", "weight", "vector", "cell", "home"],
                )


def _compare(group: pa.Table, threshold: float) -> pa.Table:
    """Of one pair of blocks: (node, links) sums and a spanning forest (node, other) with no links counted."""
    dim = group["dim"][0].as_py()
    node, weight, home, sub = (group[c].to_numpy() for c in ("node", "weight", "home", "sub"))
    x = _unit(group["vector"].combine_chunks(), dim)
    lo, hi = group["lo"][0].as_py(), group["hi"][0].as_py()
    a = np.flatnonzero(sub == lo)
    b = a if lo == hi else np.flatnonzero(sub == hi)
    near = x[a] @ x[b].T >= threshold
    near &= home[a][:, None] | home[b][None]
    if lo == hi:
        np.fill_diagonal(near, False)
    count = np.zeros(len(node), np.int64)
    count[a] += near @ weight[b]
    if lo != hi:
        count[b] += near.T @ weight[a]
    label = np.arange(len(node))
    for i in np.flatnonzero(near.any(axis=1)):
        roots = np.unique(np.append(label[b[near[i]]], label[a[i]]))
        if len(roots) > 1:
            label[np.isin(label, roots)] = roots[0]
    linked, moved = np.flatnonzero(count), np.flatnonzero(label != np.arange(len(node)))
    return pa.table(
        {
            "node": np.concatenate([node[linked], node[moved]]),
            "other": pa.array(np.concatenate([np.zeros(len(linked), np.int64), node[label[moved]]]), mask=np.arange(len(linked) + len(moved)) < len(linked)),
            "links": np.concatenate([count[linked], np.zeros(len(moved), np.int64)]),
        }
    )


def near_duplicates(
    vectors: DataFrame, id_col: str = "vec_id", vector: str = "embedding", label: str = "label", threshold: float = THRESHOLD
) -> DataFrame:
    """One row per vector: (id, n_links, component_id, kept).

    Vectors that are null, empty, zero or hold a null or non-finite component, and vectors with a
    null label, link with nothing and are kept. n_links counts the other rows that are linked
    directly, exact copies included; component_id is the smallest id that links reach. Vectors of
    different lengths never link. Repeated rows each count. Other columns are not read.
    """
    v = F.col("vector")
    rows = vectors.select(F.col(id_col).alias("id"), F.col(vector).alias("vector"), F.col(label).alias("label"))
    sound = (
        F.col("label").isNotNull()
        & v.isNotNull()
        & F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
        & F.exists(v, lambda c: c != 0)
    )
    rows = rows.withColumn("vector", F.when(F.coalesce(sound, F.lit(False)), v))
    hashes = ["hash_a", "hash_b"]
    rows = rows.select("*", F.when(v.isNotNull(), F.xxhash64(v)).alias("hash_a"), F.when(v.isNotNull(), F.xxhash64(F.lit(1), v)).alias("hash_b"))
    distinct = checkpoint(
        rows.where(v.isNotNull())
        .groupBy("label", *hashes, "vector")
        .agg(F.min("id").alias("least_id"), F.count(F.lit(1)).alias("weight"))
        .withColumn("dim", F.size("vector"))
        .withColumn("node", F.monotonically_increasing_id())
    )
    cells = fit_cells(distinct)
    element = rows.schema["vector"].dataType.elementType.simpleString()
    kind = rows.schema["label"].dataType.simpleString()
    placed = distinct.select("node", "label", "dim", "weight", "vector").mapInArrow(
        lambda it: _assign(it, cells, math.acos(threshold)),
        f"node bigint, label {kind}, dim int, weight bigint, vector array<{element}>, cell int, home boolean",
    )
    key = ["label", "dim", "cell"]
    size = placed.groupBy(*key).agg(F.ceil(F.count(F.lit(1)) / BLOCK_ROWS).cast("int").alias("blocks"))
    tasks = (
        placed.join(size, key)
        .withColumn("sub", pmod_hash(F.col("blocks"), "node").cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .withColumn("lo", F.least("sub", "other"))
        .withColumn("hi", F.greatest("sub", "other"))
        .drop("other", "blocks")
    )
    found = checkpoint(
        tasks.groupBy(*key, "lo", "hi").applyInArrow(
            lambda t: _compare(t, threshold), "node bigint, other bigint, links bigint"
        )
    )
    count = found.groupBy("node").agg(F.sum("links").alias("links"))
    joined = components(found.where("other is not null"), "node", "other").withColumnRenamed("node", "member")
    named = checkpoint(
        distinct.join(count, "node", "left")
        .join(joined, distinct.node == joined.member, "left")
        .select("label", *hashes, "least_id", "weight", "links", F.coalesce("component", "node").alias("component"))
    )
    least = named.groupBy("component").agg(F.min("least_id").alias("first_id"))
    named = split_join(named, least, "component").select(
        "label", *hashes, "first_id", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links")
    )
    component = F.coalesce("first_id", "id")  # without a sound vector there is no hash and no first one
    return rows.drop("vector").join(named, ["label", *hashes], "left").select(
        F.col("id").alias(id_col),
        F.coalesce("n_links", F.lit(0).cast("bigint")).alias("n_links"),
        component.alias("component_id"),
        F.col("id").eqNullSafe(component).alias("kept"),
    )
