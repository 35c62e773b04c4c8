"""Centroid clustering: k-means on whole numbers, nearest centroids found by Orchard's search.

Every centroid keeps the others sorted by their distance from it. A vector walks the list of its
best centroid so far; a nearer one takes over with its own list from the start; centroids already
measured are marked; the walk ends at an entry strictly farther than twice the vector's distance,
as no later one can be as near. All arithmetic is on integers, so ties are exact.

Vectors never move: each round is one pass that leaves a count and a sum per centroid and task,
and only those (centroids by dimensions, whatever the table's size) are shuffled and reach the
driver, which hands the new centroids to the next pass.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brinework.llm.common import checkpoint, released

DIMENSIONS, SCALE, CENTROIDS, ROUNDS, SEED = 64, 64, 16, 3, "1"
#: Components farther from zero than this count as this, so that four times any distance fits a long.
LARGEST = 1 << 25


def whole_vectors(column: pa.Array, dimensions: int, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the rows that hold a full, finite vector, and their vectors as whole numbers."""
    full = pc.fill_null(pc.equal(pc.list_value_length(column), dimensions), False)
    at = np.flatnonzero(full.to_numpy(zero_copy_only=False))
    x = pc.list_flatten(column.filter(full)).to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dimensions)
    good = np.isfinite(x).all(axis=1)  # a null component is not a number here
    with np.errstate(over="ignore"):
        whole = np.clip(np.floor(scale * x[good]), -LARGEST, LARGEST)
    return at[good], whole.astype(np.int64)


def _squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    gap = a - b
    return np.einsum("ij,ij->i", gap, gap)


class Orchard:
    """Centroids with their sorted neighbour lists."""

    def __init__(self, centroids: np.ndarray):
        self.centroids = centroids
        k = len(centroids)
        self.gaps = np.stack([_squared(centroids, c) for c in centroids])
        ranked = np.argsort(self.gaps, axis=1, kind="stable")
        self.lists = np.stack([r[r != c] for c, r in enumerate(ranked)]).reshape(k, k - 1)

    def nearest(self, x: np.ndarray, block: int = 4096) -> tuple[np.ndarray, np.ndarray, int]:
        """Number and squared distance of each vector's nearest centroid (of equals the smaller number), and how many distances were worked out."""
        parts = [self._nearest(x[i : i + block]) for i in range(0, len(x), block)]
        if not parts:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), 0
        return np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts]), sum(p[2] for p in parts)

    def _nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        n, k = len(x), len(self.centroids)
        best, step = np.zeros(n, np.int64), np.zeros(n, np.int64)
        distance = _squared(x, self.centroids[best])
        marked = np.zeros((n, k), bool)
        marked[:, 0] = True
        measured, active = n, np.arange(n)
        while True:
            active = active[step[active] < k - 1]
            other = self.lists[best[active], step[active]]
            near = self.gaps[best[active], other] <= 4 * distance[active]  # beyond twice the distance: all later ones too
            active, other = active[near], other[near]
            if not len(active):
                return best, distance, measured
            step[active] += 1
            new = ~marked[active, other]
            rows, other = active[new], other[new]
            marked[rows, other] = True
            found = _squared(x[rows], self.centroids[other])
            measured += len(rows)
            takes = (found < distance[rows]) | ((found == distance[rows]) & (other < best[rows]))
            rows = rows[takes]
            best[rows], distance[rows], step[rows] = other[takes], found[takes], 0


def first_centroids(vectors: DataFrame, k: int, seed: str, dimensions: int, scale: int) -> np.ndarray:
    """The vectors with the smallest hashes of their ids; of equal ids the smaller vector."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    kept = vectors.where((F.size("embedding") == dimensions) & finite)
    mark = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    rows = kept.select(mark.alias("mark"), "embedding").orderBy("mark", "embedding").limit(k).collect()  # k rows
    return whole_vectors(pa.array([r.embedding for r in rows], pa.list_(pa.float64())), dimensions, scale)[1]


def moved_centroids(vectors: DataFrame, centroids: np.ndarray, scale: int) -> np.ndarray:
    """Each centroid at the floor of its vectors' mean, worked out exactly; one without vectors stays."""
    k, dimensions = centroids.shape

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        orchard, n, total = Orchard(centroids), np.zeros(k, np.int64), np.zeros((k, dimensions), np.int64)
        for batch in batches:
            _, x = whole_vectors(batch.column("embedding"), dimensions, scale)
            cluster, _, _ = orchard.nearest(x)
            n += np.bincount(cluster, minlength=k)
            for c in np.unique(cluster):
                total[c] += x[cluster == c].sum(axis=0)
        met = np.flatnonzero(n)
        columns = [pa.array(met), pa.array(n[met]), pa.array(list(total[met]), pa.list_(pa.int64()))]
        yield pa.RecordBatch.from_arrays(columns, ["cluster", "n", "total"])

    parts = vectors.select("embedding").mapInArrow(sums, "cluster bigint, n bigint, total array<bigint>")
    exact = [F.sum(F.get("total", F.lit(i)).cast("decimal(38,0)")).alias(f"s{i}") for i in range(dimensions)]
    out = centroids.copy()
    for row in parts.groupBy("cluster").agg(F.sum("n").alias("n"), *exact).collect():  # a row for each centroid
        out[row.cluster] = [int(row[f"s{i}"]) // row.n for i in range(dimensions)]
    return out


def cluster(
    table: DataFrame, k: int = CENTROIDS, rounds: int = ROUNDS, seed: str = SEED, dimensions: int = DIMENSIONS, scale: int = SCALE
) -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256) of every full, finite vector.

    Vectors that are null, of another length, or with a null or non-finite component have no row.
    Repeated rows count and return each; equal distances go to the smaller number; a null id is
    hashed as an empty one; with fewer vectors than ``k`` there are as many centroids as vectors;
    an empty table gives an empty result. Only ``vec_id`` and ``embedding`` are read, so other
    columns may have any name. Components beyond ``LARGEST`` after scaling count as that.
    """
    vectors = table.select("vec_id", F.col("embedding").cast("array<double>").alias("embedding"))
    kind = table.schema["vec_id"].dataType.simpleString()
    centroids = first_centroids(vectors, k, seed, dimensions, scale)
    if not len(centroids):
        names = f"vec_id {kind}, cluster int, distance bigint, cluster_inertia bigint, inertia bigint, centroid_sha256 string"
        return table.sparkSession.createDataFrame([], names)
    for _ in range(rounds):
        centroids = moved_centroids(vectors, centroids, scale)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        orchard = Orchard(centroids)
        for batch in batches:
            at, x = whole_vectors(batch.column("embedding"), dimensions, scale)
            number, distance, _ = orchard.nearest(x)
            columns = [batch.column("vec_id").take(pa.array(at)), pa.array(number, pa.int32()), pa.array(distance)]
            yield pa.RecordBatch.from_arrays(columns, ["vec_id", "cluster", "distance"])

    assigned = checkpoint(vectors.mapInArrow(released(assign), f"vec_id {kind}, cluster int, distance bigint"))
    within = {r.cluster: r.d for r in assigned.groupBy("cluster").agg(F.sum("distance").alias("d")).collect()}  # a row for each centroid
    every = sum(within.values())
    text = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    rows = [(c, d, every, text[c]) for c, d in sorted(within.items())]
    facts = table.sparkSession.createDataFrame(rows, "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string")
    return assigned.join(F.broadcast(facts), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")  # k rows
