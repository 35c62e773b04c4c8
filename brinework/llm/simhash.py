"""SimHash near-duplicates: fingerprints, shard BK-trees and components.

Fingerprints that differ in at most ``radius`` bits are links. The 64 bits are cut into
``radius + agree`` blocks; two linked fingerprints agree on at least ``agree`` whole blocks, so
every distinct fingerprint is sent to one shard for each choice of ``agree`` blocks, and more
fingerprints call for wider keys. A shard holds a BK-tree (children keyed by their integer
Hamming distance to the parent), built in the task that asks it, and a search follows only the
edges within the radius. A shard with more than ``block_rows`` fingerprints is cut into blocks,
and each pair of blocks is a task of its own. Tasks emit a spanning forest, never the pairs of a
group.

``keep_one`` can ask for a similarity instead: links are then the pairs whose sets of shingles
have at least that Jaccard index. Sets that agree on a band of shingle minima meet in a shard;
its BK-tree is searched with a wide radius, and every hit is checked on the sets themselves.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brinework.llm.common import checkpoint, components, free_names, pmod_hash, released, split_join

RADIUS = 4
SHINGLE = 4
SEED = 42
#: Above this many fingerprints a shard's tree is cut into blocks.
BLOCK_ROWS = 2048
#: Aimed-at rows of a task; the number of tasks follows the input.
TASK_ROWS = 40_000
#: Sets of Jaccard index s miss each other with probability (1 - s^BAND_ROWS)^BANDS: 3e-6 at 0.8.
BANDS = 24
BAND_ROWS = 4
#: Sets of Jaccard index 0.8 differ in 9.7 of 64 bits on average, in more than 24 once in a million.
WIDE_RADIUS = 24
#: Above this many shingles a shard of sets is cut into blocks; also the aimed-at shingles of a task.
BLOCK_SHINGLES = 1_000_000


def _digests(text: str | None, shingle: int, seed: int) -> Iterator[np.ndarray]:
    """Hashes of the word shingles of a whole text, in parts; a text of fewer words is one shingle."""
    words = (text or "").encode().lower().split()
    n = len(words)
    if not n:
        return
    joined = b" ".join(words)
    digest = xxhash.xxh64_intdigest
    if n <= shingle:
        yield np.array([digest(joined, seed)], np.uint64)
        return
    lens = np.fromiter(map(len, words), np.int64, n)
    ends = np.cumsum(lens + 1) - 1
    starts = ends - lens
    total = n - shingle + 1
    for at in range(0, total, 1 << 16):
        to = min(total, at + (1 << 16))
        yield np.fromiter(
            (digest(joined[i:j], seed) for i, j in zip(starts[at:to].tolist(), ends[at + shingle - 1 : to + shingle - 1].tolist())),
            np.uint64,
            to - at,
        )


def _majority(parts: Iterator[np.ndarray]) -> int:
    """The bits that more than half of the hashes have; zero without hashes."""
    ones, total = np.zeros(64, np.int64), 0
    for hashes in parts:
        total += len(hashes)
        bits = np.unpackbits(hashes.view(np.uint8)).reshape(-1, 64)
        for k in range(0, len(bits), 255):  # so that a column sum fits in a byte
            ones += np.add.reduce(bits[k : k + 255], axis=0, dtype=np.uint8)
    return int(np.packbits(2 * ones > total).view(np.uint64)[0])


def fingerprint(text: str | None, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """Unsigned 64-bit SimHash of the word shingles of a whole text; zero without words."""
    return _majority(_digests(text, shingle, seed))


def shingle_set(text: str | None, shingle: int, seed: int = SEED) -> np.ndarray:
    """The distinct shingle hashes of a whole text, sorted."""
    return np.unique(np.concatenate([np.empty(0, np.uint64), *_digests(text, shingle, seed)]))


def set_mark(hashes: np.ndarray) -> int:
    """One hash of a set of shingles."""
    return xxhash.xxh64_intdigest(hashes.tobytes(), SEED)


def band_keys(hashes: np.ndarray) -> np.ndarray:
    """A key for each band of minima of a set under BANDS x BAND_ROWS random orders; none for an empty set."""
    if not len(hashes):
        return np.empty(0, np.uint64)
    rng = np.random.default_rng(SEED)
    k = BANDS * BAND_ROWS
    odd, mask = rng.integers(0, 1 << 63, (2, k), np.uint64) * np.uint64(2) + np.uint64(1)
    low = np.full(k, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(hashes), 2048):
        np.minimum(low, ((hashes[at : at + 2048, None] ^ mask) * odd).min(axis=0), out=low)
    rows = low.reshape(BANDS, BAND_ROWS)
    return np.array([xxhash.xxh64_intdigest(r.tobytes(), b) for b, r in enumerate(rows)], np.uint64)


def _with_fingerprints(batches: Iterator[pa.RecordBatch], text: str, name: str, keep: bool, shingle: int, whole_set: bool) -> Iterator[pa.RecordBatch]:
    mark = (lambda t: set_mark(shingle_set(t, shingle))) if whole_set else (lambda t: fingerprint(t, shingle))
    for batch in batches:
        at = batch.schema.get_field_index(text)
        marks = np.fromiter((mark(x.as_py()) for x in batch.column(at)), np.uint64, batch.num_rows)
        rest = [(f.name, c) for f, c in zip(batch.schema, batch.columns) if keep or f.name != text]
        yield pa.RecordBatch.from_arrays(
            [c for _, c in rest] + [pa.array(marks.view(np.int64))], names=[n for n, _ in rest] + [name]
        )


def fingerprints(docs: DataFrame, text: str = "text", name: str = "fingerprint", keep_text: bool = False, shingle: int = SHINGLE, whole_set: bool = False) -> DataFrame:
    """Adds the fingerprint (or the hash of the set of shingles) as a signed long; the text goes unless it is kept.

    A null text counts as empty: fingerprint zero, the hash of the empty set. Every row keeps its
    place and its other columns; ``name`` must be free (``free_names`` gives such a name).
    """
    rest = docs if keep_text else docs.drop(text)
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in rest.schema), f"`{name}` bigint"])
    return docs.mapInArrow(released(lambda it: _with_fingerprints(it, text, name, keep_text, shingle, whole_set)), schema)


def agreeing_blocks(fingerprints: int, radius: int = RADIUS) -> int:
    """How many blocks a key holds: the copies of so many fingerprints and the pairs that meet by chance are fewest."""

    def work(agree: int) -> float:
        bits = 64 * agree // (radius + agree)
        return comb(radius + agree, agree) * (1 + fingerprints / 2**bits)

    return min(range(1, radius + 3), key=work)


def block_masks(radius: int = RADIUS, agree: int = 2) -> list[int]:
    """One mask for each choice of ``agree`` of the ``radius + agree`` blocks of 64 bits."""
    n = radius + agree
    edges = [round(64 * i / n) for i in range(n + 1)]
    blocks = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(edges, edges[1:])]
    return [sum(chosen) for chosen in combinations(blocks, agree)]


class BKTree:
    """Burkhard-Keller tree of 64-bit words under Hamming distance."""

    def __init__(self, values: Iterator[int] | list[int]):
        self.values: list[int] = []
        self.children: list[dict[int, int]] = []
        for v in values:
            self.add(v)

    def add(self, value: int) -> None:
        at, new = 0, len(self.values)
        while new:
            d = (value ^ self.values[at]).bit_count()
            if (below := self.children[at].get(d)) is None:
                self.children[at][d] = new
                break
            at = below
        self.values.append(value)
        self.children.append({})

    def within(self, queries: np.ndarray, radius: int) -> Iterator[tuple[int, np.ndarray]]:
        """For each node that a query reaches within the radius: the node and those queries."""
        todo = [(0, np.arange(len(queries)))] if self.values else []
        while todo:
            node, who = todo.pop()
            d = np.bitwise_count(queries[who] ^ np.uint64(self.values[node]))
            hit = who[d <= radius]
            if len(hit):
                yield node, hit
            d = d.astype(np.int16)
            for edge, child in self.children[node].items():
                follow = who[np.abs(d - edge) <= radius]
                if len(follow):
                    todo.append((child, follow))


def forest(tree: np.ndarray, queries: np.ndarray | None, radius: int = RADIUS) -> list[tuple[int, int]]:
    """Edges that join what links within the radius connect: between the values of a tree and the queries, or within the tree."""
    n = len(tree)
    everything = tree if queries is None else np.concatenate([tree, queries])
    shift = 0 if queries is None else n
    label = np.arange(len(everything))
    for node, hit in BKTree(tree.tolist()).within(tree if queries is None else queries, radius):
        roots = np.unique(np.append(label[hit + shift], label[node]))
        if len(roots) > 1:
            label[np.isin(label, roots)] = roots[0]
    moved = np.flatnonzero(label != np.arange(len(everything)))
    return list(zip(everything[moved].tolist(), everything[label[moved]].tolist()))


def _search(group: pa.Table, masks: list[int], radius: int) -> pa.Table:
    fp = group["fp"].to_numpy().view(np.uint64)
    combo, lo, hi, sub = (group[c].to_numpy() for c in ("combo", "lo", "hi", "sub"))
    key = fp & np.array(masks, np.uint64)[combo]
    order = np.lexsort((fp, hi, lo, key, combo))
    fp, combo, key, lo, hi, sub = (x[order] for x in (fp, combo, key, lo, hi, sub))
    new = np.ones(len(fp), bool)
    new[1:] = (combo[1:] != combo[:-1]) | (key[1:] != key[:-1]) | (lo[1:] != lo[:-1]) | (hi[1:] != hi[:-1])
    starts = np.append(np.flatnonzero(new), len(fp))
    found: list[tuple[int, int]] = []
    for at in np.flatnonzero(np.diff(starts) > 1):
        a, b = starts[at], starts[at + 1]
        if lo[a] == hi[a]:
            found += forest(fp[a:b], None, radius)
        else:
            first = sub[a:b] == lo[a]
            found += forest(fp[a:b][first], fp[a:b][~first], radius)
    pairs = np.array(found, np.uint64).reshape(-1, 2).view(np.int64)
    return pa.table({"a": pairs[:, 0], "b": pairs[:, 1]})


def links(distinct: DataFrame, radius: int = RADIUS, block_rows: int = BLOCK_ROWS, agree: int | None = None) -> DataFrame:
    """A spanning set (a, b) of the links between distinct fingerprints of a column ``fp``."""
    count = distinct.count()
    masks = block_masks(radius, agree or agreeing_blocks(count, radius))
    signed = [m - (1 << 64) if m >> 63 else m for m in masks]
    keyed = distinct.select(
        "fp", F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(m).cast("long")) for m in signed])).alias("combo", "key")
    )
    crowded = checkpoint(
        keyed.groupBy("combo", "key")
        .agg(F.count(F.lit(1)).alias("rows"))
        .where(F.col("rows") > block_rows)
        .select("combo", "key", "rows", F.ceil(F.col("rows") / block_rows).cast("int").alias("blocks"))
    )
    # every block of a crowded key is copied to each of its pairs of blocks
    copies = crowded.agg(F.sum(F.col("rows") * (F.col("blocks") - 1)).alias("n")).first().n or 0
    n = max(1, (count * len(masks) + copies) // TASK_ROWS)
    placed = (
        keyed.join(crowded.drop("rows"), ["combo", "key"], "left")
        .withColumn("blocks", F.coalesce("blocks", F.lit(1)))
        .withColumn("sub", pmod_hash(F.col("blocks"), "fp").cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select(
            "fp", "combo", "key", "sub", F.least("sub", "other").alias("lo"), F.greatest("sub", "other").alias("hi")
        )
        .withColumn("shard", pmod_hash(n, "combo", "key", "lo", "hi"))
        .drop("key")
    )
    return placed.groupBy("shard").applyInArrow(lambda t: _search(t, masks, radius), "a bigint, b bigint")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text: str = "text", radius: int = RADIUS) -> DataFrame:
    """One row per document: (id, fingerprint as 16 hex digits, component_id).

    A null text counts as empty and has fingerprint zero, which links like any other. Repeated
    rows each keep their row. component_id is the smallest id that links reach; null ids never
    become one unless a component has no other. Other columns of the input are not read.
    """
    marked = checkpoint(fingerprints(docs.select(F.col(id_col).alias("id"), F.col(text).alias("text"))))
    named = _classes(marked, radius)
    return marked.join(named, marked.fingerprint == named.fp, "left").select(
        F.col("id").alias(id_col),
        F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"),
        F.col("component_id"),
    )


def _classes(marked: DataFrame, radius: int) -> DataFrame:
    """(fp, component_id) for each distinct fingerprint of a table (id, fingerprint)."""
    distinct = checkpoint(marked.groupBy(F.col("fingerprint").alias("fp")).agg(F.min("id").alias("least_id")))
    return _named(distinct, links(distinct, radius))


def _members(distinct: DataFrame, edges: DataFrame) -> DataFrame:
    """(fp, least_id, component) of each row of (fp, least_id); a component is named by one of its fingerprints."""
    joined = components(edges)
    return checkpoint(
        distinct.join(joined, distinct.fp == joined.node, "left").select("fp", "least_id", F.coalesce("component", "fp").alias("component"))
    )


def _named(distinct: DataFrame, edges: DataFrame) -> DataFrame:
    """(fp, component_id): the smallest id that edges reach from each row of (fp, least_id)."""
    members = _members(distinct, edges)
    least = members.groupBy("component").agg(F.min("least_id").alias("component_id"))
    return split_join(members, least, "component").select("fp", "component_id")


def _sketches(batches: Iterator[pa.RecordBatch], shingle: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sets = [shingle_set(x.as_py(), shingle) for x in batch.column("text")]
        marks = np.fromiter(map(set_mark, sets), np.uint64, len(sets))
        keys = [band_keys(s).view(np.int64) for s in sets]
        yield pa.RecordBatch.from_arrays(
            [batch.column("id"), pa.array(marks.view(np.int64)), pa.array([len(s) for s in sets], pa.int32()), pa.array(keys, pa.list_(pa.int64()))],
            names=["id", "fingerprint", "size", "keys"],
        )


def _sets(batches: Iterator[pa.RecordBatch], shingle: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            part = batch.slice(at, 256)
            sets = [shingle_set(x.as_py(), shingle) for x in part.column("text")]
            right = np.fromiter(map(set_mark, sets), np.uint64, len(sets)).view(np.int64) == part.column("fp").to_numpy()
            sets = [s for s, r in zip(sets, right) if r]  # a repeated id may have other texts
            bits = np.fromiter((_majority([s]) for s in sets), np.uint64, len(sets))
            yield pa.RecordBatch.from_arrays(
                [part.column("fp").filter(pa.array(right)), pa.array(bits.view(np.int64)), pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))],
                names=["fp", "bits", "hashes"],
            )


def similar_forest(bits: np.ndarray, sets: list[np.ndarray], first: int, similarity: float, radius: int) -> list[tuple[int, int]]:
    """Edges (of positions) that join what similar pairs connect: within all sets, or from the ``first`` ones to the others.

    Hits of a BK-tree within the radius are checked on the sets, by the lists of owners of each shingle.
    """
    n, sizes = len(sets), np.array(list(map(len, sets)))
    _, ids = np.unique(np.concatenate(sets), return_inverse=True)
    owners = np.repeat(np.arange(n), sizes)[np.argsort(ids, kind="stable")]
    edges = np.append(0, np.cumsum(np.bincount(ids)))
    starts = np.append(0, np.cumsum(sizes))
    shift = first % n  # all sets: the queries are the tree itself
    label = np.arange(n)
    for node, hit in BKTree(bits[:first].tolist()).within(bits[shift:], radius):
        hit = hit + shift
        hit = hit[label[hit] != label[node]]
        small, large = np.minimum(sizes[hit], sizes[node]), np.maximum(sizes[hit], sizes[node])
        hit = hit[small / large >= similarity]
        if not len(hit):
            continue
        mine = ids[starts[node] : starts[node + 1]]
        common = np.bincount(np.concatenate([owners[edges[t] : edges[t + 1]] for t in mine]), minlength=n)[hit]
        hit = hit[common / (sizes[hit] + sizes[node] - common) >= similarity]
        if len(hit):
            roots = np.unique(np.append(label[hit], label[node]))
            label[np.isin(label, roots)] = roots[0]
    moved = np.flatnonzero(label != np.arange(n))
    return list(zip(moved.tolist(), label[moved].tolist()))


def _search_sets(group: pa.Table, similarity: float, radius: int) -> pa.Table:
    fp, key, lo, hi, sub = (group[c].to_numpy() for c in ("fp", "group", "lo", "hi", "sub"))
    bits = group["bits"].to_numpy().view(np.uint64)
    hashes = group["hashes"].combine_chunks()
    ends, values = hashes.offsets.to_numpy(), hashes.values.to_numpy()
    order = np.lexsort((fp, sub, hi, lo, key))
    new = np.ones(len(order), bool)
    new[1:] = np.any([x[order][1:] != x[order][:-1] for x in (key, lo, hi)], axis=0)
    cuts = np.append(np.flatnonzero(new), len(order))
    found: list[tuple[int, int]] = []
    for a, b in zip(cuts, cuts[1:]):
        at = order[a:b]
        first = int((sub[at] == lo[at[0]]).sum())
        if b - a > 1 and first:
            pairs = similar_forest(bits[at], [values[ends[i] : ends[i + 1]] for i in at], first, similarity, radius)
            found += [(fp[at[i]], fp[at[j]]) for i, j in pairs]
    pairs = np.array(found, np.int64).reshape(-1, 2)
    return pa.table({"a": pairs[:, 0], "b": pairs[:, 1]})


def similar_links(docs: DataFrame, distinct: DataFrame, shingle: int, similarity: float, radius: int = WIDE_RADIUS, block_shingles: int = BLOCK_SHINGLES) -> DataFrame:
    """A spanning set (a, b) of the links between sets of shingles (fp, least_id, size, keys) of documents (id, text).

    Sets that share a band key make up candidate components. Only their members' texts are read
    again, and a set goes to the shard of its component alone. Chains of chance can make a component
    large: the sets of one beyond ``block_shingles`` go to the shards of their band keys instead,
    and a key that is still larger is cut into blocks.
    """
    keyed = distinct.select("fp", F.explode("keys").alias("key"))
    low = keyed.groupBy("key").agg(F.min("fp").alias("low"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    star = split_join(keyed, low, "key").where("fp <> low").select("fp", "low")
    near = checkpoint(components(star, "fp", "low").join(distinct, F.col("node") == F.col("fp")).select("fp", "least_id", "size", "keys", "component"))
    totals = near.groupBy("component").agg(F.sum("size").alias("total"))
    groups = F.when(F.col("total") > block_shingles, F.col("keys")).otherwise(F.array("component"))
    grouped = checkpoint(split_join(near, totals, "component").select("fp", "size", F.explode(groups).alias("group")))
    blocks = checkpoint(
        grouped.groupBy("group")
        .agg(F.sum("size").alias("total"), F.count(F.lit(1)).alias("n"))
        .where("n > 1")
        .select("group", "total", F.ceil(F.col("total") / block_shingles).cast("int").alias("blocks"))
    )
    n = max(1, (blocks.agg(F.sum(F.col("total") * F.col("blocks")).alias("n")).first().n or 0) // block_shingles)
    asked = docs.join(near.select("fp", "least_id"), F.col("id").eqNullSafe(F.col("least_id"))).select("fp", "text")
    sets = asked.mapInArrow(released(lambda it: _sets(it, shingle)), "fp bigint, bits bigint, hashes array<bigint>").dropDuplicates(["fp"])
    placed = (
        split_join(grouped.drop("size"), blocks.drop("total"), "group")
        .withColumn("sub", pmod_hash(F.col("blocks"), "fp").cast("int"))
        .join(sets, "fp")
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select("fp", "bits", "hashes", "group", "sub", F.least("sub", "other").alias("lo"), F.greatest("sub", "other").alias("hi"))
        .withColumn("shard", pmod_hash(n, "group", "lo", "hi"))
    )
    return placed.groupBy("shard").applyInArrow(lambda t: _search_sets(t, similarity, radius), "a bigint, b bigint")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text: str = "text", radius: int | None = None, shingle: int = SHINGLE, similarity: float | None = None) -> DataFrame:
    """The documents without their near copies: of each component the row with the smallest (id, fingerprint).

    Links are fingerprints within the radius or, with ``similarity``, sets of shingles of at least
    that Jaccard index. All columns of the input come back unchanged; exact repeats of the row that
    stays are dropped. A null text counts as empty; empty texts are one group; null ids come last.
    The texts of ids that stand for one row only are not hashed a second time.
    """
    plain = docs.select(F.col(id_col).alias("id"), F.col(text).alias("text"))
    if similarity is None:
        slim = checkpoint(fingerprints(plain, shingle=shingle))
        distinct = checkpoint(slim.groupBy(F.col("fingerprint").alias("fp")).agg(F.min("id").alias("least_id")))
        edges = links(distinct, RADIUS if radius is None else radius)
    else:
        kind = docs.schema[id_col].dataType.simpleString()
        slim = checkpoint(plain.mapInArrow(released(lambda it: _sketches(it, shingle)), f"id {kind}, fingerprint bigint, size int, keys array<bigint>"))
        distinct = checkpoint(slim.groupBy(F.col("fingerprint").alias("fp")).agg(F.min("id").alias("least_id"), F.first("size").alias("size"), F.first("keys").alias("keys")))
        edges = similar_links(plain, distinct, shingle, similarity, WIDE_RADIUS if radius is None else radius)
        distinct = distinct.select("fp", "least_id")
    mine, mark = free_names(docs, "id", "mark")
    stays = checkpoint(
        _members(distinct, edges)
        .groupBy("component")
        .agg(F.min_by(F.struct("least_id", "fp"), F.struct(F.col("least_id").isNull(), "least_id", "fp")).alias("s"))
        .select(F.col("s.least_id").alias(mine), F.col("s.fp").alias(mark))
    )
    repeated = checkpoint(slim.groupBy(F.col("id").alias(mine)).agg(F.count(F.lit(1)).alias("n")).where(F.col(mine).isNull() | (F.col("n") > 1)).select(mine))
    own = docs[f"`{id_col}`"]
    if repeated.isEmpty():
        return docs.join(stays, own == stays[mine], "left_semi")
    once = docs.join(stays.join(repeated, mine, "left_anti"), own == F.col(mine), "left_semi")
    others = fingerprints(docs.join(repeated, own.eqNullSafe(repeated[mine]), "left_semi"), text, mark, True, shingle, similarity is not None)
    first = (
        others.join(stays, others[f"`{id_col}`"].eqNullSafe(stays[mine]) & (others[mark] == stays[mark]), "left_semi")
        .groupBy(F.col(f"`{id_col}`").alias(mine), F.col(mark))
        .agg(F.first(F.struct(*[F.col(f"`{c}`") for c in docs.columns])).alias(mark + "row"))
        .select(mark + "row.*")
    )
    return once.unionByName(first)
