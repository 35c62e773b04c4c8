"""SimHash and embedding near-duplicates against brute force."""

import numpy as np
import pytest
import xxhash

from brinework.llm import embedding_dedup, simhash


def classes(n, pairs):
    root = list(range(n))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in pairs:
        a, b = find(i), find(j)
        root[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def plain_fingerprint(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").replace("\t", " ").replace("\n", " ")
    words = [w for w in words.replace("\x0b", " ").replace("\x0c", " ").replace("\r", " ").split(" ") if w]
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_documents(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    texts = sorted((r.doc_id, r.text) for r in docs.collect())
    marks = [plain_fingerprint(t) for _, t in texts]
    root = classes(len(marks), ((i, j) for i in range(len(marks)) for j in range(i) if (marks[i] ^ marks[j]).bit_count() <= 4))
    want = [(d, f"{m:016x}", texts[r][0]) for (d, _), m, r in zip(texts, marks, root)]
    got = sorted((r.doc_id, r.fingerprint, r.component_id) for r in simhash.near_duplicates(docs).collect())
    assert got == want
    assert len({c for _, _, c in want}) < len(want)
    assert sorted(r.doc_id for r in simhash.keep_one(docs).collect()) == sorted({c for _, _, c in want})


@pytest.mark.parametrize("block_rows,agree", [(8, 2), (2048, None), (2048, 1), (2048, 4)])
def test_links_are_whole(spark, block_rows, agree):
    """Chains and dense clusters of fingerprints, with shards cut into small blocks and keys of several widths."""
    rng = np.random.default_rng(3)
    values = set(map(int, rng.integers(0, 1 << 63, 150)))
    for centre in list(values)[:12]:
        v = centre
        for _ in range(25):
            flip = rng.choice(64, size=rng.integers(1, 7), replace=False)
            v = (centre if rng.random() < 0.5 else v) ^ int(sum(1 << int(b) for b in flip))
            values.add(v)
    values = sorted(values)
    root = classes(len(values), ((i, j) for i in range(len(values)) for j in range(i) if (values[i] ^ values[j]).bit_count() <= 4))
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    at = {v: i for i, v in enumerate(signed)}
    table = spark.createDataFrame([(v,) for v in signed], "fp bigint")
    edges = simhash.links(table, block_rows=block_rows, agree=agree).collect()
    assert classes(len(values), ((at[e.a], at[e.b]) for e in edges)) == root


def test_wider_keys_for_more():
    assert [simhash.agreeing_blocks(n) for n in (10**4, 10**6, 10**8, 10**10)] == sorted(simhash.agreeing_blocks(n) for n in (10**4, 10**6, 10**8, 10**10))
    assert simhash.agreeing_blocks(10**10) > simhash.agreeing_blocks(10**4)
    for agree in (1, 2, 3, 4):
        masks = simhash.block_masks(4, agree)
        for flips in ((0, 1, 2, 3), (0, 13, 30, 63), (10, 11, 33, 34)):
            assert any(not sum(1 << f for f in flips) & m for m in masks)


def test_links_come_from_the_tree(monkeypatch):
    """Shards of any size search their tree."""
    assert simhash.forest(np.array([1, 3, 0xFFFF << 40], np.uint64), None) == [(3, 1)]
    monkeypatch.setattr(simhash.BKTree, "within", lambda *a: iter(()))
    assert simhash.forest(np.array([1, 3], np.uint64), None) == []


@pytest.mark.parametrize("similarity", [None, 0.8])
def test_keep_one_with_odd_ids(spark, similarity):
    """Ids that are null or stand for several texts, and columns named like the operator's own."""
    text = {c: " ".join(f"{c}{i}" for i in range(40)) for c in "abcd"}
    rows = [(1, text["a"]), (2, text["a"]), (2, text["b"]), (2, text["b"]), (3, text["b"]), (None, text["c"]), (None, text["c"]), (None, text["a"]), (4, text["d"])]
    docs = spark.createDataFrame([(i, t, 1, 2, 3, 4, 5) for i, t in rows], "doc_id bigint, text string, __fingerprint int, __row int, __id int, __mark int, fp int")
    out = simhash.keep_one(docs, shingle=5, similarity=similarity)
    assert out.columns == docs.columns
    assert sorted((str(r.doc_id), r.text) for r in out.collect()) == sorted([("1", text["a"]), ("2", text["b"]), ("None", text["c"]), ("4", text["d"])])


def test_tree_finds_all():
    rng = np.random.default_rng(5)
    values = [int(x) & 0xFFFF for x in rng.integers(0, 1 << 16, 300)]
    queries = np.array([int(x) for x in rng.integers(0, 1 << 16, 50)], np.uint64)
    tree = simhash.BKTree(values)
    got = {(n, int(q)) for n, hit in tree.within(queries, 3) for q in hit}
    assert got == {(n, q) for n, v in enumerate(values) for q in range(50) if (v ^ int(queries[q])).bit_count() <= 3}


@pytest.mark.parametrize("shape", [(512, 1024, 2048), (16, 64, 32)])
def test_vectors(spark, monkeypatch, shape):
    """Many small cells and blocks, a dense cluster at the threshold, exact copies."""
    monkeypatch.setattr(embedding_dedup, "CELL_ROWS", shape[0])
    monkeypatch.setattr(embedding_dedup, "MAX_CELLS", shape[1])
    monkeypatch.setattr(embedding_dedup, "BLOCK_ROWS", shape[2])
    rng = np.random.default_rng(1)
    x = rng.normal(size=(260, 12))
    near = x[rng.integers(0, 20, 120)] + rng.normal(size=(120, 12)) * 0.16
    x = np.concatenate([x, near, x[:30]]).astype(np.float32).astype(float)
    label = rng.integers(0, 3, len(x))
    label[-30:] = label[:30]
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    linked = (unit @ unit.T >= 0.98) & (label[:, None] == label[None])
    np.fill_diagonal(linked, False)
    root = classes(len(x), zip(*np.nonzero(linked)))
    table = spark.createDataFrame([(i, v.tolist(), int(k)) for i, (v, k) in enumerate(zip(x, label))], "vec_id bigint, embedding array<float>, label int")
    got = sorted(tuple(r) for r in embedding_dedup.near_duplicates(table).collect())
    assert got == [(i, int(n), r, i == r) for i, (n, r) in enumerate(zip(linked.sum(axis=1), root))]
    assert linked.sum() > 100


def test_copies_with_negative_zeros(spark):
    """A zero's sign makes no other vector; rows of equal vectors meet again by their hashes, under each label."""
    rows = [(1, [0.0, 1.0], 1), (2, [-0.0, 1.0], 1), (3, [0.0, 1.0], 2), (4, [-0.0, 1.0], None), (5, [0.0, -0.0], 1), (6, None, 1), (6, None, 1), (7, [1.0, 0.0], 1), (2, [0.0, 1.0], 1)]
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int").selectExpr("*", "1 AS hash_a", "2 AS hash_b", "3 AS vector")
    got = sorted(tuple(r) for r in embedding_dedup.near_duplicates(table).collect())
    assert got == [(1, 2, 1, True), (2, 2, 1, False), (2, 2, 1, False), (3, 0, 3, True), (4, 0, 4, True), (5, 0, 5, True), (6, 0, 6, True), (6, 0, 6, True), (7, 0, 7, True)]


def test_many_lengths(spark):
    """Vectors of more lengths than a sample holds, each with a copy and a near one."""
    rng = np.random.default_rng(2)
    rows = []
    for dim in range(2, 102):
        v = rng.normal(size=dim)
        rows += [v, v + 1e-3, -v]
    table = spark.createDataFrame([(i, v.tolist(), 1) for i, v in enumerate(rows)], "vec_id bigint, embedding array<float>, label int")
    got = sorted((r.vec_id, r.n_links, r.component_id) for r in embedding_dedup.near_duplicates(table).collect())
    assert got == [(i, int(i % 3 < 2), i - (i % 3 == 1)) for i in range(len(rows))]
    few = embedding_dedup.fit_cells(table.selectExpr("vec_id AS node", "label", "size(embedding) AS dim", "embedding AS vector"), 10)
    assert 0 < len(few) <= 10


def test_given_vectors(spark):
    t = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    rows = sorted((r.vec_id, r.embedding, r.label) for r in t.collect())
    x = np.array([r[1] for r in rows], float)
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    label = np.array([r[2] for r in rows])
    linked = (unit @ unit.T >= 0.98) & (label[:, None] == label[None])
    np.fill_diagonal(linked, False)
    root = classes(len(x), zip(*np.nonzero(linked)))
    got = sorted((r.vec_id, r.n_links, r.component_id) for r in embedding_dedup.near_duplicates(t).collect())
    assert got == [(rows[i][0], int(linked[i].sum()), rows[root[i]][0]) for i in range(len(rows))]
