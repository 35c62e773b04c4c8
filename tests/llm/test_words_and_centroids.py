"""Spelling variants and centroid clustering against plain loops, and their edges."""

import collections
import hashlib
import random
import re
import zlib

import numpy as np

from brinework.llm import orchard_clustering, spelling_variants


# spelling variants
def plain_words(rows):
    count = collections.Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 97 == 0:
                k = h % len(run)
                run = run[:k] + run[k + 1 :]
            count[run] += 1
    return {w: n for w, n in count.items() if len(w) >= 5 and n >= 3}


def near(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(a == b[:k] + b[k + 1 :] for k in range(len(b)))


def plain_groups(words):
    around = {w: [v for v in words if near(w, v)] for w in words}
    form = {}
    for w, vs in around.items():
        best = min(vs, key=lambda v: (-words[v], v), default=None)
        form[w] = best if best and words[best] >= 2 * words[w] else None
    out = set()
    for w in words:
        root = w
        while form[root]:
            root = form[root]
        out.add((w, form[w], root, words[w], len(around[w]), form[w] and words[form[w]]))
    return out


def test_groups_by_plain_loops(spark):
    """Words of few letters, so that many are near; chains of forms, long words, accents, repeated documents."""
    rng = random.Random(5)
    words = ["".join(rng.choice("abé") for _ in range(rng.randint(5, 8))) for _ in range(250)]
    long = "abcdefghij" * 3
    words += [long, long + "x", long[:-1], "x" + long, long[:15] + long[16:], long[:7] + "z" + long[8:], "q" * 20, "q" * 21, "q" * 22, "q" * 19, "q" * 20 + "r" + "q" * 150, "q" * 171, "q" * 170]
    rows = []
    for i in range(60):
        text = []
        for k, w in enumerate(words):
            text += [w] * rng.choice([0, 0, 0, 1, 1, 2] if k % 3 else [0, 1, 4])
        rng.shuffle(text)
        rows.append((i if i % 7 else None, " ".join(w.upper() if rng.random() < 0.1 and w.isascii() else w for w in text)))
    rows += [(200 + k, w) for k, w in enumerate(["kkkkk"] * 3 + ["kkkkm"] * 8 + ["kkkmm"] * 20 + ["kkmmm"] * 41)]
    rows += [(99, None), (98, ""), (97, "12 34 ×÷ß !")] + rows[:2]
    docs = spark.createDataFrame([(*r, "n", 1, "w") for r in rows], "doc_id bigint, text string, word string, n int, run string")
    got = {tuple(r) for r in spelling_variants.group_variants(docs).select("word", "form", "root", "n", "n_near", "form_n").collect()}
    want = plain_groups(plain_words(rows))
    assert got == want
    assert any(r[2] != r[1] for r in want if r[1]) and any(len(r[0]) > 160 and r[4] for r in want)


def test_every_length_meets(spark):
    """Trie and parts give the same pairs wherever the border between them is."""
    rng = random.Random(6)
    words = {"".join(rng.choice("ab") for _ in range(n)) for n in range(5, 13) for _ in range(40)}
    df = spark.createDataFrame([(w,) for w in words], "word string")
    want = sorted((a, b) for a in words for b in words if near(a, b))
    for longest in (4, 8, 9, 20):
        assert sorted(map(tuple, spelling_variants.neighbours(df, longest).collect())) == want


def test_rows_of_letters_across_the_middle(spark):
    """Equal letters that lie across the middle, palindromes, single letters and the empty word, however many letters a level takes."""
    words = {"a" * i + "b" * j + "a" * k for i in range(5) for j in range(4) for k in range(5)} | {"b" * n for n in range(1, 12)}
    df = spark.createDataFrame([(w,) for w in words], "word string")
    want = sorted((a, b) for a in words for b in words if near(a, b))
    for stride in (1, 3, 5, 20):
        once = list(map(tuple, spelling_variants.trie_neighbours(df, stride).collect()))
        assert sorted(once + [(b, a) for a, b in once]) == want


def test_plans_stay_small(spark):
    """The driver's memory goes by the plans: those of a trie of full depth had 21 levels of a join each, and the driver took over 1,500 MB on a few rows."""
    rng = random.Random(7)
    words = ["".join(rng.choice("abcd") for _ in range(n)) for n in range(5, 21) for _ in range(20)]
    words += [w[:k] + "e" + w[k + 1 :] for w in words for k in (0, len(w) // 2, len(w) - 1)]
    docs = spark.createDataFrame([(i, " ".join(words)) for i in range(4)], "doc_id bigint, text string")
    store = spark._jsparkSession.sharedState().statusStore()

    def plans():
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
        every = store.executionsList()
        return {every.apply(k).executionId() for k in range(every.size())}

    before = plans()
    assert spelling_variants.group_variants(docs).where("form is null").count() > 0
    joins = []
    for k in plans() - before:
        nodes = store.planGraph(k).allNodes()
        joins.append(sum("Join" in nodes.apply(i).name() for i in range(nodes.size())))
    assert max(joins) <= 6 and sum(joins) <= 24, joins


def test_no_words(spark):
    docs = spark.createDataFrame([(1, None), (2, ""), (3, "abc abc abc")], "doc_id bigint, text string")
    for d in (docs, docs.limit(0)):
        assert spelling_variants.group_variants(d).collect() == []


# centroid clustering
def plain_clusters(rows, k=16):
    kept = [(i, np.array([int(np.floor(64 * float(x))) for x in v], dtype=object)) for i, v in rows if v is not None and len(v) == 64 and all(x is not None and np.isfinite(x) for x in v)]
    first = sorted(kept, key=lambda r: (hashlib.sha256(f"1:{'' if r[0] is None else r[0]}".encode()).hexdigest(), tuple(r[1])))[:k]
    centroids = [c for _, c in first]

    def nearest(x):
        return min((sum((x - c) ** 2), n) for n, c in enumerate(centroids))

    for _ in range(3):
        to = [nearest(x)[1] for _, x in kept]
        centroids = [sum(x for (_, x), t in zip(kept, to) if t == n) // to.count(n) if n in to else c for n, c in enumerate(centroids)]
    got = [(i, *nearest(x)) for i, x in kept]
    every = sum(d for _, d, _ in got)
    return sorted(str((i, n, int(d), int(sum(e for _, e, m in got if m == n)), int(every), hashlib.sha256(",".join(map(str, centroids[n])).encode()).hexdigest())) for i, d, n in got)


def clustered(df):
    return sorted(str((r.vec_id, r.cluster, r.distance, r.cluster_inertia, r.inertia, r.centroid_sha256)) for r in orchard_clustering.cluster(df).collect())


SCHEMA = "vec_id bigint, embedding array<float>, cluster int, distance string, inertia int"


def test_clusters_by_plain_loops(spark):
    """Ties, repeats, hot copies, unusable vectors and names that clash."""
    rng = np.random.default_rng(8)
    rows = [(i, [float(x) for x in rng.integers(-2, 3, 64) / 64]) for i in range(150)]
    rows += [(200 + i, [0.5] * 64) for i in range(80)] + rows[:5] + [(None, rows[3][1]), (None, rows[4][1])]
    bad = [(300, None), (301, []), (302, [1.0] * 63), (303, [None] + [1.0] * 63), (304, [float("nan")] * 64), (305, [float("inf")] * 64), (306, [1.0] * 65)]
    df = spark.createDataFrame([(*r, 1, "d", 2) for r in rows + bad], SCHEMA).repartition(5)
    assert clustered(df) == plain_clusters(rows + bad)


def test_few_and_no_vectors(spark):
    rows = [(i, [float(i)] * 64) for i in range(3)]
    df = spark.createDataFrame([(*r, 1, "d", 2) for r in rows], SCHEMA)
    assert clustered(df) == plain_clusters(rows)
    assert clustered(df.where("vec_id = 1")) == plain_clusters(rows[1:2])
    empty = orchard_clustering.cluster(df.limit(0))
    assert empty.collect() == [] and empty.columns == orchard_clustering.cluster(df).columns
    huge = spark.createDataFrame([(1, [3e38] * 64, 1, "d", 2), (2, [-3e38] * 64, 1, "d", 2)], SCHEMA)
    assert [r.distance for r in orchard_clustering.cluster(huge).collect()] == [0, 0]


def test_search_measures_few(spark):
    """The walk finds the nearest of many centroids, of equals the smaller number, and measures a part of them."""
    rng = np.random.default_rng(9)
    centers = rng.integers(-40_000, 40_000, (60, 8))
    centers[31] = centers[7]
    x = np.concatenate([c + rng.integers(-800, 800, (50, 8)) for c in centers] + [rng.integers(-9000, 9000, (300, 8))])
    number, distance, measured = orchard_clustering.Orchard(centers).nearest(x, block=700)
    plain = ((x[:, None, :] - centers[None]) ** 2).sum(axis=2)
    assert (number == plain.argmin(axis=1)).all() and (distance == plain.min(axis=1)).all()
    assert measured < 0.7 * plain.size
