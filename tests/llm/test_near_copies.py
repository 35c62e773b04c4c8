"""Near copies of the pipeline's stage against brute-force Jaccard indices."""

import corpus_pipeline
import numpy as np
import pytest
from test_dedup import classes

from brinework.llm import simhash


def shingles(text, k=5):
    words = text.lower().split()
    return {" ".join(words[i : i + k]) for i in range(max(1, len(words) - k + 1))} if words else set()


def planted():
    """Texts with edited copies on both sides of the threshold, chains of edits, exact copies, short and empty texts."""
    rng = np.random.default_rng(11)
    vocabulary = [f"w{i}" for i in range(3000)]
    texts = []
    for size in (20, 45, 120, 300, 900) * 6:
        base = list(rng.choice(vocabulary, size))
        texts.append(" ".join(base))
        words = base
        for _ in range(5):
            words = list(words if rng.random() < 0.3 else base)
            for at in rng.integers(0, size, max(1, int(size * rng.uniform(0.002, 0.03)))):
                words[at] = rng.choice(vocabulary)
            texts.append(" ".join(words))
    return texts + texts[:5] + [texts[7].upper(), "", "", "one two", "One  two", "one three"]


def truth(texts):
    sets = [shingles(t) for t in texts]
    near = [(i, j) for i in range(len(sets)) for j in range(i) if sets[i] == sets[j] or len(sets[i] & sets[j]) / len(sets[i] | sets[j]) >= 0.8]
    return near, sets, classes(len(sets), near)


def test_stage_drops_near_copies(spark):
    texts = planted()
    near, sets, root = truth(texts)
    far = [(simhash.fingerprint(texts[i]) ^ simhash.fingerprint(texts[j])).bit_count() > 4 for i, j in near if sets[i] != sets[j]]
    assert sum(far) > 50  # what links of four bits miss
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = sorted(r.doc_id for r in corpus_pipeline.near_dedup(spark, docs, "").collect())
    assert got == sorted(set(root))


@pytest.mark.parametrize("first", ["all", "half"])
def test_forest(first):
    texts = [t for t in dict.fromkeys(planted()) if t]
    sets = [simhash.shingle_set(t, 5) for t in texts]
    n = len(texts) if first == "all" else len(texts) // 2
    want = [(i, j) for i in range(len(sets)) for j in range(i) if (n == len(sets) or j < n <= i) and len(np.intersect1d(sets[i], sets[j])) / len(np.union1d(sets[i], sets[j])) >= 0.8]
    bits = np.array([simhash._majority([s]) for s in sets], np.uint64)
    assert classes(len(sets), simhash.similar_forest(bits, sets, n, 0.8, simhash.WIDE_RADIUS)) == classes(len(sets), want)


def test_blocks(spark, monkeypatch):
    """A component cut into small blocks keeps its links."""
    monkeypatch.setattr(simhash.similar_links, "__defaults__", (simhash.WIDE_RADIUS, 400))
    texts = planted()
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = sorted(r.doc_id for r in simhash.keep_one(docs, shingle=5, similarity=0.8).collect())
    assert got == sorted(set(truth(texts)[2]))
