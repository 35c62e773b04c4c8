"""Quality rules: boosted trees over document statistics.

The trees are fitted with a logistic loss on a bounded sample of labelled documents, with
monotonic constraints: more symbols, repetition, capitals or table bars never raise a score.
The fitted trees are flattened into numpy node arrays; scoring moves all rows of a batch down
all trees at once.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brinework.llm.common import released

#: The classifier is fitted on at most this many labelled documents, those with the smallest hashes of their ids.
MAX_SAMPLE = 20_000
#: A document passes when its probability of good quality is at least this.
MIN_PROBABILITY = 0.4
WINDOW = 8
SPACES = "\x20\t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
#: Feature and the sign that its effect on quality may have (0: either).
FEATURES = (
    ("log_words", 0),
    ("mean_word", 0),
    ("log_longest_word", 0),
    ("symbols_per_word", -1),
    ("bars_per_word", -1),
    ("bangs_per_word", -1),
    ("capital_share", -1),
    ("digit_share", 0),
    ("distinct_words", 0),
    ("same_as_previous", -1),
    ("repeated_windows", -1),
    ("repeated_lines", -1),
    ("words_per_line", 0),
    ("stops_per_word", 0),
    ("commas_per_word", 0),
)
_CAPITALS, _DIGITS = bytes(range(65, 91)), bytes(range(48, 58))
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def repeated_words(words: list[bytes], window: int = WINDOW) -> tuple[int, float, float]:
    """Words inside windows that occur twice or more; shares of distinct words and of words equal to the one before."""
    n = len(words)
    if not n:
        return 0, 1.0, 0.0
    marks = np.fromiter(map(hash, words), np.int64, n)
    distinct = len(np.unique(marks)) / n
    same = float((marks[1:] == marks[:-1]).mean()) if n > 1 else 0.0
    if n <= window:
        return 0, distinct, same
    with np.errstate(over="ignore"):
        rolled = np.zeros(n - window + 1, np.int64)
        for k in range(window):
            rolled = rolled * np.int64(6364136223846793005) + marks[k : n - window + 1 + k]
    ordered = np.sort(rolled)
    if not (ordered[1:] == ordered[:-1]).any():
        return 0, distinct, same
    codes: dict[bytes, int] = {}  # equal hashes may lie: number the words, then windows of 1, 2, 4, ... of them
    ids = np.fromiter((codes.setdefault(w, len(codes)) for w in words), np.int64, n)
    span = 1
    while span < window:
        step = min(span, window - span)
        _, ids = np.unique(ids[: len(ids) - step] * np.int64(n + 1) + ids[step:], return_inverse=True)
        span += step
    counts = np.bincount(ids)
    starts = np.flatnonzero(counts[ids] > 1)
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + window, -1)
    return int((np.cumsum(edge)[:n] > 0).sum()), distinct, same


def statistics(text: str | None) -> tuple[list[int], list[float]]:
    """The five base counts and the features of a whole text; a null text has no words."""
    text = text or ""
    raw = text.encode()
    words = raw.split()
    n = len(words)
    chars = len(text) - sum(text.count(c) for c in SPACES)
    symbols = sum(text.count(c) for c in SYMBOLS)
    seen: set[str] = set()
    lines = repeats = 0
    for line in text.split("\n"):
        if line.strip(SPACES):
            lines += 1
            repeats += line in seen
            seen.add(line)
    repeat_words, distinct, same = repeated_words(words)
    d, letters = max(n, 1), max(len(raw), 1)
    features = [
        float(np.log1p(n)),
        chars / d,
        float(np.log1p(max(map(len, words), default=0))),
        symbols / d,
        raw.count(b"|") / d,
        raw.count(b"!") / d,
        (len(raw) - len(raw.translate(None, _CAPITALS))) / letters,
        (len(raw) - len(raw.translate(None, _DIGITS))) / letters,
        distinct,
        same,
        repeat_words / d,
        repeats / max(lines, 1),
        n / max(lines, 1),
        raw.count(b".") / d,
        raw.count(b",") / d,
    ]
    return [n, chars, symbols, repeats, repeat_words], features


@dataclass
class Forest:
    """Flat trees: node arrays, the root of each tree and the depth that reaches every leaf."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    depth: int
    base: float

    def margin(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        for at in range(0, len(x), 4096):
            part = x[at : at + 4096]
            node = np.tile(self.roots, (len(part), 1))
            row = np.arange(len(part))[:, None]
            for _ in range(self.depth):
                node = np.where(part[row, self.feature[node]] <= self.threshold[node], self.left[node], self.right[node])
            out[at : at + 4096] += self.value[node].sum(axis=1)
        return out

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-self.margin(x)))


def fit(x: np.ndarray, y: np.ndarray, signs: list[int], trees: int = 40, depth: int = 3, rate: float = 0.2, bins: int = 48, penalty: float = 1.0) -> Forest:
    """Histogram boosting with second-order gains; a constrained split keeps its children's values in order, and bounds below it hold the order."""
    cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1])) for f in range(x.shape[1])]
    code = np.stack([np.searchsorted(c, x[:, f], side="left") for f, c in enumerate(cuts)], axis=1)
    share = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    base = float(np.log(share / (1 - share)))
    score = np.full(len(y), base)
    nodes: list[list[float]] = []  # feature, threshold, left, right, value
    roots = []

    def grow(rows: np.ndarray, level: int, low: float, high: float, g: np.ndarray, h: np.ndarray) -> int:
        at = len(nodes)
        gs, hs = g[rows].sum(), h[rows].sum()
        value = float(np.clip(-gs / (hs + penalty), low, high))
        nodes.append([0, np.inf, at, at, rate * value])
        best = (1e-6, -1, 0, 0.0, 0.0)
        if level < depth:
            for f, c in enumerate(cuts):
                if not len(c):
                    continue
                gl = np.cumsum(np.bincount(code[rows, f], g[rows], len(c) + 1))[:-1]
                hl = np.cumsum(np.bincount(code[rows, f], h[rows], len(c) + 1))[:-1]
                wl = np.clip(-gl / (hl + penalty), low, high)
                wr = np.clip(-(gs - gl) / (hs - hl + penalty), low, high)
                gain = gl**2 / (hl + penalty) + (gs - gl) ** 2 / (hs - hl + penalty) - gs**2 / (hs + penalty)
                gain[(hl < 2) | (hs - hl < 2) | (signs[f] * (wr - wl) < 0)] = -1
                if len(gain) and gain.max() > best[0]:
                    k = int(gain.argmax())
                    best = (gain[k], f, k, wl[k], wr[k])
        if best[1] >= 0:
            _, f, k, wl, wr = best
            goes = code[rows, f] <= k
            mid = (wl + wr) / 2
            bounds = {0: ((low, high), (low, high)), 1: ((low, mid), (mid, high)), -1: ((mid, high), (low, mid))}[signs[f]]
            nodes[at][:4] = [f, cuts[f][k], grow(rows[goes], level + 1, *bounds[0], g, h), grow(rows[~goes], level + 1, *bounds[1], g, h)]
        else:
            score[rows] += rate * value
        return at

    for _ in range(trees):
        p = 1 / (1 + np.exp(-score))
        roots.append(grow(np.arange(len(y)), 0, -4.0, 4.0, p - y, p * (1 - p)))
    flat = np.array(nodes, float).reshape(-1, 5)
    whole = [flat[:, i].astype(np.int32) for i in (0, 2, 3)]
    return Forest(whole[0], flat[:, 1], whole[1], whole[2], flat[:, 4], np.array(roots, np.int32), depth, base)


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text", quality: str = "quality", max_sample: int = MAX_SAMPLE) -> Forest | None:
    """Fits on a bounded sample of labelled documents; None where the labels hold no two outcomes.

    Labels with a null id or outcome are not used; a document with several labels counts once for each.
    """
    chosen = (
        labels.select(F.col(id_col).alias("__id"), F.col(quality).cast("double").alias("__y"))
        .dropna()
        .orderBy(F.xxhash64("__id"), "__id", "__y")
        .limit(max_sample)
    )
    rows = docs.select(F.col(id_col).alias("__id"), F.col(text).alias("__text")).join(F.broadcast(chosen), "__id")

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays(
                [b.column("__id"), b.column("__y"), pa.array([statistics(t.as_py())[1] for t in b.column("__text")], pa.list_(pa.float64()))], names=["i", "y", "x"]
            )

    # the bound holds for the rows too, should ids repeat in the documents
    got = (
        rows.mapInArrow(released(features), f"i {labels.schema[id_col].dataType.simpleString()}, y double, x array<double>")
        .orderBy(F.xxhash64("i"), "i", "y", F.xxhash64("x"))
        .limit(max_sample)
        .collect()
    )
    y = np.array([r.y for r in got]) > 0
    if y.all() or not y.any():
        return None
    return fit(np.array([r.x for r in got]), y.astype(float), [s for _, s in FEATURES])


def verdicts(texts, model: Forest | None, min_probability: float = MIN_PROBABILITY) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Base counts, base_failed, probability and kept of a batch of texts."""
    got = [statistics(t) for t in texts]
    base = np.array([b for b, _ in got], np.int64).reshape(-1, len(BASE))
    n, repeats = base[:, 0], base[:, 4]
    failed = (n < 20) | (100 * repeats > 30 * n)
    x = np.array([f for _, f in got], float).reshape(-1, len(FEATURES))
    probability = model.probability(x) if model and len(x) else np.ones(len(x))
    return base, failed, probability, ~failed & (probability >= min_probability)


def judge(docs: DataFrame, model: Forest | None, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: id, five base counts, base_failed, kept, probability.

    A null or empty text has no words and fails. Repeated rows each get their row; other columns
    are not read. Without a model (no labels) only the base rules decide.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            base, failed, p, kept = verdicts((t.as_py() for t in b.column(1)), model)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), *map(pa.array, base.T.copy()), pa.array(failed), pa.array(kept), pa.array(p)],
                names=[id_col, *BASE, "base_failed", "kept", "probability"],
            )

    kind = docs.schema[id_col].dataType.simpleString()
    counts = ", ".join(f"{c} bigint" for c in BASE)
    return docs.select(F.col(id_col), F.col(text).alias("__text")).mapInArrow(
        released(run), f"`{id_col}` {kind}, {counts}, base_failed boolean, kept boolean, probability double"
    )


def keep_good(docs: DataFrame, model: Forest | None, text: str = "text") -> DataFrame:
    """The documents that the rules keep, all columns unchanged.

    Null and empty texts go, repeated rows are judged each, other columns are not read; without a
    model only the base rules decide.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield b.filter(pa.array(verdicts((t.as_py() for t in b.column(b.schema.get_field_index(text))), model)[3]))

    return docs.mapInArrow(released(run), docs.schema)
