"""Language identification by language-bitmask n-gram filters.

Character n-grams of the learning documents are counted per language in Spark. A language holds
an n-gram when its rate there is at least MIN_SHARE of its highest rate in any language. The
held n-grams go into one bit-sliced Bloom filter: a slot is a row of bits, one for each language,
and the AND of an n-gram's slots is the set of languages that contain it. The slots follow from
the n-grams held, so that at most half the bits of a language are set; beyond MAX_BYTES the
languages with most n-grams give up those with the lowest rates. A document's score for a language
is its popcount over all n-grams, corrected for the filter's false positives.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brinework.llm.bpe import slices
from brinework.llm.common import checkpoint, released

ORDERS = (2, 3, 4)
MIN_SHARE = 0.25
#: Hashes of an n-gram, and the most bytes of a filter (slots times a byte for every eight languages): it is sent to every executor.
HASHES, MAX_BYTES = 3, 1 << 26
#: Slots that travel to the driver as one row.
BLOCK_SLOTS = 4096
UNKNOWN = "und"
#: Bytes of text that are worked on at once, and distinct n-grams of a language that a task holds before it emits them.
SLICE, MAX_PENDING = 200_000, 1_000_000
_SPACE = 32


def _letters() -> np.ndarray:
    """Whether each code point up to the last assigned letter is a letter."""
    return np.fromiter((chr(i).isalpha() for i in range(0x32400)), bool, 0x32400)


LETTER = _letters()


def letters_of(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of lower-cased texts, with one space for each run of other characters and at both ends, and the text of each."""
    points = np.frombuffer("\0".join([x.lower() for x in texts] + [""]).encode("utf-32-le", "surrogatepass"), "<u4")
    is_letter = LETTER[np.minimum(points, len(LETTER) - 1)]
    start = np.zeros(len(points), bool)
    start[1:] = ~is_letter[1:] & is_letter[:-1]
    if len(points):
        start[0] = not is_letter[0]
    lens = [len(x.lower()) + 1 for x in texts]
    owner = np.repeat(np.arange(len(texts)), lens)
    # the separator of two texts stands for the end of one and the start of the next
    keep = is_letter | start
    points = np.where(is_letter, points, _SPACE)[keep].astype(np.uint64)
    return np.concatenate([[np.uint64(_SPACE)], points]), np.concatenate([[0], owner[keep]]) if len(texts) else np.zeros(1, np.int64)


def ngrams(texts: list[str], orders: tuple[int, ...] = ORDERS) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all n-grams that hold a letter and no border of two words inside, and the text of each."""
    points, owner = letters_of(texts)
    space = points == _SPACE
    marks, owners = [], []
    for n in orders:
        size = len(points) - n + 1
        if size <= 0:
            continue
        h = np.full(size, n, np.uint64)
        for k in range(n):
            h = (h ^ points[k : k + size]) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(29)
        inner = np.zeros(size, bool)
        for k in range(1, n - 1):
            inner |= space[k : k + size]
        ok = ~inner & ~(space[:size] & space[n - 1 :]) if n > 1 else ~space[:size]
        if n > 2:  # " a " is a word of one letter
            ok |= ~inner & space[:size] & space[n - 1 :]
        marks.append(h[ok])
        owners.append(owner[n - 1 :][ok] if n == 1 else owner[np.arange(size)[ok] + 1])
    if not marks:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return np.concatenate(marks), np.concatenate(owners)


def _places(marks: np.ndarray, slots: int, hashes: int) -> list[np.ndarray]:
    step = (marks >> np.uint64(32)) | np.uint64(1)
    return [((marks + np.uint64(k) * step) % np.uint64(slots)).astype(np.int64) for k in range(hashes)]


@dataclass
class Filter:
    """Bits of each slot (a byte for eight languages), the languages, and the chance of each that a foreign n-gram hits."""

    bits: np.ndarray
    languages: list[str]
    false_rate: np.ndarray
    hashes: int

    def members(self, marks: np.ndarray) -> np.ndarray:
        """Bytes of the set of languages that contain each n-gram."""
        out = None
        for at in _places(marks, len(self.bits), self.hashes):
            out = self.bits[at] if out is None else out & self.bits[at]
        return out

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        """Language and score of each text; ``und`` with score 0 where a text has no letters or nothing was learned."""
        n = len(texts)
        label, score = [UNKNOWN] * n, np.zeros(n)
        if not self.languages or not n:
            return label, score
        marks, owner = ngrams([t or "" for t in texts])
        sets = self.members(marks)
        total = np.bincount(owner, minlength=n).astype(float)
        hits = np.zeros((n, len(self.languages)))
        for k in range(len(self.languages)):
            bit = (sets[:, k // 8] >> np.uint8(k % 8)) & 1
            hits[:, k] = np.bincount(owner, bit, n)
        some = total > 0
        share = (hits[some] / total[some, None] - self.false_rate) / (1 - self.false_rate)
        share = np.clip(share, 0, 1)
        best = share.argmax(axis=1)  # of equals the first by name
        top = share[np.arange(len(share)), best]
        every = share.sum(axis=1)
        score[some] = np.where(every > 0, top / np.where(every > 0, every, 1), 1 / len(self.languages))
        for i, k in zip(np.flatnonzero(some), best):
            label[i] = self.languages[k]
        return label, score


def in_fold(id_col: str = "doc_id") -> Column:
    """Whether a document is held out: crc32 of its id as text, modulo 3, is 1. A null id has the text of nothing."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % 3 == 1


def _merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    mark, place = np.unique(np.concatenate([m for m, _ in parts]), return_inverse=True)
    return mark, np.bincount(place, np.concatenate([n for _, n in parts]), len(mark)).astype(np.int64)


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, mark, n): counts of a task's n-grams, summed over slices of its texts up to MAX_PENDING distinct ones."""
    held: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}

    def rows(lang: str) -> pa.RecordBatch:
        mark, n = _merged(held.pop(lang))
        return pa.RecordBatch.from_arrays([pa.array([lang] * len(mark), pa.string()), pa.array(mark.view(np.int64)), pa.array(n)], names=["lang", "mark", "n"])

    for whole in batches:
        for b in slices(whole, 1, SLICE):
            langs, texts = b.column(0).to_pylist(), b.column(1).to_pylist()
            for lang in sorted(set(langs)):
                own = held.setdefault(lang, [])
                own.append(np.unique(ngrams([t for t, g in zip(texts, langs) if g == lang])[0], return_counts=True))
                if sum(len(m) for m, _ in own[1:]) > max(MAX_PENDING // 8, len(own[0][0])):
                    own[:] = [_merged(own)]
                if len(own[0][0]) > MAX_PENDING:
                    yield rows(lang)
    for lang in list(held):
        yield rows(lang)


def slots_for(most: int, hashes: int = HASHES) -> int:
    """The power of two at which so many n-grams set half of a language's bits or fewer."""
    return max(BLOCK_SLOTS, 1 << int(np.ceil(np.log2(max(most, 1) * hashes / np.log(2)))))


def _lowest_rates(held: DataFrame, most: int) -> dict[int, int]:
    """For each language (k) that holds more n-grams than ``most``: the step of the rates, four to a halving, below which they are given up."""
    steps = held.groupBy("k", F.floor(-4 * F.log2("rate")).alias("step")).count().collect()
    out = {}
    for k in {r.k for r in steps}:
        own = sorted((r.step, r["count"]) for r in steps if r.k == k)
        if sum(n for _, n in own) > most:
            within = np.cumsum([n for _, n in own]) <= most
            out[k] = own[int(within.sum())][0]  # the first step that no longer fits
    return out


def train(docs: DataFrame, id_col: str = "doc_id", text: str = "text", lang: str = "lang", hashes: int = HASHES, min_share: float = MIN_SHARE, max_bytes: int = MAX_BYTES) -> Filter:
    """Learns from all documents that are not held out and have a text and a language.

    A row for each language, a count for each language and step of the rates, and the filter's
    bytes (``max_bytes`` at most) reach the driver. Rows with a null text or language are not
    learned from, repeated rows count each, a table without any gives a filter of no language.
    """
    rows = docs.where(~in_fold(id_col)).select(F.col(lang).alias("lang"), F.col(text).alias("text")).dropna()
    counts = rows.mapInArrow(released(_counts), "lang string, mark bigint, n bigint").groupBy("lang", "mark").agg(F.sum("n").alias("n"))
    counts = checkpoint(counts)
    totals = {r.lang: r.n for r in counts.groupBy("lang").agg(F.sum("n").alias("n")).collect()}
    languages = sorted(totals)
    if not languages:
        return Filter(np.zeros((1, 1), np.uint8), [], np.zeros(0), hashes)
    known = counts.sparkSession.createDataFrame(
        [(g, k, float(totals[g])) for k, g in enumerate(languages)], "lang string, k int, total double"
    )
    rated = counts.join(F.broadcast(known), "lang").withColumn("rate", F.col("n") / F.col("total"))
    top = rated.groupBy("mark").agg(F.max("rate").alias("top"))
    held = checkpoint(rated.join(top, "mark").where(F.col("rate") >= min_share * F.col("top")).select("mark", "k", "rate"))
    width = (len(languages) + 7) // 8
    most = held.groupBy("k").count().agg(F.max("count")).first()[0] or 0
    slots = slots_for(most, hashes)
    if slots * width > max_bytes:
        slots = max(BLOCK_SLOTS, 1 << int(np.log2(max_bytes // width)))
        for k, step in _lowest_rates(held, int(slots * np.log(2) / hashes)).items():
            held = held.where((F.col("k") != k) | (F.floor(-4 * F.log2("rate")) < step))

    def slot_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at = np.concatenate(_places(b.column(0).to_numpy().view(np.uint64), slots, hashes))
            yield pa.RecordBatch.from_arrays(
                [pa.array(at // BLOCK_SLOTS), pa.array((at % BLOCK_SLOTS).astype(np.int32)), pa.array(np.tile(b.column(1).to_numpy(), hashes))], names=["block", "slot", "k"]
            )

    def packed(group: pa.Table) -> pa.Table:
        bits = np.zeros((BLOCK_SLOTS, width), np.uint8)
        k = group["k"].to_numpy()
        np.bitwise_or.at(bits, (group["slot"].to_numpy(), k // 8), np.left_shift(1, k % 8).astype(np.uint8))
        return pa.table({"block": group["block"][:1], "bits": pa.array([bits.tobytes()], pa.binary())})

    placed = held.select("mark", "k").mapInArrow(slot_rows, "block bigint, slot int, k int").distinct()
    bits = np.zeros((slots, width), np.uint8)
    for r in placed.groupBy("block").applyInArrow(packed, "block bigint, bits binary").collect():
        bits[r.block * BLOCK_SLOTS : (r.block + 1) * BLOCK_SLOTS] = np.frombuffer(r.bits, np.uint8).reshape(-1, width)
    full = np.array([((bits[:, k // 8] >> (k % 8)) & 1).mean() for k in range(len(languages))])
    return Filter(bits, languages, full**hashes, hashes)


def identify(docs: DataFrame, model: Filter, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: (id, held_out, lang_pred, score).

    A null text, or one without letters, is ``und`` with score 0. Repeated rows each get their
    row; only the text is an input of the prediction.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # MAX_BYTES at most

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in slices(whole, 2, SLICE):
                label, score = shared.value.predict(b.column(2).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), b.column(1), pa.array(label, pa.string()), pa.array(score)], names=[id_col, "held_out", "lang_pred", "score"]
                )

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col), in_fold(id_col).alias("__held"), F.col(text).alias("__text")).mapInArrow(
        released(run), f"`{id_col}` {kind}, held_out boolean, lang_pred string, score double"
    )


def keep_known(docs: DataFrame, model: Filter, min_lead: float, text: str = "text") -> DataFrame:
    """The documents in a learned language, all columns unchanged.

    A score says how far the best language leads: 1 / languages is an even split, 1 no other
    language at all. A document stays if its score goes ``min_lead`` of the way from the one to
    the other. Null texts, texts without letters and, where nothing was learned, all go; repeated
    rows are judged each; other columns are not read.
    """
    even = 1 / max(1, len(model.languages))
    min_score = even + min_lead * (1 - even) - 1e-9
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            at = whole.schema.get_field_index(text)
            for b in slices(whole, at, SLICE):
                label, score = shared.value.predict(b.column(at).to_pylist())
                yield b.filter(pa.array([g != UNKNOWN and s >= min_score for g, s in zip(label, score)], pa.bool_()))

    return docs.mapInArrow(released(run), docs.schema)
