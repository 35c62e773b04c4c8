"""Byte-pair encoding by a segment tree over adjacent pair ranks, and decoding.

Each pre-token holds a segment tree whose leaves are the merge ranks of its adjacent pairs; the
root yields the leftmost lowest rank, a merge updates three leaves in logarithmic time, and the
work ends when the root holds no mergeable pair. Pre-tokens of similar length step together as
numpy rows, so one round of array operations makes one merge in each of them.

Whole texts are cut before a single space or line feed between other characters. No pre-token of
the byte-level pattern crosses such a place, so the ids of the parts, joined, are the ids of the text; parts
that repeat are looked up in a bounded table of each task.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brinework.llm.common import released

#: Parts, and pre-tokens, that a task remembers; what it has not met lately goes, and longer ones are not stored.
MAX_PARTS, MAX_PART_CHARS = 900_000, 40
#: Symbols that step together; a pre-token of more bytes than LONG steps by itself.
MAX_CELLS, LONG = 1 << 16, 1 << 12
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_GAP = re.compile(r"\s\s")
_CUT = re.compile(r"(?<=\S) (?=\S)|(?<=\S)(?=\n\S)")


def parts_of(text: str) -> list:
    """Cuts a text before each single space or line feed between other characters.

    A string in the list stands for itself if it starts with a line feed, else for a space and
    the string; a tuple of one string stands for that string. So joined, the parts are the text.
    """
    if not text:
        return []
    parts = _CUT.split(text) if _GAP.search(text) else text.replace("\n", " \n").split(" ")
    if parts[0]:
        parts[0] = (parts[0],)
    else:
        del parts[0]
    return parts


def part_text(part) -> str:
    if isinstance(part, tuple):
        return part[0]
    return part if part[:1] == "\n" else " " + part


def byte_alphabet() -> dict[str, int]:
    """The printable character that stands for each byte in a byte-level vocabulary, by rule: printable Latin-1 stands for itself, the others follow from 256."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class SegmentTreeBPE:
    """Encoder and decoder of a byte-level vocabulary file."""

    def __init__(self, path: str):
        spec = json.loads(Path(path).read_text())
        vocab, merges = spec["model"]["vocab"], spec["model"]["merges"]
        alphabet = byte_alphabet()
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        size = max([*vocab.values(), *self.special.values()]) + 1
        words = [b""] * size
        for token, i in vocab.items():
            words[i] = bytes(alphabet[c] for c in token)
        for token, i in self.special.items():
            words[i] = token.encode()
        self.size = size
        self.byte_id = np.zeros(256, np.int64)
        for c, b in alphabet.items():
            self.byte_id[b] = vocab[c]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in merges]
        left = np.array([vocab[a] for a, _ in pairs], np.int64)
        right = np.array([vocab[b] for _, b in pairs], np.int64)
        made = np.array([vocab[a + b] for a, b in pairs], np.int64)
        key = left * size + right
        self.made = made.astype(np.int32)  # by rank
        self._index_pairs(key)
        self.blob, self.start, self.length = _blob(words)
        self.digits = _blob([b"%d," % i for i in range(size)])
        self.pattern = regex.compile(PATTERN)
        self.cut_special = regex.compile("|".join(map(re.escape, self.special))) if self.special else None
        self.rank_of: dict[int, int] = {}  # for long pre-tokens, when one comes
        self.forget()

    def forget(self) -> None:
        """Empties the tables of what was met; a task starts and ends with empty ones."""
        self.known = Table()
        self.pretokens = Table()

    def _index_pairs(self, key: np.ndarray) -> None:
        """Open addressing by a multiplicative hash: place to pair and rank."""
        self.bits = max(4, int(4 * len(key)).bit_length())
        self.slot_key = np.full(1 << self.bits, -1, np.int64)
        self.slot_rank = np.full(1 << self.bits, -1, np.int32)
        todo = np.arange(len(key))
        place = self._place(key)
        while len(todo):
            free = self.slot_key[place] < 0
            self.slot_rank[place[free][::-1]] = todo[free][::-1]  # of several, the first
            self.slot_key[place[free][::-1]] = key[todo[free]][::-1]
            stays = self.slot_key[place] != key[todo]
            todo, place = todo[stays], (place[stays] + 1) & ((1 << self.bits) - 1)

    def _place(self, key: np.ndarray) -> np.ndarray:
        mixed = key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(64 - self.bits)).astype(np.int64)

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair, or -1; a negative symbol is none."""
        key = np.where((left >= 0) & (right >= 0), left.astype(np.int64) * self.size + right, -2)
        place = self._place(key)
        there = self.slot_key[place]
        rank = np.where(there == key, self.slot_rank[place], np.int32(-1))
        todo = np.flatnonzero((there != key) & (there >= 0) & (key >= 0))
        place = place[todo]
        while len(todo):
            place = (place + 1) & ((1 << self.bits) - 1)
            there = self.slot_key[place]
            hit = there == key[todo]
            rank[todo[hit]] = self.slot_rank[place[hit]]
            go = ~hit & (there >= 0)
            todo, place = todo[go], place[go]
        return rank

    def _merge(self, tokens: list[bytes]) -> list[bytes]:
        """Ids (32-bit words) of pre-tokens of at most a common power of two bytes."""
        n = len(tokens)
        lens = np.fromiter(map(len, tokens), np.int64, n)
        width = 1 << int(lens.max() - 1).bit_length() if lens.max() > 1 else 1
        levels = width.bit_length() - 1
        kind = np.int32 if (len(self.made) + 1) * width < 1 << 31 else np.int64
        none = np.iinfo(kind).max
        sym = np.full((n, width + 2), -1, np.int32)  # a border of no symbol on each side
        inside = np.arange(width)[None] < lens[:, None]
        sym[:, 1:-1][inside] = self.byte_id[np.frombuffer(b"".join(tokens), np.uint8)]
        after = np.tile(np.arange(1, width + 3, dtype=np.int32), (n, 1))
        before = np.tile(np.arange(-1, width + 1, dtype=np.int32), (n, 1))
        tree = np.full((n, 2 * width), none, kind)

        def leaf(left: np.ndarray, right: np.ndarray, at: np.ndarray) -> np.ndarray:
            rank = self._rank(left, right)
            return np.where(rank >= 0, rank.astype(kind) * kind(width) + at.astype(kind), none)

        tree[:, width:] = leaf(sym[:, 1:-1].ravel(), sym[:, 2:].ravel(), np.tile(np.arange(width), n)).reshape(n, width)
        for k in range(levels, 0, -1):
            a, b = 1 << (k - 1), 1 << k
            tree[:, a:b] = np.minimum(tree[:, b : 2 * b : 2], tree[:, b + 1 : 2 * b : 2])
        live = np.flatnonzero(tree[:, 1] != none) if width > 1 else np.array([], np.int64)
        while len(live):
            root = tree[live, 1]
            at = root % width + 1
            gone = after[live, at]
            nxt, prv = after[live, gone], before[live, at]
            merged = self.made[root // width]
            sym[live, at] = merged
            sym[live, gone] = -1
            after[live, at] = nxt
            before[live, np.minimum(nxt, width + 1)] = at
            for place, value in (
                (gone, np.full(len(live), none, kind)),
                (at, leaf(merged, sym[live, np.minimum(nxt, width + 1)], at - 1)),
                (prv, leaf(sym[live, prv], merged, prv - 1)),
            ):
                who = np.flatnonzero((place >= 1) & (place <= width))
                row, node = live[who], place[who] - 1 + width
                tree[row, node] = value[who]
                for _ in range(levels):
                    node = node >> 1
                    tree[row, node] = np.minimum(tree[row, 2 * node], tree[row, 2 * node + 1])
            live = live[tree[live, 1] != none]
        ids = sym[:, 1:-1]
        kept = ids >= 0
        raw = ids[kept].astype("<u4").tobytes()
        ends = (4 * np.cumsum(kept.sum(axis=1))).tolist()
        return [raw[a:b] for a, b in zip([0, *ends], ends)]

    def _merge_long(self, raw: bytes) -> bytes:
        """Ids of one long pre-token: the same tree in plain lists, whose updates stop where a node keeps its value."""
        n = len(raw)
        width = 1 << (n - 1).bit_length()
        sym = self.byte_id[np.frombuffer(raw, np.uint8)]
        none = (len(self.made) + 1) * width
        rank = self._rank(sym[:-1], sym[1:]).astype(np.int64)
        tree = np.full(2 * width, none, np.int64)
        tree[width : width + n - 1] = np.where(rank >= 0, rank * width + np.arange(n - 1), none)
        a = width >> 1
        while a:
            tree[a : 2 * a] = np.minimum(tree[2 * a : 4 * a : 2], tree[2 * a + 1 : 4 * a : 2])
            a >>= 1
        tree, sym, made, size = tree.tolist(), sym.tolist(), self.made.tolist(), self.size
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        if not self.rank_of:
            self.rank_of = {k: r for k, r in zip(self.slot_key.tolist(), self.slot_rank.tolist()) if k >= 0}
        rank_of = self.rank_of

        def put(place: int, value: int) -> None:
            node = width + place
            tree[node] = value
            node >>= 1
            while node:
                low = min(tree[2 * node], tree[2 * node + 1])
                if tree[node] == low:
                    break
                tree[node] = low
                node >>= 1

        while (root := tree[1]) != none:
            at = root % width
            gone = after[at]
            nxt, prv = after[gone], before[at]
            sym[at], sym[gone], after[at] = made[root // width], -1, nxt
            put(gone, none)
            found = None
            if nxt < n:
                before[nxt] = at
                found = rank_of.get(sym[at] * size + sym[nxt])
            put(at, none if found is None else found * width + at)
            if prv >= 0:
                found = rank_of.get(sym[prv] * size + sym[at])
                put(prv, none if found is None else found * width + prv)
        return np.array([s for s in sym if s >= 0], "<u4").tobytes()

    def encode_pretokens(self, tokens: Iterable[str]) -> dict[str, bytes]:
        """Ids of each distinct pre-token, by classes of length."""
        by_class: dict[int, tuple[list[str], list[bytes]]] = {}
        for t in dict.fromkeys(tokens):
            raw = t.encode()
            names, raws = by_class.setdefault((len(raw) - 1).bit_length(), ([], []))
            names.append(t)
            raws.append(raw)
        out: dict[str, bytes] = {}
        for bits, (names, raws) in by_class.items():
            if 1 << bits > LONG:
                out.update(zip(names, map(self._merge_long, raws)))
                continue
            step = max(1, MAX_CELLS >> bits)
            for k in range(0, len(names), step):
                out.update(zip(names[k : k + step], self._merge(raws[k : k + step])))
        return out

    def learn(self, parts: list) -> list[bytes]:
        """Ids of parts as little-endian 32-bit words."""
        rows = [[p[0]] if isinstance(p, tuple) and p[0] in self.special else self.pattern.findall(part_text(p)) for p in parts]
        return self.pretokens.rows(rows, self._encode_new)

    def _encode_new(self, new: list[str]) -> list[bytes]:
        got = self.encode_pretokens(t for t in new if t not in self.special)
        return [got[t] if t in got else np.array([self.special[t]], "<u4").tobytes() for t in new]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of whole texts; the special tokens' strings in a text become their ids."""
        rows: list[list] = []
        for text in texts:
            row: list = []
            last = 0
            if any(s in text for s in self.special):
                for m in self.cut_special.finditer(text):
                    row += [*parts_of(text[last : m.start()]), (m.group(),)]
                    last = m.end()
            rows.append(row + parts_of(text[last:]))
        return [np.frombuffer(x, "<u4") for x in self.known.rows(rows, self.learn)]

    def decode_bytes(self, ids: np.ndarray) -> bytes:
        return gather(self.blob, self.start, self.length, ids)

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids, special tokens included; bytes that are no UTF-8 become replacement characters."""
        return self.decode_bytes(ids).decode("utf-8", "replace")


class Table:
    """A bounded table in two halves: when the young half is full it becomes the old one, and what was asked for moves on."""

    def __init__(self) -> None:
        self.young: dict = {}
        self.old: dict = {}

    def rows(self, rows: list[list], learn) -> list[bytes]:
        """The joined values of rows of keys; ``learn`` gives the values of a list of new keys."""
        asked: set = set()
        for row in rows:
            asked.update(row)
        new = asked.difference(self.young)
        again = new.intersection(self.old)
        self.young.update(zip(again, map(self.old.__getitem__, again)))
        new = list(new.difference(again))
        self.young.update(zip(new, learn(new)))
        out = [b"".join(map(self.young.__getitem__, row)) for row in rows]
        for p in new:
            if len(p) > MAX_PART_CHARS or isinstance(p, tuple) and len(p[0]) > MAX_PART_CHARS:
                del self.young[p]
        if len(self.young) > MAX_PARTS // 2:
            self.old, self.young = self.young, {}
        return out


def _blob(words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    length = np.fromiter(map(len, words), np.int64, len(words))
    return np.frombuffer(b"".join(words), np.uint8), np.cumsum(length) - length, length


def gather(blob: np.ndarray, start: np.ndarray, length: np.ndarray, ids: np.ndarray) -> bytes:
    """The byte strings of ids, joined."""
    out = []
    for at in range(0, len(ids), 1 << 16):
        part = ids[at : at + (1 << 16)]
        n = length[part]
        shift = start[part] - (np.cumsum(n) - n)
        out.append(blob[np.repeat(shift, n) + np.arange(n.sum())].tobytes())
    return b"".join(out)


@lru_cache(maxsize=2)
def tokenizer(path: str) -> SegmentTreeBPE:
    return SegmentTreeBPE(path)


def slices(batch: pa.RecordBatch, column: int, chars: int = 4_000_000) -> Iterator[pa.RecordBatch]:
    """Cuts a batch so that a slice holds about so many bytes of a text column, or one longer text."""
    size = np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0)).astype(np.int64)
    group = np.cumsum(size) // chars
    edges = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), batch.num_rows] if batch.num_rows else [0]
    for a, b in zip(edges, edges[1:]):
        yield batch.slice(a, b - a)


def round_trip(docs: DataFrame, path: str, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """Encodes and decodes every whole text: (id, n_tokens, ids_sha256, decoded_sha256).

    A null text counts as empty: no ids, the digests of the empty string. Repeated rows each get
    their row; other columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = tokenizer(path)
        codec.forget()
        for whole in batches:
            for b in slices(whole, 1):
                rows = codec.encode([t.as_py() or "" for t in b.column(1)])
                listed = [hashlib.sha256(gather(*codec.digits, ids)[:-1]).hexdigest() for ids in rows]
                texts = [hashlib.sha256(codec.decode(ids).encode()).hexdigest() for ids in rows]
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), pa.array([len(r) for r in rows], pa.int64()), pa.array(listed, pa.string()), pa.array(texts, pa.string())],
                    names=[id_col, "n_tokens", "ids_sha256", "decoded_sha256"],
                )
        codec.forget()

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col), F.col(text).alias("__text")).mapInArrow(
        released(run), f"`{id_col}` {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    )
