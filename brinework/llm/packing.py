"""Vector best-fit packing of token pieces into sequences.

Each open sequence has residual capacities of tokens, documents and attention cost (the sum of
squared lengths). Pieces come longest first; of the sequences that fit under every constraint,
a piece takes the one with the smallest weighted norm of what would remain, or with the largest
weighted dot product of its demand and the residuals; with none it opens a new one. A whole piece
of ``capacity`` tokens costs ``capacity`` squared by itself, so an attention capacity that admits
such pieces weighs in the choice but cannot bind; a caller with shorter pieces can set a lower one.
"""

from __future__ import annotations

import json
import os
import zlib
from collections.abc import Iterator
from functools import lru_cache, reduce
from itertools import chain
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brinework.llm.bpe import PATTERN, byte_alphabet, part_text, parts_of, slices
from brinework.llm.common import checkpoint, free_names, released

CAPACITY = 2048
#: Pieces that one task packs; tasks are dealt round-robin, so every task sees the mix of the corpus.
TASK_PIECES = 16_384
#: Of the residual tokens, documents and attention, each as a share of its capacity.
WEIGHTS = (1.0, 0.1, 0.1)
#: The least capacity of documents that is chosen where none is given.
MIN_DOCUMENTS = 64
#: Sequences of a task that are less full are taken apart and packed again with those of other tasks.
OPEN_SHARE = 0.95
#: Bytes of text that are encoded at once.
SLICE = 8_000_000
#: Two white-space characters in a row; a text without them is cut at its spaces and before its line feeds.
_GAP = r"[\s\v\x1c-\x1f\x{85}\p{Z}]{2}"
# Code points of which all versions of Unicode tell alike whether they are letters, numbers or spaces.
_COMMON = r"^\n?[!-\x7e\xa1-\x{24f}\x{410}-\x{44f}\x{3041}-\x{3096}\x{30a1}-\x{30fa}\x{4e00}-\x{9fa5}\x{ac00}-\x{d7a3}]{1,300}$"
PIECES = "piece int, start bigint, length bigint, ids_crc32 bigint"


@lru_cache(maxsize=2)
def _library(path: str):
    """The tokenizer, the strings of its special tokens, its merges for tiktoken, and the bytes of each token."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
    import tiktoken
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    t.no_padding()
    t.no_truncation()
    alphabet = byte_alphabet()
    specials = {a.content for a in t.get_added_tokens_decoder().values()}
    words = {bytes(alphabet[c] for c in token): i for token, i in t.get_vocab().items() if token not in specials}
    length = np.zeros(t.get_vocab_size(), np.int64)
    for word, i in words.items():
        length[i] = len(word)
    merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in json.loads(Path(path).read_text())["model"]["merges"]]
    made = [t.token_to_id(a + b) for a, b in merges]
    if any(x >= y for x, y in zip(made, made[1:])):
        raise ValueError("the ids of this vocabulary do not follow the order of its merges")
    return t, sorted(specials), tiktoken.Encoding("parts", pat_str=PATTERN, mergeable_ranks=words, special_tokens={}), length


def ragged(flat: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The runs of a flat array that begin at ``start`` and have ``length`` elements, joined."""
    shift = start - (np.cumsum(length) - length)
    return flat[np.repeat(shift, length) + np.arange(length.sum())]


def encode(texts: pa.Array, path: str) -> tuple[np.ndarray, np.ndarray]:
    """The ids of whole texts, joined, and where each text's ids end: those of the tokenizers library. A null text is empty.

    Arrow cuts the texts into parts before each single space or line feed and numbers the distinct
    ones. Common parts, joined to one text, go through tiktoken, which makes the same merges
    faster; their ids are cut again where the bytes of the parts end. All other parts, and texts
    with a special token, go through the library. A text's ids are then gathered by number.
    """
    library, specials, merges, token_bytes = _library(path)
    texts = pc.fill_null(texts, "")
    odd = pc.match_substring_regex(texts, _GAP)
    for s in specials:  # the library cuts a text at its special tokens first, so such a text is one part
        odd = pc.or_(odd, pc.match_substring(texts, s))
    odd = np.asarray(odd)
    split = pc.split_pattern(pc.replace_substring(texts.filter(pa.array(~odd)), "\n", " \n"), " ")
    flat = split.flatten()
    count = np.diff(split.offsets.to_numpy())
    first = np.cumsum(count) - count
    numbered = flat.dictionary_encode()
    parts = numbered.dictionary
    common = np.asarray(pc.match_substring_regex(parts, _COMMON))
    number = np.empty(len(parts), np.int64)
    number[common], number[~common] = np.arange(common.sum()), np.arange(common.sum(), len(parts))
    code = number[numbered.indices.to_numpy()]
    rest = parts.filter(pa.array(~common)).to_pylist()
    parts = parts.filter(pa.array(common))
    parts = pc.if_else(pc.starts_with(parts, "\n"), parts, pc.binary_join_element_wise(" ", parts, ""))
    ids = np.frombuffer(merges._core_bpe.encode_to_tiktoken_buffer("".join(parts.to_pylist()), set()), np.uint32)
    ends = np.cumsum(token_bytes[ids]).searchsorted(np.cumsum(pc.binary_length(parts).to_numpy())) + 1
    # the library's parts: rare ones, first ones, which nothing stands before, and those of odd texts
    heads = [(p,) if p else None for p in flat.take(pa.array(first)).to_pylist()]
    rows = [[(t,)] if any(s in t for s in specials) else parts_of(t) for t in texts.filter(pa.array(odd)).to_pylist()]
    others = [p for row in rows for p in row]
    listed = [*rest, *dict.fromkeys([h for h in heads if h] + others)]
    made = [e.ids for e in library.encode_batch_fast([part_text(p) for p in listed], add_special_tokens=False)]
    place = dict(zip(listed[len(rest) :], range(len(number), len(number) + len(listed))))
    none = len(number) + len(listed) - len(rest)
    code[first] = [place[h] if h else none for h in heads]
    size = np.concatenate([np.diff(ends, prepend=0), list(map(len, made)), [0]]).astype(np.int64)
    ids = np.concatenate([ids, np.fromiter(chain.from_iterable(made), np.uint32)])
    # the numbers of each text, in order of the texts
    every = np.concatenate([code, np.fromiter(map(place.__getitem__, others), np.int64, len(others))])
    n, at = np.zeros((2, len(texts)), np.int64)
    n[~odd], n[odd] = count, list(map(len, rows))
    at[~odd], at[odd] = first, len(code) + np.cumsum(n[odd]) - n[odd]
    every = ragged(every, at, n)
    size_of = size[every]
    ends = np.append(0, np.cumsum(size_of))[np.cumsum(n)]
    return ragged(ids, (np.cumsum(size) - size)[every], size_of), ends


def cut(length: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces: whole sequences at the end, the rest first."""
    first = length % capacity or min(length, capacity)
    return [(0, first), *((s, capacity) for s in range(first, length, capacity))]


def pieces(docs: DataFrame, path: str, end_id: int = 0, capacity: int = CAPACITY, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per piece: (id, piece, start, length, ids_crc32); a document's ids end with ``end_id``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in slices(whole, 1, SLICE):
                out: list[tuple[int, int, int, int, int]] = []
                ids, ends = encode(b.column(1), path)
                ids = np.insert(ids, ends, end_id)
                ends = ends + np.arange(1, len(ends) + 1)
                raw, at = memoryview(ids.astype("<u4").tobytes()), 0
                for row, end in enumerate(ends.tolist()):
                    for k, (s, n) in enumerate(cut(end - at, capacity)):
                        out.append((row, k, s, n, zlib.crc32(raw[4 * (at + s) : 4 * (at + s + n)])))
                    at = end
                at = np.array(out, np.int64).reshape(-1, 5).T
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).take(pa.array(at[0])), pa.array(at[1].astype(np.int32)), *(pa.array(x.copy()) for x in at[2:])],
                    names=[id_col, "piece", "start", "length", "ids_crc32"],
                )

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col), F.col(text).alias("__text")).mapInArrow(released(run), f"`{id_col}` {kind}, {PIECES}")


def best_fit(
    lengths: np.ndarray,
    capacity: int = CAPACITY,
    max_documents: int = MIN_DOCUMENTS,
    max_attention: int | None = None,
    weights: tuple[float, float, float] = WEIGHTS,
    rule: str = "norm",
) -> tuple[np.ndarray, np.ndarray]:
    """Sequence number and offset of each piece, under all three capacities.

    ``rule`` is ``norm`` (the smallest weighted norm of the residuals after the piece) or ``dot``
    (the largest weighted dot product of the residuals and the demand). A piece that breaks a
    capacity by itself is an error.
    """
    full = np.array([capacity, max_documents, max_attention or capacity**2], float)
    w = np.array(weights)
    order = np.argsort(-lengths, kind="stable")
    bins, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    room = np.zeros((len(lengths) + 1, 3))  # of open sequences, in front
    name = np.zeros(len(lengths) + 1, np.int64)
    opened = made = 0
    least = lengths.min() if len(lengths) else 0
    for i in order:
        n = lengths[i]
        need = np.array([n, 1, float(n) ** 2])
        if (need > full).any():
            raise ValueError(f"a piece of {n} tokens breaks a capacity by itself")
        left = room[:opened] - need
        fits = np.flatnonzero((left >= 0).all(axis=1))
        if len(fits):
            if rule == "norm":
                at = fits[((left[fits] / full) ** 2 @ w).argmin()]
            else:
                at = fits[((room[fits] / full) @ (w * need / full)).argmax()]
        else:
            at, room[opened], name[opened] = opened, full, made
            opened, made = opened + 1, made + 1
        bins[i], offsets[i] = name[at], capacity - room[at, 0]
        room[at] -= need
        if room[at, 0] < least or room[at, 1] < 1 or room[at, 2] < float(least) ** 2:  # nothing fits any more
            opened -= 1
            room[at], name[at] = room[opened], name[opened]
    return bins, offsets


def pack(parts: DataFrame, capacity: int = CAPACITY, max_documents: int | None = None, task_pieces: int = TASK_PIECES, **limits) -> DataFrame:
    """Adds sequence_id and offset to a table of pieces with a column ``length``; other columns stay.

    Pieces are dealt to tasks of about ``task_pieces`` and packed there. The sequences that a task
    leaves less than OPEN_SHARE full are taken apart and dealt again to fewer tasks, until they fit
    one task or no longer grow fewer, so that the loss does not grow with the number of tasks.
    ``max_documents`` defaults to twice the mean number of pieces of a full sequence of the whole
    table, MIN_DOCUMENTS at least: it stops sequences of tiny pieces alone, and costs none overall.
    ``limits`` go to best_fit. Null lengths are an error; repeated rows are packed each; an empty
    table gives an empty one. The columns sequence_id and offset of the input, if any, are replaced.
    """
    parts = checkpoint(parts.drop("sequence_id", "offset"))
    total = parts.agg(F.count(F.lit(1)).alias("n"), F.sum("length").alias("tokens")).first()
    if max_documents is None:
        max_documents = max(MIN_DOCUMENTS, -(-2 * total.n * capacity // (total.tokens or 1)))
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in parts.schema)
    (still_open,) = free_names(parts, "open")
    done: list[DataFrame] = []
    tasks = max(1, -(-total.n // task_pieces))
    while True:

        def run(batches: Iterator[pa.RecordBatch], turn: int = len(done)) -> Iterator[pa.RecordBatch]:
            got = list(batches)
            if got:
                t = pa.Table.from_batches(got).combine_chunks()
                lengths = t["length"].to_numpy()
                where, offsets = best_fit(lengths, capacity, max_documents, **limits)
                first = turn << 56 | TaskContext.get().partitionId() << 24
                t = t.append_column("sequence_id", pa.array(where + first)).append_column("offset", pa.array(offsets))
                yield from t.append_column(still_open, pa.array((np.bincount(where, lengths) < OPEN_SHARE * capacity)[where])).to_batches(max_chunksize=10_000)

        packed = checkpoint(parts.repartition(tasks).mapInArrow(released(run), f"{columns}, sequence_id bigint, offset bigint, `{still_open}` boolean"))
        still = packed.where(still_open).count() if tasks > 1 else 0
        fewer = -(-still // task_pieces)
        if not still or fewer > tasks // 2:
            return reduce(DataFrame.unionByName, [*done, packed.drop(still_open)])
        done.append(packed.where(~F.col(still_open)).drop(still_open))
        parts, tasks = packed.where(still_open).drop("sequence_id", "offset", still_open), fewer


def pack_documents(docs: DataFrame, path: str, id_col: str = "doc_id", text: str = "text", capacity: int = CAPACITY, **limits) -> DataFrame:
    """Packs every document: (id, piece, start, length, ids_crc32, sequence_id, offset).

    A null text is empty and gives one piece that holds the end id alone. Repeated rows and ties
    are packed each; an empty table gives an empty one; other columns are not read. ``limits`` go
    to pack.
    """
    return pack(pieces(docs, path, capacity=capacity, id_col=id_col, text=text), capacity, **limits)
