"""Encoding a corpus with a public byte-level BPE vocabulary.

A text is cut by the vocabulary's pattern; each piece is merged pair by pair, always the leftmost pair of least rank. A segment tree over the piece's byte positions
keeps the least rank of any span, so that the next pair is found from the root and a merge updates three positions, each in logarithmic time: a piece without any
break, however long, takes n log n steps. Pieces repeat all over a corpus, so short ones are kept with their ids in each worker.

Defined cases: null and empty texts give an empty array; blank texts are encoded as they are; strings of special tokens are ordinary text; repeated rows are
encoded each; the other columns of the table stay out of the way, whatever their names.

Scale: one narrow pass without a shuffle: only the id and the text reach Python, in Arrow batches. The vocabulary, whose size is fixed, is broadcast.
"""

from __future__ import annotations

import base64
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

NONE = 1 << 30
#: Pieces up to this many characters are kept with their ids, up to this many pieces in a worker.
KEPT_CHARS, KEPT_PIECES = 64, 400_000


def load_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and ranks of a file with one base64 token and its rank a line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


class PairTree:
    """A segment tree over positions: the least value, and the leftmost place that has it."""

    def __init__(self, values: list[int]):
        self.leaves = 1 << max(len(values) - 1, 1).bit_length()
        self.tree = tree = [NONE] * (2 * self.leaves)
        tree[self.leaves : self.leaves + len(values)] = values
        for i in range(self.leaves - 1, 0, -1):
            left, right = tree[2 * i], tree[2 * i + 1]
            tree[i] = left if left <= right else right

    def least(self) -> int:
        return self.tree[1]

    def leftmost(self) -> int:
        tree, i, least = self.tree, 1, self.tree[1]
        while i < self.leaves:
            i *= 2
            if tree[i] != least:
                i += 1
        return i - self.leaves

    def set(self, at: int, value: int) -> None:
        tree, i = self.tree, at + self.leaves
        tree[i] = value
        i >>= 1
        while i:
            left, right = tree[2 * i], tree[2 * i + 1]
            least = left if left <= right else right
            if tree[i] == least:
                return
            tree[i] = least
            i >>= 1


def merge_piece(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The ids of one piece."""
    n = len(piece)
    if n == 1:
        return [ranks[piece]]
    get = ranks.get
    tree = PairTree([get(piece[i : i + 2], NONE) for i in range(n - 1)])
    # a live part starts at i and ends before after[i], where the next one starts
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    while tree.least() != NONE:
        i = tree.leftmost()
        gone = after[i]
        end = after[i] = after[gone]
        if end < n:
            before[end] = i
            tree.set(i, get(piece[i : after[end]], NONE))
        else:
            tree.set(i, NONE)
        if gone < n - 1:
            tree.set(gone, NONE)
        if i:
            left = before[i]
            tree.set(left, get(piece[left:end], NONE))
    ids, i = [], 0
    while i < n:
        ids.append(ranks[piece[i : after[i]]])
        i = after[i]
    return ids


class Encoder:
    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks, self.cut = ranks, regex.compile(pattern).findall
        self.kept: dict[str, list[int]] = {}

    def _miss(self, piece: str) -> list[int]:
        ids = merge_piece(piece.encode(), self.ranks)
        if len(piece) <= KEPT_CHARS:
            if len(self.kept) >= KEPT_PIECES:
                self.kept.clear()
            self.kept[piece] = ids
        return ids

    def encode(self, text: str | None) -> list[int]:
        if not text:
            return []
        get = self.kept.get
        return list(chain.from_iterable(get(p) or self._miss(p) for p in self.cut(text)))


_ENCODERS: dict[str, Encoder] = {}


def _encoder(token: str, make: Callable[[], Encoder]) -> Encoder:
    """The worker's encoder of a vocabulary; workers are reused and so are the pieces they keep."""
    if token not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[token] = make()
    return _ENCODERS[token]


def vocabulary(df: DataFrame, path: str, pattern: str) -> Callable[[], Encoder]:
    """A function for executors that gives their encoder; executors needn't have the file."""
    ranks = df.sparkSession.sparkContext.broadcast(load_ranks(path))
    token = f"{path}:{len(ranks.value)}:{pattern}"
    return lambda: _encoder(token, lambda: Encoder(ranks.value, pattern))


def encode_corpus(docs: DataFrame, *, key: str, text: str, path: str, pattern: str) -> DataFrame:
    """(key, ids): the ids of every row's text."""
    make = vocabulary(docs, path, pattern)
    kind = docs.schema[key].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = make().encode
        for b in batches:
            found = [encode(t) for t in b.column(1).to_pylist()]
            offsets = np.concatenate([[0], np.cumsum([len(x) for x in found], dtype=np.int64)]).astype(np.int32)
            flat = np.fromiter(chain.from_iterable(found), np.int32, int(offsets[-1]))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))], names=[key, "ids"])

    return docs.select(key, text).mapInArrow(run, T.StructType([T.StructField(key, kind), T.StructField("ids", T.ArrayType(T.IntegerType()))]))


def count_tokens(docs: DataFrame, *, keys: list[str], text: str, path: str, pattern: str) -> DataFrame:
    """(keys..., n_tokens): the ids are counted where they arise and never leave the worker."""
    make = vocabulary(docs, path, pattern)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = make().encode
        for b in batches:
            counts = pa.array([len(encode(t)) for t in b.column(len(keys)).to_pylist()], pa.int64())
            yield pa.RecordBatch.from_arrays([*b.columns[: len(keys)], counts], names=[*keys, "n_tokens"])

    schema = T.StructType([*(docs.schema[k] for k in keys), T.StructField("n_tokens", T.LongType())])
    return docs.select(*keys, text).mapInArrow(run, schema)
