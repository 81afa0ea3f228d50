"""Byte-level BPE in numpy: encoding by rank files, and decoding.

Distinct matches of the split pattern become rows of padded matrices, one per range of lengths.
In each round every row merges its leftmost pair of minimum rank: ranks of neighbouring pairs are
looked up in a hash table, the merged cell is closed up, and rows without a pair left are put aside.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.llm.chunks import Encoder

RANKS = "byte_bpe_50k.tiktoken"
#: Upper bounds of the row lengths of one matrix. A round costs as much as a row is long, so rows
#: beyond the last bound go through a heap instead.
LENGTHS = (4, 8, 12, 16, 24, 32, 64, 256)
#: Cells of one matrix at most.
CELLS = 1 << 21

_NONE = np.int32(2**31 - 1)
_MIX = np.uint64(0x9E3779B97F4A7C15)
_RESULT = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


class PairTable:
    """The rank of each pair of tokens whose bytes together are a token: open addressing, in numpy."""

    def __init__(self, ranks: dict[bytes, int]):
        self.vocabulary = np.uint64(max(ranks.values()) + 1)
        keys, values = [], []
        for token, rank in ranks.items():
            for i in range(1, len(token)):
                a, b = ranks.get(token[:i]), ranks.get(token[i:])
                if a is not None and b is not None:
                    keys.append(a * int(self.vocabulary) + b)
                    values.append(rank)
        self.bits = max(4, (4 * len(keys)).bit_length())
        self.keys = np.full(1 << self.bits, np.uint64(2**64 - 1))
        self.values = np.full(1 << self.bits, _NONE)
        self.by_pair = dict(zip(keys, values))
        waiting, ranks_of = np.array(keys, np.uint64), np.array(values, np.int32)
        self.probes, at = 0, self._slot(waiting)
        while len(waiting):  # all pairs move on to their next slot together until each has one
            self.probes += 1
            free = self.keys[at] == np.uint64(2**64 - 1)
            self.keys[at[free]] = waiting[free]
            placed = self.keys[at] == waiting
            self.values[at[placed]] = ranks_of[placed]
            waiting, ranks_of, at = waiting[~placed], ranks_of[~placed], (at[~placed] + 1) & ((1 << self.bits) - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * _MIX) >> np.uint64(64 - self.bits)).astype(np.int64)

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each pair, or a number above all ranks."""
        keys = left.astype(np.uint64) * self.vocabulary + right.astype(np.uint64)
        at = self._slot(keys)
        out = np.where(self.keys[at] == keys, self.values[at], _NONE)
        open_ = np.nonzero((out == _NONE) & (self.keys[at] != np.uint64(2**64 - 1)))[0]
        at, keys = at[open_], keys[open_]
        for _ in range(self.probes - 1):
            if not len(open_):
                break
            at = (at + 1) & ((1 << self.bits) - 1)
            out[open_] = np.where(self.keys[at] == keys, self.values[at], _NONE)
            going = (self.keys[at] != keys) & (self.keys[at] != np.uint64(2**64 - 1))
            open_, at, keys = open_[going], at[going], keys[going]
        return out


class ByteBPE(Encoder):
    """Ids as the rank file gives them for each match of the pattern, and their bytes."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        super().__init__()
        self.pairs = PairTable(ranks)
        self.pattern = regex.compile(pattern)
        self.single = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        tokens = [b""] * int(self.pairs.vocabulary)
        for token, rank in ranks.items():
            tokens[rank] = token
        self.lengths = np.array([len(t) for t in tokens])
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.bytes = np.frombuffer(b"".join(tokens), np.uint8)

    def learn(self, cut: list[list[str]]) -> None:
        """All new pieces of a batch together, so that the matrices have many rows."""
        for known, before, wanted in (
            (self.first, "", {x[0] for x in cut}),
            (self.later, " ", set(chain.from_iterable([x[1:] for x in cut]))),
        ):
            new = known.unknown(wanted)
            matches = [self.pattern.findall(before + x) for x in new]
            words = list({w for m in matches for w in m})
            ids = dict(zip(words, self.merged([w.encode() for w in words])))
            known.update(zip(new, [b"".join([ids[w] for w in m]) for m in matches]))

    def merged(self, words: list[bytes]) -> list[bytes]:
        """The ids of each word, which is not split any further."""
        out: list[bytes] = [b""] * len(words)
        lengths = np.array([len(w) for w in words], np.int64)
        low = 0
        for bound in LENGTHS:
            rows = np.nonzero((lengths > low) & (lengths <= bound))[0]
            step = max(1, CELLS // bound)
            for at in range(0, len(rows), step):
                self._matrix(words, rows[at : at + step], lengths, bound, out)
            low = bound
        for row in np.nonzero(lengths > low)[0].tolist():
            out[row] = self._long(words[row])
        return out

    def _matrix(self, words: list[bytes], rows: np.ndarray, lengths: np.ndarray, width: int, out: list[bytes]) -> None:
        n, left = lengths[rows], rows
        flat = np.frombuffer(b"".join([words[r] for r in rows.tolist()]), np.uint8)
        columns = np.arange(width)
        inside = columns < n[:, None]
        ids = np.zeros((len(rows), width), np.int32)
        ids[inside] = self.single[flat]
        ranks = np.full((len(rows), width), _NONE)
        pair = columns + 1 < n[:, None]
        ranks[pair] = self.pairs.ranks(ids[pair], np.roll(ids, -1, axis=1)[pair])
        while len(left):
            at = ranks.argmin(axis=1)
            every = np.arange(len(left))
            best = ranks[every, at]
            done = best == _NONE
            if done.any():
                for row, cells, count in zip(left[done].tolist(), ids[done].astype("<u4"), n[done].tolist()):
                    out[row] = cells[:count].tobytes()
                going = ~done
                left, ids, ranks, n, at, best = left[going], ids[going], ranks[going], n[going], at[going], best[going]
                every = np.arange(len(left))
                if not len(left):
                    break
            ids[every, at] = best
            source = columns + (columns > at[:, None])  # what stood right of the pair moves up by one
            source[:, -1] = width - 1
            ids = np.take_along_axis(ids, source, axis=1)
            ranks = np.take_along_axis(ranks, source, axis=1)
            n = n - 1
            ranks[every, np.minimum(n - 1, width - 1)] = _NONE
            ranks[every, np.minimum(n, width - 1)] = _NONE
            for side in (at - 1, at):  # the merged token's new neighbours
                has = (side >= 0) & (side + 1 < n)
                r, c = every[has], side[has]
                ranks[r, c] = self.pairs.ranks(ids[r, c], ids[r, c + 1])

    def _long(self, word: bytes) -> bytes:
        """The same merges, leftmost of minimum rank first, from a heap of pairs."""
        ids = self.single[np.frombuffer(word, np.uint8)].tolist()
        n, size, pairs = len(ids), int(self.pairs.vocabulary), self.pairs.by_pair
        following, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i, ids[i], ids[i + 1]) for i in range(n - 1) if (r := pairs.get(ids[i] * size + ids[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            rank, i, a, b = heapq.heappop(heap)
            j = following[i]
            if ids[i] != a or j >= n or ids[j] != b:
                continue
            ids[i], ids[j] = rank, -1
            following[i] = following[j]
            if following[i] < n:
                before[following[i]] = i
            for x, y in ((before[i], i), (i, following[i])):
                if x >= 0 and y < n and (r := pairs.get(ids[x] * size + ids[y])) is not None:
                    heapq.heappush(heap, (r, x, ids[x], ids[y]))
        return np.array([x for x in ids if x >= 0], "<u4").tobytes()

    def decode(self, ids: bytes) -> bytes:
        """The bytes the ids stand for: one gather from the tokens laid end to end."""
        tokens = np.frombuffer(ids, "<u4")
        lengths = self.lengths[tokens]
        ends = np.cumsum(lengths)
        if not len(ends):
            return b""
        return self.bytes[np.arange(ends[-1]) + np.repeat(self.starts[tokens] - ends + lengths, lengths)].tobytes()


@lru_cache(maxsize=2)
def from_file(path: str, pattern: str = public_tokenizers.PATTERN) -> ByteBPE:
    """One per worker and file. The file has a token in base 64 and its rank on each line."""
    with open(path, "rb") as file:
        lines = [line.split() for line in file if line.strip()]
    return ByteBPE({base64.b64decode(token): int(rank) for token, rank in lines}, pattern)


def text_batches(batches: Iterator[pa.RecordBatch], rows: int = 512) -> Iterator[tuple[pa.Array, list[str]]]:
    """doc_id and text of some rows at a time; NULL is empty."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            some = batch.slice(at, rows)
            yield some.column("doc_id"), [x or "" for x in some.column("text").to_pylist()]


def plain_rows(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def encoded(docs: DataFrame, path: str, pattern: str = public_tokenizers.PATTERN) -> DataFrame:
    """doc_id, ids (little-endian unsigned 32-bit integers) of each whole text of ``docs``.

    * NULL and empty texts have no ids; no special token is ever made.
    * Repeated rows give repeated rows, an empty table none; other columns are not read.
    * Any length: a word of 257 bytes or more takes n log n steps.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts in text_batches(batches):
            yield pa.RecordBatch.from_arrays([ids, pa.array(from_file(path, pattern).encode(texts), pa.large_binary()).cast(pa.binary())], ["doc_id", "ids"])

    return plain_rows(docs).mapInArrow(run, "doc_id long, ids binary")


def round_trip(docs: DataFrame, path: str, pattern: str = public_tokenizers.PATTERN) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256: what ``encoded`` gives, decoded again.

    One pass; only digests leave the task. Cases as for ``encoded``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts in text_batches(batches):
            bpe = from_file(path, pattern)
            codes = bpe.encode(texts)
            columns = [ids, pa.array([len(x) // 4 for x in codes], pa.int64())]
            columns.append(pa.array([hashlib.sha256(x).hexdigest() for x in codes], pa.string()))
            columns.append(pa.array([hashlib.sha256(bpe.decode(x)).hexdigest() for x in codes], pa.string()))
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return plain_rows(docs).mapInArrow(run, _RESULT)


def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(spark.read.parquet(f"{sf_dir}/documents.parquet"), public_tokenizers.path(RANKS))
