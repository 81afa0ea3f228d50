"""Packing documents into sequences by the sum-of-squares rule.

A piece goes where the sum over all gaps of the squared number of open sequences with that gap
becomes smallest. Only the counts per gap are needed to decide, so a step costs one look over the
gaps whatever the number of sequences. Pieces are dealt out at random to groups of a bounded size,
each packed by one task. A group wastes a few of its tens of thousands of sequences, so many groups
waste the same small share as one.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.llm.byte_bpe import text_batches
from tidemark.llm.chunks import library_encoder
from tidemark.llm.stage import Run

TOKENIZER = "byte_bpe_50k.json"
CAPACITY = 2048
END = 0
#: Pieces of a group on average: one task packs them in seconds, in a few MB.
GROUP = 50_000
#: Pieces of up to this part of a sequence count as short.
SHORT = 8

_PIECES = "row long, doc_id long, piece int, start long, length long, ids_crc32 long"


def order(lengths: np.ndarray, capacity: int, seed: int) -> np.ndarray:
    """Long pieces from the longest on, then the short ones at random.

    Long ones fit few gaps, so they come first; short ones in the order of their length would fill
    the same gaps again and again, while at random they find a use for each.
    """
    longest = np.argsort(-lengths, kind="stable")
    n = int((lengths > capacity // SHORT).sum())
    return np.concatenate((longest[:n], np.random.default_rng(seed).permutation(longest[n:])))


def sum_of_squares(lengths: np.ndarray, capacity: int, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """The sequence (from 0) and the offset in it of each piece.

    Among equal sums the smallest gap is filled, and an open sequence goes before a new one.
    """
    sequence, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    counts = np.zeros(capacity + 1, np.int64)  # open sequences by gap; full ones do not count
    waiting: list[list[int]] = [[] for _ in range(capacity + 1)]
    opened = 0
    for i in order(lengths, capacity, seed).tolist():
        size = int(lengths[i])
        change = 2 * (counts[: capacity + 1 - size] - counts[size:] + 1)  # by gap, from the exact fit on
        change[0] = 1 - 2 * counts[size]
        change[counts[size:] == 0] = np.iinfo(np.int64).max
        change[-1] = 2 * counts[capacity - size] + 1 if size < capacity else 0  # a new one
        gap = int(change.argmin()) + size
        if gap == capacity:
            place, opened = opened, opened + 1
        else:
            place = waiting[gap].pop()
            counts[gap] -= 1
        sequence[i], offset[i] = place, capacity - gap
        if gap > size:
            counts[gap - size] += 1
            waiting[gap - size].append(place)
    return sequence, offset


def pieces(docs: DataFrame, path: str, capacity: int = CAPACITY, end: int | None = END) -> DataFrame:
    """The documents' ids, with ``end`` appended, cut where a document is longer than ``capacity``.

    row, doc_id, piece (from 0), start, length, ids_crc32. All pieces of a long document but the first
    have full length. ``row`` tells repeated rows apart; it is fixed once this has been written. A
    document without any id has no piece, which only happens where ``end`` is None.
    """
    tail = b"" if end is None else np.array([end], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for _, texts in text_batches([batch]):
                found = []
                for k, code in enumerate(library_encoder(path).encode(texts), at):
                    raw = memoryview(code + tail)
                    stops = list(range((len(raw) // 4 - 1) % capacity + 1, len(raw) // 4 + 1, capacity)) if len(raw) else []
                    starts = [0, *stops[:-1]]
                    found += [(k, p, i, j - i, zlib.crc32(raw[4 * i : 4 * j])) for p, (i, j) in enumerate(zip(starts, stops))]
                at += len(texts)
                columns = [pa.array(c, pa.int64()) for c in zip(*found)] if found else [pa.array([], pa.int64())] * 5
                taken = [batch.column(name).take(columns[0]) for name in ("row", "doc_id")]
                yield pa.RecordBatch.from_arrays([*taken, columns[1].cast(pa.int32()), *columns[2:]], [x.split()[0] for x in _PIECES.split(", ")])

    rows = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("text").cast("string").alias("text"),
    )
    return rows.mapInArrow(run, _PIECES)


def packed(run: Run, docs: DataFrame, path: str, capacity: int = CAPACITY, end: int | None = END, group: int = GROUP) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset: where each piece of ``docs`` goes.

    * NULL and empty texts are the single id ``end``, one piece.
    * Rows that repeat an id, or id and text, are packed as documents of their own.
    * An empty table gives no rows; other columns of ``docs``, whatever their names, are not read.
    * Within a sequence the offsets run from 0 without gaps, and no sequence exceeds ``capacity``.
    """
    found = run.written(pieces(docs, path, capacity, end), "pieces")
    groups = max(1, math.ceil(found.count() / group))

    def pack(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["row", "piece"])
        number = int(rows["pack"].iloc[0])
        sequence, offset = sum_of_squares(rows["length"].to_numpy(), capacity, number)
        return rows.assign(sequence_id=sequence + (number << 40), offset=offset)[["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]]

    dealt = found.withColumn("pack", F.pmod(F.xxhash64("row", "piece"), F.lit(groups)))
    result = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    return dealt.groupBy("pack").applyInPandas(pack, result)


def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return packed(Run(spark, "op5"), docs, public_tokenizers.path(TOKENIZER))
