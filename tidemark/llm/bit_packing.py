"""Token ids in blocks of fixed-width bits.

A block holds whole documents. Its layout, little-endian:

    4 bytes  b"TBP1"
    1 byte   bits per id, the fewest that hold every id of the vocabulary
    4 bytes  number of documents
    8 bytes  number of ids
    8 bytes each: the document ids (the smallest number for NULL), then the place of each document's
             first id and, last, the number of ids
    then     the ids, each in so many bits, the lowest bit first, without gaps

Place i starts at bit i * bits, so any range of ids is unpacked without reading those before it.
Blocks are kept in files of a Parquet table by shard and block: its writer commits whole files only,
on any store, and finds a block by its first place without opening the others.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.llm.byte_bpe import plain_rows, text_batches
from tidemark.llm.chunks import library_encoder
from tidemark.llm.stage import Run

TOKENIZER = "word_bpe_49k.json"
END = 2
#: Ids of a block, from which on it is closed after the document at hand.
BLOCK_IDS = 1 << 18

MAGIC = b"TBP1"
_HEAD = struct.Struct("<4sBIQ")
_NULL_ID = -(2**63)
_BLOCKS = "shard int, block int, start long, n_ids long, first_doc long, last_doc long, data binary"
_READ = "doc_id long, start long, n_tokens long, ids_crc32 long"


def width(vocabulary: int) -> int:
    """The fewest bits that hold the ids 0 to vocabulary - 1."""
    return max(1, (vocabulary - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> bytes:
    if bits in (8, 16, 32):
        return ids.astype(f"<u{bits // 8}").tobytes()
    spread = (ids[:, None] >> np.arange(bits, dtype=np.uint32)) & np.uint32(1)
    return np.packbits(spread.astype(np.uint8).ravel(), bitorder="little").tobytes()


def unpack(data: bytes | memoryview, bits: int, start: int, stop: int) -> np.ndarray:
    """The ids at places start to stop - 1 of packed data."""
    if bits in (8, 16, 32):
        return np.frombuffer(data, f"<u{bits // 8}", stop - start, start * bits // 8).astype("<u4")
    low, skip = divmod(start * bits, 8)
    some = np.frombuffer(data, np.uint8, (stop * bits + 7) // 8 - low, low)
    spread = np.unpackbits(some, bitorder="little")[skip : skip + (stop - start) * bits].reshape(-1, bits)
    return (spread.astype("<u4") << np.arange(bits, dtype="<u4")).sum(axis=1, dtype="<u4")


def block(doc_ids: list[int | None], codes: list[bytes], bits: int) -> bytes:
    """A block of documents, each given by its ids as little-endian unsigned 32-bit integers."""
    ids = np.frombuffer(b"".join(codes), "<u4")
    if len(ids) and int(ids.max()) >> bits:
        raise ValueError(f"id {ids.max()} takes more than {bits} bits")
    places = np.cumsum([0, *(len(c) // 4 for c in codes)], dtype="<i8")
    names = np.array([_NULL_ID if i is None else i for i in doc_ids], "<i8")
    return _HEAD.pack(MAGIC, bits, len(codes), len(ids)) + names.tobytes() + places.tobytes() + pack(ids, bits)


class Block:
    """A block's documents; ids are unpacked as they are asked for."""

    def __init__(self, data: bytes):
        magic, self.bits, n, self.n_ids = _HEAD.unpack_from(data)
        if magic != MAGIC:
            raise ValueError("not a block of packed ids")
        at = _HEAD.size
        self.doc_ids = np.frombuffer(data, "<i8", n, at)
        self.places = np.frombuffer(data, "<i8", n + 1, at + 8 * n)
        self.data = memoryview(data)[at + 16 * n + 8 :]

    def ids(self, start: int = 0, stop: int | None = None) -> np.ndarray:
        """The ids at some places, as unsigned 32-bit integers."""
        return unpack(self.data, self.bits, start, self.n_ids if stop is None else stop)

    def document(self, i: int) -> np.ndarray:
        return self.ids(int(self.places[i]), int(self.places[i + 1]))


def write(run: Run, docs: DataFrame, path: str, end: int | None = END) -> DataFrame:
    """Encode ``docs`` by a file of the tokenizers library and write the blocks, in order of doc_id.

    Rows are dealt out by ranges of doc_id and sorted within, so the order of shards and blocks is
    that of doc_id; NULL comes first and rows that repeat an id stand next to each other. ``end`` is
    appended to each document. NULL text is empty; an empty table gives no block.
    """
    bits = width(max(library_encoder(path).vocabulary, (end or 0) + 1))
    tail = b"" if end is None else np.array([end], "<u4").tobytes()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = TaskContext.get().partitionId()
        names: list[int | None] = []
        codes: list[bytes] = []
        number = start = held = 0

        def closed() -> pa.RecordBatch:
            known = [i for i in names if i is not None] or [None]
            values = [shard, number, start, held, known[0], known[-1], block(names, codes, bits)]
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, kinds)], schema=pa.schema(list(zip(labels, kinds))))

        labels = [x.split()[0] for x in _BLOCKS.split(", ")]
        kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
        for ids, texts in text_batches(batches):
            for name, code in zip(ids.to_pylist(), library_encoder(path).encode(texts)):
                names.append(name)
                codes.append(code + tail)
                held += len(codes[-1]) // 4
                if held >= BLOCK_IDS:
                    yield closed()
                    number, start, held = number + 1, start + held, 0
                    names.clear()
                    codes.clear()
        if names:
            yield closed()

    ordered = plain_rows(docs).repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    return run.written(ordered.mapInArrow(encode, _BLOCKS), "blocks")


def read(blocks: DataFrame) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens, ids_crc32 of each document written.

    Starts count from the totals of the shards, of which there are as many as writing tasks.
    """
    totals = {r.shard: r.n for r in blocks.groupBy("shard").agg(F.sum("n_ids").alias("n")).collect()}
    bases, total = {}, 0
    for shard in sorted(totals):
        bases[shard] = total
        total += totals[shard]

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, start, data in zip(*(batch.column(c) for c in ("shard", "start", "data"))):
                found = Block(data.as_py())
                raw, places = memoryview(found.ids().tobytes()), found.places
                crcs = [zlib.crc32(raw[4 * i : 4 * j]) for i, j in zip(places[:-1].tolist(), places[1:].tolist())]
                columns = [pa.array(found.doc_ids, mask=found.doc_ids == _NULL_ID), pa.array(places[:-1] + start.as_py() + bases[shard.as_py()]), pa.array(np.diff(places)), pa.array(crcs, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, [x.split()[0] for x in _READ.split(", ")])

    return blocks.select("shard", "start", "data").mapInArrow(decode, _READ)


def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return read(write(Run(spark, "op10"), docs, public_tokenizers.path(TOKENIZER)))
