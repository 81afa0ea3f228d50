"""SimHash near-deduplication over an inverted index of fingerprint bytes.

Fingerprints that differ in 3 bits or fewer differ in 3 bytes or fewer, so of their 8 bytes at least
5 agree at the same position, and at least 3 of these lie in one half. A posting of the index is
therefore a choice of three positions of a half and the bytes there: eight postings a fingerprint.
Within a posting the agreeing bytes of each pair are tallied; pairs below 5 are passed over and the
others verified bit by bit. Pairs never become rows: a posting gives at most one link per member.

Postings with more members than one task should compare are split further, by two more agreeing
positions. Of these 5 positions are fixed, so members differ in 24 bits only, and their neighbours
are looked up instead of compared. Both ways find the same links.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.llm.components import components, roots
from tidemark.llm.stage import Run

WORDS = 3
SEED = 42
MAX_BITS = 3
MIN_BYTES = 8 - MAX_BITS
#: Members of a posting that are compared with each other; larger ones are split by two more bytes.
COMPARED = 4096
#: Hashes whose bits are counted at a time.
BLOCK = 1 << 16

_HALVES = (range(4), range(4, 8))
TRIPLES = [t for half in _HALVES for t in combinations(half, 3)]
_FINGERPRINTS = pa.schema([("doc_id", pa.int64()), ("fp", pa.int64())])
_LINKS = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def fingerprint(text: str | None) -> int:
    """64 bits, each set where over half of the shingle hashes have it; 0 without words."""
    words = (text or "").encode().lower().split()  # of bytes: A-Z only, and white space as in ASCII
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    n = max(1, len(words) - WORDS + 1)
    first, last = starts[:n].tolist(), ends[min(WORDS, len(words)) - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(joined[i:j], SEED) for i, j in zip(first, last)), np.uint64, n)
    counts = np.zeros(64, np.int64)
    for at in range(0, n, BLOCK):
        bits = np.unpackbits(hashes[at : at + BLOCK].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > n, bitorder="little").view("<u8")[0])


def _fingerprint_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        values = np.fromiter((fingerprint(x.as_py()) for x in batch.column("text")), np.uint64, batch.num_rows)
        yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), pa.array(values.view(np.int64))], schema=_FINGERPRINTS)


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, fp (the 64 bits as a signed BIGINT) of each row of ``docs``."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(_fingerprint_batches, "doc_id long, fp long")


def _byte(fp: Column, i: int) -> Column:
    return F.shiftrightunsigned(fp, 8 * i).bitwiseAND(F.lit(255))


def _packed(fp: Column, positions: tuple[int, ...]) -> Column:
    out = F.lit(0).cast("long")
    for i in positions:
        out = F.shiftleft(out, 8).bitwiseOR(_byte(fp, i))
    return out


def _postings(fp: Column) -> Column:
    """Three bytes of a half, and which ones they are."""
    return F.array(*(_packed(fp, t).bitwiseOR(F.lit(i << 24)) for i, t in enumerate(TRIPLES)))


def _split(fp: Column, key: Column) -> Column:
    """The posting's bytes and two more, for every choice of two."""
    out = F.array().cast("array<long>")
    which = F.shiftright(key, 24)
    for i, triple in enumerate(TRIPLES):
        more = list(combinations([p for p in range(8) if p not in triple], 2))
        keys = F.array(*(_packed(fp, triple + pair).bitwiseOR(F.lit((1 << 62) | ((i * len(more) + j) << 40))) for j, pair in enumerate(more)))
        out = F.when(which == i, keys).otherwise(out)
    return out


def _compared(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of positions in ``fps`` that link, each with the other once."""
    a, b = [], []
    step = max(1, (1 << 20) // len(fps))
    for at in range(0, len(fps), step):
        differ = fps[at : at + step, None] ^ fps[None, :]
        agreeing = (differ.view(np.uint8).reshape(*differ.shape, 8) == 0).sum(axis=2)
        i, j = np.nonzero(agreeing >= MIN_BYTES)
        near = (np.bitwise_count(differ[i, j]) <= MAX_BITS) & (i + at < j)
        a.append(i[near] + at)
        b.append(j[near])
    return np.concatenate(a), np.concatenate(b)


def _looked_up(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """As ``_compared``, by looking up each way to flip 1 to 3 of the bits in which ``fps`` differ."""
    varying = np.bitwise_or.reduce(fps ^ fps[0])
    bits = [np.uint64(1 << i) for i in range(64) if int(varying) >> i & 1]
    order = np.argsort(fps)
    ordered, parent = fps[order], np.arange(len(fps))
    for size in range(1, MAX_BITS + 1):
        for chosen in combinations(bits, size):
            flipped = fps ^ np.bitwise_or.reduce(np.array(chosen))
            at = np.minimum(np.searchsorted(ordered, flipped), len(fps) - 1)
            found = np.nonzero(ordered[at] == flipped)[0]
            if len(found):  # merged at once, so that memory follows the members and not the links
                label = roots(len(fps), np.concatenate((np.arange(len(fps)), found)), np.concatenate((parent, order[at[found]])))
                parent = label
    return np.arange(len(fps)), parent


def links(fps: np.ndarray, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each member of a posting that links to others, its node and the node of its group there."""
    varying = int(np.bitwise_count(np.bitwise_or.reduce(fps ^ fps[0])))
    a, b = _looked_up(fps) if len(fps) > COMPARED and varying <= 24 else _compared(fps)
    label = roots(len(fps), a, b)
    moved = np.nonzero(label != np.arange(len(fps)))[0]
    return nodes[moved], nodes[label[moved]]


def _posting_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by key; a posting may go over several batches."""
    held: list[tuple[np.ndarray, np.ndarray]] = []
    held_key = None

    def closed() -> Iterator[pa.RecordBatch]:
        fps = np.concatenate([f for f, _ in held])
        if len(fps) > 1:
            a, b = links(fps, np.concatenate([n for _, n in held]))
            if len(a):
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], schema=_LINKS)

    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column("key").to_numpy()
        fps, nodes = batch.column("fp").to_numpy().view(np.uint64), batch.column("node").to_numpy()
        cuts = np.concatenate(([0], np.nonzero(np.diff(keys))[0] + 1, [len(keys)])).tolist()
        for i, j in zip(cuts, cuts[1:]):
            if held and keys[i] != held_key:
                yield from closed()
                held.clear()
            held_key = keys[i]
            held.append((fps[i:j], nodes[i:j]))
    if held:
        yield from closed()


def linked(fps: DataFrame) -> DataFrame:
    """Links (a, b) between nodes of different fingerprints (fp, node) 3 bits apart or less.

    Not every such pair is named, but all pairs are joined by links.
    """
    postings = fps.select(F.explode(_postings(F.col("fp"))).alias("key"), "fp", "node")
    sizes = postings.groupBy("key").agg(F.count("*").alias("size")).where("size > 1")
    shared = postings.join(sizes, "key")
    keys = F.when(F.col("size") <= COMPARED, F.array("key")).otherwise(_split(F.col("fp"), F.col("key")))
    members = shared.select(F.explode(keys).alias("key"), "fp", "node")
    return members.repartition("key").sortWithinPartitions("key").mapInArrow(_posting_batches, "a long, b long")


def near_duplicates(run: Run, docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id, one row per row of ``docs``.

    * Texts without words (NULL, empty, white) have fingerprint 0 and are linked like any other.
    * Shorter texts than three words are one shingle, their whole sequence of words.
    * Equal fingerprints are one node, so copies cost nothing beyond being read, however many.
    * A bit set in exactly half of the hashes is 0.
    * component_id is the smallest doc_id reachable. A row without doc_id has the component of its
      fingerprint, or NULL where no row with an id has that fingerprint; it makes no links.
    * Repeated rows give repeated rows, an empty table none; other columns are not read.
    """
    seen = run.written(fingerprints(docs), "fingerprints")
    nodes = seen.where("doc_id IS NOT NULL").groupBy("fp").agg(F.min("doc_id").alias("node"))
    named = run.written(nodes, "nodes")
    parts = components(run, run.written(linked(named), "links"))
    of_fp = named.join(parts, "node", "left").select("fp", F.coalesce("root", "node").alias("component_id"))
    out = seen.join(of_fp, "fp", "left")
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def kept(run: Run, docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose id names their component, with all columns; rows without one stay."""
    found = near_duplicates(run, docs).where("doc_id = component_id OR component_id IS NULL")
    stay = run.written(found.select("doc_id").distinct(), "kept")
    return docs.join(stay, docs["doc_id"].eqNullSafe(stay["doc_id"]), "left_semi")


def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(Run(spark, "op7"), spark.read.parquet(f"{sf_dir}/documents.parquet"))
