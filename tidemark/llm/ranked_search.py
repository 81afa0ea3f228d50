"""The documents that score highest for each item of a query table, by best positions.

Documents are packed into shards: for each document its length and how often it has each query term.
From all shards come the counts that weigh the terms. In a shard every term then has an impact list,
highest first. An item's lists are read downwards together; each document met is looked up in all of
them at once (direct access), which also tells its places there. A list's best position is the last
place up to which all have been seen, by reading or by looking up. No document still unseen can score
more than the impacts at the best positions together, and reading stops once that sum is strictly
below the k-th best score, which leaves no tie out.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tidemark.llm.stage import Run

BEST = 10
#: Documents, and entries of impact lists, from which on a shard is closed.
SHARD_DOCS, SHARD_ENTRIES = 1 << 15, 1 << 22
#: Bytes of item texts whose terms a task holds at once. More items are served in several passes.
ITEM_BYTES = 8 << 20
#: Places of each list read in the first round; every round reads twice as many as the one before.
FIRST_READ = 16

# Fixed values of the score: scale of weights, gain and damping of term counts, share of length.
WEIGHT_SCALE, GAIN, COUNT_SCALE, DAMPING, LENGTH_SHARE = 1000, 1_000_000_000, 1000, 8, 90

# A term is a run of letters and digits of ASCII, A-Z lower-cased, and of all that is beyond ASCII.
_TERM_BYTES = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)

_SHARDS = "n_docs long, n_terms long, doc_ids binary, lengths binary, ends binary, terms binary, counts binary"
_DF = "term int, df long"
_FOUND = "item_id long, doc_id long, score long"


def terms(text: str | bytes | None) -> list[bytes]:
    raw = text.encode() if isinstance(text, str) else text or b""
    return raw.translate(_TERM_BYTES).split()


def ranges(starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The numbers from each start to before its end, one after the other."""
    sizes = ends - starts
    return np.arange(sizes.sum()) + np.repeat(starts - np.cumsum(sizes) + sizes, sizes)


def shards(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """Documents with at least one term, by shard: of each its length and the query terms it has."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n_docs = n_terms = 0
        ids: list[int] = []
        lengths: list[int] = []
        ends: list[int] = []
        which: list[int] = []
        counts: list[int] = []

        def closed() -> pa.RecordBatch:
            packed = [np.array(x, kind).tobytes() for x, kind in ((ids, "<i8"), (lengths, "<i8"), (ends, "<i8"), (which, "<u4"), (counts, "<u4"))]
            names = [x.split()[0] for x in _SHARDS.split(", ")]
            kinds = [pa.int64()] * 2 + [pa.binary()] * 5
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip([n_docs, n_terms, *packed], kinds)], names)

        for batch in batches:
            for doc_id, raw in zip(batch.column("doc_id").to_pylist(), batch.column("text").cast(pa.binary())):
                found = terms(raw.as_py())
                if not found:
                    continue
                n_docs += 1
                n_terms += len(found)
                mine = Counter(map(vocabulary.get, found))
                mine.pop(None, None)
                if mine:
                    ids.append(-1 if doc_id is None else doc_id)
                    lengths.append(-len(found) if doc_id is None else len(found))
                    which += mine.keys()
                    counts += mine.values()
                    ends.append(len(which))
                if len(ids) >= SHARD_DOCS or len(which) >= SHARD_ENTRIES:
                    yield closed()
                    n_docs = n_terms = 0
                    for held in (ids, lengths, ends, which, counts):
                        held.clear()
        if n_docs:
            yield closed()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(pack, _SHARDS)


def _document_frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for raw in batch.column("terms"):
            seen, n = np.unique(np.frombuffer(raw.as_py(), "<u4"), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(seen.astype(np.int32)), pa.array(n, pa.int64())], ["term", "df"])


class Lists:
    """The impact lists of a shard, and of each document its places in them."""

    def __init__(self, doc_ids: np.ndarray, ends: np.ndarray, which: np.ndarray, impacts: np.ndarray, n_terms: int):
        self.doc_ids, self.doc_ends = doc_ids, ends
        self.doc_starts = np.concatenate(([0], ends[:-1]))
        self.which = which
        order = np.lexsort((-impacts, which))
        self.impacts = impacts[order]
        self.docs = np.repeat(np.arange(len(doc_ids)), ends - self.doc_starts)[order]
        self.places = np.empty(len(order), np.int64)  # of a document's entries, in its order
        self.places[order] = np.arange(len(order))
        self.ends = np.cumsum(np.bincount(which, minlength=n_terms))
        self.starts = np.concatenate(([0], self.ends[:-1]))
        self.wanted = np.zeros(n_terms, bool)
        self.seen = np.zeros(len(order), bool)
        self.met = np.zeros(len(doc_ids), bool)

    def best(self, of: np.ndarray, k: int, floor: int = 0) -> tuple[np.ndarray, np.ndarray]:
        """doc_ids and scores of the k best for the terms ``of``, ties by smaller doc_id.

        Documents below ``floor``, a k-th best score known already, may be left out.
        """
        of = of[self.ends[of] > self.starts[of]]
        ids, scores = np.zeros(0, np.int64), np.zeros(0, np.int64)
        starts, ends = self.starts[of], self.ends[of]
        self.wanted[of] = True
        best = starts.copy()  # the first place not seen
        read, step = 0, FIRST_READ
        visited = []
        while len(of) and read < (ends - starts).max():
            near = self.docs[ranges(np.minimum(starts + read, ends), np.minimum(starts + read + step, ends))]
            read, step = read + step, step * 2
            new = np.unique(near[~self.met[near]])
            if len(new):
                self.met[new] = True
                visited.append(new)
                entries = ranges(self.doc_starts[new], self.doc_ends[new])
                mine = self.wanted[self.which[entries]]
                places = self.places[entries]
                self.seen[places[mine]] = True
                sums = np.concatenate(([0], np.cumsum(np.where(mine, self.impacts[places], 0))))
                upto = np.cumsum(self.doc_ends[new] - self.doc_starts[new])
                ids = np.concatenate((ids, self.doc_ids[new]))
                scores = np.concatenate((scores, sums[upto] - sums[np.concatenate(([0], upto[:-1]))]))
                first = np.lexsort((ids, -scores))[:k]
                ids, scores = ids[first], scores[first]
            threshold = 0
            for i in range(len(of)):
                left = self.seen[best[i] : ends[i]]
                ahead = int(left.argmin()) if len(left) else 0
                best[i] += len(left) if len(left) and left[ahead] else ahead
                if best[i] < ends[i]:
                    threshold += int(self.impacts[best[i] - 1])
            if threshold < max(floor, int(scores[-1]) if len(scores) == k else 0):
                break
        self.wanted[of] = False
        for some in visited:
            self.met[some] = False
        self.seen[ranges(starts, ends)] = False
        some = scores > 0
        return ids[some], scores[some]


def _item_blocks(items: DataFrame) -> Iterator[list[tuple[int, set[bytes]]]]:
    """Items with their terms, so many at a time as their texts take ITEM_BYTES about; rows of one id together."""
    rows = items.where("item_id IS NOT NULL AND text IS NOT NULL").select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    held: dict[int, set[bytes]] = {}
    size = 0
    for row in rows.orderBy("item_id").toLocalIterator():
        if size > ITEM_BYTES and row.item_id not in held:
            yield list(held.items())
            held, size = {}, 0
        held.setdefault(row.item_id, set()).update(terms(row.text))
        size += len(row.text)
    if held:
        yield list(held.items())


def ranked(run: Run, docs: DataFrame, items: DataFrame, k: int = BEST) -> DataFrame:
    """item_id, rank (from 1), doc_id, score: the k documents of highest score for each item.

    * Equal scores go by the smaller doc_id; only scores above 0 count. Items may have fewer than k.
    * NULL and empty texts, and texts without a term, are no documents: they do not count in any total.
    * Rows without doc_id count in the totals and are not ranked. Rows that repeat a doc_id are
      documents of their own.
    * Rows of one item_id are one item, with the terms of all; items without id or term have no rows.
    * Any length; empty tables give no rows; other columns are not read.
    """
    found = [_ranked(run, docs, block, k, f"shards-{i}") for i, block in enumerate(_item_blocks(items))]
    out = run.spark.createDataFrame([], _FOUND) if not found else found[0]
    for more in found[1:]:
        out = out.union(more)
    best = out.withColumn("rank", F.row_number().over(Window.partitionBy("item_id").orderBy(F.desc("score"), "doc_id")))
    return best.where(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")


def _ranked(run: Run, docs: DataFrame, items: list[tuple[int, set[bytes]]], k: int, name: str) -> DataFrame:
    """The k best of each item in what each task read."""
    vocabulary = {t: i for i, t in enumerate(sorted(set().union(*(t for _, t in items))))}
    asked = [(item_id, np.array(sorted(vocabulary[t] for t in some), np.int64)) for item_id, some in items if some]
    packed = run.written(shards(docs, vocabulary), name)
    n, total = packed.agg(F.coalesce(F.sum("n_docs"), F.lit(0)), F.coalesce(F.sum("n_terms"), F.lit(0))).first()
    if not n:
        return run.spark.createDataFrame([], _FOUND)
    # One number per term of the items comes to the driver.
    counted = packed.select("terms").mapInArrow(_document_frequencies, _DF).groupBy("term").agg(F.sum("df").alias("df"))
    weights = np.zeros(len(vocabulary), np.int64)
    for r in counted.toLocalIterator():
        weights[r.term] = math.floor(WEIGHT_SCALE * math.log((2 * n + 2) / (2 * r.df + 1)))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tops: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            for row in zip(*(batch.column(c) for c in ("doc_ids", "lengths", "ends", "terms", "counts"))):
                doc_ids, lengths, ends, which, counts = (np.frombuffer(x.as_py(), kind) for x, kind in zip(row, ("<i8", "<i8", "<i8", "<u4", "<u4")))
                if not len(doc_ids):
                    continue
                counts = counts.astype(np.int64)
                measure = 100 - LENGTH_SHARE + (LENGTH_SHARE * np.abs(lengths) * n) // total
                damped = (GAIN * counts) // (COUNT_SCALE * counts + DAMPING * np.repeat(measure, np.diff(ends, prepend=0)))
                ranked_docs = lengths > 0  # those without an id have no impact
                impacts = weights[which] * damped * np.repeat(ranked_docs, np.diff(ends, prepend=0))
                lists = Lists(doc_ids, ends, which.astype(np.int64), impacts, len(weights))
                for item_id, of in asked:
                    ids, scores = tops.get(item_id, (np.zeros(0, np.int64), np.zeros(0, np.int64)))
                    more, values = lists.best(of, k, int(scores[-1]) if len(scores) == k else 0)
                    ids, scores = np.concatenate((ids, more)), np.concatenate((scores, values))
                    first = np.lexsort((ids, -scores))[:k]
                    tops[item_id] = ids[first], scores[first]
        for item_id, (ids, scores) in tops.items():
            columns = [pa.array(np.full(len(ids), item_id)), pa.array(ids), pa.array(scores)]
            yield pa.RecordBatch.from_arrays(columns, [x.split()[0] for x in _FOUND.split(", ")])

    return packed.select("doc_ids", "lengths", "ends", "terms", "counts").mapInArrow(search, _FOUND)


def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = lambda name: spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return ranked(Run(spark, "op12"), read("documents"), read("benchmark"))


OP12_SQL = r"""
WITH words AS (
  SELECT doc_id, UNNEST(regexp_extract_all(
           translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM documents
), asked AS (
  SELECT DISTINCT item_id, term FROM (
    SELECT item_id, UNNEST(regexp_extract_all(
             translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM benchmark)
), totals AS (
  SELECT COUNT(DISTINCT doc_id) AS n_docs, COUNT(*) AS n_terms FROM words
), lengths AS (
  SELECT doc_id, COUNT(*) AS n FROM words GROUP BY doc_id
), entries AS (
  SELECT doc_id, term, COUNT(*) AS tf FROM words SEMI JOIN asked USING (term) GROUP BY doc_id, term
), weights AS (
  SELECT term, CAST(FLOOR(1000 * LN((2 * n_docs + 2) / CAST(2 * COUNT(*) + 1 AS DOUBLE))) AS BIGINT) AS w
  FROM entries, totals GROUP BY term, n_docs
), scores AS (
  SELECT item_id, doc_id,
         CAST(SUM(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * n_docs) // n_terms)))) AS BIGINT) AS score
  FROM asked JOIN entries USING (term) JOIN weights USING (term) JOIN lengths USING (doc_id), totals
  GROUP BY item_id, doc_id
), ranked AS (
  SELECT *, CAST(ROW_NUMBER() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank
  FROM scores WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10
"""
