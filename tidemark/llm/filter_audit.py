"""How five filters act together, in every order; copies of texts are found by radix tries.

Texts are dealt out by ranges whose bounds are the shortest prefixes that tell neighbouring texts of a
sample apart, so a beginning that many texts share gets longer bounds and not a full partition. In a
range the full texts go into a compressed trie whose terminals hold the smallest id; a walk over the
texts' terminals then tells which rows have a smaller one. Each task first does the same with the
texts it reads, so that of very many copies only one per task and stretch of text travels.

What a document fails is a mask of five bits. Orders are counted from the number of documents by
part, mask and label, which is all that is left of the corpus then.
"""

from __future__ import annotations

import json
from bisect import bisect_right
from collections.abc import Iterator
from itertools import permutations

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.llm.stage import Run

FILTERS = "ABCDE"
#: Bounds of the filters: words at least, distinct and upper-case shares in hundredths.
LEAST_WORDS, DISTINCT_SHARE, UPPER_SHARE = 100, 80, 10
SIGNS = b"#$%&*|"
#: Bytes of texts after which a task's own trie starts anew.
HELD = 64 << 20
#: Ranges per shuffle partition, each with a trie of its own, and sampled texts per range. The sample
#: only places the bounds: it decides how evenly texts are dealt out and nothing else.
RANGES, SAMPLED = 4, 8

_UPPER = bytes(range(65, 91))
_DUPLICATE = 1 << FILTERS.index("E")


class Trie:
    """A compressed trie of byte strings. A node is its edge, its children by first byte, the smallest id."""

    def __init__(self):
        self.root: list = [b"", {}, None]

    def terminal(self, text: bytes) -> list:
        """The node at which a text ends, made if need be."""
        node, at, n = self.root, 0, len(text)
        while at < n:
            child = node[1].get(text[at])
            if child is None:
                new = node[1][text[at]] = [text[at:], {}, None]
                return new
            edge = child[0]
            if not text.startswith(edge, at):
                shared = common_prefix(edge, text, at)
                middle = [edge[:shared], {edge[shared]: child}, None]
                child[0] = edge[shared:]
                node[1][text[at]] = child = middle
            at += len(child[0])
            node = child
        return node

    def put(self, text: bytes, doc_id: int) -> list:
        node = self.terminal(text)
        if node[2] is None or doc_id < node[2]:
            node[2] = doc_id
        return node


def common_prefix(edge: bytes, text: bytes, at: int = 0) -> int:
    """Bytes that ``edge`` and ``text`` from ``at`` on share at their beginning."""
    low, high = 0, min(len(edge), len(text) - at)
    while low < high:
        middle = (low + high + 1) // 2
        if text.startswith(edge[low:middle], at + low):
            low = middle
        else:
            high = middle - 1
    return low


def failures(raw: bytes, n_chars: int) -> int:
    """Bits of the filters A to D that a text (UTF-8) of so many code points fails."""
    words = raw.split()  # of bytes: white space as in ASCII
    n = len(words)
    return (
        (n < LEAST_WORDS)
        | (100 * len(set(words)) < DISTINCT_SHARE * n) << 1
        | (100 * (len(raw) - len(raw.translate(None, _UPPER))) > UPPER_SHARE * n_chars) << 2
        | (len(raw) != len(raw.translate(None, SIGNS))) << 3
    )


def range_bounds(texts: DataFrame, ranges: int) -> list[bytes]:
    """Up to ``ranges`` - 1 ascending prefixes that cut a sample of the texts (UTF-8) into like parts."""
    n = texts.count()
    if n == 0 or ranges < 2:
        return []
    sample = texts.sample(min(1.0, SAMPLED * ranges / n), seed=0)

    def bounds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before, found = b"", []
        for batch in batches:
            for text in batch.column("text"):
                here = text.as_py()
                if here != before:  # copies count once
                    found.append(here[: common_prefix(before, here) + 1])
                    before = here
        step = max(1.0, len(found) / ranges)
        chosen = sorted({found[int(i * step)] for i in range(1, ranges) if int(i * step) < len(found)})
        yield pa.RecordBatch.from_arrays([pa.array(chosen, pa.binary())], ["bound"])

    ordered = sample.repartition(1).sortWithinPartitions("text")
    return sorted(r.bound for r in ordered.mapInArrow(bounds, "bound binary").toLocalIterator())


_ROWS = "doc_id long, part string, mask int, range int, text binary"
_MASKS = "doc_id long, part string, mask int"


def masked(run: Run, docs: DataFrame) -> DataFrame:
    """doc_id, part (lang, '' if NULL), mask of each row of ``docs``: bit i for filter ``FILTERS[i]``.

    * NULL and empty texts are the empty text: they fail A, and E where a smaller id has such a text.
    * A row fails E where any smaller doc_id has its text; rows that repeat an id do not fail by each other.
    * Rows without doc_id never fail E, nor does anything fail by them.
    """
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("part"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    partitions = int(run.spark.conf.get("spark.sql.shuffle.partitions"))
    bounds = range_bounds(rows.select(F.col("text").cast("binary").alias("text")), RANGES * partitions)

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie, held = Trie(), 0
        for batch in batches:
            texts = batch.column("text")
            raws, masks, ranges, open_ = texts.cast(pa.binary()), [], [], []
            for doc_id, raw, n in zip(batch.column("doc_id").to_pylist(), raws.to_pylist(), pc.utf8_length(texts).to_pylist()):
                mask, settled = failures(raw, n), True
                if doc_id is not None:
                    node = trie.terminal(raw)
                    if node[2] is None or doc_id <= node[2]:
                        node[2], settled = doc_id, False
                    else:
                        mask |= _DUPLICATE
                    held += len(raw)
                masks.append(mask)
                open_.append(not settled)
                ranges.append(None if settled else bisect_right(bounds, raw))
            if held > HELD:
                trie, held = Trie(), 0
            left = pc.if_else(pa.array(open_, pa.bool_()), raws, pa.scalar(None, pa.binary()))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("part"), pa.array(masks, pa.int32()), pa.array(ranges, pa.int32()), left], [x.split()[0] for x in _ROWS.split(", ")])

    def in_tries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie, at = Trie(), None
        waiting: list[tuple[int, str, int, list]] = []

        def closed() -> pa.RecordBatch:
            ids, parts = [w[0] for w in waiting], [w[1] for w in waiting]
            masks = [mask | _DUPLICATE if doc_id > node[2] else mask for doc_id, _, mask, node in waiting]
            return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(parts, pa.string()), pa.array(masks, pa.int32())], [x.split()[0] for x in _MASKS.split(", ")])

        for batch in batches:
            for doc_id, part, mask, number, text in zip(*(batch.column(c) for c in ("doc_id", "part", "mask", "range", "text"))):
                if number.as_py() != at:
                    if waiting:
                        yield closed()
                    trie, at, waiting = Trie(), number.as_py(), []
                waiting.append((doc_id.as_py(), part.as_py(), mask.as_py(), trie.put(text.as_py(), doc_id.as_py())))
        if waiting:
            yield closed()

    seen = run.written(rows.mapInArrow(judged, _ROWS), "rows")
    dealt = seen.where("range IS NOT NULL").repartitionById(partitions, F.expr(f"range DIV {RANGES}").cast("int")).sortWithinPartitions("range")
    return seen.where("range IS NULL").select("doc_id", "part", "mask").union(dealt.mapInArrow(in_tries, _MASKS))


def _steps() -> str:
    """Every step of every order as JSON: its place, its filter's bit and the bits of those before it."""
    out = []
    for order in permutations(FILTERS):
        bits = [1 << FILTERS.index(x) for x in order]
        out += [{"filter_order": "".join(order), "step": i + 1, "bit": b, "before": sum(bits[:i])} for i, b in enumerate(bits)]
    return json.dumps(out)


def audit(run: Run, docs: DataFrame, labels: DataFrame) -> DataFrame:
    """part, filter_order, step, filter, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley.

    One row per part, order of the five filters and step. A document counts as good or toxic where any
    row of ``labels`` with its id says so with 1. Cases as for ``masked``; rows that repeat are counted
    as often as they stand there, an empty table gives no rows, other columns are not read.
    """
    # Rows without an id get a number for the join, so that they do not all meet in one task.
    rows = masked(run, docs).withColumn("nth", F.when(F.col("doc_id").isNull(), F.monotonically_increasing_id()).otherwise(0))
    says = lambda column: F.max(F.coalesce(F.col(column) == 1, F.lit(False)))
    known = labels.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(says("quality").alias("good"), says("toxic").alias("toxic"))
    rows = rows.join(known.withColumn("nth", F.lit(0).cast("long")), ["doc_id", "nth"], "left")
    flag = lambda column: F.coalesce(F.col(column), F.lit(False)).alias(column)
    counts = run.written(rows.groupBy("part", "mask", flag("good"), flag("toxic")).agg(F.count(F.lit(1)).alias("n")), "counts")

    steps = F.from_json(F.lit(_steps()), "array<struct<filter_order string, step int, bit int, before int>>")
    every = counts.select("*", F.inline(steps))
    fails = F.col("mask").bitwiseAND(F.col("bit")) != 0
    reached = F.col("mask").bitwiseAND(F.col("before")) == 0
    total = lambda condition, value=F.col("n"): F.sum(F.when(condition, value).otherwise(0)).cast("long")
    # Each of the filters a document fails comes first among them in the same number of orders.
    n_orders = len(list(permutations(FILTERS)))
    return every.groupBy("part", "filter_order", "step").agg(
        F.max(F.substring("filter_order", F.col("step"), F.lit(1))).alias("filter"),
        total(reached & ~fails).alias("kept"),
        total(reached & fails).alias("removed"),
        total(~reached & fails).alias("redundant"),
        total(F.col("mask") == F.col("bit")).alias("unique_fails"),
        total(reached & fails & F.col("good")).alias("good_lost"),
        total(reached & fails & F.col("toxic")).alias("toxic_lost"),
        total(fails, F.col("n") * F.expr(f"{n_orders} DIV GREATEST(bit_count(mask), 1)")).alias("shapley"),
    )


def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = lambda name: spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return audit(Run(spark, "op11"), read("documents"), read("labels"))


OP11_SQL = r"""
WITH docs AS (
  SELECT doc_id, COALESCE(lang, '') AS part, COALESCE(text, '') AS text,
         regexp_extract_all(COALESCE(text, ''), '[^\x20\x09-\x0D]+') AS words
  FROM documents
), masks AS (
  SELECT doc_id, part,
         CASE WHEN len(words) < 100 THEN 1 ELSE 0 END
         + CASE WHEN 100 * len(list_distinct(words)) < 80 * len(words) THEN 2 ELSE 0 END
         + CASE WHEN 100 * (length(text) - length(regexp_replace(text, '[A-Z]', '', 'g'))) > 10 * length(text) THEN 4 ELSE 0 END
         + CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 8 ELSE 0 END
         + CASE WHEN doc_id > MIN(doc_id) OVER (PARTITION BY text) THEN 16 ELSE 0 END AS mask
  FROM docs
), known AS (
  SELECT doc_id, MAX(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, MAX(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
  FROM labels GROUP BY doc_id
), counts AS (
  SELECT part, mask, COALESCE(good, 0) AS good, COALESCE(toxic, 0) AS toxic, COUNT(*) AS n
  FROM masks LEFT JOIN known USING (doc_id) GROUP BY ALL
), letters AS (
  SELECT letter, CAST(bit AS BIGINT) AS bit FROM (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)) AS l(letter, bit)
), orders AS (
  SELECT a.letter || b.letter || c.letter || d.letter || e.letter AS filter_order, [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits
  FROM letters a, letters b, letters c, letters d, letters e
  WHERE (a.bit | b.bit | c.bit | d.bit | e.bit) = 31
), steps AS (
  SELECT filter_order, CAST(s AS INTEGER) AS step, bits[s] AS bit, CAST(COALESCE(list_sum(bits[1:s-1]), 0) AS BIGINT) AS before
  FROM orders, range(1, 6) AS r(s)
)
SELECT part, filter_order, step, MAX(substr(filter_order, step, 1)) AS filter,
       CAST(SUM(CASE WHEN mask & before = 0 AND mask & bit = 0 THEN n ELSE 0 END) AS BIGINT) AS kept,
       CAST(SUM(CASE WHEN mask & before = 0 AND mask & bit <> 0 THEN n ELSE 0 END) AS BIGINT) AS removed,
       CAST(SUM(CASE WHEN mask & before <> 0 AND mask & bit <> 0 THEN n ELSE 0 END) AS BIGINT) AS redundant,
       CAST(SUM(CASE WHEN mask = bit THEN n ELSE 0 END) AS BIGINT) AS unique_fails,
       CAST(SUM(CASE WHEN mask & before = 0 AND mask & bit <> 0 AND good = 1 THEN n ELSE 0 END) AS BIGINT) AS good_lost,
       CAST(SUM(CASE WHEN mask & before = 0 AND mask & bit <> 0 AND toxic = 1 THEN n ELSE 0 END) AS BIGINT) AS toxic_lost,
       CAST(SUM(CASE WHEN mask & bit <> 0 THEN n * (120 // bit_count(mask)) ELSE 0 END) AS BIGINT) AS shapley
FROM counts, steps
GROUP BY part, filter_order, step
"""
