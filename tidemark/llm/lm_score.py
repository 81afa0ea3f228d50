"""Cross-entropy difference: how much likelier a document is to a target model than to a background.

Both models are bigram models of the same form over one vocabulary: every word of the corpus, or the
most frequent ones, any other word then being the unknown word. A pair's probability is its share
after the first word, mixed with the share of the second word by a fixed prior weight, so that a
word's loss is log(after(first) + PRIOR) - log(n(first, second) + PRIOR * share(second)).

A document is scored by what the others hold: its own pairs, first words and second words are taken out
of both models, so that a document of the target is no closer to it than an equally written one outside.

Nothing that grows with the vocabulary is gathered. Documents are taken in chunks; the pairs of a
chunk are dealt by their second word, those of frequent words by both words, and go in packed arrays
to the task that counts them. It sends back sums per document. A pair that too many documents may hold
is counted in several tasks, each of which gets all its counts and the documents of some chunks. Words
are known by 64-bit hashes.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.llm.byte_bpe import plain_rows, text_batches
from tidemark.llm.stage import Run

#: Weight of the second word's own share, in occurrences of the first word.
PRIOR = 50.0
#: Words of a chunk, and half of those whose pairs one task counts.
COUNTED = 1 << 20
#: Texts of a chunk at most.
TEXTS = 1 << 16
#: Ids of the target that are broadcast at most; more are joined by sorting.
BROADCAST_IDS = 2_000_000
#: Words that are counted apart at most: those of more than this share of the text.
FREQUENT = 1 << 16
#: Documents that may hold a pair before it is counted in several tasks.
SPLIT = 1 << 25

#: Hashes of what is no word. FIRST stands for any second word: its pairs count first words.
UNKNOWN, START, FIRST = 0, 1, 2
_PACKED = "bucket int, kind int, chunk long, a binary, b binary, n binary, m binary"
#: Kinds of packed rows, in the order in which they are read.
_COUNTS, _TEXTS, _IDS = 0, 1, 2
_SCORES = "doc_id long, n_tokens long, target_loss double, background_loss double, score double"


def _hash(word: str | None) -> int:
    if word is None:
        return UNKNOWN
    h = int.from_bytes(hashlib.blake2b(word.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little")
    return h if h > FIRST else h + FIRST + 1


class _Codes(dict):
    """Small numbers for the words of a chunk; 0 and 1 are START and FIRST."""

    def __missing__(self, word: str | None) -> int:
        self[word] = code = len(self) + 2
        return code

    def hashes(self) -> np.ndarray:
        return np.fromiter((START, FIRST, *map(_hash, self)), np.uint64, len(self) + 2)


def _chunks(batches: Iterator[pa.RecordBatch], known: set[str] | None) -> Iterator[tuple[np.ndarray, list[np.ndarray], list, list]]:
    """Hashes by code, codes of each text, ids and target marks of some texts at a time."""
    codes, held, ids, marks, total = _Codes(), [], [], [], 0
    for batch in batches:
        for doc_id, text, mark in zip(*(batch.column(c) for c in ("doc_id", "text", "in_target"))):
            some = (text.as_py() or "").split()
            if held and (total + len(some) > COUNTED or len(held) == TEXTS):
                yield codes.hashes(), held, ids, marks
                codes, held, ids, marks, total = _Codes(), [], [], [], 0
            if known is not None:
                some = [w if w in known else None for w in some]
            held.append(np.fromiter(map(codes.__getitem__, some), np.int32, len(some)))
            ids.append(doc_id.as_py())
            marks.append(bool(mark.as_py()))
            total += len(some)
    if held:
        yield codes.hashes(), held, ids, marks


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    found: Counter[str] = Counter()

    def taken() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(found.keys(), pa.string()), pa.array(found.values(), pa.int64())], ["word", "n"])

    for _, texts in text_batches(batches):
        for text in texts:
            found.update(text.split())
        if len(found) > COUNTED // 4:
            yield taken()
            found.clear()
    if found:
        yield taken()


def vocabulary(docs: DataFrame, size: int) -> list[str]:
    """The most frequent words of all documents; of equally frequent ones the first by byte order."""
    words = plain_rows(docs).mapInArrow(_word_counts, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return [r.word for r in words.orderBy(F.desc("n"), "word").limit(size - 2).collect()]


def word_counts(marked: DataFrame, known: set[str] | None) -> DataFrame:
    """word (hash), n, n_target over all of ``marked``; at most a row per word and chunk is shuffled.

    START stands once before each text with words.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for hashes, texts, _, marks in _chunks(batches, known):
            n, m = (np.bincount(np.concatenate([x for x, t in zip(texts, marks) if t or every] or [np.zeros(0, np.int32)]), minlength=len(hashes)) for every in (True, False))
            held = np.array([len(x) > 0 for x in texts])
            n[0], m[0] = held.sum(), (held & np.array(marks)).sum()
            some = np.nonzero(n)[0]
            yield pa.RecordBatch.from_arrays([pa.array(x[some]) for x in (hashes.view(np.int64), n, m)], ["word", "n", "n_target"])

    found = marked.mapInArrow(run, "word long, n long, n_target long")
    return found.groupBy("word").agg(F.sum("n").alias("n"), F.sum("n_target").alias("n_target"))


def _mixed(a: np.ndarray) -> np.ndarray:
    a = (a ^ (a >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return a ^ (a >> np.uint64(29))


class _Frequent:
    """Words known to all tasks, with how often they stand in the target and in all texts."""

    def __init__(self, words: list[tuple[int, int, int]]):
        words = sorted(words)
        self.hashes = np.array([w for w, _, _ in words], np.uint64)
        self.counts = np.array([c for _, *c in words], np.int64).reshape(-1, 2)

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of ``hashes`` are frequent, and their counts (0 for others)."""
        if not len(self.hashes):
            return np.zeros(len(hashes), bool), np.zeros((len(hashes), 2), np.int64)
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        hit = self.hashes[at] == hashes
        return hit, self.counts[at] * hit[:, None]


def _small(*arrays: np.ndarray) -> bytes:
    """Arrays of equal length, one after the other, in as few bytes a number as all allow."""
    most = max(int(x.max()) for x in arrays)
    return np.concatenate(arrays).astype(f"<u{1 if most < 1 << 8 else 2 if most < 1 << 16 else 4}").tobytes()


def _packed(hashes: np.ndarray, texts: list[np.ndarray], marks: list, frequent: _Frequent, buckets: int, split: int, turn: int) -> Iterator[tuple]:
    """bucket, kind, a, b, n, m of a chunk: its pairs with their counts, and the texts that have them."""
    lengths = np.array([len(x) for x in texts])
    second = np.concatenate(texts).astype(np.int64)
    if not len(second):
        return
    first = np.empty_like(second)
    first[1:] = second[:-1]
    first[(np.cumsum(lengths) - lengths)[lengths > 0]] = 0
    of = np.repeat(np.arange(len(texts)), lengths)
    # Each word stands once as the first word of any pair, and once in its own pair.
    size, many = len(hashes), len(texts)
    words, times = np.unique(second * many + of, return_counts=True)
    keys = np.concatenate((second * size + first, first * size + 1)) * many + np.concatenate((of, of))
    del first, second, of
    keys.sort()
    at = np.nonzero(np.concatenate(([True], keys[1:] != keys[:-1])))[0]
    n = np.diff(np.append(at, len(keys)))
    keys, doc = np.divmod(keys[at], many)
    starts = np.nonzero(np.concatenate(([True], keys[1:] != keys[:-1])))[0]
    b, a = np.divmod(keys[starts], size)
    held_by = np.diff(np.append(starts, len(keys)))
    # How often a text has the second word: all that START, which is no second word, lacks.
    seconds = times[np.minimum(np.searchsorted(words, np.repeat(b, held_by) * many + doc), len(words) - 1)]
    seconds[np.repeat(a == 1, held_by)] = 0
    total, inside = np.add.reduceat(n, starts), np.add.reduceat(n * np.array(marks)[doc], starts)
    hot, known = frequent.find(hashes)
    known = known[:, 1]
    known[1] = np.iinfo(np.int64).max  # FIRST stands with any word
    parts = np.clip(-(-np.minimum(known[a], known[b]) // split), 1, buckets)
    hot, a, b = hot[b], hashes[a], hashes[b]
    bucket = (_mixed(np.where(hot, b ^ _mixed(a), b)) % np.uint64(buckets)).astype(np.int64)
    # Every part of a pair gets the counts, the part whose turn it is gets the texts.
    pair = np.repeat(np.arange(len(parts)), parts)
    part = np.arange(len(pair)) - np.repeat(np.cumsum(parts) - parts, parts)
    bucket = (bucket[pair] + part) % buckets
    held_by = np.where(part == turn % parts[pair], held_by[pair], 0)
    order = np.argsort(np.repeat(bucket, held_by), kind="stable")
    doc, n, seconds = doc[order].astype("<u2"), n[order], seconds[order]
    order = np.argsort(bucket, kind="stable")
    pair, held_by = pair[order], held_by[order]
    a, b, total, inside = a[pair], b[pair], total[pair].astype("<u4"), inside[pair].astype("<u4")
    pairs = np.concatenate(([0], np.cumsum(np.bincount(bucket, minlength=buckets)))).tolist()
    entries = np.concatenate(([0], np.cumsum(np.bincount(bucket[order], held_by, buckets)))).astype(np.int64).tolist()
    about = (lengths << 1 | np.array(marks)).astype("<u4")
    for k in range(buckets):
        if pairs[k] < pairs[k + 1]:
            p, e = slice(pairs[k], pairs[k + 1]), slice(entries[k], entries[k + 1])
            yield k, _COUNTS, a[p].tobytes(), b[p].tobytes(), total[p].tobytes(), inside[p].tobytes()
            if entries[k] < entries[k + 1]:
                yield k, _TEXTS, held_by[p].astype("<u4").tobytes(), doc[e].tobytes(), _small(n[e], seconds[e]), about[np.unique(doc[e])].tobytes()


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int32(), pa.int32(), pa.int64(), *[pa.binary()] * 4]
    packed = zstandard.ZstdCompressor(level=1).compress
    columns = [c if i < 3 else [packed(x) for x in c] for i, c in enumerate(zip(*rows))]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], [x.split()[0] for x in _PACKED.split(", ")])


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """The rows of ``_rows``."""
    unpacked = zstandard.ZstdDecompressor().decompress
    for batch in batches:
        for k, kind, chunk, *blobs in zip(*(batch.column(i) for i in range(7))):
            yield k.as_py(), kind.as_py(), chunk.as_py(), *(unpacked(x.as_py()) for x in blobs)


class _Counted:
    """Counts of the pairs of a bucket, put together from those of all chunks (a, b, n, n_target)."""

    def __init__(self, held: list[tuple[np.ndarray, ...]], frequent: _Frequent, sums: tuple[float, float]):
        a, b, n, m = (np.concatenate(x) for x in zip(*held))
        order = np.lexsort((a, b))
        a, b = a[order], b[order]
        new_b = np.concatenate(([True], b[1:] != b[:-1]))
        new = new_b | np.concatenate(([True], a[1:] != a[:-1]))
        starts = np.nonzero(new)[0]
        self.pair = np.empty(len(a), np.int32)  # by place in ``held``
        self.pair[order] = np.cumsum(new) - 1
        self.first = a[starts] == FIRST
        word, words = (np.cumsum(new_b) - 1)[starts], int(new_b.sum())
        hit, known = frequent.find(b[new_b])
        self.sides = []
        for side, (counts, total) in enumerate(zip((m, n), sums)):
            counts = np.add.reduceat(counts[order].astype(np.float64), starts)
            of = np.bincount(word, np.where(self.first, 0, counts), words)
            self.sides.append((counts, np.where(hit, known[:, side], of)[word], total))

    def losses(self, at: np.ndarray, times: np.ndarray, seconds: np.ndarray, length: np.ndarray, marked: np.ndarray) -> Iterator[np.ndarray]:
        """What the pairs ``at`` add to a text's loss under the target and under all, without its own counts.

        The text has each pair ``times``, its second word ``seconds`` and ``length`` words.
        """
        first = self.first[at]
        for (counts, of, total), own in zip(self.sides, (marked, 1)):
            prior = np.where(first, PRIOR, PRIOR * (of[at] - own * seconds + 1) / (total - own * length))
            loss = np.log(counts[at] - own * times + prior)
            yield np.where(first, loss, -loss) * times


def scored(run: Run, docs: DataFrame, target: DataFrame, size: int | None = None) -> DataFrame:
    """doc_id, n_tokens, target_loss, background_loss, score, one row per row of ``docs``.

    ``target`` names the documents of the target by doc_id, repeats and NULL being passed over; the
    background is all of ``docs``. Losses are means per word in nats; score is target_loss minus
    background_loss, lower being closer to the target. Every word is known; ``size`` keeps only so
    many, with the unknown word and the start of a text. A row's own words are in neither model.

    * Texts without words (NULL, empty, white) have no tokens and NULL losses and score.
    * An empty target has a uniform model, an empty table gives no rows.
    * Repeated rows count as often as they stand and give repeated rows; other columns are not read.
    """
    known = None if size is None else set(vocabulary(docs, size))
    names = run.written(target.select(F.col("doc_id").cast("long").alias("doc_id")).where("doc_id IS NOT NULL").distinct(), "names")
    way = "broadcast" if names.count() <= BROADCAST_IDS else "merge"
    marked = plain_rows(docs).join(names.withColumn("in_target", F.lit(True)).hint(way), "doc_id", "left")
    words = run.written(word_counts(marked, known), "words")
    counted = words.where(F.col("word") != START)
    n_words, total, inside = (int(x or 0) for x in counted.where(F.col("word") != UNKNOWN).agg(F.count("*")).first() + counted.agg(F.sum("n"), F.sum("n_target")).first())
    buckets, split = max(1, int(run.spark.conf.get("spark.sql.shuffle.partitions")), -(-total // (2 * COUNTED))), SPLIT
    # Words so frequent that the pairs of one would fill much of a task.
    often = words.where(F.col("n") * min(8 * buckets, FREQUENT) > total)
    frequent = _Frequent([(r.word % (1 << 64), r.n_target, r.n) for r in often.collect()])
    mass = (size or n_words + 2) - 1 + 1e-9  # one for each word and the unknown one; the start never follows
    sums = inside + mass, total + mass

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk = TaskContext.get().partitionId() << 32
        for hashes, texts, ids, marks in _chunks(batches, known):
            rows, turn = [], int(_mixed(np.array([chunk], np.uint64))[0] >> np.uint64(1))
            for k, kind, *blobs in _packed(hashes, texts, marks, frequent, buckets, split, turn):
                rows.append((k, kind, chunk, *blobs))
                if len(rows) == 64:
                    yield _rows(rows)
                    rows.clear()
            given = np.array([i is not None for i in ids])
            numbers, lengths = np.array([i or 0 for i in ids], "<i8"), np.array([len(x) for x in texts], "<i8")
            yield _rows([*rows, (turn % buckets, _IDS, chunk, numbers.tobytes(), given.tobytes(), lengths.tobytes(), b"")])
            chunk += 1

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows by bucket and kind: all counts of a bucket come before its texts."""
        at, held, chunks, end, counts = None, [], {}, 0, None
        for k, kind, chunk, a, b, n, m in _read(batches):
            if k != at:
                at, held, chunks, end, counts = k, [], {}, 0, None
            if kind == _COUNTS:
                held.append((np.frombuffer(a, "<u8"), np.frombuffer(b, "<u8"), np.frombuffer(n, "<u4"), np.frombuffer(m, "<u4")))
                chunks[chunk] = end, end + len(held[-1][0])
                end = chunks[chunk][1]
            elif kind == _TEXTS:
                if counts is None:
                    counts = _Counted(held, frequent, sums)
                    held.clear()
                doc = np.frombuffer(b, "<u2")
                times, seconds = np.frombuffer(n, f"<u{len(n) // len(doc) // 2}").astype(np.int64).reshape(2, -1)
                pair = np.repeat(counts.pair[slice(*chunks[chunk])], np.frombuffer(a, "<u4"))
                some, doc = np.unique(doc, return_inverse=True)
                length, marked = np.divmod(np.frombuffer(m, "<u4").astype(np.int64), 2)
                near, far = (np.bincount(doc, x).tobytes() for x in counts.losses(pair, times, seconds, length[doc], marked[doc]))
                yield _rows([(k, kind, chunk, some.tobytes(), near, far, b"")])
            else:
                yield _rows([(k, kind, chunk, a, b, n, m)])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows by chunk, the one with its ids last."""
        at, near, far = None, None, None
        for _, kind, chunk, a, b, n, _ in _read(batches):
            if chunk != at:
                at, near, far = chunk, np.zeros(TEXTS), np.zeros(TEXTS)
            if kind == _TEXTS:
                doc = np.frombuffer(a, "<u2")
                near[doc] += np.frombuffer(b, "<f8")
                far[doc] += np.frombuffer(n, "<f8")
                continue
            ids, given, lengths = np.frombuffer(a, "<i8"), np.frombuffer(b, bool), np.frombuffer(n, "<i8")
            none = lengths == 0
            one, two = (x[: len(ids)] / np.maximum(lengths, 1) for x in (near, far))
            yield pa.RecordBatch.from_arrays([pa.array(ids, mask=~given), pa.array(lengths), *(pa.array(x, mask=none) for x in (one, two, one - two))], [x.split()[0] for x in _SCORES.split(", ")])

    dealt = marked.mapInArrow(pack, _PACKED).repartitionById(buckets, F.col("bucket")).sortWithinPartitions("bucket", "kind", "chunk")
    found = dealt.mapInArrow(count, _PACKED).repartition("chunk").sortWithinPartitions("chunk", "kind", "bucket")
    return found.mapInArrow(add, _SCORES)


def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The target are the documents labelled as good ones that are not toxic."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return scored(Run(spark, "op9"), spark.read.parquet(f"{sf_dir}/documents.parquet"), labels.where("quality = 1 AND coalesce(toxic, 0) = 0"))
