"""Fuzzy passages that documents share, by collinear chaining of k-mer seeds.

Each document gives seeds: of the 5-word k-mers in every window the one with the smallest hash, so
two documents that share a long enough run of words share a seed of it. A seed is compared with the
first document that has it, never with all, so a passage in a third of all documents makes one match
per document. The matches of two documents are chained, in the order of both, with a cost for gaps,
through a Fenwick tree of prefix maxima; chains are then aligned word by word.
"""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.llm.byte_bpe import plain_rows
from tidemark.llm.stage import Run

K = 5
#: K-mers of which one is a seed at least. A shared run of K + WINDOW - 1 words always shares a seed.
#: At K - 1 one of the k-mers across any border of two words is a seed, so where the parts of a passage
#: were first seen alone, a seed across their border still leads to the first document with both.
WINDOW = K - 1
#: Words of a passage at least, and how much of it must agree.
MIN_WORDS = 50
SIMILARITY = 0.8
#: Cost of a word between chained seeds, on either side; a seed gains K.
GAP_COST = 0.05
#: Words of an aligned stretch at least. Stretches of a passage whose seeds were first seen in
#: different documents are joined afterwards.
MIN_PIECE = 20
#: Seeds of a chain at least, for it to be aligned. One is enough: it may be all that is left of a passage.
MIN_SEEDS = 1
#: Pieces that match one document in order, no further apart than this on either side, are one passage.
JOIN_GAP = 8
#: Words beyond the outer seeds that an alignment may reach, and words of a tile in which words travel.
REACH = 48
TILE = 128
#: An end of an alignment goes on past so many words on a side if as many agree behind them as RESUME.
SKIP, RESUME = 3, 4

_MULTIPLIERS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], np.uint64)
_SEEDS = "hash long, doc_id long, pos int"
_MATCHES = "doc_id long, first_id long, pos int, first_pos int"
_CHAINS = "doc_id long, first_id long, seeds binary, low int, high int, first_low int, first_high int"
_PASSAGES = "doc_id long, start int, n_words int, first_id long, first_start int, first_words int, matched int"


def words(text: str | None) -> list[bytes]:
    """Lower-case (A-Z) words between ASCII white space."""
    return (text or "").encode().lower().split()


def word_hashes(some: list[bytes]) -> np.ndarray:
    return np.fromiter(map(zlib.crc32, some), np.uint32, len(some))


def seeds(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """K-mer hashes and positions of a document's seeds, by position.

    A k-mer that occurs again is given once more under the number of the occurrence, so that the
    second one of a copy meets the second one of the original.
    """
    n = len(hashes) - K + 1
    if n < 1:
        return np.zeros(0, np.int64), np.zeros(0, np.int32)
    h = np.zeros(n, np.uint64)
    for i in range(K):
        h += (hashes[i : i + n].astype(np.uint64) + np.uint64(1)) * _MULTIPLIERS[i]
    h ^= h >> np.uint64(31)
    h *= _MULTIPLIERS[0]
    h ^= h >> np.uint64(29)
    width = min(WINDOW, n)
    m = n - width + 1
    least, chosen = h[:m], np.arange(m, dtype=np.int32)
    for k in range(1, width):
        less = h[k : k + m] < least
        least = np.where(less, h[k : k + m], least)
        chosen[less] = np.nonzero(less)[0] + k
    pos = chosen[np.concatenate(([True], chosen[1:] != chosen[:-1]))]  # first minima never go back
    h = h[pos]
    ordered = np.sort(h)
    if (ordered[1:] != ordered[:-1]).all():
        return h.view(np.int64), pos
    order = np.argsort(h, kind="stable")
    ordered = h[order]
    first = np.concatenate(([True], ordered[1:] != ordered[:-1]))
    group = np.maximum.accumulate(np.where(first, np.arange(len(h)), 0))
    nth = np.empty(len(h), np.uint64)
    nth[order] = (np.arange(len(h)) - group).astype(np.uint64)
    again = nth > 0
    h = np.concatenate((h, (h[again] ^ (nth[again] * _MULTIPLIERS[1])) * _MULTIPLIERS[2]))
    return h.view(np.int64), np.concatenate((pos, pos[again]))


def _seed_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 512):
            part = batch.slice(at, 512)
            found = [seeds(word_hashes(words(x.as_py()))) for x in part.column("text")]
            ids = np.repeat(part.column("doc_id").to_numpy(), [len(h) for h, _ in found])
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([h for h, _ in found])), pa.array(ids), pa.array(np.concatenate([p for _, p in found]))], ["hash", "doc_id", "pos"])


class Fenwick:
    """The greatest of the values up to a place, and which item has it."""

    def __init__(self, n: int):
        self.value, self.item = [float("-inf")] * (n + 1), [-1] * (n + 1)

    def put(self, at: int, value: float, item: int) -> None:
        while at < len(self.value):
            if value > self.value[at]:
                self.value[at], self.item[at] = value, item
            at += at & -at

    def best(self, at: int) -> tuple[float, int]:
        value, item = float("-inf"), -1
        while at:
            if self.value[at] > value:
                value, item = self.value[at], self.item[at]
            at -= at & -at
        return value, item


def chains(a: list[int], b: list[int]) -> list[list[int]]:
    """Chains of matches (a[i], b[i]) that rise in both, given in order of a, then b; best first.

    A chain scores K per match less the cost of the words it passes over on both sides. Each match is
    in one chain; a chain that runs into one found before ends there.
    """
    if len(a) == 1:
        return [[0]]
    ranks = {v: r for r, v in enumerate(sorted(set(b)), 1)}
    tree = Fenwick(len(ranks))
    score, before, waiting = [0.0] * len(a), [-1] * len(a), []
    for i, (x, y) in enumerate(zip(a, b)):
        if waiting and a[waiting[0]] != x:  # matches at one place do not follow each other
            for j in waiting:
                tree.put(ranks[b[j]], score[j] + GAP_COST * (a[j] + b[j]), j)
            waiting.clear()
        value, j = tree.best(ranks[y] - 1)
        gain = value - GAP_COST * (x + y)
        score[i], before[i] = (K + gain, j) if gain > 0 else (float(K), -1)
        waiting.append(i)
    used, out = [False] * len(a), []
    for i in sorted(range(len(a)), key=lambda i: -score[i]):
        chain = []
        while i >= 0 and not used[i]:
            used[i] = True
            chain.append(i)
            i = before[i]
        if chain:
            out.append(chain[::-1])
    return out


def _chain_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by doc_id, first_id, pos, first_pos; two documents' matches may go over batches."""
    held: list[tuple[np.ndarray, np.ndarray]] = []
    held_key = None

    def closed(out: list[tuple]) -> None:
        a = np.concatenate([x for x, _ in held])
        b = np.concatenate([x for _, x in held])
        if len(a) < MIN_SEEDS:
            return
        a, b = a.tolist(), b.tolist()
        for chain in chains(a, b):
            x, y = [a[i] for i in chain], [b[i] for i in chain]
            if len(chain) >= MIN_SEEDS:
                low, first_low = max(0, x[0] - REACH), max(0, y[0] - REACH)
                out.append((*held_key, struct.pack(f"<{2 * len(x)}i", *x, *y), low, x[-1] + K + REACH, first_low, y[-1] + K + REACH))

    def batch_of(out: list[tuple]) -> pa.RecordBatch:
        kinds = [pa.int64(), pa.int64(), pa.binary(), *[pa.int32()] * 4]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], [x.split()[0] for x in _CHAINS.split(", ")])

    for batch in batches:
        if not batch.num_rows:
            continue
        out: list[tuple] = []
        doc, first, pos, first_pos = (batch.column(c).to_numpy() for c in ("doc_id", "first_id", "pos", "first_pos"))
        cuts = np.concatenate(([0], np.nonzero((np.diff(doc) != 0) | (np.diff(first) != 0))[0] + 1, [len(doc)])).tolist()
        for i, j in zip(cuts, cuts[1:]):
            key = (int(doc[i]), int(first[i]))
            if held and key != held_key:
                closed(out)
                held.clear()
            held_key = key
            held.append((pos[i:j], first_pos[i:j]))
        if out:
            yield batch_of(out)
    out = []
    if held:
        closed(out)
    if out:
        yield batch_of(out)


def _common_words(a: Sequence, b: Sequence) -> int:
    """Length of the longest common subsequence of two runs, a bit per word of ``b``."""
    places: dict = {}
    for i, y in enumerate(b):
        places[y] = places.get(y, 0) | 1 << i
    full = (1 << len(b)) - 1
    row = full  # zeros where the length grows
    for x in a:
        met = row & places.get(x, 0)
        row = (row + met | row - met) & full
    return len(b) - row.bit_count()


_SKIPS = sorted(((i, j) for i in range(SKIP + 1) for j in range(SKIP + 1) if i or j), key=lambda s: (max(s), sum(s), s))
#: Words compared at once in a run.
STRIDE = 32


def _ahead(a: bytes, b: bytes, i: int, j: int) -> int:
    """How many words (of four bytes) agree from places i and j on."""
    i, j = 4 * i, 4 * j
    start, stop = i, i + min(len(a) - i, len(b) - j)
    while i < stop:
        if i + 4 * STRIDE <= stop and a[i : i + 4 * STRIDE] == b[j : j + 4 * STRIDE]:
            i, j = i + 4 * STRIDE, j + 4 * STRIDE
        elif a[i : i + 4] == b[j : j + 4]:
            i, j = i + 4, j + 4
        else:
            break
    return (i - start) // 4


def _behind(a: bytes, b: bytes, i: int, j: int, low: int = 0, first_low: int = 0) -> int:
    """How many words agree before places i and j, down to low and first_low."""
    i, j = min(4 * i, len(a)), min(4 * j, len(b))
    start, stop = i, i - min(i - 4 * low, j - 4 * first_low)
    while i > stop:
        if i - 4 * STRIDE >= stop and a[i - 4 * STRIDE : i] == b[j - 4 * STRIDE : j]:
            i, j = i - 4 * STRIDE, j - 4 * STRIDE
        elif a[i - 4 : i] == b[j - 4 : j]:
            i, j = i - 4, j - 4
        else:
            break
    return max(0, start - i) // 4


def _later(a: bytes, b: bytes, i: int, j: int) -> list[tuple[int, int, int, int]]:
    """Further runs of agreeing words behind places i and j, after a few that do not agree."""
    out = []
    while True:
        here = [a[4 * (i + d) : 4 * (i + d + RESUME)] for d in range(SKIP + 1)]
        there = [b[4 * (j + d) : 4 * (j + d + RESUME)] for d in range(SKIP + 1)]
        for di, dj in _SKIPS:
            if here[di] == there[dj] and len(here[di]) == 4 * RESUME:
                i, j = i + di, j + dj
                n = _ahead(a, b, i, j)
                out.append((i, i + n, j, j + n))
                i, j = i + n, j + n
                break
        else:
            return out


def _earlier(a: bytes, b: bytes, i: int, j: int) -> list[tuple[int, int, int, int]]:
    """As ``_later``, before places i and j, or the ends where these lie beyond; the nearest comes first."""
    out, over, first_over = [], max(0, i - len(a) // 4), max(0, j - len(b) // 4)
    i, j = i - over, j - first_over
    while True:
        here = [a[4 * max(0, i - d - RESUME) : 4 * max(0, i - d)] for d in range(SKIP + 1)]
        there = [b[4 * max(0, j - d - RESUME) : 4 * max(0, j - d)] for d in range(SKIP + 1)]
        for di, dj in _SKIPS:
            if here[di] == there[dj] and len(here[di]) == 4 * RESUME:
                i, j = i - di, j - dj
                n = _behind(a, b, i, j)
                out.append((i - n + over, i + over, j - n + first_over, j + first_over))
                i, j = i - n, j - n
                break
        else:
            return out


def aligned(a: bytes, b: bytes, x: list[int], y: list[int]) -> list[tuple[int, int, int, int, int]]:
    """Passages (start, end, start in b, end in b, words that agree) along the chain of seeds x, y.

    ``a`` and ``b`` hold word hashes of four bytes each. Seeds grow while words agree, at both ends of
    the chain also past a few that do not. What lies between the runs is aligned, and all is summed up with
    one for a word that agrees and as much less for one that does not as the similarity allows. A
    passage is a stretch whose sum nowhere falls below its start, up to its highest place.
    """
    penalty = SIMILARITY / (1 - SIMILARITY)
    parts: list[tuple[int, int, int, int]] = []  # runs of agreeing words, in order
    for i, j in zip(x, y):
        if parts and (i + K <= parts[-1][1] or i < parts[-1][1] or j < parts[-1][3]):
            if i + K <= parts[-1][1] or j + K <= parts[-1][3] or i - j != parts[-1][0] - parts[-1][2]:
                continue
            i, j = parts[-1][1], parts[-1][3]
        floor_i, floor_j = (parts[-1][1], parts[-1][3]) if parts else (0, 0)
        back = _behind(a, b, i, j, floor_i, floor_j)
        ahead = _ahead(a, b, i, j)
        if back + ahead:
            parts.append((i - back, i + ahead, j - back, j + ahead))
    if parts:
        parts = _earlier(a, b, parts[0][0], parts[0][2])[::-1] + parts + _later(a, b, parts[-1][1], parts[-1][3])
    words_a, words_b = memoryview(a).cast("I"), memoryview(b).cast("I")
    out = []
    total = top = 0.0
    start = best = None
    agree = best_agree = 0
    for p, q in zip([None, *parts], parts):
        length = q[1] - q[0]
        if start is not None:
            gap_a, gap_b = q[0] - p[1], q[2] - p[3]
            same = _common_words(words_a[p[1] : q[0]], words_b[p[3] : q[2]]) if gap_a and gap_b else 0
            total += same - penalty * (max(gap_a, gap_b) - same)
            agree += same
            if total <= 0 or top - total > penalty * MIN_WORDS:
                out.append((start, best, best_agree))
                start = None
        if start is None:
            start, total, agree, top = q, 0.0, 0, 0.0
        total += length
        agree += length
        if total >= top:
            top, best, best_agree = total, q, agree
    if start is not None:
        out.append((start, best, best_agree))
    return [(s[0], e[1], s[2], e[3], n) for s, e, n in out]


def _tile_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The word hashes of each document in tiles."""
    for batch in batches:
        for at in range(0, batch.num_rows, 512):
            part = batch.slice(at, 512)
            ids, numbers, cut = [], [], []
            for doc_id, text in zip(part.column("doc_id").to_pylist(), part.column("text")):
                raw = word_hashes(words(text.as_py())).astype("<u4").tobytes()
                tiles = [raw[i : i + 4 * TILE] for i in range(0, len(raw), 4 * TILE)]
                ids += [doc_id] * len(tiles)
                numbers += range(len(tiles))
                cut += tiles
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(numbers, pa.int32()), pa.array(cut, pa.binary())], ["doc_id", "tile", "words"])


def _flat(column: pa.ListArray) -> tuple[list[int], dict[str, list]]:
    """Where each row's structs end, and the fields of all structs as lists."""
    ends = np.cumsum(column.value_lengths().to_numpy()).tolist()
    structs = column.flatten()
    return ends, {f.name: structs.field(f.name).to_pylist() for f in structs.type}


def _aligned_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Passages of a document per row: all its chains, and each tile they lie in once."""
    for batch in batches:
        out = []
        chain_ends, chain = _flat(batch.column("chains"))
        tile_ends, tile = _flat(batch.column("tiles"))
        held_of, held_tile, held_words = (tile[c] for c in ("of", "tile", "words"))
        rows = list(zip(*(chain[c] for c in ("first_id", "seeds", "low", "high", "first_low", "first_high"))))
        at = tile_at = 0
        for doc_id, end, tile_end in zip(batch.column("doc_id").to_pylist(), chain_ends, tile_ends):
            held = dict(zip(zip(held_of[tile_at:tile_end], held_tile[tile_at:tile_end]), held_words[tile_at:tile_end]))

            def cut(of: int, low: int, high: int) -> tuple[int, bytes]:
                numbers = [n for n in range(low // TILE, high // TILE + 1) if (of, n) in held]
                return TILE * numbers[0] if numbers else 0, b"".join([held[of, n] for n in numbers])

            for first_id, seeds_of, low, high, first_low, first_high in rows[at:end]:
                (base, a), (first_base, b) = cut(doc_id, low, high), cut(first_id, first_low, first_high)
                places = memoryview(seeds_of).cast("i").tolist()
                x, y = places[: len(places) // 2], places[len(places) // 2 :]
                for i, j, first_i, first_j, same in aligned(a, b, [v - base for v in x], [v - first_base for v in y]):
                    if j - i >= MIN_PIECE and same >= SIMILARITY * max(j - i, first_j - first_i):
                        out.append((doc_id, i + base, j - i, first_id, first_i + first_base, first_j - first_i, same))
            at, tile_at = end, tile_end
        if out:
            kinds = [x.split()[1] for x in _PASSAGES.split(", ")]
            columns = [pa.array(c, pa.int64() if k == "long" else pa.int32()) for c, k in zip(zip(*out), kinds)]
            yield pa.RecordBatch.from_arrays(columns, [x.split()[0] for x in _PASSAGES.split(", ")])


def _match_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by hash, doc_id, pos: each but those of a hash's first document, with the first row."""
    held = first_id = first_pos = None
    for batch in batches:
        if not batch.num_rows:
            continue
        key, doc, pos = (batch.column(c).to_numpy() for c in ("hash", "doc_id", "pos"))
        fresh = np.concatenate(([key[0] != held], key[1:] != key[:-1]))
        start = np.maximum.accumulate(np.where(fresh, np.arange(len(key)), -1))
        ids, places = doc[start], pos[start]
        ids[start < 0], places[start < 0] = first_id or 0, first_pos or 0
        held, first_id, first_pos = key[-1], ids[-1], places[-1]
        some = np.nonzero(doc > ids)[0]
        if len(some):
            columns = [pa.array(x[some]) for x in (doc, ids, pos, places)]
            yield pa.RecordBatch.from_arrays(columns, [x.split()[0] for x in _MATCHES.split(", ")])


def matches(docs: DataFrame) -> DataFrame:
    """doc_id, first_id, pos, first_pos: each seed against the first document that has it.

    Seeds are extracted and shuffled once. What a seed's rows need of each other is the first of them
    only, so a seed of very many documents streams past in its task, however many there are.
    """
    found = docs.mapInArrow(_seed_batches, _SEEDS)
    return found.repartition("hash").sortWithinPartitions("hash", "doc_id", "pos").mapInArrow(_match_batches, _MATCHES)


def pieces(run: Run, docs: DataFrame) -> DataFrame:
    """Aligned stretches that a document shares with one of smaller doc_id, of MIN_PIECE words or more."""
    rows = plain_rows(docs).where("doc_id IS NOT NULL")
    ordered = matches(rows).repartition("doc_id", "first_id").sortWithinPartitions("doc_id", "first_id", "pos", "first_pos")
    found = run.written(ordered.mapInArrow(_chain_batches, _CHAINS), "chains", free=True)

    # Words travel in tiles, and each to a document once, however many of its chains lie in it. All tiles
    # are shuffled once; to choose those that are needed first would take a shuffle of the texts.
    tile = lambda c: F.floor(F.col(c) / TILE).cast("int")
    sides = F.array(
        F.struct(F.col("doc_id").alias("of"), tile("low").alias("from"), tile("high").alias("to")),
        F.struct(F.col("first_id").alias("of"), tile("first_low").alias("from"), tile("first_high").alias("to")),
    )
    needs = found.select("doc_id", F.explode(sides).alias("s")).select("doc_id", "s.of", F.explode(F.sequence("s.from", "s.to")).alias("tile")).distinct()
    tiles = rows.mapInArrow(_tile_batches, "doc_id long, tile int, words binary")
    tiles = tiles.groupBy(F.col("doc_id").alias("of"), "tile").agg(F.max("words").alias("words"))  # rows that repeat an id
    given = needs.join(tiles.hint("merge"), ["of", "tile"]).groupBy("doc_id").agg(F.collect_list(F.struct("of", "tile", "words")).alias("tiles"))
    chains_of = found.groupBy("doc_id").agg(F.collect_list(F.struct("first_id", "seeds", "low", "high", "first_low", "first_high")).alias("chains"))
    return chains_of.join(given.hint("merge"), "doc_id").mapInArrow(_aligned_batches, _PASSAGES)


def passages(run: Run, docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """doc_id, start, n_words, first_ids, similarity: passages that documents of smaller id have as well.

    ``start`` and ``n_words`` count words between ASCII white space; ``first_ids`` are the documents
    compared with, and similarity the share of words that agree with them, 0.8 or more. Pieces that
    touch are one passage, also where they were first seen in different documents.

    * NULL, empty and short texts have no passage; rows without doc_id take no part. Any length.
    * Of documents that share a passage all but the one of smallest id have a row for it. Repeats
      within a document, and in rows that repeat a doc_id, are not looked for.
    * An empty table gives no rows; other columns are not read.
    """
    found = run.written(pieces(run, docs), "pieces", free=True)
    run.drop("chains")

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for doc_id, parts in zip(batch.column("doc_id").to_pylist(), batch.column("parts").to_pylist()):
                for start, stop, firsts, share in _joined(parts):
                    if stop - start >= min_words:
                        out.append((doc_id, start, stop - start, firsts, share))
            columns = list(zip(*out)) if out else [()] * 5
            kinds = (pa.int64(), pa.int32(), pa.int32(), pa.list_(pa.int64()), pa.float64())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["doc_id", "start", "n_words", "first_ids", "similarity"])

    parts = found.groupBy("doc_id").agg(F.collect_list(F.struct("start", "n_words", "first_id", "first_start", "first_words", "matched")).alias("parts"))
    return parts.mapInArrow(joined, "doc_id long, start int, n_words int, first_ids array<long>, similarity double")


def _joined(parts: list[dict]) -> list[tuple[int, int, list[int], float]]:
    """A document's pieces, taken together where they follow each other.

    Pieces of one document of smaller id may have a gap on either side, which counts against the
    similarity. Those of different documents must touch: words that none of them has are not passed over.
    """
    stretches: list[list[int]] = []  # first_id, start, stop, first start, first stop, words that agree
    for p in sorted(parts, key=lambda p: (p["first_id"], p["start"], -p["n_words"], p["first_start"])):
        q = [p["first_id"], p["start"], p["start"] + p["n_words"], p["first_start"], p["first_start"] + p["first_words"], p["matched"]]
        last = stretches[-1] if stretches else None
        if last and last[0] == q[0] and 0 <= q[1] - last[2] <= JOIN_GAP and 0 <= q[3] - last[4] <= JOIN_GAP:
            if last[5] + q[5] >= SIMILARITY * max(q[2] - last[1], q[4] - last[3]):
                last[2], last[4], last[5] = q[2], q[4], last[5] + q[5]
                continue
        stretches.append(q)
    out: list[list] = []
    for first_id, start, stop, first_start, first_stop, same in sorted(stretches, key=lambda q: (q[1], -q[2], q[0])):
        length = max(stop - start, first_stop - first_start)
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], stop)
            out[-1][2].add(first_id)
            out[-1][3].append((length, same))
        else:
            out.append([start, stop, {first_id}, [(length, same)]])
    return [(s, e, sorted(ids), min(1.0, sum(x for _, x in shares) / sum(n for n, _ in shares))) for s, e, ids, shares in out]


_WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def cut_text(text: str, spans: list[tuple[int, int]]) -> str:
    """The text without some runs of words (start, n_words), each with the white space behind it."""
    raw = text.encode()
    places = [m.span() for m in _WORD.finditer(raw)]
    out, at = [], 0
    for start, n in sorted(spans):
        out.append(raw[at : places[start][0]])
        at = places[start + n][0] if start + n < len(places) else len(raw)
    return b"".join([*out, raw[at:]]).decode()


def without_passages(run: Run, docs: DataFrame) -> DataFrame:
    """``docs`` with all columns, passages that documents of smaller id have cut from the texts.

    n_chars is counted anew where there is such a column. A document with no word left is dropped;
    one that had none before stays, and so does, as it was, a text whose doc_id is NULL or repeated.
    """
    found = run.written(passages(run, docs), "passages", free=True)
    once = docs.groupBy("doc_id").count().where("count = 1").select("doc_id")
    spans = found.groupBy("doc_id").agg(F.collect_list(F.struct("start", "n_words")).alias("spans")).join(once, "doc_id", "left_semi")
    rows = docs.select(F.struct("*").alias("row"), "doc_id")
    rows = rows.join(spans.hint("merge"), "doc_id", "left").select("row.*", F.col("spans").alias("passage spans"))
    names = docs.columns

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, going = [], []
            for text, some in zip(batch.column("text").to_pylist(), batch.column("passage spans").to_pylist()):
                texts.append(cut_text(text, [(s["start"], s["n_words"]) for s in some]) if some else text)
                going.append(not some or bool(words(texts[-1])))
            columns = {name: batch.column(name) for name in names}
            columns["text"] = pa.array(texts, columns["text"].type)
            if "n_chars" in columns:
                lengths = [len(t) if s else n for t, s, n in zip(texts, batch.column("passage spans").to_pylist(), columns["n_chars"].to_pylist())]
                columns["n_chars"] = pa.array(lengths, columns["n_chars"].type)
            yield pa.RecordBatch.from_arrays(list(columns.values()), names).filter(pa.array(going, pa.bool_()))

    return rows.mapInArrow(cut, docs.schema)


def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages(Run(spark, "op4"), spark.read.parquet(f"{sf_dir}/documents.parquet"))
