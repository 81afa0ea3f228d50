"""Nearest neighbours and shared passages against brute force."""

import random

import numpy as np
import pytest

from tidemark.llm import hnsw, passages
from tidemark.llm.stage import Run


def brute_nearest(rows, step, k):
    good = [(i, np.array(v)) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    out = {}
    for q, v in good:
        if q % step == 0:
            found = {}
            for i, w in good:
                if i != q and len(w) == len(v):
                    found[i] = min(found.get(i, np.inf), float(np.sqrt(((v - w) ** 2).sum())))
            out[q] = sorted((d, i) for i, d in found.items())[:k]
    return out


def test_recall(spark, sf):
    table = spark.read.parquet(f"{sf.replace('sf0.001', 'sf0.1')}/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in table.collect()]
    expected = brute_nearest(rows, 100, 10)
    got = hnsw.nearest(Run(spark, "test3"), table, "embedding", shard=700).collect()
    assert len(got) == 10 * len(expected)
    hits = sum(r.vec_id in {i for _, i in expected[r.query_id]} for r in got)
    assert hits / len(got) >= 0.95
    whole = hnsw.nearest(Run(spark, "test3"), table, "embedding").collect()
    assert sum(r.vec_id in {i for _, i in expected[r.query_id]} for r in whole) / len(whole) >= 0.95
    vectors = dict(rows)
    for r in got:
        exact = np.sqrt(((np.array(vectors[r.query_id]) - np.array(vectors[r.vec_id])) ** 2).sum())
        assert r.score == pytest.approx(exact, rel=1e-12) and r.vec_id != r.query_id


def test_recall_of_full_shards(spark):
    """Default parameters, on vectors without any structure: the hardest that a shard can hold."""
    rng = np.random.default_rng(12)
    vectors = rng.standard_normal((2 * hnsw.SHARD, 64))
    table = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, v array<double>")
    got = hnsw.nearest(Run(spark, "test3"), table, "v", query_step=50).collect()
    queries = range(0, len(vectors), 50)
    assert len(got) == 10 * len(queries)
    nearest = {q: set(np.argsort(((vectors - vectors[q]) ** 2).sum(axis=1), kind="stable")[1:11].tolist()) for q in queries}
    recall = sum(r.vec_id in nearest[r.query_id] for r in got) / len(got)
    assert recall >= 0.9


def test_nearest_edges(spark):
    rng = np.random.default_rng(2)
    rows = [(i, rng.random(4).round(1).tolist()) for i in range(300)]
    rows += [(i, [0.5, 0.5, 0.5, 0.5]) for i in range(300, 400)]  # one vector many times
    rows += [(400, None), (401, []), (402, [0.0] * 4), (403, [float("nan"), 1.0, 1.0, 1.0]), (404, [None, 1.0, 1.0, 1.0]), (405, [float("inf")] * 4), (None, [1.0] * 4)]
    rows += [(500, [1.0, 2.0]), (501, [1.0, 3.0]), (600, [7.0]), (10, rows[10][1]), (20, rows[20][1])]
    docs = spark.createDataFrame([(i, v, 1, 2.0) for i, v in rows], "vec_id long, v array<double>, shard int, score double")
    got = hnsw.nearest(Run(spark, "test3"), docs, "v", query_step=10, shard=60).orderBy("query_id", "rank").collect()
    expected = brute_nearest(rows, 10, 10)
    # Shards of about the search width are scanned or nearly so: the result is that of brute force.
    assert [(r.query_id, r.rank, r.vec_id) for r in got] == [(q, n, i) for q in sorted(expected) for n, (_, i) in enumerate(expected[q], 1)]
    assert [r.vec_id for r in got if r.query_id == 500] == [501] and not [r for r in got if r.query_id == 600]
    assert hnsw.nearest(Run(spark, "test3"), docs.limit(0), "v").collect() == []


def test_index_is_stored_whole():
    rng = np.random.default_rng(3)
    index = hnsw.ShardIndex.built(np.arange(500), rng.random((500, 8)))
    again = hnsw.ShardIndex.from_bytes(index.to_bytes())
    for q in rng.random((5, 8)):
        assert index.nearest(-1, q, 5, 64)[0].tolist() == again.nearest(-1, q, 5, 64)[0].tolist()


SCHEMA = "doc_id long, text string, start int, hash string, tiles int, chain int"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, 1, "h", 2, 3) for i, t in rows], SCHEMA)


def found(spark, rows):
    return passages.passages(Run(spark, "test4"), frame(spark, rows)).collect()


def test_chains_against_all_predecessors():
    rng = random.Random(4)
    for _ in range(50):
        some = sorted({(rng.randrange(60), rng.randrange(60)) for _ in range(rng.randrange(1, 40))})
        a, b = [x for x, _ in some], [y for _, y in some]
        score = []
        for i in range(len(a)):
            gains = [score[j] - passages.GAP_COST * (a[i] + b[i] - a[j] - b[j]) for j in range(i) if a[j] < a[i] and b[j] < b[i]]
            score.append(passages.K + max([0.0, *gains]))
        made = passages.chains(a, b)
        assert sorted(i for c in made for i in c) == list(range(len(a)))
        best = made[0]
        total = passages.K * len(best) - passages.GAP_COST * (a[best[-1]] - a[best[0]] + b[best[-1]] - b[best[0]])
        assert total == pytest.approx(max(score))
        assert all(a[i] < a[j] and b[i] < b[j] for c in made for i, j in zip(c, c[1:]))


def test_seeds_are_shared():
    rng = random.Random(5)
    for _ in range(30):
        shared = [b"s%d" % rng.randrange(10**6) for _ in range(passages.K + passages.WINDOW - 1)]
        docs = [[b"w%d" % rng.randrange(10**6) for _ in range(40)] + shared + [b"w%d" % rng.randrange(10**6) for _ in range(40)] for _ in range(2)]
        hashes = [set(passages.seeds(passages.word_hashes(d))[0].tolist()) for d in docs]
        assert hashes[0] & hashes[1]


def test_common_words():
    rng = np.random.default_rng(6)
    for _ in range(40):
        a, b = rng.integers(0, 4, rng.integers(1, 12)), rng.integers(0, 4, rng.integers(1, 12))
        t = np.zeros((len(a) + 1, len(b) + 1), int)
        for i in range(len(a)):
            for j in range(len(b)):
                t[i + 1, j + 1] = t[i, j] + 1 if a[i] == b[j] else max(t[i, j + 1], t[i + 1, j])
        assert passages._common_words(a, b) == t[-1, -1]


def test_planted_passages(spark):
    rng = random.Random(7)
    word = lambda: f"w{int(rng.paretovariate(0.6)) % 50000}"  # noqa: E731  common words and rare ones

    def edited(text, every):
        out = []
        for i, w in enumerate(text):
            kind = rng.random() if i % every == every - 1 else 1
            out += [word(), w] if kind < 0.2 else [] if kind < 0.4 else [word()] if kind < 1 else [w]
        return out

    planted = [[word() for _ in range(n)] for n in (55, 60, 80, 150, 400)]
    rows, spans = [], {}
    for i in range(150):
        text = [word() for _ in range(rng.randrange(60, 500))]
        if i % 3 == 0:
            passage = planted[(i // 3) % len(planted)]
            at = rng.randrange(len(text))
            copy = passage if i < 15 or i % 2 else edited(passage, 14)
            text[at:at] = copy
            if i >= 15:
                spans[i] = (at, at + len(copy))
        rows.append((i, rng.choice((" ", "\n", " \t")).join(text)))
    hot = [word() for _ in range(70)]
    for i in range(1000, 1120):
        rows.append((i, " ".join([word() for _ in range(30)] + hot + [word() for _ in range(30)])))
        if i > 1000:
            spans[i] = (30, 100)
    rows += [(2000, None), (2001, ""), (2002, "a b c"), (2003, "x " * 3000), (None, rows[0][1]), (2004, "LINE one " * 30), (2005, "line ONE " * 30)]
    spans[2005] = (0, 60)
    got = {}
    for r in found(spark, rows):
        got.setdefault(r.doc_id, []).append(r)
        assert r.similarity >= 0.8 and r.n_words >= 50 and all(i < r.doc_id for i in r.first_ids)
    assert set(got) <= set(spans)
    short = [i for i, (s, e) in spans.items() if i not in got]
    # Exact copies are all found; of edited ones of just 55 to 60 words few may be missed.
    assert not [i for i in short if i % 2 or i >= 1000] and len(short) <= 3
    for i, rs in got.items():
        s, e = spans[i]
        covered = {p for r in rs for p in range(r.start, r.start + r.n_words)}
        assert len(covered & set(range(s, e))) >= 0.85 * (e - s) and len(covered - set(range(s, e))) <= 6


def test_passages_of_copies_and_pieces(spark):
    rng = random.Random(8)
    words = [f"v{rng.randrange(10**6)}" for _ in range(400)]
    # The second document holds the parts of the third one's passage, in another order.
    rows = [(1, " ".join(words[:40])), (2, " ".join(words[40:80])), (3, " ".join(words[:80])), (4, " ".join(words[200:])), (4, " ".join(words[200:])), (5, " ".join(words[200:]))]
    got = {r.doc_id: r for r in found(spark, rows)}
    assert set(got) == {3, 5}
    assert (got[3].start, got[3].n_words, got[3].first_ids) == (0, 80, [1, 2]) and got[5].n_words == 200
    assert found(spark, []) == []


def fresh(rng, n):
    return [f"u{rng.randrange(10**9)}" for _ in range(n)]


def test_passages_of_sentences_seen_alone(spark):
    """Each sentence stands alone in an earlier document; only seeds across their borders lead to the passage."""
    rng, rows, expected = random.Random(9), [], {}
    for i in range(0, 600, 10):
        sentences = [fresh(rng, rng.randrange(17, 20)) for _ in range(3)]
        rows += [(i + n, " ".join(fresh(rng, 20) + x + fresh(rng, 20))) for n, x in enumerate(sentences)]
        passage = sum(sentences, [])
        rows += [(i + n, " ".join(fresh(rng, 30) + passage + fresh(rng, 30))) for n in (5, 6)]
        expected[i + 6] = (30, len(passage), [i + 5]) if len(passage) >= 50 else None
    got = {r.doc_id: (r.start, r.n_words, r.first_ids) for r in found(spark, rows)}
    assert got == {i: x for i, x in expected.items() if x}


def test_edited_passages_give_seeds():
    rng, hits, trials = random.Random(10), 0, 400
    for _ in range(trials):
        text = fresh(rng, 60)
        copy = list(text)
        for i in rng.sample(range(60), 11):  # similarity 0.82
            copy[i] = fresh(rng, 1)[0]
        a, b = (set(passages.seeds(passages.word_hashes([w.encode() for w in fresh(rng, 20) + x + fresh(rng, 20)]))[0].tolist()) for x in (text, copy))
        hits += len(a & b) >= passages.MIN_SEEDS
    assert hits / trials >= 0.95


def test_unique_words_between_passages_are_kept(spark):
    rng = random.Random(11)
    a, b, mine = fresh(rng, 21), fresh(rng, 21), fresh(rng, 8)
    rows = [(1, " ".join(fresh(rng, 30) + a)), (2, " ".join(fresh(rng, 30) + b)), (3, " ".join(a + mine + b))]
    assert found(spark, rows) == []
    piece = lambda start, first_start, first_id=1: {"start": start, "n_words": 30, "first_id": first_id, "first_start": first_start, "first_words": 30, "matched": 30}
    assert passages._joined([piece(0, 0), piece(35, 33)]) == [(0, 65, [1], 60 / 65)]
    assert len(passages._joined([piece(0, 50), piece(35, 0)])) == len(passages._joined([piece(0, 0), piece(35, 33, 2)])) == 2


def plain_alignment(a, b, x, y):
    """The rule of ``passages.aligned`` word by word, over lists."""

    def run(p, q):
        n = 0
        while n < min(len(p), len(q)) and p[n] == q[n]:
            n += 1
        return n

    def onwards(p, q):
        out, i, j = [], 0, 0
        while True:
            for di, dj in passages._SKIPS:
                if run(p[i + di : i + di + passages.RESUME], q[j + dj : j + dj + passages.RESUME]) == passages.RESUME:
                    n = run(p[i + di :], q[j + dj :])
                    out.append((i + di, i + di + n, j + dj, j + dj + n))
                    i, j = i + di + n, j + dj + n
                    break
            else:
                return out

    first = (x - run(a[:x][::-1], b[:y][::-1]), x + run(a[x:], b[y:]), y - run(a[:x][::-1], b[:y][::-1]), y + run(a[x:], b[y:]))
    if first[0] == first[1]:
        return []
    before = [(first[0] - q, first[0] - p, first[2] - s, first[2] - r) for p, q, r, s in onwards(a[: first[0]][::-1], b[: first[2]][::-1])]
    after = [(first[1] + p, first[1] + q, first[3] + r, first[3] + s) for p, q, r, s in onwards(a[first[1] :], b[first[3] :])]
    return [*before[::-1], first, *after]


def test_alignment_against_plain_words():
    """Runs around a seed, found in bytes, are those found word by word: their outermost ends bound the passages."""
    rng = random.Random(12)
    for _ in range(400):
        a = [rng.randrange(rng.choice([2, 9, 500])) for _ in range(rng.randrange(1, 150))]
        b = [w for w in a if rng.random() > 0.05] + [7]
        for _ in range(3):
            b[rng.randrange(len(b))] = rng.randrange(9)
        x, y = rng.randrange(len(a)), rng.randrange(len(b))
        raw = [np.array(w, "<u4").tobytes() for w in (a, b)]
        parts = plain_alignment(a, b, x, y)
        around = [(p, q, r, s) for p, q, r, s in parts if (p, q) != (q, q)]
        made = [(x - passages._behind(*raw, x, y), x + passages._ahead(*raw, x, y), y - passages._behind(*raw, x, y), y + passages._ahead(*raw, x, y))]
        made = passages._earlier(*raw, made[0][0], made[0][2])[::-1] + made + passages._later(*raw, made[0][1], made[0][3]) if made[0][0] < made[0][1] else []
        assert made == around
        for start, end, first_start, first_end, same in passages.aligned(*raw, [x], [y]):
            assert (start, first_start) in {(p[0], p[2]) for p in parts} and (end, first_end) in {(p[1], p[3]) for p in parts}
            assert same <= min(end - start, first_end - first_start)


def test_alignment_of_a_lone_seed_is_quick():
    """Most chains are one seed that nothing follows; looking beyond it makes no array operation."""
    import sys

    rng = np.random.default_rng(13)
    a, b = (rng.integers(0, 1 << 32, 300, dtype=np.uint32) for _ in range(2))
    b[100:105] = a[200:205]
    calls = 0

    def count(frame, event, function):
        nonlocal calls
        calls += event == "c_call" and (getattr(function, "__module__", "") or "").startswith("numpy")

    raw = a.tobytes(), b.tobytes()
    sys.setprofile(count)
    try:
        found = passages.aligned(*raw, [200], [100])
    finally:
        sys.setprofile(None)
    assert found == [(200, 205, 100, 105, 5)] and calls == 0


def test_seeds_are_the_first_minima_of_windows():
    rng = np.random.default_rng(14)
    for n in [*range(12), 80, 81]:
        hashes = rng.integers(0, 1 << 32, n).astype(np.uint32)
        all_kmers = passages.seeds(hashes[: passages.K])[0] if n >= passages.K else []
        assert len(all_kmers) == (n >= passages.K)
        h = np.array([passages.seeds(hashes[i : i + passages.K])[0].view(np.uint64)[0] for i in range(n - passages.K + 1)], np.uint64)
        width = min(passages.WINDOW, len(h))
        expected = sorted({i + int(h[i : i + width].argmin()) for i in range(len(h) - width + 1)}) if width else []
        assert passages.seeds(hashes)[1].tolist() == expected
