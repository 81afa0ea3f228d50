"""Filter audit, ranked search and the inverted multi-index against brute force."""

import math
import random
from collections import Counter
from itertools import permutations

import numpy as np
import pyarrow as pa
import pytest

from tidemark.llm import filter_audit, multi_index, ranked_search
from tidemark.llm.stage import Run

DOCS = "doc_id long, text string, lang string, mask int, range int, part string, n long, raw string, key string"
LABELS = "doc_id long, quality int, toxic int, nth long"


def docs_frame(spark, rows):
    return spark.createDataFrame([(i, t, lang, 1, 2, "p", 3, "r", "k") for i, t, lang in rows], DOCS)


# ---- filters ----------------------------------------------------------------------------


def fails(text):
    raw = text.encode()
    words = raw.split()
    upper = sum("A" <= c <= "Z" for c in text)
    return {x for x, bad in zip("ABCD", (len(words) < 100, 100 * len(set(words)) < 80 * len(words), 100 * upper > 10 * len(text), any(c in "#$%&*|" for c in text))) if bad}


def brute_audit(rows, labels):
    least = {}
    for i, text, _ in rows:
        if i is not None:
            least[text or ""] = min(least.get(text or "", i), i)
    says = [{d for d, *both in labels if both[k] == 1 and d is not None} for k in (0, 1)]
    judged = [(lang, fails(text or "") | ({"E"} if i is not None and i > least[text or ""] else set()), i in says[0], i in says[1]) for i, text, lang in rows]
    out = {}
    for order in permutations("ABCDE"):
        for lang, bad, good, toxic in judged:
            gone = False
            for step, x in enumerate(order, 1):
                row = out.setdefault((lang or "", "".join(order), step), Counter())
                if x not in bad:
                    row["kept"] += not gone
                    continue
                row["redundant" if gone else "removed"] += 1
                row["unique_fails"] += bad == {x}
                row["good_lost"] += good and not gone
                row["toxic_lost"] += toxic and not gone
                gone = True
    shares = Counter()
    for (part, order, step), row in out.items():
        shares[part, order[step - 1]] += row["removed"]
    for (part, order, step), row in out.items():
        row["shapley"] = shares[part, order[step - 1]]
    return out


def test_audit(spark):
    rng = random.Random(1)
    texts = [" ".join(rng.choice((f"w{rng.randrange(500)}", "Word", "the", "a#b", "élan")) for _ in range(rng.choice((3, 99, 100, 150)))) for _ in range(12)]
    texts += ["", None, " \t\n", "a" * 200_000, "x\x1cy " * 100, "shared beginning " * 200 + "a", "shared beginning " * 200 + "b", "shared beginning " * 200, "A" * 9 + "b" * 81, "A" * 9 + "b" * 80]
    rows = [(i, rng.choice(texts), rng.choice(("en", "fr", None, ""))) for i in range(300)]
    rows += [(400 + i, texts[0], "en") for i in range(200)] + [rows[3], rows[3], (None, texts[0], "de"), (None, None, None), (5, texts[1], "de")]
    labels = [(i, i % 2, i % 3 == 0) for i in range(0, 500, 2)] + [(3, 0, 1), (3, 1, None), (None, 1, 1), (10**6, 1, 1)]
    frame = spark.createDataFrame([(i, q, None if t is None else int(t), 7) for i, q, t in labels], LABELS)
    expected = brute_audit(rows, [(i, q, t) for i, q, t in labels])
    for held in (64 << 20, 1000):
        filter_audit.HELD = held
        got = filter_audit.audit(Run(spark, "test11"), docs_frame(spark, rows).repartition(5), frame).collect()
        assert len(got) == len(expected) == 4 * 600
        for r in got:
            want = expected[r.part, r.filter_order, r.step]
            assert {c: r[c] for c in ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")} == {c: want[c] for c in ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")}
            assert r.filter == r.filter_order[r.step - 1]
    filter_audit.HELD = 64 << 20
    assert filter_audit.audit(Run(spark, "test11"), docs_frame(spark, rows).limit(0), frame).collect() == []


def test_trie_against_a_dictionary():
    rng = random.Random(2)
    trie, least, nodes = filter_audit.Trie(), {}, {}
    for _ in range(5000):
        text, doc_id = bytes(rng.choice(b"ab\x00\xff") for _ in range(rng.randrange(9))), rng.randrange(1000)
        least[text] = min(least.get(text, doc_id), doc_id)
        nodes[text] = trie.put(text, doc_id)
    assert all(trie.terminal(t)[2] == i and trie.terminal(t) is nodes[t] for t, i in least.items())


def test_range_bounds_follow_shared_beginnings(spark):
    texts = [("http header\n" * 50 + f"{i:04d}",) for i in range(400)] + [(f"{i}",) for i in range(40)]
    frame = spark.createDataFrame(texts, "text string").selectExpr("CAST(text AS BINARY) AS text")
    bounds = filter_audit.range_bounds(frame, 8)
    assert bounds == sorted(bounds) and 4 <= len(bounds) <= 7
    sizes = Counter(filter_audit.bisect_right(bounds, t.encode()) for t, in texts)
    assert max(sizes.values()) <= 150
    assert filter_audit.range_bounds(frame.limit(0), 8) == filter_audit.range_bounds(frame, 1) == []


# ---- ranked search ----------------------------------------------------------------------


def brute_ranking(docs, items, k=10):
    split = lambda t: ranked_search.terms(t)
    parsed = [(i, Counter(split(t))) for i, t in docs if split(t)]
    n, total = len(parsed), sum(sum(c.values()) for _, c in parsed)
    df = Counter(t for _, c in parsed for t in c)
    wanted = {}
    for item_id, text in items:
        if item_id is not None and text is not None:
            wanted.setdefault(item_id, set()).update(split(text))
    out = {}
    for item_id, some in wanted.items():
        scores = []
        for i, c in parsed:
            m = 100 - 90 + (90 * sum(c.values()) * n) // total
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((1000000000 * c[t]) // (1000 * c[t] + 8 * m)) for t in some if c[t])
            if score > 0 and i is not None:
                scores.append((-score, i))
        out[item_id] = [(i, -s) for s, i in sorted(scores)[:k]]
    return {i: x for i, x in out.items() if x}


def ranking(spark, docs, items, **more):
    frame = spark.createDataFrame([(i, t, 5, 6, 7) for i, t in docs], "doc_id long, text string, score int, rank int, item_id int").repartition(4)
    asked = spark.createDataFrame([(i, t, 5) for i, t in items], "item_id long, text string, doc_id int")
    out = {}
    for r in sorted(ranked_search.ranked(Run(spark, "test12"), frame, asked, **more).collect(), key=lambda r: (r.item_id, r.rank)):
        out.setdefault(r.item_id, []).append((r.doc_id, r.score))
        assert r.rank == len(out[r.item_id])
    return out


def test_ranking(spark, monkeypatch):
    rng = random.Random(3)
    word = lambda: f"w{int(rng.paretovariate(0.7)) % 400}"
    docs = [(i, " ".join(word() for _ in range(rng.choice((1, 5, 60, 300))))) for i in range(700)]
    docs += [(1000 + i, "Common TEXT, again: naïve Ünder_score") for i in range(60)]  # ties
    docs += [(2000, None), (2001, ""), (2002, " -_. "), (None, "w1 w2 w3"), (2003, "w1 " * 50_000), docs[0], docs[0], (2004, "again\x7fnaïve")]
    items = [(i, " ".join(word() for _ in range(rng.choice((1, 3, 40))))) for i in range(40)]
    items += [(100, "again common"), (101, "naïve ünder SCORE"), (102, "nowhere"), (103, None), (104, ""), (None, "w1"), (0, "w7 w8"), (105, docs[2][1])]
    expected = brute_ranking(docs, items)
    assert ranking(spark, docs, items) == expected
    monkeypatch.setattr(ranked_search, "SHARD_DOCS", 37)
    monkeypatch.setattr(ranked_search, "ITEM_BYTES", 200)
    monkeypatch.setattr(ranked_search, "FIRST_READ", 1)
    assert ranking(spark, docs, items) == expected
    assert ranking(spark, [], items) == ranking(spark, docs, []) == ranking(spark, [(1, "..")], items) == {}


def test_reading_stops_early_and_loses_no_tie():
    rng = np.random.default_rng(4)
    n, n_terms = 20_000, 4
    impacts = rng.zipf(1.5, n * n_terms).clip(1, 10**6).astype(np.int64)
    lists = ranked_search.Lists(np.arange(n), np.arange(1, n + 1) * n_terms, np.tile(np.arange(n_terms), n), impacts, n_terms)
    totals = impacts.reshape(n, n_terms).sum(axis=1)
    expected = np.lexsort((np.arange(n), -totals))[:10]
    met = []
    unique = np.unique
    ranked_search.np.unique = lambda x: met.append(len(x)) or unique(x)
    try:
        ids, scores = lists.best(np.arange(n_terms), 10)
    finally:
        ranked_search.np.unique = unique
    assert ids.tolist() == expected.tolist() and scores.tolist() == totals[expected].tolist()
    assert sum(met) < n / 10
    assert not lists.met.any() and not lists.seen.any() and not lists.wanted.any()


# ---- inverted multi-index ---------------------------------------------------------------


def brute_links(rows, similarity=0.95):
    good = [(k, i, np.array(v, float) / max(map(abs, v))) for k, (i, v) in enumerate(rows) if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    near = {k: set() for k in range(len(rows))}
    for a, (k, _, v) in enumerate(good):
        for m, _, w in good[:a]:
            if len(v) == len(w) and v @ w / math.sqrt(v @ v) / math.sqrt(w @ w) >= similarity:
                near[k].add(m)
                near[m].add(k)
    out = []
    for k, (i, _) in enumerate(rows):
        reached, todo = {k}, [k]
        while todo:
            for m in near[todo.pop()] - reached:
                reached.add(m)
                todo.append(m)
        out.append((i, len(near[k]), min((rows[m][0] for m in reached), default=None) if i is not None else None))
    return out


def vectors_frame(spark, rows):
    return spark.createDataFrame([(i, v, 1, 2, 3) for i, v in rows], "vec_id long, v array<double>, key int, node int, size int").repartition(3)


def clusters(rng, n, dim, spread):
    base = rng.normal(size=(n // 5, dim))
    return [(base[rng.integers(len(base))] + spread * rng.normal(size=dim)).round(3).tolist() for _ in range(n)]


@pytest.mark.parametrize("block", [4096, 40])
def test_all_links_with_a_target_of_one(spark, block, monkeypatch):
    monkeypatch.setattr(multi_index, "OCCUPANCY", 8)
    rng = np.random.default_rng(5)
    rows = [(i, v) for i, v in enumerate(clusters(rng, 400, 6, 0.15))]
    rows += [(500 + i, [1.0, 2.0, -0.0, 0.0, 0.0, 3.0]) for i in range(80)] + [(600, [2.0, 4.0, 0.0, 0.0, 0.0, 6.0]), (601, [1e200, 2e200, 0.0, 0.0, 0.0, 3e200])]
    rows += [(700, None), (701, []), (702, [0.0] * 6), (703, [float("nan")] * 6), (704, [None] + [1.0] * 5), (705, [float("inf")] * 6), (None, [1.0] * 6)]
    rows += [(800, [1.0, 2.0, 0.0, 0.0, 0.0]), (801, [1.0, 2.0, 0.0, 0.0, 0.1]), (802, [3.0]), (803, [-3.0]), (804, [0.5])]
    got = multi_index.near_duplicates(Run(spark, "test13"), vectors_frame(spark, rows), "v", target=1.0, block=block).collect()
    key = lambda x: (x[0] is None, x[0] or 0)
    assert sorted(((r.vec_id, r.n_links, r.component_id) for r in got), key=key) == sorted(brute_links(rows), key=key)
    assert all(r.kept == (r.vec_id is not None and r.vec_id == r.component_id) for r in got)
    assert multi_index.near_duplicates(Run(spark, "test13"), vectors_frame(spark, rows).limit(0), "v").collect() == []
    invalid = [(1, None), (2, [0.0])]
    assert sorted(tuple(r) for r in multi_index.near_duplicates(Run(spark, "test13"), vectors_frame(spark, invalid), "v").collect()) == [(1, 0, 1, True), (2, 0, 2, True)]


def test_cells_come_nearest_first_and_once():
    rng = np.random.default_rng(6)
    for _ in range(50):
        first, second = rng.integers(0, 9, 7) / 4, rng.integers(0, 9, 5) / 4
        got = list(multi_index.nearest_cells(first, second, 2.5))
        sums = [first[i] + second[j] for i, j in got]
        assert sums == sorted(sums) and len(set(got)) == len(got)
        assert set(got) == {(i, j) for i in range(7) for j in range(5) if first[i] + second[j] <= 2.5}
    assert all(multi_index.visits(a, b) != multi_index.visits(b, a) for a in range(20) for b in range(20) if a != b)


def test_recall_of_the_shipped_parameters(spark):
    """Vectors of 64 numbers, those of a pair just at the least similarity and a little above."""
    rng = np.random.default_rng(7)
    base = rng.normal(size=(3000, 64))
    base /= np.linalg.norm(base, axis=1)[:, None]
    aside = rng.normal(size=base.shape)
    aside -= (aside * base).sum(axis=1)[:, None] * base
    aside /= np.linalg.norm(aside, axis=1)[:, None]
    cosine = rng.uniform(0.9501, 0.97, size=(3000, 1))
    rows = [(i, v.tolist()) for i, v in enumerate(np.concatenate((base, cosine * base + np.sqrt(1 - cosine**2) * aside)))]
    got = {r.vec_id: r for r in multi_index.near_duplicates(Run(spark, "test13"), vectors_frame(spark, rows), "v").collect()}
    assert len(got) == 6000 and all(r.n_links <= 1 and r.component_id in (i, i % 3000) for i, r in got.items())
    assert sum(got[i].n_links for i in range(3000)) / 3000 >= 0.98
