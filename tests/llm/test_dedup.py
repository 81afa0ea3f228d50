"""Exact and SimHash deduplication against plain Python."""

import hashlib
import random
from itertools import combinations

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import __spark_entry__ as contract
from checks.compare import difference
from tidemark.llm import exact_dedup, simhash_dedup
from tidemark.llm.components import components
from tidemark.llm.stage import Run

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, digest int, node string, fp string"


def frame(spark, rows):
    """Rows of (doc_id, text) with more columns, some named like the operators' own."""
    return spark.createDataFrame([(i, t, None, "s", None, 7, "n", "f") for i, t in rows], SCHEMA)


def test_exact_sql(spark, sf):
    assert difference(spark, sf, "op6_exact_dedup") is None


def decided(spark, run, rows, index):
    return exact_dedup.deduplicated(run, frame(spark, rows), index).collect()


def test_exact_edges(spark):
    rows = [(1, "a b"), (2, "a  b"), (3, "ab"), (4, None), (5, ""), (6, " \t\n\x0b\x0c\r"), (7, "a b"), (8, "é" * 50000), (9, "é" * 50000), (None, "a   b"), (10, "x"), (10, "x")]
    run = Run(spark, "test6")
    index = exact_dedup.fresh(run)
    got = decided(spark, run, rows, index)
    by = {r.doc_id: r for r in got}
    assert len(got) == len(rows)
    assert by[1].keep_id is None and by[None].kept and by[1].group_size == 4
    assert by[4].keep_id == by[5].keep_id == by[6].keep_id == 6 and by[4].text_sha256 == hashlib.sha256(b"").hexdigest()
    assert by[7].group_size == 1 and by[8].keep_id == by[9].keep_id == 8
    assert sorted(r.kept for r in got if r.doc_id == 10) == [False, True]
    # The index remembers: what it holds is dropped, what is new is added, and it survives reopening.
    again = exact_dedup.DigestIndex(spark, "digest_index_again", f"{run.folder}/index")
    got = decided(spark, Run(spark, "test6b"), [(20, "a b"), (21, "new"), (22, "x ")], again)
    assert {r.doc_id: (r.keep_id, r.kept) for r in got} == {20: (None, False), 21: (21, True), 22: (10, False)}
    assert again.rows().count() == 6
    assert decided(spark, Run(spark, "test6c"), [], again) == []
    for name in (index.name, again.name):
        spark.sql(f"DROP TABLE {name}")


def brute_fingerprint(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", low) if w]
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def brute_components(ids, fps):
    parent = {i: i for i in ids}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for (i, f), (j, g) in combinations(zip(ids, fps), 2):
        if (f ^ g).bit_count() <= 3:
            a, b = sorted((find(i), find(j)))
            parent[b] = a
    return {i: find(i) for i in ids}


def test_fingerprints_are_spark_hashes(spark):
    assert spark.range(1).select(F.xxhash64(F.lit("a b ç"))).first()[0] % 2**64 == xxhash.xxh64_intdigest("a b ç".encode(), 42)


def check(spark, rows):
    out = simhash_dedup.near_duplicates(Run(spark, "test7"), frame(spark, rows)).collect()
    fps = [brute_fingerprint(t) for _, t in rows]
    expected = brute_components([i for i, _ in rows], fps)
    assert sorted((r.doc_id, r.fingerprint, r.component_id) for r in out) == sorted((i, f"{f:016x}", expected[i]) for (i, _), f in zip(rows, fps))


def test_near_duplicates(spark):
    rng = random.Random(1)
    words = [f"w{i}" for i in range(300)] + ["É", "Ä", "A", "B"]
    rows = []
    for i in range(60):
        text = [rng.choice(words) for _ in range(rng.choice((1, 2, 3, 40, 400, 3000)))]
        for _ in range(rng.choice((1, 1, 4))):
            copy = list(text)
            for _ in range(rng.choice((0, 0, 1, 2))):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            rows.append((len(rows), rng.choice((" ", "\n", " \t ")).join(copy)))
    rows += [(1000, None), (1001, ""), (1002, " \n"), (1003, "a b c"), (1004, "x " * 30000)]
    check(spark, rows)


def test_near_duplicates_without_rows_or_ids(spark):
    assert simhash_dedup.near_duplicates(Run(spark, "test7"), frame(spark, [])).collect() == []
    out = simhash_dedup.near_duplicates(Run(spark, "test7"), frame(spark, [(None, "a b c"), (3, "a b c"), (3, "a b c"), (None, "zz")])).collect()
    assert sorted((r.doc_id is None, r.component_id) for r in out if r.component_id) == [(False, 3), (False, 3), (True, 3)]


@pytest.mark.parametrize("compared", [4096, 20])
def test_large_postings_give_the_same_links(spark, monkeypatch, compared):
    """A dense ball of fingerprints; with a small limit its postings are split and looked up."""
    rng = random.Random(2)
    monkeypatch.setattr(simhash_dedup, "COMPARED", compared)
    fps = {0xDEADBEEF12345678}
    while len(fps) < 400:
        fps.add(rng.choice(sorted(fps)) ^ sum(1 << b for b in rng.sample(range(64), rng.choice((1, 2, 3, 4)))))
    fps = sorted(fps)
    table = spark.createDataFrame([(f - 2**64 if f >> 63 else f, i) for i, f in enumerate(fps)], "fp long, node long")
    run = Run(spark, "test7c")
    got = {r.node: r.root for r in components(run, simhash_dedup.linked(table)).collect()}
    expected = brute_components(list(range(len(fps))), fps)
    assert {i: got.get(i, i) for i in expected} == expected


def test_lookup_equals_comparison():
    rng = np.random.default_rng(3)
    fps = np.unique(rng.integers(0, 1 << 12, 300).astype(np.uint64) << np.uint64(20))
    from tidemark.llm.components import roots

    assert (roots(len(fps), *simhash_dedup._looked_up(fps)) == roots(len(fps), *simhash_dedup._compared(fps))).all()


def test_components_of_a_long_chain(spark):
    edges = spark.range(300).selectExpr("(id * 7919) % 301 AS a", "((id + 1) * 7919) % 301 AS b")
    got = {r.node: r.root for r in components(Run(spark, "chain"), edges).collect()}
    assert got == dict.fromkeys(range(301), 0)
    assert components(Run(spark, "chain"), edges.limit(0)).collect() == []


def test_registered():
    assert {"op6_exact_dedup", "op7_simhash_dedup"} <= set(contract.queries())
