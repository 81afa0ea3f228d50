"""The pipeline, stage by stage, against plain Python over the same rows."""

import random
import zlib

import numpy as np
import public_tokenizers as P
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from tests.llm.test_dedup import brute_components, brute_fingerprint
from tidemark.llm import language_id, packing, passages, stage

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row string, spans int, digest string, kept int"
EN, DE = "the of and house water tree green with from this".split(), "der die und haus wasser baum schön mit aus dies".split()


@pytest.fixture(scope="module")
def corpus():
    """Texts of two languages with junk, copies, near copies and a passage; extra columns."""
    rng = random.Random(11)
    text = lambda words, n: [rng.choice(words) + rng.choice("abcdefgh") * rng.randrange(3) + str(rng.choice(["", "", "x", "yz"])) for _ in range(n)]
    rows, passage = [], text(EN, 70)
    for i in range(80):
        words = text(EN if i % 2 else DE, rng.randrange(80, 300))
        if i % 10 == 1:
            words[20:20] = passage
        rows.append((i, " ".join(words), "en" if i % 2 else "de"))
    rows += [(100 + i, rows[i][1].replace(" ", "\n ", 3), "en" if i % 2 else "de") for i in range(5)]  # copies but for white space
    rows += [(200 + i, rows[i][1] + " end", rows[i][2]) for i in range(40, 46)]  # near copies
    rows += [(300, None, "en"), (301, "", "de"), (302, "12 -- 34", None), (303, "12 -- 34", None), (None, rows[7][1] + " no id here", "en"), (50, rows[50][1], "de"), (50, rows[50][1], "de")]
    rows += [(400, " ".join(passage), "en")]
    return rows


def brute(rows, model):
    rows = [r for r in rows if (p := model.predict(r[1]))[0] != "und" and p[1] >= corpus_pipeline.MIN_SCORE]
    yield sorted(rows, key=str)
    groups = {}
    for r in rows:
        groups.setdefault(r[1].translate(dict.fromkeys(map(ord, " \t\n\x0b\x0c\r"))), []).append(r)
    rows = [min(g, key=lambda r: (-len(r[1]), r[0] is None, r[0])) for g in groups.values()]
    yield sorted(rows, key=str)
    named = [r for r in rows if r[0] is not None]
    fps = {r[0]: brute_fingerprint(r[1]) for r in named}
    part = brute_components(list(fps), list(fps.values()))
    by_fp = {fps[i]: part[i] for i in fps}
    rows = [r for r in rows if (part[r[0]] == r[0] if r[0] is not None else by_fp.get(brute_fingerprint(r[1])) is None)]
    yield sorted(rows, key=str)


def test_stages(spark, corpus):
    docs = spark.createDataFrame([(i, t, lang, "s", len(t or ""), "r", 1, "d", 0) for i, t, lang in corpus], SCHEMA)
    model = language_id.fit(docs)
    expected = list(brute(corpus, model))
    for (name, stage), rows in zip(corpus_pipeline.STAGES[:3], expected):
        out = stage(spark, docs, "")
        assert out.columns == docs.columns
        assert sorted([(r.doc_id, r.text, r.lang) for r in out.collect()], key=str) == rows, name
        docs = spark.createDataFrame(out.collect(), SCHEMA)
    before = {r.doc_id: r.text for r in docs.collect()}
    out = corpus_pipeline.STAGES[3][1](spark, docs, "")
    assert out.columns == docs.columns
    after = {r.doc_id: r for r in out.collect()}
    holders = sorted(i for i in before if i is not None and (i < 80 and i % 10 == 1 or i == 101))  # 101 is a copy of 1
    assert set(before) - set(after) == {400} and len(holders) > 5
    for i, text in before.items():
        if i in holders[1:]:
            lost = len(text.split()) - len(after[i].text.split())
            assert 68 <= lost <= 74 and after[i].n_chars == len(after[i].text)
        elif i != 400:
            assert after[i].text == text
    docs = spark.createDataFrame(list(after.values()), SCHEMA)
    encode = Tokenizer.from_file(P.path(packing.TOKENIZER))
    got = corpus_pipeline.STAGES[4][1](spark, docs, "").collect()
    for r in got:
        ids = [*encode.encode(after[r.doc_id].text, add_special_tokens=False).ids, 0]
        assert r.ids_crc32 == zlib.crc32(np.array(ids[r.start : r.start + r.length], "<u4").tobytes())
    assert {r.doc_id for r in got} == set(after)


def test_run_is_its_stages(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        docs = spark.createDataFrame(stage(spark, docs, sf).collect(), docs.schema) if stage is not corpus_pipeline.sequences else stage(spark, docs, sf)
    docs = docs.collect()  # a second run deletes what a first one has left
    key = lambda r: (r.doc_id, r.piece, r.start, r.length, r.ids_crc32)
    assert sorted(map(key, corpus_pipeline.run(spark, sf).collect())) == sorted(map(key, docs))


def test_empty_table(spark, corpus):
    docs = spark.createDataFrame([], SCHEMA)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, "").collect() == []


def test_cut_text():
    assert passages.cut_text("a  b\tç d\n", [(1, 2)]) == "a  d\n"
    assert passages.cut_text(" a b c", [(0, 1), (2, 1)]) == " b "
    assert passages.cut_text("a b", [(0, 2)]) == ""


def test_texts_go_to_workers_a_few_mb_at_a_time(spark):
    """10,000 long texts are not one batch, in an executor and again in its worker."""
    import pyarrow as pa

    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.nbytes])], ["n"])

    before = spark.conf.get(stage.BATCH_BYTES)
    try:
        stage.Run(spark, "test-batches")
        docs = spark.range(0, 300, 1, 1).selectExpr("repeat('abcdefghij', 10000) AS text")
        found = [r.n for r in docs.mapInArrow(sizes, "n long").collect()]
    finally:
        spark.conf.set(stage.BATCH_BYTES, before)
    assert sum(found) >= 300 * 100_000 and max(found) <= int(stage.BATCH) + 200_000
