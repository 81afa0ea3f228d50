"""Encoding, packing and token files against the libraries and plain Python."""

import base64
import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from tokenizers import Tokenizer

from tidemark.llm import bit_packing, byte_bpe, chunks, packing
from tidemark.llm.stage import Run

SCHEMA = "doc_id long, text string, row int, pack int, ids string, start string, n_chars long"
RNG = random.Random(4)
TEXTS = [
    "", "  a  b", " lead", "trail ", "a\n\n b", "  ", "\t x", "it's we'll  ok", "日本語 テスト １２ ½", "<|endoftext|> x<|startoftext|>", "ß ſ İi Σς ΑΣ é ́x Å",
    "a" * 5000, "ab" * 3000 + " " + "x" * 300, "   y", "\x1c\x1d a\x85b 1234 !!!??", "🙂🙂 ok‍", " " * 3000, "word " * 20000,
    *("".join(RNG.choice(" \n\tab'sAé1½²日!? ́-ÉŠ") for _ in range(RNG.randrange(60))) for _ in range(300)),
]


def frame(spark, texts):
    return spark.createDataFrame([(i, t, 1, 2, "i", "s", 3) for i, t in enumerate(texts)], SCHEMA)


@pytest.fixture(scope="module")
def reference():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(P.path(byte_bpe.RANKS), "rb"))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def library(name):
    tokenizer = Tokenizer.from_file(P.path(name))
    tokenizer.encode_special_tokens = True
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids


def raw(ids):
    return np.array(ids, "<u4").tobytes()


def test_byte_bpe(spark, reference):
    got = byte_bpe.round_trip(frame(spark, [*TEXTS, None, TEXTS[5]]), P.path(byte_bpe.RANKS)).collect()
    assert len(got) == len(TEXTS) + 2
    for r in got:
        text = [*TEXTS, "", TEXTS[5]][r.doc_id]
        ids = reference.encode_ordinary(text)
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(raw(ids)).hexdigest()), text[:60]
        assert r.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()
    assert byte_bpe.round_trip(frame(spark, []), P.path(byte_bpe.RANKS)).collect() == []


def test_encoded_gives_the_ids(spark, reference):
    got = {r.doc_id: r.ids for r in byte_bpe.encoded(frame(spark, ["a bc", None]), P.path(byte_bpe.RANKS)).collect()}
    assert got == {0: bytearray(raw(reference.encode_ordinary("a bc"))), 1: b""}


def test_merge_order_in_matrix_and_heap(reference):
    bpe = byte_bpe.from_file(P.path(byte_bpe.RANKS))
    words = ["".join(RNG.choice("aeinrst") for _ in range(n)) for n in (1, 2, 3, 7, 9, 30, 60, 200, 256, 257, 900) for _ in range(5)]
    assert bpe.merged([w.encode() for w in words]) == [raw(reference.encode_ordinary(w)) for w in words] == [bpe._long(w.encode()) for w in words]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_library_encoder(name, monkeypatch):
    encode, encoder = library(name), chunks.LibraryEncoder(P.path(name))
    expected = [raw(encode(t)) for t in TEXTS]
    assert encoder.known and encoder.encode(TEXTS) == expected
    monkeypatch.setattr(chunks, "REMEMBERED", 5)  # forgets all the time
    assert [encoder.encode([t])[0] for t in TEXTS] == expected


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_words_are_cut_as_the_library_does(name, monkeypatch):
    rng, encode, encoder = random.Random(6), library(name), chunks.LibraryEncoder(P.path(name))
    alphabets = (" 's'tT'rRvVlLeEdDmM'  \n\nxX.,19", "ab 'sS ré\nÀ×÷ŊŉİıßſΣ.,;1 23", " \n", " a\n", " \u3000\x85\xa0\x1ca'b")
    texts = ["".join(rng.choice(a) for _ in range(rng.randrange(40))) for a in alphabets for _ in range(500)]
    expected = [raw(encode(t)) for t in texts]
    assert encoder.encode(texts) == expected
    long = " ".join(t for t in texts if t.strip() == t)
    monkeypatch.setattr(chunks, "PART", 50)  # many batches, and long texts in parts
    monkeypatch.setattr(chunks, "WORDS", 8)  # forgets all the time
    assert encoder.encode([*texts, long, "", long]) == [*expected, raw(encode(long)), b"", raw(encode(long))]
    assert encoder.encode([]) == [] and encoder.encode(["", ""]) == [b"", b""]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_library_encoder_remembers_words_only(name):
    """Pieces joined of few words are many; a worker that keeps them all runs out of memory."""
    encode, encoder = library(name), chunks.LibraryEncoder(P.path(name))
    words = ["".join(RNG.choice("aeinrst") for _ in range(5)) for _ in range(150)]
    text = " ".join(f"{a}.\n{b}" for a in words for b in words)
    assert encoder.encode([text]) == [raw(encode(text))]
    kept = [x for x in vars(encoder).values() if isinstance(x, dict)]
    assert sum(len(x) + len(x.aside) for x in kept) < 1000
    strange = ["日本語" * 100 + str(i) for i in range(20)]
    assert encoder.encode(strange) == [raw(encode(t)) for t in strange]
    assert max(len(word) for x in kept for word in [*x, *x.aside]) <= chunks.LONGEST


@pytest.mark.parametrize("bits", [1, 5, 8, 13, 16, 17, 31, 32])
def test_bits(bits):
    ids = np.array([RNG.randrange(1 << bits) for _ in range(1000)], np.uint32)
    data = bit_packing.pack(ids, bits)
    assert len(data) == -(-1000 * bits // 8)
    for i, j in ((0, 1000), (0, 0), (3, 4), (17, 500), (999, 1000)):
        assert (bit_packing.unpack(data, bits, i, j) == ids[i:j]).all()
    assert bit_packing.width(1 << bits) == bits


def test_block_access():
    made = bit_packing.Block(bit_packing.block([5, None, 7], [raw([1, 2, 3]), b"", raw([4])], 3))
    assert made.document(0).tolist() == [1, 2, 3] and made.document(1).tolist() == [] and made.document(2).tolist() == [4]
    with pytest.raises(ValueError):
        bit_packing.block([1], [raw([8])], 3)
    with pytest.raises(ValueError):
        bit_packing.Block(b"x" * 50)


def test_token_files(spark, monkeypatch):
    monkeypatch.setattr(bit_packing, "BLOCK_IDS", 500)
    encode = library(bit_packing.TOKENIZER)
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(7, TEXTS[7]), (None, "none"), (-3, None)]
    docs = spark.createDataFrame([(i, t, 1, 2, "i", "s", 3) for i, t in RNG.sample(rows, len(rows))], SCHEMA)
    blocks = bit_packing.write(Run(spark, "test10"), docs, P.path(bit_packing.TOKENIZER))
    assert blocks.count() > 5
    expected, start = [], 0
    for i, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = [*encode(text), 2]
        expected.append((i, start, len(ids), zlib.crc32(raw(ids))))
        start += len(ids)
    got = [(r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in bit_packing.read(blocks).collect()]
    assert sorted(got, key=lambda r: r[1:]) == sorted(expected, key=lambda r: r[1:])
    empty = bit_packing.write(Run(spark, "test10"), docs.limit(0), P.path(bit_packing.TOKENIZER))
    assert bit_packing.read(empty).collect() == []


def test_packing(spark):
    encode = library(packing.TOKENIZER)
    texts = [*TEXTS, None, TEXTS[7], TEXTS[7], "a b c d e f g h i j k l " * 700]
    docs = frame(spark, texts).union(frame(spark, texts).where("doc_id = 7"))
    got = packing.packed(Run(spark, "test5"), docs, P.path(packing.TOKENIZER), group=200).collect()
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in got:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append(r)
    assert set(by_doc) == set(range(len(texts))) and len(by_doc[7]) == 2
    for i, rows in by_doc.items():
        ids = [*encode(texts[i]), 0]
        at = 0
        for r in sorted(rows, key=lambda r: r.piece)[: None if i != 7 else 1]:
            assert (r.start, r.ids_crc32) == (at, zlib.crc32(raw(ids[at : at + r.length])))
            assert r.length == 2048 or r.piece == 0
            at += r.length
        assert at == len(ids) and (len(rows) == -(-at // 2048) or i == 7)
    for rows in by_sequence.values():
        at = 0
        for r in sorted(rows, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 2048
    assert len(by_sequence) <= -(-sum(r.length for r in got) // 2048) + 4
    assert packing.packed(Run(spark, "test5"), docs.limit(0), P.path(packing.TOKENIZER)).collect() == []


def test_sum_of_squares_rule():
    """Each step against the rule written out."""
    rng = np.random.default_rng(5)
    lengths = rng.integers(1, 21, 400)
    sequence, offset = packing.sum_of_squares(lengths, 20)
    fill = {}
    for i in packing.order(lengths, 20, 0):
        def total(s):
            after = dict(fill)
            after[s] = after.get(s, 0) + lengths[i]
            return sum(n * n for n in np.unique([20 - f for f in after.values() if f < 20], return_counts=True)[1])
        options = [s for s, f in fill.items() if f + lengths[i] <= 20] + [len(fill)]
        assert total(sequence[i]) == min(map(total, options)) and offset[i] == fill.get(sequence[i], 0)
        fill[sequence[i]] = fill.get(sequence[i], 0) + lengths[i]
