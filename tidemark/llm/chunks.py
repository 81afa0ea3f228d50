"""Encoding texts by the pieces between single spaces, or by their words, each distinct one once.

A single space between two other characters always begins a new match of the split patterns of
byte-level and word-end tokenizers, so cutting there changes no id. Words repeat, so most are found
in a table that the Python worker keeps from task to task.
"""

from __future__ import annotations

import json
import re
import sys
from array import array
from codecs import utf_32_le_decode
from collections.abc import Iterable
from functools import lru_cache

import numpy as np
import pyarrow as pa
from tokenizers import Tokenizer

#: Pieces that a worker remembers. Half of them are set aside when that many are new, and
#: forgotten with the next half unless they are met again, so frequent ones stay.
REMEMBERED = 1_200_000
#: Bytes of a word that is remembered at most, or characters of a piece: long ones hardly come again.
LONGEST = 256

_DOUBTFUL = re.compile(r" \s|\s ")
_BOUNDARY = re.compile(r"(?<=\S)(?= \S)")
# Characters on which all Unicode versions and both libraries agree, and which are normal forms.
_PLAIN = re.compile(r"[\n!-~À-įı-ňŊ-ž]*")


# White space other than the space and the line feed; looking for each is faster than a pattern is.
_OTHER_SPACE = [c for c in map(chr, range(0x3001)) if c.isspace() and c not in " \n"]


def _is_doubtful(text: str) -> bool:
    """Whether a space may stand next to other white space."""
    return "  " in text or " \n" in text or "\n " in text or any([c in text for c in _OTHER_SPACE])


def pieces(text: str) -> list[str]:
    """The text cut before single spaces, which are left out: all but the first piece began with one."""
    if _is_doubtful(text) and _DOUBTFUL.search(text):
        first, *rest = _BOUNDARY.split(text)
        return [first, *(x[1:] for x in rest)]
    return text.split(" ")


class _Known(dict):
    """Ids by piece; a piece that is asked for the first time is encoded, and not kept if it is long."""

    def __init__(self, encode):
        self.encode = encode
        self.aside: dict[str, bytes] = {}

    def __missing__(self, piece: str) -> bytes:
        out = self.aside.get(piece)
        if out is None:
            out = self.encode(piece)
        if len(piece) <= LONGEST:
            self[piece] = out
        return out

    def unknown(self, some: set[str]) -> list[str]:
        return [p for p in some.difference(self) if p not in self.aside]

    def age(self) -> None:
        self.aside = dict(self)
        self.clear()


class Encoder:
    """Ids of whole texts, as little-endian unsigned 32-bit integers, by ids of pieces."""

    def __init__(self):
        self.first = _Known(self.piece)
        self.later = _Known(lambda piece: self.piece(" " + piece))

    def piece(self, piece: str) -> bytes:
        """The ids of a piece as it stands."""
        raise NotImplementedError

    def learn(self, cut: list[list[str]]) -> None:
        """Called with the pieces of some texts before they are encoded one by one."""

    def encode(self, texts: Iterable[str]) -> list[bytes]:
        """The ids of each text. Texts of one call are cut together, so give a batch, not a table."""
        cut = [pieces(x) for x in texts]
        if len(self.first) + len(self.later) > REMEMBERED // 2:
            self.first.age()
            self.later.age()
        self.learn(cut)
        first, later = self.first, self.later.__getitem__
        return [first[x[0]] + b"".join(map(later, x[1:])) for x in cut]


# The bytes that byte-level vocabularies write as the character of the same number;
# the others follow from 256 on, in order.
_SHOWN = (range(33, 127), range(161, 173), range(174, 256))
_OTHERS = [b for b in range(256) if not any(b in r for r in _SHOWN)]
_BYTE_CHARS = {b: chr(256 + i) for i, b in enumerate(_OTHERS)}


def byte_chars(text: str) -> str:
    """A text as byte-level vocabularies write it."""
    return text.encode().decode("latin-1").translate(_BYTE_CHARS)


#: Words that a worker remembers, in halves as above: about 100 MB with their ids. A batch asks for each of
#: its words but once, so forgetting rare ones costs little.
WORDS = 400_000

#: The pattern of the tokenizer that lowers case, which ``LibraryEncoder.cut`` cuts by.
_WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
# Classes of characters in the arrays a batch is cut in. Those up to _SPACE are plain.
_LETTER, _DIGIT, _SIGN, _LINE, _SPACE, _ODD, _ODD_SPACE, _END = range(8)
#: What stands after each text of a batch, and begins it: no character.
_STOP = 0x110000
_STOP_CODE = _STOP.to_bytes(4, "little")
# After an apostrophe: the letters that are contractions alone, and those of longer ones.
_ONE, _E, _L, _R, _V = np.array([ord(c) for c in "stmd"], np.uint32), *map(ord, "elrv")
#: Characters cut at once, about; a text of more than twice as many is cut in parts.
PART = 1 << 20


@lru_cache(maxsize=1)
def _classes() -> np.ndarray:
    """The class of each code point."""
    out = np.full(_STOP + 1, _ODD, np.uint8)
    out[[i for i in range(0x3001) if chr(i).isspace()]] = _ODD_SPACE
    for i in range(0x180):
        if _PLAIN.fullmatch(chr(i)):
            out[i] = _LETTER if chr(i).isalpha() else _DIGIT if chr(i).isdigit() else _LINE if i == 10 else _SIGN
    out[32], out[_STOP] = _SPACE, _END
    return out


@lru_cache(maxsize=1)
def _lowered() -> np.ndarray:
    """The lower-case code point of each plain one, which is one; the others as they are."""
    plain = [i for i in range(0x180) if _PLAIN.fullmatch(chr(i))]
    out = np.arange(0x180, dtype=np.uint32)
    out[plain] = [ord(chr(i).lower()) for i in plain]
    return out


def _parts(text: str) -> list[str]:
    """A text longer than ``PART`` cut before single spaces, as ``pieces`` are; they keep the space."""
    out = []
    at = 0
    while len(text) - at > 2 * PART and (cut := _BOUNDARY.search(text, at + PART)):
        out.append(text[at : cut.start()])
        at = cut.start()
    return [*out, text[at:] if at else text]


class LibraryEncoder:
    """Ids by a file of the tokenizers library, without special tokens, little-endian unsigned 32-bit.

    The strings of special tokens are ordinary text. The texts of a batch are cut into words by array
    operations, as the file's own pattern does for plain characters, and each distinct word is put to
    the library's model. A piece between single spaces with any other character, or with other white
    space next to a space, is one word, which the library encodes as it stands; and so is the whole
    text where the file's steps are not among the two known here.
    """

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.words = _Known(self.word)
        with open(path, encoding="utf-8") as file:
            kind = json.load(file)
        self.vocabulary = self.tokenizer.get_vocab_size()
        self.model = self.tokenizer.model
        self.lower = False
        before, steps = kind["pre_tokenizer"] or {}, (kind["normalizer"] or {}).get("normalizers", [])
        self.known = kind["model"]["type"] == "BPE" and kind["post_processor"] is None
        if before.get("type") == "ByteLevel" and before["use_regex"] and not before["add_prefix_space"] and not steps:
            pass  # splits by public_tokenizers.PATTERN
        elif before.get("type") == "Sequence" and [s["type"] for s in steps] == ["NFC", "Replace", "Lowercase"]:
            split, level = before["pretokenizers"]
            self.lower = True
            self.known &= split["pattern"].get("Regex") == _WORD_PATTERN
            self.known &= split["behavior"] == "Removed" and split["invert"] and not level["use_regex"] and not level["add_prefix_space"]
        else:
            self.known = False

    def encode(self, texts: Iterable[str]) -> list[bytes]:
        """The ids of each text. Texts of one call are cut together, so give a batch, not a table."""
        if not self.known:
            return [_packed(x.ids) for x in self.tokenizer.encode_batch(list(texts), add_special_tokens=False)]
        out: list[bytes] = []
        held: list[str] = []
        size = 0
        for text in texts:
            if len(text) > 2 * PART:
                out += self._encoded(held)
                out.append(b"".join([x for part in _parts(text) for x in self._encoded([part])]))
                held, size = [], 0
                continue
            held.append(text)
            size += len(text)
            if size >= PART:
                out += self._encoded(held)
                held, size = [], 0
        return out + self._encoded(held)

    def _encoded(self, texts: list[str]) -> list[bytes]:
        if not any(texts):
            return [b""] * len(texts)
        chars, starts, ends = self.cut(texts)
        offsets = pa.py_buffer(4 * np.append(starts, len(chars)))
        found = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, offsets, pa.py_buffer(chars)]).dictionary_encode()
        if len(self.words) > WORDS // 2:
            self.words.age()
        _, at, data = found.dictionary.buffers()
        at, data = np.frombuffer(at, np.int64, len(found.dictionary) + 1).tolist(), data.to_pybytes()
        codes = [self.words[data[i:j]] for i, j in zip(at, at[1:])]
        which = found.indices.to_numpy()
        lengths = np.fromiter(map(len, codes), np.int64, len(codes)) // 4
        counts = lengths[which]
        after = np.cumsum(counts)
        # Where each id of the batch stands among those of the distinct words.
        places = np.repeat((np.cumsum(lengths) - lengths)[which] - (after - counts), counts) + np.arange(after[-1])
        raw = np.frombuffer(b"".join(codes), "<u4")[places].tobytes()
        stops = (4 * after[np.searchsorted(starts, ends)]).tolist()
        return [raw[i:j] for i, j in zip([0, *stops], stops)]

    def cut(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The code points of all texts, a stop after each; where words begin; where the stops are.

        A word has the space before it, and line feeds too where case is not kept; without gaps and
        with each stop a word of its own, the next begins where one ends.
        """
        ends = np.cumsum([len(x) + 1 for x in texts]) - 1
        chars = np.frombuffer("\0".join([*texts, ""]).encode("utf-32-le"), np.uint32).copy()
        chars[ends] = _STOP
        kinds = _classes()[chars]
        before = np.append(np.uint8(_END), kinds[:-1])
        after = np.append(kinds[1:], np.uint8(_END))
        space = kinds == _SPACE
        white = (kinds == _LINE) | space | (kinds == _ODD_SPACE)
        border = space & ~np.append(False, white[:-1]) & ~np.append(white[1:], False)  # a single space
        odd = (kinds == _ODD) | (kinds == _ODD_SPACE) | (space & ~border)

        begins = kinds != before
        if self.lower:
            low = np.where(chars < 0x180, _lowered()[np.minimum(chars, 0x17F)], chars)
            begins |= kinds == _DIGIT
            begins &= ~np.append(False, white[:-1])
        else:
            low = chars
            begins &= before != _SPACE
            begins |= (kinds == _LINE) & (before == _LINE) & (after != _LINE) & (after != _END)
        quotes = np.nonzero((low == 39) & (before != _SIGN) & (self.lower | (before != _SPACE)))[0]
        first = low[quotes + 1]
        second = low[np.minimum(quotes + 2, len(low) - 1)]
        long = ((first == _R) & (second == _E)) | ((first == _V) & (second == _E)) | ((first == _L) & (second == _L))
        for hit, size in ((quotes[np.isin(first, _ONE)], 2), (quotes[long], 3)):
            begins[hit + 1] = False
            begins[hit + size] = True

        spans = border | (kinds == _END) | (before == _END)
        begins |= spans
        if odd.any():
            at = np.append(np.nonzero(spans)[0], len(chars))
            whole = np.unique(np.searchsorted(at, np.nonzero(odd)[0], "right") - 1)
            change = np.zeros(len(chars) + 1, np.int8)
            change[at[whole]] = 1
            change[at[whole + 1]] -= 1
            inside = np.cumsum(change[:-1], dtype=np.int8) > 0
            begins &= ~inside
            begins[at[whole]] = True
            low = np.where(inside, chars, low)
        return low, np.nonzero(begins)[0], ends

    def word(self, code: bytes) -> bytes:
        """The ids of a word as ``cut`` gives it."""
        if code == _STOP_CODE:
            return b""
        word = utf_32_le_decode(code)[0]
        if word[:2] == " \n" or not _PLAIN.fullmatch(word, 1 if word[0] == " " else 0):
            return _packed(self.tokenizer.encode(word, add_special_tokens=False).ids)
        if self.lower:
            word = word.strip(" \n")
            if not word:
                return b""
        if word[1:].isalnum() and word.isascii() and word[0] != "\n":  # as it is shown, but for a space before it
            shown = _BYTE_CHARS[32] + word[1:] if word[0] == " " else word
        else:
            shown = byte_chars(word)
        return _packed([t.id for t in self.model.tokenize(shown)])


def _packed(ids: list[int]) -> bytes:
    return array("I", ids).tobytes() if sys.byteorder == "little" else np.array(ids, "<u4").tobytes()


@lru_cache(maxsize=4)
def library_encoder(path: str) -> LibraryEncoder:
    """One per worker and file, so that later tasks know the words of earlier ones."""
    return LibraryEncoder(path)
