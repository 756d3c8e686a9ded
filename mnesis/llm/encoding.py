"""Token ids of whole texts by the tokenizers library, each distinct word encoded once for a slice of texts.

A text is cut only where the tokenizer itself always cuts: before white space that follows a word, and between Latin
letters and ASCII marks. Everything else (other scripts, digits, apostrophes, runs of white space) goes to the whole
tokenizer as it stands. So the ids are those of ``encode`` over the whole text, special tokens' names being ordinary
text.
"""

from __future__ import annotations

import codecs
import json
from array import array
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from mnesis.llm.common import coded_words, plain_list

LETTERS, MARKS = "A-Za-zÀ-ÖØ-öø-ÿ", "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
#: A word's stem that is one piece for the tokenizer once its last marks are gone.
PLAIN_STEM = rf"^[ \n]?[{LETTERS}]*$"
#: White space other than single blanks and line feeds between words, and the mark for a text's start.
ODD_SPACE = r"^[ \n]|[ \n]$|[ \n][ \n]|[\t\x0b\x0c\r\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}\x00]"
KEPT_PARTS = 600_000


def byte_letters() -> list[str]:
    """The letter that byte-level vocabularies use for each byte: printable Latin-1 stands for itself, the others for
    the letters from 256 on in turn."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return [chr(b) if b in printable else chr(next(others)) for b in range(256)]


class Encoder:
    """path: of a tokenizer's JSON file. Its words either keep the blank before them or know no white space."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.whole.encode_special_tokens = True
        with open(path, encoding="utf-8") as f:
            rules = json.load(f)
        self.keeps_blanks = rules["pre_tokenizer"]["type"] == "ByteLevel"
        self.model, self.letters, self.parts = self.whole.model, byte_letters(), {}
        self.lines = "".join("\n" if b == 10 else letter for b, letter in enumerate(self.letters))

    def part(self, text: str) -> bytes:
        """The ids of a stem or of marks."""
        if self.keeps_blanks and text[:1] == "\n" and len(text) > 1:
            return self.part("\n") + self.part(text[1:])
        if text.isascii() and text.isalpha():
            spelt = text
        else:
            spelt = "".join([self.letters[b] for b in text.encode()])
        return array("I", [t.id for t in self.model.tokenize(spelt)]).tobytes() if spelt else b""

    def kept(self, texts: list[str]) -> list[bytes]:
        """As ``part``, each text made once while there is room."""
        got = list(map(self.parts.get, texts))
        missing = [i for i, ids in enumerate(got) if ids is None]
        if len(self.parts) + len(missing) > KEPT_PARTS:
            self.parts.clear()
        new = [texts[i] for i in missing]
        spelt = codecs.charmap_decode("\n".join(new).encode(), "strict", self.lines)[0].split("\n")  # all at once
        tokenize, part = self.model.tokenize, self.part
        if len(spelt) != len(new):  # a line feed is part of a text
            made = map(part, new)
        else:
            made = (array("I", [t.id for t in tokenize(letters)]).tobytes() if letters else b"" for letters in spelt)
        for i, text, ids in zip(missing, new, made):
            got[i] = self.parts[text] = ids
        return got

    def direct(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, np.uint32).tobytes() for e in self.whole.encode_batch_fast(texts, add_special_tokens=False)]

    def chunks(self, chunks: pa.Array) -> tuple[np.ndarray, list[bytes]]:
        """Words with what stands around them, each as two parts, a stem and its last marks: the two codes of each, and
        the ids of each code. A word that isn't so simple is a part by itself, encoded as it stands."""
        stems = pc.utf8_rtrim(chunks, MARKS)
        if self.keeps_blanks:  # a blank belongs to the marks after it
            stems = pc.if_else(pc.equal(stems, " "), chunks, stems)
        bounds = np.frombuffer(chunks.buffers()[1], np.int32)[chunks.offset : chunks.offset + len(chunks) + 1].astype(np.int64)
        starts, ends = bounds[:-1], bounds[1:]
        stem_size = pc.binary_length(stems).to_numpy().astype(np.int64)
        marks = ends - starts - stem_size
        simple = pc.match_substring_regex(pc.utf8_rtrim(stems, MARKS) if self.keeps_blanks else stems, PLAIN_STEM).to_numpy(zero_copy_only=False) & (marks <= 8)
        coded = (stems if self.keeps_blanks else pc.utf8_lower(stems)).filter(pa.array(simple)).dictionary_encode()
        ids = self.kept(plain_list(coded.dictionary) if not self.keeps_blanks else coded.dictionary.to_pylist())
        stem_code = np.empty(len(chunks), np.int64)
        stem_code[simple] = coded.indices.to_numpy()
        hard = np.flatnonzero(~simple)
        stem_code[hard] = len(ids) + np.arange(len(hard))
        ids += self.direct(chunks.take(pa.array(hard)).to_pylist())
        key = np.zeros(len(chunks), np.uint64)
        data = np.frombuffer(chunks.buffers()[2] or b"", np.uint8)
        marks[hard] = 0
        for j in range(int(marks.max(initial=0))):
            at = np.flatnonzero(marks > j)
            key[at] |= data[starts[at] + stem_size[at] + j].astype(np.uint64) << np.uint64(8 * j)
        keys, mark_code = np.unique(key, return_inverse=True)
        codes = np.stack((stem_code, len(ids) + mark_code.reshape(-1)), axis=1)
        return codes, ids + self.kept([int(k).to_bytes(8, "little").rstrip(b"\0").decode() for k in keys])

    def blank_codes(self, texts: pa.Array) -> tuple[np.ndarray, pa.Array, np.ndarray]:
        """As ``word_codes``, for texts with single blanks and line feeds; the words keep them."""
        marked = pc.binary_join_element_wise("\x00", pc.replace_substring(texts, "\n", " \n"), "")
        parts = pc.split_pattern(marked, " ")
        coded = parts.flatten().dictionary_encode()
        words = pc.binary_join_element_wise(" ", coded.dictionary, "")
        words = pc.replace_substring_regex(words, "^ (\x00|\n)", "\\1")
        words = pc.replace_substring(words, "\x00", "")
        offsets = parts.offsets.to_numpy().astype(np.int64)
        return coded.indices.to_numpy(), words, offsets - offsets[0]

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in a row, as unsigned 32-bit integers, and where each text's ids start and end. A null
        text is empty."""
        texts = pc.fill_null(texts, "")
        if not self.keeps_blanks:
            return self.joined(*coded_words(texts))
        odd = pc.match_substring_regex(texts, ODD_SPACE).to_numpy(zero_copy_only=False)
        odd |= pc.match_substring(texts, "\x01").to_numpy(zero_copy_only=False)
        if not odd.any():
            return self.joined(*self.blank_codes(texts))
        lists: list[bytes] = [b""] * len(texts)
        at, strange = np.flatnonzero(~odd), np.flatnonzero(odd)
        ids, offsets = self.joined(*self.blank_codes(texts.filter(pa.array(~odd))))
        for k, i in enumerate(at):
            lists[i] = ids[offsets[k] : offsets[k + 1]].tobytes()
        for i, got in zip(strange, self.direct(texts.filter(pa.array(odd)).to_pylist()), strict=True):
            lists[i] = got
        return np.frombuffer(b"".join(lists), np.uint32), np.cumsum([0, *(len(x) // 4 for x in lists)])

    def joined(self, codes: np.ndarray, words: pa.Array, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(codes):
            return np.zeros(0, np.uint32), np.zeros(len(offsets), np.int64)
        parts, each = self.chunks(words)
        size = np.fromiter(map(len, each), np.int64, len(each)) // 4
        start, flat = np.cumsum(size) - size, np.frombuffer(b"".join(each), np.uint32)
        sequence = parts[codes].reshape(-1)
        n = size[sequence]
        ends = np.cumsum(n)
        ids = flat[np.repeat(start[sequence] - (ends - n), n) + np.arange(ends[-1])]
        return ids, np.concatenate(([0], ends[1::2]))[offsets]


@lru_cache(maxsize=2)
def encoder_of(path: str) -> Encoder:
    """The encoder of a tokenizer's file; a Python worker keeps it, and the words that it knows, from task to task."""
    return Encoder(path)


def with_ends(ids: np.ndarray, offsets: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """The ids with ``end`` after each text's."""
    at = offsets[1:] + np.arange(len(offsets) - 1)
    out = np.full(len(ids) + len(at), end, np.uint32)
    mask = np.ones(len(out), bool)
    mask[at] = False
    out[mask] = ids
    return out, offsets + np.arange(len(offsets))
