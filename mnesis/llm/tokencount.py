"""Token counts by linear longest match over a vocabulary automaton.

Words are cut greedily into the longest pieces of a word-piece vocabulary (pieces inside a word start with a prefix,
``##`` by default). The vocabulary is a trie whose nodes carry a failure link and the number of pieces that are popped on
following it, computed once in the order of depth. A word is then read once from left to right: where the trie has no
edge, the count grows by what the node pops and the failure link is followed, so no piece is built and no letter is
read twice. Words that can't be cut count as one unknown piece, as do words over ``max_letters`` long where
that is set.

Text is cut into words at white space and around marks, in lower case if asked. Each distinct word of a slice is counted
once.

Defined results: null and empty texts have 0 words and 0 tokens; repeated rows get equal counts; texts and words of any
length are counted whole; an empty table gives an empty table; other columns, whatever their names, are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from mnesis.llm.common import slices, word_codes

WORD = re.compile(r"\w+|[^\w\s]")


class Automaton:
    """Counts the pieces of words; -1 for words that can't be cut."""

    def __init__(self, vocabulary: list[str], prefix: str = "##", max_letters: int | None = None):
        self.max_letters = max_letters
        self.edges: list[dict[str, int]] = [{}, {}]  # node 0: a word's start; node 1: the start of a piece inside
        self.ends = [False, False]
        for piece in vocabulary:
            inside = piece.startswith(prefix) and len(piece) > len(prefix)
            node = 1 if inside else 0
            for letter in piece[len(prefix) :] if inside else piece:
                following = self.edges[node].get(letter)
                if following is None:
                    following = self.edges[node][letter] = len(self.edges)
                    self.edges.append({})
                    self.ends.append(False)
                node = following
            if node > 1:
                self.ends[node] = True
        self.link()

    def link(self) -> None:
        """fail[v], pops[v]: after the letters on the way to v, the node for what is left once the longest pieces are cut
        off, and how many those are. -1 where they can't be cut off."""
        self.fail, self.pops = [-1] * len(self.edges), [0] * len(self.edges)
        level = [0, 1]
        while level:
            below = []
            for node in level:
                for letter, child in self.edges[node].items():
                    below.append(child)
                    if self.ends[child]:
                        self.fail[child], self.pops[child] = 1, 1
                        continue
                    at, popped = self.fail[node], self.pops[node]
                    while at >= 0 and letter not in self.edges[at]:
                        popped += self.pops[at]
                        at = self.fail[at]
                    if at >= 0:
                        self.fail[child], self.pops[child] = self.edges[at][letter], popped
            level = below

    def count(self, word: str) -> int:
        if not word or (self.max_letters is not None and len(word) > self.max_letters):
            return -1 if word else 0
        edges, fail, pops = self.edges, self.fail, self.pops
        node, total = 0, 0
        for letter in word:
            following = edges[node].get(letter)
            while following is None:
                total += pops[node]
                node = fail[node]
                if node < 0:
                    return -1
                following = edges[node].get(letter)
            node = following
        while node != 1:  # what is left is cut into pieces as well
            total += pops[node]
            node = fail[node]
            if node < 0:
                return -1
        return total


def sentencepiece_vocabulary(path: str) -> list[str]:
    """The word-piece form of a sentencepiece vocabulary: pieces that begin a word as they are, the others with ``##``."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = [model.id_to_piece(i) for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))]
    start = [p[1:] for p in pieces if p.startswith("▁") and len(p) > 1]
    inside = [p for p in pieces if "▁" not in p]
    return list(dict.fromkeys([*start, *(f"##{p}" for p in inside), *(p for p in inside if len(p) == 1)]))


def token_counts(docs: DataFrame, model_path: str, lower: bool = False, max_letters: int | None = None) -> DataFrame:
    """(doc_id, n_words, n_tokens, n_unknown) of every whole text; one pass, no shuffle. Words of any length are cut;
    max_letters=100 gives the counts of the library's WordPiece."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = Automaton(sentencepiece_vocabulary(model_path), max_letters=max_letters)
        for b in slices(batches):
            codes, chunks, offsets = word_codes(b.column("text"))
            each = np.zeros((len(chunks), 3), np.int64)
            known: dict[str, int] = {}
            for i, chunk in enumerate(chunks):
                words = WORD.findall(chunk.lower() if lower else chunk)
                total = unknown = 0
                for w in words:
                    n = known.get(w)
                    if n is None:
                        n = known[w] = automaton.count(w)
                    total += abs(n)
                    unknown += n < 0
                each[i] = len(words), total, unknown
            sums = np.concatenate((np.zeros((1, 3), np.int64), np.cumsum(each[codes], axis=0) if len(codes) else np.zeros((0, 3), np.int64)))
            got = sums[offsets[1:]] - sums[offsets[:-1]]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), *(pa.array(got[:, k]) for k in range(3))], ["doc_id", "n_words", "n_tokens", "n_unknown"])

    return docs.select("doc_id", "text").mapInArrow(counted, f"doc_id {dict(docs.dtypes)['doc_id']}, n_words long, n_tokens long, n_unknown long")
