"""Toxicity scores: FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

A text's words are what stands between white space, lower-cased and without marks. Its features are the hashes of the
words, of their stems (the first ``STEMS`` letters of longer words, for inflected and compound forms), of neighbouring
words and of words with one word between; each counts once. Learning keeps a rate for each coordinate, and the L1 term
leaves most weights at exactly zero, so that the model is a short list of (hash, weight) pairs, small enough to
broadcast at any size of corpus.

Defined results: a null or empty text, or one of marks alone, has no features and gets the model's bias as its score;
repeated rows get equal scores, and repeated labelled rows are learnt from each; a doc_id with several labels counts as
its highest; a text of any length is read whole; an empty table gives an empty table; without labelled rows every score is
0.5, and with rows of one label alone scores lean to it. Columns other than those named, whatever their names, are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mnesis.llm.common import mix, settled, slices, word_codes

STEMS = (4, 6)
#: About how many labelled rows a task learns from, and how many turns they take.
PART_DOCS, PARTS = 20_000, 16
MARKS = re.compile(r"[^\w\n]+|_+")


@dataclass(frozen=True)
class Ftrl:
    """bits: of a feature's hash. alpha, beta: of the rates. l1, l2: of the penalties. epochs: passes over the sample.
    max_docs: labelled rows that are learnt from, chosen by hash; all of them if it is None."""

    bits: int = 20
    alpha: float = 3.0
    beta: float = 1.0
    l1: float = 5.0
    l2: float = 0.1
    epochs: int = 4
    max_docs: int | None = None


def word_hashes(words: list[str]) -> tuple[np.ndarray, list[np.ndarray]]:
    """A 64-bit hash of each word without marks and case, 0 where nothing is left, and of each of its stems, 0 where the word
    is no longer than that."""
    plain = MARKS.sub("", "\n".join(words).lower()).split("\n")
    stems = [np.fromiter((zlib.crc32(w[:n].encode(), n) + 1 if len(w) > n else 0 for w in plain), np.uint64, len(plain)) for n in STEMS]
    return mix(np.fromiter((zlib.crc32(w.encode()) + 1 if w else 0 for w in plain), np.uint64, len(plain))), [mix(x) for x in stems]


def features(texts: pa.Array, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The features of each text: row numbers in order, and hashes below 2 ** bits, none twice in a row."""
    codes, words, offsets = word_codes(texts)
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    known, stems = word_hashes(words) if len(words) else (np.zeros(0, np.uint64), [])
    word = known[codes]
    found = [(row[x[codes] != 0], mix(x[codes][x[codes] != 0] + np.uint64(11 + k))) for k, x in enumerate(stems)]
    row, word = row[word != 0], word[word != 0]
    found.append((row, mix(word + np.uint64(1))))
    with np.errstate(over="ignore"):
        for gap in (1, 2):
            same = row[:-gap] == row[gap:]
            pair = word[:-gap][same] * np.uint64(0x9E3779B97F4A7C15) + word[gap:][same]
            found.append((row[:-gap][same], mix(pair + np.uint64(1 + gap))))
    keys = [(r.astype(np.uint64) << np.uint64(bits)) | (h >> np.uint64(64 - bits)) for r, h in found]
    key = np.sort(np.concatenate(keys))
    key = key[np.append(True, key[1:] != key[:-1])[: len(key)]]
    return (key >> np.uint64(bits)).astype(np.int64), (key & np.uint64((1 << bits) - 1)).astype(np.int64)


class State:
    """The sums z and n of each coordinate; the last coordinate is the bias, which L1 spares."""

    def __init__(self, p: Ftrl):
        size = (1 << p.bits) + 1
        self.p, self.z, self.n = p, np.zeros(size), np.zeros(size)
        self.l1 = np.full(size, p.l1)
        self.l1[-1] = 0

    def weights(self, at=slice(None)) -> np.ndarray:
        z, n, p = self.z[at], self.n[at], self.p
        shrunk = np.sign(z) * np.maximum(np.abs(z) - self.l1[at], 0)
        return -shrunk / ((p.beta + np.sqrt(n)) / p.alpha + p.l2)

    def learn(self, at: np.ndarray, label: float) -> None:
        w, n = self.weights(at), self.n[at]
        slope = 1 / (1 + np.exp(-np.clip(w.sum(), -35, 35))) - label
        self.z[at] += slope - (np.sqrt(n + slope * slope) - np.sqrt(n)) / self.p.alpha * w
        self.n[at] = n + slope * slope


def labelled(labels: DataFrame, label: str, keep=None) -> DataFrame:
    """(doc_id, label) of the usable labels, one row a document."""
    keep = F.lit(True) if keep is None else keep
    return labels.where(keep & F.col("doc_id").isNotNull() & F.col(label).isin(0, 1)).groupBy("doc_id").agg(F.max(label).cast("double").alias("label"))


def training_rows(docs: DataFrame, labels: DataFrame, label: str, p_docs: int | None, keep=None) -> DataFrame:
    """(doc_id, text, label) of all labelled rows for which the column ``keep`` holds or, with ``p_docs``, of at most about so
    many, which are chosen by hash and broadcast. All labelled rows meet their texts by a merge at every size: labels grow as
    documents do, so the plan of a small table is that of a large one, and its disk grows in proportion."""
    usable = labelled(labels, label, keep)
    if p_docs is None:
        return docs.select("doc_id", "text").join(usable.hint("merge"), "doc_id")
    share = min(1.0, p_docs / max(1, usable.count()))
    chosen = usable.where(F.pmod(F.xxhash64("doc_id", F.lit(17)), F.lit(1 << 30)) < int(share * (1 << 30)))
    return docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", keep=None, p: Ftrl = Ftrl()) -> tuple[np.ndarray, np.ndarray]:
    """Coordinates and weights that aren't zero, the bias last, learnt from all labelled rows (with ``max_docs``, of at most about
    so many).

    Rows are dealt by hash to parts of about PART_DOCS. Each part is learnt in a task, a row at a time in hash order; the
    weights are the parts' mean by their rows, added up in Spark, and only they come to the driver. A table that fits one part
    is learnt whole."""

    def learn(held: pa.Table) -> pa.Table:
        held = held.sort_by([(c, "ascending") for c in ("file", "turn", "o", "doc_id", "h")]).combine_chunks()
        s, bias, found = State(p), np.array([1 << p.bits]), []
        for b in slices(iter(held.to_batches())):
            row, at = features(b.column("text"), p.bits)
            ends, at = np.searchsorted(row, np.arange(b.num_rows + 1)), at.astype(np.int32)
            found += [(at[ends[i] : ends[i + 1]], y) for i, y in enumerate(b.column("label").to_numpy())]
        for _ in range(p.epochs):
            for at, y in found:
                s.learn(np.concatenate((at, bias)), y)
        w = s.weights()
        at = np.union1d(np.flatnonzero(w), bias)
        return pa.table({"part": pa.array([held.column("part")[0].as_py()] * len(at), pa.int64()), "n": pa.array([held.num_rows] * len(at), pa.int64()), "at": pa.array(at.astype(np.int64)), "w": pa.array(w[at])})

    sizes = labelled(labels, label, keep).agg(F.count("*")).first()[0]
    parts = max(1, -(-min(sizes, p.max_docs or sizes) // PART_DOCS))
    turn = F.pmod(F.xxhash64("doc_id", F.lit(6)), F.lit(PARTS))
    order = [F.pmod(F.hash(turn), F.lit(PARTS)).alias("file"), turn.alias("turn"), F.xxhash64("doc_id", F.lit(5)).alias("o"), F.xxhash64("text").alias("h")]
    rows = training_rows(docs, labels, label, p.max_docs, keep).select("doc_id", "label", "text", *order, F.pmod(F.xxhash64("doc_id", F.lit(29)), F.lit(parts)).alias("part"))
    models = settled(rows.groupBy("part").applyInArrow(learn, "part long, n long, at long, w double"), "toxicity")
    total = models.select("part", "n").distinct().agg(F.sum("n")).first()[0] or 1
    got = sorted(models.groupBy("at").agg(F.sort_array(F.collect_list(F.struct("part", (F.col("w") * F.col("n")).alias("x")))).alias("l")).select("at", F.aggregate("l", F.lit(0.0), lambda x, v: x + v["x"]).alias("w")).collect())
    got = got or [(1 << p.bits, 0.0)]
    return np.array([r[0] for r in got], np.int64), np.array([r[1] for r in got]) / total


def score(docs: DataFrame, model: tuple[np.ndarray, np.ndarray], p: Ftrl = Ftrl(), keep: list[str] | None = None, name: str = "score") -> DataFrame:
    """docs' columns ``keep`` with score (under ``name``), a double from 0 to 1; one pass, no shuffle."""
    keep = ["doc_id"] if keep is None else keep
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, w = shared.value
        table = np.zeros((1 << p.bits) + 1)
        table[at] = w
        for b in slices(batches):
            row, found = features(b.column("text"), p.bits)
            total = np.bincount(row, table[found], b.num_rows) + table[-1]
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in keep), pa.array(1 / (1 + np.exp(-np.clip(total, -500, 500))))], [*keep, name])

    types = dict(docs.dtypes)
    columns = list(dict.fromkeys([*keep, "text"]))
    return docs.select(*columns).mapInArrow(scored, ", ".join([*(f"`{c}` {types[c]}" for c in keep), f"`{name}` double"]))
