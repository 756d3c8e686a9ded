"""Quality scores: Bradley-Terry ranking learnt from preference pairs, cut at a quantile of scores.

A document is described by shares over its words: of each kind of word shape (the runs of capitals, letters, digits and
marks that a word is made of, hashed), of words that repeat the one before, of distinct words and lines, and by the
logarithms of its sizes. The model gives a document the score w . x; of a good and a bad document, the good one is
preferred with the probability of the logistic function of w . (x_good - x_bad), and w minimises the logistic loss over
many such pairs, with an L2 term. No bias is learnt, as it cancels in differences; the threshold comes from the scores
themselves: it is their quantile at the share of bad documents among all labelled rows. A score is reported on a scale from 0 to
1 on which the threshold is ``CUT``.

Defined results: a null or empty text has the description of no words, all shares zero, and its score; repeated rows get
equal scores, and repeated labelled rows are learnt from each; a doc_id with several labels counts as its highest; a text of
any length is read whole; an empty table gives an empty table; without labelled rows of both kinds every weight is 0 and
every score above the threshold. Other columns, whatever their names, are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mnesis.llm.common import settled, slices, word_codes
from mnesis.llm.toxicity import training_rows

CUT = 0.3
SHAPES = 256
#: About how many labelled rows a task learns from at once, and how many pairs each of them takes part in.
PART_DOCS, PAIRS = 20_000, 4
STEPS, L2 = 150, 1e-4
OWN = 9


def shape(word: str) -> str:
    """Aa for capitalised, A for capitals, a for the rest, 9 for digits; a mark for a run of that mark."""
    out = []
    for c in word:
        kind = "A" if c.isupper() else "a" if c.isalpha() else "9" if c.isdigit() else c
        if not out or out[-1] != kind:
            out.append(kind)
    return "".join(out)


def described(texts: pa.Array) -> np.ndarray:
    """A row of SHAPES + OWN numbers for each text."""
    codes, words, offsets = word_codes(texts)
    n = len(offsets) - 1
    row = np.repeat(np.arange(n), np.diff(offsets))
    count = np.maximum(np.diff(offsets), 1)
    shaped: dict[str, int] = {}
    kind = np.fromiter((shaped.setdefault(s, zlib.crc32(s.encode()) % SHAPES) for s in map(shape, words)), np.int64, len(words))
    size = np.fromiter(map(len, words), np.float64, len(words))
    x = np.zeros((n, SHAPES + OWN))
    if len(codes):
        x[:, :SHAPES] = np.sqrt(np.bincount(row * SHAPES + kind[codes], minlength=n * SHAPES).reshape(n, SHAPES) / count[:, None])
        same = (codes[1:] == codes[:-1]) & (row[1:] == row[:-1])
        pair = np.unique(row * len(words) + codes)
        x[:, SHAPES] = np.bincount(row[1:][same], minlength=n) / count
        x[:, SHAPES + 1] = np.bincount(pair // len(words), minlength=n) / np.sqrt(count)
        x[:, SHAPES + 2] = np.bincount(row, size[codes], n) / count / 10
        skip = (codes[2:] == codes[:-2]) & (row[2:] == row[:-2])
        x[:, SHAPES + 3] = np.bincount(row[2:][skip], minlength=n) / count
        x[:, SHAPES + 4] = np.bincount(pair // len(words), minlength=n) / count
    x[:, SHAPES + 5] = np.log1p(np.diff(offsets)) / 10
    for i, text in enumerate(texts.to_pylist()):
        lines = (text or "").split("\n")
        x[i, SHAPES + 6] = len(set(lines)) / len(lines)
        x[i, SHAPES + 7] = np.log1p(len(lines)) / 10
        x[i, SHAPES + 8] = sum(line[-1:] in (".", "!", "?") for line in lines) / len(lines)
    return x


def preference_pairs(good: np.ndarray, pairs: int = PAIRS, seed: int = 11) -> tuple[np.ndarray, np.ndarray]:
    """Rows (better, worse) of the pairs: each row of the larger kind meets ``pairs`` rows of the other kind."""
    better, worse = np.flatnonzero(good), np.flatnonzero(~good)
    most, rng = pairs * max(len(better), len(worse)), np.random.default_rng(seed)
    return better[np.resize(rng.permutation(len(better)), most)], worse[rng.integers(0, len(worse), most)]


def scales(x: np.ndarray) -> np.ndarray:
    """What brings each column to unit deviation; 0 for columns that don't vary."""
    spread = x.std(axis=0)
    return np.where(spread > 1e-9, 1 / np.maximum(spread, 1e-9), 0)


def bradley_terry(x: np.ndarray, good: np.ndarray, pairs: int = PAIRS, steps: int = STEPS, l2: float = L2, seed: int = 11) -> np.ndarray:
    """The weights that rank good rows of x above the others: the mean logistic loss of the differences of pairs is minimised
    by accelerated gradient steps. Columns are scaled to unit deviation, so one step size fits all."""
    if good.all() or not good.any():
        return np.zeros(x.shape[1])
    scale = scales(x)
    z, (a, b) = x * scale, preference_pairs(good, pairs, seed)
    most = len(a)
    w = ahead = np.zeros(x.shape[1])
    step = 4.0 / max(1.0, float(np.mean(((z[a[:2000]] - z[b[:2000]]) ** 2).sum(axis=1))))
    for k in range(steps):
        s = z @ ahead
        lost = 1 / (1 + np.exp(np.clip(s[a] - s[b], -500, 500)))
        pull = np.bincount(a, lost, len(z)) - np.bincount(b, lost, len(z))
        new = ahead + step * (z.T @ pull / most - l2 * ahead)
        ahead, w = new + k / (k + 3) * (new - w), new
    return w * scale


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", keep=None, max_docs: int | None = None) -> tuple[np.ndarray, float, float]:
    """(weights, threshold, scale), learnt from the descriptions of all labelled rows (max_docs: of at most about so many).

    Rows are dealt by hash to parts of about PART_DOCS, of both labels alike. Each part ranks its own pairs in a task, and the
    weights are the parts' mean by their rows; a table that fits one part is learnt whole. The threshold and the scale are
    quantiles over the scores of all rows, in Spark."""

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            x = described(b.column("text"))
            rows = [pa.array([v.astype(np.float32).tobytes() for v in x], pa.binary())]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("label"), *rows], ["doc_id", "label", "x"])

    def matrix(x: pa.Array | pa.ChunkedArray, n: int) -> np.ndarray:
        return np.frombuffer(b"".join(x.to_pylist()), np.float32).reshape(n, SHAPES + OWN).astype(np.float64)

    def learn(held: pa.Table) -> pa.Table:
        held = held.sort_by([("doc_id", "ascending"), ("x", "ascending")])  # so that reruns learn from the same pairs
        w = bradley_terry(matrix(held.column("x"), held.num_rows), held.column("label").to_numpy() == 1)
        return pa.table({"part": held.column("part")[:1], "n": pa.array([held.num_rows], pa.int64()), "w": pa.array([w.tobytes()], pa.binary())})

    rows = settled(training_rows(docs, labels, label, max_docs, keep).mapInArrow(describe, "doc_id long, label double, x binary"), "quality")
    kinds = {r.label: r["count"] for r in rows.groupBy("label").count().collect()}
    none = (np.zeros(SHAPES + OWN), float("-inf"), 1.0)
    if len(kinds) < 2:
        return none
    parts = -(-sum(kinds.values()) // PART_DOCS)
    dealt = rows.withColumn("part", F.pmod(F.xxhash64("doc_id", F.lit(29)), F.lit(parts)))
    learnt = dealt.groupBy("part").applyInArrow(learn, "part long, n long, w binary").orderBy("part").collect()
    w = np.average([np.frombuffer(r.w) for r in learnt], axis=0, weights=[r.n for r in learnt])

    def scores(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column("label"), pa.array(matrix(b.column("x"), b.num_rows) @ w)], ["label", "s"])

    # in steps of 1e-5, so that quantiles hold a count for each step and not every score
    of = rows.select("label", "x").mapInArrow(scores, "label double, s double").withColumn("s", F.round("s", 5))
    share = kinds[1.0] / sum(kinds.values())
    got = of.agg(F.percentile("s", F.lit(1 - share)).alias("cut"), F.median(F.when(F.col("label") == 0, F.col("s"))).alias("below"), F.median(F.when(F.col("label") == 1, F.col("s"))).alias("above")).first()
    return w, float(got.cut), 6.0 / max(float(got.above - got.below), 1e-9)


def score(docs: DataFrame, model: tuple[np.ndarray, float, float], keep: list[str] | None = None, name: str = "score") -> DataFrame:
    """docs' columns ``keep`` with score (under ``name``), from 0 to 1, and CUT at the threshold; one pass, no shuffle."""
    keep = ["doc_id"] if keep is None else keep
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w, threshold, scale = shared.value
        shift = np.log(CUT / (1 - CUT))
        for b in slices(batches):
            s = described(b.column("text")) @ w
            z = np.full(len(s), 1.0) if np.isinf(threshold) else scale * (s - threshold) + shift
            value = 1 / (1 + np.exp(-np.clip(z, -500, 500)))
            value = np.where(z >= shift, np.maximum(value, CUT), np.minimum(value, np.nextafter(CUT, 0)))
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in keep), pa.array(value)], [*keep, name])

    types = dict(docs.dtypes)
    return docs.select(*dict.fromkeys([*keep, "text"])).mapInArrow(scored, ", ".join([*(f"`{c}` {types[c]}" for c in keep), f"`{name}` double"]))
