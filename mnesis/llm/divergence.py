"""Audit of how each source's words differ from the other sources' and from its language's, by a sort of token starts.

Words are runs of ASCII letters and of code points beyond ASCII, A to Z in lower case. In a task every slice of texts
stays one Arrow buffer: pointers to the words' first bytes, dealt by group (language and source), are sorted by the bytes
that follow with a multikey quicksort that takes eight bytes at a time: three parts around a pivot, the equal one goes on
eight bytes deeper, small parts are sorted at once. The sort keeps the order of equal words, so a run of equal words
falls into runs of groups, and those into runs of documents: their lengths are the counts and document frequencies. Only
these counts leave the task; Spark adds them up.

A language keeps the terms that at least ``least`` of its documents have. With N occurrences of its V kept terms, a group
gives a term p = 1 + floor(1e9 (count + 5) / (N + 5 V)), and so does the language. Two groups differ by the sum of
``|p - q|`` over all kept terms, also those that neither has; these sums are made in blocks of about ``BLOCK`` terms, as
matrices of terms and sources, and added up. All is in whole numbers; products are decimals of 38 digits.

Defined results: null texts, languages and sources are empty strings, and so a language or source of their own; texts may
have any length; repeated rows are documents each; a group without terms, or in a language that keeps none, has pairs of
value 0 (or by its floor alone) and no terms; a language's only source has no pairs; ties rank by the item's UTF-8 bytes;
an empty table gives an empty table. Only text, lang and source are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mnesis.llm.common import settled, slices, text_or_empty

SLICE = 8 << 20
#: Parts of up to LEAF pointers are sorted at once, and all parts of up to FEW together.
LEAF, FEW = 32768, 256
#: Terms of a block of the pair sums, about, and entries of one of its matrices.
BLOCK, ENTRIES = 128, 1 << 20
UNIT, PRIOR = 1_000_000_000, 5
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
IN_WORD = (np.arange(256) >= 128) | ((np.arange(256) >= 97) & (np.arange(256) <= 122))
#: MASK[n]: the first n of eight bytes.
MASK = np.array([(0xFFFFFFFFFFFFFFFF << (64 - 8 * n)) & 0xFFFFFFFFFFFFFFFF for n in range(9)], np.uint64)


def word_pointers(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and length of every word of the lower-cased bytes, and the text that it is in; bounds: where texts start and end."""
    word = IN_WORD[data]
    edge = word.copy()
    edge[1:] &= ~word[:-1]
    begins = bounds[:-1][bounds[:-1] < bounds[1:]]
    edge[begins] = word[begins]
    start = np.flatnonzero(edge)
    edge = word.copy()
    edge[:-1] &= ~word[1:]
    edge[bounds[1:][bounds[:-1] < bounds[1:]] - 1] = word[bounds[1:][bounds[:-1] < bounds[1:]] - 1]
    return start, np.flatnonzero(edge) + 1 - start, np.searchsorted(bounds, start, "right") - 1


def sorted_runs(data: np.ndarray, start: np.ndarray, length: np.ndarray, order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The pointers of ``order`` sorted by their words, equal words as they stood, and whether a run of equal words begins
    at each. data ends with eight bytes to spare."""
    windows = np.ndarray(len(data) - 7, np.uint64, data, strides=(1,))  # eight bytes from anywhere
    order, begins = order.copy(), np.zeros(len(order), bool)
    lows, highs, depth = np.zeros(1, np.int64), np.full(1, len(order)), 0
    while len(lows) and len(order):  # parts whose words are equal so far, in order of place
        deeper: list[tuple[np.ndarray, np.ndarray]] = []

        def words(at: np.ndarray) -> np.ndarray:
            left = np.clip(length[at] - 8 * depth, 0, 8)  # noqa: B023
            return windows[np.where(left > 0, start[at] + 8 * depth, 0)].byteswap() & MASK[left]  # noqa: B023

        def place(places: np.ndarray, keys: np.ndarray, new: np.ndarray) -> None:
            """Runs begin at the places where ``new`` holds; those that don't end within these eight bytes go deeper."""
            heads = np.flatnonzero(new)
            begins[places[heads]] = True
            size = np.diff(np.append(heads, len(places)))
            more = (size > 1) & (keys[heads] & np.uint64(0xFF) != 0)
            deeper.append((places[heads[more]], places[heads[more]] + size[more]))  # noqa: B023

        few = highs - lows <= FEW
        stack = [(lo, hi, words(order[lo:hi])) for lo, hi in zip(lows[~few].tolist(), highs[~few].tolist(), strict=True)]
        while stack:
            lo, hi, keys = stack.pop()
            at = order[lo:hi]
            if hi - lo > LEAF:
                some = np.sort(keys[:: max(1, (hi - lo) // 63)])
                pivot = some[len(some) // 2]
                less, equal = keys < pivot, keys == pivot
                more = ~(less | equal)
                order[lo:hi] = np.concatenate((at[less], at[equal], at[more]))
                a, b = lo + np.count_nonzero(less), hi - np.count_nonzero(more)
                place(np.arange(a, b), keys[equal], np.arange(b - a) == 0)
                stack += [x for x in ((lo, a, keys[less]), (b, hi, keys[more])) if x[0] < x[1]]
            else:
                by = np.argsort(keys, kind="stable")
                order[lo:hi], keys = at[by], keys[by]
                place(np.arange(lo, hi), keys, np.concatenate(([True], keys[1:] != keys[:-1])))
        if few.any():
            size = (highs - lows)[few]
            places = np.repeat(lows[few] - (np.cumsum(size) - size), size) + np.arange(size.sum())
            part, keys = np.repeat(np.arange(len(size)), size), words(order[places])
            by = np.lexsort((keys, part))
            order[places], keys = order[places][by], keys[by]
            place(places, keys, np.concatenate(([True], (keys[1:] != keys[:-1]) | (part[1:] != part[:-1]))))
        lows, highs = (np.concatenate(x) for x in zip(*deeper, strict=True))
        depth += 1
    return order, begins


def counted_words(texts: pa.Array, group: np.ndarray) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
    """Term, group, count and document frequency of every pair of term and group in the texts."""
    bounds = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    raw = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[bounds[0] : bounds[-1]]
    data = np.zeros(len(raw) + 8, np.uint8)
    data[: len(raw)] = LOWER[raw]
    start, length, doc = word_pointers(data[: len(raw)], bounds - bounds[0])
    of = group[doc].astype(np.int64)
    order, run = sorted_runs(data, start, length, np.argsort(of.astype(np.uint16) if len(group) < 1 << 16 else of, kind="stable"))
    if not len(order):
        return pa.array([], pa.string()), *[np.zeros(0, np.int64)] * 3
    new = np.ones(len(order), bool)
    new[1:] = doc[order[1:]] != doc[order[:-1]]
    run[1:] |= of[order[1:]] != of[order[:-1]]
    at = np.flatnonzero(run)
    first, counts = order[at], np.diff(np.append(at, len(order)))
    size = length[first]
    ends = np.cumsum(size)
    text = data[np.repeat(start[first] - (ends - size), size) + np.arange(ends[-1])]
    terms = pa.StringArray.from_buffers(len(at), pa.py_buffer(np.concatenate(([0], ends)).astype(np.int32)), pa.py_buffer(text.tobytes()))
    return terms, of[first], counts, np.add.reduceat(new | run, at, dtype=np.int64)


def count_stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """lang, source, term, n and docs of every slice; a row with an empty term says that the group occurs."""
    for part in slices(batches, limit=SLICE):
        lang, source = part.column("lang").dictionary_encode(), part.column("source").dictionary_encode()
        code = lang.indices.to_numpy().astype(np.int64) * len(source.dictionary) + source.indices.to_numpy()
        groups, group = np.unique(code, return_inverse=True)
        terms, of, n, docs = counted_words(part.column("text"), group.reshape(-1))
        code = np.concatenate((groups, groups[of]))
        none = np.zeros(len(groups), np.int64)
        yield pa.RecordBatch.from_arrays(
            [
                lang.dictionary.take(pa.array(code // len(source.dictionary))), source.dictionary.take(pa.array(code % len(source.dictionary))),
                pa.concat_arrays([pa.array([""] * len(groups), pa.string()), terms]), pa.array(np.concatenate((none, n))), pa.array(np.concatenate((none, docs))),
            ],
            ["lang", "source", "term", "n", "docs"],
        )


def term_counts(docs: DataFrame) -> DataFrame:
    """lang, source, term, n (occurrences) and docs (documents that have it); also the empty term with zeros for each group."""
    rows = docs.select(text_or_empty("text").alias("text"), text_or_empty("lang").alias("lang"), text_or_empty("source").alias("source"))
    counted = rows.mapInArrow(count_stream, "lang string, source string, term string, n long, docs long")
    return counted.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def share(count: str, of: str) -> F.Column:
    return F.expr(f"1 + (cast({UNIT} as decimal(10, 0)) * cast({count} + {PRIOR} as decimal(20, 0))) div cast({of} as decimal(20, 0))").cast("long")


def pair_sums(mine: pa.Table, all_sources: pa.Table) -> pa.Table:
    """Of a block of terms: for every two sources of the language, the sum of what their shares differ by."""
    lang = all_sources.column("lang")[0].as_py() if len(all_sources) else ""
    everyone = all_sources.sort_by("source")
    sources, floor = everyone.column("source").combine_chunks(), everyone.column("p0").to_numpy()
    sums = [np.zeros(len(sources) - a - 1, np.int64) for a in range(len(sources))]
    if len(mine):
        term = mine.column("term").combine_chunks().dictionary_encode()
        code, column, p = term.indices.to_numpy(), pc.index_in(mine.column("source"), sources).to_numpy(), mine.column("p").to_numpy()
        step = max(1, ENTRIES // len(sources))
        for lo in range(0, len(term.dictionary), step):
            here = (code >= lo) & (code < lo + step)
            share_of = np.tile(floor, (min(step, len(term.dictionary) - lo), 1))
            share_of[code[here] - lo, column[here]] = p[here]
            by_source = np.ascontiguousarray(share_of.T)
            for a in range(len(sources) - 1):
                sums[a] += np.abs(by_source[a + 1 :] - by_source[a]).sum(1)
    a = np.repeat(np.arange(len(sources)), [len(x) for x in sums])
    b = np.concatenate([np.arange(i + 1, len(sources)) for i in range(len(sources))]) if len(sources) else a
    return pa.table({"lang": pa.array([lang] * len(a), pa.string()), "a": sources.take(pa.array(a)), "b": sources.take(pa.array(b)), "value": np.concatenate(sums) if sums else np.zeros(0, np.int64)})


def audit(docs: DataFrame, least: int = 30, ranks: int = 50) -> DataFrame:
    """lang, source, part (pair or term), item, value and rank: how far each other source of the language is, and the terms
    that the source has more of than its language, up to so many ranks."""
    counts = settled(term_counts(docs), "divergence-counts")
    of_term = Window.partitionBy("lang", "term")
    terms = counts.where(F.col("term") != "")
    terms = terms.select("*", F.sum("docs").over(of_term).alias("lang_docs"), F.sum("n").over(of_term).alias("lang_n"), (F.col("source") == F.min("source").over(of_term)).alias("first"))
    kept = settled(terms.where(F.col("lang_docs") >= least).drop("docs", "lang_docs"), "divergence-kept")
    sizes = kept.groupBy("lang", "source").agg(F.sum("n").alias("n"), F.sum(F.col("first").cast("long")).alias("v"))
    of_lang = sizes.groupBy("lang").agg(F.sum("n").alias("lang_n"), F.sum("v").alias("v"))
    groups = counts.where(F.col("term") == "").select("lang", "source").join(sizes.drop("v"), ["lang", "source"], "left").join(of_lang, "lang", "left").na.fill(0)
    groups = groups.select("lang", "source", (F.col("n") + PRIOR * F.col("v")).alias("whole"), (F.col("lang_n") + PRIOR * F.col("v")).alias("lang_whole"), "v")
    groups = settled(groups.withColumn("p0", F.when(F.col("v") > 0, share("0", "nullif(whole, 0)")).otherwise(F.lit(0))).repartition(1), "divergence-groups")
    shares = kept.join(groups, ["lang", "source"]).select("lang", "source", "term", "v", share("n", "whole").alias("p"), share("lang_n", "lang_whole").alias("q"))

    last = F.floor(F.col("v") / BLOCK).cast("long")  # the number of a language's last block
    mine = shares.select("lang", F.pmod(F.xxhash64("term"), last + 1).alias("block"), "term", "source", "p").groupBy("lang", "block")
    all_sources = groups.select("lang", F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("block"), "source", "p0").groupBy("lang", "block")
    sums = mine.cogroup(all_sources).applyInArrow(pair_sums, "lang string, a string, b string, value long").groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))
    both = F.explode(F.array(F.struct(F.col("a").alias("source"), F.col("b").alias("item")), F.struct(F.col("b").alias("source"), F.col("a").alias("item"))))
    ranked = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    rank = F.row_number().over(ranked)
    pairs = sums.select("lang", both.alias("x"), "value").select("lang", "x.source", F.lit("pair").alias("part"), "x.item", "value").withColumn("rank", rank)
    more = shares.where(F.col("p") > F.col("q")).select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))
    return pairs.unionByName(more.withColumn("rank", rank).where(F.col("rank") <= ranks))


#: DuckDB's SQL for ``audit`` of documents.
SQL = r"""
WITH d AS (SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
w AS (SELECT id, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
k AS (SELECT lang, term, count(*) AS lang_n FROM w GROUP BY lang, term HAVING count(DISTINCT id) >= 30),
c AS (SELECT lang, source, term, count(*) AS n FROM w JOIN k USING (lang, term) GROUP BY ALL),
v AS (SELECT lang, count(*) AS v, sum(lang_n) AS lang_total FROM k GROUP BY lang),
g AS (SELECT lang, source, coalesce(total, 0) AS total FROM (SELECT DISTINCT lang, source FROM d) LEFT JOIN (SELECT lang, source, sum(n) AS total FROM c GROUP BY ALL) USING (lang, source)),
p AS (SELECT g.lang, g.source, k.term, coalesce(n, 0) AS n, 1 + (1000000000::HUGEINT * (coalesce(n, 0) + 5)) // (total + 5 * v) AS p, 1 + (1000000000::HUGEINT * (lang_n + 5)) // (lang_total + 5 * v) AS q
      FROM g JOIN v USING (lang) JOIN k USING (lang) LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
pairs AS (SELECT a.lang, a.source, b.source AS item, coalesce(value, 0) AS value FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
          LEFT JOIN (SELECT x.lang, x.source, y.source AS item, sum(abs(x.p - y.p)) AS value FROM p x JOIN p y ON x.lang = y.lang AND x.term = y.term GROUP BY ALL) s
          ON s.lang = a.lang AND s.source = a.source AND s.item = b.source),
r AS (SELECT lang, source, 'pair' AS part, item, value FROM pairs UNION ALL SELECT lang, source, 'term', term, p - q FROM p WHERE n > 0 AND p > q),
o AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM r)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank FROM o WHERE part = 'pair' OR rank <= 50
"""
