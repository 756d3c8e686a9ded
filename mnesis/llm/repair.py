"""Token ids on disk under Re-Pair grammars, with random access.

Documents are range-partitioned by doc_id and sorted; each task encodes its documents in turn and closes a shard at
``SHARD`` ids. A shard is compressed by repeated replacement: in each round the most frequent pairs of neighbouring
symbols, up to ``PER_ROUND`` at once, become new symbols, left to right, until no pair occurs twice; every rule stands for
two places at least. Pairs don't cross documents, so a document is a run of symbols. A file holds the rules (two symbols
each), how many ids each rule stands for, the symbols and each document's place; ``read_ids`` finds ids by the running
sum of those lengths and expands only the symbols that it needs.

Files have the number of the task's attempt in their names and only those of the successful attempt are in the manifest,
so a task can run again anywhere.

Defined results: a null text is empty, its document the end id alone; null doc_ids come first; repeated rows are stored
each, equal doc_ids in the order of their texts' hashes, and any number of equal rows is spread over tasks; a text of any
length is encoded whole and stays in one shard; other columns, whatever their names, are ignored; an empty table gives
no shards and no rows.
"""

from __future__ import annotations

import json
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mnesis.llm.common import settled, shared_folder, slices
from mnesis.llm.encoding import encoder_of, with_ends

MAGIC = b"RPG1"
SHARD = 1 << 20
PER_ROUND = 131_072
#: Bits of the table of pairs: as many as a round's pairs ask for, from the least to the most.
SLOTS = (10, 19)
ARRAYS = ("left", "right", "lengths", "bounds", "symbols", "doc_symbols", "doc_tokens", "doc_ids", "doc_null")


@dataclass
class Grammar:
    """base: the first nonterminal. left, right, lengths: of each rule. bounds: where each round's rules end."""

    base: int
    left: np.ndarray
    right: np.ndarray
    lengths: np.ndarray
    bounds: np.ndarray


def every_other(places: np.ndarray) -> np.ndarray:
    """True for the first, third, fifth, ... of each run of successive places."""
    begun = np.maximum.accumulate(np.where(np.append(True, np.diff(places) != 1)[: len(places)], places, 0))
    return (places - begun) % 2 == 0


def slot_of(pair: np.ndarray, bits: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return ((pair * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - bits)).astype(np.int64)


def by_frequency(pairs: np.ndarray) -> np.ndarray:
    """The pairs that occur twice or more, the most frequent last."""
    ordered = np.sort(pairs)
    starts = np.flatnonzero(np.append(True, ordered[1:] != ordered[:-1])[: len(ordered)])
    count = np.diff(np.append(starts, len(ordered)))
    often = np.flatnonzero(count >= 2)
    return ordered[starts[often[np.argsort(count[often], kind="stable")]]]


def may_be_in(some: np.ndarray, pairs: np.ndarray) -> np.ndarray:
    """True for pairs that are in some, and for at most one in 32 of the others or so."""
    bits = len(some).bit_length() + 5
    marked = np.zeros(1 << bits, bool)
    marked[slot_of(some, bits)] = True
    return marked[slot_of(pairs, bits)]


def compress(ids: np.ndarray, last: np.ndarray, base: int) -> tuple[Grammar, np.ndarray]:
    """The grammar and the symbols of ids; last: true where a document ends. base: above all ids.

    A round looks only at pairs that the last one made and at those that it found twice. A pair that has been found once
    never occurs again: all pairs that a round makes have a symbol of that round."""
    symbols, last, alive = ids.astype(np.uint32), last.copy(), np.ones(len(ids), bool)
    left, right, bounds = [np.zeros(0, np.uint64)], [np.zeros(0, np.uint64)], [0]
    rng = np.random.default_rng(0)
    while True:
        at = np.flatnonzero(alive[:-1] & ~last[:-1])
        pair = (symbols[at].astype(np.uint64) << np.uint64(32)) | symbols[at + 1]
        counted = np.ones(len(at), bool)
        inside = np.flatnonzero((pair[1:] == pair[:-1]) & (at[1:] == at[:-1] + 1)) + 1
        counted[inside[every_other(inside)]] = False  # of aaa, the second aa overlaps the first
        often = by_frequency(pair[counted])
        if not len(often):
            break
        alive[at] = twice = may_be_in(often, pair)
        at, pair, chosen = at[twice], pair[twice], often[-PER_ROUND:]
        bits = min(SLOTS[1], max(SLOTS[0], len(at).bit_length() + 1))
        slot, slots = slot_of(pair, bits), 1 << bits
        while True:
            table = np.full(slots, ~np.uint64(0))
            table[slot_of(chosen, bits)] = chosen  # of two pairs in a slot the more frequent stays, the other waits for the next round
            use = np.flatnonzero(table[slot] == pair)
            use = use[every_other(at[use])]
            count = np.bincount(slot[use], minlength=slots)
            made = np.flatnonzero(count >= 2)
            if len(made):
                break
            chosen = rng.permutation(chosen)[: -(-len(chosen) // 2)]  # all were in each other's way; one alone never is
        made = made[np.argsort(table[made])]
        number = np.zeros(slots, np.uint64)
        number[made] = np.arange(len(made), dtype=np.uint64) + np.uint64(base + bounds[-1])
        use = use[count[slot[use]] >= 2]
        place = at[use]
        symbols[place], last[place] = number[slot[use]], last[place + 1]
        alive[place] = alive[np.maximum(place - 1, 0)] = True
        keep = np.ones(len(symbols), bool)
        keep[place + 1] = False
        symbols, last, alive = symbols[keep], last[keep], alive[keep]
        left.append(table[made] >> np.uint64(32))
        right.append(table[made] & np.uint64(0xFFFFFFFF))
        bounds.append(bounds[-1] + len(made))
    lengths = np.ones(base + bounds[-1], np.int64)
    for k in range(1, len(bounds)):
        lengths[base + bounds[k - 1] : base + bounds[k]] = lengths[left[k].astype(np.int64)] + lengths[right[k].astype(np.int64)]
    grammar = Grammar(base, np.concatenate(left).astype(np.uint32), np.concatenate(right).astype(np.uint32), lengths[base:].astype(np.uint32), np.array(bounds, np.uint32))
    return grammar, symbols


def symbol_lengths(g: Grammar, symbols: np.ndarray) -> np.ndarray:
    out = np.ones(len(symbols), np.int64)
    rule = symbols >= g.base
    out[rule] = g.lengths[symbols[rule] - g.base]
    return out


def joined(ids: np.ndarray, starts: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The runs of n ids from each start, one after another."""
    ends = np.cumsum(n)
    return ids[np.repeat(starts - (ends - n), n) + np.arange(ends[-1])]


def expand(g: Grammar, symbols: np.ndarray) -> np.ndarray:
    """The ids that symbols stand for. Where all rules' ids together are fewer, each rule is spelt once, those of the first
    round first; else, as for a piece of a document, the symbols' rules are undone, those of the last round first."""
    if g.lengths.sum(dtype=np.int64) < symbol_lengths(g, symbols).sum():
        n = np.concatenate((np.ones(g.base, np.int64), g.lengths.astype(np.int64)))
        starts = np.cumsum(n) - n
        ids = np.empty(n.sum(), np.uint32)
        ids[: g.base] = np.arange(g.base)
        for lo, hi in zip(g.bounds[:-1].astype(np.int64), g.bounds[1:].astype(np.int64), strict=True):
            both = np.stack((g.left[lo:hi], g.right[lo:hi]), axis=1).reshape(-1)
            ids[starts[g.base + lo] : starts[g.base + hi - 1] + n[g.base + hi - 1]] = joined(ids, starts[both], n[both])
        return joined(ids, starts[symbols], n[symbols])
    for k in range(len(g.bounds) - 1, 0, -1):
        rule = symbols >= g.base + g.bounds[k - 1]
        at = symbols[rule] - g.base
        first = (np.cumsum(rule) + np.arange(len(rule)) - 1)[rule]
        symbols = np.repeat(symbols, 1 + rule)
        symbols[first], symbols[first + 1] = g.left[at], g.right[at]
    return symbols


def to_bytes(arrays: dict[str, np.ndarray], base: int) -> bytes:
    packed = {k: zstandard.ZstdCompressor(level=1).compress(arrays[k].tobytes()) for k in ARRAYS}
    head = json.dumps({"base": base, "arrays": [[k, arrays[k].dtype.str, len(packed[k])] for k in ARRAYS]}).encode()
    return MAGIC + struct.pack("<I", len(head)) + head + b"".join(packed[k] for k in ARRAYS)


@dataclass
class Shard:
    grammar: Grammar
    arrays: dict[str, np.ndarray]

    @classmethod
    def from_bytes(cls, data: bytes) -> Shard:
        if data[:4] != MAGIC:
            raise ValueError("not a shard of token ids")
        (size,) = struct.unpack("<I", data[4:8])
        head, at, arrays = json.loads(data[8 : 8 + size]), 8 + size, {}
        for name, kind, n in head["arrays"]:
            arrays[name] = np.frombuffer(zstandard.ZstdDecompressor().decompress(data[at : at + n]), kind)
            at += n
        return cls(Grammar(head["base"], arrays["left"], arrays["right"], arrays["lengths"], arrays["bounds"]), arrays)

    def read_ids(self, document: int, start: int = 0, stop: int | None = None) -> np.ndarray:
        """ids[start:stop] of a document of this shard, without expanding what lies before or after."""
        a = self.arrays
        symbols = a["symbols"][a["doc_symbols"][document] : a["doc_symbols"][document + 1]]
        ends = np.cumsum(symbol_lengths(self.grammar, symbols))
        stop = int(ends[-1]) if stop is None else min(stop, int(ends[-1]))
        if start >= stop:
            return np.zeros(0, np.uint32)
        first, beyond = np.searchsorted(ends, start, "right"), np.searchsorted(ends, stop, "left") + 1
        skipped = int(ends[first - 1]) if first else 0
        return expand(self.grammar, symbols[first:beyond])[start - skipped : stop - skipped]


def shard_bytes(ids: np.ndarray, offsets: np.ndarray, doc_ids: pa.Array, base: int) -> bytes:
    last = np.zeros(len(ids), bool)
    last[offsets[1:] - 1] = True
    grammar, symbols = compress(ids, last, base)
    starts = np.cumsum(symbol_lengths(grammar, symbols))
    doc_symbols = np.concatenate(([0], np.searchsorted(starts, offsets[1:], "left") + 1))
    null = doc_ids.is_null().to_numpy(zero_copy_only=False)
    return to_bytes(
        {
            **{k: getattr(grammar, k) for k in ("left", "right", "lengths", "bounds")},
            "symbols": symbols,
            "doc_symbols": doc_symbols.astype(np.uint64),
            "doc_tokens": np.diff(offsets).astype(np.uint32),
            "doc_ids": doc_ids.fill_null(0).to_numpy().astype(np.int64),
            "doc_null": null.astype(np.uint8),
        },
        base,
    )


def write_shards(docs: DataFrame, folder: str, tokenizer: str, end: int, shard: int = SHARD) -> DataFrame:
    """Writes docs to shards in ascending order of doc_id; their manifest (part, shard, path, n_docs, n_tokens, start)
    with the ids before each shard."""

    def written(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, context = encoder_of(tokenizer), TaskContext.get()
        base = max(encoder.whole.get_vocab_size(), end + 1)
        store, path = pafs.FileSystem.from_uri(folder)
        store.create_dir(path, recursive=True)
        held: list[tuple[np.ndarray, np.ndarray, pa.Array]] = []
        number = 0

        def close() -> pa.RecordBatch:
            ids = np.concatenate([x[0] for x in held])
            sizes = np.concatenate([np.diff(x[1]) for x in held])
            keys = pa.concat_arrays([x[2] for x in held])
            name = f"{path}/{context.partitionId():06d}-{number:05d}-{context.taskAttemptId()}.rpg"
            with store.open_output_stream(name) as f:
                f.write(shard_bytes(ids, np.concatenate(([0], np.cumsum(sizes))), keys, base))
            held.clear()
            row = (context.partitionId(), number, name, len(sizes), len(ids))
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, (pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int64()), strict=True)], ["part", "shard", "path", "n_docs", "n_tokens"])

        for b in slices(batches):
            held.append((*with_ends(*encoder.encode(b.column("text")), end), b.column("doc_id")))
            if sum(len(x[0]) for x in held) >= shard:
                yield close()
                number += 1
        if held:
            yield close()

    order = ["doc_id", "tie", "nth"]
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("tie"), F.monotonically_increasing_id().alias("nth"))
    manifest = settled(rows.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(written, "part int, shard int, path string, n_docs long, n_tokens long"), "manifest")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    inside = Window.partitionBy("part").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    parts = manifest.groupBy("part").agg(F.sum("n_tokens").alias("n")).select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("part_start"))
    start = F.col("part_start") + F.coalesce(F.sum("n_tokens").over(inside), F.lit(0))
    return manifest.join(parts, "part").select(*manifest.columns, start.alias("start"))


def read_documents(manifest: DataFrame, folder: str, files: int) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from the files alone. files: how many there are."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, _ = pafs.FileSystem.from_uri(folder)
        for b in batches:
            for path, start in zip(b.column("path").to_pylist(), b.column("start").to_pylist(), strict=True):
                with store.open_input_file(path) as f:
                    s = Shard.from_bytes(f.read())
                a = s.arrays
                ids = expand(s.grammar, a["symbols"]).astype("<u4")
                ends = np.cumsum(a["doc_tokens"].astype(np.int64))
                starts, data = ends - a["doc_tokens"], memoryview(ids.tobytes())
                crc = [zlib.crc32(data[4 * i : 4 * j]) for i, j in zip(starts, ends, strict=True)]
                doc_ids = pa.array(a["doc_ids"], mask=a["doc_null"].astype(bool))
                yield pa.RecordBatch.from_arrays([doc_ids, pa.array(start + starts), pa.array(a["doc_tokens"].astype(np.int64)), pa.array(crc, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])

    spread = manifest.select("path", "start").repartition(max(1, min(files, 10_000)))
    return spread.mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def round_trip(docs: DataFrame, tokenizer: str, end: int) -> DataFrame:
    """docs written to shards in the shared folder and read back."""
    folder = shared_folder(docs.sparkSession, "tokens")
    manifest = write_shards(docs, folder, tokenizer, end)
    return read_documents(manifest, folder, manifest.count())
