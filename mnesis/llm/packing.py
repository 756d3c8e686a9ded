"""Best-fit packing of token pieces into sequences, bettered by swap-based local search.

Documents are encoded where they are read; only (document, piece, length) travels. Pieces are dealt at random to groups
of about ``GROUP`` pieces, and each group is packed by itself: best fit in falling order of length, then a local search
over the bins that aren't full. It moves pieces, exchanges one piece for one, two for one or one for two between two bins
whenever the sum of squared fills rises, so that full bins get fuller and thin bins end empty. Pieces of one length in a
bin are alike, so a bin's pairs are those of its distinct lengths: 63 at most in 2048 tokens, however many pieces it has.
What then still stands in thin bins (under ``KEEP_FILL`` full) is dealt to groups again, as the few bins that each group
leaves can be joined, until one group holds it or a round saves fewer sequences than it has groups.

A document over the limit is cut; its first piece takes what is over a multiple of the limit, the others are full.

Defined results: a null or empty text is its end id alone; repeated rows are packed each; pieces of equal length are taken
in the order of doc_id, piece and content; a text of any length is encoded whole; other columns, whatever their names,
are ignored; an empty table gives an empty table.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mnesis.llm.common import settled, slices
from mnesis.llm.encoding import encoder_of, with_ends

LIMIT = 2048
GROUP = 6000
KEEP_FILL = 0.995
PIECE = "piece int, start long, length long, ids_crc32 long"


def pieces(docs: DataFrame, tokenizer: str, end: int = 0, limit: int = LIMIT, carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """A row for each piece: the columns of ``carry``, piece, start, length, ids_crc32. No shuffle."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(tokenizer)
        for b in slices(batches):
            ids, offsets = with_ends(*encoder.encode(b.column("text")), end)
            size = np.diff(offsets)
            count = -(-size // limit)
            first = size - (count - 1) * limit
            row = np.repeat(np.arange(b.num_rows), count)
            piece = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
            start = np.where(piece > 0, first[row] + (piece - 1) * limit, 0)
            length = np.where(piece > 0, limit, first[row])
            data, at = memoryview(ids.astype("<u4").tobytes()), 4 * (offsets[row] + start)
            crc = [zlib.crc32(data[s : s + 4 * n]) for s, n in zip(at, length, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [*(b.column(c).take(pa.array(row)) for c in carry), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())],
                [*carry, "piece", "start", "length", "ids_crc32"],
            )

    types = dict(docs.dtypes)
    return docs.select(*dict.fromkeys([*carry, "text"])).mapInArrow(cut, ", ".join([*(f"`{c}` {types[c]}" for c in carry), PIECE]))


class Bins:
    """Bins of pieces, found by the room that is left in them."""

    def __init__(self, limit: int):
        self.limit, self.items, self.room = limit, [], []
        self.with_room: list[list[int]] = [[] for _ in range(limit + 1)]
        self.rooms = 0  # bit r: some bin has r left

    def put(self, b: int, room: int) -> None:
        self.room[b] = room
        if room:
            self.with_room[room].append(b)
            self.rooms |= 1 << room

    def tightest(self, length: int) -> int | None:
        """The bin with the least room that takes ``length``; it is taken off the lists."""
        above = self.rooms >> length
        while above:
            r = length + (above & -above).bit_length() - 1
            stack = self.with_room[r]
            b = stack.pop()
            if not stack:
                self.rooms &= ~(1 << r)
            return b
        return None


def best_fit(lengths: np.ndarray, limit: int) -> tuple[list[list[int]], list[int]]:
    """Pieces of each bin and the room that it has left; longest pieces first, each to the tightest bin."""
    bins = Bins(limit)
    for i in np.argsort(-lengths, kind="stable").tolist():
        n = int(lengths[i])
        b = bins.tightest(n)
        if b is None:
            b = len(bins.items)
            bins.items.append([])
            bins.room.append(limit)
        bins.items[b].append(i)
        bins.put(b, bins.room[b] - n)
    return bins.items, bins.room


class Search:
    """Exchanges between bins. size: of each piece. bin_of: the bin of each piece. room: what is left in each bin."""

    def __init__(self, items: list[list[int]], room: list[int], lengths: np.ndarray):
        self.items, self.size = items, lengths.astype(np.int64)
        self.room, self.bin_of = np.array(room, np.int64), np.zeros(len(lengths), np.int64)
        for b, own in enumerate(items):
            self.bin_of[own] = b
        self.first, self.second = self.pairs(range(len(items)))

    def alike(self, b: int, each: int) -> list[int]:
        """The pieces of a bin, at most ``each`` of one length."""
        seen: dict[int, int] = {}
        out = []
        for i in self.items[b]:
            n = int(self.size[i])
            seen[n] = seen.get(n, 0) + 1
            if seen[n] <= each:
                out.append(i)
        return out

    def pairs(self, bins) -> tuple[np.ndarray, np.ndarray]:
        """Two pieces of a bin for every two lengths that it has."""
        found = []
        for b in bins:
            of = {(self.size[i], self.size[j]): (i, j) for i, j in combinations(sorted(self.alike(b, 2), key=lambda i: self.size[i]), 2)}
            found += of.values()
        return tuple(np.array([p[k] for p in found], np.int64) for k in (0, 1))

    def best(self, thin: int) -> tuple[int, int, tuple[int, ...], tuple[int, ...]] | None:
        """(gain, bin, pieces given to it, pieces taken): of all exchanges of ``thin`` with a bin that isn't thinner, the one
        that fills the other most: one or two pieces moved, one or two for one, one for two."""
        own = self.alike(thin, 1)
        gives = [(i,) for i in own] + [(int(i), int(j)) for i, j in zip(*self.pairs([thin]), strict=True)]
        open_bin = (self.room > 0) & (self.room <= self.room[thin])
        open_bin[thin] = False
        bins = np.flatnonzero(open_bin)
        pieces = np.flatnonzero(open_bin[self.bin_of])
        pairs = np.flatnonzero(open_bin[self.bin_of[self.first]])
        left, right = self.first[pairs], self.second[pairs]
        found = None
        for n, (at, taken, given) in enumerate((
            (bins, np.zeros(len(bins), np.int64), gives),
            (self.bin_of[pieces], self.size[pieces], gives),
            (self.bin_of[left], self.size[left] + self.size[right], gives[: len(own)]),
        )):
            if not len(at):
                continue
            total = np.array([sum(self.size[i] for i in g) for g in given])
            order = np.argsort(total, kind="stable")
            total = total[order]
            which = np.searchsorted(total, taken + self.room[at], "right") - 1  # the most that the bin can take
            gain = np.where(which >= 0, total[which] - taken, 0)
            k = int(np.argmax(gain))
            if gain[k] > (found[0] if found else 0):
                take = ((), (int(pieces[k]),) if n == 1 else (), (int(left[k]), int(right[k])) if n == 2 else ())[n]
                found = (int(gain[k]), int(at[k]), given[order[which[k]]], take)
        return found

    def exchange(self, thin: int, gain: int, other: int, give: tuple[int, ...], take: tuple[int, ...]) -> None:
        self.items[thin] = [i for i in self.items[thin] if i not in give] + list(take)
        self.items[other] = [i for i in self.items[other] if i not in take] + list(give)
        self.bin_of[list(give)], self.bin_of[list(take)] = other, thin
        self.room[thin] += gain
        self.room[other] -= gain
        rest = ~np.isin(self.bin_of[self.first], (thin, other)) & (self.bin_of[self.first] == self.bin_of[self.second])
        self.first, self.second = (np.concatenate((x[rest], fresh)) for x, fresh in zip((self.first, self.second), self.pairs((thin, other)), strict=True))


def local_search(items: list[list[int]], room: list[int], lengths: np.ndarray, limit: int) -> tuple[list[list[int]], list[int]]:
    """Bins after exchanges that fill the fuller of two bins, thin bins first, each until it is empty or has no exchange left.
    The sum of squared fills rises with each. Ends with the least possible number of bins, or when a round over all bins
    changes nothing; empty bins stay as empty lists."""
    s = Search(items, room, lengths)
    least, used = -(-int(s.size.sum()) // limit), sum(map(bool, items))
    changed = True
    while changed and used > least:
        changed = False
        for thin in np.argsort(-s.room, kind="stable").tolist():
            while s.items[thin] and used > least and (found := s.best(thin)):
                s.exchange(thin, *found)
                changed = True
                used -= not s.items[thin]
    return s.items, s.room.tolist()


def packed_group(limit: int):
    def pack(table: pa.Table) -> pa.Table:
        order = [c for c in ("doc_id", "piece", "start", "ids_crc32") if c in table.column_names]
        table = table.sort_by([("length", "descending"), *((c, "ascending") for c in order)])
        lengths = table.column("length").to_numpy()
        items, room = best_fit(lengths, limit)
        items, room = local_search(items, room, lengths, limit)
        bin_of, offset, fill = np.zeros((3, len(lengths)), np.int64)
        for b, own in enumerate(items):
            own = np.array(sorted(own), np.int64)
            if len(own):
                ends = np.cumsum(lengths[own])
                bin_of[own], offset[own], fill[own] = b, ends - lengths[own], ends[-1]
        first = table.column("grp")[0].as_py() << 20
        return table.append_column("sequence_id", pa.array(first + bin_of)).append_column("offset", pa.array(offset)).append_column("fill", pa.array(fill))

    return pack


def pack(cut: DataFrame, limit: int = LIMIT, group: int = GROUP) -> DataFrame:
    """The rows of ``pieces`` with sequence_id and offset. What stands in thin bins is dealt and packed again until one group
    holds it, or a round saves fewer sequences than it has groups: then groups are as well packed as the search can."""
    cut = settled(cut, "pieces")
    types = ", ".join(f"`{c}` {t}" for c, t in cut.dtypes)
    packed = cut.where(F.col("length") == limit).withColumn("sequence_id", -1 - F.monotonically_increasing_id()).withColumn("offset", F.lit(0).cast("long"))
    dealt = F.xxhash64(F.monotonically_increasing_id(), F.lit(3))  # so that equal rows spread, too
    left, first, took = cut.where(F.col("length") < limit), 0, None
    n = left.count()
    while n:
        groups = -(-n // group)
        own = left.withColumn("grp", first + F.pmod(dealt, F.lit(groups))).groupBy("grp").applyInArrow(packed_group(limit), f"{types}, grp long, sequence_id long, offset long, fill long")
        own = settled(own, "packed")
        is_thin = F.col("fill") < int(KEEP_FILL * limit)
        ends = own.select("sequence_id", is_thin.alias("thin")).distinct().agg(F.count("*"), F.count_if("thin")).first()
        saves = took is None or took - ends[0] >= groups
        thin, took = F.lit(groups > 1 and saves) & is_thin, ends[1]
        packed = packed.unionByName(own.where(~thin).drop("grp", "fill"))
        left, first = own.where(thin).select(*cut.columns), first + groups
        n = left.count()
    return packed
