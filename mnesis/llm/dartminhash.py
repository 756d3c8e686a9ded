"""Near-duplicate classes of documents by DartMinHash signatures, banded joins and an exact check.

A document is the weighted set of its five-word shingles (words between white space, lower-cased, marks dropped; a
shorter text is one shingle), each weighing as often as it occurs. Darts are thrown by hash: each unit of weight of an
element gets about one dart for each unit of rank, with a rank uniform within it and one of ``K`` coordinates; a dart
of a fractional unit counts if it falls into the fraction. A coordinate's value is its earliest dart, so two documents
agree in a coordinate with the probability of their weighted Jaccard similarity. A text throws as many darts as fill
all coordinates, about K ln K + 2 K whatever its size, so that K can be large.

Classes are the connected components of links of similarity 0.8 or more.

1. Equal shingle sets are joined at once by a hash of the whole set, which stands for its documents in all that follows;
   sets become least doc_ids at the end. So rows that share a doc_id and differ in text have links of their own.
2. Documents that agree in all ``ROWS`` coordinates of one of ``BANDS`` bands meet in a bucket. Each is checked exactly
   against the bucket's first document, its hub.
3. Buckets most of whose members are in one class form a group. Groups with members of several classes are gone through
   again. A group of up to ``SMALL`` members is compared by one task, all pairs at once. Larger ones are spread, in rounds,
   by what most members have in common: a pair of different classes can only be a link if it shares a shingle that few
   others of its group have, or lacks the same of the common ones. Members whose rare shingles aren't rare enough wait for
   the next round, for a family of their own. The rounds end when no member waits; in the last of ``ROUNDS`` none does. So
   both ways find the same links, and none is lost, whatever a group's size. Near copies of one text cost a
   pair for each document and hub, and the few pairs whose edits coincide. Groups in which many texts differ from what
   is common to them in just the same places, a little too much to be links, cost pairs beyond that.

The exact check compares the whole multisets of shingles, as 64-bit hashes.

Defined results: null and empty texts and texts of marks alone have no shingles and are classes of their own, a row
each; repeated rows and exact copies share a class; a class is named by its least doc_id, so the classes of two texts of
one doc_id may have one name; rows without doc_id are left
as they are, each with class null; a text of any length counts with all its shingles; ties between hubs go to the lesser
hash; other columns, whatever their names, are ignored; an empty table gives an empty table.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mnesis.llm.common import mix, settled, slices, word_codes
from mnesis.llm.toxicity import MARKS

WORDS, SIMILARITY = 5, 0.8
BANDS, ROWS = 40, 8
#: The pairs of one document that a task checks; how many members of a group may have a shingle that finds pairs; rounds.
PER_TASK, POPULAR, ROUNDS = 1024, 32, 8
#: Groups of so many members, with so many shingles each on average, are one task's; larger ones are spread over all.
SMALL, SHINGLES = 1024, 2048
EPS = 1e-6
#: How many darts a cell of area 1 gets: the chances of a Poisson variable of mean 1 to be at most 0, 1, 2, ...
POISSON = np.cumsum(np.exp(-1.0) / np.cumprod([1, *range(1, 16)]))
GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def shingles(texts: pa.Array, n: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Row and 64-bit hash of every shingle of every text; the texts' order is kept."""
    codes, words, offsets = word_codes(texts)
    plain = MARKS.sub("", "\n".join(words).lower()).split("\n") if words else []
    known = np.fromiter((zlib.crc32(w.encode()) | zlib.crc32(w.encode(), 1) << 32 if w else 0 for w in plain), np.uint64, len(plain))
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    word = known[codes] if len(words) else np.zeros(0, np.uint64)
    row, word = row[word != 0], mix(word[word != 0])
    count = np.bincount(row, minlength=len(offsets) - 1)
    first = np.cumsum(count) - count
    width = np.minimum(count, n)[row]  # of the shingles of each word's text
    starts = np.flatnonzero(np.arange(len(row)) - first[row] <= count[row] - width)
    out = np.zeros(len(starts), np.uint64)
    with np.errstate(over="ignore"):
        for k in range(n):
            live = width[starts] > k
            out[live] = mix(out[live] * GOLDEN + word[starts[live] + k])
    return row[starts], out


def units(row: np.ndarray, element: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each element's occurrences made different: the m-th of an element in a row is the m-th unit of its weight."""
    order = np.lexsort((element, row))
    row, element = row[order], element[order]
    place = np.arange(len(row))
    new = np.append(True, (row[1:] != row[:-1]) | (element[1:] != element[:-1]))[: len(row)]
    nth = place - np.maximum.accumulate(np.where(new, place, 0))
    with np.errstate(over="ignore"):
        return row, mix(element + GOLDEN * nth.astype(np.uint64))


def signatures(row: np.ndarray, unit: np.ndarray, rows: int, k: int, part: np.ndarray | None = None) -> np.ndarray:
    """The earliest rank of each coordinate, a row of k for each text; infinite where a text has no units. part: how
    much of each unit there is, 1 by default."""
    best = np.full(rows * k, np.inf)
    size = np.bincount(row, minlength=rows)
    ready = np.where(size > 0, np.ceil((k * np.log(k) + 2 * k) / np.maximum(size, 1)), 0).astype(np.int64)
    begun = np.zeros(rows, np.int64)
    while len(row):
        span = (ready - begun)[row]
        owner = np.repeat(np.arange(len(row)), span)
        rank = (np.arange(len(owner)) - np.repeat(np.cumsum(span) - span, span)) + begun[row[owner]]
        with np.errstate(over="ignore"):
            cell = mix(unit[owner] ^ mix(rank.astype(np.uint64) * GOLDEN + np.uint64(1)))
            darts = np.searchsorted(POISSON, (cell >> np.uint64(11)) * 2.0**-53, "right")
            which = np.repeat(np.arange(len(owner)), darts)
            nth = np.arange(len(which)) - np.repeat(np.cumsum(darts) - darts, darts)
            dart = mix(cell[which] + GOLDEN * (nth.astype(np.uint64) + np.uint64(1)))
            time = rank[which] + (dart >> np.uint64(11)) * 2.0**-53
            aim = mix(dart + np.uint64(7))
        at = row[owner[which]] * k + ((aim >> np.uint64(32)) % np.uint64(k)).astype(np.int64)
        if part is not None:
            inside = (mix(aim) >> np.uint64(11)) * 2.0**-53 < part[owner[which]]
            at, time = at[inside], time[inside]
        np.minimum.at(best, at, time)
        # a coordinate is final once a dart has fallen: every later dart has a later rank
        open_rows = np.isinf(best.reshape(rows, k)).any(axis=1) & (size > 0)
        again = open_rows[row]
        row, unit, part = row[again], unit[again], None if part is None else part[again]
        begun, ready = ready, np.where(open_rows, 2 * ready, ready)
    return best.reshape(rows, k)


def band_keys(signature: np.ndarray, bands: int, rows: int) -> np.ndarray:
    value = signature.view(np.uint64).reshape(len(signature), bands, rows)
    key = np.zeros((len(signature), bands), np.uint64)
    with np.errstate(over="ignore"):
        for r in range(rows):
            key = mix(key * GOLDEN + value[:, :, r])
    return key


def whole_sets(row: np.ndarray, unit: np.ndarray, rows: int) -> np.ndarray:
    """A hash of each text's whole multiset of shingles."""
    whole = np.zeros(rows, np.uint64)
    with np.errstate(over="ignore"):
        np.add.at(whole, row, mix(unit + np.uint64(3)))
    return whole.view(np.int64)


def text_hash() -> Column:
    """What tells the texts of one doc_id apart."""
    return F.xxhash64("text").alias("text_hash")


def signed(docs: DataFrame, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """doc_id, text_hash, set (a hash of the whole multiset; null without shingles), bands."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, limit=1 << 20):
            row, unit = units(*shingles(b.column("text")))
            size = np.bincount(row, minlength=b.num_rows)
            keys = band_keys(signatures(row, unit, b.num_rows, bands * rows), bands, rows).view(np.int64)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, keys.size + 1, bands, dtype=np.int32)), pa.array(keys.reshape(-1)))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("text_hash"), pa.array(whole_sets(row, unit, b.num_rows), mask=size == 0), lists], ["doc_id", "text_hash", "set", "bands"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_hash(), "text").mapInArrow(sign, "doc_id long, text_hash long, `set` long, bands array<long>")


def with_units(docs: DataFrame) -> DataFrame:
    """set (the hash of the whole multiset), units: the multiset of shingles as an array without repeats."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            row, unit = units(*shingles(b.column("text")))
            ends = np.searchsorted(row, np.arange(b.num_rows + 1)).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(whole_sets(row, unit, b.num_rows)), pa.ListArray.from_arrays(pa.array(ends), pa.array(unit.view(np.int64)))], ["set", "units"])

    return docs.select("text").mapInArrow(make, "`set` long, units array<long>")


def compared(pairs: DataFrame, contents: DataFrame, least: float) -> DataFrame:
    """The pairs (a, b) whose multisets have a weighted Jaccard similarity of at least ``least``. The pairs of an a are dealt
    to as many tasks as their number asks for, and a's shingles to each of them."""
    salts = F.ceil(F.col("n") / PER_TASK).cast("int")
    many = pairs.groupBy("a").agg(F.count("*").alias("n"))
    left = contents.select(F.col("set").alias("a"), F.col("units").alias("a_units")).join(many, "a").withColumn("salt", F.explode(F.sequence(F.lit(0), salts - 1))).drop("n")
    right = contents.select(F.col("set").alias("b"), F.col("units").alias("b_units"))
    dealt = pairs.join(many, "a").withColumn("salt", F.pmod(F.xxhash64("b"), salts).cast("int")).drop("n")

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = batch.column("a_units"), batch.column("b_units")
            xo, xv, yo, yv = x.offsets.to_numpy(), x.values.to_numpy(), y.offsets.to_numpy(), y.values.to_numpy()
            linked = np.zeros(batch.num_rows, bool)
            for i in range(batch.num_rows):
                u, v = xv[xo[i] : xo[i + 1]], yv[yo[i] : yo[i + 1]]
                if min(len(u), len(v)) >= least * max(len(u), len(v)):
                    both = np.sort(np.concatenate((u, v)))
                    common = int((both[1:] == both[:-1]).sum())
                    linked[i] = common > 0 and common >= least * (len(u) + len(v) - common)
            yield pa.RecordBatch.from_arrays([batch.column(c).filter(pa.array(linked)) for c in ("a", "b")], ["a", "b"])

    rows = dealt.join(right, "b").join(left, ["a", "salt"]).select("a", "b", "a_units", "b_units")
    return rows.mapInArrow(check, "a long, b long")


def with_classes(rows: DataFrame, names: DataFrame) -> DataFrame:
    """rows (g, b, ...) of groups with members of several classes, with each member's class as comp."""
    rows = rows.join(names.select(F.col("doc_id").alias("b"), "comp"), "b", "left").withColumn("comp", F.coalesce("comp", "b"))
    several = rows.groupBy("g").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo <> hi").select("g")
    return rows.join(several, "g")


def common_shingles(row: np.ndarray, unit: np.ndarray, n: int, rare: int = 8, width: int = 2048) -> np.ndarray:
    """How many shingles each two of n members share: those that more than ``rare`` members have by products of matrices of
    ``width`` columns, the others by their pairs."""
    _, code, count = np.unique(unit, return_inverse=True, return_counts=True)
    code, common = code.reshape(-1), np.zeros((n, n), np.int32)
    order = np.flatnonzero((count[code] > 1) & (count[code] <= rare))
    order = order[np.lexsort((row[order], code[order]))]
    for d in range(1, rare):
        same = code[order[d:]] == code[order[:-d]]
        np.add.at(common, (row[order[:-d]][same], row[order[d:]][same]), 1)
    common += common.T
    place = np.cumsum(count > rare) - 1
    often = np.flatnonzero(count[code] > rare)
    often = often[np.argsort(place[code[often]], kind="stable")]
    cuts = np.searchsorted(place[code[often]], np.arange(0, len(count) + width, width))
    for k, (lo, hi) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
        if lo < hi:
            block = np.zeros((n, width), np.float32)
            block[row[often[lo:hi]], place[code[often[lo:hi]]] - k * width] = 1
            common += (block @ block.T).astype(np.int32)
    return common


def links_of_small_groups(rows: DataFrame, contents: DataFrame, least: float) -> DataFrame:
    """(a, b): for each two classes of a group with links between them one such link. Each group is a task's."""

    def links(own: pa.Table) -> pa.Table:
        own = own.sort_by("b")
        lists, name, comp = own.column("units").combine_chunks(), own.column("b").to_numpy(), own.column("comp").to_numpy()
        size = np.diff(lists.offsets.to_numpy()).astype(np.int64)
        common = common_shingles(np.repeat(np.arange(len(size)), size), lists.flatten().to_numpy(), len(size))
        linked = (common > 0) & (common >= least * (size[:, None] + size[None, :] - common)) & (comp[:, None] < comp[None, :])
        i, j = np.nonzero(linked)
        _, first = np.unique(np.stack((comp[i], comp[j])), axis=1, return_index=True)
        i, j = i[first], j[first]
        return pa.table({"a": pa.array(np.minimum(name[i], name[j])), "b": pa.array(np.maximum(name[i], name[j]))})

    with_units = rows.select("g", "b", "comp").join(contents.select(F.col("set").alias("b"), "units"), "b")
    return with_units.groupBy("g").applyInArrow(links, "a long, b long").distinct()


def deltas(rows: DataFrame, contents: DataFrame, least: float) -> tuple[DataFrame, DataFrame]:
    """Members of groups by how they differ from the core of their group, which is what most members (of those with all its
    ``focus`` shingles) have in common: g, b, focus, size, p (the core's size), o (shingles outside the core), m (those of
    the core that are missing, rarest first), c (how many of the core it has), f (c - t * size for t = s / (1 + s)), inside, n_g (how many members the group has).
    Also (g, u, n_u): in how many members a shingle is, where in several."""
    t = least / (1 + least)
    m = settled(rows.select("g", "b", "focus").join(contents.select(F.col("set").alias("b"), "units"), "b"), "group")
    counts = settled(m.select("g", F.explode("units").alias("u")).groupBy("g", "u").agg(F.count("*").alias("n_u")).where("n_u > 1"), "counts")
    m = m.withColumn("inside", F.forall("focus", lambda x: F.array_contains("units", x)))
    narrow = m.where(F.col("inside") & (F.size("focus") > 0)).select("g", F.explode("units").alias("u")).groupBy("g", "u").agg(F.count("*").alias("n_u"))
    wide = counts.join(m.where(F.size("focus") == 0).select("g").distinct(), "g")
    most = wide.unionByName(narrow).join(m.where("inside").groupBy("g").agg(F.count("*").alias("n")), "g").where(2 * F.col("n_u") > F.col("n"))
    core = most.groupBy("g").agg(F.transform(F.sort_array(F.collect_list(F.struct((-F.col("n_u")).alias("k"), "u"))), lambda x: x.u).alias("core"))
    members = m.groupBy("g").agg(F.count("*").alias("n_g"))
    d = m.join(members, "g").join(core, "g", "left").withColumn("core", F.coalesce("core", F.array().cast("array<long>")))
    d = d.select("g", "b", "focus", "inside", F.size("units").alias("size"), "n_g", F.size("core").alias("p"), F.array_except("units", "core").alias("o"), F.array_except("core", "units").alias("m"))
    return settled(d.withColumn("c", F.col("p") - F.size("m")).withColumn("f", F.col("c") - t * F.col("size")), "deltas"), counts


def outside_core(d: DataFrame, counts: DataFrame, least: float) -> tuple[DataFrame, DataFrame]:
    """(g, b, comp, u, n_u) for the shingles outside the core that several members have, and for each member the list look
    of those, rarest first, under which it has to look for partners: a link shares at least s |x| shingles, of which at most
    c are in the core, so that it must share one of all but that number less one."""
    shared = settled(d.select("g", "b", "comp", "f", "n_g", F.explode("o").alias("u")).join(counts, ["g", "u"]), "shared")
    needed = F.greatest(F.lit(1), F.ceil(least * F.col("size") - F.col("c") - EPS)).cast("int")
    lists = shared.groupBy("g", "b").agg(F.sort_array(F.collect_list(F.struct("n_u", "u"))).alias("list"))
    look = F.slice("list", F.lit(1), F.greatest(F.lit(0), F.size("list") - needed + 1))
    return shared, d.select("g", "b", "comp", "focus", "size", "c", "inside", "n_g").join(lists, ["g", "b"]).withColumn("look", look).drop("list")


def inside_core(d: DataFrame, least: float) -> tuple[DataFrame, DataFrame]:
    """Seekers and partners of links that share nothing outside the core: (g, step, u, y, yc, ny, fy) and (g, step, u, x, xc, nx, fx).

    Such a link needs |M_x n M_y| >= p - f_x - f_y, and t |x| <= f_y, t |y| <= f_x. Where f_x + f_y reaches p, that of y and
    the member z with the highest f does too, so all such members are linked with z. Any other y seeks under its rarest
    shingles of M_y, all but the least number that a partner must share less one, among the members of a size (in steps of
    2 in 100) that admits a link."""
    t = least / (1 + least)
    top = d.where("p > 0").groupBy("g").agg(F.max("f").alias("top"))
    step = F.floor(F.log("size") / float(np.log(1.02))).cast("int")
    may = d.join(top, "g").where(F.col("c") >= least * F.col("size") - EPS).withColumn("step", step)  # c < s |x| admits no partner
    bins = may.groupBy("g", "step").agg(F.min("size").alias("least_size"), F.max("f").alias("most_f"))
    open_ones = may.where(F.col("f") + F.col("top") < F.col("p") - EPS).drop("step").join(bins, "g")
    seekers = open_ones.where((t * F.col("least_size") <= F.col("f") + EPS) & (t * F.col("size") <= F.col("most_f") + EPS))
    shares = F.greatest(F.lit(1), F.ceil(F.col("p") - F.col("f") - F.col("most_f") - EPS)).cast("int")
    under = F.slice("m", F.lit(1), F.greatest(F.lit(0), F.size("m") - shares + 1))
    seek = seekers.select("g", "step", F.col("b").alias("y"), F.col("comp").alias("yc"), F.col("size").alias("ny"), F.col("f").alias("fy"), F.explode(under).alias("u"))
    lack = may.select("g", "step", F.col("b").alias("x"), F.col("comp").alias("xc"), F.col("size").alias("nx"), F.col("f").alias("fx"), F.explode("m").alias("u"))
    return seek, lack


def as_pairs(found: DataFrame) -> DataFrame:
    return found.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()


def stars(d: DataFrame, counts: DataFrame, least: float) -> DataFrame:
    """(a, b): each member with the member z of the highest f, if that must be a link; and with the member of the highest f
    among those that have (or lack) one of the shingles under which it looks for partners. As many pairs as such shingles."""
    best = lambda x, n: F.max_by(F.struct(F.col(x).alias("x"), F.col(n).alias("xc")), F.struct("f", x)).alias("best")
    z = d.where("p > 0").groupBy("g").agg(best("b", "comp"), F.max("f").alias("top"))
    sure = d.join(z, "g").where((F.col("f") + F.col("top") >= F.col("p") - EPS) & (F.col("comp") != F.col("best.xc"))).select("best.x", F.col("b").alias("y"))
    shared, looks = outside_core(d, counts, least)
    have = shared.groupBy("g", "u").agg(best("b", "comp"))
    found = looks.select("g", "b", "comp", F.explode("look.u").alias("u")).join(have, ["g", "u"]).where(F.col("comp") != F.col("best.xc")).select("best.x", F.col("b").alias("y"))
    seek, lack = inside_core(d, least)
    without = lack.withColumnRenamed("fx", "f").groupBy("g", "step", "u").agg(best("x", "xc"))
    missing = seek.join(without, ["g", "step", "u"]).where(F.col("yc") != F.col("best.xc")).select("best.x", "y")
    return as_pairs(sure.union(found).union(missing))


def all_left(d: DataFrame, counts: DataFrame, least: float, popular: int, last: bool) -> tuple[DataFrame, DataFrame]:
    """(a, b): every pair of members of different classes that may be a link and isn't one of a star, if one of them is
    settled in this round; and (g, b, focus) for the members that aren't. In groups of over 8 * ``popular`` members, those are
    the members that would look for partners under a shingle that more than ``popular`` members have; they wait for a round
    in which it is part of the core. In smaller groups a member has no more than 8 * popular partners. With last, none
    waits."""
    shared, looks = outside_core(d, counts, least)
    large = F.col("n_g") > 8 * popular
    waits = F.lit(False) if last else large & F.exists("look", lambda x: x.n_u > popular)
    looks = settled(looks.withColumn("waits", waits), "looks")
    y = looks.where("not waits").select("g", F.col("b").alias("y"), F.col("comp").alias("yc"), F.explode("look.u").alias("u"))
    x = shared.where(F.lit(True) if last else ~large | (F.col("n_u") <= popular)).select("g", "u", F.col("b").alias("x"), F.col("comp").alias("xc"))
    found = x.join(y, ["g", "u"]).where("xc <> yc").select("x", "y")
    seek, lack = inside_core(d, least)
    t = least / (1 + least)
    fits = (F.col("xc") != F.col("yc")) & (t * F.col("nx") <= F.col("fy") + EPS) & (t * F.col("ny") <= F.col("fx") + EPS)
    missing = lack.join(seek, ["g", "step", "u"]).where(fits).select("x", "y")
    # a group that hardly shrinks is seen next time from those members that have its most frequent shingle outside the core, too
    left = looks.where("waits").select("g", "b", "focus", "inside")
    kept = left.groupBy("g").agg(F.count("*").alias("kept")).join(d.groupBy("g").agg(F.count("*").alias("of")), "g").where("4 * kept > 3 * of")
    slow = left.where("inside").join(kept, "g").select("g", "b")
    often = shared.join(slow, ["g", "b"]).groupBy("g", "u").agg(F.count("*").alias("k")).groupBy("g").agg(F.max_by("u", F.struct("k", "u")).alias("next"))
    ahead = F.when(F.col("next").isNotNull(), F.concat("focus", F.array("next"))).otherwise(F.array().cast("array<long>"))
    return as_pairs(found.union(missing)), left.join(often, "g", "left").select("g", "b", ahead.alias("focus"))


def within_groups(groups: DataFrame, contents: DataFrame, names: DataFrame, least: float, small: int = SMALL, popular: int = POPULAR, rounds: int = ROUNDS) -> DataFrame:
    """names, the classes by the links that were found before, once the ends of every link within a group (g, b) are in one
    class."""

    def after(links: DataFrame) -> None:
        nonlocal names
        links = settled(links, "links")
        if not links.isEmpty():
            names = merged(names, links)

    groups = groups.withColumn("focus", F.array().cast("array<long>"))
    for k in range(rounds):
        rows = settled(with_classes(groups, names), "open")
        weights = rows.join(contents.select(F.col("set").alias("b"), F.size("units").alias("size")), "b").groupBy("g").agg(F.count("*").alias("n_g"), F.sum("size").alias("n_u"))
        is_small = (F.col("n_g") <= small) & (F.col("n_u") <= small * SHINGLES)
        dealt = settled(rows.join(weights, "g"), "dealt")
        if dealt.isEmpty():
            break
        after(links_of_small_groups(dealt.where(is_small), contents, least))
        large = dealt.where(~is_small).select("g", "b", "focus")
        if large.isEmpty():
            break
        d, counts = deltas(large, contents, least)
        after(compared(settled(stars(with_classes(d, names), counts, least), "pairs"), contents, least))
        d = settled(with_classes(d, names), "still-open")
        pairs, left = all_left(d, counts, least, popular, k == rounds - 1)
        groups = settled(left, "left")
        after(compared(settled(pairs, "pairs"), contents, least))
    return names


def components(links: DataFrame, least_rounds: int = 1) -> DataFrame:
    """(doc_id, comp) for every document in a link: comp is the least doc_id that it is linked with, over any number of
    links. Each round hands every document the least name among its neighbours', then the name of its name, so the
    number of rounds grows with the logarithm of the longest chain."""
    edges = settled(links.select("a", "b").union(links.select(F.col("b"), F.col("a"))).distinct(), "edges")
    names = settled(edges.groupBy(F.col("a").alias("doc_id")).agg(F.least(F.col("doc_id"), F.min("b")).alias("comp")), "names")
    while True:
        near = edges.join(names.select(F.col("doc_id").alias("b"), "comp"), "b").groupBy(F.col("a").alias("doc_id")).agg(F.min("comp").alias("near"))
        lower = names.join(near, "doc_id").select("doc_id", F.col("comp").alias("old"), F.least("comp", "near").alias("comp"))
        jumps = names.select(F.col("doc_id").alias("comp"), F.col("comp").alias("jump"))
        new = settled(lower.join(jumps, "comp").select("doc_id", "old", F.least("comp", "jump").alias("comp")), "names")
        changed = not new.where(F.col("old") != F.col("comp")).isEmpty()
        names = new.select("doc_id", "comp")
        if not changed:
            return names


def merged(names: DataFrame, links: DataFrame) -> DataFrame:
    """names after further links: their components are found among the classes that they touch."""
    comp = lambda c: names.select(F.col("doc_id").alias(c), F.col("comp").alias(f"{c}_comp"))
    ends = links.join(comp("a"), "a", "left").join(comp("b"), "b", "left").select(F.coalesce("a_comp", "a").alias("a"), F.coalesce("b_comp", "b").alias("b"))
    renamed = components(ends.where("a <> b")).select(F.col("doc_id").alias("comp"), F.col("comp").alias("new"))
    single = links.select(F.col("a").alias("doc_id")).union(links.select("b")).distinct().join(names, "doc_id", "left_anti").select("doc_id", F.col("doc_id").alias("comp"))
    return settled(names.unionByName(single).join(renamed, "comp", "left").select("doc_id", F.coalesce("new", "comp").alias("comp")), "names")


def rows_with_classes(docs: DataFrame, least: float = SIMILARITY, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """(doc_id, text_hash, comp, class_id) for every row of docs. comp tells classes apart that have the same least doc_id;
    it is null for texts without shingles and rows without doc_id. Links and components are those of sets: what they call
    doc_id is a set."""
    signs = settled(signed(docs, bands, rows), "signs")
    usable = signs.where(F.col("set").isNotNull() & F.col("doc_id").isNotNull())
    stands = settled(usable.groupBy("set").agg(F.min("doc_id").alias("doc_id"), F.min_by("bands", "doc_id").alias("bands")), "stands")
    spread = stands.select("set", F.posexplode("bands").alias("band", "key"))
    buckets = spread.groupBy("band", "key").agg(F.count("*").alias("n"), F.min("set").alias("first")).where("n > 1")
    members = settled(spread.join(buckets, ["band", "key"]).groupBy(F.col("first").alias("a"), F.col("set").alias("b")).agg(F.max("n").alias("n")), "members")
    involved = members.select(F.col("b").alias("set")).distinct()
    # a doc_id of several texts brings all of them; only the sets that are asked for stay
    texts = docs.join(stands.join(involved, "set", "left_semi").select("doc_id").distinct(), "doc_id").select("text")
    contents = settled(with_units(texts).join(involved, "set", "left_semi").dropDuplicates(["set"]), "contents")
    names = components(settled(compared(members.where("a <> b").select("a", "b"), contents, least), "links"))
    # a hub's pairs have been checked, so it is no member of its own buckets' group
    rest = members.where("n > 2 AND a <> b").join(names.withColumnRenamed("doc_id", "b"), "b", "left").select("a", "b", F.coalesce("comp", "b").alias("comp"))
    label = rest.groupBy("a", "comp").agg(F.count("*").alias("k")).groupBy("a").agg(F.max_by("comp", F.struct("k", "comp")).alias("g"))
    groups = rest.join(label, "a").select("g", "b").distinct()
    names = within_groups(groups, contents, names, least).withColumnRenamed("doc_id", "set")
    linked = names.join(stands.select("set", "doc_id"), "set").groupBy("comp").agg(F.min("doc_id").alias("least"))
    named = names.join(linked, "comp").select("set", "comp", "least")
    sets = stands.select("set", "doc_id").join(named, "set", "left").select("set", F.coalesce("comp", "set").alias("comp"), F.coalesce("least", "doc_id").alias("class_id"))
    found = usable.join(sets, "set").select("doc_id", "text_hash", "comp", "class_id")
    alone = signs.where(F.col("set").isNull() | F.col("doc_id").isNull())
    return found.union(alone.select("doc_id", "text_hash", F.lit(None).cast("long").alias("comp"), F.col("doc_id").alias("class_id")))


def classes(docs: DataFrame, least: float = SIMILARITY, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """(doc_id, class_id) for every row of docs."""
    return rows_with_classes(docs, least, bands, rows).select("doc_id", "class_id")
