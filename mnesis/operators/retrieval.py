"""Baseline periods of recall: matched deliberation, and the older search for free epochs.

Preparing events, and finding each trial's free intervals, are plans over all sessions. What is left, choosing a free
interval for each recall so that none is used twice, goes step by step; it runs for each session by itself, over a few
hundred recalls and intervals.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Callable, Iterator
from operator import itemgetter

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from mnesis.operators import masks, sequence


def by_session(df: DataFrame, keys: list[str], order: list[str], fn: Callable[[list[tuple]], list[tuple]], schema: str, rows: int = 10_000) -> DataFrame:
    """fn(rows) of each session, its rows being tuples of df's other columns in ``order``: keys and the columns of schema.

    Sessions are small and many, so a task walks through its sessions in their order and hands results on in batches of about
    ``rows``; a table for each session would cost more than what is done with it."""
    own = [c for c in df.columns if c not in keys]
    whole = StructType([*[df.schema[k] for k in keys], *StructType.fromDDL(schema)])

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds, key, held, out = to_arrow_schema(whole), None, [], []

        def shaped() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, k.type) for c, k in zip(zip(*out), kinds)], schema=kinds)

        for b in batches:
            columns = [c.to_pylist() for c in b.columns]
            for k, row in zip(zip(*columns[: len(keys)]), zip(*columns[len(keys) :])):
                if k != key:
                    out += [(*key, *x) for x in fn(held)] if held else []
                    key, held = k, []
                    if len(out) >= rows:
                        yield shaped()
                        out.clear()
                held.append(row)
        out += [(*key, *x) for x in fn(held)] if held else []
        if out:
            yield shaped()

    return df.select(*keys, *own).repartition(*keys).sortWithinPartitions(*keys, *order).mapInArrow(walk, whole)


def with_recall_starts(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Trials without a REC_START get one at their first recall's mstime - rectime."""
    trial = [*keys, "list"]
    has = df.where(masks.kind("REC_START")).select(*trial).distinct()
    first = df.where(masks.kind("REC_WORD")).withColumn("_n", F.row_number().over(sequence.window(trial, order))).where("_n = 1").drop("_n")
    made = first.join(has, trial, "left_anti").withColumns({"mstime": F.col("mstime") - F.col("rectime"), "type": F.lit("REC_START"), "rectime": F.lit(-999).cast("long")})
    return df.unionByName(made.select(*df.columns))


def with_recall_ends(df: DataFrame, keys: list[str], period: int = 45_000) -> DataFrame:
    """Trials without a REC_END get one ``period`` milliseconds after their REC_START."""
    trial = [*keys, "list"]
    has = df.where(masks.kind("REC_END")).select(*trial).distinct()
    made = df.where(masks.kind("REC_START")).join(has, trial, "left_anti").withColumns({"mstime": F.col("mstime") + period, "type": F.lit("REC_END")})
    return df.unionByName(made.select(*df.columns))


def sample_rate(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Samples a second, from the fourth and fifth recall of each group."""
    recalls = df.where(masks.kind("REC_WORD")).withColumn("_n", F.row_number().over(sequence.window(keys, order))).where("_n IN (4, 5)")
    span = lambda c: F.max(c) - F.min(c)
    return recalls.groupBy(*keys).agg(F.round(F.try_divide(span("eegoffset") * 1000.0, span("mstime"))).alias("samplerate"))


def included_recalls(df: DataFrame, keys: list[str], order: list[str], before: int = 2000, after: int = 1000) -> DataFrame:
    """Recalls without intrusion that have enough free time on both sides."""
    rows = sequence.time_between(df, keys, order)
    return rows.where(masks.kind("REC_WORD") & (F.col("intrusion") == 0) & (F.col("time_before") > before) & (F.col("time_after") > after)).drop("time_before", "time_after")


class FreeTime:
    """Free intervals of each trial, in milliseconds from the start of recall."""

    def __init__(self, rows: list[tuple[int, int, int]], trials: list[int]):
        self.spans: dict[int, list[tuple[int, int]]] = {t: [] for t in trials}
        for trial, begin, end in sorted(rows):
            self.spans.setdefault(trial, []).append((begin, end))

    def holds(self, trial: int, start: int, stop: int) -> bool:
        for b, e in self.spans[trial]:  # in order
            if b > start:
                return False
            if stop <= e:
                return True
        return False

    def take(self, trial: int, start: int, stop: int) -> None:
        left = []
        for b, e in self.spans[trial]:
            left += [x for x in ((b, min(e, start)), (max(b, stop), e)) if x[0] < x[1]]
        self.spans[trial] = left

    def first_within(self, trial: int, low: int, high: int, length: int) -> int | None:
        """The first start of a free stretch of ``length`` inside [low, high)."""
        for b, e in self.spans[trial]:  # in order
            if b + length > high:
                return None
            if min(e, high) - max(b, low) >= length:
                return max(b, low)
        return None


def match_session(recalls: list[tuple[int, int]], free: FreeTime, trials: list[int], before: int, after: int, tolerance: int, period: int) -> list[tuple[int, int, int, int] | None]:
    """For each (trial, rectime) a (trial, start, stop, exact) of equal length that was free, or None. Recalls with fewer exact
    choices go first; an exact choice is the same time in the nearest trial. Then those without one take a tolerated time.

    Two peculiarities are kept: the tolerated start is the earliest one of any trial, whichever trial is chosen, and what is
    taken is the row that stands, in the list of all tolerated starts, at the chosen trial's number."""
    windows = [(t - before, t + after) for _, t in recalls]
    exact = [[tr for tr in trials if a >= 0 and b <= period and free.holds(tr, a, b)] for a, b in windows]
    order = sorted(range(len(recalls)), key=lambda i: (len(exact[i]), i))
    found: list[tuple[int, int, int, int] | None] = [None] * len(recalls)
    for i in order:
        a, b = windows[i]
        choices = [tr for tr in trials if a >= 0 and b <= period and free.holds(tr, a, b)]
        if choices:
            own = min(choices, key=lambda tr: (abs(tr - recalls[i][0]), tr))
            found[i] = (own, a, b, 1)
            free.take(own, a, b)
    length = before + after
    for i in order:
        if found[i] is not None:
            continue
        a, _ = windows[i]
        low, high = max(0, a - tolerance), min(period, a + tolerance + before)
        first = {tr: free.first_within(tr, low, high, length) for tr in trials}
        choices = [tr for tr in trials if first[tr] is not None]
        if not choices:
            continue
        rank = min(range(len(choices)), key=lambda k: (abs(choices[k] - recalls[i][0]), k))
        start = first[choices[0]]
        found[i] = (choices[rank], start, start + length, 0)
        free.take(trial_of_start(free, choices, rank, low, high, length), start, start + length)
    return found


def trial_of_start(free: FreeTime, trials: list[int], k: int, low: int, high: int, length: int) -> int:
    """The trial that the k-th start belongs to, when the starts of all trials stand in a row: their intervals are counted."""
    for trial in trials:
        n = sum(max(0, min(e, high) - length + 1 - max(b, low)) for b, e in free.spans[trial])
        if k < n:
            return trial
        k -= n
    raise IndexError(k)


def matched_deliberation(df: DataFrame, keys: list[str], order: list[str], period: int = 30_000, inclusion_before: int = 2000, inclusion_after: int = 1000, start: int = -1250, end: int = 250, tolerance: int = 3000, remove_before: int = 2000, remove_after: int = 2000) -> DataFrame:
    """(keys, list, mstime, rectime, type, matched_list, matched_rectime, exact): each included recall that found a match, as
    REC_WORD, and its baseline period as REC_BASE. Prepares events, finds free time in Spark and matches by session."""
    rows = df.where("list >= 0")
    rows = with_recall_ends(with_recall_starts(rows, keys, order), keys, period)
    recalls = included_recalls(rows, keys, order, inclusion_before, inclusion_after).select(*keys, "list", "mstime", "rectime")
    free = sequence.vocalization_free(rows, [*keys, "list"], period, remove_before, remove_after)
    starts = rows.where(masks.kind("REC_START")).groupBy(*keys, "list").agg(F.min("mstime").alias("begun"))
    trials = rows.select(*keys, "list").distinct().join(starts, [*keys, "list"], "left")
    columns = ["list", "mstime", "rectime", "begin", "end", "begun"]
    empty = {c: F.lit(None).cast("long").alias(c) for c in columns}
    part = lambda t, kind, **own: t.select(*keys, F.lit(kind).alias("part"), *[F.col(own[c]).cast("long").alias(c) if c in own else empty[c] for c in columns])
    together = (
        part(recalls, 0, list="list", mstime="mstime", rectime="rectime").unionByName(part(free, 1, list="list", begin="begin", end="end")).unionByName(part(trials, 2, list="list", begun="begun"))
    )

    def match(own: list[tuple]) -> list[tuple]:
        r = [x[1:4] for x in own if x[0] == 0]
        spans = [(x[1], *x[4:6]) for x in own if x[0] == 1]
        begun = {x[1]: x[6] for x in own if x[0] == 2}
        found = match_session([(lst, rec) for lst, _, rec in r], FreeTime(spans, list(begun)), list(begun), -start, end, tolerance, period)
        out = []
        for (lst, ms, rec), got in zip(r, found, strict=True):
            if got is not None:
                trial, a, _, exact = got
                at, base = a - start, begun.get(trial)
                out.append((lst, ms, rec, "REC_WORD", trial, at, exact))
                out.append((trial, base + at if base is not None else None, at, "REC_BASE", lst, rec, exact))
        return out

    return by_session(together, keys, ["part", "list", "mstime", "rectime"], match, "list long, mstime long, rectime long, type string, matched_list long, matched_rectime long, exact int")


def insert_baseline(df: DataFrame, keys: list[str], order: list[str], duration: int = 500, pre: int = 2000, post: int = 1000, inclusion: int = 1000, **settings) -> DataFrame:
    """df with a column ``matched`` and a REC_BASE row for each recall that found a matching period of failure to recall.

    A REC_BASE row is its recall's row in the matched list: type, list, rectime, mstime and eegoffset are those of the
    period, item_name is ``N/A``, recalled 0. matched is true for it and its recall, false for all other rows. The period ends
    where the recall begins; recalls with less than ``inclusion`` milliseconds to a neighbour find none."""
    found = matched_deliberation(df, keys, order, inclusion_before=inclusion, inclusion_after=inclusion, start=-duration, end=0, remove_before=pre, remove_after=post, **settings)
    recall = [*keys, "list", "mstime", "rectime"]
    pairs = found.where(masks.kind("REC_BASE")).select(*keys, F.col("matched_list").alias("list"), F.col("matched_rectime").alias("rectime"), F.col("list").alias("_list"), F.col("mstime").alias("_mstime"), F.col("rectime").alias("_rectime"))
    marked = found.where(masks.kind("REC_WORD")).select(*recall, F.lit(True).alias("_found")).distinct()
    rows = df.join(marked, recall, "left").withColumn("matched", F.col("_found").isNotNull() & masks.kind("REC_WORD")).drop("_found")
    begun = df.where(masks.kind("REC_START")).groupBy(*keys, F.col("list").alias("_list")).agg(F.min("eegoffset").alias("_offset"))
    rates = sample_rate(df, keys, order)
    base = df.where(masks.kind("REC_WORD")).join(pairs, [*keys, "list", "rectime"]).join(begun, [*keys, "_list"], "left").join(rates, keys, "left")
    values = {
        "type": F.lit("REC_BASE"), "list": F.col("_list"), "rectime": F.col("_rectime"), "mstime": F.col("_mstime"), "recalled": F.lit(0), "matched": F.lit(True), "item_name": F.lit("N/A"),
        "eegoffset": F.coalesce(F.col("_offset") + F.round(F.coalesce("samplerate", F.lit(1000.0)) * F.col("_rectime") / 1000), F.lit(-999)),
    }
    types = dict(rows.dtypes)
    made = base.select(*[(values.get(c, F.lit(True)) if c in values else F.col(c)).cast(types[c]).alias(c) for c in rows.columns])
    return rows.unionByName(made)


def free_epoch_baseline(df: DataFrame, keys: list[str], order: list[str], duration: int = 500, pre: int = 2000, post: int = 1000, reach: int = 3000) -> DataFrame:
    """The older search: each recall takes the first unused free epoch within ``reach`` milliseconds of its own time since the
    start of recall, in the nearest other list. Recalls take turns by mstime; of those at one time, the one nearest to an epoch
    is first. A session's recalls and the gaps between its voices meet in a task, not each recall with each epoch."""
    trial = [*keys, "list"]
    voice, recall = masks.vocalization() | masks.kind("REC_START", "REC_END"), masks.kind("REC_WORD") & (F.col("intrusion") == 0)
    flag = lambda mask: F.coalesce(mask, F.lit(False))
    rows = df.select(*trial, "mstime", "type", flag(voice).alias("_voice"), flag(recall).alias("_recall")).where("_voice OR _recall").na.drop(subset=trial).repartition(*keys)
    rows = rows.withColumn("_s", F.min(F.when(masks.kind("REC_START"), F.col("mstime"))).over(Window.partitionBy(*trial)))
    rows = rows.withColumn("_next", F.lead("mstime").over(sequence.window([*trial, "_voice"], ["mstime"])))
    at, first, last = F.col("mstime") - F.col("_s"), F.col("mstime") + post - F.col("_s"), F.col("_next") - pre - duration - F.col("_s")
    gap = flag(F.col("_voice") & (last > first))
    rows = rows.where(at.isNotNull()).select(*keys, *[c.cast("long").alias(n) for n, c in {"list": F.col("list"), "mstime": F.col("mstime"), "at": at, "first": F.when(gap, first), "last": last}.items()], "_recall").where("_recall OR first IS NOT NULL")

    def choose(own: list[tuple]) -> list[tuple]:
        gaps: dict[int, list[tuple[int, int, int]]] = {}
        for lst, ms, when, first, last, _ in own:
            if first is not None:
                gaps.setdefault(lst, []).append((first, last, ms - when))
        lists, used = sorted(gaps), set()
        recalls = {(ms, lst): when for lst, ms, when, _, _, is_recall in own if is_recall}
        turns = sorted(recalls)
        crowded = {a[0] for a, b in zip(turns, turns[1:]) if a[0] == b[0]}
        if crowded:
            none = (float("inf"),)
            turns.sort(key=lambda r: (r[0], (nearest_epoch(gaps, lists, r[1], recalls[r], duration, reach, ()) or none)[:3] if r[0] in crowded else (), r[1]))
        out = []
        for ms, lst in turns:
            if got := nearest_epoch(gaps, lists, lst, recalls[ms, lst], duration, reach, used):
                used.add((got[1], got[3]))
                out.append((lst, ms, got[1], got[3]))
        return out

    return by_session(rows, keys, ["list", "first"], choose, "list long, mstime long, base_list long, base_mstime long")


def nearest_epoch(gaps: dict[int, list[tuple[int, int, int]]], lists: list[int], own: int, at: int, duration: int, reach: int, used) -> tuple[int, int, int, int] | None:
    """(distance, list, time since the start of recall, mstime) of the first epoch within ``reach`` of ``at`` that isn't in
    ``used`` (pairs of list and mstime), in the nearest list but ``own``; of two equally near, the lesser. gaps: of each list
    in order, the first epoch's time, the time that all epochs begin before, and the mstime of the start of recall."""
    j = bisect_left(lists, own)
    i, j = j - 1, j + (j < len(lists) and lists[j] == own)
    while i >= 0 or j < len(lists):
        if j == len(lists) or i >= 0 and own - lists[i] <= lists[j] - own:
            lst, i = lists[i], i - 1
        else:
            lst, j = lists[j], j + 1
        for k in range(bisect_right(gaps[lst], at - reach, key=itemgetter(1)), len(gaps[lst])):  # those before end too early
            first, last, begun = gaps[lst][k]
            if first > at + reach:
                break
            late = at - reach - first
            for x in range(first + (-(-late // duration) * duration if late > 0 else 0), min(last, at + reach + 1), duration):
                if (lst, x + begun) not in used:
                    return abs(lst - own), lst, x, x + begun
    return None


def inherit_from_previous(rows: DataFrame, made: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """made rows with the columns of the last of rows before them, by an as-of window over both."""
    both = rows.select(*keys, "mstime", *columns, F.lit(0).alias("_new")).unionByName(made.select(*keys, "mstime", *[F.lit(None).alias(c) for c in columns], F.lit(1).alias("_new")))
    w = Window.partitionBy(*keys).orderBy("mstime", "_new").rowsBetween(Window.unboundedPreceding, 0)
    return both.withColumns({c: F.last(c, ignorenulls=True).over(w) for c in columns}).where("_new = 1").drop("_new")
