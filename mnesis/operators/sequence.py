"""Operators on the order of events within a session or list, as windows. keys: of a group. order: of its rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

from mnesis.operators import masks


def window(keys: list[str], order: list[str]) -> WindowSpec:
    return Window.partitionBy(*keys).orderBy(*order)


def time_between(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """time_before and time_after: milliseconds to the rows on either side, 0 at the ends."""
    w = window(keys, order)
    return df.withColumns({
        "time_before": F.coalesce(F.col("mstime") - F.lag("mstime").over(w), F.lit(0)),
        "time_after": F.coalesce(F.lead("mstime").over(w) - F.col("mstime"), F.lit(0)),
    })


def list_phase(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """list_phase: what the last ``X_START`` or ``TRIAL`` row began; words and recalls say it themselves."""
    kind = F.col("type")
    begun = F.when(kind.endswith("_START"), F.expr("left(type, length(type) - 6)")).when(kind.contains("TRIAL"), F.replace(kind, F.lit("TRIAL"), F.lit("ENCODING")))
    carried = F.coalesce(F.last(begun, ignorenulls=True).over(window(keys, order).rowsBetween(Window.unboundedPreceding, 0)), F.lit(""))
    own = F.when(kind.isin("WORD", "PRACTICE_WORD"), F.replace(kind, F.lit("WORD"), F.lit("ENCODING")))
    return df.withColumn("_carried", carried).withColumn("list_phase", F.when((F.col("_carried") == "REC") & own.isNull() | (kind == "REC_WORD"), "RETRIEVAL").otherwise(F.coalesce(own, "_carried"))).drop("_carried")


def stim_items(df: DataFrame, keys: list[str], order: list[str], params: str | None = None) -> DataFrame:
    """Word rows with is_stim_item (stimulation begins 1 row later, or 2 after WORD_OFF, or 3 after WORD_OFF and
    DISTRACT_START), is_post_stim_item (the word before was stimulated), and the first stimulation's parameters."""
    w = window(keys, order)
    following = [F.lead("type", k).over(w) for k in (1, 2, 3)]
    on = lambda c: F.coalesce(c == "STIM_ON", F.lit(False))
    off = F.coalesce(following[0] == "WORD_OFF", F.lit(False))
    rows = df.withColumns({
        "_1": on(following[0]), "_2": off & on(following[1]),
        "_3": off & F.coalesce(following[1] == "DISTRACT_START", F.lit(False)) & on(following[2]),
        **({f"_p{k}": F.lead(params, k).over(w) for k in (1, 2, 3)} if params else {}),
    })
    rows = rows.where(masks.encoding()).withColumn("is_stim_item", F.col("_1") | F.col("_2") | F.col("_3"))
    rows = rows.withColumn("is_post_stim_item", F.coalesce(F.lag("is_stim_item").over(w), F.lit(False)))
    if params:
        rows = rows.withColumn(params, F.when(F.col("_1"), F.col("_p1")).when(F.col("_2"), F.col("_p2")).when(F.col("_3"), F.col("_p3")))
    return rows.drop("_1", "_2", "_3", "_p1", "_p2", "_p3")


def fr2_correction(items: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """In FR2 and catFR2 a stimulation spans two words: the word after a stimulated one is stimulated and after
    stimulation, the one behind that is after stimulation, as long as they are on the list of 12."""
    w = window(keys, order)
    hit = F.col("experiment").isin("FR2", "catFR2") & F.col("is_stim_item")
    before = lambda k, most: F.coalesce(F.lag(hit & (F.col("serialpos") < most), k).over(w), F.lit(False))
    return items.withColumns({"_a": before(1, 12), "_b": before(2, 11)}).withColumns({
        "is_stim_item": F.col("is_stim_item") | F.col("_a"),
        "is_post_stim_item": F.col("is_post_stim_item") | F.col("_a") | F.col("_b"),
    }).drop("_a", "_b")


def free_periods(df: DataFrame, keys: list[str], time: str, duration: int, pre: int, post: int) -> DataFrame:
    """(keys, start) of epochs of ``duration`` in the gaps between rows, ``post`` after the one and ``pre`` before the other."""
    begin = F.col(time) + post
    finish = F.lead(time).over(window(keys, [time])) - pre
    gaps = df.select(*keys, begin.alias("_begin"), (finish - duration).alias("_last")).where(F.col("_last") > F.col("_begin"))
    return gaps.select(*keys, F.explode(F.sequence("_begin", F.col("_last") - 1, F.lit(duration).cast("long"))).alias("start"))


def response_times(recalls: DataFrame, keys: list[str], order: list[str], category: str = "category_num") -> DataFrame:
    """irt and within (same category as the recall before) for every recall of a list but the first."""
    w = window(keys, order)
    rows = recalls.withColumns({"irt": F.col("mstime") - F.lag("mstime").over(w), "within": F.col(category) == F.lag(category).over(w)})
    return rows.where(F.col("irt").isNotNull())


def repetition_ratio(recalls: DataFrame, keys: list[str], order: list[str], category: str = "category_num") -> DataFrame:
    """The share of a list's successive recalls that stay in a category; null for a single recall."""
    w = window(keys, order)
    same = recalls.withColumn("_same", (F.col(category) == F.lag(category).over(w)).cast("int"))
    return same.groupBy(*keys).agg(F.try_divide(F.sum("_same"), F.count("_same")).alias("ratio"))


def running_threshold(keys: list[str], order: list[str], value: str) -> Column:
    """The mean of all earlier values, null for the first."""
    return F.avg(value).over(window(keys, order).rowsBetween(Window.unboundedPreceding, -1))


def zscore(df: DataFrame, keys: list[str], value: str) -> Column:
    """The value in sample deviations from its group's mean; null where the deviation is 0."""
    w = Window.partitionBy(*keys)
    return (F.col(value) - F.avg(value).over(w)) / F.nullif(F.stddev_samp(value).over(w), F.lit(0.0))


def resting_epochs(df: DataFrame, samplerate: float = 1000.0) -> DataFrame:
    """COUNTDOWN_START rows become three rows 1, 4 and 7 seconds later; other rows stay."""
    shift = F.explode(F.array(F.lit(1000), F.lit(4000), F.lit(7000)))
    count = df.where(masks.kind("COUNTDOWN_START")).withColumn("_ms", shift)
    moved = count.withColumns({"mstime": F.col("mstime") + F.col("_ms"), "eegoffset": F.col("eegoffset") + (F.col("_ms") * samplerate / 1000).cast("long"), "type": F.lit("REST")}).drop("_ms")
    return df.where(~masks.kind("COUNTDOWN_START")).unionByName(moved)


def adjacent(df: DataFrame, keys: list[str], order: list[str], least_ms: int = 1500) -> DataFrame:
    """adjacent: of a run of L gaps under least_ms, the first L rows, and the last if L is odd; and a group's last row."""
    w = window(keys, order)
    gap = F.lead("mstime").over(w) - F.col("mstime")
    rows = df.withColumns({"_n": F.row_number().over(w), "_small": F.coalesce((gap < least_ms).cast("int"), F.lit(0)), "_end": gap.isNull()})
    rows = rows.withColumn("_before", F.coalesce(F.lag("_small").over(w), F.lit(0)))
    # a run's rows share the number of rows so far that begin a new run
    rows = rows.withColumn("_run", F.sum(F.when(F.col("_before") == 0, 1).otherwise(0)).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    run = Window.partitionBy(*keys, "_run")
    rows = rows.withColumns({"_gaps": F.sum("_small").over(run), "_place": F.col("_n") - F.min("_n").over(run)})
    mark = (F.col("_gaps") > 0) & ((F.col("_place") < F.col("_gaps")) | (F.col("_gaps") % 2 == 1)) | F.col("_end")
    return rows.withColumn("adjacent", mark).drop("_n", "_small", "_end", "_before", "_run", "_gaps", "_place")


def longest_flat_run(samples: Column) -> Column:
    """The longest run of equal neighbours in an array, as a number of zero differences."""
    start = F.struct(F.lit(None).cast("double").alias("prev"), F.lit(0).alias("run"), F.lit(0).alias("most"))

    def step(acc, x):
        run = F.when(acc["prev"] == x.cast("double"), acc["run"] + 1).otherwise(F.lit(0))
        return F.struct(x.cast("double").alias("prev"), run.alias("run"), F.greatest(acc["most"], run).alias("most"))

    return F.aggregate(samples, start, step, lambda acc: acc["most"])


def saturated(samples: Column, most: int = 9) -> Column:
    return longest_flat_run(samples) > most


def vocalization_free(df: DataFrame, keys: list[str], period: int, before: int, after: int) -> DataFrame:
    """(keys, begin, end) of what is left of a recall period of [0, period) milliseconds when [rectime - before, rectime +
    after) of every vocalisation is taken out. Groups without a recall period or a vocalisation have nothing left."""
    spans = df.where(masks.vocalization()).select(*keys, (F.col("rectime") - before).alias("lo"), (F.col("rectime") + after).alias("hi"))
    spans = spans.join(df.where(masks.kind("REC_START", "REC_END")).select(*keys).distinct(), keys, "left_semi").select(*keys, "lo", "hi")
    w = window(keys, ["lo", "hi"])
    reach = F.coalesce(F.max("hi").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    gaps = spans.select(*keys, F.greatest(reach, F.lit(0)).alias("begin"), F.least("lo", F.lit(period)).alias("end"))
    tail = spans.groupBy(*keys).agg(F.greatest(F.max("hi"), F.lit(0)).alias("begin")).withColumn("end", F.lit(period))
    return gaps.unionByName(tail).where("begin < end").select(*keys, F.col("begin").cast("long"), F.col("end").cast("long"))
