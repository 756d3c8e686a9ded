"""Report tables of all experiments in one plan: the log is scanned once, each row is routed to the products that its
experiment's report has, and all products are grouped together, by session, subject, experiment and over all.

Rows are dealt by recording. There they get what needs their neighbours (the first of a list, pauses between recalls) from
windows over one sort, each gives a fact to every product that it counts in: keys k1 and k2 as text, sums m1 to m8 and the
bounds low and high, and facts are added up by session, all without another shuffle. The sums are added up again by
``LEVELS``; measures are sums and bounds, so the higher levels follow from the sessions. A product's ratio is taken from
its sums at every level. The result is stored once, partitioned by product and level; ``save_all`` stores the sessions
where they are and takes the higher levels from what it stored.

What the measures of each product are: ``MEASURES``. Experiments without a known report, and rows that no product counts,
give nothing; ratios over nothing are null; an empty log gives an empty table.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mnesis.functions import tails
from mnesis.operators import behavior, masks
from mnesis.plans import reports

RECORDING = ["experiment", "subject", "session"]
#: A recording's keys in the order of its windows, whose sort is by numbers first.
DEALT = ["session", "experiment", "subject"]
#: The groups that facts are added up by, and their names.
LEVELS = {"session": RECORDING, "subject": ["experiment", "subject"], "experiment": ["experiment"], "all": []}
SUMS = [f"m{k}" for k in range(1, 9)]
#: The names of each product's measures in turn, and of its ratio: percentage of the second in the first unless RATIOS has another.
MEASURES = {
    "session_summary": ["num_words", "num_correct", "num_lists", "num_prior_list_intrusions", "num_extra_list_intrusions"],
    "serialpos": ["num_words", "num_correct"],
    "first_recall": ["num_first"],
    "math_summary": ["num_problems", "num_correct", "num_lists"],
    "repeats": ["num_words", "num_correct"],
    "category_times": ["n_within", "irt_within", "n_between", "irt_between"],
    "stim_counts": ["n_stims"],
    "stim_lists": ["num_stim_lists", "num_nonstim_lists"],
    "recalls_by_list": ["num_words", "num_correct", "n_stim_events"],
    "output_by_serialpos": ["num_words", "sum_output"],
    "recall_by_stim": ["num_words", "num_correct"],
    "delta_recall": ["num_words", "num_correct", "low_words", "low_correct", "stim_words", "stim_correct", "post_words", "post_correct"],
    "stim_targets": ["n_stims"],
    "locations": ["n", "sum_delta", "sum_delta_squared"],
}
BEHAVIOUR = ["session_summary", "serialpos", "first_recall", "math_summary", "category_times"]
STIMULATION = ["stim_lists", "recalls_by_list", "output_by_serialpos", "recall_by_stim", "delta_recall"]
#: The products of each builder of reports.
PRODUCTS = {
    "record_only": BEHAVIOUR,
    "repeated_words": [*BEHAVIOUR, "repeats"],
    "open_loop": [*BEHAVIOUR, *STIMULATION],
    "closed_loop": [*BEHAVIOUR, *STIMULATION],
    "ticl": [*BEHAVIOUR, *STIMULATION, "stim_counts"],
    "ps4": ["locations"],
    "ps5": [*[p for p in BEHAVIOUR if p != "math_summary"], *STIMULATION],
    "location_search": ["stim_targets"],
}


def route(experiment: Column) -> Column:
    """The name of the builder of an experiment's report: that of the longest known beginning. It names ``experiment`` once,
    as a filter on it is carried to the scan, where what an experiment is made of stands in place of its name."""
    names = sorted(reports.BUILDERS, key=len, reverse=True)
    builders = F.create_map(*[F.lit(x) for name in names for x in (name, reports.BUILDERS[name].__name__)])
    return F.try_element_at(builders, F.regexp_extract(experiment, f"^({'|'.join(map(re.escape, names))})", 1))


def fact(product: str, when: Column, sums: list[Column], k1: Column | None = None, k2: Column | None = None, low: Column | None = None, high: Column | None = None) -> Column:
    """A row's fact for a product where ``when`` holds and the row's report has the product, else null."""
    text = lambda c: (F.lit(None) if c is None else c).cast("string")
    number = lambda c: (F.lit(None) if c is None else c).cast("double")
    has = F.col("_builder").isin(*[b for b, own in PRODUCTS.items() if product in own])
    values = [number(sums[k] if k < len(sums) else None).alias(name) for k, name in enumerate(SUMS)]
    return F.when(when & has, F.struct(F.lit(product).alias("product"), text(k1).alias("k1"), text(k2).alias("k2"), *values, number(low).alias("low"), number(high).alias("high")))


def one(mask: Column) -> Column:
    return F.coalesce(mask, F.lit(False)).cast("int")


def log_facts(log: DataFrame, order: list[str]) -> DataFrame:
    """Facts of event rows. Optional columns: category_num, repeats, iscorrect (of math rows; else recalled)."""
    rows = log.withColumn("_builder", route(F.col("experiment"))).where(F.col("_builder").isNotNull())
    there = set(log.columns)
    in_list = Window.partitionBy(*DEALT, "list").orderBy(*order)
    before = in_list.rowsBetween(Window.unboundedPreceding, -1)
    word, problem = masks.encoding(), masks.math() & (F.col("list") > -1)
    hit = word & masks.recalled()
    said = masks.kind("REC_EVENT", "REC_WORD") & masks.recalled() & (F.col("intrusion") == 0)
    rows = rows.withColumns({"_word": one(word), "_hit": one(hit), "_problem": one(problem), "_said": one(said)}).repartition(*RECORDING)
    first = lambda mark: (F.col(mark) == 1) & (F.coalesce(F.sum(mark).over(before), F.lit(0)) == 0)
    last_said = F.last(F.when(F.col("_said") == 1, F.struct("mstime", *(["category_num"] if "category_num" in there else []))), ignorenulls=True).over(before)
    rows = rows.withColumns({"_new_list": F.row_number().over(in_list) == 1, "_first_hit": first("_hit"), "_new_problem": first("_problem"), "_last": F.when(F.col("_said") == 1, last_said)})
    rows = rows.withColumn("_pause", F.col("mstime") - F.col("_last.mstime"))
    facts = [
        fact("session_summary", F.lit(True), [F.col("_word"), F.when(F.col("_word") == 1, F.col("recalled")), one(F.col("_new_list")), one(F.col("intrusion") > 0), one(F.col("intrusion") == -1)], low=F.col("mstime"), high=F.col("mstime")),
        fact("serialpos", F.col("_word") == 1, [F.lit(1), F.col("recalled")], F.col("serialpos")),
        fact("first_recall", F.col("_first_hit"), [F.lit(1)], F.col("serialpos"), high=F.col("list")),
        fact("math_summary", F.col("_problem") == 1, [F.lit(1), one(F.col("iscorrect" if "iscorrect" in there else "recalled") == 1), one(F.col("_new_problem"))]),
        fact("stim_counts", masks.kind("STIM_ON"), [F.lit(1)], F.col("phase") if "phase" in there else None),
    ]
    if "category_num" in there:
        rows = rows.withColumn("_within", F.col("category_num") == F.col("_last.category_num"))
        inside, between = one(F.col("_within")), one(~F.col("_within"))
        facts.append(fact("category_times", F.col("_pause").isNotNull(), [inside, inside * F.col("_pause"), between, between * F.col("_pause")]))
    if "repeats" in there:
        lo, hi = behavior.REPEAT_POSITIONS
        facts.append(fact("repeats", (F.col("_word") == 1) & F.col("serialpos").between(lo, hi), [F.lit(1), one(masks.recalled())], F.col("repeats")))
    return exploded(rows, facts)


def item_facts(items: DataFrame, level: str = "session") -> DataFrame:
    """Facts of the word rows of stimulation sessions. Any row of a list may give its list's fact, so they need no order of
    their own: a list's rows without stimulation come first, and its first row tells whether all have it. The window is over
    recordings, as lists may be of a row or two and each window costs as much as many rows.

    Above sessions, rows that are alike in all that products have as keys are added up before they give facts; within a
    session hardly any two are."""
    rows = items.withColumns({"_builder": route(F.col("experiment")), "_stim": one(F.col("is_stim_list"))}).where(F.col("_builder").isNotNull()).repartition(*RECORDING)
    in_recording = Window.partitionBy(*DEALT).orderBy("list", "_stim")
    rows = rows.withColumn("_new_list", (F.row_number().over(in_recording) == 1) | ~F.col("list").eqNullSafe(F.lag("list").over(in_recording)))
    low = (F.col("classifier_output") < F.col("thresh")) & ~F.col("is_stim_list")
    delta = F.col("classifier_output").cast("double")
    measures = {"_n": F.lit(1), "_recalled": F.col("recalled"), "_output": delta, "_squared": delta * delta, "_outputs": one(delta.isNotNull())}
    for name, mask in (("_low", low), ("_on", F.col("is_stim_item")), ("_after", F.col("is_post_stim_item"))):
        measures |= {name: one(mask), f"{name}_recalled": one(mask) * F.col("recalled")}
    if level == "session":
        rows = rows.withColumns(measures)
    else:
        alike = ["_builder", "list", "serialpos", "is_stim_list", "is_stim_item", "stimAnodeTag", "stimCathodeTag", "amplitude", "_stim", "_new_list", *(["loc_name"] if "loc_name" in items.columns else [])]
        rows = rows.groupBy(*LEVELS[level], *alike).agg(*[F.sum(v).alias(name) for name, v in measures.items()])
    location = F.when(F.col("is_stim_list"), "stim").otherwise("none") if "loc_name" not in items.columns else F.col("loc_name")
    on, after = [F.col("_on"), F.col("_on_recalled")], [F.col("_after"), F.col("_after_recalled")]
    words = [F.col("_n"), F.col("_recalled")]
    return exploded(rows, [
        fact("stim_lists", F.col("_new_list"), [F.col("_n") * F.col("_stim"), F.col("_n") * (1 - F.col("_stim"))]),
        fact("recalls_by_list", F.lit(True), [*words, F.col("_on")], F.col("list")),
        fact("output_by_serialpos", F.lit(True), [F.col("_n"), F.col("_output")], F.col("serialpos")),
        fact("recall_by_stim", F.lit(True), words, F.col("serialpos"), F.col("is_stim_item")),
        fact("delta_recall", F.lit(True), [*words, F.col("_low"), F.col("_low_recalled"), *on, *after]),
        fact("stim_targets", F.col("is_stim_item") & F.col("stimAnodeTag").isNotNull(), [F.col("_n")], F.col("stimAnodeTag"), F.col("stimCathodeTag"), high=F.col("amplitude")),
        fact("locations", F.col("_outputs") > 0, [F.col("_outputs"), F.col("_output"), F.col("_squared")], location, F.col("amplitude") if "loc_name" in items.columns else F.col("serialpos")),
    ], level)


def exploded(rows: DataFrame, facts: list[Column], level: str = "session") -> DataFrame:
    keys = LEVELS[level]
    return rows.select(*keys, F.explode(F.array(*facts)).alias("f")).where(F.col("f").isNotNull()).select(*keys, "f.*")


KEYS = ["product", "k1", "k2"]


def adds() -> list[Column]:
    return [F.sum(c).alias(c) for c in SUMS] + [F.min("low").alias("low"), F.max("high").alias("high")]


def by_session(log: DataFrame, items: DataFrame | None, order: list[str], level: str = "session") -> DataFrame:
    """Facts added up by session, or by the groups of a higher level with null below it, product and keys. The products of the
    log and of the items differ, so each are added up for themselves, sessions where they have been dealt to."""
    parts, below = [log_facts(log, order), *([] if items is None else [item_facts(items, level)])], [c for c in RECORDING if c not in LEVELS[level]]
    added = [f.groupBy(*KEYS, *LEVELS[level]).agg(*adds()).withColumns({c: F.lit(None).cast(log.schema[c].dataType) for c in below}) for f in parts]
    return reduce(DataFrame.unionByName, added)


def added_up(sessions: DataFrame, levels: list[str]) -> DataFrame:
    """Facts of sessions by level, product and keys: level, experiment, subject, session (null above their level), product,
    k1, k2, m1 to m8, low, high and ratio."""
    level = F.element_at(F.array(*map(F.lit, LEVELS)), (F.grouping("experiment") + F.grouping("subject") + F.grouping("session") + 1).cast("int"))
    return with_ratio(sessions.groupingSets([[*KEYS, *LEVELS[name]] for name in levels], *KEYS, *RECORDING).agg(level.alias("level"), *adds()))


def with_ratio(totals: DataFrame) -> DataFrame:
    change = F.try_divide(100 * (F.try_divide(F.col("m6"), F.col("m5")) - F.try_divide(F.col("m4"), F.col("m3"))), F.try_divide(F.col("m2"), F.col("m1")))
    ratio = F.when(F.col("product") == "delta_recall", change).when(F.col("product") == "first_recall", F.try_divide(F.col("m1"), F.col("high")))
    ratio = ratio.when(F.col("product").isin("output_by_serialpos", "locations"), F.try_divide(F.col("m2"), F.col("m1")))
    ratio = ratio.when(F.col("product") == "category_times", F.try_divide(F.try_divide(F.col("m2"), F.col("m1")), F.try_divide(F.col("m4"), F.col("m3"))))
    ratio = ratio.when(F.col("product").isin(*[p for p, m in MEASURES.items() if m[1:2] == ["num_correct"]]), 100 * F.try_divide(F.col("m2"), F.col("m1")))
    return totals.select("level", *RECORDING, *KEYS, *SUMS, "low", "high", ratio.alias("ratio"))


def build_all(log: DataFrame, items: DataFrame | None, order: list[str], item_order: list[str] | None = None, levels: list[str] | None = None) -> DataFrame:
    """Every product of every experiment's report, from one scan of the log and one of the items, at all levels or those
    named: facts are added up by the finest of them. No product depends on the order of items; ``item_order`` is for callers
    that have it."""
    levels = [name for name in LEVELS if name in (levels or LEVELS)]
    return added_up(by_session(log, items, order, levels[0]), levels)


def save(report: DataFrame, root: str, mode: str = "overwrite") -> None:
    """Stores all products at once: a job writes a folder for each product and level, rows of a subject together."""
    report.repartition("product", "level", "subject").sortWithinPartitions("product", "level", *RECORDING).write.mode(mode).partitionBy("product", "level").parquet(root)


def save_all(log: DataFrame, items: DataFrame | None, order: list[str], root: str) -> DataFrame:
    """Builds and stores every product and returns what is stored, as ``save`` of ``build_all``. Sessions, nearly all of the
    rows, are written by the tasks that made them, in order of their recordings; the higher levels are added up from the
    stored sessions."""
    sessions = with_ratio(by_session(log, items, order).withColumn("level", F.lit("session")))
    sessions.sortWithinPartitions("product", "level", *RECORDING).write.mode("overwrite").partitionBy("product", "level").parquet(root)
    stored = log.sparkSession.read.schema(sessions.schema)
    save(added_up(stored.parquet(root).where("level = 'session'").drop("level", "ratio"), [name for name in LEVELS if name != "session"]), root, "append")
    return stored.parquet(root)


def product(report: DataFrame, name: str, level: str = "session") -> DataFrame:
    """One product at a level, its measures under their names."""
    rows = report.where((F.col("product") == name) & (F.col("level") == level))
    return rows.select(*LEVELS[level], "k1", "k2", *[F.col(f"m{k}").alias(m) for k, m in enumerate(MEASURES[name], 1)], "low", "high", "ratio")


def decisions(report: DataFrame, level: str = "subject", alpha: float = 0.05) -> DataFrame:
    """Which of two locations is better, for each group of a level, from the sums of ``locations``: as stats.choose_location,
    without another look at the rows."""
    keys, rows = LEVELS[level], product(report, "locations", level)
    mean = F.col("sum_delta") / F.col("n")
    spread = F.sqrt(F.greatest(F.lit(0.0), F.try_divide(F.col("sum_delta_squared") - F.col("n") * mean * mean, F.col("n") - 1)) / F.col("n"))
    best = rows.groupBy(*keys, "k1").agg(F.max_by(F.struct(mean.alias("m"), spread.alias("sem")), F.struct(mean, F.col("k2").cast("double"))).alias("b"))
    two = best.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("k1", "b"))).alias("l")).where(F.size("l") == 2)
    x, y = F.col("l")[0], F.col("l")[1]
    t = F.try_divide(x["b"]["m"] - y["b"]["m"], F.sqrt(F.pow(x["b"]["sem"], F.lit(2)) + F.pow(y["b"]["sem"], F.lit(2))))
    got = two.withColumn("t_stat", t).withColumn("p_val", tails.normal_lower(-F.abs("t_stat"))).withColumn("tie", (F.coalesce(F.col("p_val"), F.lit(1.0)) >= alpha).cast("int"))
    wins = F.when(F.col("tie") == 0, F.col("t_stat") > 0).otherwise(x["b"]["sem"] < y["b"]["sem"])
    return got.select(*keys, "t_stat", "p_val", "tie", F.when(wins, x["k1"]).otherwise(y["k1"]).alias("best_location"))
