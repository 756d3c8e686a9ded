"""Behavioural summaries as grouped tables. Items are rows of words with subject, experiment, session, list, serialpos,
recalled (0/1), is_stim_list, is_stim_item, is_post_stim_item, classifier_output and thresh."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mnesis.functions import tails
from mnesis.functions.text import safe_divide
from mnesis.operators import masks, sequence

STIM_PARAMETERS = ["stimAnodeTag", "stimCathodeTag", "location", "amplitude", "stim_duration", "pulse_freq"]
#: Serial positions that a repeated-words session counts.
REPEAT_POSITIONS = (3, 23)


#: What tells recordings apart. Operators on recordings use those of these columns that all their tables have, unless told.
RECORDING = ("subject", "experiment", "session")


def shared_keys(*tables: DataFrame, among: tuple[str, ...] = RECORDING) -> list[str]:
    """The columns of ``among`` that all tables have."""
    return [c for c in among if all(c in t.columns for t in tables)]


def count_if(mask: Column) -> Column:
    return F.count(F.when(mask, 1))


def event_metadata(df: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """One row for each group: subject, experiments joined by commas, sessions joined by underscores."""
    distinct = lambda c: F.sort_array(F.collect_set(c))
    return df.groupBy(*keys).agg(
        F.array_join(distinct(F.when(F.col("subject") != "", F.col("subject"))), ",").alias("subjects"),
        F.array_join(distinct("experiment"), ",").alias("experiments"),
        F.array_join(F.transform(distinct("session"), lambda s: s.cast("string")), "_").alias("sessions"),
    )


def math_summary(df: DataFrame, keys: list[str], totals: bool = True) -> DataFrame:
    """Problems, lists, correct answers and ratios for each group, and with totals for all (keys null, lists null)."""
    rows = df.where(masks.math() & (F.col("list") > -1))
    each = rows.groupBy(*keys).agg(F.count("*").alias("num_problems"), F.countDistinct("list").alias("num_lists"), count_if(F.col("iscorrect") == 1).alias("num_correct"))
    table = each
    if totals:
        all_rows = each.agg(F.sum("num_problems").alias("num_problems"), F.sum("num_lists").alias("num_lists"), F.sum("num_correct").alias("num_correct"))
        table = each.unionByName(all_rows.where("num_problems IS NOT NULL"), allowMissingColumns=True)
    return table.withColumns({
        "percent_correct": safe_divide(100.0 * F.col("num_correct"), F.col("num_problems")),
        "problems_per_list": safe_divide(F.col("num_problems").cast("double"), F.col("num_lists")),
    })


def session_length(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(
        ((F.max("mstime") - F.min("mstime")) / 1000).alias("session_length"),
        F.timestamp_millis(F.max("mstime")).alias("session_datetime"),
        F.countDistinct("list").alias("num_lists"),
    )


def fr_summary(df: DataFrame, keys: list[str]) -> DataFrame:
    """Words, recalls, share recalled, lists and intrusions of each group."""
    word = masks.encoding()
    return df.groupBy(*keys).agg(
        count_if(word).alias("num_words"),
        F.sum(F.when(word, F.col("recalled"))).alias("num_correct"),
        F.countDistinct("list").alias("num_lists"),
        count_if(F.col("intrusion") > 0).alias("num_prior_list_intrusions"),
        count_if(F.col("intrusion") == -1).alias("num_extra_list_intrusions"),
    ).withColumn("percent_recalled", safe_divide(100.0 * F.col("num_correct"), F.col("num_words")))


def intrusion_events(df: DataFrame) -> DataFrame:
    """Recalls of words that their list doesn't have: of earlier lists (intrusion over 0) or of none (-1)."""
    return df.where(masks.kind("REC_WORD") & (F.col("intrusion") != -999) & (F.col("intrusion") != 0))


def repetition_ratios(events: DataFrame, subjects: DataFrame | None = None, experiment: str = "catFR1", order: tuple[str, ...] = ("mstime", "type")) -> DataFrame:
    """(subject, session, list, ratio) of an experiment's recalled rows, of all its subjects or of those of a table, such as
    ``readers.subjects_of`` an index; null for a list with one recall."""
    rows = events.where((F.col("experiment") == experiment) & masks.recalled())
    rows = rows if subjects is None else rows.join(subjects.select("subject"), "subject", "left_semi")
    return sequence.repetition_ratio(rows, ["subject", "session", "list"], list(order))


def recall_by_serialpos(items: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    return items.groupBy(*keys, "serialpos").agg(F.avg("recalled").alias("probability"))


def first_recall_by_serialpos(items: DataFrame, order: list[str], positions: int = 12, stim: bool | None = None, keys: tuple[str, ...] = ()) -> DataFrame:
    """How often each position is a list's first recalled word, over the highest list number; a row for every position of
    each group. stim: stimulated items only, or the others only."""
    items = items if stim is None else items.where(F.col("is_stim_item") == stim)
    first = items.where(masks.recalled()).groupBy(*keys, "list").agg(F.min_by("serialpos", F.struct(*order)).alias("serialpos"))
    count = first.groupBy(*keys, F.col("serialpos").cast("int").alias("serialpos")).agg(F.count("*").alias("n"))
    every = items.groupBy(*keys).agg(F.max("list").alias("last")).withColumn("serialpos", F.explode(F.sequence(F.lit(1), F.lit(positions))))
    return every.join(count, [*keys, "serialpos"], "left").select(*keys, "serialpos", safe_divide(F.coalesce("n", F.lit(0)).cast("double"), F.col("last")).alias("probability"))


def recall_by_stim(items: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """Recall by position, of stimulated items and of the others."""
    return items.groupBy(*keys, "is_stim_item", "serialpos").agg(F.avg("recalled").alias("probability"))


def repeated_words(df: DataFrame, keys: list[str]) -> DataFrame:
    """Words and recalls by number of presentations, middle serial positions only."""
    lo, hi = REPEAT_POSITIONS
    rows = df.where(masks.encoding() & F.col("serialpos").between(lo, hi))
    return rows.groupBy(*keys, "repeats").agg(F.count("*").alias("num_words"), count_if(masks.recalled()).alias("num_correct"))


def binned_recall(items: DataFrame, column: str, group: str, bins: int, values: list | None = None, keys: tuple[str, ...] = ()) -> DataFrame:
    """Mean recall by equal-width bin of a column (right-closed, numbered from 1) and by the values of a group, as columns;
    with keys, each group of keys has bins of its own."""
    ends = items.groupBy(*keys).agg(F.min(column).alias("_lo"), F.max(column).alias("_hi"))
    place = F.greatest(F.lit(1), F.ceil((F.col(column) - F.col("_lo")) * bins / F.nullif(F.col("_hi") - F.col("_lo"), F.lit(0)))).cast("int")
    rows = (items.join(ends, list(keys)) if keys else items.join(F.broadcast(ends), F.lit(True))).withColumn("bin", F.coalesce(place, F.lit(1)))
    return rows.groupBy(*keys, "bin").pivot(group, values).agg(F.avg("recalled"))


def category_times(recalls: DataFrame, keys: list[str], order: list[str], category: str = "category_num") -> DataFrame:
    """Mean times between recalls, within and between categories, for each group of keys without its list."""
    times = sequence.response_times(recalls, keys, order, category)
    return times.groupBy(*[k for k in keys if k != "list"]).agg(
        F.avg(F.when(F.col("within"), F.col("irt"))).alias("irt_within"), F.avg(F.when(~F.col("within"), F.col("irt"))).alias("irt_between"),
        count_if(F.col("within")).alias("n_within"), count_if(~F.col("within")).alias("n_between"),
    )


def subject_repetition_ratio(ratios: DataFrame) -> DataFrame:
    return ratios.groupBy("subject").agg(F.avg("ratio").alias("repetition_ratio"))


def stim_list_counts(items: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    lists = items.groupBy(*keys, "list").agg(F.bool_and("is_stim_list").alias("stim"))
    return lists.groupBy(*keys).agg(count_if(F.col("stim")).alias("num_stim_lists"), count_if(~F.col("stim")).alias("num_nonstim_lists"))


def stim_events_by_list(items: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    return items.groupBy(*keys, "list").agg(count_if(F.col("is_stim_item")).alias("n_stim_events"))


def output_by_serialpos(items: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    return items.groupBy(*keys, "serialpos").agg(F.avg("classifier_output").alias("mean_output"))


def lists_of_kind(items: DataFrame, stim: bool | None = None) -> DataFrame:
    rows = items if stim is None else items.where(F.col("is_stim_list") == stim)
    return rows.select("list").distinct()


def recalls_by_list(items: DataFrame, stim_lists_only: bool = False, keys: tuple[str, ...] = ()) -> DataFrame:
    rows = items.where("is_stim_list") if stim_lists_only else items
    return rows.groupBy(*keys, "list").agg(F.sum("recalled").cast("long").alias("n_recalls"))


def stim_params_by_list(items: DataFrame) -> DataFrame:
    """Every item with each parameter set of its list: a list with stimulated and other words gives each word twice, once
    without parameters."""
    keys, types = ["subject", "experiment", "session", "list"], dict(items.dtypes)
    # one window over the list instead of a join with its sets; 0.0 makes -0.0 and 0.0 one set
    value = lambda c: (F.col(c) + F.lit(0.0).cast(types[c])) if types[c] in ("double", "float") else F.col(c)
    sets = F.collect_set(F.struct(*[value(c).alias(c) for c in STIM_PARAMETERS])).over(Window.partitionBy(*keys))
    known = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    rows = items.withColumn("_sets", F.when(known, sets)).drop(*STIM_PARAMETERS)
    return rows.select(*keys, *[c for c in rows.columns if c not in (*keys, "_sets")], F.explode_outer("_sets").alias("_s")).select("*", "_s.*").drop("_s")


def stim_parameters(items: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """Stimulations and trials of each parameter set and kind of list; sets with a missing part don't count. With keys, for
    each group of keys; without, over all items."""
    rows = stim_params_by_list(items).na.fill({"location": "--"}).na.drop(subset=[*STIM_PARAMETERS, "is_stim_list"])
    return rows.groupBy(*keys, *STIM_PARAMETERS, "is_stim_list").agg(count_if(F.col("is_stim_item")).alias("n_stimulations"), F.count("subject").alias("n_trials"))


def recall_tests(items: DataFrame, least_list: int = 4, keys: tuple[str, ...] = ()) -> DataFrame:
    """Chi-square statistics of recall after stimulation against controls, for each parameter set: stim lists against other
    lists, and stim items and post-stim items against items of low output without stimulation. With keys, each group of keys
    is tested against its own controls; without, all items are pooled."""
    rows = stim_params_by_list(items).where(F.col("list") >= least_list)
    by = [c for c in STIM_PARAMETERS if c != "location"]
    low = ~F.col("is_stim_item") & (F.col("classifier_output") < F.col("thresh"))
    two = lambda name, mask: [F.coalesce(F.sum(F.when(mask, F.col("recalled"))), F.lit(0)).cast("long").alias(f"{name}_c"), F.count(F.when(mask, F.col("recalled"))).alias(f"{name}_n")]
    # a row for each parameter set, also those with a missing part; controls are sums over them, so items are dealt once
    parts = [*two("list", ~F.col("is_stim_list")), *two("low", low), *two("stim_list", F.col("is_stim_list")), *two("stim_item", F.col("is_stim_item")), *two("post_item", F.col("is_post_stim_item"))]
    group = Window.partitionBy(*(keys or [F.lit(True)]))
    sets = rows.na.drop(subset=list(keys)).groupBy(*keys, *by).agg(*parts)
    both = sets.withColumns({f"{name}_{c}": F.sum(f"{name}_{c}").over(group) for name in ("list", "low") for c in "cn"}).na.drop(subset=by)
    tests = F.array(*[
        F.struct(F.lit(name).alias("comparison"), F.col(f"{own}_c").alias("stim_correct"), F.col(f"{own}_n").alias("stim_items"), F.col(f"{other}_c").alias("control_correct"), F.col(f"{other}_n").alias("control_items"))
        for name, own, other in (("stim lists", "stim_list", "list"), ("stim items", "stim_item", "low"), ("post-stim items", "post_item", "low"))
    ])
    flat = both.select(*keys, *by, F.explode(tests).alias("t")).select(*keys, *by, "t.*")
    tested = flat.withColumn("chi2", two_proportions(F.col("stim_correct"), F.col("stim_items"), F.col("control_correct"), F.col("control_items")))
    return tested.withColumn("p_value", tails.chi2_1_pvalue("chi2"))


def two_proportions(c1: Column, n1: Column, c2: Column, n2: Column) -> Column:
    """Pooled chi-square with one degree of freedom; null where a group is empty or nothing varies."""
    p = F.try_divide((c1 + c2).cast("double"), (n1 + n2).cast("double"))
    part = lambda c, n: F.try_divide((c - n * p) * (c - n * p), n * p * (1 - p))
    return part(c1, n1) + part(c2, n2)


def delta_recall(items: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """Percent change of recall of stimulated and of post-stim items against items of low output on lists without
    stimulation, relative to mean recall."""
    mean = lambda mask: F.avg(F.when(mask, F.col("recalled")))
    row = items.groupBy(*keys).agg(
        mean((F.col("classifier_output") < F.col("thresh")) & ~F.col("is_stim_list")).alias("low"),
        mean(F.col("is_stim_item")).alias("stim"), mean(F.col("is_post_stim_item")).alias("post"), F.avg("recalled").alias("all"),
    )
    change = lambda c: 100 * F.try_divide(F.col(c) - F.col("low"), F.col("all"))
    return row.select(*keys, change("stim").alias("delta_recall_stim"), change("post").alias("delta_recall_post_stim"))


def matched_biomarkers(rows: DataFrame, phases: list[str] | None = None) -> DataFrame:
    """Biomarkers before stimulation that have a partner after it."""
    chosen = rows if phases is None else rows.where(F.col("phase").isin(*phases))
    after = rows.where(F.col("position") == "post").select("id").distinct()
    return chosen.where(F.col("position") == "pre").join(after, "id", "left_semi").select(*rows.columns)


def pair_counts(pairs: DataFrame, excluded: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """How many pairs each montage has, and how many of them are excluded."""
    known = excluded.select(*keys, "label").distinct().withColumn("_x", F.lit(1))
    return pairs.join(known, [*keys, "label"], "left").groupBy(*keys).agg(F.count("*").alias("n_pairs"), F.count("_x").alias("n_excluded_pairs"))


def delta_against_auc(sessions: DataFrame, deltas: DataFrame, keys: list[str]) -> DataFrame:
    """Each session's AUC beside its change of recall, for those that have both."""
    return sessions.join(deltas, keys).where("auc IS NOT NULL AND delta_recall_stim IS NOT NULL").select(*keys, "auc", "delta_recall_stim")


def per_session(df: DataFrame, keys: list[str], summaries: dict) -> DataFrame:
    """A user's own summaries: (keys and a column for each name), each an aggregate of the session's rows."""
    return df.groupBy(*keys).agg(*[column.alias(name) for name, column in summaries.items()])


def stim_count_by_phase(df: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    return df.where(masks.kind("STIM_ON")).groupBy(*keys, "phase").agg(F.count("*").alias("n_stims"))


def location_summary(df: DataFrame, keys: list[str], phase: str, amplitude: str, delta: str, post: str) -> DataFrame:
    """Arrays of amplitudes, classifier changes and post-stim outputs of each location and phase, in order of amplitude."""
    rows = F.sort_array(F.collect_list(F.struct(F.col(amplitude).alias("a"), F.col(delta).alias("d"), F.col(post).alias("p"))))
    got = df.groupBy(*keys, phase).agg(rows.alias("r"))
    return got.select(*keys, phase, F.col("r.a").alias("amplitude"), F.col("r.d").alias("delta_classifier"), F.col("r.p").alias("post_stim_output"))


def bad_channels(df: DataFrame, keys: list[str], most: int = 20) -> DataFrame:
    return df.groupBy(*keys).agg((F.sum(F.col("bad").cast("int")) > most).alias("bad_channel"))


def metric_by_group(sessions: DataFrame, by: list[str], metric: str) -> DataFrame:
    return sessions.groupBy(*by).agg(F.avg(metric).alias("mean"), F.min(metric).alias("min"), F.max(metric).alias("max"))


def with_partner_check(left: DataFrame, right: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """left with right's columns, one to one, and the rows of left without a partner."""
    one = right.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(*[c for c in right.columns if c not in keys]))).where("_n = 1").drop("_n")
    return left.join(one, keys, "left"), left.join(right, keys, "left_anti")


def first_model(models: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    return models.withColumn("_n", F.row_number().over(sequence.window(keys, order))).where("_n = 1").drop("_n")


def subject_level(sessions: DataFrame, metric: str) -> DataFrame:
    return sessions.groupBy("subject", "experiment").agg(F.sort_array(F.collect_set("session")).alias("sessions"), F.count("*").alias("n_sessions"), F.avg(metric).alias("mean"))


def stim_item_table(items: DataFrame, stim: DataFrame, locations: DataFrame, order: list[str], keys: list[str] | None = None) -> DataFrame:
    """Word rows with the parameters of their stimulation (the first in ``order`` for a recording, list and item), its location
    by anode and cathode, and null parameters where there was none. stim: (recording, list, item_name, stimAnodeTag,
    stimCathodeTag, amplitude, stim_duration, pulse_freq and order). locations: (label, location), and subject or montage
    where labels repeat over them. keys: by default what both tables have of RECORDING, and list and item_name."""
    keys = [*shared_keys(items, stim), "list", "item_name"] if keys is None else keys
    values = [c for c in STIM_PARAMETERS if c != "location"]
    first = stim.groupBy(*keys).agg(F.min_by(F.struct(*values), F.struct(*order)).alias("_p")).select(*keys, *[F.col(f"_p.{c}").alias(c) for c in values])
    own = shared_keys(items, locations, among=("subject", "montage"))
    known = locations.groupBy(*own, F.col("label").alias("_label")).agg(F.min("location").alias("location"))
    rows = items.join(first, keys, "left").withColumn("_label", F.concat(F.col("stimAnodeTag"), F.lit("-"), F.col("stimCathodeTag")))
    return rows.join(known, [*own, "_label"], "left").drop("_label")


def with_outputs(items: DataFrame, outputs: DataFrame, thresholds: DataFrame | None = None, keys: tuple[str, ...] = ("event_id",)) -> DataFrame:
    """Items with their classifier output, and their recording's threshold (0.5 where there is none); recordings are told
    apart by what both tables have of RECORDING."""
    rows = items.join(outputs.select(*keys, F.col("probability").alias("classifier_output")), list(keys), "left")
    if thresholds is None:
        return rows.withColumn("thresh", F.lit(0.5))
    own = shared_keys(items, thresholds)
    return rows.join(thresholds.select(*own, F.col("threshold").alias("_t")), own, "left").withColumn("thresh", F.coalesce("_t", F.lit(0.5))).drop("_t")


def stim_outputs(items: DataFrame, post: bool = False, phases: list[str] | None = None) -> DataFrame:
    """Outputs before stimulation of the stimulated items, or all post-stim outputs; of the named phases alone, if any."""
    items = items if phases is None else items.where(F.col("phase").isin(*phases))
    return items.where(F.col("post_stim_output").isNotNull()).select("post_stim_output") if post else items.where("is_stim_item").select("classifier_output")


def tstats_by_condition(channels: DataFrame, level: float = 0.001, keys: tuple[str, ...] = ()) -> DataFrame:
    """Arrays of t over channels with p below the level and of the others."""
    return channels.groupBy(*keys).agg(F.array_sort(F.collect_list(F.when(F.col("p") < level, F.col("t_stat")))).alias("significant"), F.array_sort(F.collect_list(F.when(F.col("p") >= level, F.col("t_stat")))).alias("others"))


def location_search_table(events: DataFrame, stim: DataFrame, pairs: DataFrame) -> DataFrame:
    """Distinct targets of a location search by recording, with the pair of their contact numbers. stim: (event_id,
    anode_number, cathode_number, amplitude). Events' columns of RECORDING tell recordings apart; where pairs have subject or
    montage as events do, contact numbers count within them."""
    rows = events.join(stim, "event_id")
    own = shared_keys(events, pairs, among=("subject", "montage"))
    known = pairs.select(*own, F.col("channel_1").alias("anode_number"), F.col("channel_2").alias("cathode_number"), F.col("pair_idx").alias("stim_idx"), "label")
    by = [*dict.fromkeys([*shared_keys(events), *own])]
    return rows.join(known, [*own, "anode_number", "cathode_number"], "left").groupBy(*by, "anode_number", "cathode_number", "stim_idx", "label").agg(F.count("*").alias("n_stims"), F.max("amplitude").alias("amplitude"))


def classifier_regions(pairs: DataFrame) -> DataFrame:
    return pairs.select("region").distinct()
