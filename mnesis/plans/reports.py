"""The tables behind each kind of report. A report is a dictionary of data frames: nothing runs until it is saved."""

from __future__ import annotations

from collections.abc import Callable
from inspect import signature

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mnesis.operators import behavior, masks, model, sequence, stats
from mnesis.schemas import FRParameters, PS5Parameters
from mnesis.sources import store

SESSION = ["subject", "experiment", "session"]
LIST = [*SESSION, "list"]
ORDER = ["mstime", "type"]


def combined_summary(sessions: DataFrame) -> DataFrame:
    return sessions.agg(*[F.sum(c).alias(c) for c in ("num_words", "num_correct", "num_prior_list_intrusions", "num_extra_list_intrusions")]).withColumn(
        "percent_recalled", 100 * F.try_divide(F.col("num_correct"), F.col("num_words"))
    )


def classifier_metadata(summaries: DataFrame) -> DataFrame:
    return summaries.select(*[c for c in ("subject", "experiment", "auc", "p_value", "median_output", "lower", "upper") if c in summaries.columns])


def gold(tables: dict[str, DataFrame]) -> DataFrame:
    """(key, rows): each table's rows as JSON, ready to be drawn."""
    out = None
    for key, df in tables.items():
        one = df.select(F.lit(key).alias("key"), F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns])).alias("row"))
        out = one if out is None else out.union(one)
    return out


def behaviour(events: DataFrame, math: DataFrame | None = None) -> dict[str, DataFrame]:
    words = events.where(masks.encoding())
    sessions = behavior.fr_summary(events, SESSION)
    out = {
        "session_summary": sessions.join(behavior.session_length(events, SESSION).drop("num_lists"), SESSION),
        "combined_summary": combined_summary(sessions),
        "serialpos": behavior.recall_by_serialpos(words, tuple(SESSION)),
        "first_recall": behavior.first_recall_by_serialpos(words, ["mstime"], keys=tuple(SESSION)),
    }
    if math is not None:
        out["math_summary"] = behavior.math_summary(math, SESSION)
    if "category_num" in events.columns:
        recalls = events.where(masks.kind("REC_EVENT", "REC_WORD") & masks.recalled() & (F.col("intrusion") == 0))
        out["category_times"] = behavior.category_times(recalls, LIST, ORDER)
        out["repetition_ratio"] = behavior.subject_repetition_ratio(sequence.repetition_ratio(recalls, LIST, ORDER))
    return out


def classifier(training: DataFrame, keys: list[str], by: str, p: FRParameters) -> dict[str, DataFrame]:
    """training: rows of model's training table. Leaving out sessions permutes training, too; leaving out lists doesn't."""
    cv = model.cross_validate(training, keys, by, p.penalty, p.n_permutations, permute_training=by == "session")
    true = cv.where("perm = 0")
    return {
        "classifier_summary": model.summary(cv, keys),
        "roc": stats.roc_curve(true, keys, "probability", "outcome"),
        "terciles": stats.terciles(true, keys, "probability", "outcome"),
        "models": model.train(training, keys, p.penalty),
    }


def electrodes(pairs: DataFrame, powers: DataFrame, p: FRParameters) -> dict[str, DataFrame]:
    table = stats.delta_hfa_table(pairs, powers, p.frequencies, p.hfa_cutoff, p.trigger_frequency)
    return {"target_selection_table": stats.target_selection(table)}


def stimulation(items: DataFrame, least_list: int = 4) -> dict[str, DataFrame]:
    return {
        "stim_parameters": behavior.stim_parameters(items, ("subject",)),
        "recall_tests": behavior.recall_tests(items, least_list, ("subject",)),
        "delta_recall": behavior.delta_recall(items, ("subject",)),
        "stim_lists": behavior.stim_list_counts(items, ("subject",)),
        "recalls_by_list": behavior.recalls_by_list(items, keys=("subject",)).join(behavior.stim_events_by_list(items, ("subject",)), ["subject", "list"]),
        "output_by_serialpos": behavior.output_by_serialpos(items, ("subject",)),
        "recall_by_stim": behavior.recall_by_stim(items, ("subject",)),
    }


def record_only(events: DataFrame, math: DataFrame, training: DataFrame, pairs: DataFrame, powers: DataFrame, by: str = "session", p: FRParameters = FRParameters()) -> dict[str, DataFrame]:
    """Behaviour, classifier, electrode table and features (FR1, catFR1, courier)."""
    return {**behaviour(events, math), **classifier(training, ["subject"], by, p), **electrodes(pairs, powers, p), "features": training}


def repeated_words(events: DataFrame, math: DataFrame, training: DataFrame, pairs: DataFrame, powers: DataFrame, p: FRParameters = FRParameters()) -> dict[str, DataFrame]:
    """As record_only, with counts by presentations and a classifier for each number of presentations."""
    return {**behaviour(events, math), "repeats": behavior.repeated_words(events, SESSION), **classifier(training, ["subject", "repeats"], "list", p), **electrodes(pairs, powers, p)}


def open_loop(events: DataFrame, math: DataFrame, items: DataFrame) -> dict[str, DataFrame]:
    """FR2: behaviour and stimulation, no classifier."""
    return {**behaviour(events, math), **stimulation(items)}


def closed_loop(events: DataFrame, math: DataFrame, items: DataFrame, scored: DataFrame) -> dict[str, DataFrame]:
    """FR3, FR5, FR6: stimulation, and the outputs of each session's model. scored: rows of model.post_hoc."""
    return {**open_loop(events, math, items), "classifier_output": scored, "classifier_auc": stats.auc(scored.where(masks.encoding()), behavior.shared_keys(scored), "probability", "recalled"), "effect_design": stats.effect_design(items)}


def ticl(events: DataFrame, math: DataFrame, items: DataFrame, scored: DataFrame, biomarkers: DataFrame) -> dict[str, DataFrame]:
    return {**closed_loop(events, math, items, scored), "matched_biomarkers": behavior.matched_biomarkers(biomarkers), "stim_counts": behavior.stim_count_by_phase(events, tuple(SESSION))}


def ps4(rows: DataFrame, sham: DataFrame | None = None) -> dict[str, DataFrame]:
    """rows: (subject, session, loc_name, list_phase, amplitude, delta_classifier, post_stim_output)."""
    keys = [c for c in ("subject", "session", "loc_name") if c in rows.columns]
    own = tuple(c for c in ("subject", "experiment") if c in rows.columns)
    return {"decision": stats.choose_location(rows, sham, keys=own), "locations": behavior.location_summary(rows, keys, "list_phase", "amplitude", "delta_classifier", "post_stim_output")}


def ps5(events: DataFrame, items: DataFrame, powers: DataFrame, pair_idx: int, p: FRParameters = PS5Parameters()) -> dict[str, DataFrame]:
    """Power at the trigger pair and frequency, its running threshold, and stimulation; all lists from 0 count."""
    at = next(k for k, f in enumerate(p.frequencies) if int(f) == p.trigger_frequency)
    trigger = powers.where((F.col("pair_idx") == pair_idx) & (F.col("freq_idx") == at))
    threshold = trigger.withColumn("thresh", sequence.running_threshold(behavior.shared_keys(trigger), ["event_id"], "power"))
    return {**behaviour(events), **stimulation(items, least_list=0), "trigger_power": threshold}


def location_search(stim: DataFrame, tmi: DataFrame) -> dict[str, DataFrame]:
    from mnesis.operators.tmi import target_table

    return {"stim_targets": target_table(stim, tmi)}


#: The builder of each experiment's report; a name's longest known beginning counts.
BUILDERS: dict[str, Callable[..., dict[str, DataFrame]]] = {
    "FR1": record_only, "catFR1": record_only, "DBOY1": record_only, "CourierReinstate1": record_only, "RepFR1": repeated_words, "FR2": open_loop, "catFR2": open_loop,
    "FR3": closed_loop, "catFR3": closed_loop, "FR5": closed_loop, "catFR5": closed_loop, "FR6": closed_loop, "catFR6": closed_loop, "TICL": ticl, "PS4": ps4, "PS5": ps5, "LocationSearch": location_search,
}


def builder(experiment: str) -> Callable[..., dict[str, DataFrame]]:
    """The builder of an experiment's report."""
    known = [name for name in BUILDERS if experiment.startswith(name)]
    if not known:
        raise ValueError(f"{experiment}: no report is known")
    return BUILDERS[max(known, key=len)]


def build(experiment: str, inputs: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The tables of an experiment's report, from those of the named inputs that its builder takes."""
    make = builder(experiment)
    takes = signature(make).parameters
    absent = [name for name, p in takes.items() if p.default is p.empty and name not in inputs]
    if absent:
        raise ValueError(f"{experiment}: needs {', '.join(absent)}")
    return make(**{name: inputs[name] for name in takes if name in inputs})


def make_report(build: Callable[[], dict[str, DataFrame]], root: str, wanted: DataFrame, data_types: list[str], rerun: bool = False) -> dict[str, DataFrame]:
    """The stored products of the wanted sessions, built and stored first where any is missing or rerun is asked for."""
    spark = wanted.sparkSession
    found = None if rerun else store.load_existing(spark, root, data_types, wanted)
    if found is None:
        store.save_all(build(), root)
        found = {t: store.load(spark, root, t, wanted) for t in data_types}
    return found


def aggregated(root: str, wanted: DataFrame, data_type: str = "items") -> tuple[dict[str, DataFrame], DataFrame]:
    """Stimulation tables over all wanted subjects, experiments and sessions at once, and the sessions that have no items."""
    spark = wanted.sparkSession
    return stimulation(store.load(spark, root, data_type, wanted)), store.missing(spark, root, data_type, wanted)
