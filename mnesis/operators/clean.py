"""Cleaning, normalising and combining event tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mnesis.operators import masks, retrieval
from mnesis.schemas import EVENTS, STIM_COLUMNS, STIM_EVENTS, required_columns


def select_columns(df: DataFrame, **flags: bool) -> DataFrame:
    """The columns that the flags ask for, as far as the table has them."""
    return df.select(*[c for c in required_columns(**flags) if c in df.columns])


def cast_columns(df: DataFrame, kinds: dict[str, str]) -> DataFrame:
    return df.withColumns({c: F.col(c).cast(k) for c, k in kinds.items()})


def add_constant(df: DataFrame, name: str, value, kind: str) -> DataFrame:
    return df.withColumn(name, F.lit(value).cast(kind))


def append_missing(df: DataFrame, kinds: dict[str, str]) -> DataFrame:
    return df.withColumns({c: F.lit(None).cast(k) for c, k in kinds.items() if c not in df.columns})


def conform(df: DataFrame, schema: T.StructType, defaults: dict | None = None) -> DataFrame:
    """Exactly the schema's columns, in its order and types; missing ones get their default or null."""
    defaults = defaults or {}
    there = set(df.columns)
    return df.select(*[(F.col(f.name) if f.name in there else F.lit(defaults.get(f.name))).cast(f.dataType).alias(f.name) for f in schema])


def empty_events(spark) -> DataFrame:
    return spark.createDataFrame([], EVENTS)


def empty_stim_events(spark) -> DataFrame:
    return spark.createDataFrame([], STIM_EVENTS)


def fill_subject(df: DataFrame, recording: list[str]) -> DataFrame:
    """Rows without a subject get that of their recording (its event file, say), where all rows that name one name the same.
    Others keep none: session numbers repeat over subjects, so a session alone may be two people's."""
    own = F.when(F.col("subject") != "", F.col("subject"))
    all_rows = Window.partitionBy(*recording)
    found = F.when(F.min(own).over(all_rows) == F.max(own).over(all_rows), F.max(own).over(all_rows))
    return df.withColumn("subject", F.coalesce(own, found))


def combine_retrieval(df: DataFrame) -> DataFrame:
    """Recalls and baseline rows become REC_EVENT; recalls count as recalled, baseline rows don't."""
    outcome = F.when(masks.kind("REC_WORD"), 1).when(masks.kind("REC_BASE"), 0).otherwise(F.col("recalled"))
    return df.withColumns({"recalled": outcome.cast("long"), "type": F.when(masks.kind("REC_WORD", "REC_BASE"), "REC_EVENT").otherwise(F.col("type"))})


def recall_outcome(df: DataFrame) -> DataFrame:
    return df.withColumn("recalled", F.when(masks.kind("REC_WORD"), 1).when(masks.kind("REC_BASE"), 0).otherwise(F.col("recalled")).cast("long"))


def study_pairs_to_words(df: DataFrame) -> DataFrame:
    return df.withColumn("type", F.when(masks.kind("STUDY_PAIR"), "WORD").otherwise(F.col("type")))


def correct_to_recalled(df: DataFrame) -> DataFrame:
    return df.drop("recalled").withColumnRenamed("correct", "recalled") if "correct" in df.columns else df


def _defaults(df: DataFrame, values: dict) -> DataFrame:
    return df.withColumns({c: F.lit(v) for c, v in values.items() if c not in df.columns})


def normalize_fr(df: DataFrame) -> DataFrame:
    return select_columns(_defaults(combine_retrieval(df), {"category_num": 999, "phase": ""}), cat=True)


def normalize_pal(df: DataFrame) -> DataFrame:
    rows = study_pairs_to_words(correct_to_recalled(df))
    return _defaults(rows, {"phase": "", "matched": True}).withColumns({"item_name": F.lit("X"), "category_num": F.lit(999)})


def separate_stim(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Events without nested parameters, and stim rows with them."""
    return df.drop("stim_params"), df.select(*[c for c in STIM_COLUMNS if c in df.columns])


def surrogate_response_times(df: DataFrame, keys: list[str], seed: int = 0) -> DataFrame:
    """PAL retrieval rows: a missing RT (-999) is drawn from the session's correct RTs by a hash of the row, so reruns agree;
    rows become REC_EVENT and start at their response. Sessions without correct RTs keep -999."""
    correct = F.array_sort(F.collect_list(F.when((F.col("correct") == 1) & (F.col("RT") != -999), F.col("RT"))))
    drawn = df.join(df.groupBy(*keys).agg(correct.alias("_rts")), keys)
    said = F.md5(F.concat_ws("|", *[F.col(c).cast("string") for c in (*keys, "mstime", "eegoffset")], F.lit(str(seed))).cast("binary"))
    pick = F.pmod(F.conv(F.substring(said, 1, 8), 16, 10).cast("long"), F.greatest(F.size("_rts"), F.lit(1)))
    rt = F.when(F.col("RT") == -999, F.coalesce(F.get("_rts", pick.cast("int")), F.lit(-999))).otherwise(F.col("RT"))
    return drawn.withColumn("RT", rt).withColumns({"type": F.lit("REC_EVENT"), "eegoffset": F.col("eegoffset") + F.col("RT")}).select(*df.columns)


def union_experiments(tables: list[DataFrame], step: int = 100) -> DataFrame:
    """One table of several experiments; sessions of the k-th table that isn't empty are raised by step * k. Columns that a
    table lacks are null. Emptiness is found in the same plan, by a count for each table."""
    marked = [t.withColumn("_table", F.lit(k)) for k, t in enumerate(tables)]
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), marked)
    present = rows.select("_table").distinct()
    rank = present.select("_table", (F.row_number().over(Window.orderBy("_table")) - 1).alias("_rank"))  # a row for each table
    return rows.join(F.broadcast(rank), "_table").withColumn("session", F.col("session") + step * F.col("_rank")).drop("_table", "_rank")


def union_sessions(tables: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)


def without_session_offset(sessions: DataFrame, experiment: str) -> DataFrame:
    """The sessions of an experiment as they are in the index: PAL's from 200, categorised ones' from 100, others below."""
    s = F.col("session")
    if "PAL" in experiment:
        return sessions.where(s >= 200).withColumn("session", s - 200)
    if "cat" in experiment:
        return sessions.where((s >= 100) & (s < 200)).withColumn("session", s - 100)
    if "FR" in experiment or "PS" in experiment:
        return sessions.where(s < 100)
    raise ValueError(f"{experiment}: no session numbering is known")


def assert_single(df: DataFrame, column: str) -> DataFrame:
    """df, with an error when the plan runs if the column has more than one value."""
    many = df.agg(F.min(column).alias("lo"), F.max(column).alias("hi"))
    check = many.select(F.assert_true(F.coalesce(F.col("lo") == F.col("hi"), F.lit(True)), F.lit(f"more than one {column}")).alias("_ok"))
    return df.join(F.broadcast(check), F.lit(True)).where(F.col("_ok").isNull()).drop("_ok")


def biomarkers(df: DataFrame) -> DataFrame:
    first = F.get("stim_params", F.lit(0))
    rows = df.where(masks.kind("BIOMARKER"))
    return rows.select(first["position"].alias("position"), "phase", first["biomarker_value"].alias("biomarker_value"), first["id"].alias("id"))


#: Of experiments that get baseline periods: free recall and its courier variant, but not where classifiers trigger stimulation.
WITH_BASELINE, WITHOUT_BASELINE = ("FR", "DBOY"), "TICL"


def clean_fr(df: DataFrame, partition: list[str], order: list[str], keep_intrusions: bool = False, baseline: dict | bool | None = True) -> DataFrame:
    """The free-recall branch: no bad offsets, voice detections, practice or unfinished lists, and no intrusions. PS5 keeps
    its practice list -1. Periods of failure to recall come in as REC_BASE rows before intrusions go (baseline: settings of
    retrieval.insert_baseline, True for the defaults where the table has rectime, which they need, None for no such rows); TICL experiments have none."""
    ps5 = F.col("experiment").contains("PS5")
    rows = df.transform(masks.remove_negative_offsets).transform(masks.remove_voice_detection).where(F.col("list") >= F.when(ps5, -1).otherwise(0))
    rows = masks.remove_incomplete_lists(rows, [*dict.fromkeys([*partition, "list"])])
    if baseline is not None and baseline is not False and (isinstance(baseline, dict) or "rectime" in rows.columns):
        named = [F.col("experiment").contains(name) for name in WITH_BASELINE]
        takes = F.coalesce((named[0] | named[1]) & ~F.col("experiment").contains(WITHOUT_BASELINE), F.lit(False))
        with_base = retrieval.insert_baseline(rows.where(takes), partition, order, **(baseline if isinstance(baseline, dict) else {}))
        rows = with_base.unionByName(rows.where(~takes), allowMissingColumns=True)
    rows = rows if keep_intrusions else masks.remove_intrusions(rows, partition, order)
    return rows.transform(recall_outcome).transform(normalize_fr)


def clean_pal(df: DataFrame, keys: list[str], seed: int = 0) -> DataFrame:
    """The paired-associates branch: responses only, surrogate times for retrieval rows, words for study pairs."""
    rows = df.transform(masks.remove_negative_offsets).transform(masks.remove_practice_lists).transform(masks.subset_pal).transform(masks.remove_nonresponses)
    study = rows.where(masks.kind("STUDY_PAIR"))
    probes = surrogate_response_times(rows.where(masks.pal_retrieval()), keys, seed)
    return normalize_pal(study.unionByName(probes))


def clean_events(df: DataFrame, partition: list[str], order: list[str], seed: int = 0, baseline: dict | bool | None = True, recording: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """(events, stim rows) of a table that may hold free recall and paired associates. A column trial stands for list. Rows
    without a subject get their recording's: of the same ``recording`` columns, by default the event file (``file``) where
    the table has it, else the partition without its subject. baseline: see ``clean_fr``."""
    if recording is None:
        recording = ["file"] if "file" in df.columns else [k for k in partition if k != "subject"]
    named = fill_subject(trial_column(df), recording) if "subject" in df.columns and recording else trial_column(df)
    events, stim = separate_stim(named)
    pal = F.col("experiment").contains("PAL")
    parts = [clean_fr(events.where(~pal), partition, order, baseline=baseline)]
    if {"correct", "RT"} <= set(df.columns):
        parts.append(clean_pal(events.where(pal), partition, seed))
    return union_sessions(parts), stim


def training_events(df: DataFrame, partition: list[str], order: list[str], encoding_only: bool = False, baseline: dict | bool | None = True, recording: list[str] | None = None) -> DataFrame:
    """Record-only experiments, cleaned and combined, as word (and retrieval) rows. With baseline, retrieval rows are recalls
    that found a match, and their matches."""
    events, _ = clean_events(df.where(F.col("experiment").isin("FR1", "catFR1", "PAL1")), partition, order, baseline=None if encoding_only else baseline, recording=recording)
    return events.where(masks.word_event(events, encoding_only))


def trial_column(df: DataFrame) -> DataFrame:
    """list from trial where the table has trials."""
    return df.withColumn("list", F.coalesce("trial", "list")).drop("trial") if "trial" in df.columns else df


def test_events(df: DataFrame, partition: list[str], order: list[str], joint: str | None = None, step: int = 100, baseline: dict | bool | None = True, recording: list[str] | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(all events without practice and with their list's phase, word and retrieval rows, stim rows), from one scan.

    joint: a series, such as "5", whose free recall (FR5) and categorised free recall (catFR5) are tested together; a
    subject's categorised sessions are raised by ``step`` where it has both, as ``union_experiments`` does for one subject."""
    from mnesis.operators import sequence

    if joint is not None:
        df = raised_sessions(df.where(F.col("experiment").isin(f"FR{joint}", f"catFR{joint}")), f"catFR{joint}", step)
    everything = sequence.list_phase(masks.remove_negative_offsets(df).where("list > -1"), [*partition, "list"], order)
    events, stim = clean_events(df, partition, order, baseline=baseline, recording=recording)
    return everything, events.where(masks.word_event(events, encoding_only=False)), stim


def raised_sessions(df: DataFrame, experiment: str, step: int = 100) -> DataFrame:
    """Sessions of an experiment raised by step for the subjects that have others, too."""
    other = F.max((F.col("experiment") != experiment).cast("int")).over(Window.partitionBy("subject"))
    return df.withColumn("session", F.col("session") + F.when((F.col("experiment") == experiment) & (other == 1), step).otherwise(0))
