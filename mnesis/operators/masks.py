"""Predicates over event rows as boolean columns, and the filters made of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mnesis.schemas import SEQUENCE

#: Event types by role.
MATH_TYPES = ["START", "STOP", "PROB"]
STIM_TABLE_EXCLUDED = ["START", "STOP", "PROB"]
PAL_TYPES = ["STUDY_PAIR", "TEST_PROBE", "PROBE_START"]
RETRIEVAL_TYPES = ["REC_WORD", "REC_BASE", "REC_EVENT"]
VOCAL_TYPES = ["REC_WORD", "REC_WORD_VV"]
LIST_END_TYPES = ["REC_END", "REC_STOP"]


def kind(*types: str) -> Column:
    return F.col("type").isin(*types)


def encoding() -> Column:
    return kind("WORD")


def math() -> Column:
    return kind("PROB")


def vocalization() -> Column:
    return kind(*VOCAL_TYPES)


def baseline_retrieval() -> Column:
    return kind("REC_BASE")


def all_retrieval(df: DataFrame) -> Column:
    """Retrieval rows; where the table knows matches, matched ones only."""
    rows = kind(*RETRIEVAL_TYPES)
    return rows & F.col("matched") if "matched" in df.columns else rows


def word_event(df: DataFrame, encoding_only: bool = True) -> Column:
    return encoding() if encoding_only else encoding() | all_retrieval(df)


def pal_retrieval() -> Column:
    return kind("TEST_PROBE", "PROBE_START")


def recalled() -> Column:
    return F.col("recalled") == 1


def not_recalled() -> Column:
    return F.col("recalled") != 1


def post_stim() -> Column:
    return kind("STIM_OFF") & (F.col("list") > -1)


def stim_list() -> Column:
    return F.col("phase") == "STIM"


def nonstim() -> Column:
    return encoding() & ~stim_list()


def stim_table() -> Column:
    return ~kind(*STIM_TABLE_EXCLUDED) & (F.col("list") > -1)


def in_session(session: int) -> Column:
    return F.col("session") == session


def gap_before(partition: list[str], order: list[str]) -> Column:
    """Milliseconds since the row before, 0 for the first."""
    w = Window.partitionBy(*partition).orderBy(*order)
    return F.coalesce(F.col("mstime") - F.lag("mstime").over(w), F.lit(0))


def fr_retrieval(partition: list[str], order: list[str], least_ms: int = 1000) -> Column:
    """Recalls without intrusion, more than least_ms after the row before. Windows can't stand in a filter: use it in
    ``withColumn`` first."""
    return kind("REC_WORD") & (F.col("intrusion") == 0) & (gap_before(partition, order) > least_ms)


def retrieval_events(df: DataFrame, partition: list[str], order: list[str]) -> DataFrame:
    """Retrieval rows by experiment family: free recall by the pause before, paired associates by type."""
    fr = fr_retrieval(partition, order)
    chosen = F.when(F.col("experiment").contains("FR"), fr).when(F.col("experiment").contains("PAL"), pal_retrieval()).otherwise(False)
    return df.withColumn("_chosen", chosen).where("_chosen").drop("_chosen")


def partitions(df: DataFrame) -> dict[str, Column]:
    """The classes of rows that features are made for; a row can be in two (a STIM_OFF row of PAL1)."""
    pal, retrieval, post = F.col("experiment") == "PAL1", all_retrieval(df), post_stim()
    return {
        "fr_encoding": ~retrieval & ~pal & ~post,
        "fr_retrieval": retrieval & ~pal,
        "pal_encoding": ~retrieval & pal,
        "pal_retrieval": retrieval & pal,
        "post_stim": post,
    }


def select_baseline_retrieval(df: DataFrame, checks=None) -> DataFrame:
    """Baseline rows; with checks (operators.checks) there must be some."""
    rows = df.where(baseline_retrieval())
    return rows if checks is None else checks.some(rows, "no baseline retrieval events")


def select_session(df: DataFrame, session: int, checks=None) -> DataFrame:
    """A session's rows; there must be some."""
    rows = df.where(in_session(session))
    if checks is not None:
        return checks.some(rows, f"no session {session}")
    if rows.isEmpty():
        raise ValueError(f"no session {session}")
    return rows


def remove_negative_offsets(df: DataFrame) -> DataFrame:
    return df.where(F.col("eegoffset") >= 0)


def remove_voice_detection(df: DataFrame) -> DataFrame:
    return df.where(~F.col("type").contains("VOCALIZATION"))


def remove_practice_lists(df: DataFrame, least: int = 0) -> DataFrame:
    return df.where(F.col("list") >= least)


def remove_nonresponses(df: DataFrame) -> DataFrame:
    return df.where(F.col("correct").isin(0, 1))


def subset_pal(df: DataFrame) -> DataFrame:
    return df.where(kind(*PAL_TYPES))


def remove_intrusions(df: DataFrame, partition: list[str], order: list[str]) -> DataFrame:
    """Encoding rows, valid recalls and baseline rows."""
    keep = encoding() | fr_retrieval(partition, order) | baseline_retrieval()
    return df.withColumn("_keep", keep).where("_keep").drop("_keep")


def remove_incomplete_lists(df: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Task rows of lists that have an end, or of list -999; math rows always stay."""
    keys = ["subject", "session", "list"] if keys is None else keys
    ended = df.where(kind(*LIST_END_TYPES)).select(*keys).distinct()
    task = df.where(~kind(*MATH_TYPES))
    whole = task.where("list <> -999").join(ended, keys, "left_semi").select(*df.columns)
    return whole.unionByName(task.where("list = -999")).unionByName(df.where(kind(*MATH_TYPES)))


def subset_powers(powers: DataFrame, events: DataFrame, mask: Column) -> DataFrame:
    return powers.join(events.where(mask).select("event_id"), "event_id", "left_semi")


def has_type(df: DataFrame, name: str, keys: list[str]) -> DataFrame:
    """Whether each group has a row of a type."""
    return df.groupBy(*keys).agg(F.bool_or(F.col("type") == name).alias("has"))


def canonical_order(df: DataFrame) -> DataFrame:
    return df.orderBy(*[c for c in SEQUENCE if c in df.columns], *[c for c in ("mstime", "type") if c in df.columns])
