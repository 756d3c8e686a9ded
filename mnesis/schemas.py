"""Schemas and parameters."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

#: Event columns by the flags that ask for them.
BASE_LONG = ["serialpos", "session", "rectime", "mstime", "eegoffset", "recalled", "intrusion", "montage", "list", "stim_list", "msoffset", "iscorrect"]
BASE_TEXT = ["subject", "experiment", "type", "phase", "eegfile", "item_name"]

STIM_SITE = T.StructType([
    T.StructField("amplitude", T.DoubleType()), T.StructField("pulse_freq", T.DoubleType()), T.StructField("stim_duration", T.DoubleType()),
    T.StructField("anode_label", T.StringType()), T.StructField("cathode_label", T.StringType()), T.StructField("anode_number", T.IntegerType()),
    T.StructField("position", T.StringType()), T.StructField("biomarker_value", T.DoubleType()), T.StructField("id", T.StringType()),
])

EVENTS = T.StructType([*(T.StructField(c, T.LongType()) for c in BASE_LONG), *(T.StructField(c, T.StringType()) for c in BASE_TEXT)])

STIM_EVENTS = T.StructType([
    *(T.StructField(c, T.LongType()) for c in ("serialpos", "session", "mstime", "eegoffset", "recalled", "list", "stim_list")),
    *(T.StructField(c, T.StringType()) for c in ("subject", "experiment", "type", "phase", "item_name")),
    T.StructField("stim_params", T.ArrayType(STIM_SITE)),
])

PAIR = T.StructType([
    T.StructField("channel_1", T.IntegerType()), T.StructField("channel_2", T.IntegerType()), T.StructField("type_1", T.StringType()),
    T.StructField("atlases", T.StructType([
        T.StructField(a, T.StructType([T.StructField("region", T.StringType()), *(T.StructField(c, T.DoubleType()) for c in "xyz")])) for a in ("stein", "wb", "ind", "mni")
    ])),
])

#: The order in which a session's events stand.
SEQUENCE = ["subject", "session", "list", "eegoffset"]


#: The defaults of the classes of parameters below.
@dataclass(frozen=True)
class FRParameters:
    """Defaults of free-recall analyses; times in seconds, those of baseline periods in milliseconds."""

    encoding_start: float = 0.0
    encoding_end: float = 1.366
    encoding_buffer: float = 1.365
    retrieval_start: float = -0.525
    retrieval_end: float = 0.0
    retrieval_buffer: float = 0.524
    post_stim_start: float = 0.030
    post_stim_end: float = 0.555
    post_stim_buffer: float = 0.524
    lowest: float = 6.0
    highest: float = 180.0
    n_frequencies: int = 8
    width: int = 5
    log_powers: bool = True
    normalize_powers: bool = True
    hfa_cutoff: float = 65.0
    trigger_frequency: int = 110
    penalty: float = 7.2e-4
    n_permutations: int = 200
    encoding_multiplier: float = 4.375
    empty_epoch: int = 500
    pre_event: int = 2000
    post_event: int = 1000
    items_in_list: int = 12

    @property
    def frequencies(self) -> list[float]:
        ratio = self.highest / self.lowest
        return [self.lowest * ratio ** (k / (self.n_frequencies - 1)) for k in range(self.n_frequencies)]

    @property
    def baseline(self) -> dict[str, int]:
        """The settings of baseline insertion."""
        return {"duration": self.empty_epoch, "pre": self.pre_event, "post": self.post_event}

    @property
    def windows(self) -> dict[str, tuple[float, float, float]]:
        """Start, end and buffer of the epochs of each partition of events."""
        return {
            "fr_encoding": (self.encoding_start, self.encoding_end, self.encoding_buffer),
            "fr_retrieval": (self.retrieval_start, self.retrieval_end, self.retrieval_buffer),
            "post_stim": (self.post_stim_start, self.post_stim_end, self.post_stim_buffer),
        }


@dataclass(frozen=True)
class PALParameters(FRParameters):
    pal_start: float = 0.3
    pal_end: float = 2.0
    pal_buffer: float = 1.2
    pal_retrieval_start: float = -0.625
    pal_retrieval_end: float = -0.1
    pal_retrieval_buffer: float = 0.524
    encoding_multiplier: float = 7.2
    pal_multiplier: float = 1.93

    @property
    def windows(self) -> dict[str, tuple[float, float, float]]:
        return super().windows | {
            "pal_encoding": (self.pal_start, self.pal_end, self.pal_buffer),
            "pal_retrieval": (self.pal_retrieval_start, self.pal_retrieval_end, self.pal_retrieval_buffer),
        }


@dataclass(frozen=True)
class PS5Parameters(FRParameters):
    normalize_powers: bool = False


#: Columns that every event table has, and those of stim tables.
EVENT_COLUMNS = ["serialpos", "session", "subject", "rectime", "experiment", "mstime", "type", "eegoffset", "recalled", "intrusion", "montage", "list", "stim_list", "eegfile", "msoffset", "item_name", "iscorrect", "phase", "matched", "is_repeat", "repeats", "item", "trial"]
STIM_COLUMNS = ["subject", "experiment", "session", "list", "stim_list", "mstime", "eegoffset", "item_name", "serialpos", "type", "phase", "stim_params", "recalled"]


def required_columns(all_relevant: bool = False, pal: bool = False, stim: bool = False, cat: bool = False) -> list[str]:
    """The columns that a projection with these flags asks for; all_relevant stands alone, and cat excludes pal."""
    if all_relevant and (pal or stim or cat) or (cat and pal):
        raise ValueError("these flags can't be combined")
    if all_relevant:
        return [*EVENT_COLUMNS, "stim_params", "correct", "category_num", "RT"]
    columns = [*(STIM_COLUMNS if stim else EVENT_COLUMNS), *(["category_num"] if cat else [])]
    return [c for c in columns if c not in ("item_name", "recalled")] + ["correct"] if pal else columns
