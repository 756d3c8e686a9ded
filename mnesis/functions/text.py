"""Column functions over identifiers, labels and paths."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Regions by location name.
REGIONS = {
    "Hipp": ["CA1", "CA2", "CA3", "DG", "Sub"],
    "MTL": ["PRC", "EC", "PHC"],
    "IFG": ["parsopercularis", "parsorbitalis", "parstriangularis"],
    "MFG": ["caudalmiddlefrontal", "rostralmiddlefrontal"],
    "SFG": ["superiorfrontal"],
    "TC": ["middletemporal", "inferiortemporal", "superiortemporal"],
    "IPC": ["inferiorparietal", "supramarginal"],
    "SPC": ["superiorparietal", "precuneus"],
    "OC": ["lateraloccipital", "lingual", "cuneus", "pericalcarine"],
}


def subject_of(subject_id: Column) -> Column:
    """``S_m`` without its montage number."""
    return F.split(subject_id, "_")[0]


def montage_of(subject_id: Column) -> Column:
    """The montage number of ``S_m``, 0 where there is none."""
    return F.coalesce(F.get(F.split(subject_id, "_"), F.lit(1)).try_cast("int"), F.lit(0))


def experiment_series(experiment: Column) -> Column:
    """The last character of an experiment's name; ``PS2.1`` has series 2.1, an empty name none."""
    return F.when(experiment == "PS2.1", "2.1").when(experiment == "", None).otherwise(F.substring(experiment, -1, 1))


def is_stim_experiment(experiment: Column) -> Column:
    series = F.coalesce(experiment_series(experiment), F.lit(""))
    return experiment.contains("PS5") | experiment.contains("TICL") | (series != "1")


def join_tags(anodes: Column, cathodes: Column) -> Column:
    """Comma lists of anodes and cathodes as ``A1-C1:A2-C2``."""
    return F.array_join(F.zip_with(F.split(anodes, ","), F.split(cathodes, ","), lambda a, c: F.concat_ws("-", a, c)), ":")


def combine_tags(tags: Column) -> Column:
    """``join_tags`` for each (anode, cathode) of an array."""
    return F.transform(tags, lambda t: join_tags(t.anode, t.cathode))


def without_zeros(comma_list: Column) -> Column:
    return F.array_join(F.filter(F.split(comma_list, ","), lambda x: x != "0"), ",")


def session_string(sessions: Column) -> Column:
    """An array of sessions as ``1_2_5``."""
    return F.array_join(F.transform(F.sort_array(sessions), lambda s: s.cast("string")), "_")


def report_path_parts(path: Column) -> Column:
    """subject, montage, experiment, sessions, file_name and file_type of ``S[_m]_EXP_s1[_s2...]_name.ext``."""
    name = F.element_at(F.split(path, "/"), -1)
    part = lambda k: F.regexp_extract(name, r"^([^_]+)_(?:(\d+)_)?([^_]+)((?:_\d+)*)_(.*)$", k)
    sessions = F.transform(F.filter(F.split(part(4), "_"), lambda s: s != ""), lambda s: s.cast("int"))
    file = F.split(part(5), r"\.")
    return F.struct(
        part(1).alias("subject"),
        F.coalesce(part(2).try_cast("int"), F.lit(0)).alias("montage"),
        part(3).alias("experiment"),
        sessions.alias("sessions"),
        file[0].alias("file_name"),
        F.get(file, F.lit(1)).alias("file_type"),
    )


def safe_divide(a: Column, b: Column) -> Column:
    """a / b, and 0 where b is 0."""
    return F.coalesce(F.try_divide(a, b), F.lit(0.0))


def _named(region: Column) -> Column:
    return F.when(~region.isin("", "None"), region)


def atlas_location(pair: Column) -> Column:
    """stein; then wb for depth electrodes; then the side and the individual region; then ``--``. pair: a struct of type_1
    and atlases (stein, wb, ind with region and x)."""
    atlas = pair["atlases"]
    side = F.when(atlas["ind"]["x"] < 0, "Left ").otherwise("Right ")
    return F.coalesce(
        _named(atlas["stein"]["region"]),
        F.when(pair["type_1"] == "D", _named(atlas["wb"]["region"])),
        F.when(atlas["ind"]["x"].isNotNull(), F.concat(side, _named(atlas["ind"]["region"]))),
        F.lit("--"),
    )


def region_name(location: Column) -> Column:
    """The region of a location's name, ``Other`` where none has it."""
    known = F.create_map(*[F.lit(x) for region, names in REGIONS.items() for name in names for x in (name, region)])
    return F.coalesce(F.try_element_at(known, location), F.lit("Other"))


def trigger_frequency(frequency: Column, trigger: int) -> Column:
    return F.floor(frequency) == trigger


def summary_id(subject: Column, experiment: Column, sessions: Column, tag: Column) -> Column:
    """``subject:experiment:s1.s2:tag``."""
    return F.concat_ws(":", subject, experiment, F.array_join(F.transform(sessions, lambda s: s.cast("string")), "."), tag)


def session_id(subject: Column, experiment: Column, session: Column, stim_tag: Column | None = None) -> Column:
    return F.concat_ws(":", subject, experiment, session.cast("string"), *([] if stim_tag is None else [stim_tag]))


def stim_tag(anode: Column, cathode: Column) -> Column:
    return F.concat_ws("-", anode, cathode)


def contact_label(anode: Column, cathode: Column) -> Column:
    return F.concat_ws("_", anode, cathode)


def padded_channel(channel: Column) -> Column:
    return F.lpad(channel.cast("string"), 3, "0")
