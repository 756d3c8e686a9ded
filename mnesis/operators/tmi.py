"""Theta modulation: how channels' change of theta power after stimulation depends on their connectivity to the site."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mnesis.operators import behavior, features, masks, montage, sequence, stats

LEAST_CHANNELS = 10
#: A channel with so many bad events has no change.
MOST_BAD_EVENTS = 20
SESSION = ["subject", "session"]


def channel_change(psd: DataFrame, keys: list[str]) -> DataFrame:
    """t of the paired change from pre to post for each channel."""
    return stats.paired_t(psd, [*keys, "pair_idx"], "pre", "post").select(*keys, "pair_idx", "t_stat")


def design(change: DataFrame, connectivity: DataFrame, distances: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of the regression: (keys, pair_idx, t, distance, logit of connectivity), the stimulated channel left out.
    connectivity and distances: (stim_idx, pair_idx, value), and subject where change has subjects."""
    own = behavior.shared_keys(change, connectivity, distances, among=("subject",))
    c = connectivity.select(*own, "stim_idx", "pair_idx", F.col("value").alias("_c"))
    d = distances.select(*own, "stim_idx", "pair_idx", F.col("value").alias("distance"))
    bound = F.least(F.greatest("_c", F.lit(1e-6)), F.lit(1 - 1e-6))
    rows = change.join(c, [*own, "stim_idx", "pair_idx"]).join(d, [*own, "stim_idx", "pair_idx"]).where("stim_idx <> pair_idx AND t_stat IS NOT NULL")
    return rows.select(*keys, "pair_idx", "t_stat", "distance", F.log(bound / (1 - bound)).alias("connectivity"))


def regress(rows: DataFrame, keys: list[str], permutations: int = 1000, seed: int = 0) -> DataFrame:
    """(keys, n, b_distance, b_connectivity, r, z_tmi): least squares of t on distance, connectivity and 1, and the connectivity
    coefficient in population deviations of its values over shuffles of the regressors' rows. A target has some hundred
    channels; targets with under 10 give no row."""
    types = dict(rows.dtypes)

    def fit(own: pd.DataFrame) -> pd.DataFrame:
        own = own.sort_values("pair_idx")
        columns = [*keys, "n", "b_distance", "b_connectivity", "r", "z_tmi"]
        if len(own) < LEAST_CHANNELS:
            return pd.DataFrame({c: [] for c in columns}).astype({k: own[k].dtype for k in keys} | {"n": "int64"})
        x = np.column_stack((own["distance"], own["connectivity"], np.ones(len(own))))
        y = own["t_stat"].to_numpy()
        solve = np.linalg.pinv(x)
        b = solve @ y
        rng = np.random.default_rng(seed)
        # shuffling the regressors' rows is shuffling y against them
        shuffled = np.stack([y[rng.permutation(len(y))] for _ in range(permutations)], axis=1)
        null = (solve @ shuffled)[1]
        spread = null.std()
        r = np.corrcoef(x @ b, y)[0, 1]
        return pd.DataFrame([[*(own[k].iloc[0] for k in keys), len(own), b[0], b[1], r, (b[1] - null.mean()) / spread if spread > 0 else np.nan]], columns=columns)

    schema = ", ".join([*(f"`{k}` {types[k]}" for k in keys), "n long, b_distance double, b_connectivity double, r double, z_tmi double"])
    return rows.groupBy(*keys).applyInPandas(fit, schema)


def target_table(stim: DataFrame, tmi: DataFrame) -> DataFrame:
    """Distinct stimulation parameters with the TMI of their target; targets without one are left out."""
    return stim.distinct().join(tmi, "stim_idx").where(F.col("z_tmi").isNotNull())


def both_ways(edges: DataFrame, value: str) -> DataFrame:
    """Edges i < j of a subject as (subject, stim_idx, pair_idx, value), each in both directions."""
    ends = F.explode(F.array(F.struct(F.col("i").alias("stim_idx"), F.col("j").alias("pair_idx")), F.struct(F.col("j").alias("stim_idx"), F.col("i").alias("pair_idx"))))
    return edges.select("subject", ends.alias("e"), F.col(value).alias("value")).select("subject", "e.*", "value")


def resting_connectivity(resting: DataFrame, chunks: DataFrame, samplerate: float, experiments: tuple[str, ...] = ("FR1", "catFR1", "LocationSearch", "RepFR1"), low: float = 4.0, high: float = 13.0) -> DataFrame:
    """(subject, i, j, coherence) over seconds of rest: of each subject's sessions of the first of ``experiments`` that it has,
    three seconds after every countdown's start, and one after other rows. resting: (subject, experiment, session, event_id,
    type, mstime, eegfile, eegoffset)."""
    seconds = sequence.resting_epochs(features.by_priority(resting, experiments), samplerate)
    seconds = seconds.withColumn("event_id", F.xxhash64("subject", "session", "event_id", "eegoffset"))
    epochs = features.cut_epochs(seconds, chunks, 0, 1000).join(seconds.select("event_id", "subject").distinct(), "event_id")
    return features.coherence(epochs, ["subject"], low, high)


def session_design(stim: DataFrame, resting: DataFrame, chunks: DataFrame, pairs: DataFrame, samplerate: float, order: list[str], experiments: tuple[str, ...] = ("FR1", "catFR1", "LocationSearch", "RepFR1"), buffer: int = 50, window: int = 900, duration: int = 500, threshold: float = 1e-4) -> DataFrame:
    """The regression's rows of every session and stimulated pair, from recordings alone: (subject, session, stim_idx,
    pair_idx, t_stat, distance, connectivity).

    stim: rows of all kinds of the stimulation sessions (subject, session, event_id, type, mstime, eegfile, eegoffset,
    anode_label, cathode_label), STIM_ON rows count. chunks: (eegfile, pair_idx, samplerate, chunk_id, samples). pairs:
    (subject, pair_idx, label, x, y, z). Everything is keyed by subject, so pair numbers may repeat over subjects. Events next
    to others don't count, nor do saturated channels of an event, channels that differ in level or spread around stimulation,
    and channels with more than MOST_BAD_EVENTS bad events."""
    on = stim.where(masks.kind("STIM_ON") & (F.coalesce("eegfile", F.lit("")) != ""))
    before, after = (features.stim_epochs(on, chunks, side, buffer, window, duration) for side in (False, True))
    known = on.select("event_id", *SESSION)
    near = sequence.adjacent(on, SESSION, order).select("event_id", "adjacent")
    flat = after.select("event_id", "pair_idx", sequence.saturated(F.col("samples")).alias("flat")).join(near, "event_id", "left")
    bad = flat.select("event_id", "pair_idx", (F.col("flat") | F.coalesce("adjacent", F.lit(False))).alias("bad"))
    psd = features.psd_pair(before, after).join(bad, ["event_id", "pair_idx"]).join(known, "event_id")
    good = psd.where(~F.col("bad"))
    often = psd.groupBy(*SESSION, "pair_idx").agg((F.count_if("bad") > MOST_BAD_EVENTS).alias("often"))
    raw = before.select("event_id", "pair_idx", F.col("samples").alias("pre")).join(after.select("event_id", "pair_idx", F.col("samples").alias("post")), ["event_id", "pair_idx"]).join(known, "event_id")
    artifacts = stats.channel_exclusion(raw, [*SESSION, "pair_idx"], threshold).select(*SESSION, "pair_idx", "excluded")
    change = channel_change(good, SESSION).join(often, [*SESSION, "pair_idx"]).join(artifacts, [*SESSION, "pair_idx"], "left")
    change = change.where(~F.col("often") & ~F.coalesce("excluded", F.lit(False)) & (F.col("t_stat") != 0)).select(*SESSION, "pair_idx", "t_stat")
    label = F.concat_ws("-", "anode_label", "cathode_label").alias("label")
    targets = on.select(*SESSION, label).distinct().join(pairs.select("subject", "label", F.col("pair_idx").alias("stim_idx")), ["subject", "label"]).select(*SESSION, "stim_idx")
    edges = both_ways(resting_connectivity(resting, chunks, samplerate, experiments), "coherence")
    apart = both_ways(montage.pair_distances(pairs, ["subject"]), "adjacency")
    return design(change.join(targets, SESSION), edges, apart, [*SESSION, "stim_idx"])


def session_tmi(*tables, permutations: int = 1000, **settings) -> DataFrame:
    """(subject, session, stim_idx, n, b_distance, b_connectivity, r, z_tmi) of every session, from recordings alone: see
    ``session_design`` for the tables."""
    return regress(session_design(*tables, **settings), [*SESSION, "stim_idx"], permutations)
