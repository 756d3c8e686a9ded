"""Statistics of powers, outputs and effects, as grouped aggregates; tails of distributions come from functions.tails."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mnesis.functions import tails


def moments(df: DataFrame, keys: list[str], value: str, flag: Column) -> DataFrame:
    """Counts, means and sample variances of a value where a flag holds (1) and where it doesn't (0)."""
    hit, miss = F.when(flag, F.col(value)), F.when(~flag, F.col(value))
    return df.groupBy(*keys).agg(
        F.count(hit).alias("n1"), F.avg(hit).alias("m1"), F.var_samp(hit).alias("v1"), F.count(miss).alias("n0"), F.avg(miss).alias("m0"), F.var_samp(miss).alias("v0")
    )


def pooled_t() -> Column:
    """Student's t of two samples with a common variance, from the columns of ``moments``; null where it isn't defined."""
    df = F.col("n1") + F.col("n0") - 2
    pooled = F.try_divide((F.col("n1") - 1) * F.col("v1") + (F.col("n0") - 1) * F.col("v0"), df.cast("double"))
    inverse = F.try_divide(F.lit(1.0), F.col("n1").cast("double")) + F.try_divide(F.lit(1.0), F.col("n0").cast("double"))
    return F.try_divide(F.col("m1") - F.col("m0"), F.sqrt(pooled * inverse))


def pair_t_table(powers: DataFrame, lowest: int, highest: int, keys: tuple[str, ...] = ("pair_idx",)) -> DataFrame:
    """Recalled against not recalled, on each pair's mean power over frequencies lowest to highest: t and degrees of freedom."""
    mean = powers.where(F.col("freq_idx").between(lowest, highest)).groupBy(*keys, "event_id", "recalled").agg(F.avg("power").alias("power"))
    return moments(mean, list(keys), "power", F.col("recalled") == 1).select(*keys, pooled_t().alias("t_stat"), (F.col("n1") + F.col("n0") - 2).alias("df"))


def benjamini_hochberg(table: DataFrame, p: str, keys: tuple[str, ...] = ()) -> DataFrame:
    """adjusted: the least p * m / rank over this and all greater p, at most 1. One montage's pairs are a group."""
    own = Window.partitionBy(*keys)
    ties = [c for c in table.columns if c not in (p, *keys)]  # equal p get equal values in any order; reruns agree on it
    ranked = table.withColumns({"_m": F.count(p).over(own), "_r": F.row_number().over(own.orderBy(F.col(p).asc_nulls_last(), *ties))})
    raw = F.col(p) * F.col("_m") / F.col("_r")
    up = own.orderBy(F.desc("_r")).rowsBetween(Window.unboundedPreceding, 0)  # a frame that only grows is one pass
    return ranked.withColumn("adjusted", F.least(F.lit(1.0), F.min(raw).over(up))).drop("_m", "_r")


def delta_hfa_table(pairs: DataFrame, powers: DataFrame, frequencies: list[float], cutoff: float = 65.0, trigger: int = 110, keys: tuple[str, ...] = ()) -> DataFrame:
    """Pairs with t, p and adjusted p of high-frequency power, and of power at the trigger frequency. keys: what tells the
    montages of powers and pairs apart (subject); p is adjusted within each."""
    on = [*keys, "pair_idx"]
    high = next(k for k, f in enumerate(frequencies) if f > cutoff)
    at = next(k for k, f in enumerate(frequencies) if int(f) == trigger)

    def tested(lo: int, hi: int, name: str) -> DataFrame:
        t = pair_t_table(powers, lo, hi, tuple(on)).withColumn("p", tails.t_pvalue("t_stat", F.col("df").cast("double")))
        return benjamini_hochberg(t, "p", keys).select(*on, F.col("t_stat").alias(f"{name}_t_stat"), F.col("adjusted").alias(f"{name}_p_value"))

    return pairs.join(tested(high, len(frequencies) - 1, "hfa"), on, "left").join(tested(at, at, str(trigger)), on, "left")


def target_selection(table: DataFrame, controllability: DataFrame | None = None) -> DataFrame:
    if controllability is None:
        return table.withColumn("controllability", F.lit(None).cast("double"))
    return table.join(controllability, "label", "left")


def by_p(table: DataFrame, k: int | None = None) -> DataFrame:
    rows = table.orderBy(F.col("hfa_p_value").asc_nulls_last(), "pair_idx")
    return rows if k is None else rows.limit(k)


def paired_t(df: DataFrame, keys: list[str], before: str, after: str, least: int = 2) -> DataFrame:
    """t of after - before for each group with at least ``least`` pairs without nulls."""
    d = F.col(after) - F.col(before)
    got = df.groupBy(*keys).agg(F.count(d).alias("n"), F.avg(d).alias("_m"), F.stddev_samp(d).alias("_s")).where(F.col("n") >= least)
    return got.select(*keys, "n", F.try_divide(F.col("_m"), F.col("_s") / F.sqrt(F.col("n").cast("double"))).alias("t_stat"), (F.col("n") - 1).alias("df"))


#: The list number of stimulations before the first list, and how many of them a session's test needs.
ARTIFACT_LIST, LEAST_STIMULATIONS = -999, 30


def stim_tstats(stim: DataFrame, before: DataFrame, after: DataFrame, keys: list[str], before_experiment: bool = True, least: int = LEAST_STIMULATIONS) -> DataFrame:
    """(keys, pair_idx, n, t_stat, p_value) of the paired change of channels' mean levels from before to after stimulation.
    stim: (keys, event_id, list); before and after: (event_id, pair_idx, samples). With before_experiment only stimulations of
    list -999 count, and groups of keys with fewer than ``least`` of them have no rows."""
    events = stim.where(F.col("list") == ARTIFACT_LIST) if before_experiment else stim
    if before_experiment:
        events = events.join(events.groupBy(*keys).agg(F.count("*").alias("_n")).where(F.col("_n") >= least).select(*keys), keys, "left_semi")
    level = lambda t, name: t.select("event_id", "pair_idx", F.try_divide(F.aggregate("samples", F.lit(0.0), lambda s, x: s + x), F.size("samples")).alias(name))
    rows = level(before, "pre").join(level(after, "post"), ["event_id", "pair_idx"]).join(events.select(*keys, "event_id"), "event_id")
    got = paired_t(rows, [*keys, "pair_idx"], "pre", "post")
    return got.select(*keys, "pair_idx", "n", "t_stat", tails.t_pvalue("t_stat", F.col("df").cast("double")).alias("p_value"))


def levene(df: DataFrame, keys: list[str], before: str, after: str) -> DataFrame:
    """Levene's statistic of two columns' spreads about their medians, with its degrees of freedom."""
    long = df.select(*keys, F.explode(F.array(F.struct(F.lit(0).alias("g"), F.col(before).alias("x")), F.struct(F.lit(1).alias("g"), F.col(after).alias("x")))).alias("s")).select(*keys, "s.*").where("x IS NOT NULL")
    middle = long.groupBy(*keys, "g").agg(F.median("x").alias("_mid"))
    z = long.join(middle, [*keys, "g"]).withColumn("z", F.abs(F.col("x") - F.col("_mid")))
    group = z.groupBy(*keys, "g").agg(F.count("z").alias("n"), F.avg("z").alias("m"), F.var_pop("z").alias("v"))
    total = group.groupBy(*keys).agg(
        F.sum("n").alias("N"), F.sum(F.col("n") * F.col("m")).alias("_s"), F.sum(F.col("n") * F.col("m") * F.col("m")).alias("_q"), F.sum(F.col("n") * F.col("v")).alias("_w")
    )
    between = F.col("_q") - F.col("_s") * F.col("_s") / F.col("N")
    return total.select(*keys, ((F.col("N") - 2) * F.try_divide(between, F.col("_w"))).alias("w"), F.lit(1).alias("df1"), (F.col("N") - 2).alias("df2"))


def channel_exclusion(epochs: DataFrame, keys: list[str], threshold: float = 1e-4, samples: int = 350) -> DataFrame:
    """Channels whose level or spread after stimulation differs from before: means of the last samples before and the first
    ones after, a paired t-test and Levene's test, and excluded where either p is under the threshold."""
    mean = lambda a: F.try_divide(F.aggregate(a, F.lit(0.0), lambda s, x: s + x), F.size(a))
    ends = epochs.select(*keys, mean(F.slice("pre", F.greatest(F.size("pre") - samples + 1, F.lit(1)), F.lit(samples))).alias("before"), mean(F.slice("post", 1, samples)).alias("after"))
    t = paired_t(ends, keys, "before", "after").withColumn("p_level", tails.t_pvalue("t_stat", F.col("df").cast("double")))
    v = levene(ends, keys, "before", "after").withColumn("p_spread", tails.f_pvalue("w", F.col("df1").cast("double"), F.col("df2").cast("double")))
    rows = t.select(*keys, "p_level").join(v.select(*keys, "p_spread"), keys)
    return rows.withColumn("excluded", (F.col("p_level") < threshold) | (F.col("p_spread") < threshold))


def auc(df: DataFrame, keys: list[str], score: str, outcome: str) -> DataFrame:
    """Area under the ROC curve by the Mann-Whitney statistic. Scores are counted first, so ties are one row and the running
    sums go over distinct scores."""
    each = df.groupBy(*keys, score).agg(F.sum((F.col(outcome) == 1).cast("long")).alias("p"), F.sum((F.col(outcome) != 1).cast("long")).alias("q"))
    below = Window.partitionBy(*keys).orderBy(score).rowsBetween(Window.unboundedPreceding, -1)
    beaten = F.coalesce(F.sum("q").over(below), F.lit(0)) + F.col("q") / 2
    got = each.withColumn("_u", F.col("p") * beaten).groupBy(*keys).agg(F.sum("_u").alias("u"), F.sum("p").alias("np"), F.sum("q").alias("nq"))
    return got.select(*keys, F.try_divide(F.col("u"), (F.col("np") * F.col("nq")).cast("double")).alias("auc"))


def permuted_aucs(df: DataFrame, keys: list[str], score: str, outcome: str, within: list[str], permutations: int, seed: int = 0, tie: str = "event_id", most: int = 100_000) -> DataFrame:
    """(keys, perm, auc): AUC with true outcomes (perm 0) and with outcomes shuffled within groups of ``within``.

    Distinct scores are ranked once for each group of keys, ties by their mean rank; the ranks of each drawing's hits are
    added up. A group of more than about ``most`` rows is dealt by hash to slices: each drawing first deals the group's hits to
    its slices, as drawing without replacement does, then shuffles within the slice, so a task holds one slice and one
    drawing at a time. tie orders a group's rows, so that reruns draw the same."""
    types, groups = dict(df.dtypes), [*dict.fromkeys([*keys, *within])]
    known = df.where(F.col(score).isNotNull() & F.col(outcome).isNotNull()).select(*groups, score, tie, (F.col(outcome) == 1).cast("int").alias("_hit"))
    each = known.groupBy(*keys, score).agg(F.count("*").alias("_c"))
    below = F.coalesce(F.sum("_c").over(Window.partitionBy(*keys).orderBy(score).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ranks = each.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.col(score).alias("_score"), (below + (F.col("_c") + 1) / 2).alias("_rank"))
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)], F.col(score) == F.col("_score"))
    counts = known.groupBy(*groups).agg(F.count("*").alias("_m")).select(*[F.col(g).alias(f"_g{i}") for i, g in enumerate(groups)], F.ceil(F.col("_m") / most).alias("_k"))
    in_group = reduce(lambda a, b: a & b, [F.col(g).eqNullSafe(F.col(f"_g{i}")) for i, g in enumerate(groups)])
    dealt = known.join(counts, in_group).withColumn("_slice", F.pmod(F.xxhash64(tie), F.col("_k"))).drop(*[f"_g{i}" for i in range(len(groups))])
    sliced = dealt.where("_k > 1").groupBy(*groups, "_slice").agg(F.count("*").alias("_m"), F.sum("_hit").alias("_h"))
    plan = sliced.groupBy(*groups).agg(F.sort_array(F.collect_list(F.struct("_slice", "_m", "_h"))).alias("_plan"))
    plan = plan.select(*[F.col(g).alias(f"_g{i}") for i, g in enumerate(groups)], F.col("_plan._slice").alias("_slices"), F.col("_plan._m").alias("_sizes"), F.aggregate("_plan._h", F.lit(0).cast("long"), lambda x, h: x + h).alias("_hits"))

    def sums(own: pd.DataFrame, drawn_hits: tuple | None = None) -> pd.DataFrame:
        own = own.sort_values(tie)
        hit, at = own["_hit"].to_numpy(), own["_rank"].to_numpy()
        name = zlib.crc32("|".join(str(own[g].iloc[0]) for g in groups).encode())
        if drawn_hits is None:
            rng = np.random.default_rng([seed, name])
            drawn = [float(at @ hit), *(float(at @ rng.permutation(hit)) for _ in range(permutations))]
        else:
            slices, sizes, total = drawn_hits
            whole, number = np.random.default_rng([seed, name]), int(own["_slice"].iloc[0])
            rng, place = np.random.default_rng([seed, name, number]), list(slices).index(number)
            drawn = [float(at @ hit), *(float(rng.permutation(at)[: whole.multivariate_hypergeometric(sizes, total, method="marginals")[place]].sum()) for _ in range(permutations))]
        return pd.DataFrame({**{k: [own[k].iloc[0]] for k in keys}, "_s": [drawn], "_p": [int(hit.sum())], "_n": [len(hit)]})

    def slice_sums(own: pd.DataFrame, its_plan: pd.DataFrame) -> pd.DataFrame:
        return sums(own, (its_plan["_slices"].iloc[0], np.array(its_plan["_sizes"].iloc[0], np.int64), int(its_plan["_hits"].iloc[0])))

    schema = ", ".join([*(f"`{k}` {types[k]}" for k in keys), "_s array<double>, _p long, _n long"])
    ranked = dealt.join(ranks, same).select(*groups, "_slice", "_k", tie, "_hit", "_rank")
    names = [*(f"_g{i}" for i in range(len(groups))), "_number"]
    plans = plan.select("*", F.explode("_slices").alias("_number"))
    whole_groups = ranked.where("_k = 1").groupBy(*groups).applyInPandas(lambda own: sums(own), schema)
    parts = whole_groups.unionByName(ranked.where("_k > 1").groupBy(*groups, "_slice").cogroup(plans.groupBy(*names)).applyInPandas(slice_sums, schema))
    sizes = parts.groupBy(*keys).agg(F.sum("_p").alias("_p"), F.sum("_n").alias("_n"))
    total = parts.select(*keys, F.posexplode("_s").alias("perm", "_s")).groupBy(*keys, "perm").agg(F.sum("_s").alias("_s"))
    rows = total.join(sizes, keys) if keys else total.join(F.broadcast(sizes), F.lit(True))
    beaten, others = F.col("_s") - F.col("_p") * (F.col("_p") + 1) / 2, F.col("_n") - F.col("_p")
    return rows.select(*keys, "perm", F.try_divide(beaten, (F.col("_p") * others).cast("double")).alias("auc"))


def roc_curve(df: DataFrame, keys: list[str], score: str, outcome: str) -> DataFrame:
    """threshold, false and true positive rate for every distinct score, highest first."""
    each = df.groupBy(*keys, F.col(score).alias("threshold")).agg(F.sum((F.col(outcome) == 1).cast("long")).alias("p"), F.sum((F.col(outcome) != 1).cast("long")).alias("q"))
    down = Window.partitionBy(*keys).orderBy(F.desc("threshold")).rowsBetween(Window.unboundedPreceding, 0)
    every = Window.partitionBy(*keys)
    rate = lambda c: F.try_divide(F.sum(c).over(down).cast("double"), F.sum(c).over(every).cast("double"))
    return each.select(*keys, "threshold", rate("q").alias("false_positive_rate"), rate("p").alias("true_positive_rate"))


def terciles(df: DataFrame, keys: list[str], score: str, outcome: str) -> DataFrame:
    """Recall rates of the lowest, middle and highest third of scores (cuts belong to both sides), their percent difference
    from the mean rate, and the median score."""
    cuts = df.groupBy(*keys).agg(F.percentile(score, F.array(F.lit(1 / 3), F.lit(2 / 3))).alias("_c"), F.median(score).alias("median_output"))
    rows = df.join(cuts, keys) if keys else df.join(F.broadcast(cuts), F.lit(True))  # without keys it is one row
    lo, hi = F.col("_c")[0], F.col("_c")[1]
    rate = lambda mask: F.avg(F.when(mask, F.col(outcome)))
    got = rows.groupBy(*keys, "median_output").agg(
        rate(F.col(score) <= lo).alias("low"), rate((F.col(score) >= lo) & (F.col(score) <= hi)).alias("mid"), rate(F.col(score) >= hi).alias("high"), F.avg(outcome).alias("recall_rate")
    )
    change = lambda c: 100 * F.try_divide(F.col(c) - F.col("recall_rate"), F.col("recall_rate"))
    return got.withColumns({f"{c}_diff_from_mean": change(c) for c in ("low", "mid", "high")})


def median_interval(df: DataFrame, keys: list[str], score: str) -> DataFrame:
    """The order statistics that bound the median's 95 % interval, at the zero-based ranks round(n/2 -+ 1.96 sqrt(n)/2), the
    upper one raised by one and no rank beyond the ends."""
    n = df.groupBy(*keys).agg(F.count(score).alias("n"))
    half = 1.96 * F.sqrt(F.col("n").cast("double")) / 2
    ranks = n.select(*keys, F.greatest(F.lit(0), F.bround(F.col("n") / 2 - half)).cast("long").alias("_lo"), F.least(F.col("n") - 1, F.bround(F.col("n") / 2 + half) + 1).cast("long").alias("_hi"))
    placed = df.where(F.col(score).isNotNull()).withColumn("_i", F.row_number().over(Window.partitionBy(*keys).orderBy(score)) - 1)
    rows = placed.join(ranks, keys) if keys else placed.join(F.broadcast(ranks), F.lit(True))
    return rows.groupBy(*keys).agg(F.max(F.when(F.col("_i") == F.col("_lo"), F.col(score))).alias("lower"), F.max(F.when(F.col("_i") == F.col("_hi"), F.col(score))).alias("upper"))


def permutation_pvalue(permuted: DataFrame, observed: DataFrame, keys: list[str]) -> DataFrame:
    """The share of permuted AUCs that reach the observed one."""
    rows = permuted.join(observed.select(*keys, F.col("auc").alias("_own")), keys) if keys else permuted.join(observed.select(F.col("auc").alias("_own")), F.lit(True))
    return rows.groupBy(*keys).agg(F.avg((F.col("auc") >= F.col("_own")).cast("double")).alias("p_value"))


def haufe_activation(powers: DataFrame, weights: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """Each feature's covariance with the model's output: what the covariance matrix times the weights is, without the
    matrix. powers: (keys, event_id, pair_idx, freq_idx, power). weights: (keys, pair_idx, freq_idx, weight). keys: of a model."""
    output = powers.join(weights, [*keys, "pair_idx", "freq_idx"]).groupBy(*keys, "event_id").agg(F.sum(F.col("power") * F.col("weight")).alias("_y"))
    return powers.join(output, [*keys, "event_id"]).groupBy(*keys, "pair_idx", "freq_idx").agg(F.covar_samp("power", "_y").alias("activation"))


def activation_by_region(activation: DataFrame, pairs: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    return activation.join(pairs.select(*keys, "pair_idx", "region"), [*keys, "pair_idx"]).groupBy(*keys, "region", "freq_idx").agg(F.avg("activation").alias("activation"))


def reduce_powers(powers: DataFrame, pairs: DataFrame | None = None, frequencies: DataFrame | None = None, keys: tuple[str, ...] = ()) -> DataFrame:
    """Powers of the pairs (keys, pair_idx) and frequencies (freq_idx) that the masks hold; no mask keeps all."""
    rows = powers if pairs is None else powers.join(pairs.select(*keys, "pair_idx").distinct(), [*keys, "pair_idx"], "left_semi")
    rows = rows if frequencies is None else rows.join(frequencies.select("freq_idx").distinct(), "freq_idx", "left_semi")
    return rows.select(*powers.columns)


def covariance(powers: DataFrame, keys: list[str]) -> DataFrame:
    """Sample covariances of the features of each group, as a list of (i, j, value) with i <= j, over the events that have
    all of a group's features. Each slice of events becomes one row for each pair of features, however many events it has."""
    feature = F.struct((F.col("pair_idx") * 1000 + F.col("freq_idx")).cast("long").alias("f"), F.col("power").cast("double").alias("x"))
    rows = powers.groupBy(*keys, "event_id").agg(F.sort_array(F.collect_list(feature)).alias("v"))
    types = dict(powers.dtypes)
    rows = rows.select(*keys, F.transform("v", lambda v: v["f"]).alias("f"), F.transform("v", lambda v: v["x"]).alias("x"))

    def products(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for own, part in frame.groupby([*keys, frame["f"].map(tuple)], sort=False):
                f, x = np.array(own[-1]), np.stack(part["x"].to_numpy())
                i, j = np.triu_indices(len(f))
                total, cross = x.sum(axis=0), x.T @ x
                yield pd.DataFrame({**dict(zip(keys, own[:-1], strict=True)), "i": f[i], "j": f[j], "n": len(x), "si": total[i], "sj": total[j], "sij": cross[i, j]})

    schema = ", ".join([*(f"`{k}` {types[k]}" for k in keys), "i long, j long, n long, si double, sj double, sij double"])
    sums = rows.mapInPandas(products, schema).groupBy(*keys, "i", "j").agg(*[F.sum(c).alias(c) for c in ("n", "si", "sj", "sij")])
    return sums.select(*keys, "i", "j", F.try_divide(F.col("sij") - F.col("si") * F.col("sj") / F.col("n"), F.col("n") - 1).alias("value"))


def choose_location(rows: DataFrame, sham: DataFrame | None = None, level: float = 0.05, keys: tuple[str, ...] = ()) -> DataFrame:
    """Which of two locations is better, for each group of keys. rows: (keys, loc_name, amplitude, delta_classifier). A
    location's value is its best mean over amplitudes with that amplitude's standard error; a difference that isn't
    significant is a tie, which the lesser error wins; the winner is compared with its group's sham. A group with another
    number of locations has no decision and gets no row."""
    by = rows.groupBy(*keys, "loc_name", "amplitude").agg(F.avg("delta_classifier").alias("m"), (F.stddev_samp("delta_classifier") / F.sqrt(F.count("*").cast("double"))).alias("sem"))
    best = by.groupBy(*keys, "loc_name").agg(F.max_by(F.struct("m", "sem", "amplitude"), F.struct("m", "amplitude")).alias("b"))
    two = best.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("loc_name", "b"))).alias("l")).where(F.size("l") == 2).select(*keys, F.col("l")[0].alias("x"), F.col("l")[1].alias("y"))
    t = F.try_divide(F.col("x.b.m") - F.col("y.b.m"), F.sqrt(F.pow("x.b.sem", F.lit(2)) + F.pow("y.b.sem", F.lit(2))))
    got = two.withColumn("t_stat", t).withColumn("p_val", tails.normal_lower(-F.abs("t_stat"))).withColumn("tie", (F.coalesce(F.col("p_val"), F.lit(1.0)) >= level).cast("int"))
    first = F.when(F.col("tie") == 0, F.col("t_stat") > 0).otherwise(F.col("x.b.sem") < F.col("y.b.sem"))
    got = got.withColumn("_w", F.when(first, F.col("x")).otherwise(F.col("y")))
    out = got.select(*keys, "t_stat", "p_val", "tie", F.col("_w.loc_name").alias("best_location"), F.col("_w.b.m").alias("_m"), F.col("_w.b.sem").alias("_s"))
    if sham is None:
        return out.drop("_m", "_s")
    control = sham.groupBy(*keys).agg(F.avg("delta_classifier").alias("sham_mean"), (F.stddev_samp("delta_classifier") / F.sqrt(F.count("*").cast("double"))).alias("sham_sem"))
    rows = (out.join(control, list(keys), "left") if keys else out.join(control, F.lit(True))).withColumn("t_stat_sham", F.try_divide(F.col("_m") - F.col("sham_mean"), F.sqrt(F.pow("_s", F.lit(2)) + F.pow("sham_sem", F.lit(2)))))
    return rows.withColumn("p_val_sham", tails.normal_lower(-F.abs("t_stat_sham"))).drop("_m", "_s")


def effect_design(items: DataFrame, least_list: int = 4) -> DataFrame:
    """The design table of stimulation effects: session index, positions and lists from 0, lists as a share of those there,
    one column for each position, and which rows each comparison takes."""
    # numbered in two steps, so that no task has the sessions of all subjects
    names = items.select("subject", "experiment", "session").distinct()
    ahead = names.groupBy("subject").agg(F.count("*").alias("_k")).withColumn("_k", F.sum("_k").over(Window.orderBy("subject").rowsBetween(Window.unboundedPreceding, -1)))
    inside = Window.partitionBy("subject").orderBy("experiment", "session")
    sessions = names.withColumn("_i", F.row_number().over(inside) - 1).join(ahead, "subject").withColumn("session_idx", (F.col("_i") + F.coalesce("_k", F.lit(0))).cast("int")).drop("_i", "_k")
    low_pos = items.agg(F.min("serialpos").alias("_p"), F.max("serialpos").alias("_q"))
    later = items.where(F.col("list") >= least_list)
    lists = later.agg(F.min("list").alias("_l"), F.countDistinct("list").alias("_n"))
    rows = later.join(sessions, ["subject", "experiment", "session"]).join(F.broadcast(low_pos), F.lit(True)).join(F.broadcast(lists), F.lit(True))
    rows = rows.withColumns({"serialpos": F.col("serialpos") - F.col("_p"), "list": (F.col("list") - F.col("_l")) / F.col("_n"), "low_biomarker": F.col("classifier_output") < F.col("thresh")})
    rows = rows.withColumns({f"pos_{k}": (F.col("serialpos") == k).cast("int") for k in range(12)})
    control = lambda own: F.col(own) | F.col("low_biomarker")
    return rows.withColumns({"in_stim_comparison": control("is_stim_item"), "in_post_stim_comparison": control("is_post_stim_item")}).drop("_p", "_q", "_l", "_n")


def stim_effect(design: DataFrame, comparison: str, features: list[str]) -> DataFrame:
    """Logistic regression of recall on a comparison's flag and the design's columns, over rows that have them all: (term,
    coefficient). One fit of ``stim_effects``: rows are counted by cell once, and steps go over cells."""
    got = stim_effects(design.na.drop(subset=features), features, {"all": []}, {comparison: None})
    return got.select(F.when(F.col("term") == "flag", comparison).otherwise(F.col("term")).alias("term"), "coefficient")


#: A comparison of stimulation: its flag, and which rows of the design take part.
COMPARISONS = {"is_stim_list": None, "is_stim_item": "in_stim_comparison", "is_post_stim_item": "in_post_stim_comparison"}


def effect_cells(design: DataFrame, features: list[str], levels: dict[str, list[str]], comparisons: dict[str, str | None] | None = None) -> DataFrame:
    """Recalls by cell: (level, the levels' columns, comparison, flag, features, n, y). All comparisons are counted in one pass
    over the design; levels (a name and its columns, each within the one before) are added up from the first's cells."""
    comparisons = COMPARISONS if comparisons is None else comparisons
    keys = [*dict.fromkeys(c for own in levels.values() for c in own)]
    part = F.array_compact(F.array(*[F.when(F.lit(True) if rows is None else F.col(rows), F.struct(F.lit(name).alias("comparison"), F.col(name).cast("int").alias("flag"))) for name, rows in comparisons.items()]))
    named = [F.col(f).cast("double").alias(f) for f in features]
    rows = design.where(F.col("recalled").isNotNull()).select(*keys, *named, "recalled", F.explode(part).alias("c")).select(*keys, "c.*", *features, "recalled")
    by = ["comparison", "flag", *features]
    cells = rows.where(F.col("flag").isNotNull()).groupBy(*keys, *by).agg(F.count("*").alias("n"), F.sum("recalled").alias("y"))
    out = None
    for name, own in levels.items():
        one = cells.groupBy(*own, *by).agg(F.sum("n").alias("n"), F.sum("y").alias("y"))
        one = one.select(F.lit(name).alias("level"), *[(F.col(k) if k in own else F.lit(None)).cast(dict(design.dtypes)[k]).alias(k) for k in keys], *by, "n", "y")
        out = one if out is None else out.unionByName(one)
    return out


def stim_effects(design: DataFrame, features: list[str], levels: dict[str, list[str]], comparisons: dict[str, str | None] | None = None, most: int = 100, tolerance: float = 1e-9) -> DataFrame:
    """Logistic regressions of recall on each comparison's flag and features, one for every comparison and group of every
    level, in one job: (level, the levels' columns, comparison, term, coefficient, error, n, converged).

    A fit iterates reweighted sums over its cells, whose number is that of the features' values however many rows there are.
    Terms that don't vary in a group get the least-norm solution; where outcomes are separated, coefficients grow until
    ``most`` steps and converged is false."""
    cells = effect_cells(design, features, levels, comparisons)
    keys = [*dict.fromkeys(c for own in levels.values() for c in own)]
    by, terms = ["level", *keys, "comparison"], ["flag", *features, "intercept"]

    def fit(own: pd.DataFrame) -> pd.DataFrame:
        own = own.sort_values(["flag", *features])
        x = np.column_stack((own[["flag", *features]].to_numpy(np.float64), np.ones(len(own))))
        n, y = own["n"].to_numpy(np.float64), own["y"].to_numpy(np.float64)
        b, done = np.zeros(x.shape[1]), False
        for _ in range(most):
            p = 1 / (1 + np.exp(-np.clip(x @ b, -40, 40)))
            score, spread = x.T @ (y - n * p), (x * (n * p * (1 - p))[:, None]).T @ x
            done = bool(np.abs(score).max() <= tolerance * max(1.0, np.sqrt(n.sum())))  # sums round off by far less than that
            if done:
                break
            b = b + np.linalg.lstsq(spread, score, rcond=1e-12)[0]
        error = np.sqrt(np.clip(np.diag(np.linalg.pinv(spread, hermitian=True)), 0, None))
        head = {k: own[k].iloc[0] for k in by}
        return pd.DataFrame({**{k: [v] * len(terms) for k, v in head.items()}, "term": terms, "coefficient": b, "error": error, "n": int(n.sum()), "converged": done})

    types = dict(cells.dtypes)
    schema = ", ".join([*(f"`{k}` {types[k]}" for k in by), "term string, coefficient double, error double, n long, converged boolean"])
    return cells.groupBy(*by).applyInPandas(fit, schema)


def effect_scores(cells: DataFrame, effects: DataFrame, features: list[str], keys: list[str]) -> DataFrame:
    """(level, keys, comparison, term, score): the sums of x (y - n p) of a fit over its cells, 0 where it is the most likely."""
    by = ["level", *keys, "comparison"]
    weights = effects.groupBy(*by).agg(F.map_from_entries(F.collect_list(F.struct("term", "coefficient"))).alias("b"))
    same = reduce(lambda a, b: a & b, [cells[k].eqNullSafe(weights[k]) for k in by])
    rows = cells.join(weights, same).select(*[cells[k] for k in by], "flag", *features, "n", "y", "b")
    terms = {**{t: F.col(t).cast("double") for t in ("flag", *features)}, "intercept": F.lit(1.0)}
    size = reduce(lambda a, b: a + b, [F.col("b")[t] * x for t, x in terms.items()])
    left = F.col("y") - F.col("n") / (1 + F.exp(-size))
    parts = F.explode(F.array(*[F.struct(F.lit(t).alias("term"), (x * left).alias("s")) for t, x in terms.items()])).alias("t")
    return rows.select(*by, parts).groupBy(*by, "t.term").agg(F.sum("t.s").alias("score"))
