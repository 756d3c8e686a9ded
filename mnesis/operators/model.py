"""Recall classifiers: sample weights, logistic regression, cross-validation and permutation tests.

A training table has one row for each event: event_id, session, list, type, recalled, weight and an array of features. A
group's rows, which are those of one subject's sessions (some thousand rows of some hundred features), meet in one task, which
fits all its folds; where permutations are fitted, too, blocks of them are tasks of their own.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mnesis.operators import behavior, masks, stats

#: Permutations that one task fits; each task gets the group's rows once.
PERMUTATIONS = 50


def scheme(df: DataFrame, keys: list[str]) -> DataFrame:
    """The weighting scheme of each group: PAL if it has PAL rows, equal for PS5, FR if it has encoding and retrieval rows of
    free recall, else equal."""
    e = F.col("experiment")
    both = F.bool_or(masks.encoding()) & F.bool_or(masks.kind("REC_EVENT"))
    pick = F.when(F.bool_or(e.contains("PAL")) & both, "PAL").when(F.bool_or(e.contains("PS5")), "EQUAL").when(F.bool_or(e.contains("FR")) & both, "FR").otherwise("EQUAL")
    return df.groupBy(*keys).agg(pick.alias("scheme"))


def _classes(pal: bool) -> dict[str, Column]:
    enc, ret = masks.encoding(), masks.kind("REC_WORD", "REC_BASE", "REC_EVENT")
    out = {}
    for group, rows in ({"pal": F.col("experiment") == "PAL1", "fr": F.col("experiment") != "PAL1"} if pal else {"fr": F.lit(True)}).items():
        for name, part in (("enc", enc), ("ret", ret)):
            for outcome in (0, 1):
                out[f"{group}_{name}_{outcome}"] = rows & part & (F.col("recalled") == outcome)
    return out


def _weighted(df: DataFrame, keys: list[str], classes: dict[str, Column], boosts: list[tuple[str, float]]) -> DataFrame:
    """Each row gets the inverse of its class's count, scaled to mean 1 over classes, then boosted and scaled again for each of
    boosts (classes that have the text in their name, factor). Rows outside every class get 1."""
    counts = df.groupBy(*keys).agg(*[F.count(F.when(c, 1)).alias(f"_n_{k}") for k, c in classes.items()])
    inverse = {k: F.coalesce(F.try_divide(F.lit(1.0), F.col(f"_n_{k}").cast("double")), F.lit(0.0)) for k in classes}

    def scaled(values: dict[str, Column]) -> dict[str, Column]:
        mean = sum(values.values(), F.lit(0.0)) / len(values)
        return {k: F.try_divide(v, mean) for k, v in values.items()}

    table = counts.select(*keys, *[v.alias(f"_w_{k}") for k, v in scaled(inverse).items()])
    for text, factor in boosts:
        table = table.select(*keys, *[v.alias(f"_w_{k}") for k, v in scaled({k: F.col(f"_w_{k}") * (factor if text in k else 1.0) for k in classes}).items()])
    rows = df.join(table, keys) if keys else df.join(F.broadcast(table), F.lit(True))  # without keys it is one row
    weight = F.coalesce(*[F.when(c, F.col(f"_w_{k}")) for k, c in classes.items()], F.lit(1.0))
    return rows.withColumn("weight", weight).drop(*[f"_w_{k}" for k in classes])


def equal_weights(df: DataFrame) -> DataFrame:
    return df.withColumn("weight", F.lit(1.0))


def fr_weights(df: DataFrame, keys: list[str], encoding_multiplier: float) -> DataFrame:
    return _weighted(df, keys, _classes(pal=False), [("enc", encoding_multiplier)])


def pal_weights(df: DataFrame, keys: list[str], encoding_multiplier: float, pal_multiplier: float) -> DataFrame:
    return _weighted(df, keys, _classes(pal=True), [("pal", pal_multiplier), ("enc", encoding_multiplier)])


def sample_weights(df: DataFrame, keys: list[str], kind: str, encoding_multiplier: float = 4.375, pal_multiplier: float = 1.93) -> DataFrame:
    if kind == "FR":
        return fr_weights(df, keys, encoding_multiplier)
    if kind == "PAL":
        return pal_weights(df, keys, encoding_multiplier, pal_multiplier)
    if kind == "EQUAL":
        return equal_weights(df)
    raise ValueError(f"{kind}: no such weighting scheme")


def class_of(experiment: np.ndarray, kind: np.ndarray, outcome: np.ndarray, pal: bool) -> np.ndarray:
    """The number of each row's class: its phase, outcome and, with pal, whether it is of paired associates; -1 for none."""
    retrieval = np.isin(kind, masks.RETRIEVAL_TYPES)
    known = (retrieval | (kind == "WORD")) & np.isin(outcome, (0, 1))
    return np.where(known, 4 * (pal & (experiment != "PAL1")) + 2 * retrieval + (outcome == 1), -1)


def weights_in_sample(classes: np.ndarray, pal: bool, encoding_multiplier: float, pal_multiplier: float) -> np.ndarray:
    """As ``fr_weights`` and ``pal_weights``, for the rows of one fold."""
    n = 8 if pal else 4
    count = np.bincount(classes[classes >= 0], minlength=n)
    w = np.divide(1.0, count, out=np.zeros(n), where=count > 0)
    for boost in (1.0, *([np.where(np.arange(n) < 4, pal_multiplier, 1.0)] if pal else []), np.where(np.arange(n) % 4 < 2, encoding_multiplier, 1.0)):
        w = w * boost
        w = w / w.mean() if w.any() else w
    return np.where(classes >= 0, w[classes], 1.0)


def fold_weights(df: DataFrame, keys: list[str], by: str, kind: str, encoding_multiplier: float = 4.375, pal_multiplier: float = 1.93) -> DataFrame:
    """(keys, fold, row's class columns, weight): what a row of a class weighs where a fold is left out. Only counts of
    classes meet: a class's rows outside a fold are all of its rows less the fold's."""
    if kind not in ("FR", "PAL"):
        raise ValueError(f"{kind}: no weights by class")
    fold_of = ["session", "list"] if by == "list" else ["session"]
    retrieval = masks.kind(*masks.RETRIEVAL_TYPES)
    family = F.when(F.col("experiment") == "PAL1", "pal").otherwise("fr") if kind == "PAL" else F.lit("fr")
    phase = F.when(masks.encoding(), "enc").when(retrieval, "ret")
    rows = df.select(*keys, *fold_of, family.alias("family"), phase.alias("phase"), "recalled").where("phase IS NOT NULL AND recalled IN (0, 1)")
    by_fold = rows.groupBy(*keys, *fold_of, "family", "phase", "recalled").agg(F.count("*").alias("n"))
    folds = df.select(*keys, *fold_of).distinct().withColumn("fold", F.row_number().over(Window.partitionBy(*keys).orderBy(*fold_of)) - 1)
    cells = [(f, p, o) for f in (("pal", "fr") if kind == "PAL" else ("fr",)) for p in ("enc", "ret") for o in (0, 1)]
    every = folds.withColumn("_c", F.explode(F.array(*[F.struct(F.lit(f).alias("family"), F.lit(p).alias("phase"), F.lit(o).alias("recalled")) for f, p, o in cells]))).select(*keys, *fold_of, "fold", "_c.*")
    whole = by_fold.groupBy(*keys, "family", "phase", "recalled").agg(F.sum("n").alias("_all"))
    counted = every.join(whole, [*keys, "family", "phase", "recalled"], "left").join(by_fold, [*keys, *fold_of, "family", "phase", "recalled"], "left")
    left = F.coalesce("_all", F.lit(0)) - F.coalesce("n", F.lit(0))
    w = counted.withColumn("weight", F.coalesce(F.try_divide(F.lit(1.0), left.cast("double")), F.lit(0.0)))
    one = Window.partitionBy(*keys, "fold")
    boosts = [F.lit(1.0), *([F.when(F.col("family") == "pal", pal_multiplier).otherwise(1.0)] if kind == "PAL" else []), F.when(F.col("phase") == "enc", encoding_multiplier).otherwise(1.0)]
    for boost in boosts:
        w = w.withColumn("weight", F.col("weight") * boost).withColumn("weight", F.try_divide(F.col("weight"), F.avg("weight").over(one)))
    return w.select(*keys, "fold", "family", "phase", "recalled", "weight")


def fit_logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, c: float, steps: int = 60) -> np.ndarray:
    """Weights and, last, the intercept that minimise |w|^2 / 2 + c * sum of weighted logistic losses, the intercept being
    penalised like a weight, with classes balanced: Newton steps, halved where they don't lower the loss. With fewer rows
    than columns the step is found in the space of rows."""
    x1 = np.hstack((x, np.ones((len(x), 1))))
    sign = np.where(y > 0, 1.0, -1.0)
    share = np.where(y > 0, len(y) / (2 * max((y > 0).sum(), 1)), len(y) / (2 * max((y <= 0).sum(), 1)))
    s = c * weight * share
    w = np.zeros(x1.shape[1])
    loss = lambda v: 0.5 * v @ v + (s * np.logaddexp(0, -sign * (x1 @ v))).sum()
    now = loss(w)
    for _ in range(steps):
        p = 1 / (1 + np.exp(np.clip(sign * (x1 @ w), -500, 500)))
        slope = w - x1.T @ (s * sign * p)
        d = s * p * (1 - p)
        if len(x1) < x1.shape[1]:
            root = np.sqrt(d)[:, None] * x1
            step = slope - root.T @ np.linalg.solve(np.eye(len(x1)) + root @ root.T, root @ slope)
        else:
            step = np.linalg.solve(np.eye(x1.shape[1]) + x1.T @ (d[:, None] * x1), slope)
        size = 1.0
        while loss(w - size * step) > now and size > 1e-8:
            size /= 2
        w = w - size * step
        before, now = now, loss(w)
        if before - now < 1e-12 * max(1.0, abs(now)):
            break
    return w


def train(df: DataFrame, keys: list[str], c: float = 7.2e-4) -> DataFrame:
    """(keys, coefficients, intercept) of a model for each group."""
    types = dict(df.dtypes)

    def fit(own: pd.DataFrame) -> pd.DataFrame:
        own = own.sort_values("event_id")
        w = fit_logistic(np.stack(own["features"].to_numpy()).astype(float), own["recalled"].to_numpy(), own["weight"].to_numpy(), c)
        return pd.DataFrame({**{k: [own[k].iloc[0]] for k in keys}, "coefficients": [w[:-1]], "intercept": [w[-1]]})

    schema = ", ".join([*(f"`{k}` {types[k]}" for k in keys), "coefficients array<double>, intercept double"])
    return df.select(*keys, "event_id", "features", "recalled", "weight").groupBy(*keys).applyInPandas(fit, schema)


def predict(df: DataFrame, models: DataFrame, keys: list[str]) -> DataFrame:
    """probability by each group's model, as a dot product in the plan."""
    rows = df.join(models, keys)
    total = F.aggregate(F.zip_with("features", "coefficients", lambda a, b: a * b), F.lit(0.0), lambda s, v: s + v) + F.col("intercept")
    return rows.withColumn("probability", 1 / (1 + F.exp(-total))).drop("coefficients", "intercept")


def cross_validate(df: DataFrame, keys: list[str], by: str, c: float = 7.2e-4, permutations: int = 0, permute_training: bool = False, seed: int = 0, weights: str | None = None, encoding_multiplier: float = 4.375, pal_multiplier: float = 1.93) -> DataFrame:
    """Out-of-fold probabilities of word rows: (keys, perm, fold, event_id, outcome, probability). by: ``list`` leaves out a
    session's list, ``session`` a session. perm 0 has the true outcomes; in perm 1, 2, ... they are shuffled within session
    (and list) by seed and permutation, for scoring, and with permute_training for learning, too. A task has a group's rows
    once and fits all its folds, for up to ``PERMUTATIONS`` permutations; without permute_training a fold is fit once for all
    of them, and one task does it. weights:
    the scheme (FR or PAL, which need a column experiment; EQUAL) by which a fold's rows are weighed, from the rows outside
    the fold alone and their true outcomes; None takes the column weight as it is."""
    types = dict(df.dtypes)
    fold_of = ["session", "list"] if by == "list" else ["session"]
    rows = df.withColumn("fold", F.dense_rank().over(Window.partitionBy(*keys).orderBy(*fold_of)) - 1)
    parts = permutations // PERMUTATIONS if permute_training else 0
    work = rows.withColumn("_part", F.explode(F.sequence(F.lit(0), F.lit(parts)))) if parts else rows.withColumn("_part", F.lit(0))

    def run(own: pd.DataFrame) -> pd.DataFrame:
        own = own.sort_values("event_id").reset_index(drop=True)
        part, fold = int(own["_part"].iloc[0]), own["fold"].to_numpy()
        perms = range(part * PERMUTATIONS, min((part + 1) * PERMUTATIONS, permutations + 1)) if permute_training else range(permutations + 1)
        true, word = own["recalled"].to_numpy(), (own["type"] == "WORD").to_numpy()
        x = np.stack(own["features"].to_numpy()).astype(float)
        groups = [at for _, at in own.groupby(fold_of, sort=True).indices.items()]
        outcomes = []
        for perm in perms:
            outcome = true.copy()
            if perm:
                rng = np.random.default_rng([seed, perm])
                for at in groups:
                    outcome[at] = true[rng.permutation(at)]
            outcomes.append(outcome)
        classes = class_of(own["experiment"].to_numpy(), own["type"].to_numpy(), true, weights == "PAL") if weights in ("FR", "PAL") else None
        found = []
        for hold in np.unique(fold):
            out = fold == hold
            test = out & word
            if not test.any() or out.all():
                continue
            weight = own["weight"].to_numpy()[~out] if weights is None else np.ones(int((~out).sum()))
            if classes is not None:
                weight = weights_in_sample(classes[~out], weights == "PAL", encoding_multiplier, pal_multiplier)
            w, n = None, int(test.sum())
            for perm, outcome in zip(perms, outcomes, strict=True):
                if w is None or permute_training:
                    w = fit_logistic(x[~out], (outcome if permute_training else true)[~out], weight, c)
                    probability = 1 / (1 + np.exp(-(x[test] @ w[:-1] + w[-1])))
                head = own.loc[test, [*keys, "event_id"]]
                found.append(head.assign(perm=np.int32(perm), fold=np.int32(hold), outcome=outcome[test].astype(np.int64), probability=probability))
        columns = [*keys, "perm", "fold", "event_id", "outcome", "probability"]
        if not found:
            return pd.DataFrame({c: [] for c in columns}).astype({"perm": "int32", "fold": "int32"})
        return pd.concat(found, ignore_index=True)[columns]

    schema = ", ".join([*(f"`{k}` {types[k]}" for k in keys), "perm int, fold int, event_id long, outcome long, probability double"])
    needed = [*dict.fromkeys([*keys, "session", "list"]), "_part", "fold", "event_id", "type", "recalled", *(["weight"] if weights is None else []), *(["experiment"] if weights in ("FR", "PAL") else []), "features"]
    return work.select(*needed).groupBy(*keys, "_part").applyInPandas(run, schema)


def scheme_of_validation(df: DataFrame, keys: list[str]) -> DataFrame:
    """Leave out sessions where there are several, else lists."""
    return df.groupBy(*keys).agg(F.when(F.countDistinct("session") > 1, "session").otherwise("list").alias("by"))


def summary(cv: DataFrame, keys: list[str]) -> DataFrame:
    """AUC, permutation p-value, terciles and the median's interval of each group's cross-validation."""
    true = cv.where("perm = 0")
    own = stats.auc(true, keys, "probability", "outcome")
    shuffled = stats.auc(cv.where("perm > 0"), [*keys, "perm"], "probability", "outcome")
    p = stats.permutation_pvalue(shuffled, own, keys)
    rows = own.join(p, keys, "left") if keys else own.join(p, F.lit(True), "left")
    t, m = stats.terciles(true, keys, "probability", "outcome"), stats.median_interval(true, keys, "probability")
    return rows.join(t, keys).join(m, keys) if keys else rows.join(t, F.lit(True)).join(m, F.lit(True))


def latest_model(registry: DataFrame, keys: list[str]) -> DataFrame:
    """The newest model of each session, a retrained one first."""
    return registry.groupBy(*keys).agg(F.max_by("path", F.struct("is_retrained", "created")).alias("path"))


def with_stored_features(df: DataFrame, models: DataFrame, used: DataFrame) -> DataFrame:
    """df's features cut to the pairs that each recording's stored model uses, in their order. used: (recording, pair_idx) of
    each model; a feature array holds the frequencies of pair 0, then of pair 1, and so on. Recordings are told apart by what
    all three tables have of subject, experiment and session."""
    keys = behavior.shared_keys(df, models, used)
    pairs = used.groupBy(*keys).agg(F.sort_array(F.collect_set("pair_idx")).alias("_p"))
    rows = df.join(pairs, keys).join(models.select(*keys, F.size("coefficients").alias("_n")), keys)
    each = (F.col("_n") / F.size("_p")).cast("int")
    cut = F.flatten(F.transform("_p", lambda k: F.slice("features", k * each + 1, each)))
    return rows.withColumn("features", cut).drop("_p", "_n")


def post_hoc(df: DataFrame, models: DataFrame, retrained: DataFrame | None = None) -> DataFrame:
    """Outputs of each recording's stored model, or of the retrained one of its subject (of the only one, where retrained has
    no subject) where a recording has none. Recordings are told apart by what df and models have of subject, experiment and
    session."""
    keys = behavior.shared_keys(df, models)
    if retrained is None:
        return predict(df, models, keys)
    again = retrained.select(*behavior.shared_keys(df, retrained), F.col("coefficients").alias("_c"), F.col("intercept").alias("_i"))
    own = behavior.shared_keys(df, again)
    every = [*dict.fromkeys([*keys, *own])]
    stored = df.select(*every).distinct().join(models, keys, "left")
    stored = stored.join(again, own, "left") if own else stored.join(again, F.lit(True))
    used = stored.select(*every, F.coalesce("coefficients", "_c").alias("coefficients"), F.coalesce("intercept", "_i").alias("intercept"))
    return predict(df, used, every)
