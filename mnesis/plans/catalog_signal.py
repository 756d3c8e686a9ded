"""Queries of weights, classifiers, signals, matching and scalar functions; importing this module registers them."""

from __future__ import annotations

from pyspark.sql import functions as F

from mnesis.functions import text
from mnesis.operators import behavior, clean, features, masks, model, montage, retrieval, sequence, stats, tmi
from mnesis.plans import adapters as a
from mnesis.plans.catalog import LIST_KEYS, query, rounded
from mnesis.schemas import FRParameters

#: Log rows as encoding (WORD) and retrieval (REC_EVENT) rows of FR and PAL.
WEIGHT_ROWS = """w AS (SELECT seq, subject, session, CASE experiment WHEN 'PAL1' THEN 'PAL1' ELSE 'FR1' END AS experiment, CASE type WHEN 'WORD' THEN 'WORD' ELSE 'REC_EVENT' END AS type, recalled
  FROM session_log WHERE type IN ('WORD', 'REC_WORD'))"""


def weight_rows(spark, d):
    log = a.session_log(spark, d).where(masks.kind("WORD", "REC_WORD"))
    return log.select("seq", "subject", "session", F.when(F.col("experiment") == "PAL1", "PAL1").otherwise("FR1").alias("experiment"), F.when(masks.encoding(), "WORD").otherwise("REC_EVENT").alias("type"), "recalled")


@query(
    """, c AS (SELECT type, recalled, 1.0 / count(*) AS v FROM w GROUP BY 1, 2), n AS (SELECT *, v / avg(v) OVER () AS v1 FROM c),
    m AS (SELECT *, v1 * CASE type WHEN 'WORD' THEN 4.375 ELSE 1 END AS v2 FROM n), f AS (SELECT type, recalled, v2 / avg(v2) OVER () AS weight FROM m)
    SELECT seq, round(weight, 9) AS weight FROM w JOIN f USING (type, recalled)""",
    a.SESSION_LOG,
    WEIGHT_ROWS,
)
def fr_sample_weights(spark, d):
    return rounded(model.fr_weights(weight_rows(spark, d), [], 4.375), "weight").select("seq", "weight")


@query(
    """, c AS (SELECT experiment, type, recalled, 1.0 / count(*) AS v FROM w GROUP BY 1, 2, 3), n AS (SELECT *, v / avg(v) OVER () AS v1 FROM c),
    m AS (SELECT *, v1 * CASE experiment WHEN 'PAL1' THEN 1.93 ELSE 1 END AS v2 FROM n), o AS (SELECT *, v2 / avg(v2) OVER () AS v3 FROM m),
    p AS (SELECT *, v3 * CASE type WHEN 'WORD' THEN 7.2 ELSE 1 END AS v4 FROM o), f AS (SELECT experiment, type, recalled, v4 / avg(v4) OVER () AS weight FROM p)
    SELECT seq, round(weight, 9) AS weight FROM w JOIN f USING (experiment, type, recalled)""",
    a.SESSION_LOG,
    WEIGHT_ROWS,
)
def pal_sample_weights(spark, d):
    return rounded(model.pal_weights(weight_rows(spark, d), [], 7.2, 1.93), "weight").select("seq", "weight")


def training(spark, d):
    e = a.table(spark, d, "embeddings")
    group = (F.col("vec_id") / 2500).cast("long")  # cohorts of bounded size, as subjects are
    return e.select(
        F.col("vec_id").alias("event_id"), group.alias("subject"), (F.col("vec_id") % 5).alias("session"), F.floor(F.col("vec_id") / 5 % 5).cast("long").alias("list"),
        F.lit("WORD").alias("type"), (F.col("label") % 2).cast("long").alias("recalled"), F.lit(1.0).alias("weight"), F.transform("embedding", lambda x: x.cast("double")).alias("features"),
    )


@query()
def loso_cv(spark, d):
    return model.summary(model.cross_validate(training(spark, d), ["subject"], "session"), ["subject"]).drop("p_value")


@query()
def lolo_cv(spark, d):
    return model.summary(model.cross_validate(training(spark, d), ["subject"], "list"), ["subject"]).drop("p_value")


def by_score(spark, d):
    """Items with scores that tie, numbered."""
    order = ["orderkey", "serialpos", "shipdate", "partkey", "session", "price"]
    return a.items(spark, d).select("subject", "experiment", "recalled", F.round(F.col("classifier_output") * 3 + F.col("serialpos")).cast("double").alias("score"), F.concat_ws("|", *order).alias("n"))


@query(
    """, t AS (SELECT subject, recalled, round(classifier_output * 3 + serialpos) AS score FROM items), r AS (SELECT *, rank() OVER (PARTITION BY subject ORDER BY score) + (count(*) OVER (PARTITION BY subject, score) - 1) / 2 AS k FROM t)
    SELECT subject, round((sum(k) FILTER (recalled = 1) - count(*) FILTER (recalled = 1) * (count(*) FILTER (recalled = 1) + 1) / 2) / (count(*) FILTER (recalled = 1) * count(*) FILTER (recalled <> 1)), 9) AS auc, 201 AS n FROM r GROUP BY 1""",
    a.ITEMS,
)
def permuted_aucs(spark, d):
    """The true AUC, and how many were drawn, from ranks that are made once."""
    got = stats.permuted_aucs(by_score(spark, d), ["subject"], "score", "recalled", ["experiment"], 200, tie="n")
    return got.groupBy("subject").agg(F.round(F.max(F.when(F.col("perm") == 0, F.col("auc"))), 9).alias("auc"), F.count("auc").cast("int").alias("n"))


@query()
def permuted_lolo(spark, d):
    """Leaving out lists, with outcomes shuffled within lists 200 times."""
    rows = training(spark, d)
    scored = model.cross_validate(rows, ["subject"], "list").join(rows.select("event_id", "session", "list"), "event_id")
    aucs = stats.permuted_aucs(scored, ["subject"], "probability", "outcome", ["session", "list"], FRParameters().n_permutations)
    return stats.permutation_pvalue(aucs.where("perm > 0"), aucs.where("perm = 0").drop("perm"), ["subject"])


@query()
def perm_cv(spark, d):
    cv = model.cross_validate(training(spark, d), ["subject"], "session", permutations=FRParameters().n_permutations, permute_training=True)
    return stats.auc(cv, ["subject", "perm"], "probability", "outcome")


@query()
def perm_pvalue(spark, d):
    rows = training(spark, d)
    true = model.cross_validate(rows, ["subject"], "session")
    cv = model.cross_validate(rows, ["subject"], "session", permutations=FRParameters().n_permutations, permute_training=True)
    own, shuffled = stats.auc(true, ["subject"], "probability", "outcome"), stats.auc(cv.where("perm > 0"), ["subject", "perm"], "probability", "outcome")
    return stats.permutation_pvalue(shuffled, own, ["subject"])


@query()
def trained_models(spark, d):
    rows = training(spark, d)
    models = model.train(rows, ["subject"])
    scored = model.predict(rows.drop("list", "type", "weight"), models, ["subject"])
    return scored.select("event_id", F.round("probability", 6).alias("probability"))


def epochs(spark, d):
    """The embeddings as epochs of 64 samples at 128 a second, 8 of them for each event."""
    e = a.table(spark, d, "embeddings")
    return e.select(F.floor(F.col("vec_id") / 8).alias("event_id"), (F.col("vec_id") % 8).cast("int").alias("pair_idx"), (F.floor(F.col("vec_id") / 8) % 5).alias("session"), F.transform("embedding", lambda x: x.cast("double")).alias("samples"), F.lit(128.0).alias("samplerate"))


@query()
def morlet_powers(spark, d):
    fast = epochs(spark, d).withColumn("samplerate", F.lit(512.0))
    return features.powers(fast, ["event_id", "pair_idx"], FRParameters().frequencies, buffer=0.0625)


@query()
def normalized_powers(spark, d):
    fast = epochs(spark, d).withColumn("samplerate", F.lit(512.0))
    return features.normalized_powers(fast, FRParameters().frequencies, ["session"], buffer=0.0625)


#: Samples of ``epochs`` with their place.
SAMPLES = """samples AS (SELECT vec_id, vec_id // 8 AS event_id, CAST(vec_id % 8 AS INTEGER) AS pair_idx, (vec_id // 8) % 5 AS session, j, x, avg(x) OVER (PARTITION BY vec_id) AS m
  FROM (SELECT vec_id, unnest(range(64)) AS j, CAST(unnest(embedding) AS DOUBLE) AS x FROM embeddings))"""


def tapers_sql() -> str:
    """The tapers of multitaper_psd as rows (taper, j, w)."""
    rows = [f"SELECT {n} AS taper, unnest(range(64)) AS j, unnest({[float(v) for v in taper]}) AS w" for n, taper in enumerate(features.slepian(64, 2.0, 3))]
    return "tapers AS (" + " UNION ALL ".join(rows) + ")"


@query(
    """, z AS (SELECT event_id, pair_idx, taper, k, sum(x * w * cos(2 * pi() * k * j / 64)) AS re, sum(x * w * sin(2 * pi() * k * j / 64)) AS im FROM samples JOIN tapers USING (j) JOIN (SELECT unnest([3, 4]) AS k) ON true GROUP BY ALL),
    s AS (SELECT event_id, pair_idx, k, avg(re * re + im * im) AS p FROM z GROUP BY ALL) SELECT event_id, pair_idx, round(avg(log10(p / 128 + 1e-12)), 6) AS power FROM s GROUP BY ALL""",
    SAMPLES,
    tapers_sql(),
)
def psd_multitaper(spark, d):
    return rounded(features.multitaper_psd(epochs(spark, d), ["event_id", "pair_idx"]), "power", digits=6)


@query(
    """, z AS (SELECT session, event_id, pair_idx, k, sum((x - m) * h * cos(2 * pi() * k * j / 64)) AS re, -sum((x - m) * h * sin(2 * pi() * k * j / 64)) AS im
      FROM (SELECT *, 0.5 - 0.5 * cos(2 * pi() * j / 63) AS h FROM samples) JOIN (SELECT unnest(range(2, 7)) AS k) ON true GROUP BY ALL),
    a AS (SELECT session, pair_idx, k, sum(re * re + im * im) AS p FROM z GROUP BY ALL),
    c AS (SELECT x.session, x.k, x.pair_idx AS i, y.pair_idx AS j, sum(x.re * y.re + x.im * y.im) AS u, sum(x.im * y.re - x.re * y.im) AS v FROM z x JOIN z y ON x.session = y.session AND x.event_id = y.event_id AND x.k = y.k AND x.pair_idx < y.pair_idx GROUP BY ALL)
    SELECT c.session, c.i, c.j, round(avg(sqrt(u * u + v * v) / sqrt(ai.p * aj.p)), 6) AS coherence FROM c JOIN a ai ON ai.session = c.session AND ai.k = c.k AND ai.pair_idx = c.i JOIN a aj ON aj.session = c.session AND aj.k = c.k AND aj.pair_idx = c.j GROUP BY ALL""",
    SAMPLES,
)
def coherence(spark, d):
    return rounded(features.coherence(epochs(spark, d), ["session"]), "coherence", digits=6)


@query(
    """SELECT event_id, value FROM (SELECT e.event_id, (SELECT sum(f.value) FROM r f WHERE f.n BETWEEN e.n - 2 AND e.n + 3 HAVING count(*) = 6) AS value FROM r e WHERE e.n >= 2) WHERE value IS NOT NULL""",
    "r AS (SELECT event_id, round(value * 100) AS value, event_id AS n FROM events)",
)
def epoch_cutting(spark, d):
    """A recording of one sample an event, in chunks of 50, cut from 2 samples before each event to 3 after."""
    e = a.table(spark, d, "events").select("event_id", F.round(F.col("value") * 100).alias("v"))
    chunks = e.groupBy(F.floor(F.col("event_id") / 50).alias("chunk_id")).agg(F.sort_array(F.collect_list(F.struct("event_id", "v"))).alias("s"))
    chunks = chunks.select(F.lit("f").alias("eegfile"), F.lit(0).alias("pair_idx"), F.lit(1000.0).alias("samplerate"), "chunk_id", F.transform("s", lambda x: x["v"]).alias("samples"))
    cut = features.cut_epochs(e.select("event_id", F.lit("f").alias("eegfile"), F.col("event_id").alias("eegoffset")), chunks, -2, 4)
    return cut.select("event_id", F.aggregate("samples", F.lit(0.0), lambda s, x: s + x).alias("value"))


def theta_design(spark, d):
    p = a.powers(spark, d)
    psd = p.withColumn("pair_idx", F.col("pair_idx") * 4 + (F.col("freq_idx") % 4)).groupBy("session", "pair_idx", "event_id").agg(F.min("power").alias("pre"), F.max("power").alias("post"))
    change = tmi.channel_change(psd, ["session"]).withColumn("stim_idx", F.lit(0))
    channels = p.select((F.col("pair_idx") * 4 + (F.col("freq_idx") % 4)).alias("pair_idx")).distinct()
    value = lambda c: channels.select(F.lit(0).alias("stim_idx"), "pair_idx", c.alias("value"))
    return tmi.design(change, value((F.col("pair_idx") * 7 % 31 + 1) / 33), value(F.exp(-F.col("pair_idx") / 20)), ["session"])


@query()
def theta_modulation(spark, d):
    return tmi.regress(theta_design(spark, d), ["session"])


@query(
    """, p AS (SELECT session, pair_idx * 4 + freq_idx % 4 AS pair_idx, event_id, max(power) - min(power) AS change FROM powers GROUP BY ALL),
    t AS (SELECT session, pair_idx, avg(change) / (stddev_samp(change) / sqrt(count(*))) AS t FROM p WHERE pair_idx <> 0 GROUP BY ALL),
    x AS (SELECT *, exp(-pair_idx / 20.0) AS e, ln((pair_idx * 7 % 31 + 1) / 33.0 / (1 - (pair_idx * 7 % 31 + 1) / 33.0)) AS c FROM t),
    m AS (SELECT session, count(*) AS n, var_pop(e) AS ee, var_pop(c) AS cc, covar_pop(e, c) AS ec, covar_pop(e, t) AS et, covar_pop(c, t) AS ct FROM x GROUP BY 1)
    SELECT session, n, round((et * cc - ct * ec) / (ee * cc - ec * ec), 6) AS b_distance, round((ct * ee - et * ec) / (ee * cc - ec * ec), 6) AS b_connectivity FROM m""",
    a.POWERS,
)
def theta_coefficients(spark, d):
    """The coefficients that shuffles are compared with; a single shuffle makes no difference to them."""
    return rounded(tmi.regress(theta_design(spark, d), ["session"], permutations=1).select("session", "n", "b_distance", "b_connectivity"), "b_distance", "b_connectivity", digits=6)


@query(
    """, e AS (SELECT session, event_id, pair_idx, avg(x) FILTER (WHERE j BETWEEN 24 AND 31) AS a, avg(x) FILTER (WHERE j BETWEEN 32 AND 39) AS b FROM samples GROUP BY ALL),
    t AS (SELECT session, pair_idx, avg(b - a) / (stddev_samp(b - a) / sqrt(count(*))) AS t_stat FROM e GROUP BY ALL),
    l AS (SELECT session, pair_idx, 0 AS g, a AS x FROM e UNION ALL SELECT session, pair_idx, 1, b FROM e), z AS (SELECT session, pair_idx, g, abs(x - median(x) OVER (PARTITION BY session, pair_idx, g)) AS z FROM l),
    g AS (SELECT session, pair_idx, g, count(*) AS n, avg(z) AS m, var_pop(z) AS v FROM z GROUP BY ALL),
    w AS (SELECT session, pair_idx, (sum(n) - 2) * (sum(n * m * m) - sum(n * m) * sum(n * m) / sum(n)) / sum(n * v) AS w FROM g GROUP BY ALL)
    SELECT session, pair_idx, round(t_stat, 6) AS t_stat, round(w, 6) AS w FROM t JOIN w USING (session, pair_idx)""",
    SAMPLES,
)
def channel_statistics(spark, d):
    """t and Levene's statistic, from which channel_exclusion takes its p."""
    mean = lambda lo, n: F.aggregate(F.slice("samples", lo, n), F.lit(0.0), lambda s, x: s + x) / n
    ends = epochs(spark, d).select("session", "pair_idx", mean(25, 8).alias("before"), mean(33, 8).alias("after"))
    keys = ["session", "pair_idx"]
    return rounded(stats.paired_t(ends, keys, "before", "after").select(*keys, "t_stat").join(stats.levene(ends, keys, "before", "after").select(*keys, "w"), keys), "t_stat", "w", digits=6)


@query(
    """, p AS (SELECT montage, pair_idx, x * 7 % 50 / 50 AS p, row_number() OVER (PARTITION BY montage ORDER BY x * 7 % 50 / 50, pair_idx) AS r, count(*) OVER (PARTITION BY montage) AS m FROM pairs)
    SELECT montage, pair_idx, p, round(least(1, min(p * m / r) OVER (PARTITION BY montage ORDER BY r ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)), 9) AS adjusted FROM p""",
    a.PAIRS,
)
def adjusted_p(spark, d):
    rows = a.pairs(spark, d).select("montage", "pair_idx", (F.col("x") * 7 % 50 / 50).alias("p"))
    return rounded(stats.benjamini_hochberg(rows, "p", ("montage",)), "adjusted")


def recall_log(spark, d):
    """The log as trials of recall: a trial is a subject's session and list, times count from its start."""
    log = a.session_log(spark, d)
    first = F.min("mstime").over(sequence.Window.partitionBy(*LIST_KEYS))
    rows = log.withColumn("rectime", ((F.col("mstime") - first) / 2000).cast("long"))
    kind = F.when(F.col("rectime") == 0, "REC_START").otherwise("REC_WORD")
    return rows.select("subject", "session", "list", "mstime", F.col("rectime").cast("long").alias("rectime"), kind.alias("type"), F.lit(0).cast("long").alias("intrusion"), F.col("seq"))


@query()
def matched_deliberation(spark, d):
    # a session is a user's month, so that matching stays small however long a user's log is
    log = recall_log(spark, d).withColumn("session", F.concat_ws("-", "session", F.date_format(F.timestamp_millis("mstime"), "yyyyMM")))
    return retrieval.matched_deliberation(log, ["subject", "session"], ["mstime", "seq"], period=45_000, inclusion_before=0, inclusion_after=0)


FREE = """t AS (SELECT subject, session, list, CAST((mstime - min(mstime) OVER (PARTITION BY subject, session, list)) / 2000 AS DOUBLE) AS r0 FROM session_log),
  v AS (SELECT subject, session, list, floor(r0) - 2000 AS lo, floor(r0) + 2000 AS hi, floor(r0) AS r FROM t),
  z AS (SELECT *, max(hi) OVER (PARTITION BY subject, session, list ORDER BY lo, hi ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM v WHERE r > 0),
  g AS (SELECT subject, session, list, greatest(coalesce(reach, 0), 0) AS b, least(lo, 45000) AS e FROM z UNION ALL SELECT subject, session, list, greatest(max(hi), 0), 45000 FROM z GROUP BY 1, 2, 3)"""


@query(
    'SELECT subject, session, list, CAST(b AS BIGINT) AS "begin", CAST(e AS BIGINT) AS "end" FROM g WHERE b < e',
    a.SESSION_LOG,
    FREE,
)
def free_recall_time(spark, d):
    return sequence.vocalization_free(recall_log(spark, d), LIST_KEYS, 45_000, 2000, 2000)


@query(
    """, p AS (SELECT *, CASE WHEN recalled = 1 THEN serialpos * 50 ELSE -999 END AS rt FROM session_log WHERE type = 'REC_WORD'),
    r AS (SELECT subject, session, list_sort(list(rt) FILTER (WHERE recalled = 1 AND rt <> -999)) AS rts FROM p GROUP BY 1, 2),
    q AS (SELECT p.*, CASE WHEN rt <> -999 THEN rt ELSE coalesce(rts[CAST('0x' || substr(md5(subject || '|' || session || '|' || mstime || '|' || seq || '|0'), 1, 8) AS BIGINT) % greatest(coalesce(len(rts), 0), 1) + 1], -999) END AS drawn FROM p JOIN r USING (subject, session))
    SELECT subject, session, seq, mstime, seq + drawn AS eegoffset, recalled AS correct, drawn AS "RT", 'REC_EVENT' AS type FROM q""",
    a.SESSION_LOG,
)
def surrogate_rt(spark, d):
    log = a.session_log(spark, d).where(masks.kind("REC_WORD"))
    rows = log.select("subject", "session", "seq", "mstime", F.col("seq").alias("eegoffset"), F.col("recalled").alias("correct"), F.when(F.col("recalled") == 1, F.col("serialpos") * 50).otherwise(-999).alias("RT"), "type")
    return clean.surrogate_response_times(rows, ["subject", "session"])


@query()
def stim_effect(spark, d):
    from mnesis.operators import stats as s

    t = s.effect_design(a.items(spark, d)).where("in_stim_comparison")
    return rounded(s.stim_effect(t, "is_stim_item", ["list", "pos_1", "pos_2", "pos_3", "pos_4", "pos_5", "pos_6", "pos_7"]), "coefficient", digits=4)


@query()
def channel_exclusion(spark, d):
    e = epochs(spark, d).select("session", "pair_idx", F.slice("samples", 1, 32).alias("pre"), F.slice("samples", 33, 32).alias("post"))
    return stats.channel_exclusion(e, ["session", "pair_idx"], samples=8)


@query()
def choose_location(spark, d):
    rows = a.items(spark, d).select(F.when(F.col("is_stim_list"), "A").otherwise("B").alias("loc_name"), F.col("serialpos").cast("double").alias("amplitude"), F.col("classifier_output").alias("delta_classifier"))
    return stats.choose_location(rows, rows.where("amplitude = 1").select("delta_classifier"))


@query(
    """SELECT c_custkey, split_part(c_name, '#', 1) AS subject, c_nationkey AS montage, right(c_mktsegment, 1) AS series, right(c_mktsegment, 1) <> '1' AS is_stim,
    'A' || c_nationkey || '-B' || c_nationkey || ':C' || c_custkey || '-D' || c_custkey AS tags, array_to_string(list_filter([CAST(c_nationkey % 2 AS VARCHAR), CAST(c_custkey AS VARCHAR)], lambda x: x <> '0'), ',') AS cleaned,
    CASE c_nationkey WHEN 1 THEN 'Hipp' WHEN 2 THEN 'MTL' WHEN 3 THEN 'TC' ELSE 'Other' END AS region, c_mktsegment || '-' || c_name AS tag, lpad(CAST(c_nationkey AS VARCHAR), 3, '0') AS channel,
    coalesce(round(c_acctbal / nullif(c_nationkey, 0), 6), 0) AS ratio FROM customer"""
)
def label_functions(spark, d):
    c = a.table(spark, d, "customer")
    n, k = F.col("c_nationkey").cast("string"), F.col("c_custkey").cast("string")
    sid = F.concat_ws("_", F.split("c_name", "#")[0], n)
    place = F.when(F.col("c_nationkey") == 1, "CA1").when(F.col("c_nationkey") == 2, "EC").when(F.col("c_nationkey") == 3, "middletemporal").otherwise("none")
    return c.select(
        "c_custkey",
        text.subject_of(sid).alias("subject"),
        text.montage_of(sid).alias("montage"),
        text.experiment_series(F.col("c_mktsegment")).alias("series"),
        text.is_stim_experiment(F.col("c_mktsegment")).alias("is_stim"),
        text.join_tags(F.concat(F.lit("A"), n, F.lit(",C"), k), F.concat(F.lit("B"), n, F.lit(",D"), k)).alias("tags"),
        text.without_zeros(F.concat_ws(",", (F.col("c_nationkey") % 2).cast("string"), k)).alias("cleaned"),
        text.region_name(place).alias("region"),
        text.stim_tag(F.col("c_mktsegment"), F.col("c_name")).alias("tag"),
        text.padded_channel(F.col("c_nationkey")).alias("channel"),
        F.round(text.safe_divide(F.col("c_acctbal"), F.col("c_nationkey").cast("double")), 6).alias("ratio"),
    )


@query(
    """, m AS (SELECT DISTINCT channel_1 AS channel FROM pairs UNION SELECT channel_2 FROM pairs) SELECT count(*) AS n, CAST(sum(channel) AS BIGINT) AS total FROM m""",
    a.PAIRS,
)
def monopolar_channels(spark, d):
    return montage.monopolar(a.pairs(spark, d)).agg(F.count("*").alias("n"), F.sum("channel").alias("total"))


@query("SELECT event_id, round(list_sum(list_transform(embedding, lambda x: CAST(x AS DOUBLE))), 6) AS total, 64 AS n FROM (SELECT vec_id AS event_id, embedding FROM embeddings)")
def reshape_powers(spark, d):
    rows = a.table(spark, d, "embeddings").select(F.col("vec_id").alias("event_id"), F.transform("embedding", lambda x: x.cast("double")).alias("features"))
    back = features.as_arrays(features.as_rows(rows, "features", 8), ["event_id"])
    return back.select("event_id", F.round(F.aggregate("features", F.lit(0.0), lambda s, x: s + x), 6).alias("total"), F.size("features").alias("n"))




@query(
    """, w AS (SELECT seq, session, list, serialpos AS item_name FROM session_log WHERE type = 'WORD'),
    s AS (SELECT session, list, serialpos AS item_name, arg_min('A' || category_num, seq) AS stimAnodeTag, arg_min(round(value, 1), seq) AS amplitude FROM session_log WHERE type = 'STIM_ON' GROUP BY 1, 2, 3)
    SELECT w.seq, s.stimAnodeTag, s.amplitude, CASE stimAnodeTag WHEN 'A1' THEN 'Hipp' WHEN 'A2' THEN 'MTL' END AS location FROM w LEFT JOIN s USING (session, list, item_name)""",
    a.SESSION_LOG,
)
def stim_item_table(spark, d):
    log = a.session_log(spark, d).withColumn("item_name", F.col("serialpos"))
    words = log.where(masks.encoding()).select("seq", "session", "list", "item_name")
    stim = log.where(masks.kind("STIM_ON")).select(
        "session", "list", "item_name", F.concat(F.lit("A"), F.col("category_num").cast("string")).alias("stimAnodeTag"), F.lit("C").alias("stimCathodeTag"), F.round("value", 1).alias("amplitude"),
        F.lit(500).alias("stim_duration"), F.lit(200).alias("pulse_freq"), F.col("seq").alias("n"),
    )
    places = spark.createDataFrame([("A1-C", "Hipp"), ("A2-C", "MTL")], "label string, location string")
    return behavior.stim_item_table(words, stim, places, ["n"]).select("seq", "stimAnodeTag", "amplitude", "location")


@query(
    """, g AS (SELECT seq, recalled, lead(mstime) OVER w - mstime AS gap FROM session_log WINDOW w AS (PARTITION BY subject, session ORDER BY mstime, seq)) SELECT seq, gap IS NULL AS is_last FROM g WHERE gap IS NULL""",
    a.SESSION_LOG,
)
def last_events_are_bad(spark, d):
    """With no gap small enough, bad events are the last of each session alone."""
    log = a.session_log(spark, d).withColumn("event_id", F.col("seq"))
    none = epochs(spark, d).where("pair_idx < 0")
    bad = features.bad_events(none, log, ["subject", "session"], a.LOG_ORDER, least_ms=0).where("bad")
    return bad.select(F.col("event_id").alias("seq"), F.lit(True).alias("is_last"))
