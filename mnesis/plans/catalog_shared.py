"""Queries over recordings whose session numbers repeat over subjects; importing this module registers them."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from mnesis.operators import behavior, clean, masks, model, stats
from mnesis.plans import adapters as a
from mnesis.plans.catalog import SETS, query, rounded
from mnesis.plans.catalog_events import CLEAN_FR, CLEAN_PAL, CLEANED, RETRIEVAL

RECORDING = list(behavior.RECORDING)
SESSION = ["subject", "session"]
ORDER = ["mstime", "eegoffset"]
#: The SQL of cleaning over the shared log; a subject's session number is one recording there, too.
SHARED_FR, SHARED_PAL = (sql.replace("full_log", "shared_log") for sql in (CLEAN_FR, CLEAN_PAL))


def nameless(spark, d):
    """The shared log with a third of its subjects missing, but never in a recording's first row."""
    first = F.min("seq").over(Window.partitionBy("file"))
    log = a.shared_log(spark, d).withColumn("subject", F.when((F.col("eegoffset") % 3 == 1) & (F.col("seq") != first), "").otherwise(F.col("subject")))
    return log.drop("seq", "value")


@query("SELECT * FROM clean_fr UNION ALL SELECT * FROM clean_pal", a.FULL_LOG, a.SHARED_LOG, SHARED_FR, SHARED_PAL)
def clean_events_shared(spark, d):
    """Subjects are filled by event file: nobody gets another's rows."""
    return clean.clean_events(nameless(spark, d), SESSION, ORDER, baseline=None)[0].select(*CLEANED)


@query(
    f"SELECT * FROM (SELECT * FROM clean_fr UNION ALL SELECT * FROM clean_pal) WHERE experiment IN ('FR1', 'catFR1', 'PAL1') AND (type = 'WORD' OR ({RETRIEVAL} AND matched))",
    a.FULL_LOG,
    a.SHARED_LOG,
    SHARED_FR,
    SHARED_PAL,
)
def training_events_shared(spark, d):
    return clean.training_events(nameless(spark, d), SESSION, ORDER, baseline=None).select(*CLEANED)


JOINT = """joint_log AS (SELECT * REPLACE (session + CASE WHEN experiment = 'catFR1' AND bool_or(experiment = 'FR1') OVER (PARTITION BY subject) THEN 100 ELSE 0 END AS session)
  FROM shared_log WHERE experiment IN ('FR1', 'catFR1'))"""


@query(f"SELECT * FROM clean_fr WHERE type = 'WORD' OR ({RETRIEVAL} AND matched)", a.FULL_LOG, a.SHARED_LOG, JOINT, CLEAN_FR.replace("full_log", "joint_log"))
def joint_test_events(spark, d):
    """Free recall and categorised free recall of one series, tested together."""
    log = a.shared_log(spark, d).drop("seq", "value")
    return clean.test_events(log, SESSION, ORDER, joint="1", baseline=None)[1].select(*CLEANED)


@query(
    """, m AS (SELECT subject, experiment, session, count(*) AS n_events, count(DISTINCT phase) AS n_phases FROM joint_log WHERE eegoffset >= 0 AND list > -1 GROUP BY ALL) SELECT * FROM m""",
    a.FULL_LOG,
    a.SHARED_LOG,
    JOINT,
)
def joint_all_events(spark, d):
    everything = clean.test_events(a.shared_log(spark, d), SESSION, ["mstime", "seq"], joint="1", baseline=None)[0]
    return everything.groupBy(*RECORDING).agg(F.count("*").alias("n_events"), F.countDistinct("phase").alias("n_phases"))


@query(
    """, w AS (SELECT seq, subject, experiment, session, list, item_name FROM shared_log WHERE type = 'WORD'),
    s AS (SELECT subject, experiment, session, list, item_name, arg_min('A' || category_num, seq) AS stimAnodeTag, arg_min(round(value, 1), seq) AS amplitude FROM shared_log WHERE type = 'STIM_OFF' GROUP BY ALL)
    SELECT w.seq, s.stimAnodeTag, s.amplitude, CASE WHEN stimAnodeTag = 'A1' THEN 'Hipp' || subject WHEN stimAnodeTag = 'A2' THEN 'MTL' || subject END AS location FROM w LEFT JOIN s USING (subject, experiment, session, list, item_name)""",
    a.FULL_LOG,
    a.SHARED_LOG,
)
def stim_item_table_shared(spark, d):
    """Equal session numbers, lists, words and labels of several subjects stay apart."""
    log = a.shared_log(spark, d)
    stim = log.where(masks.kind("STIM_OFF")).select(
        *RECORDING, "list", "item_name", F.concat(F.lit("A"), F.col("category_num").cast("string")).alias("stimAnodeTag"), F.lit("C").alias("stimCathodeTag"), F.round("value", 1).alias("amplitude"),
        F.lit(500).alias("stim_duration"), F.lit(200).alias("pulse_freq"), F.col("seq").alias("n"),
    )
    place = F.explode(F.array(*[F.struct(F.lit(f"{tag}-C").alias("label"), F.concat(F.lit(name), F.col("subject")).alias("location")) for tag, name in (("A1", "Hipp"), ("A2", "MTL"))]))
    places = log.select("subject").distinct().select("subject", place.alias("x")).select("subject", "x.*")
    return behavior.stim_item_table(log.where(masks.encoding()), stim, places, ["n"]).select("seq", "stimAnodeTag", "amplitude", "location")


@query(
    """, e AS (SELECT vec_id AS event_id, vec_id % 3 AS subject, vec_id // 3 % 5 AS session, unnest(range(64)) AS i, CAST(unnest(embedding) AS DOUBLE) AS x FROM embeddings),
    u AS (SELECT *, i // 8 AS pair, i % 8 AS freq FROM e WHERE (i // 8 + session + subject) % 2 = 0), n AS (SELECT *, (dense_rank() OVER (PARTITION BY subject, session ORDER BY pair) - 1) * 8 + freq AS k FROM u)
    SELECT event_id, round(1 / (1 + exp(-(sum(x * ((k + subject) % 5 - 2)) + 0.25))), 9) AS probability FROM n GROUP BY 1""",
    "one AS (SELECT 1)",
)
def stored_outputs_shared(spark, d):
    """Each subject's own model of a session number that others have, too; one subject's are retrained for all its sessions."""
    e = a.table(spark, d, "embeddings").select(F.col("vec_id").alias("event_id"), (F.col("vec_id") % 3).alias("subject"), (F.floor(F.col("vec_id") / 3) % 5).alias("session"), F.transform("embedding", lambda x: x.cast("double")).alias("features"))
    sessions = e.select("subject", "session").distinct()
    used = sessions.withColumn("pair_idx", F.explode(F.sequence(F.lit(0), F.lit(7)))).where("(pair_idx + session + subject) % 2 = 0")
    weights = F.transform(F.sequence(F.lit(0), F.lit(31)), lambda k: ((k + F.col("subject")) % 5 - 2).cast("double"))
    models = sessions.select("subject", "session", weights.alias("coefficients"), F.lit(0.25).alias("intercept"))
    cut = model.with_stored_features(e, models, used)
    retrained = models.where("subject = 2").drop("session").dropDuplicates(["subject"])
    return rounded(model.post_hoc(cut, models.where("subject <> 2"), retrained).select("event_id", "probability"), "probability")


@query(
    """, r AS (SELECT subject, CASE WHEN is_stim_list THEN 'A' ELSE 'B' END AS loc_name, CAST(serialpos AS DOUBLE) AS amplitude, CAST(classifier_output AS DOUBLE) AS d FROM items),
    m AS (SELECT subject, loc_name, amplitude, avg(d) AS m, stddev_samp(d) / sqrt(count(*)) AS sem FROM r GROUP BY ALL),
    b AS (SELECT subject, loc_name, arg_max(m, (round(m, 12), amplitude)) AS m, arg_max(sem, (round(m, 12), amplitude)) AS sem FROM m GROUP BY ALL),
    t AS (SELECT x.subject, x.m AS xm, y.m AS ym, x.sem AS xs, y.sem AS ys, (x.m - y.m) / sqrt(x.sem ** 2 + y.sem ** 2) AS t FROM b x JOIN b y ON x.subject = y.subject AND x.loc_name = 'A' AND y.loc_name = 'B'),
    w AS (SELECT *, CASE WHEN abs(t) > 1.6448536269514722 THEN 0 ELSE 1 END AS tie FROM t), v AS (SELECT *, CASE WHEN tie = 0 THEN t > 0 ELSE xs < ys END AS first FROM w),
    s AS (SELECT subject, avg(d) AS sm, stddev_samp(d) / sqrt(count(*)) AS ss FROM r WHERE amplitude = 1 GROUP BY 1)
    SELECT subject, round(t, 6) AS t_stat, tie, CASE WHEN first THEN 'A' ELSE 'B' END AS best_location, round((CASE WHEN first THEN xm ELSE ym END - sm) / sqrt(CASE WHEN first THEN xs ELSE ys END ** 2 + ss ** 2), 6) AS t_stat_sham
    FROM v JOIN s USING (subject)""",
    a.ITEMS,
)
def choose_location_by_subject(spark, d):
    rows = a.items(spark, d).select("subject", F.when(F.col("is_stim_list"), "A").otherwise("B").alias("loc_name"), F.col("serialpos").cast("double").alias("amplitude"), F.col("classifier_output").cast("double").alias("delta_classifier"))
    got = stats.choose_location(rows, rows.where("amplitude = 1"), keys=("subject",))
    return rounded(got.select("subject", "t_stat", "tie", "best_location", "t_stat_sham"), "t_stat", "t_stat_sham", digits=6)


@query(
    """, g AS (SELECT * FROM spread WHERE list > 3),
    c AS (SELECT subject, CAST(sum(recalled) FILTER (NOT is_stim_list) AS BIGINT) AS lc, count(*) FILTER (NOT is_stim_list) AS ln, CAST(sum(recalled) FILTER (NOT is_stim_item AND classifier_output < thresh) AS BIGINT) AS bc,
      count(*) FILTER (NOT is_stim_item AND classifier_output < thresh) AS bn FROM g GROUP BY 1),
    p AS (SELECT subject, stimAnodeTag, amplitude, CAST(coalesce(sum(recalled) FILTER (is_stim_list), 0) AS BIGINT) AS c1, count(*) FILTER (is_stim_list) AS n1, CAST(coalesce(sum(recalled) FILTER (is_stim_item), 0) AS BIGINT) AS c2,
      count(*) FILTER (is_stim_item) AS n2, CAST(coalesce(sum(recalled) FILTER (is_post_stim_item), 0) AS BIGINT) AS c3, count(*) FILTER (is_post_stim_item) AS n3 FROM g WHERE stimAnodeTag IS NOT NULL GROUP BY 1, 2, 3),
    u AS (SELECT subject, stimAnodeTag, amplitude, unnest(['stim lists', 'stim items', 'post-stim items']) AS comparison, unnest([c1, c2, c3]) AS a, unnest([n1, n2, n3]) AS n, unnest([lc, bc, bc]) AS b, unnest([ln, bn, bn]) AS m FROM p JOIN c USING (subject)),
    x AS (SELECT *, (a + b) / (n + m) AS q FROM u), y AS (SELECT *, (a - n * q) ** 2 / nullif(n * q * (1 - q), 0) + (b - m * q) ** 2 / nullif(m * q * (1 - q), 0) AS chi2 FROM x)
    SELECT subject, stimAnodeTag, amplitude, comparison, a AS stim_correct, n AS stim_items, b AS control_correct, m AS control_items, round(chi2, 6) AS chi2,
      chi2 > 3.841458820694124 AS below_5, chi2 > 6.634896601021213 AS below_1, chi2 > 10.827566170662733 AS below_01 FROM y""",
    a.ITEMS,
    SETS,
)
def recall_tests_by_subject(spark, d):
    """Each subject against its own controls; p-values by the levels that they are below."""
    got = behavior.recall_tests(a.items(spark, d), keys=("subject",))
    below = [(F.col("p_value") < level).alias(f"below_{name}") for level, name in ((0.05, "5"), (0.01, "1"), (0.001, "01"))]
    return got.select("subject", "stimAnodeTag", "amplitude", "comparison", "stim_correct", "stim_items", "control_correct", "control_items", F.round("chi2", 6).alias("chi2"), *below)


@query("SELECT subject, experiment, session, phase, count(*) AS n_stims FROM shared_log WHERE type = 'STIM_ON' GROUP BY ALL", a.FULL_LOG, a.SHARED_LOG.replace("FROM full_log", "FROM (SELECT * REPLACE (CASE type WHEN 'STIM_OFF' THEN 'STIM_ON' ELSE type END AS type) FROM full_log)"))
def stim_counts_shared(spark, d):
    log = a.shared_log(spark, d).withColumn("type", F.when(F.col("type") == "STIM_OFF", "STIM_ON").otherwise(F.col("type")))
    return behavior.stim_count_by_phase(log, tuple(RECORDING))


@query(
    """, w AS (SELECT * FROM shared_log WHERE type = 'WORD'), m AS (SELECT subject, min(serialpos) AS lo, max(serialpos) AS hi FROM w GROUP BY 1),
    b AS (SELECT w.subject, recalled, intrusion, CAST(greatest(1, ceil((serialpos - lo) * 5.0 / (hi - lo))) AS INTEGER) AS bin FROM w JOIN m USING (subject))
    SELECT subject, bin, round(avg(recalled) FILTER (intrusion = -1), 9) AS r0, round(avg(recalled) FILTER (intrusion = 0), 9) AS r1, round(avg(recalled) FILTER (intrusion = 1), 9) AS r2 FROM b GROUP BY 1, 2""",
    a.FULL_LOG,
    a.SHARED_LOG,
)
def binned_recall_by_subject(spark, d):
    rows = a.shared_log(spark, d).where(masks.encoding())
    got = behavior.binned_recall(rows, "serialpos", "intrusion", 5, [-1, 0, 1], keys=("subject",))
    return got.select("subject", "bin", *[F.round(F.col(f"`{k}`"), 9).alias(f"r{k + 1}") for k in (-1, 0, 1)])


@query(
    """, s AS (SELECT o_custkey % 4 AS subject, l_orderkey % 9 AS session, l_partkey AS anode, count(*) AS n_stims, max(l_quantity) AS amplitude FROM lineitem JOIN orders ON o_orderkey = l_orderkey GROUP BY 1, 2, 3)
    SELECT s.subject, session, anode AS anode_number, anode + 1 AS cathode_number, pair_idx AS stim_idx, label, n_stims, amplitude FROM s LEFT JOIN pairs p ON channel_1 = anode AND p.montage % 4 = s.subject""",
    a.PAIRS,
)
def location_targets_shared(spark, d):
    """Contact numbers count within a subject: a target of one is no pair of another."""
    line = a.table(spark, d, "lineitem").join(a.table(spark, d, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    rows = line.select((F.col("o_custkey") % 4).alias("subject"), (F.col("l_orderkey") % 9).alias("session"), F.col("l_partkey").alias("anode_number"), (F.col("l_partkey") + 1).alias("cathode_number"), F.col("l_quantity").alias("amplitude"))
    named = rows.withColumn("event_id", F.struct("subject", "session", "anode_number", "cathode_number", "amplitude"))
    stim = named.select("event_id", "anode_number", "cathode_number", "amplitude").distinct()
    pairs = a.pairs(spark, d).withColumn("subject", F.col("montage") % 4)
    return behavior.location_search_table(named.select("event_id", "subject", "session"), stim, pairs)


EFFECT_LEVELS = {"subject": ["experiment", "subject"], "experiment": ["experiment"], "all": []}
EFFECT_FEATURES = ["list", *(f"pos_{k}" for k in range(1, 7))]


@query(
    """, g AS (SELECT *, classifier_output < thresh AS low FROM items WHERE list >= 4),
    c AS (SELECT experiment, subject, 'is_stim_list' AS comparison FROM g UNION ALL SELECT experiment, subject, 'is_stim_item' FROM g WHERE is_stim_item OR low UNION ALL SELECT experiment, subject, 'is_post_stim_item' FROM g WHERE is_post_stim_item OR low),
    n AS (SELECT ['subject', 'experiment', 'all'][grouping(experiment) + grouping(subject) + 1] AS level, experiment, subject, comparison, count(*) AS n FROM c GROUP BY GROUPING SETS ((comparison, experiment, subject), (comparison, experiment), (comparison)))
    SELECT level, experiment, subject, comparison, term, CAST(0 AS DOUBLE) AS score, n FROM n, (SELECT unnest(['flag', 'list', 'pos_1', 'pos_2', 'pos_3', 'pos_4', 'pos_5', 'pos_6', 'intercept']) AS term)""",
    a.ITEMS,
)
def stim_effects(spark, d):
    """Three comparisons for every subject, experiment and the pool; the score equations hold at what was fitted."""
    design = stats.effect_design(a.items(spark, d))
    effects = stats.stim_effects(design, EFFECT_FEATURES, EFFECT_LEVELS)
    scores = stats.effect_scores(stats.effect_cells(design, EFFECT_FEATURES, EFFECT_LEVELS), effects, EFFECT_FEATURES, ["experiment", "subject"])
    by = ["level", "experiment", "subject", "comparison", "term"]
    counts = effects.select(*by, "n").withColumnRenamed("n", "_n")
    same = [scores[k].eqNullSafe(counts[k]) for k in by]
    return scores.join(counts, same[0] & same[1] & same[2] & same[3] & same[4]).select(*[scores[k] for k in by], (F.round("score", 4) + 0.0).alias("score"), F.col("_n").alias("n"))


@query("SELECT seq, subject, session, list, intrusion FROM shared_log WHERE type = 'REC_WORD' AND intrusion NOT IN (0, -999)", a.FULL_LOG, a.SHARED_LOG)
def intrusion_events(spark, d):
    return behavior.intrusion_events(a.shared_log(spark, d)).select("seq", "subject", "session", "list", "intrusion")


@query(
    """, r AS (SELECT subject, session, list, CAST(category_num = lag(category_num) OVER (PARTITION BY subject, session, list ORDER BY mstime, seq) AS INTEGER) AS same FROM shared_log WHERE experiment = 'catFR1' AND recalled = 1 AND subject IN ('S0', 'S2', 'S4'))
    SELECT subject, session, list, round(sum(same) / count(same), 9) AS ratio FROM r GROUP BY ALL""",
    a.FULL_LOG,
    a.SHARED_LOG,
)
def repetition_ratios(spark, d):
    """Of every second subject of the log, as an index would name them."""
    log = a.shared_log(spark, d)
    named = log.select("subject").distinct().where(F.substring("subject", 2, 1).cast("int") % 2 == 0)
    return rounded(behavior.repetition_ratios(log, named, order=("mstime", "seq")), "ratio")


@query(
    """, e AS (SELECT vec_id // 4 AS event_id, vec_id % 4 AS pair_idx, vec_id // 4 % 3 AS session, list_avg(list_transform(embedding[1:32], lambda x: CAST(x AS DOUBLE))) AS pre, list_avg(list_transform(embedding[33:64], lambda x: CAST(x AS DOUBLE))) AS post FROM embeddings),
    k AS (SELECT * FROM e WHERE event_id % 3 < 2 AND NOT (session = 1 AND event_id // 3 >= 20))
    SELECT session, pair_idx, count(*) AS n, round(avg(post - pre) / (stddev_samp(post - pre) / sqrt(count(*))), 6) AS t_stat FROM k WHERE session <> 1 GROUP BY 1, 2""",
    "one AS (SELECT 1)",
)
def stim_tstats(spark, d):
    """Channels around the stimulations before the first list; one session has too few of them, another none."""
    e = a.table(spark, d, "embeddings").select(F.floor(F.col("vec_id") / 4).alias("event_id"), (F.col("vec_id") % 4).alias("pair_idx"), F.transform("embedding", lambda x: x.cast("double")).alias("s"))
    early = (F.col("event_id") % 3 < 2) & ~((F.col("session") == 1) & (F.floor(F.col("event_id") / 3) >= 20))
    stim = e.select("event_id", (F.col("event_id") % 3).alias("session")).distinct().withColumn("list", F.when(early, -999).otherwise(1))
    half = lambda start: e.select("event_id", "pair_idx", F.slice("s", start, 32).alias("samples"))
    got = stats.stim_tstats(stim, half(1), half(33), ["session"])
    return got.select("session", "pair_idx", "n", F.round("t_stat", 6).alias("t_stat"))
