"""Every registered query of the reference's own operators over the driver's tables, and the SQL that must agree."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mnesis.operators import behavior, clean, masks, montage, sequence, stats
from mnesis.plans import adapters as a

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}
DIGITS = 9


def query(sql: str | None = None, *ctes: str):
    """Registers the function under its name, with SQL over the adapters it names."""

    def register(fn):
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLE_SQL[fn.__name__] = ("WITH " + ", ".join(ctes) + " " if ctes else "") + sql
        return fn

    return register


def rounded(df: DataFrame, *columns: str, digits: int = DIGITS) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


@query("SELECT serialpos, round(avg(recalled), 9) AS probability FROM items GROUP BY 1", a.ITEMS)
def serialpos_probability(spark, d):
    return rounded(behavior.recall_by_serialpos(a.items(spark, d)), "probability")


@query(
    """, f AS (SELECT list, arg_min(serialpos, (orderkey, serialpos, shipdate, partkey, session, price)) AS serialpos FROM items WHERE recalled = 1 GROUP BY 1)
    SELECT CAST(p AS INTEGER) AS serialpos, round(count(list) / (SELECT CAST(max(list) AS DOUBLE) FROM items), 9) AS probability FROM range(1, 13) r(p) LEFT JOIN f ON f.serialpos = p GROUP BY 1""",
    a.ITEMS,
)
def first_recall_probability(spark, d):
    return rounded(behavior.first_recall_by_serialpos(a.items(spark, d), a.ITEM_ORDER), "probability")


@query("SELECT subject, session, round((max(mstime) - min(mstime)) / 1000.0, 3) AS session_length, max(mstime) AS last_ms, count(DISTINCT list) AS num_lists FROM session_log GROUP BY 1, 2", a.SESSION_LOG)
def session_length(spark, d):
    got = behavior.session_length(a.session_log(spark, d), ["subject", "session"])
    return rounded(got, "session_length", digits=3).withColumn("last_ms", F.unix_millis("session_datetime")).drop("session_datetime")


@query(
    """, s AS (SELECT session, count(*) AS num_problems, count(DISTINCT list) AS num_lists, count(*) FILTER (iscorrect = 1) AS num_correct FROM math WHERE type = 'PROB' AND list > -1 GROUP BY 1),
    t AS (SELECT * FROM s UNION ALL SELECT NULL, CAST(sum(num_problems) AS BIGINT), CAST(sum(num_lists) AS BIGINT), CAST(sum(num_correct) AS BIGINT) FROM s)
    SELECT *, round(100.0 * num_correct / num_problems, 9) AS percent_correct, round(num_problems / num_lists, 9) AS problems_per_list FROM t""",
    a.MATH,
)
def math_summary(spark, d):
    return rounded(behavior.math_summary(a.math_events(spark, d), ["session"]), "percent_correct", "problems_per_list")


@query(
    """SELECT subject, experiment, session, count(*) FILTER (type = 'WORD') AS num_words, CAST(sum(recalled) FILTER (type = 'WORD') AS BIGINT) AS num_correct, count(DISTINCT list) AS num_lists,
    count(*) FILTER (intrusion > 0) AS num_prior_list_intrusions, count(*) FILTER (intrusion = -1) AS num_extra_list_intrusions,
    round(coalesce(100.0 * sum(recalled) FILTER (type = 'WORD') / nullif(count(*) FILTER (type = 'WORD'), 0), 0), 9) AS percent_recalled FROM session_log GROUP BY 1, 2, 3""",
    a.SESSION_LOG,
)
def fr_session_summary(spark, d):
    return rounded(behavior.fr_summary(a.session_log(spark, d), ["subject", "experiment", "session"]), "percent_recalled")


@query("SELECT subject, session, repeats, count(*) AS num_words, count(*) FILTER (recalled = 1) AS num_correct FROM session_log WHERE type = 'WORD' AND serialpos BETWEEN 3 AND 23 GROUP BY 1, 2, 3", a.SESSION_LOG)
def repfr_counts(spark, d):
    return behavior.repeated_words(a.session_log(spark, d), ["subject", "session"])


@query(
    """, w AS (SELECT * FROM session_log WHERE type = 'WORD'), b AS (SELECT recalled, repeats, CAST(greatest(1, ceil((serialpos - (SELECT min(serialpos) FROM w)) * 9.0 / (SELECT max(serialpos) - min(serialpos) FROM w))) AS INTEGER) AS bin FROM w)
    SELECT bin, round(avg(recalled) FILTER (repeats = 1), 9) AS r1, round(avg(recalled) FILTER (repeats = 2), 9) AS r2, round(avg(recalled) FILTER (repeats = 3), 9) AS r3 FROM b GROUP BY 1""",
    a.SESSION_LOG,
)
def repfr_binned_pivot(spark, d):
    rows = a.session_log(spark, d).where(masks.encoding())
    got = behavior.binned_recall(rows, "serialpos", "repeats", 9, [1, 2, 3])
    return got.select("bin", *[F.round(F.col(f"`{k}`"), DIGITS).alias(f"r{k}") for k in (1, 2, 3)])


RECALLS = "r AS (SELECT *, mstime - lag(mstime) OVER w AS irt, category_num = lag(category_num) OVER w AS within FROM session_log WHERE type = 'REC_WORD' WINDOW w AS (PARTITION BY subject, session, list ORDER BY mstime, seq))"
LIST_KEYS = ["subject", "session", "list"]


def recalls(spark, d):
    return a.session_log(spark, d).where(masks.kind("REC_WORD"))


@query(
    """SELECT subject, session, round(avg(irt) FILTER (within), 6) AS irt_within, round(avg(irt) FILTER (NOT within), 6) AS irt_between, count(*) FILTER (within) AS n_within, count(*) FILTER (NOT within) AS n_between
    FROM r WHERE irt IS NOT NULL GROUP BY 1, 2""",
    a.SESSION_LOG,
    RECALLS,
)
def irt_within_between(spark, d):
    return rounded(behavior.category_times(recalls(spark, d), LIST_KEYS, a.LOG_ORDER), "irt_within", "irt_between", digits=6)


@query("SELECT subject, session, list, round(avg(CAST(within AS INTEGER)), 9) AS ratio FROM r GROUP BY 1, 2, 3", a.SESSION_LOG, RECALLS)
def repetition_ratio(spark, d):
    return rounded(sequence.repetition_ratio(recalls(spark, d), LIST_KEYS, a.LOG_ORDER), "ratio")


@query(", l AS (SELECT subject, session, list, avg(CAST(within AS INTEGER)) AS ratio FROM r GROUP BY 1, 2, 3) SELECT subject, round(avg(ratio), 9) AS repetition_ratio FROM l GROUP BY 1", a.SESSION_LOG, RECALLS)
def subject_repetition_ratio(spark, d):
    return rounded(behavior.subject_repetition_ratio(sequence.repetition_ratio(recalls(spark, d), LIST_KEYS, a.LOG_ORDER)), "repetition_ratio")


@query("SELECT seq, coalesce(mstime - lag(mstime) OVER w, 0) AS time_before, coalesce(lead(mstime) OVER w - mstime, 0) AS time_after FROM session_log WINDOW w AS (PARTITION BY subject, session ORDER BY mstime, seq)", a.SESSION_LOG)
def inter_event_time(spark, d):
    return sequence.time_between(a.session_log(spark, d), ["subject", "session"], a.LOG_ORDER).select("seq", "time_before", "time_after")


PHASES = ", p AS (SELECT *, CASE type WHEN 'STIM_ON' THEN 'DISTRACT_START' WHEN 'STIM_OFF' THEN 'REC_START' WHEN 'WORD_OFF' THEN 'TRIAL' ELSE type END AS t FROM session_log)"


@query(
    PHASES
    + """, c AS (SELECT seq, t, coalesce(last_value(CASE WHEN suffix(t, '_START') THEN left(t, length(t) - 6) WHEN contains(t, 'TRIAL') THEN replace(t, 'TRIAL', 'ENCODING') END IGNORE NULLS)
      OVER (PARTITION BY subject, session, list ORDER BY mstime, seq ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), '') AS b FROM p)
    SELECT seq, CASE WHEN t = 'WORD' THEN 'ENCODING' WHEN t = 'REC_WORD' OR b = 'REC' THEN 'RETRIEVAL' ELSE b END AS list_phase FROM c""",
    a.SESSION_LOG,
)
def list_phase(spark, d):
    kinds = F.create_map(*[F.lit(x) for x in ("STIM_ON", "DISTRACT_START", "STIM_OFF", "REC_START", "WORD_OFF", "TRIAL")])
    rows = a.session_log(spark, d).withColumn("type", F.coalesce(F.try_element_at(kinds, F.col("type")), "type"))
    return sequence.list_phase(rows, LIST_KEYS, a.LOG_ORDER).select("seq", "list_phase")


STIM_ITEMS = """s AS (SELECT *, coalesce(lead(type) OVER w = 'STIM_ON', false) OR (coalesce(lead(type) OVER w = 'WORD_OFF', false) AND (coalesce(lead(type, 2) OVER w = 'STIM_ON', false)
      OR (coalesce(lead(type, 2) OVER w = 'DISTRACT_START', false) AND coalesce(lead(type, 3) OVER w = 'STIM_ON', false)))) AS is_stim_item FROM session_log
    WINDOW w AS (PARTITION BY subject, session, list ORDER BY mstime, seq)),
  i AS (SELECT *, coalesce(lag(is_stim_item) OVER (PARTITION BY subject, session, list ORDER BY mstime, seq), false) AS is_post_stim_item FROM s WHERE type = 'WORD')"""


@query("SELECT seq, is_stim_item, is_post_stim_item FROM i", a.SESSION_LOG, STIM_ITEMS)
def stim_item_detection(spark, d):
    return sequence.stim_items(a.session_log(spark, d), LIST_KEYS, a.LOG_ORDER).select("seq", "is_stim_item", "is_post_stim_item")


@query(
    """, h AS (SELECT *, experiment IN ('FR2', 'catFR2') AND is_stim_item AS hit FROM i), g AS (SELECT *, coalesce(lag(hit AND serialpos < 12) OVER w, false) AS a, coalesce(lag(hit AND serialpos < 11, 2) OVER w, false) AS b FROM h
      WINDOW w AS (PARTITION BY subject, session, list ORDER BY mstime, seq))
    SELECT seq, is_stim_item OR a AS is_stim_item, is_post_stim_item OR a OR b AS is_post_stim_item FROM g""",
    a.SESSION_LOG,
    STIM_ITEMS,
)
def fr2_correction(spark, d):
    found = sequence.stim_items(a.session_log(spark, d), LIST_KEYS, a.LOG_ORDER)
    return sequence.fr2_correction(found, LIST_KEYS, a.LOG_ORDER).select("seq", "is_stim_item", "is_post_stim_item")


@query(
    """SELECT seq, NOT r AND NOT p AND NOT s AS fr_encoding, r AND NOT p AS fr_retrieval, NOT r AND p AS pal_encoding, r AND p AS pal_retrieval, s AS post_stim
    FROM (SELECT seq, type IN ('REC_WORD', 'REC_BASE', 'REC_EVENT') AS r, experiment = 'PAL1' AS p, type = 'STIM_OFF' AND list > -1 AS s FROM session_log)""",
    a.SESSION_LOG,
)
def partition_events(spark, d):
    log = a.session_log(spark, d)
    return log.select("seq", *[m.alias(k) for k, m in masks.partitions(log).items()])


@query(
    """, l AS (SELECT *, CASE WHEN type = 'STIM_OFF' AND recalled = 1 THEN 'REC_END' WHEN type = 'WORD_OFF' AND recalled = 0 THEN 'PROB' ELSE type END AS t FROM session_log)
    SELECT seq, t AS type FROM l WHERE t = 'PROB' OR list = -999 OR (subject, session, list) IN (SELECT (subject, session, list) FROM l WHERE t IN ('REC_END', 'REC_STOP'))""",
    a.SESSION_LOG,
)
def remove_incomplete_lists(spark, d):
    kind = F.when(masks.kind("STIM_OFF") & (F.col("recalled") == 1), "REC_END").when(masks.kind("WORD_OFF") & (F.col("recalled") == 0), "PROB").otherwise(F.col("type"))
    return masks.remove_incomplete_lists(a.session_log(spark, d).withColumn("type", kind)).select("seq", "type")


@query(
    """, g AS (SELECT subject, session, list, mstime + 1000 AS b, lead(mstime) OVER (PARTITION BY subject, session, list ORDER BY mstime) - 2000 - 600000 AS e FROM session_log WHERE type = 'REC_WORD')
    SELECT subject, session, list, unnest(range(b, e, 600000)) AS start FROM g WHERE e > b""",
    a.SESSION_LOG,
)
def free_periods(spark, d):
    return sequence.free_periods(recalls(spark, d), LIST_KEYS, "mstime", 600_000, 2000, 1000)


@query(
    """, g AS (SELECT *, lead(mstime) OVER w - mstime AS gap, row_number() OVER w AS n FROM session_log WINDOW w AS (PARTITION BY subject, session ORDER BY mstime, seq)),
    b AS (SELECT *, coalesce(gap < 2000000, false) AS small, coalesce(lag(gap < 2000000) OVER (PARTITION BY subject, session ORDER BY n), false) AS before FROM g),
    u AS (SELECT *, n - row_number() OVER (PARTITION BY subject, session, small ORDER BY n) AS island, n - 1 - row_number() OVER (PARTITION BY subject, session, before ORDER BY n) AS tail FROM b),
    x AS (SELECT *, count(*) FILTER (small) OVER (PARTITION BY subject, session, small, island) AS l1, row_number() OVER (PARTITION BY subject, session, small, island ORDER BY n) - 1 AS p,
          count(*) FILTER (before) OVER (PARTITION BY subject, session, before, tail) AS l2 FROM u)
    SELECT seq, gap IS NULL OR small OR (before AND l2 % 2 = 1) AS adjacent FROM x""",
    a.SESSION_LOG,
)
def adjacent_events(spark, d):
    return sequence.adjacent(a.session_log(spark, d), ["subject", "session"], a.LOG_ORDER, 2_000_000).select("seq", "adjacent")


@query("SELECT vec_id AS event_id, max(run) AS longest, max(run) > 2 AS saturated FROM (SELECT vec_id, count(*) - 1 AS run FROM (SELECT vec_id, x, i - row_number() OVER (PARTITION BY vec_id, x ORDER BY i) AS g FROM (SELECT vec_id, unnest(list_transform(embedding, lambda v: round(CAST(v AS DOUBLE), 0))) AS x, unnest(range(len(embedding))) AS i FROM embeddings)) GROUP BY vec_id, x, g) GROUP BY 1")
def saturated_epochs(spark, d):
    samples = F.transform("embedding", lambda v: F.round(v.cast("double"), 0))
    run = sequence.longest_flat_run(samples)
    return a.table(spark, d, "embeddings").select(F.col("vec_id").alias("event_id"), run.cast("long").alias("longest"), (run > 2).alias("saturated"))


@query("SELECT seq, session + CASE experiment WHEN 'FR2' THEN 0 WHEN 'catFR1' THEN 100 ELSE 200 END AS session FROM session_log", a.SESSION_LOG)
def union_experiments(spark, d):
    log = a.session_log(spark, d)
    parts = [log.where(F.col("experiment") == e) for e in ("FR2", "none", "catFR1", "PAL1")]
    return clean.union_experiments([parts[0], parts[1], parts[2], parts[3].drop("value")]).select("seq", "session")


STIMMED = "stimmed AS (SELECT DISTINCT l_partkey AS channel_1, l_partkey + 1 AS channel_2 FROM lineitem WHERE l_quantity > 45)"


def stimmed(spark, d):
    return a.table(spark, d, "lineitem").where("l_quantity > 45").select(F.col("l_partkey").alias("channel_1"), (F.col("l_partkey") + 1).alias("channel_2"))


@query("SELECT pair_idx, label FROM pairs WHERE (channel_1, channel_2) NOT IN (SELECT (channel_1, channel_2) FROM stimmed)", a.PAIRS, STIMMED)
def pair_exclusion_anti(spark, d):
    return montage.without_stim_pairs(a.pairs(spark, d), stimmed(spark, d)).select("pair_idx", "label")


@query("SELECT pair_idx, (channel_1, channel_2) NOT IN (SELECT (channel_1, channel_2) FROM stimmed) AS used FROM pairs", a.PAIRS, STIMMED)
def used_pair_mask(spark, d):
    return montage.flagged(a.pairs(spark, d), stimmed(spark, d), ["channel_1", "channel_2"], "used", present=False).select("pair_idx", "used")


@query(
    """SELECT p_partkey AS pair_idx, CASE WHEN r_name <> 'ASIA' THEN r_name WHEN p_size > 25 AND n_name <> 'NATION_3' THEN n_name WHEN p_size % 3 <> 0 THEN CASE WHEN p_size % 2 = 0 THEN 'Left ' ELSE 'Right ' END || p_brand ELSE '--' END AS location
    FROM part JOIN nation ON n_nationkey = p_partkey % 25 JOIN region ON n_regionkey = r_regionkey"""
)
def pair_metadata_join(spark, d):
    n, r = a.table(spark, d, "nation"), a.table(spark, d, "region")
    p = a.table(spark, d, "part").withColumn("nation", (F.col("p_partkey") % 25).cast("int"))
    place = n.join(r, F.col("n_regionkey") == F.col("r_regionkey")).select(F.col("n_nationkey").alias("nation"), "n_name", "r_name")
    region = lambda mask, v: F.struct(F.when(mask, v).alias("region"), (F.lit(0.5) - F.col("p_size") % 2 * -1 - 1).alias("x"), F.lit(0.0).alias("y"), F.lit(0.0).alias("z"))
    atlases = F.struct(
        region(F.col("r_name") != "ASIA", F.col("r_name")).alias("stein"),
        region(F.col("n_name") != "NATION_3", F.col("n_name")).alias("wb"),
        region(F.col("p_size") % 3 != 0, F.col("p_brand")).alias("ind"),
        region(F.lit(True), F.lit("m")).alias("mni"),
    )
    known = p.join(place, "nation").select(F.concat(F.lit("l "), F.col("p_partkey").cast("string")).alias("label"), F.when(F.col("p_size") > 25, "D").otherwise("S").alias("type_1"), atlases.alias("atlases"))
    configured = a.table(spark, d, "part").select(F.col("p_partkey").alias("pair_idx"), F.concat(F.lit("L"), F.col("p_partkey").cast("string")).alias("label"))
    return montage.pair_metadata(configured, known).select("pair_idx", "location")


@query(
    """SELECT pair_idx, arg_min(v.region, (sqrt((p.x - v.x) ** 2 + (p.y - v.y) ** 2 + (p.z - v.z) ** 2), v.region)) AS region, round(min(sqrt((p.x - v.x) ** 2 + (p.y - v.y) ** 2 + (p.z - v.z) ** 2)), 9) AS distance
    FROM pairs p, voxels v GROUP BY 1""",
    a.PAIRS,
    a.VOXELS,
)
def nearest_region(spark, d):
    return rounded(montage.nearest_region(a.pairs(spark, d), a.voxels(spark, d), "pair_idx"), "distance")


@query(
    """, x AS (SELECT i.montage, i.pair_idx AS i, j.pair_idx AS j, sqrt((i.x - j.x) * (i.x - j.x) + (i.y - j.y) * (i.y - j.y) + (i.z - j.z) * (i.z - j.z)) AS d FROM pairs i JOIN pairs j ON i.montage = j.montage AND i.pair_idx < j.pair_idx)
    SELECT montage, i, j, round(d, 9) AS distance, round(exp(-d / 120.0), 9) AS adjacency FROM x""",
    a.PAIRS,
)
def pair_distances(spark, d):
    got = montage.pair_distances(a.pairs(spark, d), ["montage"])
    return got.withColumns({c: F.rint(F.col(c) * 1e9) / 1e9 for c in ("distance", "adjacency")})  # as round(c, 9), without decimals


SETS = """sets AS (SELECT DISTINCT subject, experiment, session, list, stimAnodeTag, stimCathodeTag, location, amplitude, stim_duration, pulse_freq FROM items),
  spread AS (SELECT i.subject, i.experiment, i.session, i.list, i.serialpos, i.recalled, i.is_stim_list, i.is_stim_item, i.is_post_stim_item, i.classifier_output, i.thresh, s.stimAnodeTag, s.stimCathodeTag, s.location, s.amplitude, s.stim_duration, s.pulse_freq
    FROM items i JOIN sets s ON i.subject = s.subject AND i.experiment = s.experiment AND i.session = s.session AND i.list = s.list)"""


@query("SELECT stimAnodeTag, location, amplitude, is_stim_list, count(*) AS n, CAST(sum(recalled) AS BIGINT) AS n_recalled FROM spread GROUP BY 1, 2, 3, 4", a.ITEMS, SETS)
def stim_params_by_list(spark, d):
    got = behavior.stim_params_by_list(a.items(spark, d))
    return got.groupBy("stimAnodeTag", "location", "amplitude", "is_stim_list").agg(F.count("*").alias("n"), F.sum("recalled").alias("n_recalled"))


@query(
    """SELECT stimAnodeTag, stimCathodeTag, coalesce(location, '--') AS location, amplitude, stim_duration, pulse_freq, is_stim_list, count(*) FILTER (is_stim_item) AS n_stimulations, count(subject) AS n_trials
    FROM spread WHERE stimAnodeTag IS NOT NULL AND stimCathodeTag IS NOT NULL AND amplitude IS NOT NULL GROUP BY 1, 2, 3, 4, 5, 6, 7""",
    a.ITEMS,
    SETS,
)
def stim_parameters(spark, d):
    return behavior.stim_parameters(a.items(spark, d))


@query(
    """, g AS (SELECT * FROM spread WHERE list > 3),
    c AS (SELECT CAST(sum(recalled) FILTER (NOT is_stim_list) AS BIGINT) AS lc, count(*) FILTER (NOT is_stim_list) AS ln, CAST(sum(recalled) FILTER (NOT is_stim_item AND classifier_output < thresh) AS BIGINT) AS bc, count(*) FILTER (NOT is_stim_item AND classifier_output < thresh) AS bn FROM g),
    p AS (SELECT stimAnodeTag, stimCathodeTag, amplitude, stim_duration, pulse_freq, CAST(coalesce(sum(recalled) FILTER (is_stim_list), 0) AS BIGINT) AS c1, count(*) FILTER (is_stim_list) AS n1,
      CAST(coalesce(sum(recalled) FILTER (is_stim_item), 0) AS BIGINT) AS c2, count(*) FILTER (is_stim_item) AS n2, CAST(coalesce(sum(recalled) FILTER (is_post_stim_item), 0) AS BIGINT) AS c3, count(*) FILTER (is_post_stim_item) AS n3
      FROM g WHERE stimAnodeTag IS NOT NULL GROUP BY 1, 2, 3, 4, 5),
    u AS (SELECT stimAnodeTag, amplitude, 'stim lists' AS comparison, c1 AS a, n1 AS n, lc AS b, ln AS m FROM p, c UNION ALL SELECT stimAnodeTag, amplitude, 'stim items', c2, n2, bc, bn FROM p, c UNION ALL SELECT stimAnodeTag, amplitude, 'post-stim items', c3, n3, bc, bn FROM p, c)
    SELECT stimAnodeTag, amplitude, comparison, a AS stim_correct, n AS stim_items, b AS control_correct, m AS control_items,
      round((a - n * ((a + b) / (n + m))) ** 2 / (n * ((a + b) / (n + m)) * (1 - (a + b) / (n + m))) + (b - m * ((a + b) / (n + m))) ** 2 / (m * ((a + b) / (n + m)) * (1 - (a + b) / (n + m))), 6) AS chi2 FROM u""",
    a.ITEMS,
    SETS,
)
def recall_tests(spark, d):
    got = rounded(behavior.recall_tests(a.items(spark, d)), "chi2", digits=6)
    return got.select("stimAnodeTag", "amplitude", "comparison", "stim_correct", "stim_items", "control_correct", "control_items", "chi2")


@query(
    """SELECT round(100 * (avg(recalled) FILTER (is_stim_item) - avg(recalled) FILTER (classifier_output < thresh AND NOT is_stim_list)) / avg(recalled), 9) AS delta_recall_stim,
    round(100 * (avg(recalled) FILTER (is_post_stim_item) - avg(recalled) FILTER (classifier_output < thresh AND NOT is_stim_list)) / avg(recalled), 9) AS delta_recall_post_stim FROM items""",
    a.ITEMS,
)
def delta_recall(spark, d):
    return rounded(behavior.delta_recall(a.items(spark, d)), "delta_recall_stim", "delta_recall_post_stim")


@query("SELECT list, CAST(sum(recalled) AS BIGINT) AS n_recalls, CAST(coalesce(sum(recalled) FILTER (is_stim_list), 0) AS BIGINT) AS n_stim_list_recalls, count(*) FILTER (is_stim_item) AS n_stim_events FROM items GROUP BY 1", a.ITEMS)
def recalls_by_list(spark, d):
    rows = a.items(spark, d)
    some = behavior.recalls_by_list(rows, stim_lists_only=True).withColumnRenamed("n_recalls", "n_stim_list_recalls")
    return behavior.recalls_by_list(rows).join(some, "list", "left").na.fill({"n_stim_list_recalls": 0}).join(behavior.stim_events_by_list(rows), "list")


@query(", l AS (SELECT list, bool_and(is_stim_list) AS stim FROM items GROUP BY 1) SELECT count(*) FILTER (stim) AS num_stim_lists, count(*) FILTER (NOT stim) AS num_nonstim_lists FROM l", a.ITEMS)
def stim_list_counts(spark, d):
    return behavior.stim_list_counts(a.items(spark, d))


@query("SELECT serialpos, round(avg(classifier_output), 9) AS mean_output FROM items GROUP BY 1", a.ITEMS)
def output_by_serialpos(spark, d):
    return rounded(behavior.output_by_serialpos(a.items(spark, d)), "mean_output")


@query(", b AS (SELECT seq AS event, CASE type WHEN 'STIM_ON' THEN 'pre' ELSE 'post' END AS position, category_num * 1000 + session AS id FROM session_log WHERE type IN ('STIM_ON', 'STIM_OFF')) SELECT event, id FROM b WHERE position = 'pre' AND id IN (SELECT id FROM b WHERE position = 'post')", a.SESSION_LOG)
def biomarker_semi(spark, d):
    rows = a.session_log(spark, d).where(masks.kind("STIM_ON", "STIM_OFF"))
    marks = rows.select(F.col("seq").alias("event"), F.when(masks.kind("STIM_ON"), "pre").otherwise("post").alias("position"), (F.col("category_num") * 1000 + F.col("session")).alias("id"))
    return behavior.matched_biomarkers(marks).select("event", "id")


@query("SELECT event_id, pair_idx, freq_idx, round((power - avg(power) OVER w) / nullif(stddev_samp(power) OVER w, 0), 6) AS z FROM powers WINDOW w AS (PARTITION BY session, pair_idx, freq_idx)", a.POWERS)
def zscore_by_session(spark, d):
    p = a.powers(spark, d)
    return p.select("event_id", "pair_idx", "freq_idx", F.round(sequence.zscore(p, ["session", "pair_idx", "freq_idx"], "power"), 6).alias("z"))


@query("SELECT pair_idx, freq_idx, round(avg(power), 9) AS mean_power, count(*) AS n FROM powers WHERE pair_idx % 2 = 0 AND freq_idx >= 5 GROUP BY 1, 2", a.POWERS)
def reduce_powers(spark, d):
    got = a.powers(spark, d).where("pair_idx % 2 = 0 AND freq_idx >= 5").groupBy("pair_idx", "freq_idx")
    return rounded(got.agg(F.avg("power").alias("mean_power"), F.count("*").alias("n")), "mean_power")


T_TEST = """e AS (SELECT pair_idx, event_id, recalled, avg(power) AS x FROM powers WHERE freq_idx >= 5 GROUP BY 1, 2, 3),
  m AS (SELECT pair_idx, count(*) FILTER (recalled = 1) AS n1, avg(x) FILTER (recalled = 1) AS m1, var_samp(x) FILTER (recalled = 1) AS v1, count(*) FILTER (recalled = 0) AS n0, avg(x) FILTER (recalled = 0) AS m0, var_samp(x) FILTER (recalled = 0) AS v0 FROM e GROUP BY 1),
  t AS (SELECT pair_idx, (m1 - m0) / sqrt(((n1 - 1) * v1 + (n0 - 1) * v0) / (n1 + n0 - 2) * (1.0 / n1 + 1.0 / n0)) AS t, n1 + n0 - 2 AS df FROM m)"""


@query("SELECT pair_idx, round(t, 6) AS t_stat, df FROM t", a.POWERS, T_TEST)
def hfa_ttest(spark, d):
    return rounded(stats.pair_t_table(a.powers(spark, d), 5, 7), "t_stat", digits=6)


@query()
def hfa_fdr(spark, d):
    p = a.powers(spark, d)
    from mnesis.schemas import FRParameters

    return stats.by_p(stats.delta_hfa_table(p.select("pair_idx").distinct(), p, FRParameters().frequencies))


@query(
    """SELECT pair_idx, count(*) AS n, round(avg(x) / (stddev_samp(x) / sqrt(count(*))), 6) AS t_stat, count(*) - 1 AS df FROM (SELECT pair_idx, event_id, sum(power) FILTER (freq_idx = 7) - sum(power) FILTER (freq_idx = 0) AS x FROM powers GROUP BY 1, 2) GROUP BY 1 HAVING count(*) >= 30""",
    a.POWERS,
)
def paired_ttest(spark, d):
    ends = a.powers(spark, d).groupBy("pair_idx", "event_id").agg(F.sum(F.when(F.col("freq_idx") == 0, F.col("power"))).alias("pre"), F.sum(F.when(F.col("freq_idx") == 7, F.col("power"))).alias("post"))
    return rounded(stats.paired_t(ends, ["pair_idx"], "pre", "post", 30), "t_stat", digits=6)


@query(
    """, r AS (SELECT session, outcome, rank() OVER w + (count(*) OVER (PARTITION BY session, score) - 1) / 2.0 AS rk FROM scores WINDOW w AS (PARTITION BY session ORDER BY score))
    SELECT session, round((sum(rk) FILTER (outcome = 1) - count(*) FILTER (outcome = 1) * (count(*) FILTER (outcome = 1) + 1) / 2.0) / (count(*) FILTER (outcome = 1) * count(*) FILTER (outcome = 0)), 9) AS auc FROM r GROUP BY 1""",
    a.SCORES,
)
def auc(spark, d):
    return rounded(stats.auc(a.scores(spark, d), ["session"], "score", "outcome"), "auc")


@query(
    """, g AS (SELECT session, score AS threshold, count(*) FILTER (outcome = 1) AS p, count(*) FILTER (outcome <> 1) AS q FROM scores GROUP BY 1, 2)
    SELECT session, threshold, round(CAST(sum(q) OVER w AS DOUBLE) / sum(q) OVER (PARTITION BY session), 9) AS false_positive_rate, round(CAST(sum(p) OVER w AS DOUBLE) / sum(p) OVER (PARTITION BY session), 9) AS true_positive_rate
    FROM g WINDOW w AS (PARTITION BY session ORDER BY threshold DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""",
    a.SCORES,
)
def roc_curve(spark, d):
    return rounded(stats.roc_curve(a.scores(spark, d), ["session"], "score", "outcome"), "false_positive_rate", "true_positive_rate")


@query(
    """, c AS (SELECT session, quantile_cont(score, 1.0 / 3) AS lo, quantile_cont(score, 2.0 / 3) AS hi, median(score) AS median_output, avg(outcome) AS rate FROM scores GROUP BY 1)
    SELECT s.session, round(median_output, 9) AS median_output, round(avg(outcome) FILTER (score <= lo), 6) AS low, round(avg(outcome) FILTER (score >= lo AND score <= hi), 6) AS mid, round(avg(outcome) FILTER (score >= hi), 6) AS high, round(rate, 9) AS recall_rate
    FROM scores s JOIN c ON s.session = c.session GROUP BY s.session, median_output, rate""",
    a.SCORES,
)
def terciles(spark, d):
    got = stats.terciles(a.scores(spark, d), ["session"], "score", "outcome")
    return rounded(rounded(got, "median_output", "recall_rate"), "low", "mid", "high", digits=6).select("session", "median_output", "low", "mid", "high", "recall_rate")


@query(
    """, n AS (SELECT session, count(*) AS n FROM scores GROUP BY 1), k AS (SELECT session, greatest(0, round_even(n / 2 - 1.96 * sqrt(n) / 2, 0)) AS lo, least(n - 1, round_even(n / 2 + 1.96 * sqrt(n) / 2, 0) + 1) AS hi FROM n),
    o AS (SELECT session, score, row_number() OVER (PARTITION BY session ORDER BY score) - 1 AS i FROM scores)
    SELECT o.session, max(score) FILTER (i = lo) AS lower, max(score) FILTER (i = hi) AS upper FROM o JOIN k ON o.session = k.session GROUP BY 1""",
    a.SCORES,
)
def median_ci(spark, d):
    return stats.median_interval(a.scores(spark, d), ["session"], "score")


@query(
    """, y AS (SELECT event_id, sum(power * (pair_idx - freq_idx)) AS y FROM powers GROUP BY 1) SELECT pair_idx, freq_idx, round(covar_samp(power, y), 9) AS activation FROM powers JOIN y ON powers.event_id = y.event_id GROUP BY 1, 2""",
    a.POWERS,
)
def haufe_activation(spark, d):
    p = a.powers(spark, d)
    weights = p.select("pair_idx", "freq_idx").distinct().withColumn("weight", (F.col("pair_idx") - F.col("freq_idx")).cast("double"))
    return rounded(stats.haufe_activation(p, weights), "activation")


@query("SELECT l.pair_idx * 1000 + l.freq_idx AS i, r.pair_idx * 1000 + r.freq_idx AS j, round(covar_samp(l.power, r.power), 9) AS value FROM powers l JOIN powers r ON l.event_id = r.event_id AND l.pair_idx * 1000 + l.freq_idx <= r.pair_idx * 1000 + r.freq_idx GROUP BY 1, 2", a.POWERS)
def feature_covariance(spark, d):
    got = stats.covariance(a.powers(spark, d).withColumn("all", F.lit(1)), ["all"])
    return rounded(got, "value").select(F.col("i"), F.col("j"), "value")


@query(", s AS (SELECT subject, experiment, session, avg(recalled) AS rate FROM session_log WHERE type = 'WORD' GROUP BY 1, 2, 3) SELECT experiment, round(avg(rate), 9) AS mean, round(min(rate), 9) AS min, round(max(rate), 9) AS max FROM s GROUP BY 1", a.SESSION_LOG)
def session_metric_by_group(spark, d):
    s = a.session_log(spark, d).where(masks.encoding()).groupBy("subject", "experiment", "session").agg(F.avg("recalled").alias("rate"))
    return rounded(behavior.metric_by_group(s, ["experiment"], "rate"), "mean", "min", "max")


@query(
    """, s AS (SELECT session, count(*) AS n FROM session_log GROUP BY 1), m AS (SELECT session, round(avg(score), 9) AS metric FROM scores GROUP BY 1) SELECT s.session, n, metric, metric IS NULL AS missing FROM s LEFT JOIN m ON s.session = m.session""",
    a.SESSION_LOG,
    a.SCORES,
)
def metrics_left_merge(spark, d):
    s = a.session_log(spark, d).groupBy("session").agg(F.count("*").alias("n"))
    m = rounded(a.scores(spark, d).groupBy("session").agg(F.avg("score").alias("metric")), "metric")
    merged, without = behavior.with_partner_check(s, m, ["session"])
    return merged.join(without.select("session", F.lit(True).alias("missing")), "session", "left").na.fill({"missing": False})


@query(", s AS (SELECT subject, experiment, session, avg(recalled) AS rate FROM session_log WHERE type = 'WORD' GROUP BY 1, 2, 3) SELECT subject, experiment, array_to_string(list_sort(list(DISTINCT session)), '_') AS sessions, count(*) AS n_sessions, round(avg(rate), 9) AS mean FROM s GROUP BY 1, 2", a.SESSION_LOG)
def subject_level(spark, d):
    from mnesis.functions.text import session_string

    s = a.session_log(spark, d).where(masks.encoding()).groupBy("subject", "experiment", "session").agg(F.avg("recalled").alias("rate"))
    return rounded(behavior.subject_level(s, "rate"), "mean").withColumn("sessions", session_string(F.col("sessions")))


@query("SELECT seq, avg(value) OVER (PARTITION BY subject, session ORDER BY mstime, seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) IS NULL AS first, round(avg(value) OVER (PARTITION BY subject, session ORDER BY mstime, seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 9) AS thresh FROM session_log", a.SESSION_LOG)
def running_threshold(spark, d):
    log = a.session_log(spark, d).withColumn("thresh", F.round(sequence.running_threshold(["subject", "session"], a.LOG_ORDER, "value"), DIGITS))
    return log.select("seq", F.col("thresh").isNull().alias("first"), "thresh")


@query(
    """, x AS (SELECT *, list - min(list) OVER () AS l0, serialpos - min(serialpos) OVER () AS p0, count(*) OVER () AS c FROM (SELECT * FROM items WHERE list > 3))
    SELECT p0 AS serialpos, round((l0) / CAST((SELECT count(DISTINCT list) FROM items WHERE list > 3) AS DOUBLE), 9) AS list, count(*) AS n, count(*) FILTER (classifier_output < thresh) AS n_low, count(*) FILTER (is_stim_item OR classifier_output < thresh) AS n_stim_comparison, CAST(sum(recalled) AS BIGINT) AS n_recalled FROM x GROUP BY 1, 2""",
    a.ITEMS,
)
def effect_design(spark, d):
    t = stats.effect_design(a.items(spark, d))
    return t.groupBy("serialpos", F.round("list", DIGITS).alias("list")).agg(
        F.count("*").alias("n"), behavior.count_if(F.col("low_biomarker")).alias("n_low"), behavior.count_if(F.col("in_stim_comparison")).alias("n_stim_comparison"), F.sum("recalled").alias("n_recalled")
    )
