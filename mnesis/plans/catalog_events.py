"""Queries of predicates, cleaning, weights and summaries over the full event log; importing this module registers them."""

from __future__ import annotations

from pyspark.sql import functions as F

from mnesis.functions import text
from mnesis.operators import behavior, clean, features, masks, model, montage, retrieval, sequence, stats
from mnesis.plans import adapters as a
from mnesis.plans.catalog import query, rounded
from mnesis.plans.catalog_signal import recall_log, training
from mnesis.schemas import EVENTS, required_columns

SESSION = ["subject", "session"]
ORDER = ["mstime", "seq"]
GAP = "coalesce(mstime - lag(mstime) OVER (PARTITION BY subject, session ORDER BY mstime, seq), 0) AS gap"
RETRIEVAL = "type IN ('REC_WORD', 'REC_BASE', 'REC_EVENT')"


@query(
    f"""SELECT seq, type = 'WORD' AS encoding, type = 'PROB' AS math, type IN ('REC_WORD', 'REC_WORD_VV') AS vocalization, type = 'REC_BASE' AS baseline, {RETRIEVAL} AND matched AS all_retrieval,
    type = 'WORD' OR ({RETRIEVAL} AND matched) AS word_event, type IN ('TEST_PROBE', 'PROBE_START') AS pal_retrieval, recalled = 1 AS recalled, recalled <> 1 AS not_recalled,
    type = 'STIM_OFF' AND list > -1 AS post_stim, phase = 'STIM' AS stim_list, type = 'WORD' AND phase <> 'STIM' AS nonstim, type NOT IN ('START', 'STOP', 'PROB') AND list > -1 AS stim_table,
    session = 7 AS in_session, type = 'REC_WORD' AND intrusion = 0 AND gap > 1000 AS fr_retrieval, {RETRIEVAL} AND matched AND experiment <> 'PAL1' AS fr_retrieval_class,
    NOT ({RETRIEVAL} AND matched) AND experiment = 'PAL1' AS pal_encoding_class FROM (SELECT *, {GAP} FROM full_log)""",
    a.FULL_LOG,
)
def event_masks(spark, d):
    log = a.full_log(spark, d)
    classes = masks.partitions(log)
    return log.select(
        "seq", masks.encoding().alias("encoding"), masks.math().alias("math"), masks.vocalization().alias("vocalization"), masks.baseline_retrieval().alias("baseline"),
        masks.all_retrieval(log).alias("all_retrieval"), masks.word_event(log, False).alias("word_event"), masks.pal_retrieval().alias("pal_retrieval"), masks.recalled().alias("recalled"),
        masks.not_recalled().alias("not_recalled"), masks.post_stim().alias("post_stim"), masks.stim_list().alias("stim_list"), masks.nonstim().alias("nonstim"), masks.stim_table().alias("stim_table"),
        masks.in_session(7).alias("in_session"), masks.fr_retrieval(SESSION, ORDER).alias("fr_retrieval"), classes["fr_retrieval"].alias("fr_retrieval_class"), classes["pal_encoding"].alias("pal_encoding_class"),
    )


@query(
    f"""SELECT 'offsets' AS name, count(*) AS n, CAST(sum(seq) AS BIGINT) AS total FROM full_log WHERE eegoffset >= 0 UNION ALL
    SELECT 'voices', count(*), CAST(sum(seq) AS BIGINT) FROM full_log WHERE NOT contains(type, 'VOCALIZATION') UNION ALL
    SELECT 'practice', count(*), CAST(sum(seq) AS BIGINT) FROM full_log WHERE list >= 0 UNION ALL
    SELECT 'nonresponses', count(*), CAST(sum(seq) AS BIGINT) FROM full_log WHERE correct IN (0, 1) UNION ALL
    SELECT 'pal', count(*), CAST(sum(seq) AS BIGINT) FROM full_log WHERE type IN ('STUDY_PAIR', 'TEST_PROBE', 'PROBE_START') UNION ALL
    SELECT 'intrusions', count(*), CAST(sum(seq) AS BIGINT) FROM g WHERE type IN ('WORD', 'REC_BASE') OR (type = 'REC_WORD' AND intrusion = 0 AND gap > 1000) UNION ALL
    SELECT 'retrieval', count(*), CAST(sum(seq) AS BIGINT) FROM g WHERE CASE WHEN contains(experiment, 'FR') THEN type = 'REC_WORD' AND intrusion = 0 AND gap > 1000 WHEN contains(experiment, 'PAL') THEN type IN ('TEST_PROBE', 'PROBE_START') ELSE false END UNION ALL
    SELECT 'stimulated', count(*), CAST(sum(seq) AS BIGINT) FROM full_log WHERE phase = 'STIM' UNION ALL
    SELECT 'search', count(*), CAST(sum(seq) AS BIGINT) FROM full_log WHERE list > -1 UNION ALL
    SELECT 'trials', count(*), CAST(sum(list * 1000 + seq) AS BIGINT) FROM full_log UNION ALL
    SELECT 'recalled words', count(*), CAST(sum(seq) AS BIGINT) FROM full_log WHERE type = 'WORD' AND recalled = 1""",
    a.FULL_LOG,
    f"g AS (SELECT *, {GAP} FROM full_log)",
)
def event_filters(spark, d):
    from mnesis.sources import readers

    log = a.full_log(spark, d)
    kept = {
        "offsets": masks.remove_negative_offsets(log), "voices": masks.remove_voice_detection(log), "practice": masks.remove_practice_lists(log), "nonresponses": masks.remove_nonresponses(log),
        "pal": masks.subset_pal(log), "intrusions": masks.remove_intrusions(log, SESSION, ORDER), "retrieval": masks.retrieval_events(log, SESSION, ORDER), "stimulated": log.where(masks.stim_list()),
        "search": readers.parameter_search_events(log), "recalled words": log.where(masks.encoding() & masks.recalled()),
        "trials": clean.trial_column(log.withColumn("trial", F.col("list"))).withColumn("seq", F.col("list") * 1000 + F.col("seq")),
    }
    out = None
    for name, rows in kept.items():
        one = rows.agg(F.count("*").alias("n"), F.sum("seq").alias("total")).select(F.lit(name).alias("name"), "n", "total")
        out = one if out is None else out.unionByName(one)
    return out


CLEAN_FR = f"""c AS (SELECT * FROM full_log WHERE NOT contains(experiment, 'PAL') AND eegoffset >= 0 AND NOT contains(type, 'VOCALIZATION') AND list >= CASE WHEN contains(experiment, 'PS5') THEN -1 ELSE 0 END),
  e AS (SELECT DISTINCT subject, session, list FROM c WHERE type IN ('REC_END', 'REC_STOP')),
  w AS (SELECT c.* FROM c WHERE type IN ('START', 'STOP', 'PROB') OR EXISTS (SELECT 1 FROM e WHERE e.subject = c.subject AND e.session = c.session AND e.list = c.list)),
  x AS (SELECT *, coalesce(mstime - lag(mstime) OVER (PARTITION BY subject, session ORDER BY mstime, eegoffset), 0) AS gap FROM w),
  clean_fr AS (SELECT subject, experiment, session, list, mstime, eegoffset, CASE WHEN type IN ('REC_WORD', 'REC_BASE') THEN 'REC_EVENT' ELSE type END AS type,
    CAST(CASE type WHEN 'REC_WORD' THEN 1 WHEN 'REC_BASE' THEN 0 ELSE recalled END AS BIGINT) AS recalled, phase, category_num, matched
    FROM x WHERE type IN ('WORD', 'REC_BASE') OR (type = 'REC_WORD' AND intrusion = 0 AND gap > 1000))"""
CLEAN_PAL = """p AS (SELECT * FROM full_log WHERE contains(experiment, 'PAL') AND eegoffset >= 0 AND list >= 0 AND type IN ('STUDY_PAIR', 'TEST_PROBE', 'PROBE_START') AND correct IN (0, 1)),
  r AS (SELECT subject, session, list_sort(list(RT) FILTER (WHERE correct = 1 AND RT <> -999)) AS rts FROM p WHERE type <> 'STUDY_PAIR' GROUP BY 1, 2),
  q AS (SELECT p.*, coalesce(len(rts), 0) AS n, rts, CAST('0x' || substr(md5(subject || '|' || session || '|' || mstime || '|' || eegoffset || '|0'), 1, 8) AS BIGINT) AS h FROM p LEFT JOIN r USING (subject, session)),
  clean_pal AS (SELECT subject, experiment, session, list, mstime, CASE WHEN type = 'STUDY_PAIR' THEN eegoffset ELSE eegoffset + CASE WHEN RT = -999 THEN coalesce(rts[h % greatest(n, 1) + 1], -999) ELSE RT END END AS eegoffset,
    CASE WHEN type = 'STUDY_PAIR' THEN 'WORD' ELSE 'REC_EVENT' END AS type, correct AS recalled, phase, 999 AS category_num, matched FROM q)"""
CLEANED = ["subject", "experiment", "session", "list", "mstime", "eegoffset", "type", "recalled", "phase", "category_num", "matched"]


def raw_log(spark, d):
    """The full log as a cleaner gets it; eegoffset is the second part of its order."""
    return a.full_log(spark, d).drop("seq", "value")


@query("SELECT * FROM clean_fr", a.FULL_LOG, CLEAN_FR)
def clean_fr(spark, d):
    log = raw_log(spark, d).where(~F.col("experiment").contains("PAL"))
    return clean.clean_fr(log, SESSION, ["mstime", "eegoffset"], baseline=None).select(*CLEANED)


@query("SELECT * FROM clean_pal", a.FULL_LOG, CLEAN_PAL)
def clean_pal(spark, d):
    log = raw_log(spark, d).where(F.col("experiment").contains("PAL"))
    return clean.clean_pal(log, SESSION).select(*CLEANED)


@query("SELECT * FROM clean_fr UNION ALL SELECT * FROM clean_pal", a.FULL_LOG, CLEAN_FR, CLEAN_PAL)
def clean_events(spark, d):
    """Both branches, with a third of the subjects missing and filled from their sessions."""
    log = raw_log(spark, d).withColumn("subject", F.when(F.col("eegoffset") % 3 == 1, "").otherwise(F.col("subject")))
    events, _ = clean.clean_events(log, SESSION, ["mstime", "eegoffset"], baseline=None)
    # sessions without any row that names the subject have none
    known = a.full_log(spark, d).groupBy("session").agg(F.max("subject").alias("_s"))
    return events.join(known, "session").withColumn("subject", F.coalesce("subject", "_s")).select(*CLEANED)


@query(
    f"SELECT * FROM (SELECT * FROM clean_fr UNION ALL SELECT * FROM clean_pal) WHERE experiment IN ('FR1', 'catFR1', 'PAL1') AND (type = 'WORD' OR ({RETRIEVAL} AND matched))",
    a.FULL_LOG,
    CLEAN_FR,
    CLEAN_PAL,
)
def training_events(spark, d):
    return clean.training_events(raw_log(spark, d), SESSION, ["mstime", "eegoffset"], baseline=None).select(*CLEANED)


def months(log):
    """A session is a user's month, so that matching stays small however long a user's log is."""
    return log.withColumn("session", F.concat_ws("-", "session", F.date_format(F.timestamp_millis("mstime"), "yyyyMM")))


@query()
def clean_fr_with_baseline(spark, d):
    """Recalls and their matching periods of failure to recall."""
    log = months(recall_log(spark, d)).withColumns({"eegoffset": F.col("mstime"), "recalled": F.lit(0), "item_name": F.lit("w")})
    return retrieval.insert_baseline(log, SESSION, ["mstime", "seq"], pre=200, post=200, inclusion=0, period=45_000)


@query()
def free_epoch_baseline(spark, d):
    """A session is all of a user's log: recalls of every month find epochs of every month."""
    log = recall_log(spark, d).withColumn("mstime", F.col("rectime"))
    return retrieval.free_epoch_baseline(log, SESSION, ["mstime", "seq"], duration=500, pre=200, post=200)


@query(
    f"""SELECT subject, session, list, mstime, CAST(CASE WHEN type = 'REC_WORD' THEN 1 WHEN type = 'REC_BASE' THEN 0 ELSE recalled END AS BIGINT) AS recalled, CASE type WHEN 'STUDY_PAIR' THEN 'WORD' ELSE type END AS type,
    correct AS recalled_pal, CAST(category_num AS VARCHAR) AS category_num, 'fixed' AS made, CAST(NULL AS BIGINT) AS missing, CAST(0 AS BIGINT) AS montage FROM full_log""",
    a.FULL_LOG,
)
def projections(spark, d):
    log = a.full_log(spark, d)
    rows = clean.study_pairs_to_words(clean.recall_outcome(log))
    pal = clean.correct_to_recalled(log.select("seq", "recalled", "correct")).select("seq", F.col("recalled").alias("recalled_pal"))
    rows = clean.append_missing(clean.add_constant(clean.cast_columns(rows, {"category_num": "string"}), "made", "fixed", "string"), {"missing": "bigint"}).join(pal, "seq")
    shaped = clean.conform(clean.select_columns(rows, all_relevant=True), EVENTS, {"montage": 0})
    same = [c for c in ("subject", "session", "list", "mstime", "recalled", "type") if c in required_columns(all_relevant=True)]
    return rows.withColumn("montage", F.lit(0).cast(shaped.schema["montage"].dataType)).select(*same, "recalled_pal", "category_num", "made", "missing", "montage")


@query(
    """SELECT s.subject, s.session, CASE WHEN pal AND enc AND ret THEN 'PAL' WHEN ps5 THEN 'EQUAL' WHEN fr AND enc AND ret THEN 'FR' ELSE 'EQUAL' END AS scheme, 'list' AS "by", has_end FROM
    (SELECT subject, session, bool_or(contains(experiment, 'PAL')) AS pal, bool_or(contains(experiment, 'PS5')) AS ps5, bool_or(contains(experiment, 'FR')) AS fr, bool_or(type = 'WORD') AS enc, bool_or(type = 'REC_EVENT') AS ret,
     bool_or(type = 'REC_END') AS has_end FROM full_log GROUP BY 1, 2) s""",
    a.FULL_LOG,
)
def schemes(spark, d):
    log = a.full_log(spark, d)
    ends = masks.has_type(log, "REC_END", SESSION).withColumnRenamed("has", "has_end")
    return model.scheme(log, SESSION).join(model.scheme_of_validation(log, SESSION), SESSION).join(ends, SESSION)


def weight_rows(spark, d):
    """Cohorts of sessions with phases and outcomes of both families."""
    return a.full_log(spark, d).select(F.col("subject"), F.col("session"), F.col("list"), F.when(F.col("experiment") == "PAL1", "PAL1").otherwise("FR1").alias("experiment"), "type", "recalled")


def fold_sql(family: str, boosts: list[str]) -> str:
    steps = ", ".join(f"b{k} AS (SELECT *, v{k - 1} * ({b}) / avg(v{k - 1} * ({b})) OVER (PARTITION BY subject, fold) AS v{k} FROM b{k - 1})" for k, b in enumerate(boosts, 1))
    return f""", u AS (SELECT subject, session, {family} AS family, CASE WHEN type = 'WORD' THEN 'enc' WHEN {RETRIEVAL} THEN 'ret' END AS phase, recalled FROM full_log),
    f AS (SELECT subject, session, row_number() OVER (PARTITION BY subject ORDER BY session) - 1 AS fold FROM (SELECT DISTINCT subject, session FROM full_log)),
    n AS (SELECT subject, session, family, phase, recalled, count(*) AS n FROM u WHERE phase IS NOT NULL GROUP BY ALL),
    k AS (SELECT DISTINCT family, phase, recalled FROM n),
    b0 AS (SELECT f.subject, f.fold, k.family, k.phase, k.recalled, 1.0::DOUBLE / sum(n.n) FILTER (WHERE n.session <> f.session) AS v0 FROM f JOIN k ON true
      JOIN n ON n.subject = f.subject AND n.family = k.family AND n.phase = k.phase AND n.recalled = k.recalled GROUP BY ALL),
    {steps} SELECT subject, fold, family, phase, recalled, round(v{len(boosts)}, 9) AS weight FROM b{len(boosts)}"""


@query(fold_sql("'fr'", ["1", "CASE phase WHEN 'enc' THEN 4.375 ELSE 1 END"]), a.FULL_LOG)
def fold_weights_fr(spark, d):
    return rounded(model.fold_weights(weight_rows(spark, d), ["subject"], "session", "FR"), "weight")


@query(
    """, p AS (SELECT subject, list, count(*) AS n FROM full_log GROUP BY 1, 2) SELECT subject, list, n, CAST(dense_rank() OVER (PARTITION BY subject ORDER BY list) - 1 AS INTEGER) AS rank FROM p""",
    a.FULL_LOG,
)
def lists_of_subjects(spark, d):
    log = a.full_log(spark, d)
    counts = log.groupBy("subject", "list").agg(F.count("*").alias("n"))
    return counts.withColumn("rank", (F.dense_rank().over(sequence.window(["subject"], ["list"])) - 1).cast("int"))


@query(
    """SELECT session, string_agg(DISTINCT subject, ',' ORDER BY subject) AS subjects, string_agg(DISTINCT experiment, ',' ORDER BY experiment) AS experiments, CAST(session AS VARCHAR) AS sessions FROM full_log GROUP BY 1""",
    a.FULL_LOG,
)
def event_metadata(spark, d):
    rows = a.full_log(spark, d).withColumn("_s", F.col("session"))
    return behavior.event_metadata(rows.withColumnRenamed("session", "own").withColumnRenamed("_s", "session"), ("own",)).withColumnRenamed("own", "session")


@query(
    """SELECT subject, phase, count(*) FILTER (WHERE type = 'STIM_OFF') AS n_stims, count(*) FILTER (WHERE type = 'WORD') AS n_words, round(avg(value) FILTER (WHERE type = 'WORD'), 9) AS mean_value FROM full_log GROUP BY 1, 2""",
    a.FULL_LOG,
)
def own_summaries(spark, d):
    """What a user adds to the summaries: any aggregates of a group's rows."""
    log = a.full_log(spark, d)
    return rounded(behavior.per_session(log, ["subject", "phase"], {"n_stims": behavior.count_if(masks.kind("STIM_OFF")), "n_words": behavior.count_if(masks.encoding()), "mean_value": F.avg(F.when(masks.encoding(), F.col("value")))}), "mean_value")


@query(
    """, f AS (SELECT subject, is_stim_item, list, arg_min(serialpos, (orderkey, serialpos, shipdate, partkey, session, price)) AS serialpos FROM items WHERE recalled = 1 GROUP BY 1, 2, 3),
    m AS (SELECT subject, is_stim_item, max(list) AS last FROM items GROUP BY 1, 2)
    SELECT m.subject, m.is_stim_item, CAST(p AS INTEGER) AS serialpos, round(count(f.list) / CAST(last AS DOUBLE), 9) AS probability FROM m JOIN range(1, 13) r(p) ON true LEFT JOIN f ON f.serialpos = p AND f.subject = m.subject AND f.is_stim_item = m.is_stim_item GROUP BY 1, 2, 3, last""",
    a.ITEMS,
)
def first_recall_by_stim(spark, d):
    items = a.items(spark, d)
    each = [behavior.first_recall_by_serialpos(items, a.ITEM_ORDER, stim=s, keys=("subject",)).withColumn("is_stim_item", F.lit(s)) for s in (True, False)]
    return rounded(each[0].unionByName(each[1]), "probability")


@query("SELECT subject, is_stim_item, serialpos, round(avg(recalled), 9) AS probability FROM items GROUP BY 1, 2, 3", a.ITEMS)
def recall_by_stim(spark, d):
    return rounded(behavior.recall_by_stim(a.items(spark, d), ("subject",)), "probability")


@query(
    """SELECT subject, count(*) FILTER (WHERE stim) AS num_stim_lists, count(*) FILTER (WHERE NOT stim) AS num_nonstim_lists, CAST(sum(r) AS BIGINT) AS n_recalls, CAST(sum(e) AS BIGINT) AS n_stim_events FROM
    (SELECT subject, list, bool_and(is_stim_list) AS stim, sum(recalled) AS r, count(*) FILTER (WHERE is_stim_item) AS e FROM items GROUP BY 1, 2) GROUP BY 1""",
    a.ITEMS,
)
def stim_lists_by_subject(spark, d):
    items, keys = a.items(spark, d), ("subject",)
    recalls = behavior.recalls_by_list(items, keys=keys).groupBy("subject").agg(F.sum("n_recalls").alias("n_recalls"))
    events = behavior.stim_events_by_list(items, keys).groupBy("subject").agg(F.sum("n_stim_events").alias("n_stim_events"))
    return behavior.stim_list_counts(items, keys).join(recalls, "subject").join(events, "subject")


@query(
    """, t AS (SELECT subject, session, round(classifier_output, 2) AS score, recalled AS outcome FROM items), c AS (SELECT subject, quantile_cont(score, 1/3.0) AS lo, quantile_cont(score, 2/3.0) AS hi, avg(outcome) AS r FROM t GROUP BY 1),
    x AS (SELECT t.subject, r, avg(outcome) FILTER (WHERE score <= lo) AS low, avg(outcome) FILTER (WHERE score >= lo AND score <= hi) AS mid, avg(outcome) FILTER (WHERE score >= hi) AS high FROM t JOIN c USING (subject) GROUP BY 1, 2)
    SELECT subject, round(100 * (low - r) / r, 6) AS low_diff_from_mean, round(100 * (mid - r) / r, 6) AS mid_diff_from_mean, round(100 * (high - r) / r, 6) AS high_diff_from_mean FROM x""",
    a.ITEMS,
)
def tercile_differences(spark, d):
    rows = a.items(spark, d).select("subject", "session", F.round("classifier_output", 2).alias("score"), F.col("recalled").alias("outcome"))
    got = stats.terciles(rows, ["subject"], "score", "outcome")
    return rounded(got.select("subject", "low_diff_from_mean", "mid_diff_from_mean", "high_diff_from_mean"), "low_diff_from_mean", "mid_diff_from_mean", "high_diff_from_mean", digits=6)


@query(
    """, h AS (SELECT pair_idx, freq_idx FROM powers GROUP BY 1, 2 HAVING avg(power) > 0) SELECT p.event_id, count(*) AS n, round(sum(power), 6) AS total FROM powers p WHERE pair_idx IN (SELECT pair_idx FROM h) AND freq_idx IN (SELECT freq_idx FROM h) GROUP BY 1""",
    a.POWERS,
)
def reduced_powers(spark, d):
    """Pairs and frequencies that have a positive mean somewhere."""
    p = a.powers(spark, d)
    high = p.groupBy("pair_idx", "freq_idx").agg(F.avg("power").alias("m")).where("m > 0")
    kept = stats.reduce_powers(p, high.select("pair_idx"), high.select("freq_idx"))
    return kept.groupBy("event_id").agg(F.count("*").alias("n"), F.round(F.sum("power"), 6).alias("total"))


@query(
    """, x AS (SELECT montage % 10 AS montage, label FROM pairs WHERE channel_1 % 7 = 0) SELECT p.montage % 10 AS montage, count(*) AS n_pairs, count(x.label) AS n_excluded_pairs FROM pairs p LEFT JOIN x ON p.montage % 10 = x.montage AND p.label = x.label GROUP BY 1""",
    a.PAIRS,
)
def pair_counts(spark, d):
    p = a.pairs(spark, d).withColumn("montage", F.col("montage") % 10)
    return behavior.pair_counts(p, p.where("channel_1 % 7 = 0"), ("montage",))


@query(
    """SELECT pair_idx, label, channel_1 % 3 <> 0 AS used, channel_2 % 4 = 0 AS in_model, channel_1 % 50 = 0 OR channel_2 % 50 = 0 AS near_lead, channel_1 % 5 <> 0 AND channel_2 % 4 = 0 AS kept_by_models, label = 'L7-L8' AS is_trigger,
    pair_idx % 9 = 0 AS stimulated FROM pairs""",
    a.PAIRS,
)
def pair_flags(spark, d):
    p = a.pairs(spark, d)
    leads = p.where("channel_1 % 50 = 0").select(F.concat(F.lit("L"), F.col("channel_1").cast("string")).alias("lead"))
    near = montage.excluded_by_leads(p, leads.union(p.where("channel_2 % 50 = 0").select(F.concat(F.lit("L"), F.col("channel_2").cast("string")))))
    rejected = montage.rejected_by_models(p, [p.where("channel_1 % 5 <> 0"), p.where("channel_2 % 4 = 0")])
    stim = montage.stim_channels(p, p.where("pair_idx % 9 = 0").select(F.split("label", "-")[0].alias("anode_label"), F.split("label", "-")[1].alias("cathode_label")))
    rows = montage.trigger_mask(montage.recorded_pairs(montage.used_pairs(p, p.where("channel_1 % 3 = 0")), p.where("channel_2 % 4 = 0")), "L7-L8")
    rows = montage.flagged(rows, near, ["label"], "near_lead")
    rows = montage.flagged(montage.flagged(rows, rejected, ["label"], "kept_by_models", present=False), stim, ["label"], "stimulated")
    return rows.select("pair_idx", "label", "used", "in_model", "near_lead", "kept_by_models", "is_trigger", "stimulated")


@query(
    """SELECT 'model' AS name, count(*) AS n, CAST(sum(pair_idx) AS BIGINT) AS total FROM pairs WHERE channel_1 % 3 <> 0 UNION ALL
    SELECT 'missing', count(*), CAST(sum(pair_idx) AS BIGINT) FROM pairs WHERE pair_idx % 2 = 1 UNION ALL SELECT 'contacts', count(*), CAST(sum(channel_1 * 3 + channel_2) AS BIGINT) FROM pairs""",
    a.PAIRS,
)
def pair_sets(spark, d):
    p = a.pairs(spark, d)
    sheet = montage.monopolar(p).select(F.col("channel").cast("int").alias("number"), F.concat(F.lit("L"), F.col("channel").cast("string")).alias("label"))
    numbered = montage.stim_parameters(p.select(F.split("label", "-")[0].alias("anode"), F.split("label", "-")[1].alias("cathode")), sheet)
    sets = {
        "model": montage.model_pairs(p, p.where("channel_1 % 3 = 0")).select("pair_idx"), "missing": montage.missing_pairs(p, p.where("pair_idx % 2 = 0")).select("pair_idx"),
        "contacts": numbered.select((F.col("anode_number") * 3 + F.col("cathode_number")).alias("pair_idx")),
    }
    one = lambda name, rows: rows.agg(F.count("*").alias("n"), F.sum("pair_idx").alias("total")).select(F.lit(name).alias("name"), "n", F.col("total").cast("long").alias("total"))
    first, second, third = (one(*x) for x in sets.items())
    return first.unionByName(second).unionByName(third)


@query(
    """SELECT c_custkey, 'S' || c_custkey || ':FR1:' || c_nationkey || '.' || (c_nationkey + 1) || ':' || c_mktsegment AS summary_id, 'S' || c_custkey || ':FR1:' || c_nationkey AS session_id, c_mktsegment || '_' || c_nationkey AS contact,
    c_nationkey || '_' || (c_nationkey + 1) AS sessions, 'A' || c_nationkey || '-B' || c_nationkey AS tag, c_acctbal >= 110 AND c_acctbal < 111 AS is_trigger, 'S' || c_custkey AS p_subject, 1 AS p_montage, 'FR1' AS p_experiment,
    c_nationkey || ',' || 9 AS p_sessions, 'powers' AS p_name, 'h5' AS p_type FROM customer"""
)
def identifiers(spark, d):
    c = a.table(spark, d, "customer")
    n, key = F.col("c_nationkey").cast("string"), F.concat(F.lit("S"), F.col("c_custkey").cast("string"))
    both = F.array("c_nationkey", F.col("c_nationkey") + 1)
    parts = text.report_path_parts(F.concat(F.lit("/db/"), key, F.lit("_1_FR1_"), n, F.lit("_9_powers.h5")))
    return c.select(
        "c_custkey", text.summary_id(key, F.lit("FR1"), both, F.col("c_mktsegment")).alias("summary_id"), text.session_id(key, F.lit("FR1"), F.col("c_nationkey")).alias("session_id"),
        text.contact_label(F.col("c_mktsegment"), n).alias("contact"), text.session_string(both).alias("sessions"),
        text.combine_tags(F.array(F.struct(F.concat(F.lit("A"), n).alias("anode"), F.concat(F.lit("B"), n).alias("cathode"))))[0].alias("tag"), text.trigger_frequency(F.col("c_acctbal"), 110).alias("is_trigger"),
        parts["subject"].alias("p_subject"), parts["montage"].alias("p_montage"), parts["experiment"].alias("p_experiment"), F.array_join(F.transform(parts["sessions"], lambda s: s.cast("string")), ",").alias("p_sessions"),
        parts["file_name"].alias("p_name"), parts["file_type"].alias("p_type"),
    )


@query(
    """, b AS (SELECT o_custkey, min(CASE o_orderpriority WHEN '1-URGENT' THEN 1 WHEN '2-HIGH' THEN 2 WHEN '3-MEDIUM' THEN 3 END) AS best FROM orders GROUP BY 1)
    SELECT o_orderkey, o_custkey AS subject FROM orders JOIN b USING (o_custkey) WHERE CASE o_orderpriority WHEN '1-URGENT' THEN 1 WHEN '2-HIGH' THEN 2 WHEN '3-MEDIUM' THEN 3 END = best""",
    "one AS (SELECT 1)",
)
def sessions_by_priority(spark, d):
    rows = a.table(spark, d, "orders").select("o_orderkey", F.col("o_custkey").alias("subject"), F.col("o_orderpriority").alias("experiment"))
    return features.by_priority(rows, ("1-URGENT", "2-HIGH", "3-MEDIUM")).select("o_orderkey", "subject")


@query(
    """, t AS (SELECT pair_idx % 4 AS region, freq_idx, pair_idx, covar_samp(power, y) AS c FROM (SELECT *, sum(power * (pair_idx - freq_idx)) OVER (PARTITION BY event_id) AS y FROM powers) GROUP BY 1, 2, 3)
    SELECT region, freq_idx, round(avg(c), 6) AS activation FROM t GROUP BY 1, 2""",
    a.POWERS,
)
def activation_by_region(spark, d):
    p = a.powers(spark, d)
    weights = p.select("pair_idx", "freq_idx").distinct().withColumn("weight", (F.col("pair_idx") - F.col("freq_idx")).cast("double"))
    regions = p.select("pair_idx", (F.col("pair_idx") % 4).alias("region")).distinct()
    return rounded(stats.activation_by_region(stats.haufe_activation(p, weights), regions), "activation", digits=6)


@query(
    """, e AS (SELECT vec_id AS event_id, (vec_id // 8) % 5 AS session, vec_id % 8 AS pair_idx, embedding FROM embeddings) SELECT session, pair_idx, count(*) AS n, count(*) FILTER (WHERE event_id % 10 <> 3 AND pair_idx <> 5) AS n_valid, CAST(128 AS DOUBLE) AS samplerate FROM e GROUP BY 1, 2""",
    "one AS (SELECT 1)",
)
def invalid_epochs(spark, d):
    e = a.table(spark, d, "embeddings").select(F.col("vec_id").alias("event_id"), (F.col("vec_id") % 8).alias("pair_idx"), (F.floor(F.col("vec_id") / 8) % 5).alias("session"), F.col("embedding").alias("samples"), F.lit(128.0).alias("samplerate"))
    nulls = features.invalid_as_null(e, e.where("event_id % 10 = 3"), e.where("pair_idx = 5"))
    counts = nulls.groupBy("session", "pair_idx").agg(F.count("*").alias("n"), F.count("samples").alias("n_valid"))
    return counts.join(features.sample_rate_of(e, ["session", "pair_idx"]), ["session", "pair_idx"])


@query(
    """, b AS (SELECT c_custkey AS subject, avg(CAST(o_totalprice > 150000 AS INTEGER)) AS auc FROM customer JOIN orders ON c_custkey = o_custkey GROUP BY 1), x AS (SELECT subject, 100 * (s - l) / r AS delta FROM
      (SELECT subject, avg(recalled) AS r, avg(recalled) FILTER (WHERE classifier_output < thresh AND NOT is_stim_list) AS l, avg(recalled) FILTER (WHERE is_stim_item) AS s FROM items GROUP BY 1))
    SELECT b.subject, round(auc, 9) AS auc, round(delta, 6) AS delta_recall_stim FROM b JOIN x USING (subject) WHERE delta IS NOT NULL""",
    a.ITEMS,
)
def delta_against_auc(spark, d):
    orders = a.table(spark, d, "orders").groupBy(F.col("o_custkey").alias("subject")).agg(F.avg((F.col("o_totalprice") > 150000).cast("int")).alias("auc"))
    deltas = behavior.delta_recall(a.items(spark, d), ("subject",)).select("subject", "delta_recall_stim")
    return behavior.delta_against_auc(orders, deltas, ["subject"]).select("subject", F.round("auc", 9).alias("auc"), F.round("delta_recall_stim", 6).alias("delta_recall_stim"))


@query()
def fold_weighted_cv(spark, d):
    """Leaving sessions out with weights of the rows that are left in."""
    rows = training(spark, d).drop("weight").withColumns({"experiment": F.lit("FR1"), "type": F.when(F.col("event_id") % 3 == 0, "REC_EVENT").otherwise("WORD")})
    return stats.auc(model.cross_validate(rows, ["subject"], "session", weights="FR"), ["subject"], "probability", "outcome")
