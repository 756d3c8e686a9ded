"""Queries of epochs, stored models and electrode summaries; importing this module registers them."""

from __future__ import annotations

from pyspark.sql import functions as F

from mnesis.operators import behavior, features, model, montage, notch, retrieval, sequence, tmi
from mnesis.plans import adapters as a
from mnesis.plans.catalog import query, rounded


@query(
    """SELECT seq, CASE type WHEN 'START' THEN 'REST' ELSE type END AS type, mstime + ms AS mstime, CAST(eegoffset + ms * 500 // 1000 AS BIGINT) AS eegoffset FROM full_log, (SELECT unnest([0, 1000, 4000, 7000]) AS ms) WHERE (type = 'START') = (ms > 0)""",
    a.FULL_LOG,
)
def resting_epochs(spark, d):
    log = a.full_log(spark, d).withColumn("type", F.when(F.col("type") == "START", "COUNTDOWN_START").otherwise(F.col("type")))
    return sequence.resting_epochs(log, 500.0).select("seq", "type", "mstime", "eegoffset")


def recording(spark, d):
    """(events, chunks): a recording of one sample an event in chunks of 50, two pairs, a thousand samples a second."""
    e = a.table(spark, d, "events").select("event_id", F.round(F.col("value") * 100).alias("v"))
    chunks = e.groupBy(F.floor(F.col("event_id") / 50).alias("chunk_id")).agg(F.sort_array(F.collect_list(F.struct("event_id", "v"))).alias("s"))
    chunks = chunks.withColumn("pair_idx", F.explode(F.array(F.lit(0), F.lit(1)))).select(F.lit("f").alias("eegfile"), "pair_idx", F.lit(1000.0).alias("samplerate"), "chunk_id", F.transform("s", lambda x: x["v"] * (F.col("pair_idx") + 1)).alias("samples"))
    return e.select("event_id", F.lit("f").alias("eegfile"), F.col("event_id").alias("eegoffset")), chunks


@query(
    """SELECT e.event_id, p AS pair_idx, k = 1 AS after, sum((p + 1) * f.v) AS total FROM r e JOIN (SELECT unnest([0, 1]) AS p) ON true JOIN (SELECT unnest([0, 1]) AS k) ON true
    JOIN r f ON CASE k WHEN 1 THEN f.event_id BETWEEN e.event_id + 35 AND e.event_id + 54 ELSE f.event_id BETWEEN e.event_id - 25 AND e.event_id - 6 END GROUP BY 1, 2, 3 HAVING count(*) = 20""",
    "r AS (SELECT event_id, round(value * 100) AS v FROM events)",
)
def stim_epochs(spark, d):
    """20 samples before and after stimulation, with a buffer of 5 and a duration of 30."""
    events, chunks = recording(spark, d)
    total = F.aggregate("samples", F.lit(0.0), lambda s, x: s + x).alias("total")
    cut = [features.stim_epochs(events, chunks, after, 5, 20, 30).select("event_id", "pair_idx", F.lit(after).alias("after"), total) for after in (False, True)]
    return cut[0].unionByName(cut[1])


FLAT = """flat AS (SELECT event_id, max(n) > 9 AS s FROM (SELECT event_id, vec_id, g, count(*) - 1 AS n FROM
    (SELECT *, sum(CASE WHEN same THEN 0 ELSE 1 END) OVER (PARTITION BY vec_id ORDER BY j) AS g FROM (SELECT *, x = lag(x) OVER (PARTITION BY vec_id ORDER BY j) AS same FROM
      (SELECT vec_id, vec_id // 2 AS event_id, unnest(range(64)) AS j, floor(CAST(unnest(embedding) AS DOUBLE) * 3) AS x FROM embeddings))) GROUP BY ALL) GROUP BY 1)"""


@query(
    """, o AS (SELECT seq, subject, session, mstime, lead(mstime) OVER w - mstime AS gap, row_number() OVER w AS n FROM session_log WINDOW w AS (PARTITION BY subject, session ORDER BY mstime, seq)),
    s AS (SELECT *, coalesce(CAST(gap < 36000000 AS INTEGER), 0) AS small FROM o), b AS (SELECT *, coalesce(lag(small) OVER (PARTITION BY subject, session ORDER BY n), 0) AS before FROM s),
    r AS (SELECT *, sum(CASE before WHEN 0 THEN 1 ELSE 0 END) OVER (PARTITION BY subject, session ORDER BY n) AS run FROM b), q AS (SELECT *, sum(small) OVER (PARTITION BY subject, session, run) AS gaps, n - min(n) OVER (PARTITION BY subject, session, run) AS place FROM r)
    SELECT seq AS event_id, (gaps > 0 AND (place < gaps OR gaps % 2 = 1)) OR gap IS NULL OR coalesce(s, false) AS bad FROM q LEFT JOIN flat ON flat.event_id = q.seq""",
    a.SESSION_LOG,
    FLAT,
)
def bad_events(spark, d):
    """Events within ten hours of the next, and those with a flat recording on one of two pairs."""
    log = a.session_log(spark, d).withColumn("event_id", F.col("seq"))
    e = a.table(spark, d, "embeddings").select(F.floor(F.col("vec_id") / 2).alias("event_id"), (F.col("vec_id") % 2).alias("pair_idx"), F.transform("embedding", lambda x: F.floor(x.cast("double") * 3).cast("double")).alias("samples"))
    return features.bad_events(e, log, ["subject", "session"], a.LOG_ORDER, least_ms=36_000_000)


@query(
    """, e AS (SELECT vec_id AS event_id, vec_id % 5 AS session, unnest(range(64)) AS i, CAST(unnest(embedding) AS DOUBLE) AS x FROM embeddings),
    u AS (SELECT *, i // 8 AS pair, i % 8 AS freq FROM e WHERE (i // 8 + session) % 2 = 0), n AS (SELECT *, (dense_rank() OVER (PARTITION BY session ORDER BY pair) - 1) * 8 + freq AS k FROM u)
    SELECT event_id, round(1 / (1 + exp(-(sum(x * (k % 5 - 2)) + 0.25))), 9) AS probability FROM n GROUP BY 1""",
    "one AS (SELECT 1)",
)
def stored_model_outputs(spark, d):
    """Outputs of each session's stored model, which uses every second pair; the newest stored one counts."""
    e = a.table(spark, d, "embeddings").select(F.col("vec_id").alias("event_id"), (F.col("vec_id") % 5).alias("session"), F.transform("embedding", lambda x: x.cast("double")).alias("features"))
    sessions = e.select("session").distinct()
    used = sessions.withColumn("pair_idx", F.explode(F.sequence(F.lit(0), F.lit(7)))).where("(pair_idx + session) % 2 = 0")
    registry = sessions.withColumn("v", F.explode(F.array(F.struct(F.lit(False).alias("is_retrained"), F.lit(3).alias("created"), F.lit("old").alias("path")), F.struct(F.lit(True).alias("is_retrained"), F.lit(1).alias("created"), F.lit("new").alias("path"))))).select("session", "v.*")
    weights = F.transform(F.sequence(F.lit(0), F.lit(31)), lambda k: (k % 5 - 2).cast("double"))
    stored = sessions.withColumn("path", F.explode(F.array(F.lit("old"), F.lit("new")))).withColumn("coefficients", F.when(F.col("path") == "new", weights).otherwise(F.transform(weights, lambda x: x * 0))).withColumn("intercept", F.lit(0.25))
    models = stored.join(model.latest_model(registry, ["session"]), ["session", "path"]).drop("path")
    return rounded(model.post_hoc(model.with_stored_features(e, models, used), models).select("event_id", "probability"), "probability")


@query(
    """SELECT subject, CASE WHEN is_stim_list THEN 'A' ELSE 'B' END AS loc_name, experiment AS list_phase, count(*) AS n, round(sum(price), 2) AS total, min(serialpos) AS first_amplitude, max(serialpos) AS last_amplitude FROM items GROUP BY ALL""",
    a.ITEMS,
)
def location_summary(spark, d):
    rows = a.items(spark, d).select("subject", F.when(F.col("is_stim_list"), "A").otherwise("B").alias("loc_name"), F.col("experiment").alias("list_phase"), "serialpos", F.col("price").cast("double").alias("p"), F.col("classifier_output").alias("o"))
    got = behavior.location_summary(rows, ["subject", "loc_name"], "list_phase", "serialpos", "p", "o")
    total = F.aggregate("delta_classifier", F.lit(0.0), lambda s, x: s + x)
    return got.select("subject", "loc_name", "list_phase", F.size("amplitude").cast("long").alias("n"), F.round(total, 2).alias("total"), F.col("amplitude")[0].alias("first_amplitude"), F.element_at("amplitude", -1).alias("last_amplitude"))


@query(
    """SELECT montage, sum(CAST(x > 25 AS INTEGER)) > 20 AS bad_channel, count(*) FILTER (WHERE x / 50 < 0.1) AS n_significant, count(*) FILTER (WHERE x / 50 >= 0.1) AS n_others FROM pairs GROUP BY 1""",
    a.PAIRS,
)
def channel_quality(spark, d):
    """Montages with more than twenty bad channels, and how many channels are below a level of p."""
    p = a.pairs(spark, d)
    bad = behavior.bad_channels(p.withColumn("bad", F.col("x") > 25), ["montage"])
    split = behavior.tstats_by_condition(p.select("montage", (F.col("x") / 50).alias("p"), F.col("y").alias("t_stat")), 0.1, ("montage",))
    return bad.join(split, "montage").select("montage", "bad_channel", F.size("significant").cast("long").alias("n_significant"), F.size("others").cast("long").alias("n_others"))


@query(
    """, s AS (SELECT l_orderkey % 9 AS session, l_partkey AS anode, l_partkey + 1 AS cathode, count(*) AS n_stims, max(l_quantity) AS amplitude FROM lineitem GROUP BY 1, 2, 3)
    SELECT session, anode AS anode_number, cathode AS cathode_number, pair_idx AS stim_idx, label, n_stims, amplitude, CASE WHEN pair_idx % 2 = 0 THEN pair_idx / 10.0 END AS z_tmi FROM s LEFT JOIN pairs ON channel_1 = anode AND channel_2 = cathode WHERE pair_idx % 2 = 0""",
    a.PAIRS,
)
def location_search_targets(spark, d):
    line = a.table(spark, d, "lineitem")
    events = line.select(F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice").alias("event_id"), (F.col("l_orderkey") % 9).alias("session")).distinct()
    stim = line.select(F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice").alias("event_id"), F.col("l_partkey").alias("anode_number"), (F.col("l_partkey") + 1).alias("cathode_number"), F.col("l_quantity").alias("amplitude"))
    p = a.pairs(spark, d)
    targets = behavior.location_search_table(events, stim, p)
    return tmi.target_table(targets, p.select(F.col("pair_idx").alias("stim_idx"), F.when(F.col("pair_idx") % 2 == 0, F.col("pair_idx") / 10.0).alias("z_tmi")))


@query(
    """, m AS (SELECT *, 60 * seq AS offs FROM session_log WHERE type = 'REC_WORD'), n AS (SELECT *, row_number() OVER (PARTITION BY subject, session ORDER BY mstime, seq) AS n FROM m)
    SELECT subject, session, round((max(offs) - min(offs)) * 1000.0 / nullif(max(mstime) - min(mstime), 0)) AS samplerate FROM n WHERE n IN (4, 5) GROUP BY 1, 2""",
    a.SESSION_LOG,
)
def recorded_rates(spark, d):
    log = a.session_log(spark, d).withColumn("eegoffset", 60 * F.col("seq"))
    return retrieval.sample_rate(log, ["subject", "session"], a.LOG_ORDER)


@query(
    """, o AS (SELECT *, lag(mstime) OVER w AS p, lead(mstime) OVER w AS n FROM session_log WINDOW w AS (PARTITION BY subject, session ORDER BY mstime, seq)) SELECT seq FROM o WHERE type = 'REC_WORD' AND intrusion = 0 AND coalesce(mstime - p, 0) > 2000 AND coalesce(n - mstime, 0) > 1000""",
    a.SESSION_LOG,
)
def included_recalls(spark, d):
    return retrieval.included_recalls(a.session_log(spark, d), ["subject", "session"], a.LOG_ORDER).select("seq")


@query(
    """, t AS (SELECT DISTINCT subject, session, list FROM session_log), s AS (SELECT subject, session, list, arg_min(mstime - serialpos, (mstime, seq)) AS begun FROM session_log WHERE type = 'REC_WORD' GROUP BY ALL)
    SELECT subject, session, list, 'REC_START' AS type, begun AS mstime FROM s UNION ALL SELECT subject, session, list, 'REC_END', begun + 45000 FROM s""",
    a.SESSION_LOG,
)
def recall_periods(spark, d):
    """Starts and ends of recall where a log has none."""
    keys = ["subject", "session"]
    log = a.session_log(spark, d).withColumn("rectime", F.col("serialpos"))
    rows = retrieval.with_recall_ends(retrieval.with_recall_starts(log, keys, a.LOG_ORDER), keys)
    return rows.where(F.col("type").isin("REC_START", "REC_END")).select(*keys, "list", "type", "mstime")


@query(
    """, e AS (SELECT vec_id, vec_id // 4 AS event_id, vec_id % 4 AS pair_idx, unnest(range(64)) AS i, CAST(unnest(embedding) AS DOUBLE) AS x FROM embeddings),
    m AS (SELECT event_id, i, avg(x) AS m FROM e WHERE pair_idx <> 2 OR event_id % 3 <> 0 GROUP BY 1, 2)
    SELECT e.event_id, pair_idx, e.i, round(x - coalesce(m, 0), 9) AS value FROM e LEFT JOIN m ON m.event_id = e.event_id AND m.i = e.i""",
    "one AS (SELECT 1)",
)
def common_average(spark, d):
    """Epochs less their event's mean over four channels, one of which is bad in every third event."""
    e = a.table(spark, d, "embeddings").select(F.floor(F.col("vec_id") / 4).alias("event_id"), (F.col("vec_id") % 4).alias("pair_idx"), F.transform("embedding", lambda x: x.cast("double")).alias("samples"))
    got = features.common_average(e, excluded=e.where("pair_idx = 2 AND event_id % 3 = 0").select("event_id", "pair_idx"))
    return got.select("event_id", "pair_idx", F.posexplode("samples").alias("i", "value")).withColumn("value", F.round("value", 9))


def recorded_subjects(spark, d):
    """(stim, resting, chunks, pairs): the embeddings as recordings of 16 pairs of a subject at 64 samples a second, with
    countdowns and stimulations."""
    v = F.col("vec_id")
    chunks = a.table(spark, d, "embeddings").select(
        F.concat(F.lit("f"), F.floor(v / 512).cast("string")).alias("eegfile"), (v % 16).cast("int").alias("pair_idx"), F.lit(64.0).alias("samplerate"), F.floor(v % 512 / 16).alias("chunk_id"), F.transform("embedding", lambda x: x.cast("double")).alias("samples"),
    )
    files = chunks.select("eegfile").distinct().withColumn("subject", F.col("eegfile"))
    second = F.explode(F.sequence(F.lit(0), F.lit(29))).alias("at")
    rows = files.select("subject", "eegfile", second).withColumns({"experiment": F.lit("FR1"), "session": F.lit(0), "event_id": F.xxhash64("eegfile", "at"), "mstime": F.col("at") * 1000, "eegoffset": (F.col("at") * 64).cast("long")})
    kinds = rows.withColumn("type", F.when(F.col("at") % 10 == 0, "COUNTDOWN_START").when(F.col("at") % 3 == 1, "STIM_ON"))
    site = F.when(F.col("at") % 2 == 0, F.lit(0)).otherwise(F.lit(5))
    stim = kinds.where("type = 'STIM_ON'").withColumns({"anode_label": F.concat(F.lit("A"), site), "cathode_label": F.concat(F.lit("B"), site)})
    place = F.explode(F.sequence(F.lit(0), F.lit(15))).alias("pair_idx")
    pairs = files.select("subject", place).select("subject", "pair_idx", F.concat(F.lit("A"), "pair_idx", F.lit("-B"), "pair_idx").alias("label"), *[(F.col("pair_idx") * k % 7 * 10).cast("double").alias(c) for k, c in ((1, "x"), (3, "y"), (5, "z"))])
    return stim, kinds.where("type = 'COUNTDOWN_START'"), chunks, pairs


@query()
def session_theta_modulation(spark, d):
    """From recordings to the modulation of every session's targets."""
    return tmi.session_tmi(*recorded_subjects(spark, d), samplerate=64.0, order=["mstime"])


@query(
    """, t AS (SELECT DISTINCT 'f' || vec_id // 512 AS subject FROM embeddings), c AS (SELECT subject, p, (p * 1) % 7 * 10 AS x, (p * 3) % 7 * 10 AS y, (p * 5) % 7 * 10 AS z FROM t, range(16) r(p))
    SELECT a.subject, 0 AS session, a.p AS stim_idx, b.p AS pair_idx, round(exp(-sqrt((a.x - b.x) ** 2 + (a.y - b.y) ** 2 + (a.z - b.z) ** 2) / 120), 9) AS distance FROM c a JOIN c b ON a.subject = b.subject AND a.p <> b.p AND a.p IN (0, 5)""",
    "one AS (SELECT 1)",
)
def session_theta_targets(spark, d):
    """Every target of a session with every other pair and their distance, from the same plan."""
    stim, _, _, pairs = recorded_subjects(spark, d)
    label = F.concat_ws("-", "anode_label", "cathode_label").alias("label")
    targets = stim.select("subject", "session", label).distinct().join(pairs.select("subject", "label", F.col("pair_idx").alias("stim_idx")), ["subject", "label"])
    apart = tmi.both_ways(montage.pair_distances(pairs, ["subject"]), "adjacency")
    return targets.join(apart, ["subject", "stim_idx"]).select("subject", "session", "stim_idx", "pair_idx", F.round("value", 9).alias("distance"))


BAND = (10.0, 14.0)


def one_way_sql(name, source, backward):
    """A recursive query of the sections over each channel's samples in turn: (c, t, y). source: (c, t, x), t from 0."""
    sections = [[float(v) for v in (*b, *a[1:])] for b, a in notch.sections(*BAND, 64.0)]
    turned = f"(SELECT c, {'max(t) OVER (PARTITION BY c) - t' if backward else 't'} AS t, x FROM {source})"
    begin = ", ".join(f"x * ({b1!r} - {a1!r} + {b2!r} - {a2!r}) AS s{k}, x * ({b2!r} - {a2!r}) AS r{k}" for k, (_, b1, b2, a1, a2) in enumerate(sections))
    inner, u = "SELECT v.c, v.t, v.x, " + ", ".join(f"s{k}, r{k}" for k in range(len(sections))) + f" FROM f{name} f JOIN i{name} v ON v.c = f.c AND v.t = f.t + 1", "x"
    for k, (b0, *_) in enumerate(sections):
        inner, u = f"SELECT *, {b0!r} * {u} + s{k} AS y{k} FROM ({inner})", f"y{k}"
    inputs = ["x", *(f"y{k}" for k in range(len(sections) - 1))]
    states = ", ".join(f"{b1!r} * {u} - {a1!r} * y{k} + r{k}, {b2!r} * {u} - {a2!r} * y{k}" for k, (u, (_, b1, b2, a1, a2)) in enumerate(zip(inputs, sections, strict=True)))
    return f"""i{name} AS (SELECT * FROM {turned}),
    f{name} AS (SELECT c, CAST(-1 AS BIGINT) AS t, x AS y, {begin} FROM i{name} WHERE t = 0 UNION ALL SELECT c, t, y{len(sections) - 1}, {states} FROM ({inner})),
    {name} AS (SELECT c, {"max(t) OVER (PARTITION BY c) - t" if backward else "t"} AS t, y AS x FROM f{name} WHERE t >= 0)"""


WAVES = """RECURSIVE waves AS (SELECT 'f' || vec_id // 512 || '/' || vec_id % 16 AS c, vec_id % 512 // 16 * 64 + i AS t, x FROM (SELECT vec_id, unnest(range(64)) AS i, CAST(unnest(embedding) AS DOUBLE) AS x FROM embeddings))"""


@query(
    " SELECT c AS channel, CAST(t AS BIGINT) AS sample, round(x, 6) AS value FROM back",
    WAVES,
    one_way_sql("there", "waves", False),
    one_way_sql("back", "there", True),
)
def notch_filtered(spark, d):
    """Whole recordings without 10 to 14 hertz, from their chunks."""
    got = notch.without_band(recorded_subjects(spark, d)[2], *BAND)
    rows = got.select(F.concat_ws("/", "eegfile", F.col("pair_idx").cast("string")).alias("channel"), "chunk_id", F.posexplode("samples").alias("i", "value"))
    return rows.select("channel", (F.col("chunk_id") * 64 + F.col("i")).cast("long").alias("sample"), (F.round("value", 6) + 0.0).alias("value"))
