"""Queries of readers, stored products and reports: Spark writes files made of the tables and reads them again; importing this
module registers them."""

from __future__ import annotations

from pyspark.sql import functions as F

from mnesis.functions import text
from mnesis.operators import behavior, montage
from mnesis.plans import adapters as a
from mnesis.plans import reports
from mnesis.plans.catalog import query
from mnesis.sources import readers, scratch, store

#: Files of a written index, pair tables and configurations.
FILES = 5
#: Files that a task writes.
FILES_A_TASK = 500
#: Rows of a bucket of settled items.
ROWS_A_TASK = 200_000


def written(df, spark, name):
    """df's one text column as files, one row each, by tasks of some hundred files; their folder."""
    path = scratch.folder(spark, name)
    df.repartition(max(1, -(-df.count() // FILES_A_TASK))).write.option("maxRecordsPerFile", 1).text(path)
    return path


def event_files(spark, log):
    """log as event files, one for each session, of a row a line; their index."""
    lines = log.select("session", "mstime", "seq", F.to_json(F.struct("session", "type", "mstime", "eegfile")).alias("line"))
    files = store.save_lines(lines, "session", "line", scratch.folder(spark, "events"), a.LOG_ORDER)
    return files.select(F.lit("S").alias("subject"), F.lit("FR1").alias("experiment"), "session", F.col("path").alias("all_events"))


@query(
    """SELECT 'S' || c_custkey AS subject, CASE WHEN o_orderkey % 2 = 0 THEN 'FR1' ELSE 'PAL1' END AS experiment, o_orderkey AS session, '/' || o_orderkey || '.json' AS all_events, o_orderstatus AS montage,
    NOT EXISTS (SELECT 1 FROM orders x WHERE x.o_custkey = c_custkey AND x.o_orderkey % 2 = 0) AS pal_only FROM customer JOIN orders ON c_custkey = o_custkey"""
)
def session_index(spark, d):
    o = a.table(spark, d, "orders")
    session = F.struct(F.concat(F.lit("/"), F.col("o_orderkey").cast("string"), F.lit(".json")).alias("all_events"), F.col("o_orderstatus").alias("montage"))
    rows = o.select((F.col("o_custkey") % FILES).alias("f"), F.concat(F.lit("S"), F.col("o_custkey").cast("string")).alias("subject"), F.when(F.col("o_orderkey") % 2 == 0, "FR1").otherwise("PAL1").alias("experiment"), F.col("o_orderkey").cast("string").alias("n"), session.alias("s"))
    nest = lambda key, value: F.map_from_entries(F.collect_list(F.struct(key, value)))
    rows = rows.groupBy("f", "subject", "experiment").agg(F.struct(nest("n", "s").alias("sessions")).alias("e"))
    rows = rows.groupBy("f", "subject").agg(F.struct(nest("experiment", "e").alias("experiments")).alias("v")).groupBy("f").agg(nest("subject", "v").alias("subjects"))
    path = written(rows.select(F.to_json(F.struct(F.struct(F.struct("subjects").alias("r1")).alias("protocols"))).alias("value")), spark, "index")
    index = readers.session_index(spark, path)
    fr = readers.subjects_of(index, "FR1").withColumn("_fr", F.lit(True))
    return index.join(fr, "subject", "left").select("subject", "experiment", "session", "all_events", "montage", F.col("_fr").isNull().alias("pal_only"))


@query("SELECT session, count(*) AS n, CAST(sum(mstime) AS BIGINT) AS total FROM full_log WHERE eegfile <> '' GROUP BY 1", a.FULL_LOG)
def indexed_events(spark, d):
    """Event files of an index, one for each session; rows without a recording don't count."""
    index = event_files(spark, a.full_log(spark, d))
    rows = readers.events(spark, index, multiline=False)
    return rows.groupBy("session").agg(F.count("*").alias("n"), F.sum("mstime").alias("total"))


@query("SELECT session, count(*) AS n, CAST(sum(mstime) AS BIGINT) AS total, 0 AS n_unread FROM full_log WHERE eegfile <> '' AND session % 5 <> 0 GROUP BY 1 UNION ALL SELECT session, 0, NULL, 1 FROM (SELECT DISTINCT session FROM full_log WHERE session % 5 = 0)", a.FULL_LOG)
def events_read_by_tasks(spark, d):
    """Event files that tasks open; every fifth session's file is missing, which makes a row of the report of unread files."""
    log = a.full_log(spark, d)
    gone = log.where("session % 5 = 0").select(F.lit("S").alias("subject"), F.lit("FR1").alias("experiment"), "session").distinct()
    gone = gone.withColumn("all_events", F.concat(F.lit(f"{scratch.folder(spark, 'events')}/none-"), F.col("session").cast("string"), F.lit(".json")))
    rows = readers.event_rows(event_files(spark, log.where("session % 5 <> 0")).unionByName(gone), multiline=False)
    return rows.groupBy("session").agg(F.count(F.when(F.col("error").isNull(), 1)).alias("n"), F.sum("mstime").alias("total"), F.count("error").cast("int").alias("n_unread"))


@query(
    """SELECT 'S' || montage AS subject, label, CAST(channel_1 AS INTEGER) AS channel_1, CAST(channel_2 AS INTEGER) AS channel_2, CASE WHEN x > 25 THEN 'CA1' ELSE '--' END AS location, CASE WHEN x > 25 THEN 'Hipp' ELSE 'Other' END AS region FROM pairs""",
    a.PAIRS,
)
def pair_files(spark, d):
    p = a.pairs(spark, d)
    one = F.struct(F.col("channel_1").cast("int").alias("channel_1"), F.col("channel_2").cast("int").alias("channel_2"), F.struct(F.struct(F.when(F.col("x") > 25, "CA1").alias("region")).alias("stein")).alias("atlases"))
    rows = p.groupBy("montage").agg(F.map_from_entries(F.collect_list(F.struct("label", one.alias("v")))).alias("pairs"))
    rows = rows.select(F.to_json(F.create_map(F.concat(F.lit("S"), F.col("montage").cast("string")), F.struct("pairs"))).alias("value"))
    got = readers.pairs(spark, written(rows, spark, "pairs"))
    place = text.atlas_location(F.struct("type_1", "atlases"))
    return got.select("subject", "label", "channel_1", "channel_2", place.alias("location"), text.region_name(place).alias("region"))


@query(
    """SELECT p.montage, p.label, p.channel_1 % 7 = 0 AS lead_excluded, p.channel_1 % 11 = 0 AS bad FROM pairs p""",
    a.PAIRS,
)
def contact_files(spark, d):
    """Jacksheets, excluded leads and bad channels, each a file of lines."""
    p = a.pairs(spark, d)
    root = scratch.folder(spark, "contacts")
    lead = F.concat(F.lit("L"), F.col("channel_1").cast("string"))
    p.select(F.concat_ws(" ", F.col("channel_1").cast("string"), lead).alias("value")).write.text(f"{root}/jacksheet")
    p.where("channel_1 % 7 = 0").select(lead.alias("value")).write.text(f"{root}/leads")
    bad = p.where("channel_1 % 11 = 0").groupBy((F.col("montage") % FILES).alias("f")).agg(F.array_join(F.sort_array(F.collect_list(lead)), "\n").alias("l"))
    bad_path = written(bad.select(F.concat(F.lit("Bad electrodes:\n"), F.col("l"), F.lit("\nNotes: none\nother")).alias("value")), spark, "bad")
    numbers = readers.jacksheet(spark, f"{root}/jacksheet").select(F.col("number").cast("long").alias("channel_1"), F.col("label").alias("lead"))
    excluded = readers.leads(spark, f"{root}/leads").distinct().withColumn("_x", F.lit(True))
    broken = readers.bad_channels(spark, bad_path).select(F.col("label").alias("lead")).distinct().withColumn("_b", F.lit(True))
    rows = p.join(numbers, "channel_1").join(excluded, "lead", "left").join(broken, "lead", "left")
    return rows.select("montage", "label", F.col("_x").isNotNull().alias("lead_excluded"), F.col("_b").isNotNull().alias("bad"))


@query(
    """SELECT CAST(p_partkey AS INTEGER) AS channel_1, CAST(p_partkey + 1 AS INTEGER) AS channel_2, 'L' || p_partkey || '-L' || (p_partkey + 1) AS label FROM part WHERE EXISTS (SELECT 1 FROM part q WHERE q.p_partkey = part.p_partkey + 1) AND p_partkey // 100 = (p_partkey + 1) // 100"""
)
def electrode_configs(spark, d):
    """A configuration for each hundred contacts; pairs of neighbours are its sense channels."""
    p = a.table(spark, d, "part").select("p_partkey", F.floor(F.col("p_partkey") / 100).alias("f"))
    k = F.col("p_partkey").cast("string")
    contact = F.concat(F.lit("L"), k, F.lit(","), k, F.lit(","), k, F.lit(",0.5,#L#"))
    both = p.join(p.select((F.col("p_partkey") - 1).alias("p_partkey"), "f"), ["p_partkey", "f"], "left_semi")
    sense = both.groupBy("f").agg(F.sort_array(F.collect_list(F.concat(F.lit("s"), k, F.lit(",x,"), k, F.lit(","), (F.col("p_partkey") + 1).cast("string"), F.lit(",x,#x#")))).alias("s"))
    rows = p.groupBy("f").agg(F.sort_array(F.collect_list(contact)).alias("c")).join(sense, "f")
    body = F.concat(F.lit("ODINConfigurationVersion:,#1.2#\nContacts:\n"), F.array_join("c", "\n"), F.lit("\nSenseChannels:\n"), F.array_join("s", "\n"), F.lit("\nStimulationChannels:\n"))
    return readers.electrode_config(spark, written(rows.select(body.alias("value")), spark, "configurations")).select("channel_1", "channel_2", "label")


@query("SELECT CAST(s_suppkey AS VARCHAR) AS name, CAST(s_suppkey * 10 AS DOUBLE) AS sample_rate FROM supplier")
def sample_rate_files(spark, d):
    s = a.table(spark, d, "supplier")
    rows = s.select(F.to_json(F.create_map(F.concat(F.lit("eeg"), F.col("s_suppkey").cast("string")), F.struct((F.col("s_suppkey") * 10).cast("double").alias("sample_rate"), F.col("s_suppkey").alias("n")))).alias("value"))
    path = written(rows, spark, "sources")
    return readers.sample_rates(spark, path).select((F.col("sample_rate") / 10).cast("int").cast("string").alias("name"), "sample_rate")


@query(
    """SELECT subject, experiment, session, count(*) AS n, CAST(sum(recalled) AS BIGINT) AS n_recalled, session % 7 = 0 AS was_missing FROM full_log GROUP BY 1, 2, 3""",
    a.FULL_LOG,
)
def stored_products(spark, d):
    """Products by session: all but some are stored, those that lack are found and stored, and all are read again."""
    log = a.full_log(spark, d).select("subject", "experiment", "session", "seq", "recalled")
    root = scratch.folder(spark, "products")
    wanted = log.select("subject", "experiment", "session").distinct()
    store.save(log.where("session % 7 <> 0"), root, "items")
    names = store.missing(spark, root, "items", wanted).select("subject", "experiment", "session").withColumn("was_missing", F.lit(True))
    found = scratch.folder(spark, "missing")
    names.write.parquet(found)
    names = spark.read.parquet(found)
    store.save(log.join(names, ["subject", "experiment", "session"], "left_semi"), root, "items")
    rows = store.load_existing(spark, root, ["items"], wanted)["items"]
    rows = rows.groupBy("subject", "experiment", F.col("session").cast("long").alias("session")).agg(F.count("*").alias("n"), F.sum("recalled").alias("n_recalled"))
    return rows.join(names, ["subject", "experiment", "session"], "left").withColumn("was_missing", F.coalesce("was_missing", F.lit(False)))


@query(
    """SELECT o_orderkey AS session, o_orderstatus AS source FROM orders"""
)
def joint_sessions(spark, d):
    """Sessions that have a recording of their own, and the montage's for the others."""
    o = a.table(spark, d, "orders").select(F.col("o_orderkey").alias("session"), F.col("o_orderstatus").alias("source"))
    recorded, other = o.where("session % 2 = 0"), o
    both = readers.recorded_or_montage(recorded, other, "session")
    joint = store.joint_sessions(both.where("source = 'F'").select("session"), both.where("source <> 'F'").select((F.col("session") - 100).alias("session")))
    return both.join(joint, "session", "left_semi")


def report_inputs(spark, d):
    log = a.full_log(spark, d)
    return {"events": log, "math": log.withColumn("iscorrect", F.col("recalled")), "items": a.items(spark, d)}


REPORT_COUNTS = """, s AS (SELECT DISTINCT subject, experiment, session FROM full_log), w AS (SELECT DISTINCT subject, experiment, session, serialpos FROM full_log WHERE type = 'WORD'), ws AS (SELECT DISTINCT subject, experiment, session FROM full_log WHERE type = 'WORD'),
  m AS (SELECT DISTINCT subject, experiment, session FROM full_log WHERE type = 'PROB' AND list > -1)
  SELECT * FROM (SELECT 'session_summary' AS key, count(*) AS n FROM s UNION ALL SELECT 'combined_summary', 1 UNION ALL SELECT 'serialpos', count(*) FROM w UNION ALL SELECT 'first_recall', 12 * count(*) FROM ws UNION ALL
  SELECT 'math_summary', 1 + count(*) FROM m UNION ALL SELECT 'delta_recall', count(DISTINCT subject) FROM items UNION ALL SELECT 'stim_lists', count(DISTINCT subject) FROM items UNION ALL
  SELECT 'recalls_by_list', count(*) FROM (SELECT DISTINCT subject, list FROM items) UNION ALL SELECT 'output_by_serialpos', count(*) FROM (SELECT DISTINCT subject, serialpos FROM items) UNION ALL
  SELECT 'recall_by_stim', count(*) FROM (SELECT DISTINCT subject, serialpos, is_stim_item FROM items))"""


@query(REPORT_COUNTS, a.FULL_LOG, a.ITEMS)
def open_loop_report(spark, d):
    """The rows of each table of an open-loop report over all sessions."""
    tables = reports.build("FR2", report_inputs(spark, d))
    kept = {k: t for k, t in tables.items() if k not in ("category_times", "repetition_ratio", "stim_parameters", "recall_tests")}
    return reports.gold(kept).groupBy("key").agg(F.count("*").alias("n"))


@query()
def reports_by_experiment(spark, d):
    """The number of rows of every table of the reports of closed loops and of comparisons of locations, through the dispatch
    by experiment. Tables of stimulation share items that are joined and dealt by recording once."""
    log = a.full_log(spark, d)
    items = a.items(spark, d).drop("orderkey", "shipdate", "partkey", "price")
    items = store.dealt(items, reports.SESSION, "items", max(1, -(-a.table(spark, d, "lineitem").count() // ROWS_A_TASK)))
    inputs = report_inputs(spark, d) | {
        "items": items,
        "scored": log.select("seq", "session", "type", "recalled", (F.col("value") / 100).alias("probability")),
        "biomarkers": log.select(F.when(F.col("seq") % 2 == 0, "pre").otherwise("post").alias("position"), "phase", F.floor(F.col("seq") / 2).cast("string").alias("id")),
        "rows": items.select("subject", "session", F.when(F.col("is_stim_list"), "A").otherwise("B").alias("loc_name"), F.lit("STIM").alias("list_phase"), F.col("serialpos").cast("double").alias("amplitude"), F.col("classifier_output").alias("delta_classifier"), F.col("classifier_output").alias("post_stim_output")),
    }
    out = None
    for experiment in ("catFR5", "TICL_FR", "PS4_FR"):
        for key, table in reports.build(experiment, inputs).items():
            one = table.agg(F.count("*").alias("n")).select(F.lit(experiment).alias("experiment"), F.lit(key).alias("key"), "n")
            out = one if out is None else out.unionByName(one)
    return out


@query("SELECT DISTINCT pair_idx % 4 AS region FROM pairs", a.PAIRS)
def model_regions(spark, d):
    return behavior.classifier_regions(montage.model_pairs(a.pairs(spark, d), a.pairs(spark, d).where("false")).withColumn("region", F.col("pair_idx") % 4))
