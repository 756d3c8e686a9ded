"""Queries of the report jobs over the whole log; importing this module registers them."""

from __future__ import annotations

from pyspark.sql import functions as F

from mnesis.plans import adapters as a
from mnesis.plans import report_jobs as jobs
from mnesis.plans.catalog import query, rounded
from mnesis.sources import scratch

#: Experiments of ``report_log`` and of ``report_items``: every builder of reports, and some without one.
EXPERIMENTS = ["FR1", "catFR1", "RepFR1", "FR2", "catFR5", "TICL_FR", "PS4_FR", "PS5_FR", "LocationSearch", "DBOY1", "PAL1"]
STIM_EXPERIMENTS = ["FR2", "catFR5", "TICL_FR", "PS4_FR", "PS5_FR", "LocationSearch", "FR3", "PAL2"]


def pick(names, at):
    return F.element_at(F.array(*map(F.lit, names)), (at % len(names) + 1).cast("int"))


def report_log(spark, d):
    log = a.shared_log(spark, d)
    user = F.substring("file", 2, 20).cast("long")
    return log.withColumns({"experiment": pick(EXPERIMENTS, user), "repeats": F.col("seq") % 3 + 1, "iscorrect": F.col("recalled"), "type": F.when((F.col("type") == "STIM_OFF") & (F.col("seq") % 4 == 0), "STIM_ON").otherwise(F.col("type"))})


def report_items(spark, d):
    return a.items(spark, d).withColumns({"experiment": pick(STIM_EXPERIMENTS, F.col("subject")), "subject": F.concat(F.lit("S"), (F.col("subject") % 5).cast("string"))})


LOG = f"""report_log AS (SELECT * REPLACE ({EXPERIMENTS}[CAST(file[2:] AS BIGINT) % {len(EXPERIMENTS)} + 1] AS experiment, CASE WHEN type = 'STIM_OFF' AND seq % 4 = 0 THEN 'STIM_ON' ELSE type END AS type), seq % 3 + 1 AS repeats, recalled AS iscorrect FROM shared_log)"""
ITEMS = f"""report_items AS (SELECT * REPLACE ({STIM_EXPERIMENTS}[subject % {len(STIM_EXPERIMENTS)} + 1] AS experiment, 'S' || subject % 5 AS subject) FROM items)"""
BEHAVES = "experiment IN ('FR1', 'catFR1', 'RepFR1', 'FR2', 'catFR5', 'TICL_FR', 'PS5_FR', 'DBOY1')"
STIMULATES = "experiment IN ('FR2', 'catFR5', 'TICL_FR', 'PS5_FR', 'FR3')"
KEYS = "experiment, subject, session"


def select(product, source, where, sums, k1="NULL", k2="NULL", low="NULL", high="NULL"):
    values = ", ".join(f"CAST({sums[k] if k < len(sums) else 'NULL'} AS DOUBLE) AS m{k + 1}" for k in range(8))
    return f"SELECT '{product}' AS product, CAST({k1} AS VARCHAR) AS k1, CAST({k2} AS VARCHAR) AS k2, {KEYS}, {values}, CAST({low} AS DOUBLE) AS low, CAST({high} AS DOUBLE) AS high FROM {source} WHERE {where} GROUP BY ALL"


N, HITS = "count(*)", "sum(recalled)"
FIRST = f"(SELECT {KEYS}, list, arg_min(serialpos, (mstime, seq)) AS serialpos FROM report_log WHERE type = 'WORD' AND recalled = 1 GROUP BY ALL)"
PAUSES = f"""(SELECT {KEYS}, mstime - lag(mstime) OVER w AS irt, category_num = lag(category_num) OVER w AS within FROM report_log WHERE type IN ('REC_EVENT', 'REC_WORD') AND recalled = 1 AND intrusion = 0
  WINDOW w AS (PARTITION BY {KEYS}, list ORDER BY mstime, seq))"""
MATHS = f"(SELECT {KEYS}, list, count(*) AS n, count(*) FILTER (iscorrect = 1) AS c FROM report_log WHERE type = 'PROB' AND list > -1 GROUP BY ALL)"
LISTS = f"(SELECT {KEYS}, list, bool_and(is_stim_list) AS stim FROM report_items GROUP BY ALL)"
half = lambda mask: [f"count(*) FILTER ({mask})", f"coalesce(sum(recalled) FILTER ({mask}), 0)"]
SELECTS = [
    select("session_summary", "report_log", BEHAVES, ["count(*) FILTER (type = 'WORD')", "sum(recalled) FILTER (type = 'WORD')", "count(DISTINCT list)", "count(*) FILTER (intrusion > 0)", "count(*) FILTER (intrusion = -1)"], low="min(mstime)", high="max(mstime)"),
    select("serialpos", "report_log", f"{BEHAVES} AND type = 'WORD'", [N, HITS], "serialpos"),
    select("first_recall", FIRST, BEHAVES, [N], "serialpos", high="max(list)"),
    select("math_summary", MATHS, f"{BEHAVES} AND experiment <> 'PS5_FR'", ["sum(n)", "sum(c)", N]),
    select("repeats", "report_log", "experiment = 'RepFR1' AND type = 'WORD' AND serialpos BETWEEN 3 AND 23", [N, HITS], "repeats"),
    select("category_times", PAUSES, f"{BEHAVES} AND irt IS NOT NULL", ["count(*) FILTER (within)", "coalesce(sum(irt) FILTER (within), 0)", "count(*) FILTER (NOT within)", "coalesce(sum(irt) FILTER (NOT within), 0)"]),
    select("stim_counts", "report_log", "experiment = 'TICL_FR' AND type = 'STIM_ON'", [N], "phase"),
    select("stim_lists", LISTS, STIMULATES, ["count(*) FILTER (stim)", "count(*) FILTER (NOT stim)"]),
    select("recalls_by_list", "report_items", STIMULATES, [N, HITS, "count(*) FILTER (is_stim_item)"], "list"),
    select("output_by_serialpos", "report_items", STIMULATES, [N, "sum(CAST(classifier_output AS DOUBLE))"], "serialpos"),
    select("recall_by_stim", "report_items", STIMULATES, [N, HITS], "serialpos", "is_stim_item"),
    select("delta_recall", "report_items", STIMULATES, [N, HITS, *half("classifier_output < thresh AND NOT is_stim_list"), *half("is_stim_item"), *half("is_post_stim_item")]),
    select("stim_targets", "report_items", "experiment = 'LocationSearch' AND is_stim_item AND stimAnodeTag IS NOT NULL", [N], "stimAnodeTag", "stimCathodeTag", high="max(amplitude)"),
    select("locations", "report_items", "experiment = 'PS4_FR'", [N, "sum(CAST(classifier_output AS DOUBLE))", "sum(CAST(classifier_output AS DOUBLE) ** 2)"], "CASE WHEN is_stim_list THEN 'stim' ELSE 'none' END", "serialpos"),
]
FACTS = "facts AS (" + " UNION ALL ".join(f"({s})" for s in SELECTS) + ")"
SUMMED = ", ".join(f"round(sum(m{k}), 6) AS m{k}" for k in range(1, 9))
RATIO = """CASE WHEN product = 'delta_recall' THEN 100 * (m6 / nullif(m5, 0) - m4 / nullif(m3, 0)) / nullif(m2 / nullif(m1, 0), 0) WHEN product = 'first_recall' THEN m1 / nullif(high, 0) WHEN product IN ('output_by_serialpos', 'locations') THEN m2 / nullif(m1, 0)
  WHEN product = 'category_times' THEN m2 / nullif(m1, 0) / nullif(m4 / nullif(m3, 0), 0) WHEN product IN ('session_summary', 'serialpos', 'math_summary', 'repeats', 'recalls_by_list', 'recall_by_stim') THEN 100 * m2 / nullif(m1, 0) END"""
SQL = f""", t AS (SELECT ['session', 'subject', 'experiment', 'all'][grouping(experiment) + grouping(subject) + grouping(session) + 1] AS level, {KEYS}, product, k1, k2, {SUMMED}, min(low) AS low, max(high) AS high
  FROM facts GROUP BY GROUPING SETS ((product, k1, k2, experiment, subject, session), (product, k1, k2, experiment, subject), (product, k1, k2, experiment), (product, k1, k2)))
  SELECT *, round({RATIO}, 6) AS ratio FROM t"""


@query(SQL, a.FULL_LOG, a.SHARED_LOG, LOG, a.ITEMS, ITEMS, FACTS)
def report_products(spark, d):
    """The contents of every product of every experiment's report, written once and read again."""
    got = jobs.save_all(report_log(spark, d), report_items(spark, d), a.LOG_ORDER, scratch.folder(spark, "reports"))
    return rounded(got.select("level", *jobs.RECORDING, "product", "k1", "k2", *jobs.SUMS, "low", "high", "ratio"), *jobs.SUMS, "ratio", digits=6)


@query(
    f""", m AS (SELECT experiment, subject, k1, CAST(k2 AS DOUBLE) AS amplitude, sum(m2) / sum(m1) AS m, sqrt(greatest(0, (sum(m3) - sum(m2) ** 2 / sum(m1)) / nullif(sum(m1) - 1, 0)) / sum(m1)) AS sem FROM facts WHERE product = 'locations' GROUP BY ALL),
    b AS (SELECT experiment, subject, k1, arg_max(m, (m, amplitude)) AS m, arg_max(sem, (m, amplitude)) AS sem FROM m GROUP BY ALL),
    t AS (SELECT x.experiment, x.subject, (x.m - y.m) / nullif(sqrt(x.sem ** 2 + y.sem ** 2), 0) AS t, x.sem AS xs, y.sem AS ys FROM b x JOIN b y ON x.experiment = y.experiment AND x.subject = y.subject AND x.k1 = 'none' AND y.k1 = 'stim')
    SELECT experiment, subject, round(t, 6) AS t_stat, CASE WHEN abs(t) > 1.6448536269514722 THEN 0 ELSE 1 END AS tie,
      CASE WHEN CASE WHEN abs(t) > 1.6448536269514722 THEN t > 0 ELSE xs < ys END THEN 'none' ELSE 'stim' END AS best_location FROM t""",
    a.FULL_LOG, a.SHARED_LOG, LOG, a.ITEMS, ITEMS, FACTS,
)
def report_decisions(spark, d):
    """The choice of a location from the report's sums, which are added up by subject as the choice is a subject's."""
    report = jobs.build_all(report_log(spark, d), report_items(spark, d), a.LOG_ORDER, levels=["subject"])
    return jobs.decisions(report).select("experiment", "subject", F.round("t_stat", 6).alias("t_stat"), "tie", "best_location")
