"""The driver's tables as event logs, items, powers and the like; the SQL says the same for the check of results."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: What orders the rows of ``items`` whose order counts and line numbers repeat.
ITEM_ORDER = ["orderkey", "serialpos", "shipdate", "partkey", "session", "price"]
LOG_ORDER = ["mstime", "seq"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def session_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    k = F.regexp_extract("props", r"(\d+)", 1).cast("long")
    kind = F.create_map(*[F.lit(x) for x in ("view", "WORD", "click", "STIM_ON", "signup", "REC_WORD", "error", "WORD_OFF", "purchase", "STIM_OFF")])
    ts = F.col("ts").cast("timestamp")
    return e.select(
        F.concat(F.lit("S"), (F.col("user_id") % 5).cast("string")).alias("subject"),
        F.when(F.col("user_id") % 3 == 0, "FR2").when(F.col("user_id") % 3 == 1, "PAL1").otherwise("catFR1").alias("experiment"),
        F.col("user_id").alias("session"),
        F.dayofmonth(ts).cast("long").alias("list"),
        F.unix_millis(ts).alias("mstime"),
        F.col("event_id").alias("seq"),
        F.element_at(kind, F.col("event_type")).alias("type"),
        (k % 5).alias("category_num"),
        (F.col("value") > 20).cast("long").alias("recalled"),
        (k % 3 - 1).alias("intrusion"),
        (k % 24 + 1).alias("serialpos"),
        (k % 3 + 1).alias("repeats"),
        F.col("value"),
    )


SESSION_LOG = """session_log AS (SELECT 'S' || CAST(user_id % 5 AS VARCHAR) AS subject,
  CASE user_id % 3 WHEN 0 THEN 'FR2' WHEN 1 THEN 'PAL1' ELSE 'catFR1' END AS experiment, user_id AS session,
  CAST(day(ts) AS BIGINT) AS list, epoch_us(ts) // 1000 AS mstime, event_id AS seq,
  CASE event_type WHEN 'view' THEN 'WORD' WHEN 'click' THEN 'STIM_ON' WHEN 'signup' THEN 'REC_WORD' WHEN 'error' THEN 'WORD_OFF' WHEN 'purchase' THEN 'STIM_OFF' END AS type,
  k % 5 AS category_num, CAST(value > 20 AS BIGINT) AS recalled, k % 3 - 1 AS intrusion, k % 24 + 1 AS serialpos, k % 3 + 1 AS repeats, value
  FROM (SELECT *, CAST(regexp_extract(props, '(\\d+)', 1) AS BIGINT) AS k FROM events))"""


def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority", "o_orderstatus")
    rows = table(spark, sf_dir, "lineitem").join(o, F.col("l_orderkey") == F.col("o_orderkey"))
    stim_list, stim_item = F.col("o_orderstatus") == "F", (F.col("o_orderstatus") == "F") & (F.col("l_linestatus") == "F")
    when = lambda v: F.when(stim_item, v)
    return rows.select(
        (F.col("o_custkey") % 20).alias("subject"),
        F.col("o_orderpriority").alias("experiment"),
        F.col("l_suppkey").alias("session"),
        (F.col("l_orderkey") % 25 + 1).alias("list"),
        F.col("l_linenumber").alias("serialpos"),
        (F.col("l_returnflag") == "A").cast("long").alias("recalled"),
        stim_list.alias("is_stim_list"),
        stim_item.alias("is_stim_item"),
        (stim_list & ~stim_item).alias("is_post_stim_item"),
        (F.col("l_discount") * 10).alias("classifier_output"),
        F.lit(0.5).alias("thresh"),
        when(F.concat(F.lit("A"), F.round(F.col("l_tax") * 100).cast("int") % 2)).alias("stimAnodeTag"),
        when(F.lit("C1")).alias("stimCathodeTag"),
        F.when(stim_item & (F.col("l_tax") > 0.04), F.lit("MTL")).alias("location"),
        when(F.round(F.col("l_tax") * 100).cast("int") % 3).alias("amplitude"),
        when(F.lit(500)).alias("stim_duration"),
        when(F.lit(200)).alias("pulse_freq"),
        F.col("l_orderkey").alias("orderkey"),
        F.col("l_shipdate").alias("shipdate"),
        F.col("l_partkey").alias("partkey"),
        F.col("l_extendedprice").alias("price"),
    )


ITEMS = """items AS (SELECT *, CASE WHEN is_stim_item THEN 'A' || CAST(tax % 2 AS VARCHAR) END AS stimAnodeTag, CASE WHEN is_stim_item THEN 'C1' END AS stimCathodeTag,
  CASE WHEN is_stim_item AND l_tax > 0.04 THEN 'MTL' END AS location, CASE WHEN is_stim_item THEN tax % 3 END AS amplitude,
  CASE WHEN is_stim_item THEN 500 END AS stim_duration, CASE WHEN is_stim_item THEN 200 END AS pulse_freq, is_stim_list AND NOT is_stim_item AS is_post_stim_item
  FROM (SELECT o_custkey % 20 AS subject, o_orderpriority AS experiment, l_suppkey AS session, l_orderkey % 25 + 1 AS list, l_linenumber AS serialpos,
    CAST(l_returnflag = 'A' AS BIGINT) AS recalled, o_orderstatus = 'F' AS is_stim_list, o_orderstatus = 'F' AND l_linestatus = 'F' AS is_stim_item,
    l_discount * 10 AS classifier_output, CAST(0.5 AS DOUBLE) AS thresh, CAST(round(l_tax * 100) AS INTEGER) AS tax, l_tax,
    l_orderkey AS orderkey, l_shipdate AS shipdate, l_partkey AS partkey, l_extendedprice AS price
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey))"""


def powers(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "embeddings")
    rows = e.select(F.col("vec_id").alias("event_id"), (F.col("vec_id") % 5).alias("session"), (F.col("vec_id") % 25).alias("list"), (F.col("label") % 2).alias("recalled"), F.posexplode("embedding").alias("i", "x"))
    return rows.select("event_id", "session", "list", "recalled", F.floor(F.col("i") / 8).cast("int").alias("pair_idx"), (F.col("i") % 8).alias("freq_idx"), F.col("x").cast("double").alias("power"))


POWERS = """powers AS (SELECT event_id, session, list, recalled, CAST(floor(i / 8) AS INTEGER) AS pair_idx, i % 8 AS freq_idx, power
  FROM (SELECT vec_id AS event_id, vec_id % 5 AS session, vec_id % 25 AS list, label % 2 AS recalled, unnest(range(64))::INTEGER AS i, CAST(unnest(embedding) AS DOUBLE) AS power FROM embeddings))"""


def scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "embeddings")
    return e.select((F.col("vec_id") % 5).alias("session"), F.round(F.col("embedding")[0].cast("double"), 2).alias("score"), (F.col("label") % 2).alias("outcome"))


SCORES = "scores AS (SELECT vec_id % 5 AS session, round(CAST(embedding[1] AS DOUBLE), 2) AS score, label % 2 AS outcome FROM embeddings)"


def math_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return o.select((F.col("o_custkey") % 10).alias("session"), (F.col("o_orderkey") % 25).alias("list"), F.when(F.col("o_orderstatus") == "P", "PROB").otherwise("START").alias("type"), (F.col("o_orderpriority") < "3").cast("int").alias("iscorrect"))


MATH = "math AS (SELECT o_custkey % 10 AS session, o_orderkey % 25 AS list, CASE o_orderstatus WHEN 'P' THEN 'PROB' ELSE 'START' END AS type, CAST(o_orderpriority < '3' AS INTEGER) AS iscorrect FROM orders)"


def pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    key = F.col("p_partkey")
    return p.select(
        key.alias("pair_idx"), (key % 40).alias("montage"), F.concat(F.lit("L"), key.cast("string"), F.lit("-L"), (key + 1).cast("string")).alias("label"),
        key.alias("channel_1"), (key + 1).alias("channel_2"), F.col("p_size").cast("double").alias("x"), (key % 97).cast("double").alias("y"), F.round(F.col("p_retailprice") % 50, 2).alias("z"),
    )


PAIRS = """pairs AS (SELECT p_partkey AS pair_idx, p_partkey % 40 AS montage, 'L' || CAST(p_partkey AS VARCHAR) || '-L' || CAST(p_partkey + 1 AS VARCHAR) AS label,
  p_partkey AS channel_1, p_partkey + 1 AS channel_2, CAST(p_size AS DOUBLE) AS x, CAST(p_partkey % 97 AS DOUBLE) AS y, round(p_retailprice % 50, 2) AS z FROM part)"""


def voxels(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "supplier")
    return s.select(F.col("s_suppkey").alias("region"), (F.col("s_suppkey") * 7 % 50).cast("double").alias("x"), (F.col("s_nationkey") * 4).cast("double").alias("y"), (F.col("s_suppkey") * 13 % 50).cast("double").alias("z"))


VOXELS = "voxels AS (SELECT s_suppkey AS region, CAST(s_suppkey * 7 % 50 AS DOUBLE) AS x, CAST(s_nationkey * 4 AS DOUBLE) AS y, CAST(s_suppkey * 13 % 50 AS DOUBLE) AS z FROM supplier)"


#: Event types of ``full_log`` in turn, so that every predicate meets rows that it holds for.
KINDS = "WORD REC_WORD WORD REC_BASE REC_EVENT TEST_PROBE PROBE_START STUDY_PAIR PROB START STOP REC_WORD_VV STIM_OFF REC_END VOCALIZATION_START REC_START".split()


def full_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log with all columns of event tables and rows of every kind; seq tells rows apart."""
    e = table(spark, sf_dir, "events")
    k = F.regexp_extract("props", r"(\d+)", 1).cast("long")
    ts = F.col("ts").cast("timestamp")
    day = F.dayofmonth(ts).cast("long") % 12
    pick = lambda names, at: F.element_at(F.array(*map(F.lit, names)), (at % len(names) + 1).cast("int"))
    return e.select(
        F.concat(F.lit("S"), (F.col("user_id") % 5).cast("string")).alias("subject"),
        pick(["FR1", "PAL1", "catFR1", "FR2", "PS5_FR", "TICL_FR"], F.col("user_id")).alias("experiment"),
        F.col("user_id").alias("session"),
        F.when(day == 0, -999).otherwise(day - 2).alias("list"),
        F.unix_millis(ts).alias("mstime"),
        F.col("event_id").alias("seq"),
        pick(KINDS, F.col("event_id")).alias("type"),
        F.when(F.col("user_id") % 2 == 0, "STIM").otherwise("NON-STIM").alias("phase"),
        (F.col("value") > 20).cast("long").alias("recalled"),
        (k % 3 - 1).alias("intrusion"),
        (k % 12 + 1).alias("serialpos"),
        F.when(F.col("event_id") % 40 == 0, -1).otherwise(F.col("event_id")).alias("eegoffset"),
        (k % 2 == 0).alias("matched"),
        (k % 4 - 1).alias("correct"),
        F.when(k % 5 == 0, -999).otherwise(k * 10).alias("RT"),
        (k % 5).alias("category_num"),
        F.when(k % 7 == 0, "").otherwise("eeg").alias("eegfile"),
        F.concat(F.lit("w"), k.cast("string")).alias("item_name"),
        F.lit(0).cast("long").alias("rectime"),
        F.col("value"),
    )


def shared_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """full_log with session numbers that all subjects share; file tells recordings apart."""
    log = full_log(spark, sf_dir)
    return log.withColumns({"file": F.concat(F.lit("u"), F.col("session").cast("string")), "session": F.floor(F.col("session") / 5)})


SHARED_LOG = "shared_log AS (SELECT * REPLACE (session // 5 AS session), 'u' || session AS file FROM full_log)"


FULL_LOG = f"""full_log AS (SELECT 'S' || CAST(user_id % 5 AS VARCHAR) AS subject, ['FR1', 'PAL1', 'catFR1', 'FR2', 'PS5_FR', 'TICL_FR'][user_id % 6 + 1] AS experiment, user_id AS session,
  CASE WHEN day(ts) % 12 = 0 THEN -999 ELSE day(ts) % 12 - 2 END AS list, epoch_us(ts) // 1000 AS mstime, event_id AS seq, {KINDS}[event_id % {len(KINDS)} + 1] AS type,
  CASE user_id % 2 WHEN 0 THEN 'STIM' ELSE 'NON-STIM' END AS phase, CAST(value > 20 AS BIGINT) AS recalled, k % 3 - 1 AS intrusion, k % 12 + 1 AS serialpos,
  CASE WHEN event_id % 40 = 0 THEN -1 ELSE event_id END AS eegoffset, k % 2 = 0 AS matched, k % 4 - 1 AS correct, CASE WHEN k % 5 = 0 THEN -999 ELSE k * 10 END AS RT, k % 5 AS category_num,
  CASE WHEN k % 7 = 0 THEN '' ELSE 'eeg' END AS eegfile, 'w' || k AS item_name, 0 AS rectime, value
  FROM (SELECT *, CAST(regexp_extract(props, '(\\d+)', 1) AS BIGINT) AS k FROM events))"""
