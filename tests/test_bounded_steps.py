"""Steps that a session, a list or a fit went through row by row or again and again: the same results in one pass."""

import random

from pyspark.sql import functions as F

from mnesis.operators import behavior, retrieval, stats

LOG = "subject string, session long, list long, mstime long, type string, intrusion long, seq long"


def plan(df):
    return df._jdf.queryExecution().toString()


def free_log(seed):
    r, rows = random.Random(seed), []
    for s in range(4):
        for lst in r.sample(range(9), 6):
            t = lst * 200_000
            if r.random() < 0.9:
                rows.append(("S", s, lst, t, "REC_START", 0))
            for _ in range(r.randrange(5)):
                t += r.choice([700, 1500, 2500, 4000, 8000])
                rows.append(("S", s, lst, t, r.choice(["REC_WORD", "REC_WORD", "REC_WORD_VV", "WORD"]), r.choice([0, 0, 0, 1])))
    rows += [(None, 0, 1, 5, "REC_WORD", 0), ("S", 1, None, 9, "REC_WORD", 0)]
    return [(*x, i) for i, x in enumerate(rows)]


def plain_free_epochs(rows, duration, pre, post, reach):
    """Every recall against every epoch."""
    out = set()
    rows = [x for x in rows if x[0] is not None and x[2] is not None]
    for s in {x[1] for x in rows}:
        own = [x for x in rows if x[1] == s]
        begun = {x[2]: x[3] for x in own if x[4] == "REC_START"}
        epochs = []
        for lst in begun:
            times = sorted(x[3] for x in own if x[2] == lst and x[4] != "WORD")
            epochs += [(lst, t - begun[lst], t) for a, b in zip(times, times[1:]) if b - pre - duration > a + post for t in range(a + post, b - pre - duration, duration)]
        pairs = sorted((x[3], abs(e[0] - x[2]), e[0], e[1], x[2], e[2]) for x in own if x[4] == "REC_WORD" and x[5] == 0 and x[2] in begun for e in epochs if e[0] != x[2] and abs(e[1] - (x[3] - begun[x[2]])) <= reach)
        used, turns = set(), dict.fromkeys((p[0], p[4]) for p in pairs)
        for ms, lst in turns:
            for p in pairs:
                if (p[0], p[4]) == (ms, lst) and (p[2], p[5]) not in used:
                    used.add((p[2], p[5]))
                    out.add(("S", s, lst, ms, p[2], p[5]))
                    break
    return out


def test_free_epochs_without_pairs_of_all_recalls_and_epochs(spark):
    """The choices of the plain search, and no join that makes a row of each recall and epoch."""
    for seed in range(3):
        rows = free_log(seed)
        got = retrieval.free_epoch_baseline(spark.createDataFrame([tuple(x) for x in rows], LOG), ["subject", "session"], ["mstime", "seq"], duration=300, pre=200, post=200, reach=1500)
        found = [tuple(q) for q in got.collect()]
        assert len(found) == len(set(found)) and set(found) == plain_free_epochs(rows, 300, 200, 200, 1500) and found
    assert "Join" not in plan(got) and plan(got).count("Generate") == 0


def test_recalls_of_one_time_take_turns(spark):
    """Times that count from each list's start coincide; what is nearer to its first epoch goes first."""
    rows = [("S", 1, lst, 0, "REC_START", 0) for lst in (1, 2, 4, 7)] + [("S", 1, lst, t, "REC_WORD", 0) for lst in (1, 2, 4, 7) for t in (2000, 5000)]
    rows = [(*x, i) for i, x in enumerate(rows)]
    got = retrieval.free_epoch_baseline(spark.createDataFrame(rows, LOG), ["subject", "session"], ["mstime", "seq"], duration=300, pre=200, post=200, reach=1500)
    assert {tuple(q) for q in got.collect()} == plain_free_epochs(rows, 300, 200, 200, 1500)


def test_sessions_are_walked_through(spark):
    """A session split over batches and sessions of one row each: all rows, in order, and no pandas frame for each session."""
    df = spark.range(500).select(F.when(F.col("id") < 300, 0).otherwise(F.col("id")).alias("session"), (500 - F.col("id")).alias("x"))
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        got = retrieval.by_session(df, ["session"], ["x"], lambda rows: [(len(rows), rows == sorted(rows))], "n long, sorted boolean", rows=3).collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)
    assert sorted((q.session, q.n) for q in got) == [(0, 300), *[(k, 1) for k in range(300, 500)]] and all(q.sorted for q in got)
    log = spark.createDataFrame([("S", 1, 1, 0, 0, "REC_START", 0, 0)], "subject string, session long, list long, mstime long, rectime long, type string, intrusion long, seq long")
    assert "FlatMapGroupsInPandas" not in plan(retrieval.matched_deliberation(log, ["subject", "session"], ["mstime"]))


def test_parameters_of_a_list_without_a_join(spark):
    """Each item with each set of its list; rows without a key have none; -0.0 and 0.0 are one set."""
    shape = "subject string, experiment string, session long, list long, item long, stimAnodeTag string, stimCathodeTag string, location string, amplitude double, stim_duration long, pulse_freq long"
    rows = [("S", "E", 1, 1, 0, "A", "B", None, 0.0, 1, 2), ("S", "E", 1, 1, 1, "A", "B", None, -0.0, 1, 2), ("S", "E", 1, 1, 2, None, None, None, None, None, None), ("S", "E", None, 1, 3, "A", "B", None, 1.0, 1, 2)]
    got = behavior.stim_params_by_list(spark.createDataFrame(rows, shape))
    assert "Join" not in plan(got)
    assert sorted((q.item, q.amplitude is None, q.stimAnodeTag or "") for q in got.collect()) == [(k, f, "" if f else "A") for k in range(3) for f in (False, True)] + [(3, True, "")]


def test_stim_effect_counts_rows_once(spark):
    """Coefficients of planted odds, finite where outcomes are separated, from cells and not from passes over the rows."""
    cells = [(1, 0, 30, 70), (0, 0, 50, 50), (1, 1, 60, 40), (0, 1, 80, 20)]
    rows = [(y, bool(flag), x) for flag, x, no, yes in cells for y, n in ((0, no), (1, yes)) for _ in range(n)]
    df = spark.createDataFrame(rows, "recalled int, is_stim_item boolean, x int")
    got = stats.stim_effect(df, "is_stim_item", ["x"])
    b = {q.term: q.coefficient for q in got.collect()}
    assert set(b) == {"is_stim_item", "x", "intercept"} and 0.8 < b["is_stim_item"] < 1.0 and -1.4 < b["x"] < -1.2 and abs(b["intercept"]) < 0.1
    assert "HashAggregate" in plan(got)
    apart = {q.term: q.coefficient for q in stats.stim_effect(df.withColumn("recalled", F.col("is_stim_item").cast("int")), "is_stim_item", ["x"]).collect()}
    assert 10 < apart["is_stim_item"] < 100 and apart["intercept"] < -5
