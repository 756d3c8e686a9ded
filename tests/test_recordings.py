"""Recordings of several subjects with equal session numbers stay apart, and cleaning finds baselines by default."""

import pytest
from pyspark.sql import functions as F

from mnesis.operators import behavior, clean, masks, model, stats
from mnesis.plans import reports

EVENTS = "file string, subject string, experiment string, session long, list long, mstime long, rectime long, type string, intrusion long, eegoffset long, recalled long, item_name string, serialpos long"


def recall_rows(file, subject, experiment="FR1", shift=0):
    """Three trials with words, recalls and ends; only the first row names the subject."""
    rows = []
    for trial in range(3):
        begun = 100_000 * trial + shift
        rows += [(file, "", experiment, 0, trial, begun - 5000 + k, -999, "WORD", 0, begun + k, k % 2, f"w{k}", k + 1) for k in range(3)]
        rows.append((file, "", experiment, 0, trial, begun, 0, "REC_START", 0, begun, 0, "X", 0))
        rows += [(file, "", experiment, 0, trial, begun + t, t, "REC_WORD", 0, begun + t, 1, f"w{t}", 0) for t in ((5000, 12_000), (9000,), (20_000, 25_000))[trial]]
        rows.append((file, "", experiment, 0, trial, begun + 45_000, 45_000, "REC_END", 0, begun + 45_000, 0, "X", 0))
    return [(file, subject, *rows[0][2:]), *rows[1:]]


@pytest.fixture(scope="module")
def two(spark):
    return spark.createDataFrame(recall_rows("a.json", "A") + recall_rows("b.json", "B", shift=7), EVENTS)


def test_cleaning_fills_subjects_by_file(spark, two):
    got = clean.clean_events(two, ["subject", "session"], ["mstime", "eegoffset"])[0]
    counts = {(r.subject, r.type, r.recalled): r["count"] for r in got.groupBy("subject", "type", "recalled").count().collect()}
    alone = clean.clean_events(two.where("file = 'a.json'"), ["subject", "session"], ["mstime", "eegoffset"])[0]
    assert {k for k in counts} == {(s, t, r) for s in "AB" for t, r in (("WORD", 0), ("WORD", 1), ("REC_EVENT", 0), ("REC_EVENT", 1))}
    assert alone.count() == sum(n for (s, _, _), n in counts.items() if s == "A")
    assert all(counts[s, "REC_EVENT", 0] == counts[s, "REC_EVENT", 1] == 5 for s in "AB")  # a period of failure for each recall


def test_ambiguous_sessions_are_not_filled(spark, two):
    got = clean.fill_subject(two.drop("file"), ["session"])
    assert {r.subject for r in got.select("subject").distinct().collect()} == {"A", "B", None}
    assert {r.subject for r in clean.fill_subject(two.where("file = 'a.json'"), ["session"]).collect()} == {"A"}


def test_baselines_by_default_in_training_and_test(spark, two):
    keys, order = ["subject", "session"], ["mstime", "eegoffset"]
    training = clean.training_events(two, keys, order)
    assert training.where("type = 'REC_EVENT' and recalled = 0").count() == 10 and training.where("type = 'REC_EVENT' and not matched").count() == 0
    assert clean.training_events(two, keys, order, encoding_only=True).where("type <> 'WORD'").count() == 0
    assert clean.training_events(two, keys, order, baseline=None).where("recalled = 0 and type = 'REC_EVENT'").count() == 0
    ticl = two.withColumn("experiment", F.lit("TICL_FR"))
    assert clean.clean_events(ticl, keys, order)[0].where("type = 'REC_EVENT' and recalled = 0").count() == 0


def test_joint_test_data(spark):
    rows = recall_rows("a.json", "A", "FR5") + recall_rows("c.json", "A", "catFR5", 3) + recall_rows("d.json", "D", "catFR5") + recall_rows("e.json", "A", "FR1", 5)
    df = clean.fill_subject(spark.createDataFrame(rows, EVENTS), ["file"])
    everything, words, _ = clean.test_events(df.withColumn("phase", F.lit("STIM")), ["subject", "session"], ["mstime", "eegoffset"], joint="5")
    sessions = {(r.subject, r.experiment, r.session) for r in words.select("subject", "experiment", "session").distinct().collect()}
    assert sessions == {("A", "FR5", 0), ("A", "catFR5", 100), ("D", "catFR5", 0)}
    assert {(r.subject, r.session) for r in everything.select("subject", "session").distinct().collect()} == {("A", 0), ("A", 100), ("D", 0)}


def test_stimulation_of_one_subject_is_not_anothers(spark):
    words = spark.createDataFrame([("A", 0, 1, "w"), ("B", 0, 1, "w")], "subject string, session long, list long, item_name string")
    stim = spark.createDataFrame([("A", 0, 1, "w", "A1", "A2", 0.5, 500, 200, 1)], "subject string, session long, list long, item_name string, stimAnodeTag string, stimCathodeTag string, amplitude double, stim_duration int, pulse_freq int, n int")
    places = spark.createDataFrame([("A", "A1-A2", "MTL"), ("B", "A1-A2", "Hipp")], "subject string, label string, location string")
    got = {r.subject: (r.stimAnodeTag, r.amplitude, r.location) for r in behavior.stim_item_table(words, stim, places, ["n"]).collect()}
    assert got == {"A": ("A1", 0.5, "MTL"), "B": (None, None, None)}


def test_models_of_equal_session_numbers(spark):
    df = spark.createDataFrame([(1, "A", 0, [1.0, 2.0]), (2, "B", 0, [1.0, 2.0]), (3, "B", 1, [1.0, 2.0])], "event_id long, subject string, session long, features array<double>")
    models = spark.createDataFrame([("A", 0, [1.0, 0.0], 0.0), ("B", 0, [0.0, -1.0], 0.0)], "subject string, session long, coefficients array<double>, intercept double")
    retrained = spark.createDataFrame([("A", [9.0, 9.0], 0.0), ("B", [0.0, 1.0], 0.0)], "subject string, coefficients array<double>, intercept double")
    got = {r.event_id: round(r.probability, 4) for r in model.post_hoc(df, models, retrained).collect()}
    assert got == {1: 0.7311, 2: 0.1192, 3: 0.8808}
    used = spark.createDataFrame([("A", 0, 0), ("A", 0, 1), ("B", 0, 0), ("B", 0, 1)], "subject string, session long, pair_idx int")
    assert model.with_stored_features(df, models, used).count() == 2


def test_decisions_by_subject(spark):
    rows = [(s, loc, 1.0, base + d) for s, a, b in (("A", 1.0, 0.0), ("B", 0.0, 1.0)) for loc, base in (("x", a), ("y", b)) for d in (0.0, 0.1, 0.2)] + [("C", "x", 1.0, 0.5)]
    df = spark.createDataFrame(rows, "subject string, loc_name string, amplitude double, delta_classifier double")
    assert {r.subject: (r.best_location, r.tie) for r in stats.choose_location(df, keys=("subject",)).collect()} == {"A": ("x", 0), "B": ("y", 0)}
    outputs = spark.createDataFrame([(1, 0.3), (2, 0.6)], "event_id long, probability double")
    items = spark.createDataFrame([(1, "A", 0), (2, "B", 0)], "event_id long, subject string, session long")
    levels = spark.createDataFrame([("A", 0, 0.1), ("B", 0, 0.9)], "subject string, session long, threshold double")
    assert {r.subject: r.thresh for r in behavior.with_outputs(items, outputs, levels).collect()} == {"A": 0.1, "B": 0.9}


def test_reports_hold_all_subjects(spark, two):
    events = clean.fill_subject(two, ["file"]).withColumn("category_num", F.col("serialpos"))
    got = reports.behaviour(events)["session_summary"].collect()
    assert sorted((r.subject, r.num_words) for r in got) == [("A", 9), ("B", 9)] and masks.encoding() is not None


def test_stimulations_before_the_first_list(spark):
    import math

    rows = [(s, e + 100 * s, -999 if e < (40 if s == 0 else 29) else 3) for s in (0, 1) for e in range(60)]
    stim = spark.createDataFrame(rows, "session long, event_id long, list long")
    before = spark.createDataFrame([(e, p, [0.0, 1.0 * (e % 3)]) for _, e, _ in rows for p in (0, 1)], "event_id long, pair_idx int, samples array<double>")
    after = spark.createDataFrame([(e, p, [float(p) + e % 5, 2.0]) for _, e, _ in rows for p in (0, 1)], "event_id long, pair_idx int, samples array<double>")
    got = {(r.session, r.pair_idx): r for r in stats.stim_tstats(stim, before, after, ["session"]).collect()}
    assert set(got) == {(0, 0), (0, 1)} and got[0, 0].n == 40  # the other session has 29 of them
    d = [(1 + e % 5 + 2) / 2 - (e % 3) / 2 for e in range(40)]
    m = sum(d) / 40
    want = m / (math.sqrt(sum((x - m) ** 2 for x in d) / 39) / math.sqrt(40))
    assert abs(got[0, 1].t_stat - want) < 1e-9 and got[0, 1].p_value < 1e-6
    assert stats.stim_tstats(stim, before, after, ["session"], before_experiment=False).where("session = 1").first().n == 60


def test_intrusions_and_ratios_of_an_index(spark):
    rows = [("A", 0, 1, "catFR1", "REC_WORD", k, i, 1, c) for k, (i, c) in enumerate([(0, 1), (2, 1), (-1, 2), (-999, 2)])] + [("A", 0, 1, "catFR1", "WORD", 9, 3, 0, 1), ("B", 0, 1, "catFR1", "REC_WORD", 1, 0, 1, 1), ("A", 0, 2, "FR1", "REC_WORD", 1, 0, 1, 1)]
    df = spark.createDataFrame(rows, "subject string, session long, list long, experiment string, type string, mstime long, intrusion long, recalled long, category_num long")
    assert sorted(r.intrusion for r in behavior.intrusion_events(df).collect()) == [-1, 2]
    assert [tuple(r) for r in behavior.repetition_ratios(df, spark.createDataFrame([("A",)], "subject string")).collect()] == [("A", 0, 1, 2 / 3)]
    assert {r.subject: r.ratio for r in behavior.repetition_ratios(df).collect()} == {"A": 2 / 3, "B": None}
