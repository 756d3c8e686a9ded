"""Operators on small tables with answers worked out by hand or by a plain loop."""

import json
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from mnesis.functions import tails, text
from mnesis.operators import behavior, clean, features, masks, model, montage, retrieval, sequence, stats, tmi
from mnesis.plans import reports
from mnesis.schemas import EVENTS, FRParameters, PALParameters, required_columns
from mnesis.sources import readers, store


def one(spark, **columns):
    return spark.range(1).select(*[c.alias(k) for k, c in columns.items()]).first()


def test_identifiers_and_labels(spark):
    lit = F.lit
    r = one(
        spark, s=text.subject_of(lit("R1001P_2")), m=text.montage_of(lit("R1001P_2")), m0=text.montage_of(lit("R1001P")), e1=text.experiment_series(lit("catFR1")), e2=text.experiment_series(lit("PS2.1")), e3=text.experiment_series(lit("")),
        k1=text.is_stim_experiment(lit("FR1")), k2=text.is_stim_experiment(lit("FR5")), k3=text.is_stim_experiment(lit("PS5_FR1")), k4=text.is_stim_experiment(lit("TICL_FR1")), t1=text.join_tags(lit("LA1"), lit("LA2")), t2=text.join_tags(lit("A,C"), lit("B,D")),
        z=text.without_zeros(lit("0,5,0,7")), ss=text.session_string(F.array(lit(3), lit(1))), d=text.safe_divide(lit(1.0), lit(0.0)), g=text.region_name(lit("precuneus")), o=text.region_name(lit("x")), i=text.summary_id(lit("S"), lit("FR1"), F.array(lit(0), lit(1)), lit("t")),
        j=text.session_id(lit("S"), lit("FR1"), lit(3)), c=text.contact_label(lit("A"), lit("B")), p=text.padded_channel(lit(7)),
    )
    assert (r.s, r.m, r.m0, r.e1, r.e2, r.e3) == ("R1001P", 2, 0, "1", "2.1", None)
    assert (r.k1, r.k2, r.k3, r.k4) == (False, True, True, True)
    assert (r.t1, r.t2, r.z, r.ss, r.d, r.g, r.o, r.i, r.j, r.c, r.p) == ("LA1-LA2", "A-B:C-D", "5,7", "1_3", 0.0, "SPC", "Other", "S:FR1:0.1:t", "S:FR1:3", "A_B", "007")


@pytest.mark.parametrize("path,want", [("/a/R1_1_FR5_0_2_target_table.csv", ("R1", 1, "FR5", [0, 2], "target_table", "csv")), ("R1_catFR1_math.h5", ("R1", 0, "catFR1", [], "math", "h5"))])
def test_report_paths(spark, path, want):
    assert tuple(one(spark, p=text.report_path_parts(F.lit(path))).p) == want


def test_atlas_waterfall(spark):
    def pair(stein, kind, wb, ind, x):
        region = lambda v: F.struct(F.lit(v).alias("region"), F.lit(x).cast("double").alias("x"))
        return text.atlas_location(F.struct(F.lit(kind).alias("type_1"), F.struct(region(stein).alias("stein"), region(wb).alias("wb"), region(ind).alias("ind")).alias("atlases")))

    r = one(spark, a=pair("CA1", "D", "w", "i", 1.0), b=pair("None", "D", "w", "i", 1.0), c=pair("", "S", "w", "i", -1.0), d=pair(None, "S", "w", "i", 2.0), e=pair(None, "S", "w", "i", None), f=pair(None, "S", "w", None, 1.0))
    assert tuple(r) == ("CA1", "w", "Left i", "Right i", "--", "--")


def test_tails(spark):
    rows = spark.createDataFrame([(2.228138852, 10.0), (0.0, 5.0), (None, 3.0)], "t double, df double").select(tails.t_pvalue("t", "df").alias("p")).collect()
    assert math.isclose(rows[0].p, 0.05, abs_tol=1e-8) and math.isclose(rows[1].p, 1.0) and rows[2].p is None
    r = one(spark, c=tails.chi2_1_pvalue(F.lit(3.841458821)), n=tails.normal_lower(F.lit(-1.959963985)), f=tails.f_pvalue(F.lit(4.964602744), F.lit(1.0), F.lit(10.0)))
    assert all(math.isclose(v, w, abs_tol=1e-8) for v, w in ((r.c, 0.05), (r.n, 0.025), (r.f, 0.05)))


def log(spark, rows, extra=""):
    return spark.createDataFrame(rows, "session long, mstime long, type string" + extra)


def test_adjacent_matches_the_plain_loop(spark):
    r, rows, want = random.Random(3), [], {}
    for s in range(30):
        times = sorted(r.randrange(0, 20000) for _ in range(r.randrange(1, 12)))
        times = sorted(set(times))
        mark, i = [False] * len(times), 0
        for i in range(len(times) - 1):
            if not mark[i] and times[i + 1] - times[i] < 1500:
                mark[i] = mark[i + 1] = True
        mark[-1] = True
        rows += [(s, t, "X") for t in times]
        want |= {(s, t): m for t, m in zip(times, mark)}
    got = sequence.adjacent(log(spark, rows), ["session"], ["mstime"]).collect()
    assert {(x.session, x.mstime): x.adjacent for x in got} == want


def test_stimulated_items_and_their_correction(spark):
    kinds = "WORD STIM_ON WORD WORD_OFF STIM_ON WORD WORD_OFF DISTRACT_START STIM_ON WORD WORD_OFF".split()
    rows = log(spark, [(1, i, k, i + 1, "FR2") for i, k in enumerate(kinds)], ", serialpos long, experiment string").withColumn("stim_params", F.when(F.col("type") == "STIM_ON", F.col("mstime")))
    got = sequence.stim_items(rows, ["session"], ["mstime"], "stim_params").orderBy("mstime")
    assert [(r.mstime, r.is_stim_item, r.is_post_stim_item, r.stim_params) for r in got.collect()] == [(0, True, False, 1), (2, True, True, 4), (5, True, True, 8), (9, False, True, None)]
    items = spark.createDataFrame([(1, p, "FR2", p == 3, False) for p in range(1, 13)], "session long, serialpos long, experiment string, is_stim_item boolean, is_post_stim_item boolean")
    fixed = sequence.fr2_correction(items, ["session"], ["serialpos"]).orderBy("serialpos").collect()
    assert [r.serialpos for r in fixed if r.is_stim_item] == [3, 4] and [r.serialpos for r in fixed if r.is_post_stim_item] == [4, 5]


def test_list_phase(spark):
    kinds = "TRIAL WORD DISTRACT_START PROB REC_START VOCALIZATION REC_WORD PRACTICE_WORD".split()
    got = sequence.list_phase(log(spark, [(1, i, k) for i, k in enumerate(kinds)]), ["session"], ["mstime"]).orderBy("mstime").collect()
    assert [r.list_phase for r in got] == ["ENCODING", "ENCODING", "DISTRACT", "DISTRACT", "RETRIEVAL", "RETRIEVAL", "RETRIEVAL", "PRACTICE_ENCODING"]


def test_free_time(spark):
    rows = [(1, 1, "REC_START", 0), (1, 1, "REC_WORD", 5000), (1, 1, "REC_WORD", 6000), (1, 1, "REC_WORD_VV", 20000), (1, 2, "REC_START", 0), (1, 3, "REC_WORD", 9)]
    df = spark.createDataFrame(rows, "session long, list long, type string, rectime long")
    got = sequence.vocalization_free(df, ["session", "list"], 30000, 1500, 1500).orderBy("begin").collect()
    assert [(r.list, r.begin, r.end) for r in got] == [(1, 0, 3500), (1, 7500, 18500), (1, 21500, 30000)]
    epochs = sequence.free_periods(spark.createDataFrame([(1, 0), (1, 10000)], "s long, t long"), ["s"], "t", 500, 2000, 1000).collect()
    assert [r.start for r in epochs] == list(range(1000, 7500, 500))


def test_saturation_and_resting(spark):
    df = spark.createDataFrame([(1, [1.0] * 11), (2, [1.0] * 10 + [2.0]), (3, [])], "e long, x array<double>")
    assert [r.s for r in df.orderBy("e").select(sequence.saturated(F.col("x")).alias("s")).collect()] == [True, False, False]
    rest = sequence.resting_epochs(spark.createDataFrame([(1, 0, 100, "COUNTDOWN_START"), (1, 9, 9, "X")], "session long, mstime long, eegoffset long, type string"), 500.0)
    assert sorted(r.eegoffset for r in rest.collect()) == [9, 600, 2100, 3600]


def test_every_row_is_in_one_partition(spark):
    rows = [(e, k, 1, True) for e in ("FR1", "PAL1") for k in ("WORD", "REC_EVENT", "REC_WORD")]
    df = spark.createDataFrame(rows, "experiment string, type string, list long, matched boolean")
    parts = masks.partitions(df)
    assert all(sum(r[k] for k in parts) == 1 for r in df.select(*[c.alias(k) for k, c in parts.items()]).collect())


def test_incomplete_lists_and_masks(spark):
    rows = [("S", 1, 1, "WORD"), ("S", 1, 1, "REC_END"), ("S", 1, 2, "WORD"), ("S", 1, 2, "PROB"), ("S", 1, -999, "X")]
    df = spark.createDataFrame(rows, "subject string, session long, list long, type string")
    assert sorted((r.list, r.type) for r in masks.remove_incomplete_lists(df).collect()) == [(-999, "X"), (1, "REC_END"), (1, "WORD"), (2, "PROB")]
    assert masks.select_session(df, 1).count() == 5
    with pytest.raises(Exception, match="no session 9"):
        masks.select_session(df, 9)


def test_normalising_and_conforming(spark):
    df = spark.createDataFrame([("REC_WORD", 0, 5), ("REC_BASE", 1, 6), ("WORD", 1, 7)], "type string, recalled long, mstime long")
    got = clean.combine_retrieval(df).orderBy("mstime").collect()
    assert [(r.type, r.recalled) for r in got] == [("REC_EVENT", 1), ("REC_EVENT", 0), ("WORD", 1)]
    assert clean.conform(df, EVENTS, {"phase": ""}).columns == [f.name for f in EVENTS] and clean.empty_events(spark).schema == EVENTS
    assert "category_num" in required_columns(cat=True) and "recalled" not in required_columns(pal=True)
    with pytest.raises(ValueError):
        required_columns(cat=True, pal=True)
    both = clean.union_experiments([df.withColumn("session", F.lit(1)), df.where("mstime < 0").withColumn("session", F.lit(1)), df.withColumn("session", F.lit(2)).drop("recalled")])
    assert sorted({r.session for r in both.collect()}) == [1, 102]
    sessions = spark.createDataFrame([(0,), (1,), (100,), (102,), (203,)], "session long")
    assert [[r.session for r in clean.without_session_offset(sessions, e).orderBy("session").collect()] for e in ("FR1", "catFR1", "PAL1", "PS2")] == [[0, 1], [0, 2], [3], [0, 1]]
    with pytest.raises(Exception, match="more than one"):
        clean.assert_single(df, "type").collect()


def test_surrogate_times_come_from_the_session(spark):
    rows = [(1, i, i, i % 2, 100 + i if i % 2 else -999, "TEST_PROBE") for i in range(10)] + [(2, 1, 1, 0, -999, "TEST_PROBE")]
    df = spark.createDataFrame(rows, "session long, mstime long, eegoffset long, correct long, RT long, type string")
    got = clean.surrogate_response_times(df, ["session"]).collect()
    assert {r.RT for r in got if r.session == 1} <= {101, 103, 105, 107, 109} and [r.RT for r in got if r.session == 2] == [-999]


def test_math_totals_and_percent(spark):
    df = spark.createDataFrame([(1, 1, "PROB", 1), (1, 1, "PROB", 0), (2, 1, "PROB", 1), (2, -1, "PROB", 1), (2, 1, "START", 0)], "session long, list long, type string, iscorrect long")
    got = {r.session: r for r in behavior.math_summary(df, ["session"]).collect()}
    assert (got[1].percent_correct, got[2].num_problems, got[None].num_problems, got[None].num_correct) == (50.0, 1, 3, 2)


@pytest.mark.parametrize("small", [0, 5000])
def test_nearest_region_is_exact(spark, small):
    r = np.random.default_rng(0)
    e, v = r.uniform(-80, 80, (60, 3)).round(2), np.vstack((r.uniform(-80, 80, (30, 3)).round(2), [[500.0, 0, 0]]))
    near = montage.nearest_region(spark.createDataFrame([(i, *map(float, x)) for i, x in enumerate(e)], "i long, x double, y double, z double"), spark.createDataFrame([(i, *map(float, x)) for i, x in enumerate(v)], "region long, x double, y double, z double"), "i", cell=4.0, small=small)
    assert {x.i: x.region for x in near.collect()} == {i: int(np.argmin(((v - x) ** 2).sum(axis=1))) for i, x in enumerate(e)}


def test_pairs_and_exclusions(spark):
    p = spark.createDataFrame([(0, "A1-A2", 1, 2), (1, "A2-A3", 2, 3), (2, "B1-B10", 4, 5)], "pair_idx long, label string, channel_1 long, channel_2 long")
    stim = p.where("pair_idx = 1")
    assert montage.without_stim_pairs(p, stim).count() == 2 and montage.without_stim_pairs(p, stim, excluded=True).count() == 1
    leads = spark.createDataFrame([("B1",)], "lead string")
    assert [r.label for r in montage.excluded_by_leads(p, leads).collect()] == ["B1-B10"]
    assert montage.monopolar(p).count() == 5 and [r.label for r in montage.model_pairs(p, stim).collect()] == ["A1-A2", "B1-B10"]
    assert montage.rejected_by_models(p, [p.where("pair_idx < 2"), p.where("pair_idx > 0")]).count() == 2
    jack = spark.createDataFrame([(1, "A1"), (2, "A2")], "number int, label string")
    assert montage.stim_parameters(spark.createDataFrame([("A1", "A2")], "anode string, cathode string"), jack).first().cathode_number == 2
    with pytest.raises(Exception, match="unknown contact"):
        montage.stim_parameters(spark.createDataFrame([("A1", "ZZ")], "anode string, cathode string"), jack).collect()
    epochs = spark.createDataFrame([(7, 1, [3.0, 4.0]), (7, 2, [1.0, 1.0])], "event_id long, channel long, samples array<double>")
    assert montage.bipolar_epochs(epochs, p).first().samples == [2.0, 3.0]


def test_weights_have_mean_one_over_classes(spark):
    rows = [("FR1", "WORD", i % 2) for i in range(6)] + [("FR1", "REC_EVENT", 1), ("FR1", "REC_EVENT", 0), ("FR1", "OTHER", 0)]
    df = spark.createDataFrame(rows, "experiment string, type string, recalled long")
    got = model.fr_weights(df, [], 2.0).distinct().collect()
    w = {(r.type, r.recalled): r.weight for r in got}
    each = [w["WORD", 0], w["WORD", 1], w["REC_EVENT", 0], w["REC_EVENT", 1]]
    assert math.isclose(sum(each) / 4, 1.0) and w["OTHER", 0] == 1.0 and math.isclose(w["WORD", 1] / w["REC_EVENT", 1], 2 / 3)


def test_logistic_fit_is_at_its_minimum():
    r = np.random.default_rng(1)
    for n, k in ((60, 5), (30, 80)):
        x, y, w = r.normal(size=(n, k)), r.integers(0, 2, n), r.uniform(0.5, 2, n)
        v = model.fit_logistic(x, y, w, 0.3)
        x1, s = np.hstack((x, np.ones((n, 1)))), np.where(y > 0, 1, -1)
        share = np.where(y > 0, n / (2 * y.sum()), n / (2 * (n - y.sum())))
        slope = v - x1.T @ (0.3 * w * share * s / (1 + np.exp(s * (x1 @ v))))
        assert np.abs(slope).max() < 1e-6


def training(spark, signal):
    r = np.random.default_rng(0)
    rows = []
    for i in range(240):
        y = int(r.integers(0, 2))
        rows.append((i, "S", i % 3, i // 3 % 4, "WORD", y, 1.0, [float(v) for v in r.normal(size=4) + (signal * y, 0, 0, 0)]))
    return spark.createDataFrame(rows, "event_id long, subject string, session long, list long, type string, recalled long, weight double, features array<double>")


def test_cross_validation(spark):
    df = training(spark, 3.0)
    cv = model.cross_validate(df, ["subject"], "session", c=1.0, permutations=4).cache()
    assert cv.where("perm = 0").count() == 240
    got = model.summary(cv, ["subject"]).first()
    assert got.auc > 0.9 and got.p_value == 0.0 and got.low < got.high
    assert cv.where("perm = 1").agg(F.sum("outcome")).first()[0] == df.agg(F.sum("recalled")).first()[0]
    lists = model.cross_validate(df.where("session = 0"), ["subject"], "list", c=1.0)
    assert lists.count() == 80 and lists.select("fold").distinct().count() == 4
    assert [r.by for r in model.scheme_of_validation(df, ["subject"]).collect()] == ["session"]
    models = model.train(df, ["subject"], c=1.0)
    assert stats.auc(model.predict(df, models, ["subject"]), [], "probability", "recalled").first().auc > 0.9


def epochs(spark, waves, rate=256.0):
    return spark.createDataFrame([(i, p, rate, [float(v) for v in w]) for (i, p), w in waves.items()], "event_id long, pair_idx int, samplerate double, samples array<double>")


def test_powers_peak_at_the_wave_and_notch_removes_60(spark):
    t = np.arange(512) / 256
    got = features.powers(epochs(spark, {(0, 0): np.sin(2 * np.pi * 12 * t), (1, 0): np.sin(2 * np.pi * 60 * t)}), ["event_id", "pair_idx"], [6.0, 12.0, 24.0], buffer=0.5, log=False).collect()
    p = {(r.event_id, r.freq_idx): r.power for r in got}
    assert p[0, 1] > 20 * max(p[0, 0], p[0, 2]) and max(v for (e, _), v in p.items() if e == 1) < 1e-2 * p[0, 1]
    psd = {r.event_id: r.power for r in features.multitaper_psd(epochs(spark, {(0, 0): np.sin(2 * np.pi * 6.5 * t), (1, 0): np.sin(2 * np.pi * 30 * t)}), ["event_id", "pair_idx"]).collect()}
    assert psd[0] > psd[1] + 2


def test_coherence(spark):
    r, t, waves = np.random.default_rng(0), np.arange(256) / 256, {}
    for e in range(30):
        shared = np.sin(2 * np.pi * 8 * t + r.uniform(0, 6))
        waves[e, 0], waves[e, 1], waves[e, 2] = shared + 0.1 * r.normal(size=256), shared * 2 + 0.1 * r.normal(size=256), r.normal(size=256)
    got = {(x.i, x.j): x.coherence for x in features.coherence(epochs(spark, waves).withColumn("g", F.lit(1)), ["g"], 8.0, 8.0).collect()}
    assert got[0, 1] > 0.95 and got[0, 2] < 0.5


def test_epochs_from_chunks(spark):
    chunks = spark.createDataFrame([("f", 0, 1000.0, k, [float(v) for v in range(10 * k, 10 * k + 10)]) for k in range(5)], "eegfile string, pair_idx int, samplerate double, chunk_id long, samples array<double>")
    events = spark.createDataFrame([(1, "f", 8), (2, "f", 20), (3, "f", 47), (4, "f", 1), (5, "g", 8)], "event_id long, eegfile string, eegoffset long")
    got = {r.event_id: r.samples for r in features.cut_epochs(events, chunks, -3, 15).collect()}
    assert got == {1: [float(v) for v in range(5, 23)], 2: [float(v) for v in range(17, 35)]}


def test_rows_and_arrays(spark):
    df = spark.createDataFrame([(1, [1.0, 2.0, 3.0, 4.0])], "event_id long, features array<double>")
    rows = features.as_rows(df, "features", 2)
    assert [(r.pair_idx, r.freq_idx) for r in rows.orderBy("power").collect()] == [(0, 0), (0, 1), (1, 0), (1, 1)]
    assert features.as_arrays(rows, ["event_id"]).first().features == [1.0, 2.0, 3.0, 4.0]


def test_fdr_and_choice_of_location(spark):
    p = spark.createDataFrame([(0, 0.01), (1, 0.04), (2, 0.03), (3, 0.5)], "i long, p double")
    got = {r.i: r.adjusted for r in stats.benjamini_hochberg(p, "p").collect()}
    assert all(math.isclose(got[i], w) for i, w in ((0, 0.04), (1, 0.04 * 4 / 3), (2, 0.04 * 4 / 3), (3, 0.5)))
    rows = spark.createDataFrame([("A", 1.0, 1.0 + d) for d in (0, 0.1, 0.2)] + [("B", 1.0, 0.0 + d) for d in (0, 0.1, 0.2)], "loc_name string, amplitude double, delta_classifier double")
    r = stats.choose_location(rows).first()
    assert (r.best_location, r.tie) == ("A", 0) and r.t_stat > 5


def test_theta_modulation_finds_the_planted_effect(spark):
    r = np.random.default_rng(0)
    rows = [(1, i, float(2 * c + 0.1 * r.normal()), float(d), float(c)) for i, (d, c) in enumerate(zip(r.normal(size=40), r.normal(size=40)))]
    df = spark.createDataFrame(rows + [(2, i, 0.0, 1.0, 1.0) for i in range(5)], "k long, pair_idx long, t_stat double, distance double, connectivity double")
    got = tmi.regress(df, ["k"], permutations=100).collect()
    assert len(got) == 1 and abs(got[0].b_connectivity - 2) < 0.1 and got[0].z_tmi > 4 and got[0].r > 0.99


def test_matching_uses_no_time_twice(spark):
    r, rows = random.Random(1), []
    for s in range(3):
        for lst in range(8):
            begin = lst * 100_000
            rows.append(("S", s, lst, begin, -999, "REC_START", 0))
            t = 0
            for _ in range(r.randrange(1, 4)):
                t += r.randrange(4000, 9000)
                rows.append(("S", s, lst, begin + t, t, "REC_WORD", 0))
    df = spark.createDataFrame(rows, "subject string, session long, list long, mstime long, rectime long, type string, intrusion long")
    got = retrieval.matched_deliberation(df, ["subject", "session"], ["mstime"]).toPandas()
    base, recalls = got[got.type == "REC_BASE"], got[got.type == "REC_WORD"]
    assert len(base) == len(recalls) > 0
    exact = base[base.exact == 1].sort_values(["session", "list", "rectime"])
    gaps = exact.groupby(["session", "list"]).rectime.diff().dropna()
    assert (gaps >= 1500).all() and (exact.rectime == exact.matched_rectime).all()


def test_sources_read_nested_files(spark, tmp_path):
    index = {"protocols": {"r1": {"subjects": {"S1": {"experiments": {"FR1": {"sessions": {"0": {"all_events": "/e0.json", "montage": "0"}, "1": {"montage": "0"}}}}}}}}}
    (tmp_path / "r1.json").write_text(json.dumps(index))
    (tmp_path / "e0.json").write_text(json.dumps([{"subject": "", "experiment": "FR1", "session": 0, "type": "WORD", "eegfile": "f", "mstime": 5}, {"type": "WORD", "eegfile": ""}]))
    got = readers.session_index(spark, f"{tmp_path}/r1.json")
    assert got.count() == 2 and readers.completed_sessions(got, "S1", "FR1").count() == 2 and readers.subjects_of(got, "FR1").count() == 1
    rows = readers.events(spark, got, root=str(tmp_path)).collect()
    assert [(r.subject, r.session, r.mstime) for r in rows] == [("S1", 0, 5)]
    assert readers.events(spark, got.where("session = 1"), root=str(tmp_path)).count() == 0
    (tmp_path / "pairs.json").write_text(json.dumps({"version": "1", "S1": {"pairs": {"B-A": {"channel_1": 2, "channel_2": 3}, "A-C": {"channel_1": 1, "channel_2": 3}}}}))
    assert [(r.pair_idx, r.label, r.channel_1) for r in readers.pairs(spark, f"{tmp_path}/pairs.json").orderBy("pair_idx").collect()] == [(0, "B-A", 2), (1, "A-C", 1)]
    (tmp_path / "jack.txt").write_text("1 A1\n2 A2\n")
    (tmp_path / "bad.txt").write_text("Seizure onset zone\nX1\n\nBad electrodes:\na3\nA4\n\nOther stuff:\nB1\n")
    assert readers.jacksheet(spark, f"{tmp_path}/jack.txt").count() == 2
    assert sorted(r.label for r in readers.bad_channels(spark, f"{tmp_path}/bad.txt").collect()) == ["A3", "A4"]
    (tmp_path / "conf.csv").write_text("ODINConfigurationVersion:,#1.2#\nContacts:\nA1,1,1,10,#x#\nA2,2,2,10,#x#\nSenseChannels:\nA1A2,A1A2,1,2,x,#x#\n")
    pair = readers.electrode_config(spark, f"{tmp_path}/conf.csv").first()
    assert (pair.channel_1, pair.channel_2, pair.label) == (1, 2, "A1-A2")


def test_products_are_stored_and_reused(spark, tmp_path):
    root, calls = f"{tmp_path}/db", []
    wanted = spark.createDataFrame([("S", "FR1", 0), ("S", "FR1", 1)], "subject string, experiment string, session int")

    def build():
        calls.append(1)
        return {"words": wanted.withColumn("n", F.col("session") + 10)}

    for rerun in (False, False, True):
        got = reports.make_report(build, root, wanted, ["words"], rerun)
        assert sorted(r.n for r in got["words"].collect()) == [10, 11]
    assert len(calls) == 2
    more = wanted.union(spark.createDataFrame([("S", "FR1", 5)], "subject string, experiment string, session int"))
    assert [r.session for r in store.missing(spark, root, "words", more).collect()] == [5]


def stim_items(spark):
    rows = []
    for lst in range(1, 11):
        for pos in range(1, 13):
            stim = lst > 5
            hit = stim and pos % 4 == 1
            rows.append(("S", "FR5", 0, lst, pos, int((lst + pos) % 3 == 0), stim, hit, stim and pos % 4 == 2, 0.3 + 0.05 * (pos % 8), 0.5, *(("A", "C", None, "0.5", "500", "200") if hit else (None,) * 6)))
    return spark.createDataFrame(rows, "subject string, experiment string, session long, list long, serialpos int, recalled long, is_stim_list boolean, is_stim_item boolean, is_post_stim_item boolean, classifier_output double, thresh double, stimAnodeTag string, stimCathodeTag string, location string, amplitude string, stim_duration string, pulse_freq string")


def test_stimulation_report(spark):
    got = reports.stimulation(stim_items(spark))
    assert tuple(got["stim_lists"].first()) == ("S", 5, 5)
    one_set = got["stim_parameters"].collect()
    assert len(one_set) == 1 and one_set[0].location == "--" and one_set[0].n_trials == 60 and one_set[0].n_stimulations == 15
    assert {r.comparison for r in got["recall_tests"].collect()} == {"stim lists", "stim items", "post-stim items"}
    assert behavior.stim_params_by_list(stim_items(spark)).count() == 60 + 2 * 60
    design = stats.effect_design(stim_items(spark))
    assert design.agg(F.min("list"), F.max("serialpos")).first() == (0.0, 11)


def test_frequencies():
    f = FRParameters().frequencies
    assert np.allclose(f, np.logspace(np.log10(6), np.log10(180), 8)) and int(f[6]) == 110


def test_resampling_and_stim_epochs(spark):
    t = np.arange(512) / 512
    got = features.resampled(epochs(spark, {(0, 0): np.sin(2 * np.pi * 5 * t) + np.sin(2 * np.pi * 60 * t)}, 512.0), ["event_id", "pair_idx"]).first()
    assert got.samplerate == 256.0 and np.allclose(got.samples, np.sin(2 * np.pi * 5 * np.arange(256) / 256), atol=1e-9)
    chunks = spark.createDataFrame([("f", 0, 1000.0, k, [float(v) for v in range(1000 * k, 1000 * k + 1000)]) for k in range(4)], "eegfile string, pair_idx int, samplerate double, chunk_id long, samples array<double>")
    events = spark.createDataFrame([(1, "f", 1500)], "event_id long, eegfile string, eegoffset long")
    before, after = (features.stim_epochs(events, chunks, a).first().samples for a in (False, True))
    assert (before[0], before[-1], after[0], after[-1]) == (550.0, 1449.0, 2050.0, 2949.0)


def test_outputs_and_thresholds(spark):
    items = spark.createDataFrame([(1, 0), (2, 1)], "event_id long, session long")
    outputs = spark.createDataFrame([(1, 0.25)], "event_id long, probability double")
    got = behavior.with_outputs(items, outputs, spark.createDataFrame([(0, 0.4)], "session long, threshold double")).orderBy("event_id").collect()
    assert [(r.classifier_output, r.thresh) for r in got] == [(0.25, 0.4), (None, 0.5)]
    channels = spark.createDataFrame([(5.0, 0.0001), (1.0, 0.4)], "t_stat double, p double")
    assert tuple(behavior.tstats_by_condition(channels).first()) == ([5.0], [1.0])


def test_weights_of_folds_are_those_of_the_rows_left_in(spark):
    import numpy as np

    r = np.random.default_rng(4)
    kinds = ["WORD", "REC_EVENT", "REC_BASE", "STIM_ON"]
    rows = [(i, "A" if i % 2 else "B", i % 5, ["FR1", "PAL1"][int(r.integers(2))], kinds[int(r.integers(4))], int(r.integers(2))) for i in range(200)]
    df = spark.createDataFrame(rows, "event_id long, subject string, session long, experiment string, type string, recalled long")
    for kind in ("FR", "PAL"):
        made = {(x.subject, x.fold, x.family, x.phase, x.recalled): x.weight for x in model.fold_weights(df, ["subject"], "session", kind).collect()}
        for subject in "AB":
            for fold in range(5):
                left = df.where((F.col("subject") == subject) & (F.col("session") != fold))
                for x in model.sample_weights(left, [], kind).where("type <> 'STIM_ON'").collect():
                    key = (subject, fold, "pal" if kind == "PAL" and x.experiment == "PAL1" else "fr", "enc" if x.type == "WORD" else "ret", x.recalled)
                    assert abs(made[key] - x.weight) < 1e-9
                own = left.toPandas()
                classes = model.class_of(own["experiment"].to_numpy(), own["type"].to_numpy(), own["recalled"].to_numpy(), kind == "PAL")
                want = {x.event_id: x.weight for x in model.sample_weights(left, [], kind).collect()}
                assert np.allclose(model.weights_in_sample(classes, kind == "PAL", 4.375, 1.93), [want[i] for i in own["event_id"]])


def test_baseline_rows_are_whole_rows(spark):
    rows = []
    for trial in range(3):
        begun = 100_000 * trial
        rows.append(("S", 0, trial, begun, 0, "REC_START", 0, begun, 0, "X"))
        rows += [("S", 0, trial, begun + t, t, "REC_WORD", 0, begun + t, 1, f"w{t}") for t in ((5000, 12_000), (9000,), (20_000, 25_000))[trial]]
        rows.append(("S", 0, trial, begun + 45_000, 45_000, "REC_END", 0, begun + 45_000, 0, "X"))
    rows.append(("S", 0, 0, 50, -999, "WORD", 0, 50, 1, "word"))
    df = spark.createDataFrame(rows, "subject string, session long, list long, mstime long, rectime long, type string, intrusion long, eegoffset long, recalled long, item_name string")
    got = retrieval.insert_baseline(df, ["subject", "session"], ["mstime"], duration=500, pre=1000, post=500, period=45_000)
    table = got.toPandas()
    base, recalls = table[table["type"] == "REC_BASE"], table[table["type"] == "REC_WORD"]
    assert got.columns == [*df.columns, "matched"] and len(table) == len(rows) + len(base) and len(base) == recalls["matched"].sum() == 5
    assert not table[~table["type"].isin(["REC_BASE", "REC_WORD"])]["matched"].any() and base["matched"].all()
    voices = {t: [r[4] for r in rows if r[5] == "REC_WORD" and r[2] == t] for t in range(3)}
    for x in base.itertuples():  # a period [rectime - 500, rectime) without a voice near
        assert (x.recalled, x.item_name, x.mstime) == (0, "N/A", 100_000 * x.list + x.rectime) and x.eegoffset == x.mstime
        assert all(not (v - 1000 < x.rectime and x.rectime - 500 < v + 500) for v in voices[x.list])
    spans = sorted((x.list, x.rectime) for x in base.itertuples())
    assert all(a[0] != b[0] or b[1] - a[1] >= 500 for a, b in zip(spans, spans[1:]))


def test_start_of_a_trial_by_interval_lengths():
    free = retrieval.FreeTime([(1, 0, 30), (1, 50, 80), (2, 10, 25), (3, 0, 5)], [1, 2, 3])
    for low, high, length in ((0, 100, 10), (5, 60, 7), (0, 22, 12)):
        listed = [t for t in (1, 2, 3) for b, e in free.spans[t] for _ in range(max(b, low), min(e, high) - length + 1)]
        assert [retrieval.trial_of_start(free, [1, 2, 3], k, low, high, length) for k in range(len(listed))] == listed


def test_electrodes_of_two_subjects_are_tested_apart(spark):
    rows = [(s, p, e, e % 2, f, float((e * 7 + p * 3 + f + (s == "B") * e) % 5)) for s in "AB" for p in range(3) for e in range(12) for f in range(2)]
    powers = spark.createDataFrame(rows, "subject string, pair_idx int, event_id long, recalled int, freq_idx int, power double")
    pairs = spark.createDataFrame([(s, p) for s in "AB" for p in range(3)], "subject string, pair_idx int")
    both = {(r.subject, r.pair_idx): r for r in stats.delta_hfa_table(pairs, powers, [50.0, 110.0], keys=("subject",)).collect()}
    assert len(both) == 6
    for s in "AB":
        for r in stats.delta_hfa_table(pairs.where(F.col("subject") == s), powers.where(F.col("subject") == s), [50.0, 110.0]).collect():
            assert both[s, r.pair_idx].hfa_t_stat == r.hfa_t_stat and abs(both[s, r.pair_idx].hfa_p_value - r.hfa_p_value) < 1e-12


def test_features_of_a_stored_model(spark):
    df = spark.createDataFrame([(1, 0, [1.0, 2.0, 3.0, 4.0, 5.0, 6.0])], "event_id long, session long, features array<double>")
    models = spark.createDataFrame([(0, [1.0, 0.0, 0.0, 1.0], 0.5)], "session long, coefficients array<double>, intercept double")
    used = spark.createDataFrame([(0, 2), (0, 0)], "session long, pair_idx int")
    cut = model.with_stored_features(df, models, used)
    assert cut.first().features == [1.0, 2.0, 5.0, 6.0]
    assert abs(model.post_hoc(cut, models).first().probability - 1 / (1 + 2.718281828459045 ** -7.5)) < 1e-9


def test_each_partition_has_its_own_window(spark):
    rate, n = 500.0, 20_000
    wave = [math.sin(2 * math.pi * 30 * k / rate) * (1.0 if k < n // 2 else 3.0) for k in range(n)]
    chunks = spark.createDataFrame([("f", 0, rate, c, wave[1000 * c : 1000 * (c + 1)]) for c in range(n // 1000)], "eegfile string, pair_idx int, samplerate double, chunk_id long, samples array<double>")
    rows = [(0, "WORD", 3000), (1, "REC_EVENT", 15_000), (2, "STIM_OFF", 3000)]
    events = spark.createDataFrame([(i, 0, t, "FR1", 1, True, "f", at) for i, t, at in rows], "event_id long, session long, type string, experiment string, list long, matched boolean, eegfile string, eegoffset long")
    p = FRParameters(normalize_powers=False, lowest=30.0, highest=60.0, n_frequencies=2)
    got = {(r.partition, r.event_id): r.power for r in features.partition_powers(events, chunks, p, ["session"]).where("freq_idx = 0").collect()}
    assert set(got) == {("fr_encoding", 0), ("fr_retrieval", 1), ("post_stim", 2)}
    assert abs(got["fr_retrieval", 1] - got["fr_encoding", 0] - math.log10(9)) < 0.02 and abs(got["post_stim", 2] - got["fr_encoding", 0]) < 0.02
    assert set(PALParameters().windows) == set(masks.partitions(events))
    assert FRParameters().baseline == {"duration": 500, "pre": 2000, "post": 1000}


def test_reports_by_experiment():
    assert reports.builder("catFR1") is reports.record_only and reports.builder("PS5_catFR") is reports.ps5 and reports.builder("RepFR1") is reports.repeated_words
    with pytest.raises(ValueError):
        reports.builder("none")
    with pytest.raises(ValueError):
        reports.build("FR2", {})
