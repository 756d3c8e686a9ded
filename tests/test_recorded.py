"""From recordings to theta modulation, and common averages, against planted effects and plain loops."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from mnesis.operators import features, tmi

RATE, CHUNK = 128, 200


@pytest.fixture(scope="module")
def recordings(spark):
    """Two subjects of 14 channels: channels follow channel 0 at rest as much as ``link`` says, and theta rises after
    stimulation with it for A, and falls for B."""
    chunks, stim, rest, pairs = [], [], [], []
    for subject, sign in (("A", 1.0), ("B", -1.0)):
        r = np.random.default_rng(ord(subject))
        link = np.concatenate(([1.0], r.permutation(np.linspace(0.1, 0.9, 13))))
        n = 150 * RATE
        shared, t = r.normal(size=n), np.arange(n) / RATE
        x = link[:, None] * shared + np.sqrt(1 - link**2)[:, None] * r.normal(size=(14, n))
        for k in range(24):  # stimulation every three seconds from second 70
            at = int((70 + 3 * k) * RATE)
            rise = slice(at + int(0.55 * RATE), at + int(1.45 * RATE))
            x[:, rise] += (1.0 + sign * (link - 0.5) * 1.8)[:, None] * np.sin(2 * np.pi * 6.5 * t[rise])
            stim.append((subject, 0, 1000 * (ord(subject) % 2) + k, "STIM_ON", 3000 * k, f"f{subject}", at, "P0", "Q0"))
        rest += [(subject, "FR1", 1, 100 * (ord(subject) % 2) + k, "COUNTDOWN_START", 9000 * k, f"f{subject}", int(9 * k * RATE)) for k in range(7)]
        rest.append((subject, "RepFR1", 2, 7, "COUNTDOWN_START", 0, "none", 0))
        chunks += [(f"f{subject}", c, float(RATE), k, x[c, k * CHUNK : (k + 1) * CHUNK].tolist()) for c in range(14) for k in range(n // CHUNK)]
        pairs += [(subject, c, f"P{c}-Q{c}", *r.normal(size=3).tolist()) for c in range(14)]
    return (
        spark.createDataFrame(stim, "subject string, session long, event_id long, type string, mstime long, eegfile string, eegoffset long, anode_label string, cathode_label string"),
        spark.createDataFrame(rest, "subject string, experiment string, session long, event_id long, type string, mstime long, eegfile string, eegoffset long"),
        spark.createDataFrame(chunks, "eegfile string, pair_idx int, samplerate double, chunk_id long, samples array<double>"),
        spark.createDataFrame(pairs, "subject string, pair_idx int, label string, x double, y double, z double"),
    )


def test_planted_modulation_is_found_from_recordings(recordings):
    got = {(r.subject, r.session, r.stim_idx): r for r in tmi.session_tmi(*recordings, samplerate=float(RATE), order=["mstime"], permutations=300, threshold=1e-12).collect()}
    assert set(got) == {("A", 0, 0), ("B", 0, 0)} and all(r.n == 13 for r in got.values())
    assert got["A", 0, 0].z_tmi > 1.8 and got["B", 0, 0].z_tmi < -1.8


def test_coefficients_solve_the_normal_equations(recordings):
    rows = tmi.session_design(*recordings, samplerate=float(RATE), order=["mstime"], threshold=1e-12).where("subject = 'A'").toPandas()
    r = tmi.regress(tmi.session_design(*recordings, samplerate=float(RATE), order=["mstime"], threshold=1e-12), ["subject", "session", "stim_idx"], 10).where("subject = 'A'").first()
    x = np.column_stack((rows["distance"], rows["connectivity"], np.ones(len(rows))))
    want = np.linalg.solve(x.T @ x, x.T @ rows["t_stat"])
    assert np.allclose([r.b_distance, r.b_connectivity], want[:2]) and set(rows["pair_idx"]) == set(range(1, 14))


def test_common_average(spark):
    r = np.random.default_rng(1)
    x = r.normal(size=(5, 6, 8))
    rows = [(e, c, x[e, c].tolist() if (e, c) != (1, 2) else None) for e in range(4) for c in range(6)] + [(4, 0, x[4, 0, :3].tolist()), (4, 1, x[4, 1].tolist()), (4, 2, x[4, 2].tolist()), (5, 5, [1.0, 2.0])]
    df = spark.createDataFrame(rows, "event_id long, pair_idx long, samples array<double>").repartition(7)
    bad = spark.createDataFrame([(5,)], "pair_idx long")
    got = {(q.event_id, q.pair_idx): q.samples for q in features.common_average(df, excluded=bad).collect()}
    assert len(got) == len(rows) and got[1, 2] is None and got[5, 5] == [1.0, 2.0]
    assert np.allclose(got[0, 5], x[0, 5] - x[0, :5].mean(0)) and np.allclose(got[1, 0], x[1, 0] - x[1, [0, 1, 3, 4]].mean(0))
    assert np.allclose(got[4, 0], 0) and np.allclose(got[4, 1], x[4, 1] - x[4, 1:3].mean(0))
    assert features.common_average(df.limit(0)).count() == 0
    two = df.withColumn("subject", F.lit("s"))
    assert features.common_average(two, ["subject", "event_id"]).columns == two.columns
