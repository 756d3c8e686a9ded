"""Registered queries and operators do the whole of their job: no rows, permutations or members are left out."""

import os

import pytest

from mnesis.operators import model, stats, tmi
from mnesis.plans import catalog, catalog_signal
from mnesis.schemas import FRParameters

DATA = "/root/testdata/sf0.001"
tables = pytest.mark.skipif(not os.path.isdir(DATA), reason="no driver tables")


@tables
def test_lists_of_all_sessions_are_left_out(spark):
    cv = model.cross_validate(catalog_signal.training(spark, DATA), ["subject"], "list").cache()
    assert cv.count() == catalog_signal.training(spark, DATA).count()
    want = stats.auc(cv, ["subject"], "probability", "outcome").first().auc
    assert abs(catalog.QUERIES["lolo_cv"](spark, DATA).first().auc - want) < 1e-9


@tables
def test_all_permutations_are_drawn(spark, monkeypatch):
    rows = catalog_signal.training(spark, DATA)
    assert catalog.QUERIES["perm_cv"](spark, DATA).select("perm").distinct().count() == FRParameters().n_permutations + 1
    drawn = []
    real = model.cross_validate
    monkeypatch.setattr(model, "cross_validate", lambda *a, permutations=0, permute_training=False, **k: drawn.append((permutations, permute_training)) or real(*a, permutations=min(permutations, 2), permute_training=permute_training, **k))
    assert catalog.QUERIES["perm_pvalue"](spark, DATA).count() == rows.select("subject").distinct().count()
    assert sorted(drawn) == [(0, False), (200, True)]


@tables
def test_theta_modulation_shuffles_a_thousand_times(spark, monkeypatch):
    real = tmi.regress
    monkeypatch.setattr(tmi, "regress", lambda rows, keys, permutations=1000, **k: drawn.append(permutations) or real(rows, keys, permutations, **k))
    drawn = []
    catalog.QUERIES["theta_modulation"](spark, DATA)
    assert drawn == [1000]


def test_permutations_do_not_depend_on_how_they_are_dealt(spark, monkeypatch):
    rows = spark.createDataFrame([(i, "S", i % 3, i // 3 % 2, "WORD", i * 7 % 11 % 2, 1.0, [float(i % 5), float(i % 7)]) for i in range(60)], "event_id long, subject string, session long, list long, type string, recalled long, weight double, features array<double>")
    for training in (False, True):
        cv = lambda: sorted(map(tuple, model.cross_validate(rows, ["subject"], "session", permutations=7, permute_training=training).collect()))  # noqa: B023, E731
        whole = cv()
        monkeypatch.setattr(model, "PERMUTATIONS", 2)
        assert cv() == whole and len(whole) == 8 * 60
        monkeypatch.undo()
