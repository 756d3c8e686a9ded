"""Many logistic regressions from cells against plain Newton steps over rows."""

import numpy as np
from pyspark.sql import functions as F

from mnesis.operators import stats


def newton(x, y):
    b = np.zeros(x.shape[1])
    for _ in range(60):
        p = 1 / (1 + np.exp(-x @ b))
        b += np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x, x.T @ (y - p))
    return b, np.sqrt(np.diag(np.linalg.inv((x * (p * (1 - p))[:, None]).T @ x)))


def test_fits_of_all_levels(spark):
    r = np.random.default_rng(4)
    rows = []
    for subject, effect in (("A", 1.0), ("B", -1.0), ("C", 0.0)):
        for _ in range(600):
            flag, place = int(r.integers(2)), int(r.integers(4))
            rows.append(("FR5" if subject != "C" else "FR3", subject, bool(flag), float(place), int(r.random() < 1 / (1 + np.exp(-(effect * flag + 0.3 * place - 0.5)))), bool(r.integers(2))))
    df = spark.createDataFrame(rows, "experiment string, subject string, is_stim_list boolean, place double, recalled long, in_stim_comparison boolean").withColumn("is_stim_item", F.col("is_stim_list"))
    levels, comparisons = {"subject": ["experiment", "subject"], "experiment": ["experiment"], "all": []}, {"is_stim_list": None, "is_stim_item": "in_stim_comparison"}
    got = {}
    for q in stats.stim_effects(df, ["place"], levels, comparisons).collect():
        got[q.level, q.experiment, q.subject, q.comparison, q.term] = (q.coefficient, q.error, q.n, q.converged)
    assert len(got) == (3 + 2 + 1) * 2 * 3 and all(v[3] for v in got.values())
    for key, keep in ((("subject", "FR5", "A"), lambda q: q[1] == "A"), (("experiment", "FR5", None), lambda q: q[0] == "FR5"), (("all", None, None), lambda q: True)):
        for name, part in (("is_stim_list", lambda q: True), ("is_stim_item", lambda q: q[5])):
            own = [q for q in rows if keep(q) and part(q)]
            b, e = newton(np.array([(q[2], q[3], 1.0) for q in own], float), np.array([q[4] for q in own], float))
            for k, term in enumerate(("flag", "place", "intercept")):
                assert np.allclose(got[(*key, name, term)][:2], (b[k], e[k]), atol=1e-6) and got[(*key, name, term)][2] == len(own)
    assert got["subject", "FR5", "A", "is_stim_list", "flag"][0] > 0.5 > -0.5 > got["subject", "FR5", "B", "is_stim_list", "flag"][0]


def test_permuted_aucs_equal_the_sort(spark):
    import zlib

    r = np.random.default_rng(7)
    rows = [(s, int(g), k, float(r.integers(6)), int(r.integers(2))) for s in "AB" for k, g in enumerate(r.integers(0, 5, 90))]
    df = spark.createDataFrame(rows, "subject string, list long, event_id long, score double, outcome long")
    got = {(q.subject, q.perm): q.auc for q in stats.permuted_aucs(df.repartition(5), ["subject"], "score", "outcome", ["list"], 7, seed=3).collect()}
    drawn = []
    for s in "AB":
        for g in range(5):
            own = sorted(q for q in rows if q[0] == s and q[1] == g)
            own.sort(key=lambda q: q[2])
            hit = np.array([q[4] for q in own])
            rng = np.random.default_rng([3, zlib.crc32(f"{s}|{g}".encode())])
            for perm, out in enumerate([hit, *(rng.permutation(hit) for _ in range(7))]):
                drawn += [(s, perm, q[3], int(o)) for q, o in zip(own, out, strict=True)]
    want = stats.auc(spark.createDataFrame(drawn, "subject string, perm long, score double, outcome long"), ["subject", "perm"], "score", "outcome").collect()
    assert len(got) == len(want) == 16 and all(abs(got[q.subject, q.perm] - q.auc) < 1e-12 for q in want)
    assert len({got["A", p] for p in range(8)}) > 4


def test_separated_and_constant_terms(spark):
    rows = [("A", k % 2 == 0, 0.0, int(k % 2 == 0)) for k in range(20)] + [("B", k % 2 == 0, 0.0, int(k % 3 == 0)) for k in range(30)]
    df = spark.createDataFrame(rows, "subject string, is_stim_list boolean, never double, recalled long")
    got = {(q.subject, q.term): q for q in stats.stim_effects(df, ["never"], {"subject": ["subject"]}, {"is_stim_list": None}, most=25).collect()}
    assert not got["A", "flag"].converged or got["A", "flag"].coefficient > 10
    assert got["B", "never"].coefficient == 0 and got["B", "flag"].converged
    assert stats.stim_effects(df.limit(0), ["never"], {"subject": ["subject"]}, {"is_stim_list": None}).count() == 0
