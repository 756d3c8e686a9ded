"""How the report jobs deal their rows: one shuffle by recording and one sort for the windows; stored products are built_all's."""

import pytest

from mnesis.plans import report_jobs as jobs

LOG = "experiment string, subject string, session long, list long, mstime long, seq long, type string, recalled long, intrusion long, serialpos long, category_num long, repeats long, phase string"
ITEMS = "experiment string, subject string, session long, list long, serialpos int, recalled long, is_stim_list boolean, is_stim_item boolean, is_post_stim_item boolean, classifier_output double, thresh double, stimAnodeTag string, stimCathodeTag string, amplitude double"
ORDER = ["mstime", "seq"]


@pytest.fixture(scope="module")
def tables(spark):
    kinds = ["WORD", "REC_WORD", "PROB", "REC_EVENT", "STIM_ON"]
    log = [(e, s, n, k % 3, 1000 * k if k % 9 else None, k, kinds[k % 5], k // 3 % 2, k % 3 - 1, k % 6 + 1, k % 2 if k % 4 else None, k % 3 + 1, "STIM") for e in ("RepFR1", "TICL_FR", "none") for s in ("A", None) for n in (0, 1) for k in range(70)]
    items = [(e, s, n, k // 8, k % 8 + 1, k * 3 % 2, k // 16 % 2 == 0, k % 4 == 1, k % 4 == 2, k * 7 % 10 / 10, 0.5, "A1" if k % 4 == 1 else None, "A2", 0.5 * (k % 3)) for e in ("FR5", "PS4_FR", "LocationSearch") for s in "AB" for n in (0, 1) for k in range(64)]
    return spark.createDataFrame(log, LOG), spark.createDataFrame(items, ITEMS)


def test_one_shuffle_by_recording_and_one_sort(tables):
    for facts in (jobs.log_facts(tables[0], ORDER), jobs.by_session(*tables, ORDER)):
        plan = facts._jdf.queryExecution().executedPlan().toString()
        sides = 1 if "k1" in plan and "Union" not in plan else 2
        assert plan.count("Exchange hashpartitioning") == sides and plan.count("Sort [") == sides


def test_stored_products_are_all_products(tables, tmp_path):
    want = jobs.build_all(*tables, ORDER)
    got = jobs.save_all(*tables, ORDER, f"{tmp_path}/reports")
    text = lambda df: sorted(str([round(v, 9) if isinstance(v, float) else v for v in r]) for r in df.select(*want.columns).collect())
    assert text(got) == text(want) and {r.level for r in got.select("level").distinct().collect()} == set(jobs.LEVELS)
    assert jobs.save_all(tables[0].limit(0), None, ORDER, f"{tmp_path}/none").count() == 0


def test_pauses_are_to_the_recall_before(tables):
    """Every recall of a list in turn, also where its time or category is null, against a plain loop."""
    got = {(r.experiment, r.subject, r.session): (r.m1, r.m2, r.m3, r.m4) for r in jobs.by_session(tables[0], None, ORDER).where("product = 'category_times'").collect()}
    want, last = {}, {}
    for r in sorted(tables[0].where("experiment <> 'none'").collect(), key=lambda r: (r.mstime if r.mstime is not None else -1, r.seq)):
        if r.type not in ("REC_WORD", "REC_EVENT") or r.recalled != 1 or r.intrusion != 0:
            continue
        key = (r.experiment, r.subject, r.session)
        before = last.get((*key, r.list))
        last[(*key, r.list)] = r
        if before is None or r.mstime is None or before.mstime is None:
            continue
        same = None not in (r.category_num, before.category_num) and r.category_num == before.category_num
        other = None not in (r.category_num, before.category_num) and not same
        a, b, c, d = want.get(key, (0, 0, 0, 0))
        want[key] = (a + same, b + same * (r.mstime - before.mstime), c + other, d + other * (r.mstime - before.mstime))
    assert want and got == want
