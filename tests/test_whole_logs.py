"""Queries over logs of several months."""

import json
from datetime import datetime, timedelta

import pytest

from mnesis.operators import retrieval
from mnesis.plans import catalog_events, catalog_signal
from test_bounded_steps import plain_free_epochs


def write_events(spark, path, months):
    """Three users' events of some days a month, as the driver's table has them."""
    rows = []
    for m in months:
        for user in range(3):
            for day in (1, 2, 5, 9):
                for k in range(6):
                    at = datetime(2024, m, day) + timedelta(seconds=1 + user * 50 + k * (2500 + 400 * m + 130 * day))
                    rows.append((len(rows), at, user, "view", 1.0, json.dumps({"k": k})))
    spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string").coalesce(1).write.parquet(f"{path}/events.parquet")


@pytest.mark.parametrize("months", [(1,), (1, 2, 4)])
def test_free_epochs_of_a_user_s_whole_log(spark, tmp_path, months):
    """Recalls of later months find epochs, and epochs of any month of the log will do."""
    write_events(spark, tmp_path, months)
    log = catalog_signal.recall_log(spark, str(tmp_path)).select("subject", "session", "list", "rectime", "type", "intrusion", "seq")
    want = {x[1:] for x in plain_free_epochs([tuple(q) for q in log.collect()], 500, 200, 200, 3000)}
    got = [tuple(q)[1:] for q in catalog_events.free_epoch_baseline(spark, str(tmp_path)).collect()]
    assert len(got) == len(set(got)) and set(got) == want and want
    ends = max(q.rectime for q in log.where("list = 1").collect())
    assert len(months) == 1 or max(ms for _, _, ms, _, _ in got) > ends / 2 > 43_200


def test_long_lists_are_searched_from_the_recall_s_time():
    """Of a list's gaps only those within reach are looked at."""

    class Counted(list):
        looks = 0

        def __getitem__(self, k):
            Counted.looks += 1
            return list.__getitem__(self, k)

        def __iter__(self):
            for x in list.__iter__(self):
                Counted.looks += 1
                yield x

    gaps = {lst: Counted((t, t + 900, 0) for t in range(0, 5_000_000, 1000)) for lst in (1, 2)}
    plain = lambda at, used: next(((1, 2, x, x) for t, e, _ in list.__iter__(gaps[2]) for x in range(t, e, 500) if abs(x - at) <= 1500 and (2, x) not in used), None)
    for at in (0, 700, 4_000_300, 4_999_999, 5_003_000):
        for used in (set(), {(2, x) for x in range(3_998_000, 4_001_000, 500)}):
            assert retrieval.nearest_epoch(gaps, [1, 2], 1, at, 500, 1500, used) == plain(at, used)
    assert 0 < Counted.looks < 300
