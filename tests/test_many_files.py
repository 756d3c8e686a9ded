"""Event files by the hundred: written by tasks, and read by tasks where the driver would hold too long a list."""

import json

import pytest
from pyspark.sql import functions as F

from mnesis.sources import readers, store


def test_more_files_than_the_driver_lists(spark, tmp_path):
    for k in range(12):
        (tmp_path / f"e{k}.json").write_text(json.dumps([{"subject": "other", "type": "WORD", "eegfile": "f", "mstime": k}, {"type": "WORD", "eegfile": ""}]) if k else "[]")
    index = spark.createDataFrame([(f"S{k % 3}", "FR1", k, f"/e{k % 12}.json" if k != 5 else None) for k in range(14)], "subject string, experiment string, session long, all_events string")
    for options in ({}, {"with_eeg": False}, {"with_file": True}):
        want = readers.events(spark, index, root=str(tmp_path), **options)
        got = readers.events(spark, index, root=f"file://{tmp_path}", listed=3, **options)
        assert got.columns == want.columns and sorted(map(str, got.collect())) == sorted(map(str, want.collect())) and got.count() >= 11
    plan = readers.events(spark, index, root=str(tmp_path), listed=3)._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and "FileScan json" not in plan
    (tmp_path / "e7.json").unlink()
    with pytest.raises(Exception, match="e7.json"):
        readers.events(spark, index, root=str(tmp_path), listed=3).collect()


def test_events_and_unread_files_in_one_pass(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"type": "WORD", "eegfile": "f", "mstime": 1}\n\n{"type": "WORD", "eegfile": ""}\n')
    (tmp_path / "empty.json").write_text("")
    index = spark.createDataFrame([("S", "FR1", k, n) for k, n in enumerate(["a", "none", "empty", None])], "subject string, experiment string, session long, name string").selectExpr("subject", "experiment", "session", "concat('/', name, '.json') AS all_events")
    got = readers.event_rows(index, root=f"file://{tmp_path}", multiline=False)
    assert [(r.session, r.mstime, r.error is None) for r in got.orderBy("session").collect()] == [(0, 1, True), (1, None, False)]
    assert got._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1


def test_a_file_for_each_key(spark, tmp_path):
    rows = spark.range(5000).select(F.when(F.col("id") % 41 > 0, F.concat(F.lit("k/"), (F.col("id") % 41).cast("string"))).alias("key"), F.col("id").cast("string").alias("line"), "id").repartition(5)
    files = store.save_lines(rows, "key", "line", f"file://{tmp_path}/files", ["id"], per_task=10)
    got = {r.key: r.path for r in files.collect()}
    assert files.count() == len(got) == 41 and files.columns == ["key", "path"] and len({p.rsplit("/", 1)[0] for p in got.values()}) > 2
    for key, path in got.items():
        own = [k for k in range(5000) if k % 41 == (int(key[2:]) if key else 0)]
        assert open(path.removeprefix("file://")).read() == "".join(f"{k}\n" for k in own)
    assert store.save_lines(rows.limit(0), "key", "line", f"file://{tmp_path}/none", ["id"]).count() == 0
