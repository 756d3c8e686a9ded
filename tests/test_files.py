"""Event files that tasks read by an index, missing ones as rows."""

import json

from mnesis.sources import readers


def test_tasks_read_what_spark_reads(spark, tmp_path):
    rows, n = [], 60
    for k in range(n):
        name = f"e{k}.json" if k % 7 else None if k % 2 else f"absent{k}.json"
        if k % 7:
            (tmp_path / name).write_text(json.dumps([{"subject": "other", "type": "WORD", "eegfile": "f", "mstime": k, "item_name": "né"}, {"type": "WORD", "eegfile": ""}]))
        rows.append((f"S{k % 3}", "FR1", k, name and f"/{name}"))
    index = spark.createDataFrame(rows, "subject string, experiment string, session long, all_events string")
    got, unread = readers.events_by_tasks(index, root=f"file://{tmp_path}")
    want = readers.events(spark, index.where("session % 7 <> 0"), root=str(tmp_path))
    assert got.columns == want.columns and sorted(map(str, got.collect())) == sorted(map(str, want.collect())) and got.count() == sum(k % 7 > 0 for k in range(n))
    assert {r.session for r in unread.collect()} == {k for k in range(n) if k % 7 == 0 and k % 2 == 0} and all("absent" in r.file and r.error for r in unread.collect())
    assert readers.events_by_tasks(index, root=f"file://{tmp_path}", with_eeg=False)[0].count() == 2 * got.count()


def test_many_paths_make_no_list(spark, tmp_path):
    (tmp_path / "one.json").write_text("[]")
    index = spark.range(100_000).selectExpr("'S' AS subject", "'FR1' AS experiment", "id AS session", f"concat('file://{tmp_path}/', IF(id % 1000 = 0, 'one', concat('none', id)), '.json') AS all_events")
    texts = readers.file_texts(index, "all_events", per_task=25_000)
    assert texts.rdd.getNumPartitions() == 4
    counts = texts.selectExpr("count(*) AS n", "count(text) AS read", "count(error) AS unread").first()
    assert tuple(counts) == (100_000, 100, 99_900)
