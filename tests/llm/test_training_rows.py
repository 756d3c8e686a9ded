"""Labelled rows meet their texts by one plan at every size."""

from mnesis.llm.toxicity import training_rows


def test_small_labels_take_the_plan_of_large_ones(spark, tmp_path):
    docs = spark.createDataFrame([(k, f"text {k}") for k in range(20)] + [(3, "other"), (None, "x")], "doc_id long, text string")
    labels = spark.createDataFrame([(k, k % 2) for k in range(0, 20, 3)] + [(3, 1), (99, 1)], "doc_id long, toxic int")
    docs.write.parquet(f"{tmp_path}/docs")
    labels.write.parquet(f"{tmp_path}/labels")
    docs, labels = spark.read.parquet(f"{tmp_path}/docs"), spark.read.parquet(f"{tmp_path}/labels")  # of known, small sizes
    rows = training_rows(docs, labels, "toxic", None)
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan
    assert sorted((q.doc_id, q.text, q.label) for q in rows.collect()) == sorted([(k, f"text {k}", float(k % 2)) for k in range(0, 20, 3)] + [(3, "other", 1.0)])
