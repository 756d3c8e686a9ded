"""Items of stimulation reports: dealt once, and recall tests in one pass over them."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from mnesis.operators import behavior
from mnesis.sources import store

SHAPE = "subject string, experiment string, session long, list long, serialpos int, recalled long, is_stim_list boolean, is_stim_item boolean, is_post_stim_item boolean, classifier_output double, thresh double, stimAnodeTag string, stimCathodeTag string, location string, amplitude double, stim_duration long, pulse_freq long"


def items(spark):
    rows = [(s, "FR5", n, k // 8 + 2, k % 8, k * k // 3 % 2, k // 8 % 2 == 0, on := k // 8 % 2 == 0 and k % 3 == 1, k // 8 % 2 == 0 and not on, k * 7 % 10 / 10, 0.5, f"A{n}" if on else None, "C" if on else None, None, 0.5 * n if on else None, 500 if on else None, 200 if on else None) for s in ("A", "B", None) for n in (0, 1) for k in range(64)]
    return spark.createDataFrame(rows, SHAPE)


def shuffles(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0].count("Exchange hashpartitioning")


def test_dealt_rows_need_no_shuffle(spark):
    rows = items(spark)
    got = store.dealt(rows, ["subject", "experiment", "session"], "items", 3)
    assert got.columns == rows.columns and sorted(map(str, got.collect())) == sorted(map(str, rows.collect()))
    assert shuffles(got.withColumn("n", F.count("*").over(Window.partitionBy("subject", "experiment", "session", "list")))) == 0
    assert shuffles(behavior.stim_params_by_list(got)) == 0 and shuffles(behavior.stim_params_by_list(rows)) == 1


def test_recall_tests_in_one_pass(spark):
    rows = items(spark)
    for keys in (("subject",), ()):
        got = behavior.recall_tests(rows, keys=keys)
        assert got._jdf.queryExecution().executedPlan().toString().count("collect_set") == behavior.stim_params_by_list(rows)._jdf.queryExecution().executedPlan().toString().count("collect_set")
        each = behavior.stim_params_by_list(rows).where("list >= 4 AND subject IS NOT NULL" if keys else "list >= 4").collect()
        tests = got.collect()
        assert len(tests) == 3 * 2 * (2 if keys else 1)
        for r in tests:
            own = [x for x in each if not keys or x.subject == r.subject]
            of_set = [x for x in own if (x.stimAnodeTag, x.amplitude) == (r.stimAnodeTag, r.amplitude)]
            control = [x for x in own if (not x.is_stim_list if r.comparison == "stim lists" else not x.is_stim_item and x.classifier_output < x.thresh)]
            stim = [x for x in of_set if {"stim lists": x.is_stim_list, "stim items": x.is_stim_item, "post-stim items": x.is_post_stim_item}[r.comparison]]
            assert (r.stim_correct, r.stim_items, r.control_correct, r.control_items) == (sum(x.recalled for x in stim), len(stim), sum(x.recalled for x in control), len(control))
