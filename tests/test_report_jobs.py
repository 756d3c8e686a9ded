"""The one plan of all reports against the operators that make single tables."""

import pytest
from pyspark.sql import functions as F

from mnesis.operators import behavior, masks, stats
from mnesis.plans import report_jobs as jobs
from mnesis.plans import reports

LOG = "experiment string, subject string, session long, list long, mstime long, seq long, type string, recalled long, intrusion long, serialpos long, category_num long, repeats long, phase string"
ITEMS = "experiment string, subject string, session long, list long, serialpos int, recalled long, is_stim_list boolean, is_stim_item boolean, is_post_stim_item boolean, classifier_output double, thresh double, stimAnodeTag string, stimCathodeTag string, amplitude double"


@pytest.fixture(scope="module")
def report(spark):
    kinds = ["WORD", "REC_WORD", "PROB", "WORD", "STIM_ON"]
    log = [(e, s, n, k % 4 - 1, 1000 * k + k * k % 7, k, kinds[k % 5], k // 3 % 2, k % 3 - 1, k % 6 + 1, k % 2, k % 3 + 1, "STIM") for e in ("FR1", "RepFR1", "TICL_FR", "PS5_FR", "none") for s in "AB" for n in (0, 1) for k in range(60 + ord(s) % 3)]
    items = [(e, s, n, k // 8, k % 8 + 1, k * 3 % 2, k // 8 % 2 == 0, k % 4 == 1, k % 4 == 2, k * 7 % 10 / 10 + ord(s) / 1000, 0.5, "A1" if k % 4 == 1 else None, "A2", 0.5 * (k % 3)) for e in ("FR5", "PS4_FR", "LocationSearch") for s in "AB" for n in (0, 1) for k in range(64)]
    log, items = spark.createDataFrame(log, LOG).cache(), spark.createDataFrame(items, ITEMS).cache()
    return log, items, jobs.build_all(log, items, ["mstime", "seq"], ["list", "serialpos"]).cache()


def rows(df, *columns):
    return sorted(tuple(None if r[c] is None else (round(r[c], 9) if isinstance(r[c], float) else r[c]) for c in columns) for r in df.collect())


def test_routes_are_the_builders(spark):
    names = ["FR1", "catFR1", "RepFR1", "DBOY1", "CourierReinstate1", "FR2", "catFR5", "FR6", "TICL_FR", "PS4_FR", "PS5_catFR", "LocationSearch"]
    got = spark.createDataFrame([(n,) for n in [*names, "PAL1", None]], "experiment string").select("experiment", jobs.route(F.col("experiment")).alias("b")).collect()
    assert {r.experiment: r.b for r in got} == {**{n: reports.builder(n).__name__ for n in names}, "PAL1": None, None: None}
    assert set(jobs.PRODUCTS) == {b.__name__ for b in reports.BUILDERS.values()} and {p for own in jobs.PRODUCTS.values() for p in own} == set(jobs.MEASURES)


def test_sessions_are_as_single_tables(report):
    log, items, out = report
    known = log.where("experiment <> 'none'")
    keys = ["experiment", "subject", "session"]
    columns = [*keys, "num_words", "num_correct", "num_lists", "num_prior_list_intrusions", "num_extra_list_intrusions"]
    assert rows(jobs.product(out, "session_summary"), *columns) == rows(behavior.fr_summary(known, keys), *columns)
    words = known.where(masks.encoding())
    assert rows(jobs.product(out, "serialpos").select(*keys, F.col("k1").cast("long").alias("serialpos"), (F.col("ratio") / 100).alias("p")), *keys, "serialpos", "p") == rows(behavior.recall_by_serialpos(words, tuple(keys)).withColumnRenamed("probability", "p"), *keys, "serialpos", "p")
    first = jobs.product(out, "first_recall").select(*keys, F.col("k1").cast("int").alias("serialpos"), F.col("num_first").cast("long").alias("n"))
    assert first.agg(F.sum("n")).first()[0] == words.where("recalled = 1").select(*keys, "list").distinct().count()
    maths = known.where("experiment <> 'PS5_FR'").withColumn("iscorrect", F.col("recalled"))
    assert rows(jobs.product(out, "math_summary"), *keys, "num_problems", "num_correct", "num_lists", "ratio") == rows(behavior.math_summary(maths, keys, totals=False).withColumnRenamed("percent_correct", "ratio"), *keys, "num_problems", "num_correct", "num_lists", "ratio")
    said = known.where(masks.kind("REC_EVENT", "REC_WORD") & masks.recalled() & (F.col("intrusion") == 0))
    want = behavior.category_times(said, [*keys, "list"], ["mstime", "seq"]).where("n_within + n_between > 0")
    assert rows(jobs.product(out, "category_times"), *keys, "n_within", "n_between") == rows(want, *keys, "n_within", "n_between")
    assert rows(jobs.product(out, "repeats").withColumn("repeats", F.col("k1").cast("long")), *keys, "repeats", "num_words", "num_correct") == rows(behavior.repeated_words(known.where("experiment = 'RepFR1'"), keys), *keys, "repeats", "num_words", "num_correct")
    assert {r.experiment for r in jobs.product(out, "stim_counts").collect()} == {"TICL_FR"}
    fr5 = items.where("experiment = 'FR5'")
    assert rows(jobs.product(out, "delta_recall", "subject").select("subject", "ratio"), "subject", "ratio") == rows(behavior.delta_recall(fr5, ("subject",)).withColumnRenamed("delta_recall_stim", "ratio"), "subject", "ratio")
    assert rows(jobs.product(out, "stim_lists", "subject"), "subject", "num_stim_lists", "num_nonstim_lists") == [("A", 8.0, 8.0), ("B", 8.0, 8.0)]


def test_levels_add_up(report):
    out = report[2]
    for name in ("session_summary", "serialpos", "delta_recall"):
        sums = {r.level: r.n for r in out.where(F.col("product") == name).groupBy("level").agg(F.sum("m1").alias("n")).collect()}
        assert len(set(sums.values())) == 1 and set(sums) == set(jobs.LEVELS)
    assert out.where("level = 'all' and (experiment is not null or session is not null)").count() == 0
    assert jobs.product(out, "session_summary", "all").count() == 1


def test_decision_from_sums(report):
    _, items, out = report
    ps4 = items.where("experiment = 'PS4_FR'").select("subject", F.when(F.col("is_stim_list"), "stim").otherwise("none").alias("loc_name"), F.col("serialpos").cast("double").alias("amplitude"), F.col("classifier_output").alias("delta_classifier"))
    columns = ["subject", "t_stat", "tie", "best_location"]
    got, want = rows(jobs.decisions(out), *columns), rows(stats.choose_location(ps4, keys=("subject",)), *columns)
    assert [x[2:] for x in got] == [x[2:] for x in want] and all(abs(x[1] - y[1]) < 1e-6 for x, y in zip(got, want, strict=True)) and len(got) == 2


def test_stored_products_and_one_scan(spark, report, tmp_path):
    log, items, out = report
    jobs.save(out, f"{tmp_path}/reports")
    assert sorted(p.name for p in (tmp_path / "reports").glob("product=*")) == sorted(f"product={p}" for p in {r.product for r in out.select("product").distinct().collect()})
    assert spark.read.parquet(f"{tmp_path}/reports").count() == out.count()
    log.write.parquet(f"{tmp_path}/log")
    plan = jobs.build_all(spark.read.parquet(f"{tmp_path}/log"), None, ["mstime", "seq"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1
    assert jobs.build_all(log.limit(0), None, ["mstime", "seq"]).count() == 0
