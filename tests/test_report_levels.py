"""Reports at chosen levels, and what a row of a report costs."""

import pytest
from pyspark.sql import functions as F

from mnesis.plans import report_jobs as jobs
from tests.test_report_jobs import ITEMS, LOG

ORDER = ["mstime", "seq"]


@pytest.fixture(scope="module")
def tables(spark):
    kinds = ["WORD", "REC_WORD", "PROB", "WORD", "STIM_ON"]
    log = [(e, s, n, k % 4 - 1, 1000 * k + k * k % 7, k, kinds[k % 5], k // 3 % 2, k % 3 - 1, k % 6 + 1, k % 2, k % 3 + 1, "STIM") for e in ("FR1", "RepFR1", "TICL_FR", "none") for s in "AB" for n in (0, 1) for k in range(60)]
    items = [(e, s, n, None if k < 8 else k // 8, k % 8 + 1, None if k % 11 == 0 else k * 3 % 2, k // 8 % 2 == 0 or k == 17, k % 4 == 1, k % 4 == 2, None if k % 9 == 0 else k * 7 % 10 / 10 + ord(s) / 1000, 0.5, "A1" if k % 4 == 1 else None, "A2", 0.5 * (k % 3)) for e in ("FR5", "PS4_FR", "LocationSearch", None) for s in "AB" for n in (0, 1) for k in range(64)]
    return spark.createDataFrame(log, LOG).cache(), spark.createDataFrame(items, ITEMS).cache()


def as_rows(df):
    return sorted(str([round(x, 9) if isinstance(x, float) else x for x in r]) for r in df.collect())


@pytest.mark.parametrize("levels", [["subject"], ["experiment", "all"], ["all"]])
def test_levels_asked_for_are_those_of_the_whole_report(tables, levels):
    whole = jobs.build_all(*tables, ORDER)
    got = jobs.build_all(*tables, ORDER, levels=levels)
    assert got.columns == whole.columns and as_rows(got) == as_rows(whole.where(F.col("level").isin(levels)))
    assert {r.product for r in got.select("product").distinct().collect()} == {r.product for r in whole.select("product").distinct().collect()}


def test_named_locations_at_a_higher_level(tables):
    log, items = tables
    items = items.withColumn("loc_name", F.when(F.col("is_stim_item"), "LA").otherwise("LB"))
    assert as_rows(jobs.build_all(log, items, ORDER, levels=["subject"])) == as_rows(jobs.build_all(log, items, ORDER).where("level = 'subject'"))


def test_a_filter_on_the_route_names_the_experiment_once(spark, tables, tmp_path):
    tables[0].write.parquet(f"{tmp_path}/log")
    made = spark.read.parquet(f"{tmp_path}/log").withColumn("experiment", F.concat(F.lower("experiment"), F.lit("_made")))
    plan = made.where(jobs.route(F.col("experiment")).isNotNull())._jdf.queryExecution().optimizedPlan().toString()
    condition = next(line for line in plan.splitlines() if "Filter" in line)
    assert condition.count("_made") == 1


def test_routes_take_beginnings_as_they_stand(spark):
    names = ["FR1", "FR12", "xFR1", "fr1", "", "TICL.FR", "catFR", "FR1\n", "CourierReinstate1_x"]
    got = {r.e: r.b for r in spark.createDataFrame([(n,) for n in names], "e string").select("e", jobs.route(F.col("e")).alias("b")).collect()}
    want = {"FR1": "record_only", "FR12": "record_only", "TICL.FR": "ticl", "FR1\n": "record_only", "CourierReinstate1_x": "record_only"}
    assert got == {n: want.get(n) for n in names}
