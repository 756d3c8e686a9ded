"""What tables of sixty times the size showed, on small ones."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from mnesis.operators import montage, stats
from mnesis.sources import store

RATES = (0.02, 0.2)


@pytest.mark.parametrize("small", [0, 5000])
def test_nearest_region_of_repeated_places_and_keys(spark, small):
    """Voxels that share places, electrodes that share a key: the least of all distances, then of regions."""
    r = np.random.default_rng(1)
    v = np.vstack([r.integers(0, 6, (8, 3))] * 30).astype(float)
    e = r.uniform(0, 40, (40, 3)).round(1)
    voxels = spark.createDataFrame([(240 - i, *map(float, x)) for i, x in enumerate(v)], "region long, x double, y double, z double")
    near = montage.nearest_region(spark.createDataFrame([(i // 2, *map(float, x)) for i, x in enumerate(e)], "i long, x double, y double, z double"), voxels, "i", cell=2.0, small=small)
    want = {}
    for i, x in enumerate(e):
        own = min((float(np.sqrt((y - x) @ (y - x))), 240 - k) for k, y in enumerate(v))
        want[i // 2] = min(own, want.get(i // 2, own))
    got = {q.i: (q.distance, q.region) for q in near.collect()}
    assert set(got) == set(want) and all(abs(got[i][0] - want[i][0]) < 1e-9 and got[i][1] == want[i][1] for i in want)


def test_a_small_atlas_is_one_of_few_places(spark):
    """An atlas of many voxels at few places is compared as a small one: no cells, no shuffle of neighbours."""
    voxels = spark.range(600).select(F.col("id").alias("region"), *[(F.col("id") % 5).cast("double").alias(c) for c in "xyz"])
    electrodes = spark.range(20).select("id", *[(F.col("id") % 7).cast("double").alias(c) for c in "xyz"])
    near = montage.nearest_region(electrodes, voxels, "id", small=10)
    assert "MapInPandas" in near._jdf.queryExecution().toString() and sorted({q.region for q in near.collect()}) == [0, 1, 2, 3, 4]


def test_pair_distances_in_blocks(spark):
    """A group of several blocks has each of its pairs once, and its work is dealt to as many tasks as it needs."""
    df = spark.range(90).select(F.col("id").alias("pair_idx"), F.when(F.col("id") < 70, "a").otherwise("b").alias("g"), *[(F.col("id") * k % 17).cast("double").alias(c) for k, c in enumerate("xyz", 1)])
    got = montage.pair_distances(df, ["g"], block=8).collect()
    assert len(got) == len({(q.g, q.i, q.j) for q in got}) == 70 * 69 // 2 + 20 * 19 // 2
    at = {q.pair_idx: np.array([q.x, q.y, q.z]) for q in df.collect()}
    assert all(q.i < q.j and abs(q.distance - np.linalg.norm(at[q.i] - at[q.j])) < 1e-9 for q in got)


def test_saves_replace_sessions_without_a_folder_each(spark, tmp_path):
    """Files go with rows, not sessions; a later save replaces the sessions it has and no others, append adds to them."""
    root = f"{tmp_path}/db"
    rows = spark.range(400).select((F.col("id") % 7).cast("string").alias("subject"), F.lit("FR1").alias("experiment"), (F.col("id") % 200).alias("session"), F.lit(1).alias("n"))
    store.save(rows, root, "items")
    store.save(rows.where("session < 3 or session > 250").withColumn("n", F.lit(2)), root, "items")
    store.save(rows.where("session = 5").withColumn("n", F.lit(3)), root, "items", mode="append")
    assert len(list(tmp_path.rglob("*.parquet"))) < 20
    got = store.load(spark, root, "items")
    assert got.columns == rows.columns and {(q["session"], q["n"]): q["count"] for q in got.groupBy("session", "n").count().collect()} == {**{(k, 2 if k < 3 else 1): 2 for k in range(200)}, (5, 3): 2}
    wanted = spark.createDataFrame([("1", "FR1", 1), ("1", "FR1", 500)], "subject string, experiment string, session long")
    assert store.load(spark, root, "items", wanted).count() == 1 and [q.session for q in store.missing(spark, root, "items", wanted).collect()] == [500]


def test_scores_of_many_rows_are_zero(spark):
    """A fit ends where the score equations hold, not where they nearly hold in proportion to the rows."""
    chance = F.when(F.col("is_stim_list"), F.lit(RATES[0])).otherwise(F.lit(RATES[1]))
    df = spark.range(3_000_000).select((F.col("id") % 2 == 0).alias("is_stim_list"), (F.col("id") % 7).cast("double").alias("place"), F.col("id"))
    df = df.select("is_stim_list", "place", (F.floor(F.col("id") / 14) % 1000 < chance * 1000 + F.col("place") * 20).cast("long").alias("recalled"))
    names = {"all": []}, {"is_stim_list": None}
    got = stats.stim_effects(df, ["place"], *names)
    scores = stats.effect_scores(stats.effect_cells(df, ["place"], *names), got, ["place"], []).collect()
    assert len(scores) == 3 and all(abs(q.score) < 5e-5 for q in scores) and got.first().converged


def test_outcomes_shuffled_over_slices(spark):
    """Groups of many rows are dealt to tasks: the true AUC stays, drawings of all slices together have the moments of a
    shuffle within groups, and reruns agree."""
    df = spark.range(600).select(F.lit("A").alias("subject"), (F.col("id") % 2).alias("list"), F.col("id").alias("event_id"), (F.col("id") * 7 % 31).cast("double").alias("score"), (F.col("id") % 5 == 0).cast("long").alias("outcome"))
    draw = lambda most: {q.perm: q.auc for q in stats.permuted_aucs(df.repartition(3), ["subject"], "score", "outcome", ["list"], 300, most=most).collect()}
    whole, dealt = draw(1000), draw(25)
    assert len(dealt) == 301 and abs(whole[0] - dealt[0]) < 1e-12 and dealt == draw(25)
    a, b = (np.array([v for k, v in sorted(x.items()) if k]) for x in (whole, dealt))
    assert abs(a.mean() - b.mean()) < 0.01 and 0.8 < a.std() / b.std() < 1.25 and len(set(b)) > 100


def test_adjusted_p_takes_one_pass(spark):
    """A frame that reaches to the end is read anew for each row; results are those of the plain formula."""
    df = spark.range(50).select(F.col("id"), (F.col("id") * 7 % 20 / 20).alias("p"))
    got = stats.benjamini_hochberg(df, "p")
    assert "unboundedfollowing" not in got._jdf.queryExecution().toString().lower().replace("specifiedwindowframe(rowframe, unboundedpreceding$(), unboundedfollowing$())", "").replace("unboundedpreceding$(), unboundedfollowing$()", "")
    p = sorted((q.p, q.id) for q in df.collect())
    want = {i: min(1.0, min(p[k][0] * 50 / (k + 1) for k in range(r, 50))) for r, (_, i) in enumerate(p)}
    assert all(abs(q.adjusted - want[q.id]) < 1e-12 for q in got.collect())


def test_files_are_written_by_many_tasks(spark, monkeypatch):
    """A table of one partition still has its files written by several tasks."""
    from mnesis.plans import catalog_files

    monkeypatch.setattr(catalog_files, "FILES_A_TASK", 5)
    path = catalog_files.written(spark.range(30).coalesce(1).select(F.col("id").cast("string").alias("value")), spark, "many")
    names = spark.read.text(path).select(F.regexp_extract(F.input_file_name(), r"part-(\d+)", 1).alias("task"), F.input_file_name().alias("file"), "value").collect()
    assert len({q.file for q in names}) == len({q.value for q in names}) == 30 and len({q.task for q in names}) == 6
