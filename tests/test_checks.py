"""Checks that run with the job."""

import pytest
from pyspark.sql import functions as F

from mnesis.operators import checks, masks, montage
from mnesis.sources import readers

EVENTS = "type string, eegfile string, session long, experiment string, x double"


@pytest.fixture(scope="module")
def events(spark):
    return spark.createDataFrame([("STIM_ON", "f", 0, "FR1", 1.0), ("STIM_ON", "", 1, "FR2", 2.0), ("WORD", "f", 1, "FR2", None)], EVENTS)


def test_held_checks_let_the_job_pass(events, tmp_path):
    with checks.Checks() as c:
        rows = c.single(readers.stim_events(events, c), "experiment")
        rows.write.parquet(f"{tmp_path}/stim")
    assert rows.count() == 1 and c.made == []
    with checks.Checks() as c:
        assert c.single(c.some(events.where("session = 0"), "none"), "session").groupBy().count().first()[0] == 1


@pytest.mark.parametrize("action", [lambda df: df.count(), lambda df: df.select(F.lit(1).alias("one")).collect(), lambda df: df.write.format("noop").mode("overwrite").save()])
def test_failed_checks_fire_though_no_column_is_read(events, action):
    with pytest.raises(ValueError, match="no stimulation"), checks.Checks() as c:
        action(readers.stim_events(events.where("session = 1"), c))
    with pytest.raises(ValueError, match="more than one experiment"), checks.Checks() as c:
        action(c.single(events, "experiment").select("session"))
    with pytest.raises(ValueError, match="no baseline"), checks.Checks() as c:
        action(masks.select_baseline_retrieval(events, c))
    with pytest.raises(ValueError, match="no session 9"), checks.Checks() as c:
        action(masks.select_session(events, 9, c))
    with pytest.raises(ValueError, match="x is missing"), checks.Checks() as c:
        action(c.all(events, F.col("x").isNotNull(), "x is missing"))


def test_trigger_must_be_there(spark):
    pairs = spark.createDataFrame([(0, "A1-A2"), (1, "A2-A3")], "pair_idx long, label string")
    with checks.Checks() as c:
        assert montage.trigger_mask(pairs, "A2-A3", c).where("is_trigger").count() == 1
    with pytest.raises(ValueError, match="no trigger electrode B1-B2"), checks.Checks() as c:
        montage.trigger_mask(pairs, "B1-B2", c).select("pair_idx").collect()


def test_no_action_is_an_error_too(events, monkeypatch):
    monkeypatch.setattr(checks, "PATIENCE", 1)
    c = checks.Checks()
    c.some(events, "none")
    with pytest.raises(ValueError, match="no action has run"):
        c.verify()


def test_an_error_in_the_block_stays_itself(events):
    with pytest.raises(KeyError), checks.Checks() as c:
        c.some(events, "none")
        raise KeyError("other")
