import datetime as dt

import pytest

from ledgertag.plans import training_set
from ledgertag.plans.training_set import TrainingSetConfig
from ledgertag.session import (
    drop_scratch,
    materialize,
    scratch_path,
    scratch_scope,
    scratch_scopes,
)
from test_jobs import SETTINGS, write_inputs


def test_tables_of_a_scope_go_with_it(spark):
    before = scratch_scopes(spark)
    with scratch_scope(spark, "job") as place:
        kept = materialize(spark.range(10))
        assert kept.count() == 10 and place in {p.removeprefix("file:") for p in scratch_scopes(spark)}
        with scratch_scope(spark, "inner") as inner:
            assert inner == place and scratch_path(spark, "x").startswith(place)
        assert kept.count() == 10  # the inner job leaves the outer one's tables alone
    assert scratch_scopes(spark) == before


def test_tables_of_a_failed_job_stay_and_can_be_dropped(spark):
    before = set(scratch_scopes(spark))
    with pytest.raises(ZeroDivisionError), scratch_scope(spark, "broken"):
        materialize(spark.range(10))
        raise ZeroDivisionError
    (left,) = set(scratch_scopes(spark)) - before
    assert "ledgertag-broken-" in left
    drop_scratch(spark, left)
    assert set(scratch_scopes(spark)) == before
    with pytest.raises(ValueError, match="not a scratch folder"):
        drop_scratch(spark, "/tmp/other")


def test_outside_a_scope_tables_stay(spark):
    before = len(scratch_scopes(spark))
    assert materialize(spark.range(3)).count() == 3
    assert len(scratch_scopes(spark)) == before + 1


def test_only_outputs_remain_of_a_run(spark, tmp_path):
    paths = write_inputs(spark, str(tmp_path / "inputs"))
    before = scratch_scopes(spark)
    config = TrainingSetConfig.from_text(SETTINGS)
    training_set.run(spark, paths, config, str(tmp_path / "out"))
    assert scratch_scopes(spark) == before
    assert spark.read.parquet(f"{tmp_path}/out/sets").where("split = 'test'").count() >= 50
    late = TrainingSetConfig.from_text({**SETTINGS, "n_test_samples": "9999"})
    with pytest.raises(ValueError, match="wanted"):
        training_set.run(spark, paths, late, str(tmp_path / "out2"))
    assert len(scratch_scopes(spark)) == len(before) + 1
    assert config.start == dt.date(2017, 1, 1)
