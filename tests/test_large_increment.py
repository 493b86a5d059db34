"""An increment whose keys are too many to broadcast meets the earlier versions in one shuffle."""

import random

import pytest
from pyspark.sql import functions as F

from tessera.operators import increment as IN
from tessera.operators.clean import drop_rows, survivors_of
from test_increment import SCHEMA, rows_of, spec_of


@pytest.fixture
def nothing_fits(monkeypatch):
    monkeypatch.setattr(IN, "fits_broadcast", lambda *a, **k: False)


@pytest.mark.parametrize("seed", range(2))
def test_rows_and_marts_equal_a_full_run(spark, nothing_fits, seed):
    rng = random.Random(seed)
    loads = [spark.createDataFrame(rows_of(rng, n, 40), SCHEMA) for n in (80, 60)]
    loads[1] = loads[1].unionByName(loads[1].where("id = 3 or id is null")).unionByName(
        spark.createDataFrame([(3, "h", True, i % 5, True) for i in range(200)], SCHEMA))
    spec, by, sums = spec_of(loads[0]), ["grp"], {"hits": F.col("hit").cast("int")}
    state = survivors_of(loads[0], spec).checkpoint()
    mart = IN.additive(drop_rows(state, spec.post), by, sums).checkpoint()
    merged = IN.merge_versions(state, loads[1], spec)
    full = survivors_of(loads[0].unionByName(loads[1]), spec)
    assert sorted(map(str, merged.rows.collect())) == sorted(map(str, full.collect()))
    touched = {r.id for r in loads[1].where("id is not null").collect()}
    assert {r.id for r in merged.new.collect()} == touched
    assert sorted(map(str, merged.old.collect())) == sorted(str(r) for r in state.collect() if r.id in touched)
    mart = IN.maintain(mart, drop_rows(merged.old, spec.post), drop_rows(merged.new, spec.post), by, sums)
    assert sorted(map(str, mart.collect())) == sorted(map(str, IN.additive(drop_rows(full, spec.post), by, sums).collect()))


def test_the_increment_is_not_deduplicated_apart(spark, nothing_fits, monkeypatch):
    monkeypatch.setattr(IN, "survivors_of", lambda *a: pytest.fail("a shuffle of the increment alone"))
    state = spark.range(500).select("id", F.lit("a").alias("grp"), F.lit(True).alias("hit"), F.lit(1).alias("at"), F.lit(True).alias("ok"))
    increment = state.where("id >= 100").unionByName(state.where("id >= 300")).withColumn("at", F.lit(2))
    merged = IN.merge_versions(state, increment, spec_of(state))
    assert (merged.old.count(), merged.new.count(), merged.untouched.count()) == (400, 400, 100)
