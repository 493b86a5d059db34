"""An increment merged into what earlier loads left equals a full run over both."""

import random

import pytest
from pyspark.sql import functions as F

from tessera.operators import increment as IN
from tessera.operators.clean import CleanSpec, Rule, drop_rows, survivors_of, total_order

SCHEMA = "id long, grp string, hit boolean, at int, ok boolean"


def spec_of(df):
    return CleanSpec(table="t", pre=(Rule("id", F.col("id").isNotNull()),), keys=("id",),
                     order=tuple(total_order(df, ["id"], [F.col("at").desc_nulls_last()])), post=(Rule("ok", F.col("ok")),))


def rows_of(rng, n, ids):
    return [(rng.choice([None, *range(ids)]), rng.choice(["a", "b", None, "c"]), rng.choice([True, False, None]),
             rng.choice([None, 1, 2, 3, 4]), rng.random() < 0.8) for _ in range(n)]


@pytest.mark.parametrize("seed", range(3))
def test_rows_and_marts_equal_a_full_run(spark, seed):
    rng = random.Random(seed)
    loads = [spark.createDataFrame(rows_of(rng, n, 60), SCHEMA) for n in (80, 25, 0, 40)]
    spec, by, sums = spec_of(loads[0]), ["grp"], {"hits": F.col("hit").cast("int")}
    state = survivors_of(loads[0], spec).checkpoint()
    mart = IN.additive(drop_rows(state, spec.post), by, sums).checkpoint()
    everything = loads[0]
    for load in loads[1:]:
        merged = IN.merge_versions(state, load, spec)
        mart = IN.maintain(mart, drop_rows(merged.old, spec.post), drop_rows(merged.new, spec.post), by, sums).checkpoint()
        state = merged.rows.checkpoint()
        everything = everything.unionByName(load)
        full = survivors_of(everything, spec)
        assert sorted(map(str, state.collect())) == sorted(map(str, full.collect()))
        want = IN.additive(drop_rows(full, spec.post), by, sums)
        assert sorted(map(str, mart.collect())) == sorted(map(str, want.collect()))


def test_an_emptied_group_goes(spark):
    old = spark.createDataFrame([(1, "a", True, 1, True)], SCHEMA)
    spec, sums = spec_of(old), {"hits": F.col("hit").cast("int")}
    merged = IN.merge_versions(old, spark.createDataFrame([(1, "b", False, 2, True)], SCHEMA), spec)
    mart = IN.maintain(IN.additive(old, ["grp"], sums), merged.old, merged.new, ["grp"], sums)
    assert [tuple(r) for r in mart.collect()] == [("b", 1, 0)]


def test_dimension_keys_stay_and_new_members_follow(spark):
    dim = spark.createDataFrame([(1, "b", "x"), (2, "d", "y"), (-1, "DESCONHECIDO", None)], "key int, t string, u string")
    fresh = spark.createDataFrame([(1, "a", "n"), (2, "b", "other"), (3, "c", "n"), (-1, None, None)], "key int, t string, u string")
    got = IN.extend_dim(dim, fresh, "t", "key")
    assert got.schema == dim.schema
    assert sorted(map(tuple, got.collect()), key=str) == sorted(
        [(1, "b", "x"), (2, "d", "y"), (-1, "DESCONHECIDO", None), (3, "a", "n"), (4, "c", "n")], key=str)
    empty = IN.extend_dim(dim.where("false"), fresh, "t", "key")
    assert sorted((r.t, r.key) for r in empty.collect()) == [("a", 1), ("b", 2), ("c", 3)]


def test_facts_of_touched_ids_are_replaced(spark):
    fact = spark.createDataFrame([(1, "old"), (2, "old"), (3, "old")], "id long, v string")
    new = spark.createDataFrame([(2, "new"), (4, "new")], "id long, v string")
    got = IN.replace_facts(fact, spark.createDataFrame([(2,)], "id long"), new)
    assert sorted(map(tuple, got.collect())) == [(1, "old"), (2, "new"), (3, "old"), (4, "new")]


def test_the_large_side_is_not_shuffled(spark):
    big = spark.range(50_000).select(F.col("id"), F.lit("a").alias("grp"), F.lit(True).alias("hit"), F.lit(1).alias("at"), F.lit(True).alias("ok"))
    merged = IN.merge_versions(big, spark.createDataFrame([(7, "b", True, 2, True)], SCHEMA), spec_of(big))
    text = merged.untouched._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in text and "hashpartitioning" not in text
