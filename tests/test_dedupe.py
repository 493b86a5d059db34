"""The dedupe of a table that is not known to be small: whole rows are sorted once, above the
exchange, and only rows of hot keys are reduced below it."""

import random

import pytest
from pyspark.sql import functions as F

from tessera.operators import clean as CL


@pytest.fixture
def no_small_tables(monkeypatch):
    monkeypatch.setattr(CL, "SMALL_BYTES", 0)


def executed(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_rows_are_sorted_above_the_exchange_only(spark, no_small_tables):
    df = spark.range(20_000, numPartitions=4).select((F.col("id") % 9000).alias("k"), F.col("id").alias("v"))
    plan = executed(CL.dedupe(df, ["k"], [F.desc("v")]))
    above, below = plan.split("Exchange hashpartitioning")
    assert "WindowGroupLimit" in above and "Sort" in above
    assert "WindowGroupLimit" not in below and "Sort" not in below


def test_a_hot_key_is_still_reduced_map_side(spark, no_small_tables):
    df = spark.range(30_000, numPartitions=8).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), F.col("id").alias("v"))
    out = CL.dedupe(df, ["k"], [F.desc("v")])
    rows = {r.k: r.v for r in out.collect()}
    assert rows[0] == 29997 and len(rows) == 20_001
    assert "Partial" in executed(out).split("Exchange hashpartitioning")[1]


@pytest.mark.parametrize("seed", range(2))
def test_same_rows_as_for_a_small_table(spark, monkeypatch, seed):
    rng = random.Random(seed)
    rows = [(rng.choice([None, "a", *map(str, range(300))]) if rng.random() < 0.7 else "hot", rng.choice([None, 1, 2]),
             rng.choice([None, 0.5, float("nan"), -0.0, 0.0])) for _ in range(3000)]
    df = spark.createDataFrame(rows, "k string, n int, v double")
    small = {keys: sorted(map(str, CL.dedupe(df, list(keys)).collect())) for keys in (("k",), ("k", "n"), ("v",))}
    monkeypatch.setattr(CL, "SMALL_BYTES", 0)
    for keys, want in small.items():
        assert sorted(map(str, CL.dedupe(df, list(keys)).collect())) == want
