"""A key holding a third of all rows: results stay whole and right, and the heavy work is
reduced map-side before any shuffle (no task receives the hot key's raw rows)."""

from pyspark.sql import functions as F

from tessera.operators.clean import dedupe
from tessera.operators.dims import representative
from tessera.operators.marts import group_rate
from tessera.operators.quality import duplicate_keys


def hot(spark, n=30000):
    # key 0 holds a third of the rows, spread over every input partition
    return (spark.range(n, numPartitions=8)
            .select(F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("k"),
                    F.col("id").alias("v"), (F.col("id") % 5 == 0).alias("is_arrest")))


def executed(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_dedupe_hot_key(spark):
    df = hot(spark)
    out = dedupe(df, ["k"], [F.desc("v")])
    rows = {r.k: r.v for r in out.collect()}
    assert rows[0] == 29997 and len(rows) == 1 + 20000
    plan = executed(out)
    # partial top-1 per key below the exchange
    below = plan.split("Exchange hashpartitioning")[1]
    assert "WindowGroupLimit" in below and "Partial" in below


def test_rates_and_counts_hot_key(spark):
    df = hot(spark)
    g = {r.k: (r.total, r.taxa) for r in group_rate(df, ["k"], rate_name="taxa").collect()}
    assert g[0][0] == 10000 and len(g) == 20001
    plan = executed(group_rate(df, ["k"], rate_name="taxa"))
    assert "partial_count" in plan.split("Exchange hashpartitioning")[1]
    d = duplicate_keys(df, ["k"]).first()
    assert (d.linhas, d.chaves_repetidas, d.linhas_extras) == (30000, 1, 9999)


def test_representative_hot_code(spark):
    df = hot(spark).select(F.when(F.col("k") == 0, "HOT").otherwise("c").alias("iucr"),
                           (F.col("v") % 2).cast("string").alias("primary_type"))
    rep = {r.iucr: r.primary_type for r in representative(df, "iucr", ["primary_type"]).collect()}
    # key 0 rows are v = 0, 3, 6, ...: 5000 even (type "0"), 5000 odd -> tie -> smallest "0"
    assert rep["HOT"] == "0"
