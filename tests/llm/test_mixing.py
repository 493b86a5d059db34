import collections
import hashlib
import math

import pytest
from pyspark.sql import functions as F

from tessera.llm import mixing as M


def poisson(u, rate):
    """Smallest k with CDF(k) > u."""
    k, p, total = 0, math.exp(-rate), math.exp(-rate)
    while total <= u:
        k += 1
        p *= rate / k
        total += p
    return k


def uniform(doc_id, seed="mix-1"):
    return int(hashlib.md5(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:13], 16) / 2**52


def brute(rows, weights=None, budget=None, size=None):
    mass = collections.Counter()
    for r in rows:
        mass[r["source"]] += 1.0 if size is None else max(float(r[size] or 0), 0.0)
    w = {s: 1.0 for s in mass} if weights is None else {s: weights.get(s, 0.0) for s in mass}
    total = sum(w[s] for s in mass if mass[s] > 0)
    target = sum(mass.values()) if budget is None else budget
    out = collections.Counter()
    for r in rows:
        s = r["source"]
        rate = w[s] * target / total / mass[s] if mass[s] > 0 and total else 0
        out[r["doc_id"]] += poisson(uniform(r["doc_id"]), rate) if rate else 0
    return {k: v for k, v in out.items() if v}


@pytest.mark.parametrize(("weights", "budget", "size"), [
    (None, None, None), ({"src0": 3.0, "src1": 1.0}, 500, None), ({"src2": 1.0}, None, "n_chars"), ({}, None, None)])
def test_counts_follow_the_inverse(spark, documents, weights, budget, size):
    table = None if weights is None else spark.createDataFrame(list(weights.items()), "source string, weight double")
    got = M.mix_sources(documents, table, budget, size=size)
    rows = [r.asDict() for r in documents.drop("text").collect()]
    counts = dict(got.groupBy("doc_id").count().collect())
    assert counts == brute(rows, weights, budget, size)
    assert got.columns == [*documents.columns, "copy_no", "mix_key"]


def inverse(u, rate):
    """Smallest k with CDF(k) > u, terms from their logarithms."""
    k, total = 0, 0.0
    while True:
        total += math.exp(k * math.log(rate) - rate - math.lgamma(k + 1))
        if total > u or k > rate + 10 * math.sqrt(rate) + 20:
            return k
        k += 1


@pytest.mark.parametrize("rate", [1e-9, 0.3, 1.0, 30.0, 700.0, 1650.0, 2300.0, 5000.0, 40_000.0])
def test_large_rates_and_tails(spark, rate):
    us = [0.0, 1e-12, 0.001, 0.1, 0.37, 0.5, 0.61, 0.9, 0.9995]
    df = spark.createDataFrame([(u, rate) for u in us], "u double, r double")
    got = dict(df.select("u", M.poisson_count(F.col("u"), F.col("r"))).collect())
    assert got == {u: inverse(u, rate) for u in us}


def test_counts_of_a_large_rate_have_its_mean_and_spread(spark):
    df = spark.range(400).select(((F.col("id") + 0.5) / 400).alias("u"), F.lit(1e6).alias("r"))
    got = [r[0] for r in df.select(M.poisson_count(F.col("u"), F.col("r"))).collect()]
    assert sum(got) / 400 == pytest.approx(1e6, abs=10)
    assert math.sqrt(sum((n - 1e6) ** 2 for n in got) / 400) == pytest.approx(1000, rel=0.02)


def test_a_source_of_one_document_among_many(spark):
    docs = spark.range(1, 200_001).select(F.col("id").alias("doc_id"), F.when(F.col("id") == 7, "rare").otherwise("hot").alias("source"))
    got = dict(M.mix_sources(docs).groupBy("source").count().collect())
    assert got["rare"] == inverse(uniform(7), 100_000.0) and abs(got["hot"] - 100_000) < 2000


def test_weights_are_reached(documents):
    got = M.mix_sources(documents, budget=20_000)
    shares = [r["count"] for r in got.groupBy("source").count().collect()]
    assert all(abs(s / 20_000 - 1 / len(shares)) < 0.02 for s in shares)


def test_nulls_repeats_empty_and_clashing_names(spark, frame, hard_docs):
    got = M.mix_sources(hard_docs, budget=200)
    assert dict(got.groupBy("doc_id").count().collect()) == brute([r.asDict() for r in hard_docs.collect()], budget=200)
    assert {r[0] for r in got.select("source").distinct().collect()} == {None, "a", "b"}
    assert M.mix_sources(spark.createDataFrame([], "doc_id long, source string")).count() == 0
    docs = frame([(1, "a", "x", 4)], "doc_id long, source string, Copy_no string, __rate int")
    assert M.mix_sources(docs, budget=5).columns == ["doc_id", "source", "copy_no", "mix_key"]


def test_plan_has_no_python(documents):
    plan = M.mix_sources(documents)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
