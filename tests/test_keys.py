import random

import pytest

from pyspark.sql import Window
from pyspark.sql import functions as F

from tessera.operators import keys
from tessera.operators.keys import with_ntile, with_ntiles, with_surrogate_key, with_unknown


@pytest.fixture(autouse=True, params=["ranges", "one task"])
def way(request, monkeypatch):
    """Both ways of numbering, whatever the size of the input."""
    monkeypatch.setattr(keys, "ONE_TASK_BYTES", -1 if request.param == "ranges" else 1 << 40)
    return request.param


def test_surrogate_key_equals_global_row_number(spark):
    rnd = random.Random(7)
    names = [f"n{rnd.randrange(10**6):06d}" for _ in range(3000)]
    df = spark.createDataFrame([(n,) for n in set(names)], "name string").repartition(5)
    got = with_surrogate_key(df, ["name"], "k", key_type="long")
    want = df.withColumn("k", F.row_number().over(Window.orderBy("name")).cast("long"))
    assert sorted(got.collect()) == sorted(want.collect())
    # keys are dense 1..n
    ks = sorted(r.k for r in got.collect())
    assert ks == list(range(1, len(ks) + 1))


def test_surrogate_key_nulls_first(spark):
    df = spark.createDataFrame([("b",), (None,), ("a",)], "t string")
    got = {r.t: r.k for r in with_surrogate_key(df, ["t"], "k").collect()}
    assert got == {None: 1, "a": 2, "b": 3}


def test_large_input_uses_no_single_partition_exchange_of_rows(spark, monkeypatch):
    monkeypatch.setattr(keys, "ONE_TASK_BYTES", -1)
    from tessera.operators.keys import with_position
    df = spark.range(1000).select(F.col("id").cast("string").alias("s"))
    plan = with_position(df, ["s"], "k")._jdf.queryExecution().executedPlan().toString()
    # the only single-partition step is inside the broadcast offsets (one row per partition)
    head = plan.split("BroadcastExchange")[0]
    assert "SinglePartition" not in head


def test_ntile_equals_window_ntile_with_ties_and_nulls(spark):
    rows = [(i, (i * 37) % 23 if i % 9 else None) for i in range(1, 78)]
    df = spark.createDataFrame(rows, "area int, v int")
    got = with_ntile(df, 4, ["v", "area"], "q")
    want = df.withColumn("q", F.ntile(4).over(Window.orderBy(F.col("v").asc_nulls_first(), "area")))
    assert sorted(got.collect()) == sorted(want.collect())
    sizes = [r["count"] for r in got.groupBy("q").count().orderBy("q").collect()]
    assert sizes == [20, 19, 19, 19]


def test_with_unknown_appends_typed_row(spark):
    df = spark.createDataFrame([(1, "x")], "k int, t string")
    out = with_unknown(df, {"k": -1, "t": "DESCONHECIDO"})
    assert sorted(out.collect()) == sorted([(1, "x"), (-1, "DESCONHECIDO")])
    assert out.schema == df.schema or [f.dataType for f in out.schema] == [f.dataType for f in df.schema]


def test_nothing_stays_cached_and_sizes_are_recorded(spark, monkeypatch):
    monkeypatch.setattr(keys, "ONE_TASK_BYTES", -1)
    from tessera.operators.fact import size_of
    before = spark.sparkContext._jsc.getPersistentRDDs().size()
    df = spark.range(500).select(F.concat(F.lit("text"), F.col("id").cast("string")).alias("s"))
    out = with_surrogate_key(df, ["s"], "k")
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == before
    rows, size = size_of(out)
    assert rows == 500 and 500 * 5 < size < 500 * 100


def test_too_many_members_fail_loudly(spark):
    import pytest
    df = spark.createDataFrame([(i,) for i in range(200)], "s int")
    with pytest.raises(Exception, match="OVERFLOW|overflow"):
        with_surrogate_key(df, ["s"], "k", key_type="tinyint").collect()


def test_tiles_of_several_specs_and_types(spark):
    rows = [(i, None if i % 11 == 0 else (i * 7919 % 13) / 4, None if i % 5 == 0 else f"t{i % 3}", i % 2 == 0) for i in range(203)]
    df = spark.createDataFrame(rows, "id int, x double, t string, b boolean").repartition(3)
    specs = {"a": (7, ["x", "id"]), "c": (4, ["t", "b", "id"]), "d": (300, ["id"]), "e": (1, ["id"])}
    got = with_ntiles(df, specs)
    want = df.withColumns({n: F.ntile(k).over(Window.orderBy(*[F.col(c).asc_nulls_first() for c in order])) for n, (k, order) in specs.items()})
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_only_a_proven_bound_is_numbered_in_one_task(spark, monkeypatch):
    monkeypatch.undo()
    small = spark.range(1000)
    assert keys._one_task(small) and not keys._one_task(spark.range(10**9))
    assert not keys._one_task(small.select(F.explode(F.sequence(F.lit(1), F.lit(10**6)))))
    assert not keys._one_task(small.crossJoin(spark.range(10**9)))
    assert keys._one_task(small.groupBy((F.col("id") % 7).alias("k")).count())
