"""Property tests on random inputs (kept small: each example runs Spark jobs)."""

import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from tessera.functions import to_long
from tessera.operators import keys
from tessera.operators.clean import CleanSpec, Rule, apply_clean, audit
from tessera.operators.keys import with_ntiles, with_position

SETTINGS = settings(max_examples=8, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])


@pytest.fixture(autouse=True, scope="module")
def numbered_in_ranges():
    """Small random inputs go the way of large ones."""
    was, keys.ONE_TASK_BYTES = keys.ONE_TASK_BYTES, -1
    yield
    keys.ONE_TASK_BYTES = was


@SETTINGS
@given(st.lists(st.one_of(st.none(), st.text("abc", min_size=0, max_size=4)), min_size=1,
                max_size=60, unique=True))
def test_position_equals_row_number(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "t string").repartition(3)
    got = with_position(df, ["t"], "p", total="n")
    want = df.withColumn("p", F.row_number().over(Window.orderBy(F.col("t").asc_nulls_first())))
    assert sorted((r.t or "", r.p) for r in got.collect()) == \
        sorted((r.t or "", r.p) for r in want.collect())
    assert {r.n for r in got.collect()} == {len(values)}


@SETTINGS
@given(st.lists(st.one_of(st.none(), st.integers(0, 5)), min_size=1, max_size=50),
       st.integers(2, 5))
def test_ntile_equals_window(spark, vals, n):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "k int, v int")
    got = with_ntiles(df, {"q": (n, ["v", "k"])})
    want = df.withColumn("q", F.ntile(n).over(Window.orderBy(F.col("v").asc_nulls_first(), "k")))
    assert sorted(got.collect()) == sorted(want.collect())


@SETTINGS
@given(st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 6)),
                          st.one_of(st.none(), st.integers(2000, 2020))), min_size=1, max_size=40))
def test_audit_chain(spark, rows):
    df = spark.createDataFrame(rows, "id int, year int")
    spec = CleanSpec(table="t", pre=(Rule("id", F.col("id").isNotNull()),), keys=("id",),
                     post=(Rule("window", F.col("year").between(2005, 2015)),))
    steps = sorted(audit(df, spec).collect(), key=lambda r: r.step_order)
    assert steps[0].after == len(rows)
    for prev, cur in zip(steps, steps[1:]):
        assert cur.before == prev.after and cur.after == cur.before - cur.removed
    assert steps[-1].after == apply_clean(df, spec).count()


def _model(s):
    if s is None or not re.fullmatch(r" *[+-]?[0-9]+(\.0*)? *", s):
        return None
    v = int(s.strip().split(".")[0])
    return v if -2**63 <= v < 2**63 else None


@SETTINGS
@given(st.lists(st.one_of(st.none(), st.from_regex(r"\A *[+-]?[0-9]{1,20}(\.[05]{0,3})? *\Z"),
                          st.text(" .0123456789abx+-e", max_size=8)), min_size=1, max_size=40))
def test_to_long_matches_grammar(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "x string")
    got = [r[0] for r in df.select(to_long("x")).collect()]
    assert got == [_model(t) for t in texts]
