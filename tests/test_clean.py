import pytest
from pyspark.sql import functions as F

from tessera.operators.clean import (CleanSpec, Rule, apply_clean, audit, dedupe, drop_index_column,
                                     drop_rows, project)
from tessera.sources.files import normalize_columns, normalize_name, read_raw_csv, stamp, write_csv


def test_dedupe_keeps_defined_survivor(spark):
    df = spark.createDataFrame([(1, "b", 2), (1, "a", 2), (1, "c", 1), (2, "z", 0)],
                               "k int, t string, v int")
    got = dedupe(df, ["k"], [F.desc("v"), F.asc("t")]).orderBy("k").collect()
    assert [tuple(r) for r in got] == [(1, "a", 2), (2, "z", 0)]
    # default order: all other columns ascending
    got = dedupe(df, ["k"]).orderBy("k").collect()
    assert [tuple(r) for r in got] == [(1, "a", 2), (2, "z", 0)]


def test_dedupe_prunes_before_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("k"), F.col("id").alias("v"))
    plan = dedupe(df, ["k"])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan or "AdaptiveSparkPlan" in plan


def test_drop_rows_three_valued(spark):
    df = spark.createDataFrame([(2012,), (2018,), (None,)], "year int")
    out = drop_rows(df, [Rule("window", F.col("year").between(2012, 2017))])
    assert [r.year for r in out.collect()] == [2012]


def test_audit_charges_first_failed_rule(spark):
    df = spark.createDataFrame(
        [(1, "a", 2015), (1, "b", 2015), (None, "c", 2015), (2, None, 2015), (3, "x", 2011),
         (4, None, 2011), (5, "y", 2016)], "id int, d string, year int")
    spec = CleanSpec(table="t", pre=(Rule("null id", F.col("id").isNotNull()),), keys=("id",),
                     post=(Rule("null d", F.col("d").isNotNull()),
                           Rule("window", F.col("year").between(2012, 2017))))
    rows = {r.step: r for r in audit(df, spec).collect()}
    assert rows["input"].after == 7
    assert (rows["null id"].removed, rows["null id"].after) == (1, 6)
    assert (rows["duplicate key"].removed, rows["duplicate key"].after) == (1, 5)
    assert (rows["null d"].removed, rows["null d"].after) == (2, 3)   # id 2 and id 4
    assert (rows["window"].removed, rows["window"].after) == (1, 2)
    assert apply_clean(df, spec).count() == 2


def test_project_and_index_column(spark):
    df = spark.createDataFrame([("0", "7", "x")], "_c0 string, id string, t string")
    assert drop_index_column(df).columns == ["id", "t"]
    out = project(df, {"id": F.col("id").cast("int"), "text": "t"})
    assert out.columns == ["id", "text"] and out.first().id == 7


def test_normalize_names():
    assert normalize_name(" Case Number ") == "case_number"
    assert normalize_name("N (Region) Key") == "n_region_key"
    assert normalize_name("a=b;c") == "a_b_c"


def test_normalize_rejects_collisions(spark):
    df = spark.createDataFrame([(1, 2)], "`a b` int, `a_b` int")
    with pytest.raises(ValueError):
        normalize_columns(df)


def test_csv_multiline_quotes_empty_and_index(spark, tmp_path):
    p = tmp_path / "x.csv"
    p.write_text(',ID,Block,Code\n0,1,"123 ""MAIN"" ST\nAPT 4",0110\n1,2,,""\n')
    df = read_raw_csv(spark, str(p))
    assert df.columns == ["_c0", "ID", "Block", "Code"]
    rows = df.orderBy("ID").collect()
    assert len(rows) == 2
    assert rows[0].Block == '123 "MAIN" ST\nAPT 4' and rows[0].Code == "0110"
    assert rows[1].Block is None and rows[1].Code is None
    assert all(t == "string" for _, t in df.dtypes)


def test_csv_roundtrip_and_stamp(spark, tmp_path):
    df = spark.createDataFrame([(1, "a b"), (2, "x,y")], "k int, t string")
    path = write_csv(df, str(tmp_path / "out"))
    back = stamp(read_raw_csv(spark, path), "test")
    assert sorted((r.k, r.t) for r in back.collect()) == [("1", "a b"), ("2", "x,y")]
    assert back.select("_source").distinct().count() == 1
    assert back.select("_ingested_at").distinct().count() == 1


def test_stamp_uses_given_time_in_session_zone(spark):
    import datetime as dt
    df = spark.createDataFrame([(1,)], "k int")
    t = dt.datetime(2024, 1, 2, 3, 4, 5)
    got = stamp(df, "x", t).select(F.col("_ingested_at").cast("string").alias("s")).first().s
    assert got == "2024-01-02 03:04:05"


def test_save_all_writes_side_by_side_and_raises(spark):
    import pytest as _pt
    from tessera.sources.catalog import ensure_layers, save_all
    ensure_layers(spark, ["scratch_t"])
    out = save_all({"scratch_t.a": spark.range(3), "scratch_t.b": lambda: spark.range(5)})
    assert spark.table("scratch_t.a").count() == 3 and spark.table("scratch_t.b").count() == 5
    assert set(out) == {"scratch_t.a", "scratch_t.b"}
    with _pt.raises(Exception):
        save_all({"scratch_t.c": lambda: spark.range(1).selectExpr("missing_column")})


def test_csv_files_of_other_column_orders_and_malformed_records(spark, tmp_path):
    import pytest
    from tessera.sources.files import malformed
    (tmp_path / "a.csv").write_text("id,name\n1,x\n2\n3,y,z\n")
    (tmp_path / "b.csv").write_text("name,id\n w ,4\n")
    df = read_raw_csv(spark, str(tmp_path / "*.csv"), columns=["id", "name"], corrupt="bad")
    got = {r.id: (r.name, r.bad) for r in df.collect()}
    assert got == {"1": ("x", None), "2": (None, "2"), "3": ("y", "3,y,z"), "4": (" w ", None)}
    assert tuple(malformed(df.checkpoint(), "bad").first()) == (4, 2)
    (tmp_path / "c.csv").write_text("id,title\n5,q\n")
    with pytest.raises(ValueError, match="c.csv"):
        read_raw_csv(spark, str(tmp_path / "*.csv"))


def test_written_csv_keeps_outer_blanks(spark, tmp_path):
    df = spark.createDataFrame([(" a ", "b"), ("", "c")], "x string, y string")
    back = read_raw_csv(spark, write_csv(df, str(tmp_path / "o")))
    assert sorted((r.x or "", r.y) for r in back.collect()) == [("", "c"), (" a ", "b")]
