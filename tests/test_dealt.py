"""Rows that the dedupe deals into buckets are written without another exchange."""

from pyspark.sql import functions as F

from tessera.operators import clean
from tessera.plans import crimes as C
from tessera.plans import tpch
from tessera.sources import catalog


def exchanges(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.count("Exchange hashpartitioning(")


def versions(spark):
    """Ids with two versions, a null id and one hot id, of 400 rows."""
    n = F.col("n")
    key = F.when(n % 97 == 0, F.lit(None)).when(n < 800, F.lit(7)).otherwise(n % 300)
    return spark.range(2000).select(F.col("id").alias("n")).select(key.cast("long").alias("id"), "n", (n % 13).alias("v"))


def test_dealt_rows_are_those_of_the_dedupe(spark, monkeypatch):
    df = versions(spark).checkpoint()
    order = [F.desc("v"), F.asc("n")]
    whole = sorted(clean.dedupe(df, ["id"], order).collect(), key=str)
    for small in (1 << 24, 0):  # without and with the pass that finds the hot id
        monkeypatch.setattr(clean, "SMALL_BYTES", small)
        dealt = clean.dedupe(df, ["id"], order, parts=5)
        assert sorted(dealt.collect(), key=str) == whole and dealt.rdd.getNumPartitions() == 5


def test_a_bucketed_write_of_dealt_rows_has_one_exchange(spark):
    rows = clean.dedupe(versions(spark), ["id"], [F.desc("v"), F.asc("n")], parts=5)
    assert exchanges(rows) == 1
    name = catalog.save(rows, "default.dealt", bucket_by=(5, ["id"]), dealt=True)
    table = spark.table(name)
    assert len(table.inputFiles()) == 5 and exchanges(table.groupBy("id").count()) == 0
    assert sorted(table.collect(), key=str) == sorted(rows.collect(), key=str)


def test_the_build_deals_its_records_once(spark, landing, tmp_path, monkeypatch):
    from tessera.plans import crimes
    seen = {}

    def save(df, name, **kw):
        if kw.get("bucket_by"):
            seen[name] = (kw.get("dealt", False), exchanges(df))
        return catalog.save(df, name, **kw)
    monkeypatch.setattr(crimes, "save", save)
    layers = ("bronze_dealt", "silver_dealt", "gold_dealt")
    C.build(spark, landing, C.Config(layers=layers, location=str(tmp_path), buckets=3), comments=False)
    assert seen["silver_dealt.crimes_checked_a"] == (True, 1)


def test_both_landings_share_their_times(spark, tmp_path):
    """Two formatted times an item, one of them shared by date and update of the first landing."""
    spark.sql("SELECT 1L l_orderkey, 2L l_partkey, 3L l_suppkey, 1 l_linenumber, 5D l_quantity, 9D l_extendedprice, 0.1D l_discount, "
              "0.01D l_tax, 'R' l_returnflag, 'F' l_linestatus, TIMESTAMP_NTZ '1996-03-01 13:05:06' l_shipdate").write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.sql("SELECT 2L p_partkey, 'Brand#12' p_brand, 'T' p_type, 'name' p_name, 9 p_size").write.parquet(f"{tmp_path}/part.parquet")
    spark.sql("SELECT 3L s_suppkey, 4 s_nationkey").write.parquet(f"{tmp_path}/supplier.parquet")
    raw = tpch.crimes_raw(spark, str(tmp_path))
    got = sorted((r.case_number, r.date, r.updated_on) for r in raw.collect())
    assert got == [("L11", "03/01/1996 01:05:06 PM", "03/01/1996 01:05:06 PM"),
                   ("again 11", "03/01/1996 01:05:06 PM", "02/29/1996 01:05:06 PM")]
    plan = raw._jdf.queryExecution().optimizedPlan().toString()
    above = plan[:plan.index("Generate explode")]
    assert "date_format" not in above
