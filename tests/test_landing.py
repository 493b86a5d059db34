"""The landed text of the crime records."""

from pyspark.sql import functions as F

from tessera.plans import tpch


def test_landed_crimes_are_read_in_one_scan(spark, tmp_path):
    spark.createDataFrame([(1, 1, 5, 6, 1.0, 0.02, "R", "F"), (2, 7, 5, 6, 3.0, 0.02, "N", "O")],
                          "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_quantity double, l_tax double, "
                          "l_returnflag string, l_linestatus string").withColumn(
        "l_shipdate", F.lit("1997-03-31").cast("timestamp_ntz")).write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.createDataFrame([(5, "Brand#11", "TIN", "name", 4)], "p_partkey long, p_brand string, p_type string, p_name string, p_size int"
                          ).write.parquet(f"{tmp_path}/part.parquet")
    spark.createDataFrame([(6, 24)], "s_suppkey long, s_nationkey int").write.parquet(f"{tmp_path}/supplier.parquet")
    raw = tpch.crimes_raw(spark, str(tmp_path))
    assert raw._jdf.queryExecution().optimizedPlan().collectLeaves().size() == 3
    got = sorted((r.id, r.case_number, r.updated_on, r.community_area, r.latitude, r.longitude) for r in raw.collect())
    assert got == sorted([
        ("11.0", "L11", "03/31/1997 12:00:00 AM", "99.0", None, None),
        ("11.0", "again 11", "03/30/1997 12:00:00 AM", "99.0", None, None),
        ("27.0", "L27", "03/31/1997 12:00:00 AM", "99.0", "0.0", "0.0"),
        ("27.0", "again 27", "04/01/1997 12:00:00 AM", "99.0", "0.0", "0.0")])
