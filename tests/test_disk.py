"""What a whole run leaves on disk: packed texts, removed shuffles, compressed landings and tables."""

import glob
import gzip
import time

import pytest
from pyspark.sql import functions as F

from tessera.operators import clean
from tessera.operators.packed import PACKED, pack_texts, unpack_texts
from tessera.plans import entry_queries, tpch
from tessera.session import local_path, scratch_path, shuffles_removed
from tessera.sources import catalog
from tessera.sources.files import read_raw_csv, read_split_csv, write_csv

KEY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
ODD = [None, "", "a", " a ", "\x01", "\x02", "\x020", "\x021", "\x022\x01", "\x023C3", "a\x01b\x02", "é\n\"x\",", "\x00"]


def odd_texts(spark):
    """Every pair of odd texts, one with bytes that are no valid UTF-8, with other columns between."""
    one = spark.createDataFrame([(t,) for t in ODD], "t string").unionByName(
        spark.sql("SELECT CAST(X'61FF01C3' AS STRING) AS t"))
    rows = one.crossJoin(one.withColumnRenamed("t", "u")).withColumn("id", F.expr("abs(hash(t, u)) % 40"))
    return rows.selectExpr("t AS a", "id", "u AS `b c`", "CAST(NULL AS STRING) AS d", "id % 3 = 0 AS e", "t || 'k' AS k")


def exact(df):
    """Rows with texts as their bytes."""
    return sorted(map(tuple, df.select(*[F.hex(f"`{c}`") if t == "string" else f"`{c}`" for c, t in df.dtypes]).collect()), key=str)


def test_packed_texts_come_back_as_they_were(spark):
    df = odd_texts(spark)
    for keep in ([], ["k"], ["id"]):
        packed = pack_texts(df, keep)
        assert [c for c, t in packed.dtypes if t == "string"] == [*(["k"] if keep == ["k"] else []), PACKED]
        back = unpack_texts(packed.repartition(3, *(keep or ["id"])), df, keep)
        assert back.dtypes == df.dtypes and exact(back) == exact(df)
    single = df.select("id", "a")
    assert pack_texts(single, []).columns == ["id", "a"] and unpack_texts(single, single, []).columns == ["id", "a"]


def test_dealt_rows_keep_their_texts(spark, monkeypatch):
    df = odd_texts(spark).checkpoint()
    for keys in (["id"], ["k"], ["a", "id"]):
        want = exact(clean.dedupe(df, keys))
        for small in (1 << 24, 0):
            monkeypatch.setattr(clean, "SMALL_BYTES", small)
            dealt = clean.dedupe(df, keys, parts=3)
            assert dealt.columns == df.columns and exact(dealt) == want
            assert "Exchange hashpartitioning(" in (plan := dealt._jdf.queryExecution().executedPlan().toString())
            assert plan.index("split(") < plan.index("Exchange hashpartitioning(") < plan.index("concat_ws(")


def shuffle_files(spark):
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {files.apply(i).getName() for i in range(files.size()) if files.apply(i).getName().startswith("shuffle_")}


def new_shuffles(spark, before):
    """Shuffle files that are there beside those of ``before``, after some time to remove them."""
    for _ in range(50):
        if shuffle_files(spark) <= before:
            break
        time.sleep(0.1)
    return shuffle_files(spark) - before


def test_shuffles_go_with_their_query(spark, tmp_path):
    def write(name):
        spark.range(1000).repartition(4, "id").groupBy("id").count().write.parquet(f"{tmp_path}/{name}")
    old, before = spark.conf.get(KEY, None), shuffle_files(spark)
    with shuffles_removed(spark):
        write("a")
        assert not new_shuffles(spark, before)
        twice = spark.range(100).repartition(4, "id").groupBy("id").count()
        assert len(twice.collect()) == len(twice.collect()) == 100  # computed anew
    assert spark.conf.get(KEY, None) == old
    with pytest.raises(ValueError), shuffles_removed(spark):
        raise ValueError
    assert spark.conf.get(KEY, None) == old


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """The tables that the run lands, of a few rows."""
    d = str(tmp_path_factory.mktemp("tables"))
    made = {
        "lineitem": "id DIV 3 AS l_orderkey, id % 40 AS l_partkey, id % 7 AS l_suppkey, INT(id % 3 + 1) AS l_linenumber, "
                    "DOUBLE(id % 5) AS l_quantity, 9D AS l_extendedprice, 0.1D AS l_discount, 0.01D AS l_tax, "
                    "IF(id % 2 = 0, 'R', 'N') AS l_returnflag, 'F' AS l_linestatus, "
                    "TIMESTAMP_NTZ '1996-03-01 00:00:00' + MAKE_INTERVAL(0, 0, 0, INT(id)) AS l_shipdate FROM range(600)",
        "part": "id AS p_partkey, concat('Brand#', 11 + id % 4) AS p_brand, 'TIN' AS p_type, concat('name ', id % 6) AS p_name, "
                "INT(id % 50) AS p_size, 1D AS p_retailprice FROM range(40)",
        "supplier": "id AS s_suppkey, 's' AS s_name, INT(id % 4) AS s_nationkey, 1D AS s_acctbal FROM range(7)",
        "customer": "id AS c_custkey, 'c' AS c_name, INT(id % 4) AS c_nationkey, DOUBLE(id - 5) AS c_acctbal, "
                    "'HOUSEHOLD' AS c_mktsegment FROM range(20)",
        "nation": "INT(id) AS n_nationkey, concat('N', id) AS n_name, 0 AS n_regionkey FROM range(4)"}
    for name, what in made.items():
        spark.sql(f"SELECT {what}").coalesce(1).write.parquet(f"{d}/{name}.parquet")
    return d


def test_the_run_lands_and_stores_compressed(spark, tables, monkeypatch):
    seen, left = {}, set()

    def path(session, name):
        seen[name] = scratch_path(session, name)
        return seen[name]

    def build(*args, made=entry_queries.C.build, **kw):
        made(*args, **kw)
        left.update(new_shuffles(spark, before))
    monkeypatch.setattr(entry_queries, "scratch_path", path)
    monkeypatch.setattr(entry_queries.C, "build", build)
    before = shuffle_files(spark)
    rows = {r.tabela: r.linhas for r in entry_queries.QUERIES["build_run"](spark, tables).collect()}
    assert rows["bronze.crimes"] == 1200 and rows["gold.fact_crime"] > 0
    assert not left  # every step's shuffle has gone
    top = local_path(seen["build"])
    landed = glob.glob(f"{top}/landing/crimes/part-*")
    assert landed and all(f.endswith(".csv.gz") for f in landed)
    assert sum(gzip.open(f, "rt").read().count("\n") - 1 for f in landed) == 1200
    stored = glob.glob(f"{top}/*/**/part-*.parquet", recursive=True)
    assert stored and all(".zstd." in f for f in stored)


def test_compressed_files_are_read_back(spark, tmp_path):
    df = spark.createDataFrame([("1", "two\nlines, \"q\""), ("2", None), ("3", " x ")], "a string, b string").repartition(2, "a")
    plain = write_csv(df, f"{tmp_path}/plain")
    packed = write_csv(df, f"{tmp_path}/packed", compression="gzip")
    assert glob.glob(f"{packed}/*.csv.gz") and not glob.glob(f"{plain}/*.gz")
    want = exact(df)
    for read in (read_raw_csv, read_split_csv):
        assert exact(read(spark, packed)) == exact(read(spark, plain)) == want


def test_a_table_of_another_format_has_its_own_codec(spark):
    name = catalog.save(spark.range(3), "default.as_json", fmt="json")
    assert all(f.endswith(".json") for f in spark.table(name).inputFiles())


def test_landed_items_are_shuffled_once(spark, tables):
    """For the parts, when neither parts nor suppliers are broadcast by Spark itself."""
    key = "spark.sql.autoBroadcastJoinThreshold"
    old = spark.conf.get(key)
    spark.conf.set(key, "-1")
    try:
        plan = tpch.crimes_raw(spark, tables)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set(key, old)
    assert plan.count("Exchange hashpartitioning(") == 2 and plan.count("BroadcastExchange") == 1
