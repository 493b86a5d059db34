import datetime as dt

from pyspark.sql import functions as F

from tessera.functions import (clean_text, date_key, date_parts, flag, in_box, null_unless,
                               pad_code, to_double, to_int, to_long, to_ts, upper_flag)


def one_col(spark, values, fn, dtype="string"):
    df = spark.createDataFrame([(v,) for v in values], f"x {dtype}")
    return [r[0] for r in df.select(fn(F.col("x"))).collect()]


def test_to_long_accepts_integral_decimals_only(spark):
    got = one_col(spark, ["10", "10.0", "10.5", "abc", "", None, "-3", "007"], to_long)
    assert got == [10, 10, None, None, None, None, -3, 7]


def test_to_int_truncates_and_nulls_overflow(spark):
    got = one_col(spark, ["6.0", "6.7", "1e12", "x", None, "-2.9"], to_int)
    assert got == [6, 6, None, None, None, -2]


def test_to_double(spark):
    assert one_col(spark, ["41.8", "x", ""], to_double) == [41.8, None, None]


def test_to_ts_twelve_hour_clock_and_bad_input(spark):
    fmt = "MM/dd/yyyy hh:mm:ss a"
    got = one_col(spark, ["01/01/2016 12:00:00 AM", "05/03/2016 11:40:00 PM", "bad", None],
                  lambda c: to_ts(c, fmt).cast("timestamp_ntz"))
    assert got == [dt.datetime(2016, 1, 1, 0, 0), dt.datetime(2016, 5, 3, 23, 40), None, None]


def test_flag_is_exact_text_and_null_stays_null(spark):
    assert one_col(spark, ["True", "true", "False", None], flag) == [True, False, False, None]


def test_upper_flag(spark):
    assert one_col(spark, ["I", " i ", "N", None], lambda c: upper_flag(c, "I")) == \
        [True, True, False, None]


def test_trim_keeps_tabs(spark):
    assert one_col(spark, ["  a b  ", "\tx\t"], clean_text) == ["a b", "\tx\t"]


def test_pad_code_pads_short_keeps_long(spark):
    got = one_col(spark, ["110", " 0110 ", "041A", "12345", "", None], lambda c: pad_code(c, 4))
    assert got == ["0110", "0110", "041A", "12345", "0000", None]


def test_in_box_three_valued_and_edges(spark):
    box = ((41.60, 42.05), (-87.95, -87.50))
    rows = [(41.8, -87.7), (0.0, 0.0), (40.0, -87.7), (41.8, None), (None, None), (41.60, -87.95),
            (42.05, -87.50)]
    df = spark.createDataFrame(rows, "lat double, lon double")
    got = [r[0] for r in df.select(in_box("lat", "lon", box)).collect()]
    assert got == [True, False, False, False, False, True, True]
    nulled = df.select(null_unless("lat", in_box("lat", "lon", box))).collect()
    assert [r[0] for r in nulled] == [41.8, None, None, None, None, 41.60, 42.05]


def test_date_parts(spark):
    df = spark.createDataFrame([(dt.date(2016, 1, 3),), (dt.date(2017, 1, 18),)], "d date")
    r = df.select(date_key("d").alias("k"), *[v.alias(k) for k, v in date_parts("d").items()
                                              if k != "date_key"]).collect()
    assert r[0]["k"] == 20160103 and r[0]["day_of_week"] == "Sunday" and r[0]["is_weekend"]
    assert r[0]["month_name"] == "January" and r[0]["quarter"] == 1
    assert r[1]["k"] == 20170118 and r[1]["day_of_week"] == "Wednesday" and not r[1]["is_weekend"]


def test_size_for_sets_partitions(spark):
    from tessera.session import size_for
    old = spark.conf.get("spark.sql.shuffle.partitions")
    conf = size_for(spark, 100 * (1 << 40), 8000)
    assert int(conf["spark.sql.shuffle.partitions"]) == 409600
    small = size_for(spark, 1 << 20, 4)
    assert small["spark.sql.shuffle.partitions"] == "8"
    spark.conf.set("spark.sql.shuffle.partitions", old)
