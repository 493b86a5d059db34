import datetime as dt

from pyspark.sql import functions as F

from tessera.operators.dims import area_dim, date_dim, place_dim, representative, time_dim, type_dim
from tessera.operators.fact import build_fact, integrity, lookup_key
from tessera.operators.marts import group_corr, group_rate, top_k, widget_series, with_share


def test_time_dim_shifts(spark):
    rows = {r.hour: r.shift for r in time_dim(spark).collect()}
    assert len(rows) == 24
    assert rows[0] == rows[5] == "Madrugada" and rows[6] == rows[11] == "Manhã"
    assert rows[12] == rows[17] == "Tarde" and rows[18] == rows[23] == "Noite"
    assert dict(time_dim(spark).dtypes)["time_key"] == "int"


def test_date_dim_observed_days_only(spark):
    df = spark.createDataFrame([(dt.datetime(2016, 1, 1, 0, 0),), (dt.datetime(2016, 1, 1, 23, 0),),
                                (dt.datetime(2016, 1, 3, 5, 0),), (None,)], "ts timestamp_ntz")
    d = date_dim(df, "ts").orderBy("date").collect()
    assert [r.date_key for r in d] == [20160101, 20160103]


def test_representative_majority_and_tie(spark):
    df = spark.createDataFrame(
        [("0820", "THEFT"), ("0820", "THEFT"), ("0820", "DECEPTIVE"), ("0530", "ROBBERY"),
         ("0530", "ASSAULT"), (None, "X")], "iucr string, primary_type string")
    got = {r.iucr: r.primary_type for r in representative(df, "iucr", ["primary_type"]).collect()}
    assert got == {"0820": "THEFT", "0530": "ASSAULT"}


def test_type_dim_left_join_default_and_unknown(spark):
    occ = spark.createDataFrame([("0110", "H", "d", "01"), ("9999", "N", "d", "08")],
                                "iucr string, primary_type string, description string, fbi_code string")
    ref = spark.createDataFrame([("0110", "H", "M", True)],
                                "iucr string, iucr_primary_description string, "
                                "iucr_secondary_description string, is_index boolean")
    d = {r.iucr: r for r in type_dim(occ, ref, unknown={"crime_type_key": -1, "iucr": "XXXX",
                                                         "is_index": False}).collect()}
    assert d["0110"].crime_type_key == 1 and d["0110"].is_index is True
    assert d["9999"].crime_type_key == 2 and d["9999"].is_index is False
    assert d["XXXX"].crime_type_key == -1


def test_lookup_key_unknown_and_literal_label(spark):
    occ = spark.createDataFrame([("STREET",), (None,), ("DESCONHECIDO",), ("PARK",)], "loc string")
    dim = place_dim(occ.withColumnRenamed("loc", "location_description"),
                    unknown={"location_key": -1, "location_description": "DESCONHECIDO"})
    known = dim.where("location_key != -1")
    out = lookup_key(occ.withColumnRenamed("loc", "location_description"), known,
                     "location_description", "location_key")
    got = sorted((r.location_description, r.location_key) for r in out.collect()
                 if r.location_description)
    assert out.count() == 4  # no doubled fact
    assert got == [("DESCONHECIDO", 1), ("PARK", 2), ("STREET", 3)]
    assert [r.location_key for r in out.collect() if r.location_description is None] == [-1]


def test_area_dim_quartiles_and_membership(spark):
    socio = spark.createDataFrame([(i, f"A{i}", 1000 * i, 100 - i) for i in range(1, 10)],
                                  "community_area int, community_area_name string, "
                                  "per_capita_income int, hardship_index int")
    d = area_dim(socio, quartiles={"income_quartile": "per_capita_income"},
                 unknown={"community_area_key": -1})
    q = {r.community_area: r.income_quartile for r in d.collect()}
    assert q[1] == 1 and q[3] == 1 and q[4] == 2 and q[9] == 4 and q[None] is None


def test_group_rate_null_flag_counts_as_zero(spark):
    df = spark.createDataFrame([("a", True), ("a", False), ("a", None), ("b", True)],
                               "g string, is_arrest boolean")
    got = {r.g: (r.total, r.prisoes, r.taxa) for r in
           group_rate(df, ["g"], hits="prisoes", rate_name="taxa").collect()}
    assert got == {"a": (3, 1, 33.3), "b": (1, 1, 100.0)}


def test_share_top_k_corr_series(spark):
    df = spark.createDataFrame([("x", 30), ("y", 70)], "k string, total bigint")
    assert {r.k: r.pct for r in with_share(df, "total", "pct").collect()} == {"x": 30.0, "y": 70.0}
    assert [r.k for r in top_k(df, [F.desc("total"), "k"], 1).collect()] == ["y"]
    pts = spark.createDataFrame([(a, float(a)) for a in range(1, 6) for _ in range(a)],
                                "area int, inc double")
    r = group_corr(pts, "area", {"n": F.count(F.lit(1)), "inc": F.max("inc")},
                   {"c": ("n", "inc")}).first()
    assert r.c == 1.0
    flat = spark.createDataFrame([(1, 5.0), (2, 5.0)], "area int, inc double")
    assert group_corr(flat, "area", {"n": F.count(F.lit(1)), "inc": F.max("inc")},
                      {"c": ("n", "inc")}).first().c is None   # zero variance -> null
    m = spark.createDataFrame([("Non-index", 10, 1), ("Non-index", 30, 3)],
                              "tipo string, total bigint, prisoes bigint")
    s = widget_series(m, "tipo", "taxa", series="w", rate_of=("prisoes", "total")).first()
    assert s.y == 10.0


def test_build_fact_and_integrity(spark):
    occ = spark.createDataFrame(
        [(1, dt.datetime(2016, 5, 3, 23, 40), "0110", "STREET", 25, True, False),
         (2, dt.datetime(2016, 1, 1, 0, 0), None, None, 0, None, True)],
        "id long, occurred_at timestamp_ntz, iucr string, location_description string, "
        "community_area int, arrest boolean, domestic boolean")
    occ = occ.withColumns({"district": F.lit(1), "beat": F.lit(2), "ward": F.lit(3),
                           "latitude": F.lit(41.8), "longitude": F.lit(-87.7),
                           "primary_type": F.lit("H"), "description": F.lit("d"),
                           "fbi_code": F.lit("01")})
    t = type_dim(occ, None, unknown={"crime_type_key": -1, "iucr": "XXXX", "is_index": False})
    p = place_dim(occ, unknown={"location_key": -1, "location_description": "DESCONHECIDO"})
    socio = spark.createDataFrame([(25, "A", 100, 1)], "community_area int, community_area_name string, "
                                  "per_capita_income int, hardship_index int")
    a = area_dim(socio, unknown={"community_area_key": -1})
    f = build_fact(occ, type_dim=t, location_dim=p, area_dim=a)
    rows = {r.id: r for r in f.collect()}
    assert (rows[1].date_key, rows[1].time_key, rows[1].crime_type_key, rows[1].location_key,
            rows[1].community_area_key) == (20160503, 23, 1, 1, 25)
    assert (rows[2].crime_type_key, rows[2].location_key, rows[2].community_area_key) == (-1, -1, -1)
    chk = {r.check: (r.value, r.ok) for r in integrity(
        f, {"crime_type_key": (t, "crime_type_key"), "location_key": (p, "location_key")}).collect()}
    assert chk["grain_violations"] == (0.0, True) and chk["orphans_crime_type_key"] == (0.0, True)
