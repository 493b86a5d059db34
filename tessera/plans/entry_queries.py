"""Registry of the queries checked against the SQL oracle (see ``__spark_entry__``).

Each entry reads the driver tables under ``sf_dir``; the SQL twin re-derives the same
result in DuckDB from the same tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.functions import (clean_text, flag, in_box, null_unless, pad_code, to_double, to_int,
                               to_long, to_ts, upper_flag)
from tessera.operators import increment as IN
from tessera.operators import quality as QL
from tessera.operators import sketches as SK
from tessera.operators.clean import audit, drop_index_column, drop_rows, null_columns, survivors_of
from tessera.operators.dims import place_dim, type_dim
from tessera.operators.fact import build_fact, integrity, measured
from tessera.operators.keys import with_ntiles, with_surrogate_key
from tessera.operators.marts import preview, star_join
from tessera.plans import crimes as C
from tessera.plans import questions as Q
from tessera.plans import tpch
from tessera.plans import tpch_sql as S
from tessera.sources.catalog import data_dictionary, ensure_layers, list_tables, save, save_partitions, table_comment
from tessera.sources.files import malformed, normalize_columns, read_raw_csv, read_split_csv, stamp, write_csv
from tessera.session import scratch_path, shuffles_removed

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

# The line-item star's last year (shipments until late 2001) is partial.
LINE_PARTIAL_YEAR = 2001


def register(name: str, sql: str | None):
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            tpch.prepare(spark)  # UTC session zone, shared checkpoint folder
            return fn(spark, sf_dir)
        run.__name__ = run.__qualname__ = f"query_{name}"
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def line(spark, d):
    return tpch.line_star(spark, d)


def event(spark, d):
    return tpch.event_star(spark, d)


# ---- business questions ----------------------------------------------------------------

PCT, HITS = f"{S.RATE} AS taxa_prisao_pct", f"{S.HITS} AS prisoes"
KNOWN = "WHERE community_area_key > 0"


def _question(name: str, oracle: str, star, question) -> None:
    """A question over a star, with its statement."""
    @register(name, oracle)
    def run(spark, d):
        return question(star(spark, d))


_question("bq1", S.line(S.by("primary_type", HITS, PCT, tail="ORDER BY total DESC, primary_type LIMIT 20")), line, Q.bq1)
_question("bq2", S.line(S.by("is_domestic", PCT)), line, Q.bq2)
_question("bq3a", S.event(S.by("shift", PCT)), event, Q.bq3a)
_question("bq3b", S.event(S.by("day_of_week", PCT)), event, Q.bq3b)
_question("bq3c", S.event(S.by("time_key AS hour", PCT)), event, Q.bq3c)
_question("bq4a", S.line(S.by("year", PCT)), line, Q.bq4a)
_question("bq4b", S.line(S.by("month, month_name")), line, Q.bq4b)
_question("bq5", S.line(S.by("community_area, community_area_name", where=KNOWN,
                             tail="ORDER BY total DESC, community_area LIMIT 15")), line, Q.bq5)
_question("bq6a", S.line("SELECT total AS total_crimes, * EXCLUDE (total) FROM (" + S.by(
    "hardship_quartile", "round(avg(per_capita_income)) AS renda_media", PCT, where=KNOWN) + ")"), line, Q.bq6a)


def _pearson(x: str, y: str) -> str:
    """Correlation from its sums; null where a side does not vary."""
    cov = f"avg({x} * {y}) - avg({x}) * avg({y})"
    return f"round(CASE WHEN var_pop({x}) * var_pop({y}) > 0 THEN ({cov}) / sqrt(var_pop({x}) * var_pop({y})) END, 3)"


_question("bq6b", S.line("SELECT " + ", ".join(
    f"{_pearson('total', c)} AS corr_crimes_{name}" for c, name in
    (("income", "renda"), ("hardship", "hardship"), ("poverty", "pobreza"))) + " FROM (" + S.by(
        "community_area", "any_value(per_capita_income)::DOUBLE AS income", "any_value(hardship_index)::DOUBLE AS hardship",
        "any_value(pct_below_poverty) AS poverty", where=KNOWN) + ")"), line, Q.bq6b)
_question("bq7", S.line(S.by(
    "is_index", "round(100.0 * count(*) / (SELECT count(*) FROM fact), 1) AS pct_do_total", PCT)), line, Q.bq7)


def _extremes(by: str, least: int, k: int) -> str:
    rank = "row_number() OVER (ORDER BY taxa_prisao_pct {0}, total DESC, {1})::INTEGER"
    sides = " UNION ALL ".join(
        f"SELECT '{side}' AS lado, {rank.format(way, by)} AS posicao, * FROM g QUALIFY posicao <= {k}"
        for side, way in (("top", "DESC"), ("bottom", "ASC")))
    return f", g AS ({S.by(by, PCT, tail=f'HAVING count(*) >= {least}')}) {sides}"


_question("rate_extremes", S.line(_extremes("primary_type", 500, 3)), line, Q.rate_extremes)


@register("rate_extremes_places", S.line(_extremes("location_description", 120, 3)))
def _rate_extremes_places(spark, d):
    """The same over places: more groups, some of them too small."""
    s = line(spark, d)
    return Q.extremes(star_join(s.fact, s.dim_location, "location_key"), "location_description", 120, 3)


@register("top_places", S.line(S.by("location_description", HITS, PCT,
                                    tail="ORDER BY total DESC, location_description LIMIT 20")))
def _top_places(spark, d):
    s = line(spark, d)
    return Q.most_frequent(star_join(s.fact, s.dim_location, "location_key"), "location_description", 20)


# ---- dashboard marts --------------------------------------------------------------------

_SHARE = f"{S.RATE} AS taxa_prisao"
MARTS = {
    "mart_bq1": S.by("primary_type", HITS, _SHARE, tail="ORDER BY total DESC, primary_type LIMIT 10"),
    "mart_bq2": S.by("if(is_domestic, 'Domestico', 'Nao domestico') AS tipo", HITS, _SHARE),
    "mart_bq3": S.by("shift AS turno", HITS, _SHARE),
    "mart_bq4": S.by("year", HITS, _SHARE, where=f"WHERE year < {LINE_PARTIAL_YEAR}"),
    "mart_bq5": S.by("community_area_name AS bairro", where=KNOWN, tail="ORDER BY total DESC, bairro LIMIT 10"),
    "mart_bq6": S.by("hardship_quartile AS quartil", HITS, _SHARE, where=KNOWN),
    "mart_bq7": S.by("if(is_index, 'Index (graves)', 'Non-index') AS tipo", HITS, _SHARE),
}
_MART_OF = {"mart_bq1": Q.mart_bq1, "mart_bq2": Q.mart_bq2, "mart_bq3": Q.mart_bq3,
            "mart_bq4": lambda s: Q.mart_bq4(s, before_year=LINE_PARTIAL_YEAR), "mart_bq5": Q.mart_bq5,
            "mart_bq6": Q.mart_bq6, "mart_bq7": Q.mart_bq7}
for _name, _sql in MARTS.items():
    _timed = _name == "mart_bq3"
    _question(_name, (S.event if _timed else S.line)(_sql), event if _timed else line, _MART_OF[_name])


def _series(series: str, mart: str, x: str, rate: bool) -> str:
    y = "round(100.0 * sum(prisoes) / sum(total), 1)" if rate else "sum(total)::DOUBLE"
    star = S.event if mart == "mart_bq3" else S.line
    return f"SELECT '{series}' AS series, {x}::VARCHAR AS x, {y} AS y FROM ({star(MARTS[mart])}) GROUP BY {x}"


@register("widget_series", " UNION ALL ".join(f"({_series(*w)})" for w in (
    ("w1", "mart_bq1", "primary_type", False), ("w1b", "mart_bq1", "primary_type", True), ("w4", "mart_bq4", "year", False),
    ("w5", "mart_bq5", "bairro", False), ("w6", "mart_bq6", "quartil", True), ("w7", "mart_bq7", "tipo", True),
    ("w2", "mart_bq2", "tipo", True), ("w3", "mart_bq3", "turno", True))))
def _widgets(spark, d):
    marts = Q.marts(line(spark, d), event(spark, d), before_year=LINE_PARTIAL_YEAR)
    return Q.widget_all({n: m.checkpoint() for n, m in marts.items()})


# ---- dimensions, keys, fact --------------------------------------------------------------

@register("dim_date", S.line("\nSELECT * FROM dim_date"))
def _dim_date(spark, d):
    return line(spark, d).dim_date


@register("dim_time", S.event(""", seen AS (SELECT time_key, count(*) AS n FROM fact GROUP BY ALL)
SELECT time_key, hour, shift, coalesce(n, 0) AS total FROM dim_time LEFT JOIN seen USING (time_key)"""))
def _dim_time(spark, d):
    """The hours with their shift and the facts observed in each."""
    s = event(spark, d)
    seen = s.fact.groupBy("time_key").agg(F.count(F.lit(1)).alias("total"))
    return s.dim_time.join(seen, "time_key", "left").na.fill(0, ["total"])


@register("representative", S.line("\nSELECT * FROM code_texts"))
def _rep(spark, d):
    return tpch.line_representative(spark, d)


@register("dim_type", S.line("\nSELECT * FROM dim_type"))
def _dim_type(spark, d):
    return line(spark, d).dim_type


@register("dim_location", S.line("\nSELECT * FROM dim_location"))
def _dim_location(spark, d):
    return line(spark, d).dim_location


@register("surrogate_key", """
SELECT CAST(row_number() OVER (ORDER BY c_name NULLS FIRST) AS INTEGER) AS name_key, c_name
FROM (SELECT DISTINCT c_name FROM customer)""")
def _surrogate_key(spark, d):
    names = tpch.table(spark, d, "customer").select("c_name").distinct()
    return with_surrogate_key(names, ["c_name"], "name_key").select("name_key", "c_name")


@register("surrogate_key_orders", """
SELECT dense_rank() OVER (ORDER BY l_orderkey)::BIGINT AS order_number, l_orderkey, count(*) AS lines
FROM lineitem GROUP BY l_orderkey""")
def _surrogate_key_orders(spark, d):
    """A key of as many members as there are orders."""
    orders = tpch.table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("lines"))
    return with_surrogate_key(orders, ["l_orderkey"], "order_number", key_type="long")


@register("ntile_customers", """
SELECT c_custkey, ntile(10) OVER (ORDER BY c_acctbal NULLS FIRST, c_custkey)::INTEGER AS decile,
       ntile(7) OVER (ORDER BY c_mktsegment NULLS FIRST, c_custkey)::INTEGER AS seventh FROM customer""")
def _ntile_customers(spark, d):
    c = tpch.table(spark, d, "customer")
    tiled = with_ntiles(c, {"decile": (10, ["c_acctbal", "c_custkey"]), "seventh": (7, ["c_mktsegment", "c_custkey"])})
    return tiled.select("c_custkey", "decile", "seventh")


@register("unknown_member", S.line("""
SELECT 'dim_crime_type' AS dimensao, crime_type_key AS chave, iucr AS rotulo, (SELECT count(*) FROM fact WHERE crime_type_key = -1) AS fatos
FROM dim_type WHERE crime_type_key = -1
UNION ALL SELECT 'dim_location', location_key, location_description, (SELECT count(*) FROM fact WHERE location_key = -1)
FROM dim_location WHERE location_key = -1
UNION ALL SELECT 'dim_community_area', community_area_key, community_area_name, (SELECT count(*) FROM fact WHERE community_area_key = -1)
FROM dim_area WHERE community_area_key = -1"""))
def _unknown(spark, d):
    """The unknown members and the facts that each holds, counted in one scan of the fact."""
    s = line(spark, d)
    dims = {"dim_crime_type": (s.dim_type, "crime_type_key", "iucr"),
            "dim_location": (s.dim_location, "location_key", "location_description"),
            "dim_community_area": (s.dim_area, "community_area_key", "community_area_name")}
    held = s.fact.agg(*[F.count_if(F.col(key) == -1).alias(n) for n, (_, key, _) in dims.items()])
    held = held.selectExpr("stack(3, " + ", ".join(f"'{n}', {n}" for n in dims) + ") AS (dimensao, fatos)")
    members = None
    for n, (dim, key, text) in dims.items():
        one = dim.where(F.col(key) == -1).select(F.lit(n).alias("dimensao"), F.col(key).alias("chave"), F.col(text).alias("rotulo"))
        members = one if members is None else members.unionByName(one)
    return members.join(held, "dimensao")


@register("quartiles", S.line("\nSELECT * FROM dim_area"))
def _quartiles(spark, d):
    return line(spark, d).dim_area


@register("rollup_row_guard", S.line("\nSELECT * FROM areas"))
def _rollup_guard(spark, d):
    return tpch.clean_indicators(tpch.indicators_raw(spark, d))


@register("fact_build", S.line("\nSELECT * FROM fact"))
def _fact(spark, d):
    return line(spark, d).fact


# Dimensions of an earlier load: later days, shifts, codes, areas and places are not in them.
STALE = {"date_key": ("dim_date", "date_key", "year < 2000"), "time_key": ("dim_time", "time_key", "hour > 0"),
         "crime_type_key": ("dim_type", "crime_type_key", "is_index"),
         "community_area_key": ("dim_area", "community_area_key", "community_area_key <> 7"),
         "location_key": ("dim_location", "location_key", "location_key <> -1")}


def _integrity_sql(dims: dict) -> str:
    heads = {"fact_rows": ("count(*)", "true"), "distinct_grain": ("count(DISTINCT id)", "true"),
             "grain_violations": ("count(*) - count(DISTINCT id)", "count(*) = count(DISTINCT id)"),
             "is_arrest_pct": ("round(100 * (count(*) FILTER (is_arrest) / count(*)), 2)", "true")}
    parts = [f"""SELECT '{n}' AS "check", ({v})::DOUBLE AS value, {ok} AS ok FROM fact""" for n, (v, ok) in heads.items()]
    parts += [f"SELECT 'orphans_{col}', count(*)::DOUBLE, count(*) = 0 FROM (FROM fact ANTI JOIN (FROM {dim} WHERE {cond}) USING ({key}))"
              for col, (dim, key, cond) in dims.items()]
    return "\n" + "\nUNION ALL ".join(parts)


def _fks(s, stale: bool) -> dict:
    dims = {"dim_date": s.dim_date, "dim_time": s.dim_time, "dim_type": s.dim_type, "dim_area": s.dim_area,
            "dim_location": s.dim_location}
    return {col: (dims[dim].where(cond) if stale else dims[dim], key) for col, (dim, key, cond) in STALE.items()}


@register("star_integrity", S.line(_integrity_sql({c: (d, k, "true") for c, (d, k, _) in STALE.items()})))
def _integrity(spark, d):
    s = line(spark, d)
    return integrity(s.fact, _fks(s, stale=False))


@register("star_integrity_stale", S.line(_integrity_sql(STALE)))
def _integrity_stale(spark, d):
    """The same checks against dimensions of an earlier load: every orphan count is above 0."""
    s = line(spark, d)
    return integrity(s.fact, _fks(s, stale=True))


@register("orphans", S.line("""
SELECT 'iucr' AS chave, count(DISTINCT o.iucr) AS distintos, count(DISTINCT o.iucr) FILTER (c.iucr IS NULL) AS sem_match
FROM occ o LEFT JOIN code_list c USING (iucr)
UNION ALL
SELECT 'community_area', count(DISTINCT o.community_area), count(DISTINCT o.community_area) FILTER (a.community_area IS NULL)
FROM occ o LEFT JOIN areas a USING (community_area)"""))
def _orphans(spark, d):
    occ = tpch.silver_lines(spark, d)
    ref = C.clean_iucr(tpch.codes_raw(spark, d))
    socio = tpch.clean_indicators(tpch.indicators_raw(spark, d))
    return QL.coverage(occ, ref, "iucr").unionByName(QL.coverage(occ, socio, "community_area"))


# ---- cleaning ------------------------------------------------------------------------------

@register("dedupe", "WITH" + S.LINES + "\nSELECT * FROM line_once")
def _dedupe(spark, d):
    return tpch.dedupe_lineitem(spark, d)


@register("dup_keys", """
SELECT CAST(SUM(c) AS BIGINT) AS linhas, COUNT(*) AS chaves,
       COUNT(*) FILTER (WHERE c > 1) AS chaves_repetidas, CAST(SUM(c - 1) AS BIGINT) AS linhas_extras
FROM (SELECT l_orderkey, l_linenumber, COUNT(*) AS c FROM lineitem GROUP BY l_orderkey, l_linenumber)""")
def _dup_keys(spark, d):
    return QL.duplicate_keys(tpch.table(spark, d, "lineitem"), tpch.LINE_KEYS)


@register("try_cast_num", """
SELECT l_orderkey, l_linenumber, raw,
  CASE WHEN regexp_matches(raw, '^ *[+-]?[0-9]+(\\.0*)? *$')
       THEN try_cast(split_part(trim(raw), '.', 1) AS BIGINT) END AS as_long,
  try_cast(trunc(try_cast(raw AS DOUBLE)) AS INTEGER) AS as_int,
  try_cast(raw AS DOUBLE) AS as_double
FROM (SELECT l_orderkey, l_linenumber,
        CASE WHEN l_orderkey % 7 = 0 THEN CAST(l_quantity AS VARCHAR) || 'x'
             WHEN l_orderkey % 7 = 1 THEN CAST(l_extendedprice AS VARCHAR)
             ELSE CAST(l_quantity AS VARCHAR) END AS raw FROM lineitem)""")
def _try_cast(spark, d):
    li = tpch.table(spark, d, "lineitem")
    k = F.col("l_orderkey") % 7
    raw = (F.when(k == 0, F.concat(F.col("l_quantity").cast("string"), F.lit("x")))
           .when(k == 1, F.col("l_extendedprice").cast("string"))
           .otherwise(F.col("l_quantity").cast("string")))
    return (li.select("l_orderkey", "l_linenumber", raw.alias("raw"))
            .select("l_orderkey", "l_linenumber", "raw", to_long("raw").alias("as_long"),
                    to_int("raw").alias("as_int"), to_double("raw").alias("as_double")))


@register("parse_timestamp", f"""
SELECT event_id, raw, try_strptime(raw, '{S.TS_FMT}') AS parsed
FROM (SELECT event_id, CASE WHEN event_id % 11 = 0 THEN 'x' || strftime(ts, '{S.TS_FMT}')
                            ELSE strftime(ts, '{S.TS_FMT}') END AS raw FROM events)""")
def _parse_ts(spark, d):
    e = tpch.table(spark, d, "events")
    fmt = F.date_format("ts", tpch.TS_FMT)
    raw = F.when(F.col("event_id") % 11 == 0, F.concat(F.lit("x"), fmt)).otherwise(fmt)
    return (e.select("event_id", raw.alias("raw"))
            .select("event_id", "raw", to_ts("raw", tpch.TS_FMT).cast("timestamp_ntz").alias("parsed")))


@register("trim_pad_upper", """
SELECT p_partkey, raw_code,
       CASE WHEN length(trim(raw_code)) < 4 THEN lpad(trim(raw_code), 4, '0') ELSE trim(raw_code) END AS code,
       raw_flag, upper(trim(raw_flag)) = 'I' AS is_index, trim(raw_text) AS text
FROM (SELECT p_partkey,
        CASE WHEN p_partkey % 3 = 0 THEN ' ' || CAST(p_size AS VARCHAR) || ' ' ELSE CAST(p_partkey AS VARCHAR) END AS raw_code,
        CASE WHEN p_size > 25 THEN ' i ' WHEN p_size > 5 THEN 'n' END AS raw_flag,
        '  ' || p_type || ' ' AS raw_text FROM part)""")
def _trim_pad(spark, d):
    p = tpch.table(spark, d, "part")
    raw_code = (F.when(F.col("p_partkey") % 3 == 0,
                       F.concat(F.lit(" "), F.col("p_size").cast("string"), F.lit(" ")))
                .otherwise(F.col("p_partkey").cast("string")))
    raw_flag = F.when(F.col("p_size") > 25, F.lit(" i ")).when(F.col("p_size") > 5, F.lit("n"))
    raw_text = F.concat(F.lit("  "), F.col("p_type"), F.lit(" "))
    return (p.select("p_partkey", raw_code.alias("raw_code"), raw_flag.alias("raw_flag"),
                     raw_text.alias("raw_text"))
            .select("p_partkey", "raw_code", pad_code("raw_code", 4).alias("code"), "raw_flag",
                    upper_flag("raw_flag", "I").alias("is_index"), clean_text("raw_text").alias("text")))


@register("bool_flag", """
SELECT raw, raw = 'True' AS arrest, COUNT(*) AS linhas
FROM (SELECT CASE l_returnflag WHEN 'R' THEN 'True' WHEN 'A' THEN 'true' END AS raw FROM lineitem)
GROUP BY raw""")
def _bool_flag(spark, d):
    li = tpch.table(spark, d, "lineitem")
    raw = F.when(F.col("l_returnflag") == "R", "True").when(F.col("l_returnflag") == "A", "true")
    return (li.select(raw.alias("raw")).withColumn("arrest", flag("raw", "True"))
            .groupBy("raw", "arrest").agg(F.count(F.lit(1)).alias("linhas")))


BOX = ((41.60, 42.05), (-87.95, -87.50))


@register("null_invalid", """
SELECT event_id,
       CASE WHEN ok THEN lat END AS latitude, CASE WHEN ok THEN lon END AS longitude, ok AS coord_valid
FROM (SELECT event_id, lat, lon,
        coalesce(lat BETWEEN 41.60 AND 42.05 AND lon BETWEEN -87.95 AND -87.50
                 AND NOT (lat = 0 AND lon = 0), false) AS ok
      FROM (SELECT event_id,
              CASE WHEN event_id % 13 = 0 THEN 0.0 ELSE 41.55 + value / 1000 END AS lat,
              CASE WHEN event_id % 13 = 0 THEN 0.0 WHEN event_id % 17 = 0 THEN NULL
                   ELSE -87.45 - value / 1000 END AS lon FROM events))""")
def _null_invalid(spark, d):
    e = tpch.table(spark, d, "events")
    k = F.col("event_id")
    lat = F.when(k % 13 == 0, F.lit(0.0)).otherwise(F.lit(41.55) + F.col("value") / 1000)
    lon = (F.when(k % 13 == 0, F.lit(0.0)).when(k % 17 == 0, F.lit(None).cast("double"))
           .otherwise(F.lit(-87.45) - F.col("value") / 1000))
    c = e.select("event_id", lat.alias("lat"), lon.alias("lon"))
    ok = in_box("lat", "lon", BOX)
    return c.select("event_id", null_unless("lat", ok).alias("latitude"),
                    null_unless("lon", ok).alias("longitude"), ok.alias("coord_valid"))


ORDERS_RAW = f"""
raw AS (
  SELECT CASE WHEN o_orderkey % 101 = 0 THEN CAST(o_orderkey AS VARCHAR) || 'x'
              ELSE CAST(o_orderkey AS VARCHAR) || '.0' END AS id,
         CASE WHEN o_orderkey % 89 = 0 THEN 'bad' ELSE strftime(o_orderdate, '{S.TS_FMT}') END AS date,
         CAST(year(o_orderdate) AS VARCHAR) || '.0' AS year,
         o_orderstatus AS status, strftime(o_orderdate, '{S.TS_FMT}') AS updated_on
  FROM orders
  UNION ALL
  SELECT CASE WHEN o_orderkey % 101 = 0 THEN CAST(o_orderkey AS VARCHAR) || 'x'
              ELSE CAST(o_orderkey AS VARCHAR) || '.0' END,
         CASE WHEN o_orderkey % 89 = 0 THEN 'bad' ELSE strftime(o_orderdate, '{S.TS_FMT}') END,
         CAST(year(o_orderdate) AS VARCHAR) || '.0', 'X',
         strftime(o_orderdate + (CASE WHEN o_orderkey % 2 = 0 THEN 1 ELSE -1 END) * INTERVAL 1 DAY,
                  '{S.TS_FMT}')
  FROM orders),
typed AS (
  SELECT CASE WHEN regexp_matches(id, '^ *[+-]?[0-9]+(\\.0*)? *$')
              THEN try_cast(split_part(trim(id), '.', 1) AS BIGINT) END AS id,
         try_strptime(date, '{S.TS_FMT}') AS occurred_at,
         try_cast(trunc(try_cast(year AS DOUBLE)) AS INTEGER) AS year, status,
         try_strptime(updated_on, '{S.TS_FMT}') AS updated_at
  FROM raw),
surv AS (
  SELECT id, occurred_at, year, status, updated_at FROM (
    SELECT *, row_number() OVER (PARTITION BY id ORDER BY updated_at DESC NULLS LAST,
        occurred_at NULLS FIRST, year NULLS FIRST, status NULLS FIRST, updated_at NULLS FIRST) AS rn
    FROM typed WHERE id IS NOT NULL) WHERE rn = 1)"""


@register("clean_window", "WITH" + ORDERS_RAW + """
SELECT * FROM surv WHERE occurred_at IS NOT NULL AND year BETWEEN 1996 AND 2000""")
def _clean_window(spark, d):
    return tpch.clean_orders(spark, d)


@register("clean_audit", "WITH" + ORDERS_RAW + """,
c AS (SELECT (SELECT COUNT(*) FROM typed) AS n,
             (SELECT COUNT(*) FROM typed WHERE id IS NULL) AS r1,
             (SELECT COUNT(DISTINCT id) FROM typed) AS k,
             (SELECT COUNT(*) FROM surv WHERE occurred_at IS NULL) AS r3,
             (SELECT COUNT(*) FROM surv WHERE occurred_at IS NOT NULL
                AND NOT coalesce(year BETWEEN 1996 AND 2000, false)) AS r4)
SELECT 'orders' AS "table", 0 AS step_order, 'input' AS step, CAST(NULL AS BIGINT) AS before,
       CAST(0 AS BIGINT) AS removed, n AS after, CAST(NULL AS BIGINT) AS flagged FROM c
UNION ALL SELECT 'orders', 1, 'id nulo ou malformado', n, r1, n - r1, NULL FROM c
UNION ALL SELECT 'orders', 2, 'duplicidade de id', n - r1, n - r1 - k, k, NULL FROM c
UNION ALL SELECT 'orders', 3, 'data nula ou malformada', k, r3, k - r3, NULL FROM c
UNION ALL SELECT 'orders', 4, 'ano fora de 1996-2000', k - r3, r4, k - r3 - r4, NULL FROM c""")
def _clean_audit(spark, d):
    return audit(tpch.orders_typed(tpch.orders_raw(spark, d)), tpch.orders_clean_spec())


# ---- the crime preset over landed text -------------------------------------------------------

_YEARS = tpch.CRIMES_YEARS
_CFG = C.Config(year_window=_YEARS)
CRIMES = f"""
twice AS (SELECT *, unnest([false, true]) AS again FROM lineitem),
landed AS (
  SELECT CASE WHEN l_partkey % 97 <> 0 THEN 10 * l_orderkey + l_linenumber END AS id,
         concat(if(again, 'again ', 'L'), 10 * l_orderkey + l_linenumber) AS case_number,
         CASE WHEN l_suppkey % 89 <> 0 THEN l_shipdate END AS occurred_at, concat(l_returnflag, '-', l_linestatus) AS block,
         CASE WHEN p_size <> 1 THEN lpad(substr(p_brand, 7), 4, '0') END AS iucr, p_type AS primary_type,
         lower(p_type) AS description, {S.PLACE} AS location_description,
         CASE l_returnflag WHEN 'R' THEN true WHEN 'N' THEN false END AS arrest, l_linestatus = 'F' AS domestic,
         l_suppkey::INTEGER AS beat, s_nationkey AS district, l_linenumber AS ward,
         if(s_nationkey = 24, 99, s_nationkey) AS community_area, substr(p_brand, 7) AS fbi_code, year(l_shipdate)::INTEGER AS year,
         CASE WHEN l_linenumber = 7 THEN 0.0::DOUBLE WHEN l_quantity <> 1 THEN 41.55::DOUBLE + l_tax * 8 END AS latitude,
         CASE WHEN l_linenumber = 7 THEN 0.0::DOUBLE WHEN l_quantity <> 1 THEN (-87.7)::DOUBLE END AS longitude,
         l_shipdate + to_days(CASE WHEN NOT again THEN 0 WHEN l_orderkey % 2 = 0 THEN 1 ELSE -1 END) AS updated
  FROM twice, part, supplier WHERE l_partkey = p_partkey AND l_suppkey = s_suppkey),
last_of AS (
  SELECT * FROM landed WHERE id IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY id ORDER BY updated DESC, case_number, occurred_at NULLS FIRST, block,
    iucr NULLS FIRST, primary_type, description, location_description NULLS FIRST, arrest NULLS FIRST, domestic, beat,
    district, ward, community_area, fbi_code, year, latitude NULLS FIRST, longitude NULLS FIRST) = 1),
kept AS (FROM last_of WHERE occurred_at IS NOT NULL AND year BETWEEN {_YEARS[0]} AND {_YEARS[1]}),
boxed AS (SELECT *, coalesce(latitude BETWEEN 41.60 AND 42.05 AND longitude BETWEEN -87.95 AND -87.50, false) AS inside FROM kept)"""


@register("clean_crimes", "WITH" + CRIMES + """
SELECT * EXCLUDE (updated, inside) REPLACE (if(inside, latitude, NULL) AS latitude, if(inside, longitude, NULL) AS longitude)
FROM boxed""")
def _clean_crimes(spark, d):
    out = C.clean_crimes(tpch.crimes_raw(spark, d), _CFG)
    return out.withColumn("occurred_at", F.col("occurred_at").cast("timestamp_ntz"))


def _audit_sql(table: str, counts: list[tuple[str, str, str]], start: str) -> str:
    """Audit rows from the number of rows left after each step (``flag``: rows changed)."""
    values = ", ".join(f"({i}, '{step}', {'NULL' if kind == 'flag' else n}, {n if kind == 'flag' else 'NULL'})"
                       for i, (step, kind, n) in enumerate(counts, 1))
    return f"""(SELECT '{table}' AS "table", step_order::INTEGER AS step_order, step,
  CASE WHEN step_order > 0 THEN lag(left_over, 1, left_over) OVER (ORDER BY step_order) END AS before,
  (lag(left_over, 1, left_over) OVER (ORDER BY step_order) - left_over)::BIGINT AS removed, left_over AS after, flagged
  FROM (SELECT step_order, step, flagged, last_value(n IGNORE NULLS) OVER (ORDER BY step_order) AS left_over
        FROM (VALUES (0, 'input', {start}, NULL::BIGINT), {values}) t(step_order, step, n, flagged)))"""


_CRIMES_AUDIT = "SELECT * FROM " + _audit_sql("crimes", [
    ("id nulo ou malformado", "", "(SELECT count(id) FROM landed)"),
    ("duplicidade de id", "", "(SELECT count(DISTINCT id) FROM landed)"),
    ("data nula ou malformada", "", "(SELECT count(occurred_at) FROM last_of)"),
    (f"ano fora de {_YEARS[0]}-{_YEARS[1]}", "", "(SELECT count(*) FROM kept)"),
    ("coordenadas ausentes", "flag", "(SELECT count(*) FILTER (latitude IS NULL OR longitude IS NULL) FROM boxed)"),
    ("coordenadas (0,0)", "flag", "(SELECT count(*) FILTER (latitude = 0 AND longitude = 0) FROM boxed)"),
    ("coordenadas fora da caixa", "flag", "(SELECT count(*) FILTER (NOT inside AND latitude <> 0) FROM boxed)")],
    "(SELECT count(*) FROM landed)")


@register("crimes_audit", "WITH" + CRIMES + "\n" + _CRIMES_AUDIT)
def _crimes_audit(spark, d):
    return audit(C.typed_crimes(tpch.crimes_raw(spark, d), _CFG), C.crimes_spec(_CFG), C.coordinate_flags(_CFG))


@register("clean_iucr", "WITH" + S.CODE_LIST + "\nSELECT * FROM code_list")
def _clean_iucr(spark, d):
    return C.clean_iucr(tpch.codes_raw(spark, d))


_REFERENCE_AUDIT = ("SELECT * FROM " + _audit_sql("socioeconomic", [
    ("linha agregada (area nula)", "", "(SELECT count(*) FROM areas)"),
    ("area repetida", "", "(SELECT count(DISTINCT community_area) FROM areas)")], "(SELECT count(*) FROM landed_areas)")
    + " UNION ALL SELECT * FROM " + _audit_sql("iucr_codes", [
        ("codigo nulo", "", "(SELECT count(*) FROM part WHERE p_brand NOT LIKE '%5')"),
        ("codigo repetido", "", "(SELECT count(DISTINCT p_brand) FROM part WHERE p_brand NOT LIKE '%5')")],
        "(SELECT count(*) FROM part)"))


@register("reference_audit", "WITH" + S.INDICATORS + "\n" + _REFERENCE_AUDIT)
def _reference_audit(spark, d):
    socio = tpch.indicators_raw(spark, d).select(*[F.col(k).cast("string").alias(v) for k, v in C.SOCIO.items()])
    return C.reference_audit(socio, tpch.codes_raw(spark, d))


@register("gold_from_text", "WITH" + CRIMES + """
SELECT iucr, count(*) AS total, count(*) FILTER (arrest)::BIGINT AS prisoes,
       round(100.0 * (count(*) FILTER (arrest) / count(*)), 1) AS taxa_prisao_pct
FROM (SELECT coalesce(iucr, 'XXXX') AS iucr, arrest FROM kept) GROUP BY ALL ORDER BY total DESC, iucr LIMIT 10""")
def _gold_from_text(spark, d):
    """Landed text through the preset's cleaning and gold layer to an answer."""
    crimes = C.clean_crimes(tpch.crimes_raw(spark, d), _CFG).checkpoint()
    socio = tpch.clean_indicators(tpch.indicators_raw(spark, d))
    star = C.gold(spark, crimes, socio, C.clean_iucr(tpch.codes_raw(spark, d)))
    return Q.most_frequent(star_join(star.fact, star.dim_type, "crime_type_key"), "iucr", 10)


_REPORT_GUARDS = [("fact_crime", "area fora da dimensao ou ausente", "chave -1 na area",
                   "(SELECT count(*) FROM kept ANTI JOIN areas USING (community_area))"),
                  ("fact_crime", "local ausente", "chave -1 no local",
                   "(SELECT count(*) FROM kept WHERE coalesce(trim(location_description), '') = '')"),
                  ("fact_crime", "codigo ausente", "chave -1 no tipo", "(SELECT count(*) FROM kept WHERE iucr IS NULL)"),
                  ("crimes", "codigo IUCR com mais de 4 caracteres", "fica como veio", "(SELECT count(*) FROM kept WHERE length(iucr) > 4)"),
                  ("crimes", "ids repetidos", "fica a versao mais nova do id",
                   "(SELECT count(*) FROM (SELECT id FROM landed WHERE id IS NOT NULL GROUP BY id HAVING count(*) > 1))")]


@register("report_preset", "WITH" + CRIMES + "," + S.INDICATORS + """,
steps AS (""" + _CRIMES_AUDIT + " UNION ALL " + _REFERENCE_AUDIT + """),
lines AS (
  SELECT "table" AS tabela, step AS verificacao, coalesce(flagged, removed)::BIGINT AS linhas_afetadas,
         if(flagged IS NULL, 'linha sai', 'valor anulado, linha fica') AS tratamento FROM steps WHERE step_order > 0
  UNION ALL """ + " UNION ALL ".join(f"SELECT '{t}', '{n}', {q}::BIGINT, '{how}'" for t, n, how, q in _REPORT_GUARDS) + """)
SELECT *, if(linhas_afetadas > 0, 'problema real', 'guarda defensiva') AS natureza FROM lines""")
def _report_preset(spark, d):
    """The preset's quality report over the landed text, its audit and its star."""
    raw = tpch.crimes_raw(spark, d)
    typed, spec = C.typed_crimes(raw, _CFG), C.crimes_spec(_CFG)
    newest = survivors_of(typed, spec).checkpoint()  # deduplicated once, for the audit and the silver rows
    socio_raw = tpch.indicators_raw(spark, d).select(*[F.col(k).cast("string").alias(v) for k, v in C.SOCIO.items()])
    rows = audit(typed, spec, C.coordinate_flags(_CFG), survivors=newest).unionByName(
        C.reference_audit(socio_raw, tpch.codes_raw(spark, d)))
    silver = C.clean_crimes(raw, _CFG, survivors=newest)
    star = C.gold(spark, silver, tpch.clean_indicators(tpch.indicators_raw(spark, d)), C.clean_iucr(tpch.codes_raw(spark, d)))
    return C.report(raw, rows, star, silver)


@register("preview", """
SELECT least(count(*), 5) AS linhas, true AS da_tabela FROM orders""")
def _preview(spark, d):
    """A look at a table: its number of rows, all of them rows of the table."""
    o = tpch.table(spark, d, "orders")
    some = preview(o, 5).checkpoint()
    return some.join(o, o.columns, "left_semi").agg(F.count(F.lit(1)).alias("linhas")).crossJoin(
        some.agg(F.count(F.lit(1)).alias("n"))).select("linhas", (F.col("linhas") == F.col("n")).alias("da_tabela"))


# ---- quality ---------------------------------------------------------------------------------

OCC_TYPES = [("id", "bigint"), ("case_number", "string"), ("occurred_at", "timestamp_ntz"),
             ("block", "string"), ("iucr", "string"), ("primary_type", "string"),
             ("description", "string"), ("location_description", "string"),
             ("arrest", "boolean"), ("domestic", "boolean"), ("beat", "int"), ("district", "int"),
             ("ward", "int"), ("community_area", "int"), ("fbi_code", "string"), ("year", "int"),
             ("latitude", "double"), ("longitude", "double")]

PROFILE_SQL = S.line("\n" + "\nUNION ALL\n".join(
    f"SELECT '{c}' AS coluna, '{t}' AS tipo, COUNT(*) AS linhas, COUNT(*) - COUNT({c}) AS nulos, "
    f"CASE WHEN COUNT(*) > 0 THEN ROUND(100.0 * (COUNT(*) - COUNT({c})) / COUNT(*), 2) ELSE 0.0 END AS pct_nulos, "
    f"COUNT(DISTINCT {c}) + CASE WHEN COUNT(*) > COUNT({c}) THEN 1 ELSE 0 END AS distintos FROM occ"
    for c, t in OCC_TYPES))


@register("profile", PROFILE_SQL)
def _profile(spark, d):
    return QL.profile(tpch.silver_lines(spark, d))


DOMAIN_COLS = ["beat", "district", "ward", "community_area", "year", "latitude", "longitude"]


@register("numeric_domains", S.line("\nSELECT " + ", ".join(
    [f"MIN({c}) AS {c}_min, MAX({c}) AS {c}_max" for c in DOMAIN_COLS]
    + [f"ROUND(AVG({c}), 6) AS {c}_mean" for c in DOMAIN_COLS]) + " FROM occ"))
def _domains(spark, d):
    return QL.numeric_domains(tpch.silver_lines(spark, d), DOMAIN_COLS)


@register("value_counts", S.line(""",
vc AS (SELECT location_description AS valor, COUNT(*) AS contagem FROM occ GROUP BY location_description)
SELECT CAST(valor AS VARCHAR) AS valor, contagem,
       CAST(row_number() OVER (ORDER BY contagem DESC, valor NULLS FIRST) AS INTEGER) AS posicao,
       (SELECT COUNT(*) FROM vc) AS categorias
FROM vc ORDER BY contagem DESC, valor NULLS FIRST LIMIT 15"""))
def _value_counts(spark, d):
    return QL.value_counts(tpch.silver_lines(spark, d), "location_description", 15)


_FREQUENT = (("lineitem", "l_orderkey"), ("lineitem", "l_suppkey"), ("lineitem", "l_linenumber"), ("lineitem", "l_returnflag"),
             ("events", "event_type"), ("part", "p_brand"))


@register("frequent_values", "\nUNION ALL\n".join(f"""
(SELECT '{c}' AS coluna, {c}::VARCHAR AS valor, count(*) AS contagem,
        row_number() OVER (ORDER BY count(*) DESC, {c} NULLS FIRST)::INTEGER AS posicao
 FROM {t} GROUP BY {c} QUALIFY posicao <= 15)""" for t, c in _FREQUENT))
def _frequent_values(spark, d):
    """Most frequent values of skewed columns (proved by a sketch) and of keys (grouped)."""
    out = None
    for t, c in _FREQUENT:
        one = SK.frequent_values(tpch.table(spark, d, t), c, 15).withColumn("coluna", F.lit(c))
        out = one if out is None else out.unionByName(one)
    return out


@register("value_counts_keys", """
WITH vc AS (SELECT l_orderkey AS valor, count(*) AS contagem FROM lineitem GROUP BY l_orderkey)
SELECT valor::VARCHAR AS valor, contagem, row_number() OVER (ORDER BY contagem DESC, valor)::INTEGER AS posicao,
       (SELECT count(*) FROM vc) AS categorias
FROM vc QUALIFY posicao <= 15""")
def _value_counts_keys(spark, d):
    """A column of as many values as there are orders."""
    return QL.value_counts(tpch.table(spark, d, "lineitem"), "l_orderkey", 15)


@register("profile_sketch", S.line("\nSELECT *, true AS dentro FROM (SELECT * EXCLUDE (distintos) FROM (" + "\nUNION ALL\n".join(
    f"SELECT '{c}' AS coluna, '{t}' AS tipo, count(*) AS linhas, count(*) - count({c}) AS nulos, "
    f"CASE WHEN count(*) > 0 THEN round(100.0 * (count(*) - count({c})) / count(*), 2) ELSE 0.0 END AS pct_nulos, 0 AS distintos FROM occ"
    for c, t in OCC_TYPES) + "))"))
def _profile_sketch(spark, d):
    """A sketch stored per yearly load, the stored sketches merged, the estimate held against the count."""
    occ = tpch.silver_lines(spark, d)
    path = scratch_path(spark, "sketches")
    old = F.col("year") < 1998
    SK.store_sketches(occ.where(old), path, "ate-1997")
    SK.store_sketches(occ.where(~old | old.isNull()), path, "desde-1998")
    return SK.sketch_error(spark.read.parquet(path), QL.profile(occ))


_LOADED = ["block", "iucr", "district", "arrest", "ward"]


@register("frequent_values_loads", S.line("\n" + "\nUNION ALL ".join(
    f"(SELECT '{c}' AS coluna, {c}::VARCHAR AS valor, count(*) AS contagem, true AS dentro FROM occ WHERE {c} IS NOT NULL GROUP BY {c} "
    f"ORDER BY contagem DESC, valor LIMIT 5)" for c in _LOADED)))
def _frequent_values_loads(spark, d):
    """Frequent-items sketches stored per yearly load and merged; what they name is counted in one scan."""
    occ = tpch.silver_lines(spark, d)
    path = scratch_path(spark, "frequent")
    for load in range(4):
        SK.store_sketches(occ.where(F.pmod(F.coalesce("year", F.lit(0)), F.lit(4)) == load), path, f"ano-{load}", _LOADED, tracked=1000)
    named = SK.sketched_values(spark.read.parquet(path), 60).checkpoint()
    counted = SK.count_values(occ, named).join(named, ["coluna", "valor"])
    place = F.row_number().over(Window.partitionBy("coluna").orderBy(F.desc("contagem"), "valor"))
    within = F.col("estimativa").between(F.col("contagem"), F.col("contagem") + F.col("erro"))
    return counted.withColumn("p", place).where("p <= 5").select("coluna", "valor", "contagem", within.alias("dentro"))


GUARDS = [("area", "community_area_key"), ("local", "location_key"), ("tipo", "crime_type_key")]


@register("quality_report", S.line(""", dk AS (SELECT count(*) AS c FROM lineitem GROUP BY l_orderkey, l_linenumber)
""" + "\nUNION ALL\n".join(
    [f"SELECT 'fact_crime' AS tabela, '{n} sem membro' AS verificacao, 'guarda' AS natureza, "
     f"count(*) FILTER ({k} = -1) AS linhas_afetadas, 'chave -1' AS tratamento FROM fact" for n, k in GUARDS]
    + ["SELECT 'socioeconomic', 'linha sem area', 'regra', count(*) FILTER (community_area IS NULL), 'sai' FROM landed_areas",
       "SELECT 'lineitem', 'chaves repetidas', 'regra', count(*) FILTER (c > 1), 'fica uma' FROM dk",
       "SELECT 'lineitem', 'linhas a mais', 'regra', sum(c - 1)::BIGINT, 'fica uma' FROM dk"])))
def _quality_report(spark, d):
    s = line(spark, d)
    checks = [QL.Check("fact_crime", f"{n} sem membro", "guarda", "chave -1", "fact", F.col(k) == -1) for n, k in GUARDS]
    checks.append(QL.Check("socioeconomic", "linha sem area", "regra", "sai", "socio_raw", F.col("community_area").isNull()))
    dk = QL.duplicate_keys(tpch.table(spark, d, "lineitem"), tpch.LINE_KEYS)
    extra = dk.selectExpr("stack(2, 'chaves repetidas', chaves_repetidas, 'linhas a mais', linhas_extras) "
                          "AS (verificacao, linhas_afetadas)")
    extra = extra.select(F.lit("lineitem").alias("tabela"), "verificacao", F.lit("regra").alias("natureza"),
                         "linhas_afetadas", F.lit("fica uma").alias("tratamento"))
    return QL.quality_report({"fact": s.fact, "socio_raw": tpch.indicators_raw(spark, d)}, checks, [extra])


# ---- joins above the broadcast bound, bucketed tables ------------------------------------------

@register("fact_build_skewed", S.line("\nSELECT * FROM fact"))
def _fact_skewed(spark, d):
    """The fact against dimensions taken as too large to broadcast: hot keys looked up apart."""
    s = line(spark, d)
    return build_fact(tpch.silver_lines(spark, d), type_dim=s.dim_type, location_dim=s.dim_location, area_dim=s.dim_area,
                      max_bytes=0)


def _layer(spark, kind: str) -> str:
    """A new schema in the shared folder."""
    path = scratch_path(spark, kind)
    return ensure_layers(spark, [f"{kind}_{path[-12:]}"], location=path)[0]


@register("bucketed_integrity", ORACLE["star_integrity"])
def _bucketed_integrity(spark, d):
    """The star's checks over a fact written in buckets of its grain: no exchange of the fact."""
    s = line(spark, d)
    name = save(s.fact, f"{_layer(spark, 'bucketed')}.fact_crime", bucket_by=(8, ["id"]), rows=s.fact.count())
    return integrity(spark.table(name), _fks(s, stale=False))


@register("bucketed_dup_keys", ORACLE["dup_keys"])
def _bucketed_dup_keys(spark, d):
    lines = tpch.table(spark, d, "lineitem")
    name = save(lines, f"{_layer(spark, 'bucketed')}.lines", bucket_by=(8, tpch.LINE_KEYS), rows=lines.count())
    return QL.duplicate_keys(spark.table(name), tpch.LINE_KEYS)


# ---- increments ----------------------------------------------------------------------------------

def _two_loads(spark, d):
    """Typed rows of two loads that hold every landed row once: orders that are only in the base,
    that the increment brings a newer or an older version of, and that are new in it."""
    raw = tpch.crimes_raw(spark, d)
    order = F.floor(F.regexp_extract("case_number", "([0-9]+)", 1).cast("long") / 10)
    again = F.col("case_number").startswith("again")
    base = F.when(again, order % 3 == 0).otherwise(order % 3 != 1)
    return C.typed_crimes(raw.where(base), _CFG), C.typed_crimes(raw.where(~base), _CFG)


def _merged(spark, d):
    base, increment = _two_loads(spark, d)
    spec = C.crimes_spec(_CFG)
    before = survivors_of(base, spec).checkpoint()

    def kept(rows):
        return null_columns(drop_rows(rows, spec.post), spec).select(*C.SILVER_CRIMES)
    return before, IN.merge_versions(before, increment, spec), kept


@register("mart_increment", "WITH" + CRIMES + """
SELECT year, primary_type, count(*) AS total, count(*) FILTER (arrest)::BIGINT AS prisoes FROM kept GROUP BY ALL""")
def _mart_increment(spark, d):
    """A mart of the base load, kept up to date by the increment alone, equals the mart of both."""
    before, merged, kept = _merged(spark, d)
    by, sums = ["year", "primary_type"], {"prisoes": F.col("arrest").cast("int")}
    mart = IN.additive(kept(before), by, sums).checkpoint()
    return IN.maintain(mart, kept(merged.old), kept(merged.new), by, sums).withColumnRenamed("n", "total")


@register("fact_increment", "WITH" + CRIMES + "," + S.INDICATORS + """
SELECT id, 10000 * year(occurred_at)::INTEGER + 100 * month(occurred_at)::INTEGER + day(occurred_at)::INTEGER AS date_key,
       coalesce(iucr, 'XXXX') AS iucr, CASE WHEN trim(location_description) <> '' THEN trim(location_description) ELSE 'DESCONHECIDO' END
         AS location_description, coalesce(a.community_area, -1) AS community_area_key, arrest AS is_arrest,
       if(inside, latitude, NULL) AS latitude
FROM boxed LEFT JOIN areas a USING (community_area)""")
def _fact_increment(spark, d):
    """Facts of the base load with those of touched ids replaced, dimensions extended by new members."""
    before, merged, kept = _merged(spark, d)
    socio = tpch.clean_indicators(tpch.indicators_raw(spark, d))
    codes = C.clean_iucr(tpch.codes_raw(spark, d))
    base = C.gold(spark, kept(before), socio, codes)
    dims = {n: measured(f.checkpoint()) for n, f in (("type", base.dim_type), ("place", base.dim_location), ("area", base.dim_area))}
    fact = build_fact(kept(before), type_dim=dims["type"], location_dim=dims["place"], area_dim=dims["area"]).checkpoint()
    new = kept(merged.new)
    types = measured(IN.extend_dim(dims["type"], type_dim(new, codes), "iucr", "crime_type_key").checkpoint())
    places = measured(IN.extend_dim(dims["place"], place_dim(new), "location_description", "location_key").checkpoint())
    merged_fact = IN.replace_facts(fact, merged.old, build_fact(new, type_dim=types, location_dim=places, area_dim=dims["area"]))
    out = merged_fact.join(F.broadcast(types.select("crime_type_key", "iucr")), "crime_type_key")
    out = out.join(F.broadcast(places), "location_key")
    return out.select("id", "date_key", "iucr", "location_description", "community_area_key", "is_arrest", "latitude")


# ---- catalog and the whole run -------------------------------------------------------------------

@register("catalog_roundtrip", """
WITH t AS (SELECT o_orderkey, o_orderstatus, o_custkey * if(o_orderstatus = 'F', 3, 1) AS v FROM orders)
SELECT 'replaced partition' AS passo, 'pedidos' AS tabela, 'o_orderkey,v,o_orderstatus' AS colunas, count(*) AS linhas, sum(v)::BIGINT AS soma,
       'orders by status' AS comentario FROM t
UNION ALL SELECT 'replaced schema', 'clientes', 'o_custkey,n', count(*), sum(n)::BIGINT, 'orders of a customer'
FROM (SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey)
UNION ALL SELECT 'listed', 'clientes,pedidos', '', 2, 0, 'round trip'""")
def _catalog_roundtrip(spark, d):
    """Layers, tables and comments written to the session catalog and read back from it: one
    partition replaced, another table replaced with another schema."""
    path = scratch_path(spark, "roundtrip")
    layer = f"roundtrip_{path[-12:]}"
    ensure_layers(spark, [layer], {layer: "round trip"}, location=path)
    ensure_layers(spark, [layer])  # again: nothing changes
    o = tpch.table(spark, d, "orders")
    first = o.select("o_orderkey", F.col("o_custkey").alias("v"), "o_orderstatus")
    orders = save(first, f"{layer}.pedidos", partition_by=["o_orderstatus"], comments={"table": "orders by status", "columns": {"v": "a value"}})
    save_partitions(o.where("o_orderstatus = 'F'").select("o_orderstatus", (F.col("o_custkey") * 3).alias("v"), "o_orderkey"), orders)
    customers = save(o.select("o_orderkey", "o_orderpriority"), f"{layer}.clientes")
    save(o.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n")), customers, comments={"table": "orders of a customer"})
    out = None
    for step, name, column in (("replaced partition", orders, "v"), ("replaced schema", customers, "n")):
        t = spark.table(name)
        one = t.agg(F.count(F.lit(1)).alias("linhas"), F.sum(column).cast("long").alias("soma")).select(
            F.lit(step).alias("passo"), F.lit(name.split(".")[1]).alias("tabela"), F.lit(",".join(t.columns)).alias("colunas"), "linhas", "soma",
            F.lit(table_comment(spark, name)).alias("comentario"))
        out = one if out is None else out.unionByName(one)
    listed = sorted(r["tableName"] for r in list_tables(spark, layer).collect())
    told = {r[0]: r[1] for r in spark.sql(f"DESCRIBE SCHEMA {layer}").collect()}
    return out.unionByName(spark.createDataFrame([("listed", ",".join(listed), "", len(listed), 0, told.get("Comment"))],
                                                 "passo string, tabela string, colunas string, linhas long, soma long, comentario string"))


_BUILT = {
    "bronze.crimes": "SELECT count(*) FROM landed", "bronze.socioeconomic": "SELECT count(*) FROM landed_areas",
    "bronze.iucr_codes": "SELECT count(*) FROM part", "silver.crimes": "SELECT count(*) FROM kept",
    "silver.crimes_checked": "SELECT count(*) FROM last_of", "silver.socioeconomic": "SELECT count(*) FROM areas",
    "silver.iucr_codes": "SELECT count(*) FROM code_list", "gold.fact_crime": "SELECT count(*) FROM kept",
    "gold.dim_crime_type": "SELECT count(DISTINCT iucr) + 1 FROM kept",
    "gold.dim_location": "SELECT count(DISTINCT location_description) FILTER (location_description <> '') + 1 FROM kept",
    "gold.dim_community_area": "SELECT count(*) + 1 FROM areas", "gold.dim_date": "SELECT count(DISTINCT occurred_at::DATE) FROM kept",
    "gold.dim_time": "SELECT 24", "gold.mart_bq2": "SELECT count(DISTINCT domestic) FROM kept",
    "gold.mart_bq4": f"SELECT count(DISTINCT year) FROM kept WHERE year < {_YEARS[1]}",
    "gold.data_quality_report": "SELECT 17"}


@register("build_run", "WITH" + CRIMES + "," + S.INDICATORS + "," + S.CODE_LIST + "\n" + "\nUNION ALL ".join(
    f"SELECT '{t}' AS tabela, ({q})::BIGINT AS linhas, true AS comentada" for t, q in _BUILT.items()))
def _build_run(spark, d):
    """The whole run from landed files to the written, commented layers, in buckets of the id."""
    path = scratch_path(spark, "build")
    with shuffles_removed(spark):
        landing = {n: write_csv(df, f"{path}/landing/{n}", compression="gzip") for n, df in {
            "crimes": tpch.crimes_raw(spark, d), "iucr_codes": tpch.codes_raw(spark, d),
            "socioeconomic": tpch.indicators_raw(spark, d).select(*[F.col(k).alias(v) for k, v in C.SOCIO.items()])}.items()}
    layers = tuple(f"{layer}_{path[-12:]}" for layer in ("bronze", "silver", "gold"))
    C.build(spark, landing, C.Config(year_window=_YEARS, layers=layers, location=path, buckets=4))
    out = None
    for t in _BUILT:
        layer, name = t.split(".")
        full = f"{layer}_{path[-12:]}.{name}"
        one = spark.table(full).agg(F.count(F.lit(1)).alias("linhas")).select(
            F.lit(t).alias("tabela"), "linhas", F.lit(bool(table_comment(spark, full))).alias("comentada"))
        out = one if out is None else out.unionByName(one)
    return out

# ---- sources and catalog -----------------------------------------------------------------------

@register("csv_roundtrip", """
SELECT CAST(n_nationkey AS VARCHAR) AS n_nationkey, n_name, CAST(n_regionkey AS VARCHAR) AS n_regionkey
FROM nation""")
def _csv_roundtrip(spark, d):
    path = scratch_path(spark, "nation-csv")
    write_csv(tpch.table(spark, d, "nation"), path)
    return read_raw_csv(spark, path)


@register("csv_many_files", """
SELECT o_orderkey::VARCHAR AS o_orderkey, o_orderstatus, o_orderpriority || ' ' AS o_orderpriority FROM orders""")
def _csv_many_files(spark, d):
    """Orders landed as files of two column orders, with blanks at the end of a value."""
    o = tpch.table(spark, d, "orders").select("o_orderkey", "o_orderstatus", F.concat("o_orderpriority", F.lit(" ")).alias("o_orderpriority"))
    path = scratch_path(spark, "orders-csv")
    odd = F.col("o_orderkey") % 2 == 1
    write_csv(o.where(odd), f"{path}/a")
    write_csv(o.where(~odd).select("o_orderpriority", "o_orderkey", "o_orderstatus"), f"{path}/b")
    return read_raw_csv(spark, path, columns=o.columns, multi_line=False)


_SPLIT = """
SELECT o_orderkey::VARCHAR AS o_orderkey,
       concat('line one of ', o_orderkey, chr(10), 'said "', o_orderpriority, '",', chr(10), chr(10), o_orderstatus) AS note,
       CASE WHEN o_orderkey % 5 <> 0 THEN o_orderstatus END AS o_orderstatus FROM orders"""


def _noted_orders(spark, d):
    """Orders with a text of several lines, quotes and separators."""
    key, br = F.col("o_orderkey").cast("string"), F.lit("\n")
    note = F.concat(F.lit("line one of "), key, br, F.lit('said "'), "o_orderpriority", F.lit('",'), br, br, "o_orderstatus")
    return tpch.table(spark, d, "orders").select(
        key.alias("o_orderkey"), note.alias("note"), F.when(F.col("o_orderkey") % 5 != 0, F.col("o_orderstatus")).alias("o_orderstatus"))


@register("csv_split_multiline", _SPLIT)
def _csv_split_multiline(spark, d):
    """One file whose fields hold line breaks, read in byte ranges side by side."""
    path = scratch_path(spark, "notes-csv")
    write_csv(_noted_orders(spark, d).coalesce(1), path)
    return read_split_csv(spark, path)


@register("csv_200_files", _SPLIT)
def _csv_200_files(spark, d):
    """The same rows as 200 files of two column orders; no job reads their headers."""
    o = _noted_orders(spark, d)
    path = scratch_path(spark, "notes-files")
    odd = F.col("o_orderkey").cast("long") % 2 == 1
    write_csv(o.where(odd).repartition(100, "o_orderkey"), f"{path}/a")
    write_csv(o.where(~odd).select("note", "o_orderkey", "o_orderstatus").repartition(100, "o_orderkey"), f"{path}/b")
    return read_raw_csv(spark, path, columns=o.columns)


@register("malformed_records", """
SELECT way, count(*) AS records, count(*) FILTER (o_orderkey % 11 < 2) AS malformed,
       count(DISTINCT o_orderkey) FILTER (o_orderkey % 11 >= 2) AS whole_orders
FROM orders, (VALUES ('split'), ('whole')) t(way) GROUP BY way""")
def _malformed_records(spark, d):
    """Landed lines with too few or too many fields are marked and counted by both readers."""
    key = F.col("o_orderkey").cast("string")
    k = F.col("o_orderkey") % 11
    text = F.when(k == 0, key).when(k == 1, F.concat_ws(",", key, "o_orderstatus", F.lit("x"), F.lit("y"))).otherwise(
        F.concat_ws(",", key, "o_orderstatus"))
    path = scratch_path(spark, "orders-lines")
    lines = tpch.table(spark, d, "orders").select(text.alias("value")).repartition(3, "value")
    header = spark.createDataFrame([("key,status",)], "value string")
    for i in range(3):  # three files, each with its header first
        part = lines.where(F.pmod(F.xxhash64("value"), F.lit(3)) == i)
        header.withColumn("n", F.lit(0)).unionByName(part.withColumn("n", F.lit(1))).coalesce(1).sortWithinPartitions(
            "n").select("value").write.text(f"{path}/f{i}")
    out = None
    for way, reader in (("split", read_split_csv), ("whole", read_raw_csv)):
        found = reader(spark, path, corrupt="raw_record").checkpoint()
        whole = found.where(F.col("raw_record").isNull()).agg(F.countDistinct("key").alias("whole_orders"))
        one = malformed(found, "raw_record").crossJoin(whole).select(F.lit(way).alias("way"), "*")
        out = one if out is None else out.unionByName(one)
    return out


@register("indexed_file", "WITH" + S.CODE_LIST + "\nSELECT * FROM code_list")
def _indexed_file(spark, d):
    """A code list landed with a first column of row numbers without a name, cleaned without it."""
    codes = tpch.codes_raw(spark, d)
    path = scratch_path(spark, "codes-csv")
    indexed = codes.withColumn("n", F.monotonically_increasing_id().cast("string")).select(F.col("n").alias(" "), *codes.columns)
    write_csv(indexed, path)
    landed = normalize_columns(read_raw_csv(spark, path))
    if landed.columns[0] != "_c0" or drop_index_column(landed).columns != codes.columns:
        raise ValueError(f"the index column was not recognised in {landed.columns}")
    return C.clean_iucr(drop_index_column(landed))


@register("normalize_columns", """
SELECT n_nationkey, n_name, n_regionkey AS n_region_key FROM nation""")
def _normalize(spark, d):
    n = tpch.table(spark, d, "nation").toDF("N Nationkey", " N Name ", "N (Region) Key")
    return normalize_columns(n)


@register("data_dictionary", """
WITH num AS (
  SELECT 'p_partkey' AS "column", CAST(MIN(p_partkey) AS VARCHAR) || ' - ' || CAST(MAX(p_partkey) AS VARCHAR) AS domain FROM part
  UNION ALL SELECT 'p_size', CAST(MIN(p_size) AS VARCHAR) || ' - ' || CAST(MAX(p_size) AS VARCHAR) FROM part
  UNION ALL SELECT 'p_retailprice', CAST(MIN(p_retailprice) AS VARCHAR) || ' - ' || CAST(MAX(p_retailprice) AS VARCHAR) FROM part),
txt AS (
  SELECT c AS "column", string_agg(v, ', ' ORDER BY n DESC, v) AS domain FROM (
    SELECT c, v, n, row_number() OVER (PARTITION BY c ORDER BY n DESC, v) AS rn FROM (
      SELECT 'p_name' AS c, p_name AS v, COUNT(*) AS n FROM part GROUP BY p_name
      UNION ALL SELECT 'p_brand', p_brand, COUNT(*) FROM part GROUP BY p_brand
      UNION ALL SELECT 'p_type', p_type, COUNT(*) FROM part GROUP BY p_type))
  WHERE rn <= 3 GROUP BY c),
meta AS (
  SELECT * FROM (VALUES ('p_partkey', 'bigint', 'part number'), ('p_name', 'string', 'part name'),
                        ('p_brand', 'string', 'brand code'), ('p_type', 'string', 'part type'),
                        ('p_size', 'int', 'size'), ('p_retailprice', 'double', 'list price'))
         AS m("column", type, description))
SELECT 'part' AS "table", m."column", m.type, m.description, coalesce(num.domain, txt.domain) AS domain
FROM meta m LEFT JOIN num ON m."column" = num."column" LEFT JOIN txt ON m."column" = txt."column\"""")
def _dictionary(spark, d):
    return data_dictionary(tpch.table(spark, d, "part"), "part",
                           {"p_partkey": "part number", "p_name": "part name",
                            "p_brand": "brand code", "p_type": "part type", "p_size": "size",
                            "p_retailprice": "list price"})


@register("lineage_stamp", """
SELECT n_nationkey, n_name, n_regionkey, 'driver:nation' AS _source FROM nation""")
def _lineage_stamp(spark, d):
    # the ingest time is one literal per run; it is left out of the comparison
    return stamp(tpch.table(spark, d, "nation"), "driver:nation").drop("_ingested_at")


@register("indicators_csv", S.line("\nSELECT * FROM areas"))
def _indicators_csv(spark, d):
    landed = tpch.indicators_raw(spark, d).select(
        *[F.col(k).alias(v) for k, v in C.SOCIO.items()])
    path = scratch_path(spark, "indicators-csv")
    write_csv(landed, path)
    return C.clean_socio(normalize_columns(read_raw_csv(spark, path)))
