"""DuckDB statements that derive the driver-table star by other means than the library:
QUALIFY instead of nested ranking, keyed dimensions from ``list`` positions, one joined view
(``j``) with every attribute of a fact. They are the correctness oracle.

Engine differences handled here: DuckDB sorts nulls last (so orders say NULLS FIRST),
counts in BIGINT and sums in HUGEINT (so keys and counts are cast), numbers Sunday as 0,
rounds on double to integer casts (so truncation is written with ``trunc``) and parses
``'6.0'`` as a bigint (so the integral-decimal rule is spelled out).
"""

from __future__ import annotations

TS_FMT = "%m/%d/%Y %I:%M:%S %p"

LINES = """
line_once AS (
  SELECT * FROM lineitem
  QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC NULLS LAST,
    l_partkey NULLS FIRST, l_suppkey NULLS FIRST, l_quantity NULLS FIRST, l_extendedprice NULLS FIRST,
    l_discount NULLS FIRST, l_tax NULLS FIRST, l_returnflag NULLS FIRST, l_linestatus NULLS FIRST) = 1)"""

PLACE = "CASE p_size WHEN 2 THEN NULL WHEN 3 THEN '' ELSE p_name END"
AREA = "CASE s_nationkey WHEN 0 THEN NULL WHEN 24 THEN 99 ELSE s_nationkey END"

LINE_OCC = LINES + f""",
occ AS (
  SELECT (10 * l_orderkey + l_linenumber)::BIGINT AS id, concat('L', l_orderkey, '-', l_linenumber) AS case_number,
         l_shipdate AS occurred_at, concat(l_returnflag, '-', l_linestatus) AS block,
         CASE WHEN p_size <> 1 THEN p_brand END AS iucr, p_type AS primary_type, lower(p_type) AS description,
         {PLACE} AS location_description, l_returnflag = 'R' AS arrest, l_linestatus = 'F' AS domestic,
         l_suppkey::INTEGER AS beat, s_nationkey AS district, l_linenumber AS ward, {AREA} AS community_area,
         substr(p_brand, 7) AS fbi_code, year(l_shipdate)::INTEGER AS year, l_discount AS latitude, l_tax AS longitude
  FROM line_once, part, supplier WHERE l_partkey = p_partkey AND l_suppkey = s_suppkey)"""

EVENT_OCC = """
occ AS (
  SELECT event_id AS id, concat('E', event_id) AS case_number, ts AS occurred_at, event_type AS block,
         event_type AS iucr, upper(event_type) AS primary_type, event_type AS description,
         props AS location_description, event_type = 'error' AS arrest, event_type = 'purchase' AS domestic,
         user_id::INTEGER AS beat, c_nationkey AS district, NULL::INTEGER AS ward,
         CASE WHEN c_nationkey <> 0 THEN c_nationkey END AS community_area, left(event_type, 1) AS fbi_code,
         year(ts)::INTEGER AS year, value AS latitude, -value AS longitude
  FROM events LEFT JOIN customer ON user_id = c_custkey)"""


def _pct(condition: str) -> str:
    return f"100.0 * avg(({condition})::INTEGER)"


_INDICATORS = ", ".join([
    _pct("c_mktsegment = 'HOUSEHOLD'") + " AS pct_housing_crowded", _pct("c_acctbal < 0") + " AS pct_below_poverty",
    _pct("c_mktsegment = 'MACHINERY'") + " AS pct_unemployed", _pct("c_mktsegment = 'FURNITURE'") + " AS pct_no_highschool",
    _pct("c_mktsegment = 'AUTOMOBILE'") + " AS pct_dependent_age",
    "round(avg(c_acctbal))::INTEGER AS per_capita_income", "count(*)::INTEGER AS hardship_index"])

#: The code list: one row per listed code, the smallest tuple of its texts and flag.
CODE_LIST = """
code_list AS (
  SELECT p_brand AS iucr, trim(p_type) AS iucr_primary_description, trim(p_name) AS iucr_secondary_description,
         p_size > 25 AS is_index
  FROM part WHERE p_brand NOT LIKE '%5'
  QUALIFY row_number() OVER (PARTITION BY iucr ORDER BY iucr_primary_description NULLS FIRST,
    iucr_secondary_description NULLS FIRST, is_index NULLS FIRST) = 1)"""

INDICATORS = f"""
landed_areas AS (
  SELECT n_nationkey::INTEGER AS community_area, n_name AS community_area_name, {_INDICATORS}
  FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY ALL
  UNION ALL SELECT NULL, 'ALL NATIONS', {_INDICATORS} FROM customer),
areas AS (FROM landed_areas WHERE community_area IS NOT NULL)"""

DIMS = f""",{CODE_LIST},{INDICATORS},
code_texts AS (
  SELECT iucr, primary_type, description, fbi_code FROM occ WHERE iucr IS NOT NULL
  GROUP BY iucr, primary_type, description, fbi_code
  QUALIFY row_number() OVER (PARTITION BY iucr ORDER BY count(*) DESC, primary_type NULLS FIRST,
    description NULLS FIRST, fbi_code NULLS FIRST) = 1),
dim_type AS (
  SELECT rank() OVER (ORDER BY iucr)::INTEGER AS crime_type_key, iucr, primary_type, description, fbi_code,
         iucr_primary_description, iucr_secondary_description, coalesce(is_index, false) AS is_index
  FROM code_texts LEFT JOIN code_list USING (iucr)
  UNION ALL VALUES (-1, 'XXXX', 'DESCONHECIDO', NULL, NULL, NULL, NULL, false)),
dim_location AS (
  SELECT rank() OVER (ORDER BY location_description)::INTEGER AS location_key, location_description
  FROM (SELECT location_description FROM occ WHERE location_description <> '' GROUP BY ALL)
  UNION ALL VALUES (-1, 'DESCONHECIDO')),
dim_area AS (
  SELECT community_area AS community_area_key, *,
         ntile(4) OVER (ORDER BY per_capita_income NULLS FIRST, community_area)::INTEGER AS income_quartile,
         ntile(4) OVER (ORDER BY hardship_index NULLS FIRST, community_area)::INTEGER AS hardship_quartile
  FROM areas
  UNION ALL VALUES (-1, NULL, 'Desconhecido', NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL)),
dim_date AS (
  SELECT date, (10000 * year(date) + 100 * month(date) + day(date))::INTEGER AS date_key,
         year(date)::INTEGER AS year, month(date)::INTEGER AS month, monthname(date) AS month_name,
         quarter(date)::INTEGER AS quarter, day(date)::INTEGER AS day, dayname(date) AS day_of_week,
         isodow(date) > 5 AS is_weekend
  FROM (SELECT occurred_at::DATE AS date FROM occ WHERE occurred_at IS NOT NULL GROUP BY ALL)),
dim_time AS (
  SELECT h::INTEGER AS time_key, h::INTEGER AS hour, ['Madrugada', 'Manhã', 'Tarde', 'Noite'][h // 6 + 1] AS shift
  FROM range(24) g(h)),
fact AS (
  SELECT id, (10000 * year(occurred_at) + 100 * month(occurred_at) + day(occurred_at))::INTEGER AS date_key,
         hour(occurred_at)::INTEGER AS time_key, coalesce(crime_type_key, -1) AS crime_type_key,
         coalesce(community_area_key, -1) AS community_area_key, coalesce(location_key, -1) AS location_key,
         district, beat, ward, arrest AS is_arrest, domestic AS is_domestic, latitude, longitude
  FROM occ
  LEFT JOIN (SELECT iucr, crime_type_key FROM dim_type WHERE crime_type_key > 0) USING (iucr)
  LEFT JOIN (FROM dim_location WHERE location_key > 0) USING (location_description)
  LEFT JOIN (SELECT community_area, community_area_key FROM dim_area WHERE community_area_key >= 0) USING (community_area)),
j AS (
  SELECT f.*, coalesce(is_arrest, false)::INTEGER AS hit, dim_type.* EXCLUDE (crime_type_key),
         dim_area.* EXCLUDE (community_area_key), dim_date.* EXCLUDE (date_key), shift, location_description
  FROM fact f LEFT JOIN dim_type USING (crime_type_key) LEFT JOIN dim_area USING (community_area_key)
  LEFT JOIN dim_date USING (date_key) LEFT JOIN dim_time USING (time_key) LEFT JOIN dim_location USING (location_key))
"""

LINE = "WITH" + LINE_OCC + DIMS
EVENT = "WITH" + EVENT_OCC + DIMS

#: Percent of facts with an arrest.
RATE = "round(100.0 * (sum(hit) / count(*)), 1)"
HITS = "sum(hit)::BIGINT"


def line(body: str) -> str:
    """A statement over the line-item star; a body may begin with further ``, name AS (...)``."""
    return LINE + body


def event(body: str) -> str:
    return EVENT + body


def by(group: str, *values: str, where: str = "", tail: str = "") -> str:
    """Counts of ``j`` by a group expression (``x AS y``): total and the given values."""
    return f"SELECT {group}, count(*) AS total{''.join(', ' + v for v in values)} FROM j {where} GROUP BY ALL {tail}"
