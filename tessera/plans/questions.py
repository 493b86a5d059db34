"""The business questions over a star (BQ1-BQ7), the dashboard marts and chart series.

Every rate is ``ROUND(100 * AVG(CASE WHEN is_arrest THEN 1 ELSE 0 END), 1)``. Dimensions are
broadcast if they are known to be small. Answers come ordered (a global sort of one row per
group), every order and top-k with a tie-breaker on the group key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.operators.marts import (group_corr, group_rate, label, rate, star_join, top_k,
                                     widget_series, with_share)
from tessera.plans.star import Star

# Dashboard labels of the boolean groups (fixed values of the published marts).
LABEL_INDEX = ("Index (graves)", "Non-index")
LABEL_DOMESTIC = ("Domestico", "Nao domestico")

RATE = "taxa_prisao_pct"


def _date(s: Star) -> DataFrame:
    return star_join(s.fact, s.dim_date, "date_key")


def _time(s: Star) -> DataFrame:
    return star_join(s.fact, s.dim_time, "time_key")


def bq1(s: Star, k: int = 20) -> DataFrame:
    """Most frequent types with arrest count and rate (top ``k`` by total)."""
    return most_frequent(star_join(s.fact, s.dim_type, "crime_type_key"), "primary_type", k)


def most_frequent(rows: DataFrame, by: str, k: int, rate_name: str = RATE) -> DataFrame:
    """The ``k`` most frequent values of ``by`` with arrest count and rate."""
    g = group_rate(rows, [by], hits="prisoes", rate_name=rate_name)
    return top_k(g.select(by, "total", "prisoes", rate_name), [F.desc("total"), F.asc_nulls_first(by)], k)


def bq2(s: Star) -> DataFrame:
    """Rate by the domestic flag (a null flag is its own group)."""
    return group_rate(s.fact, ["is_domestic"], rate_name=RATE)


def bq3a(s: Star) -> DataFrame:
    """Total and rate by shift, most facts first."""
    return group_rate(_time(s), ["shift"], rate_name=RATE).orderBy(F.desc("total"), "shift")


def bq3b(s: Star) -> DataFrame:
    """Total and rate by weekday name, most facts first."""
    return group_rate(_date(s), ["day_of_week"], rate_name=RATE).orderBy(F.desc("total"), "day_of_week")


def bq3c(s: Star) -> DataFrame:
    """Total and rate by hour (the time key is the hour: no join needed)."""
    return group_rate(s.fact.withColumnRenamed("time_key", "hour"), ["hour"], rate_name=RATE).orderBy("hour")


def bq4a(s: Star) -> DataFrame:
    """Total and rate by year."""
    return group_rate(_date(s), ["year"], rate_name=RATE).orderBy("year")


def bq4b(s: Star) -> DataFrame:
    """Total by month."""
    return group_rate(_date(s), ["month", "month_name"], rate_name=None).orderBy("month")


def bq5(s: Star, k: int = 15) -> DataFrame:
    """Areas with most facts (known areas only), top ``k``."""
    j = star_join(s.fact, s.dim_area, "community_area_key", known_only=True)
    g = group_rate(j, ["community_area", "community_area_name"], rate_name=None)
    return top_k(g, [F.desc("total"), F.asc_nulls_first("community_area")], k)


def bq6a(s: Star) -> DataFrame:
    """By hardship quartile: facts, fact-weighted mean income (rounded), rate."""
    j = star_join(s.fact, s.dim_area, "community_area_key", known_only=True)
    return group_rate(j, ["hardship_quartile"], total="total_crimes", rate_name=None,
                      extra={"renda_media": F.round(F.avg("per_capita_income")),
                             RATE: rate(F.col("is_arrest"))}).orderBy("hardship_quartile")


def bq6b(s: Star) -> DataFrame:
    """Area-by-area correlation of fact counts with income, hardship and poverty."""
    j = star_join(s.fact, s.dim_area, "community_area_key", known_only=True)
    # an indicator is constant within its area, so any aggregate that returns it will do
    indicators = {"per_capita_income": "renda", "hardship_index": "hardship", "pct_below_poverty": "pobreza"}
    return group_corr(
        j, "community_area", {"n": F.count(F.lit(1)), **{c: F.max(c) for c in indicators}},
        {f"corr_crimes_{name}": ("n", c) for c, name in indicators.items()})


def bq7(s: Star) -> DataFrame:
    """Index vs non-index: total, share of all facts, rate."""
    g = group_rate(star_join(s.fact, s.dim_type, "crime_type_key"), ["is_index"], rate_name=RATE)
    return with_share(g, "total", "pct_do_total").select("is_index", "total", "pct_do_total", RATE)


def rate_extremes(s: Star, min_total: int = 500, k: int = 3) -> DataFrame:
    """Highest and lowest rates among types with at least ``min_total`` facts:
    ``lado`` ('top' / 'bottom'), ``posicao``, type, total, rate."""
    return extremes(star_join(s.fact, s.dim_type, "crime_type_key"), "primary_type", min_total, k)


def extremes(rows: DataFrame, by: str, min_total: int, k: int) -> DataFrame:
    """The ``k`` groups of ``by`` with the highest and the lowest rate, from one grouping: each
    side's rank is a window over the groups that have enough rows."""
    g = group_rate(rows, [by], rate_name=RATE, min_total=min_total)
    tie = [F.desc("total"), F.asc_nulls_first(by)]
    sides = g.select("*", F.explode(F.array(F.lit("top"), F.lit("bottom"))).alias("lado"))
    sign = F.when(F.col("lado") == "top", -F.col(RATE)).otherwise(F.col(RATE))
    ranked = sides.withColumn("posicao", F.row_number().over(Window.partitionBy("lado").orderBy(sign, *tie)))
    return ranked.where(F.col("posicao") <= k).select("lado", "posicao", by, "total", RATE)


# ---- dashboard marts (each keeps its numerator so a chart can re-aggregate rates) -------

MART_RATE = "taxa_prisao"


def mart_bq1(s: Star, k: int = 10) -> DataFrame:
    return most_frequent(star_join(s.fact, s.dim_type, "crime_type_key"), "primary_type", k, MART_RATE)


def mart_bq2(s: Star) -> DataFrame:
    g = group_rate(s.fact, ["is_domestic"], hits="prisoes", rate_name=MART_RATE)
    return g.select(label(F.col("is_domestic"), *LABEL_DOMESTIC).alias("tipo"), "total",
                    "prisoes", MART_RATE)


def mart_bq3(s: Star) -> DataFrame:
    g = group_rate(_time(s), ["shift"], hits="prisoes", rate_name=MART_RATE)
    return g.select(F.col("shift").alias("turno"), "total", "prisoes", MART_RATE).orderBy(F.desc("total"), "turno")


def mart_bq4(s: Star, before_year: int = 2017) -> DataFrame:
    """By year, leaving out the partial last year (``year < before_year``)."""
    j = _date(s).where(F.col("year") < before_year)
    return group_rate(j, ["year"], hits="prisoes", rate_name=MART_RATE).orderBy("year")


def mart_bq5(s: Star, k: int = 10) -> DataFrame:
    j = star_join(s.fact, s.dim_area, "community_area_key", known_only=True)
    g = group_rate(j.withColumnRenamed("community_area_name", "bairro"), ["bairro"],
                   rate_name=None)
    return top_k(g, [F.desc("total"), F.asc_nulls_first("bairro")], k)


def mart_bq6(s: Star) -> DataFrame:
    j = star_join(s.fact, s.dim_area, "community_area_key", known_only=True)
    g = group_rate(j, ["hardship_quartile"], hits="prisoes", rate_name=MART_RATE)
    return g.select(F.col("hardship_quartile").alias("quartil"), "total", "prisoes", MART_RATE).orderBy("quartil")


def mart_bq7(s: Star) -> DataFrame:
    g = group_rate(star_join(s.fact, s.dim_type, "crime_type_key"), ["is_index"], hits="prisoes",
                   rate_name=MART_RATE)
    return g.select(label(F.col("is_index"), *LABEL_INDEX).alias("tipo"), "total", "prisoes",
                    MART_RATE)


def marts(s: Star, time_star: Star | None = None, before_year: int = 2017) -> dict[str, DataFrame]:
    """The seven dashboard datasets by name."""
    ts = time_star or s
    return {"mart_bq1": mart_bq1(s), "mart_bq2": mart_bq2(s), "mart_bq3": mart_bq3(ts),
            "mart_bq4": mart_bq4(s, before_year), "mart_bq5": mart_bq5(s), "mart_bq6": mart_bq6(s),
            "mart_bq7": mart_bq7(s)}


def widget_all(m: dict[str, DataFrame]) -> DataFrame:
    """The eight dashboard series as ``series, x, y`` (x as text), from marts that are
    written (or checkpointed): the fact is not read again."""
    rate = ("prisoes", "total")
    parts = [
        widget_series(m["mart_bq1"], "primary_type", "total", series="w1"),
        widget_series(m["mart_bq1"], "primary_type", MART_RATE, series="w1b", rate_of=rate),
        widget_series(m["mart_bq4"], "year", "total", series="w4"),
        widget_series(m["mart_bq5"], "bairro", "total", series="w5"),
        widget_series(m["mart_bq6"], "quartil", MART_RATE, series="w6", rate_of=rate),
        widget_series(m["mart_bq7"], "tipo", MART_RATE, series="w7", rate_of=rate),
        widget_series(m["mart_bq2"], "tipo", MART_RATE, series="w2", rate_of=rate),
        widget_series(m["mart_bq3"], "turno", MART_RATE, series="w3", rate_of=rate),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
