"""Dimension builders: calendar, hour bands, representative attributes, enriched code,
area and place dimensions, each with surrogate or natural keys and an unknown member."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.functions.dates import date_parts
from tessera.functions.parse import ColumnOrName, _c
from tessera.operators.keys import _sized_like, with_ntiles, with_surrogate_key, with_unknown

# Shift bands of the hour dimension: (first hour, last hour, label); hours not covered get
# the fallback label. Fixed values, they are the published answer's group names.
SHIFT_BANDS = ((0, 5, "Madrugada"), (6, 11, "Manhã"), (12, 17, "Tarde"))
SHIFT_OTHER = "Noite"

DATE_COLUMNS = ["date", "date_key", "year", "month", "month_name", "quarter", "day",
                "day_of_week", "is_weekend"]


def date_dim(df: DataFrame, ts: ColumnOrName) -> DataFrame:
    """One row per observed day of ``ts`` (null days left out) with its calendar attributes.

    Rows are bounded by the calendar (days in the covered range), not by the fact size.
    """
    days = df.select(F.to_date(_c(ts)).alias("date")).where(F.col("date").isNotNull()).distinct()
    return days.withColumns(date_parts(F.col("date"))).select(*DATE_COLUMNS)


def shift_of(hour: Column, bands=SHIFT_BANDS, other: str = SHIFT_OTHER) -> Column:
    expr = None
    for lo, hi, label in bands:
        cond = hour.between(lo, hi)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr.otherwise(F.lit(other)) if expr is not None else F.lit(other)


def time_dim(spark: SparkSession, bands=SHIFT_BANDS, other: str = SHIFT_OTHER) -> DataFrame:
    """24 rows: ``time_key`` (int, = hour), ``hour``, ``shift``."""
    hours = spark.range(0, 24).select(F.col("id").cast("int").alias("time_key"))
    return hours.select("time_key", F.col("time_key").alias("hour"),
                        shift_of(F.col("time_key"), bands, other).alias("shift"))


def representative(df: DataFrame, key: str, attrs: Sequence[str]) -> DataFrame:
    """Most frequent ``attrs`` tuple per ``key`` (null keys left out). Ties go to the
    smallest tuple (ascending, nulls first), so the result is defined.

    Counting is a partial/final hash aggregate; the top-1 per key is pruned map-side.
    """
    counted = (df.where(F.col(key).isNotNull()).groupBy(key, *attrs)
               .agg(F.count(F.lit(1)).alias("_cnt")))
    w = Window.partitionBy(key).orderBy(F.desc("_cnt"), *[F.col(a).asc_nulls_first() for a in attrs])
    return (counted.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1)
            .select(key, *attrs))


def keyed_dim(df: DataFrame, natural: str, key: str, unknown: Mapping[str, object] | None,
              columns: Sequence[str]) -> DataFrame:
    """Surrogate ``key`` = position of ``natural`` in ascending order; optional unknown row."""
    keyed = with_surrogate_key(df, [natural], key)
    out = _sized_like(keyed, keyed.select(*columns))
    return with_unknown(out, dict(unknown)) if unknown is not None else out


def type_dim(occ: DataFrame, ref: DataFrame | None, *, code: str = "iucr",
             attrs: Sequence[str] = ("primary_type", "description", "fbi_code"),
             key: str = "crime_type_key", flag: str = "is_index",
             ref_columns: Sequence[str] = ("iucr_primary_description", "iucr_secondary_description"),
             unknown: Mapping[str, object] | None = None) -> DataFrame:
    """Code dimension: representative attributes per code from the facts, enriched by a
    reference table (left join: codes missing there are kept, ``flag`` defaults to false),
    surrogate key by code, plus the unknown member."""
    rep = representative(occ, code, list(attrs))
    if ref is not None:
        rep = rep.join(ref.select(code, *ref_columns, flag), code, "left")
    else:
        rep = rep.withColumns({c: F.lit(None).cast("string") for c in ref_columns}) \
                 .withColumn(flag, F.lit(None).cast("boolean"))
    rep = rep.withColumn(flag, F.coalesce(F.col(flag), F.lit(False)))
    cols = [key, code, *attrs, *ref_columns, flag]
    return keyed_dim(rep, code, key, unknown, cols)


def place_dim(occ: DataFrame, text: str = "location_description", key: str = "location_key",
              unknown: Mapping[str, object] | None = None) -> DataFrame:
    """Distinct non-blank texts, surrogate key by text, plus the unknown member."""
    places = occ.select(text).where(F.col(text).isNotNull() & (F.col(text) != "")).distinct()
    return keyed_dim(places, text, key, unknown, [key, text])


def area_dim(indicators: DataFrame, *, area: str = "community_area",
             key: str = "community_area_key",
             quartiles: Mapping[str, str] | None = None, n: int = 4,
             unknown: Mapping[str, object] | None = None) -> DataFrame:
    """Area dimension: natural key = area number, indicators, ``n``-tiles of chosen columns
    (``{tile_name: source column}``, lowest values in tile 1, nulls first, ties by area),
    plus the unknown member."""
    quartiles = quartiles or {}
    out = indicators.withColumn(key, F.col(area))
    tiled = with_ntiles(out, {name: (n, [src, area]) for name, src in quartiles.items()})
    cols = [key] + [c for c in indicators.columns] + list(quartiles)
    out = _sized_like(tiled, tiled.select(*cols))
    return with_unknown(out, dict(unknown)) if unknown is not None else out
