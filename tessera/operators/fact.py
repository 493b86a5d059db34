"""Fact build: keys computed from values or looked up in dimensions (unknown -> -1), and
the integrity report of the star."""

from __future__ import annotations

import weakref
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.dates import date_key

# A side of at most this many bytes may be broadcast; a larger or unknown one is joined as
# Spark plans it (by its own threshold, at run time from measured sizes).
BROADCAST_MAX_BYTES = 64 << 20


# Share of the rows from which a value is hot: a shuffle partition of its own.
HOT_SHARE = 0.005


_SIZES: "weakref.WeakKeyDictionary[DataFrame, tuple[int, int]]" = weakref.WeakKeyDictionary()


def row_bytes(df: DataFrame) -> Column:
    """Bytes of a row in memory: lengths of texts, 8 for any other value, and 16 of overhead."""
    total = F.lit(16)
    for f in df.schema.fields:
        is_text = isinstance(f.dataType, (T.StringType, T.BinaryType))
        total = total + (F.coalesce(F.octet_length(F.col(f"`{f.name}`")), F.lit(0)) + 8 if is_text else F.lit(8))
    return total.cast("long")


def remember_size(df: DataFrame, rows: int, size: int) -> DataFrame:
    """Record rows and bytes already computed for ``df`` (e.g. while numbering a dimension)."""
    _SIZES[df] = (rows, size)
    return df


def size_of(df: DataFrame) -> tuple[int, int] | None:
    """(rows, bytes) recorded for ``df``, if any."""
    return _SIZES.get(df)


def measured(df: DataFrame) -> DataFrame:
    """Measure and record the size of a written or checkpointed ``df`` (one small job)."""
    n, size = df.agg(F.count(F.lit(1)), F.coalesce(F.sum(row_bytes(df)), F.lit(0))).first()
    return remember_size(df, n, size)


def bytes_of(df: DataFrame) -> int:
    """Recorded bytes, else the plan's own statistics (file sizes for a table): no job."""
    size = size_of(df)
    if size is not None:
        return size[1]
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def fits_broadcast(dim: DataFrame, max_bytes: int = BROADCAST_MAX_BYTES) -> bool:
    """Whether ``dim`` is known to take at most ``max_bytes``."""
    return bytes_of(dim) <= max_bytes


def broadcast_checked(dim: DataFrame, max_bytes: int = BROADCAST_MAX_BYTES,
                      basis: DataFrame | None = None) -> DataFrame:
    """Broadcast ``dim`` only if ``basis`` (default ``dim`` itself; pass the unfiltered
    dimension when ``dim`` is derived from it) is known to be small. Else the dimension is
    returned unhinted: Spark plans a shuffle join, and AQE re-plans it from measured sizes
    and splits skewed partitions."""
    return F.broadcast(dim) if fits_broadcast(basis if basis is not None else dim, max_bytes) else dim


def hot_values(df: DataFrame, col: str, share: float = HOT_SHARE) -> list:
    """Values of ``col`` that hold at least about ``share`` of the rows: one aggregate, and at
    most ``2 / share`` values, whatever the data."""
    most = int(2 / share)
    one = df.agg(F.count(F.lit(1)).alias("n"), F.expr(f"approx_top_k(`{col}`, {most}, {max(10_000, 10 * most)})").alias("top")).first()
    return [i["item"] for i in one["top"] if i["item"] is not None and i["count"] >= share * one["n"]]


def lookup_key(df: DataFrame, dim: DataFrame, natural: str, key: str, unknown: int = -1,
               broadcast: bool = True, basis: DataFrame | None = None,
               max_bytes: int = BROADCAST_MAX_BYTES) -> DataFrame:
    """Add ``key`` by a left join of ``df`` to ``dim`` on ``natural``; no match (and any null
    natural value) -> ``unknown``. ``dim`` must be unique on ``natural`` and must not hold the
    unknown member (a real value equal to its label would otherwise double facts).

    A dimension that is not known to take at most ``max_bytes`` is joined in two parts: rows
    without a value or with a hot one (:func:`hot_values`) look it up in the few dimension rows
    of those, which are broadcast; only the others, none of which is frequent, are shuffled.
    """
    side = dim.select(natural, key)
    if not broadcast:
        joined = df.join(side, natural, "left")
    elif fits_broadcast(basis if basis is not None else dim, max_bytes):
        joined = df.join(F.broadcast(side), natural, "left")
    else:
        hot = hot_values(df, natural)
        is_hot = F.col(natural).isNull() | F.col(natural).isin(hot) if hot else F.col(natural).isNull()
        few = df.where(is_hot).join(F.broadcast(side.where(F.col(natural).isin(hot) if hot else F.lit(False))), natural, "left")
        joined = few.unionByName(df.where(~is_hot).join(side, natural, "left"))
    return joined.withColumn(key, F.coalesce(F.col(key), F.lit(unknown)).cast("int"))


def known(dim: DataFrame, key: str, unknown: int = -1) -> DataFrame:
    """The dimension without its unknown member."""
    return dim.where(F.col(key) != unknown)


FACT_COLUMNS = ["id", "date_key", "time_key", "crime_type_key", "community_area_key",
                "location_key", "district", "beat", "ward", "is_arrest", "is_domestic",
                "latitude", "longitude"]


def build_fact(occ: DataFrame, *, type_dim: DataFrame, location_dim: DataFrame,
               area_dim: DataFrame, ts: str = "occurred_at", unknown: int = -1,
               columns: Mapping[str, Column | str] | None = None,
               max_bytes: int = BROADCAST_MAX_BYTES) -> DataFrame:
    """Fact rows, one per occurrence: date and time keys from the timestamp (no join), type
    and location keys looked up, area key = the area when it is a member of the area dimension,
    else ``unknown``. No shuffle of the fact while the dimensions are known to take at most
    ``max_bytes``; beyond it, none of hot keys (:func:`lookup_key`)."""
    out = occ.withColumns({"date_key": date_key(F.col(ts)), "time_key": F.hour(F.col(ts))})
    out = lookup_key(out, known(type_dim, "crime_type_key", unknown), "iucr", "crime_type_key",
                     unknown, basis=type_dim, max_bytes=max_bytes)
    out = lookup_key(out, known(location_dim, "location_key", unknown), "location_description",
                     "location_key", unknown, basis=location_dim, max_bytes=max_bytes)
    areas = known(area_dim, "community_area_key", unknown).select(
        F.col("community_area").alias("_area"), F.col("community_area_key").alias("_ak"))
    out = (out.join(broadcast_checked(areas, basis=area_dim), out["community_area"] == F.col("_area"), "left")
           .withColumn("community_area_key", F.coalesce(F.col("_ak"), F.lit(unknown)).cast("int"))
           .drop("_area", "_ak"))
    spec = columns or {
        "id": "id", "date_key": "date_key", "time_key": "time_key",
        "crime_type_key": "crime_type_key", "community_area_key": "community_area_key",
        "location_key": "location_key", "district": "district", "beat": "beat", "ward": "ward",
        "is_arrest": "arrest", "is_domestic": "domestic", "latitude": "latitude",
        "longitude": "longitude"}
    return out.select(*[(F.col(v) if isinstance(v, str) else v).alias(k) for k, v in spec.items()])


def integrity(fact: DataFrame, fks: Mapping[str, tuple[DataFrame, str]],
              grain: Sequence[str] = ("id",), flag: str | None = "is_arrest") -> DataFrame:
    """Star checks as rows ``(check, value, ok)``: fact rows, distinct grain keys, grain
    violations, share of flagged facts, and orphans of every foreign key
    (``fks = {fact_col: (dim, dim_key)}``).

    One pass over the fact: each dimension's keys carry a marker column and are left-joined
    (broadcast if small), missing markers and flags are summed per grain key, and those
    sums are added up. The only shuffle of the fact is the one on its grain. A null in a
    single grain column is no key.
    """
    cols = list(dict.fromkeys([*grain, *fks, *([flag] if flag else [])]))
    probe = fact.select(*cols)
    for i, (col, (dim, dkey)) in enumerate(fks.items()):
        keys = dim.select(F.col(dkey).alias(col)).distinct().withColumn(f"_in{i}", F.lit(True))
        probe = probe.join(broadcast_checked(keys, basis=dim), col, "left")
    per = probe.groupBy(*grain).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.when(F.col(flag), 1).otherwise(0) if flag else F.lit(0)).alias("hits"),
        *[F.count_if(F.col(f"_in{i}").isNull()).alias(f"orph{i}") for i in range(len(fks))])
    is_key = F.col(grain[0]).isNotNull() if len(grain) == 1 else F.lit(True)
    one = per.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("rows"), F.count_if(is_key).alias("keys"),
                  (F.try_divide(F.sum("hits"), F.sum("n"))).alias("flag_avg"),
                  *[F.coalesce(F.sum(f"orph{i}"), F.lit(0)).alias(f"orph{i}") for i in range(len(fks))])
    rows = [("'fact_rows'", "CAST(rows AS DOUBLE)", "true"),
            ("'distinct_grain'", "CAST(keys AS DOUBLE)", "true"),
            ("'grain_violations'", "CAST(rows - keys AS DOUBLE)", "rows = keys")]
    if flag:
        rows.append((f"'{flag}_pct'", "ROUND(flag_avg * 100, 2)", "true"))
    rows += [(f"'orphans_{col}'", f"CAST(orph{i} AS DOUBLE)", f"orph{i} = 0")
             for i, col in enumerate(fks)]
    body = ", ".join(", ".join(r) for r in rows)
    return one.selectExpr(f"stack({len(rows)}, {body}) AS (check, value, ok)")
