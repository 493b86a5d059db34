"""Question-answering operators over a star: joins to dimensions, rates per group, share of
total, top-k, two-level correlations and chart series."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.operators.fact import broadcast_checked


def star_join(fact: DataFrame, dim: DataFrame, key: str, known_only: bool = False,
              unknown: int = -1) -> DataFrame:
    """Inner join of the fact to one dimension on ``key`` (dimension broadcast if it is
    known to be small). ``known_only`` keeps only real members (``key > 0``: the unknown member and any
    non-positive key are left out); the filter reaches both scans."""
    d = dim.where(F.col(key) > 0) if known_only else dim
    f = fact.where(F.col(key) > 0) if known_only else fact
    return f.join(broadcast_checked(d, basis=dim), key, "inner")


def as_count(flag: Column) -> Column:
    """0/1 counter of a boolean; null counts as 0."""
    return F.when(flag, 1).otherwise(0)


def rate(flag: Column, decimals: int = 1) -> Column:
    """``ROUND(100.0 * AVG(CASE WHEN flag THEN 1 ELSE 0 END), decimals)``."""
    return F.round(F.lit(100.0) * F.avg(as_count(flag)), decimals)


def group_rate(df: DataFrame, by: Sequence[str | Column], flag: str = "is_arrest", *,
               total: str = "total", hits: str | None = None, rate_name: str | None = "taxa_prisao_pct",
               extra: Mapping[str, Column] | None = None, min_total: int | None = None,
               decimals: int = 1) -> DataFrame:
    """Rows per group: ``total`` = COUNT(*), optional ``hits`` = number flagged, ``rate_name``
    = percent flagged rounded (null flag counts as not flagged), plus ``extra`` aggregates.
    ``min_total`` keeps only groups with at least that many rows (minimum support)."""
    aggs = [F.count(F.lit(1)).alias(total)]
    if hits:
        aggs.append(F.sum(as_count(F.col(flag))).alias(hits))
    if rate_name:
        aggs.append(rate(F.col(flag), decimals).alias(rate_name))
    aggs += [c.alias(n) for n, c in (extra or {}).items()]
    out = df.groupBy(*by).agg(*aggs)
    if min_total is not None:
        out = out.where(F.col(total) >= min_total)
    return out


def with_share(df: DataFrame, total: str = "total", name: str = "pct_do_total",
               decimals: int = 1) -> DataFrame:
    """``ROUND(100 * total / SUM(total), decimals)`` as double. ``df`` holds one row a group,
    so the grand total is a window over those few rows; the data are read once."""
    grand = F.sum(total).over(Window.partitionBy())
    return df.withColumn(name, F.round(F.lit(100.0) * F.col(total) / grand, decimals).cast("double"))


def top_k(df: DataFrame, order: Sequence[Column | str], k: int) -> DataFrame:
    """First ``k`` rows of a total order (pass a tie-breaker last): planned as a bounded
    per-partition heap (TakeOrderedAndProject), never a full sort."""
    return df.orderBy(*order).limit(k)


def preview(df: DataFrame, n: int = 5) -> DataFrame:
    """First ``n`` rows in no particular order (a look at a table, not a ranking)."""
    return df.limit(n)


def _safe_corr(x: str, y: str) -> Column:
    """Pearson r over the rows where both values exist; null (not a divide-by-zero error
    under ANSI) when either side has no variance."""
    xs = F.when(F.col(y).isNotNull(), F.col(x))
    ys = F.when(F.col(x).isNotNull(), F.col(y))
    return F.try_divide(F.covar_pop(xs, ys), F.stddev_pop(xs) * F.stddev_pop(ys))


def group_corr(df: DataFrame, by: str, measures: Mapping[str, Column],
               pairs: Mapping[str, tuple[str, str]], decimals: int = 3) -> DataFrame:
    """Two-level aggregate: first one row per ``by`` with ``measures`` (e.g. COUNT(*) and
    MAX of attributes constant in the group), then one row of rounded correlations
    ``{name: (x, y)}`` across groups (null pairs skipped)."""
    per = df.groupBy(by).agg(*[c.alias(n) for n, c in measures.items()])
    return per.agg(*[F.round(_safe_corr(x, y), decimals).alias(n) for n, (x, y) in pairs.items()])


def label(flag: Column, when_true: str, otherwise: str) -> Column:
    """Text label of a boolean; false and null share ``otherwise``."""
    return F.when(flag, F.lit(when_true)).otherwise(F.lit(otherwise))


def widget_series(mart: DataFrame, x: str, y: str, *, series: str,
                  rate_of: tuple[str, str] | None = None, decimals: int = 1) -> DataFrame:
    """A chart series: one row per ``x`` with ``SUM(y)``. For a rate, pass
    ``rate_of=(hits, total)``: the series re-derives ``100 * SUM(hits) / SUM(total)`` so
    groups that share an x label combine correctly (summing rates would not)."""
    g = mart.groupBy(F.col(x).cast("string").alias("x"))
    if rate_of:
        h, t = rate_of
        out = g.agg(F.round(F.lit(100.0) * F.sum(h) / F.sum(t), decimals).alias("y"))
    else:
        out = g.agg(F.sum(y).cast("double").alias("y"))
    return out.select(F.lit(series).alias("series"), "x", "y")
