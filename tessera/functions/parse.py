"""Null-safe parsing of raw text columns.

Every parse is total: malformed input gives null, never a failed job (ANSI mode stays on).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


# Integral text with a zero fraction, e.g. "10.0", "-3.", "+7.000" (fixed grammar).
INTEGRAL_TEXT = r"^ *[+-]?[0-9]+(\.0*)? *$"


def to_long(c: ColumnOrName) -> Column:
    """Text -> bigint. Accepted: an optional sign and digits, optionally followed by a point
    and zeros only (``'10'``, ``'10.0'``, ``'-3.'`` -> 10, 10, -3); anything else
    (``'10.5'``, ``'1e3'``, ``'abc'``, ``''``) gives null.

    A plain ``try_cast(x AS BIGINT)`` turns ``'10.0'`` into null (and pays for a failed
    parse on every such row); going through double would round ids above 2^53. Here the
    text is matched first and only the integer part of admitted texts is cast (exact;
    out-of-range -> null).
    """
    x = _c(c)
    whole = F.substring_index(F.trim(x), ".", 1)
    return F.when(x.rlike(INTEGRAL_TEXT), whole.try_cast("bigint"))


def to_int(c: ColumnOrName) -> Column:
    """Text -> int through double: ``'6.0'`` -> 6, ``'6.7'`` -> 6 (truncation), text or
    out-of-range (``'1e12'``) -> null."""
    return _c(c).try_cast("double").try_cast("int")


def to_double(c: ColumnOrName) -> Column:
    return _c(c).try_cast("double")


def to_ts(c: ColumnOrName, fmt: str) -> Column:
    """Text -> timestamp with a datetime pattern; malformed -> null."""
    return F.try_to_timestamp(_c(c), F.lit(fmt))


def flag(c: ColumnOrName, true_text: str = "True") -> Column:
    """Exact-text boolean: ``true_text`` -> true, any other text -> false, null stays null."""
    return _c(c) == F.lit(true_text)


def upper_flag(c: ColumnOrName, text: str = "I") -> Column:
    """Case- and space-insensitive match: ``' i '`` -> true for ``text='I'``; null stays null."""
    return F.upper(F.trim(_c(c))) == F.lit(text.upper())


def clean_text(c: ColumnOrName) -> Column:
    """Strip leading/trailing spaces (spaces only; tabs are kept)."""
    return F.trim(_c(c))


def pad_code(c: ColumnOrName, width: int = 4, pad: str = "0") -> Column:
    """Trim, then left-pad codes shorter than ``width``: ``110`` -> ``0110``, ``''`` -> ``0000``.

    Longer codes are kept whole (``lpad`` alone would cut them and could merge codes);
    :func:`tessera.operators.quality.value_counts` or a rule can report them.
    """
    t = F.trim(_c(c))
    return F.when(F.length(t) < width, F.lpad(t, width, pad)).otherwise(t)


def valid(pred: Column) -> Column:
    """Two-valued view of a predicate: unknown (null) counts as not valid."""
    return F.coalesce(pred, F.lit(False))


def in_box(lat: ColumnOrName, lon: ColumnOrName,
           box: tuple[tuple[float, float], tuple[float, float]]) -> Column:
    """True when (lat, lon) lies in the inclusive box and is not (0, 0); false when either
    coordinate is null or outside."""
    la, lo = _c(lat), _c(lon)
    (lat_lo, lat_hi), (lon_lo, lon_hi) = box
    inside = la.between(lat_lo, lat_hi) & lo.between(lon_lo, lon_hi) & ~((la == 0) & (lo == 0))
    return valid(inside)


def null_unless(c: ColumnOrName, pred: Column) -> Column:
    """Keep the value where ``pred`` holds, null otherwise (the row itself is kept)."""
    return F.when(valid(pred), _c(c))
