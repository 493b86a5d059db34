"""Typing, filtering, dedupe and the drop audit.

A cleaning step is a :class:`Rule` (keep rows where the predicate is true; unknown counts
as false) or the dedupe of a key. Rules run in order, so each dropped row is charged to the
first rule it fails; all counts for the audit come from aggregates, never from one
``count()`` job per step.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.parse import valid
from tessera.operators.fact import bytes_of, hot_values
from tessera.operators.packed import pack_texts, unpack_texts

#: A table that its statistics prove to be at most so large is deduplicated as it is read.
SMALL_BYTES = 16 << 20
#: Types whose equal values have equal hashes.
_HASHED = (T.IntegralType, T.StringType, T.DateType, T.TimestampType, T.TimestampNTZType, T.BooleanType)


@dataclass(frozen=True)
class Rule:
    """Keep rows where ``keep`` is true; a null ``keep`` drops the row."""

    name: str
    keep: Column


def project(df: DataFrame, spec: Mapping[str, Column | str]) -> DataFrame:
    """Fixed output list and order: ``{out_name: expression or source column}``.

    Columns not named are dropped (raw-only fields, a CSV index column, ...)."""
    return df.select(*[(F.col(v) if isinstance(v, str) else v).alias(k) for k, v in spec.items()])


def drop_index_column(df: DataFrame) -> DataFrame:
    """Drop the first column when it is an unnamed CSV index (``_c0``, empty, ``Unnamed: 0``),
    under its raw or its normalized name."""
    first = df.columns[0]
    if first.strip().lower() in ("_c0", "", "unnamed: 0", "unnamed:_0"):
        return df.drop(first)
    return df


def drop_rows(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Keep rows passing every rule (three-valued logic resolved to false)."""
    out = df
    for r in rules:
        out = out.where(valid(r.keep))
    return out


def first_failed(rules: Sequence[Rule]) -> Column:
    """Name of the first rule the row fails, null when it passes all."""
    if not rules:
        return F.lit(None).cast("string")
    return F.coalesce(*[F.when(~valid(r.keep), F.lit(r.name)) for r in rules])


def total_order(df: DataFrame, keys: Sequence[str], first: Sequence[Column] = ()) -> list[Column]:
    """``first`` then every non-key column ascending (nulls first): a total order inside
    each key, so the survivor of a dedupe is defined and reproducible."""
    rest = [F.col(c).asc_nulls_first() for c in df.columns if c not in keys]
    return list(first) + rest


def dedupe(df: DataFrame, keys: Sequence[str], order: Sequence[Column] | None = None,
           parts: int | None = None) -> DataFrame:
    """One row per key: the first in ``order`` (default: all other columns ascending).

    Rows are dealt by key and then sorted, once: sorting them below the exchange as well, to keep
    only the first row per key of each task, spills whole rows to disk and removes few unless a
    key is hot. So one pass over the keys alone finds the hot ones (:func:`hot_values`), and only
    their rows are reduced map-side (``row_number() = 1``, WindowGroupLimit). A table that is
    known to be small takes that way as a whole, without the pass.

    ``parts`` deals the rows by key into so many partitions, once, so a write into as many buckets
    of the key needs no exchange of its own (``save(dealt=True)``). Their texts are dealt as one
    (:func:`pack_texts`).
    """
    order = list(order) if order is not None else total_order(df, keys)
    w = Window.partitionBy(*keys).orderBy(*order)

    def first(rows: DataFrame) -> DataFrame:
        return (rows.withColumn("_dd_rn", F.row_number().over(w)).where(F.col("_dd_rn") == 1)
                .drop("_dd_rn"))
    if parts is not None:
        hot = hot_rows(df, keys) if hashed(df, keys) and bytes_of(df) > SMALL_BYTES else None
        rows = df if hot is None else first(df.where(hot)).unionByName(df.where(~hot))
        dealt = pack_texts(rows, list(keys)).repartition(parts, *keys)
        return first(unpack_texts(dealt, rows, list(keys)))
    if not hashed(df, keys) or bytes_of(df) <= SMALL_BYTES:
        return first(df)
    hot = hot_rows(df, keys)
    if hot is None:
        return first(df.repartition(*keys))
    return first(df.where(hot)).unionByName(first(df.where(~hot).repartition(*keys)))


def hashed(df: DataFrame, keys: Sequence[str]) -> bool:
    """Whether equal keys have equal hashes."""
    return all(isinstance(df.schema[k].dataType, _HASHED) for k in keys)


def hot_rows(df: DataFrame, keys: Sequence[str]) -> Column | None:
    """Condition of the rows that may have a hot key (one pass over the keys); None without any."""
    key = F.xxhash64(*keys)
    hot = hot_values(df.select(key.alias("_dd_key")), "_dd_key")
    return key.isin(hot) if hot else None


@dataclass(frozen=True)
class CleanSpec:
    """A cleaning plan: ``pre`` rules, then dedupe on ``keys`` with ``order``, then ``post``
    rules, then column ``nulling`` (value kept only where its predicate holds)."""

    table: str
    pre: tuple[Rule, ...] = ()
    keys: tuple[str, ...] = ()
    order: tuple[Column, ...] | None = None
    post: tuple[Rule, ...] = ()
    nulling: tuple[tuple[str, Column], ...] = ()
    dedupe_step: str = "duplicate key"


def apply_clean(df: DataFrame, spec: CleanSpec) -> DataFrame:
    """Run the plan lazily and return the cleaned rows."""
    out = drop_rows(survivors_of(df, spec), spec.post)
    return null_columns(out, spec)


def null_columns(out: DataFrame, spec: CleanSpec) -> DataFrame:
    """Apply the ``nulling`` of ``spec`` (predicates read the original values)."""
    if spec.nulling:
        # evaluate every predicate on the original values before any column is nulled
        preds = {f"_nl_{i}": valid(p) for i, (_, p) in enumerate(spec.nulling)}
        out = out.withColumns(preds)
        out = out.withColumns({c: F.when(F.col(f"_nl_{i}"), F.col(c))
                               for i, (c, _) in enumerate(spec.nulling)})
        out = out.drop(*preds)
    return out


def survivors_of(df: DataFrame, spec: CleanSpec, parts: int | None = None) -> DataFrame:
    """Rows left after the ``pre`` rules and the dedupe (before the ``post`` rules), dealt by the
    keys into ``parts`` partitions if given."""
    out = drop_rows(df, spec.pre)
    if spec.keys:
        out = dedupe(out, list(spec.keys), list(spec.order) if spec.order else None, parts)
    return out


def audit(df: DataFrame, spec: CleanSpec, flags: Mapping[str, Column] | None = None,
          survivors: DataFrame | None = None) -> DataFrame:
    """Drop audit of :func:`apply_clean`: one row per step with ``table, step_order, step,
    before, removed, after, flagged``; ``flags`` adds rows that count rows changed but kept
    (e.g. coordinates nulled) in ``flagged``.

    Cost: one aggregate over the input (count and first failed ``pre`` rule) and one over
    the dedupe survivors (pass ``survivors`` when they are already materialized, e.g. as a
    written table, to avoid a second dedupe shuffle). The two one-row results are combined
    by a union and a ``max``, never by a join.
    """
    flags = dict(flags or {})
    pre_reason = first_failed(spec.pre)
    head = df.agg(F.count(F.lit(1)).alias("n"),
                  *[F.count_if(pre_reason == F.lit(r.name)).alias(f"pre{i}")
                    for i, r in enumerate(spec.pre)],
                  F.count_if(pre_reason.isNull()).alias("kept"))
    surv = survivors if survivors is not None else survivors_of(df, spec)
    post_reason = first_failed(spec.post)
    post_ok = post_reason.isNull()
    tail = surv.agg(F.count(F.lit(1)).alias("surv"),
                    *[F.count_if(post_reason == F.lit(r.name)).alias(f"post{i}")
                      for i, r in enumerate(spec.post)],
                    *[F.count_if(post_ok & ~valid(pred)).alias(f"flag{j}")
                      for j, pred in enumerate(flags.values())])
    both = head.unionByName(tail, allowMissingColumns=True)
    one = both.agg(*[F.max(c).alias(c) for c in both.columns])

    # stacked to (step_order, step, signed delta); a running sum over steps gives `after`
    rows = [("0", "'input'", "n")]
    rows += [(str(i + 1), _lit(r.name), f"-pre{i}") for i, r in enumerate(spec.pre)]
    base = len(spec.pre) + 1
    if spec.keys:
        rows.append((str(base), _lit(spec.dedupe_step), "-(kept - surv)"))
    rows += [(str(base + 1 + i), _lit(r.name), f"-post{i}") for i, r in enumerate(spec.post)]
    nsteps = len(rows)
    rows += [(str(base + 1 + len(spec.post) + j), _lit(name), f"flag{j}")
             for j, name in enumerate(flags)]
    body = ", ".join(f"{o}, {s}, CAST({v} AS BIGINT)" for o, s, v in rows)
    parts = one.selectExpr(f"stack({len(rows)}, {body}) AS (step_order, step, delta)")
    parts = parts.withColumn("kind", F.when(F.col("step_order") < nsteps, "step").otherwise("flag"))
    # a handful of rows: the un-partitioned window runs over steps, not data
    w = Window.orderBy("step_order").rowsBetween(Window.unboundedPreceding, 0)
    is_step = F.col("kind") == "step"
    running = F.sum(F.when(is_step, F.col("delta")).otherwise(0)).over(w)
    return parts.select(
        F.lit(spec.table).alias("table"), F.col("step_order").cast("int").alias("step_order"),
        "step",
        F.when(F.col("step_order") == 0, F.lit(None).cast("bigint"))
         .when(is_step, running - F.col("delta")).otherwise(running).alias("before"),
        F.when(F.col("step_order") == 0, F.lit(0).cast("bigint"))
         .when(is_step, -F.col("delta")).otherwise(F.lit(0).cast("bigint")).alias("removed"),
        running.alias("after"),
        F.when(is_step, F.lit(None).cast("bigint")).otherwise(F.col("delta")).alias("flagged"),
    )


def _lit(s: str) -> str:
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"
