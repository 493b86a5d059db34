"""Incremental maintenance: a landed increment is merged into cleaned rows, dimensions, facts and
additive marts, without rebuilding them.

Rows that share no key with the increment stay as they are. Where it brings another version of
a key, the newest version wins as in a full cleaning; an additive mart retracts what the old
version added and adds the new one; facts of touched keys are replaced. A dimension keeps its
keys and numbers new members after the largest one, so facts written before stay valid.

The increment is taken to be much smaller than what it is merged into: its keys are
broadcast while they are known to be small (:func:`tessera.operators.fact.broadcast_checked`), so
the large side is filtered and not shuffled. Versions of a larger increment meet those they
replace in one shuffle of both sides.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.operators.clean import CleanSpec, dedupe, drop_rows, hashed, hot_rows, survivors_of, total_order
from tessera.operators.fact import broadcast_checked, fits_broadcast, measured
from tessera.operators.keys import with_position
from tessera.session import ensure_checkpoint_dir


@dataclass
class Merged:
    """Newest versions after an increment: ``untouched`` rows, the versions that the touched
    keys had (``old``) and have now (``new``)."""

    untouched: DataFrame
    old: DataFrame
    new: DataFrame

    @property
    def rows(self) -> DataFrame:
        return self.untouched.unionByName(self.new)


def merge_versions(survivors: DataFrame, increment: DataFrame, spec: CleanSpec) -> Merged:
    """Merge typed rows of an increment into the survivors of earlier loads.

    ``survivors`` holds one row per key of ``spec`` (:func:`survivors_of`), before its later rules,
    with all columns that order versions. Rows of the increment that fail the rules before the
    dedupe touch nothing. The result equals ``survivors_of`` over all loads.
    """
    ensure_checkpoint_dir(survivors.sparkSession)
    keys = list(spec.keys)
    passed = drop_rows(increment, spec.pre)
    if hashed(passed, keys) and not fits_broadcast(measured(passed.select(*keys))):
        return _merged_at_once(survivors, passed, spec)
    landed = survivors_of(increment, spec).checkpoint()  # one version a key is enough
    touched = broadcast_checked(measured(landed.select(*keys)))
    same = [F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}")) for k in keys]
    old = survivors.alias("a").join(touched.alias("b"), same, "left_semi")
    untouched = survivors.alias("a").join(touched.alias("b"), same, "left_anti")
    old = old.checkpoint()
    return Merged(untouched, old, survivors_of(old.unionByName(landed), spec).checkpoint())


def _merged_at_once(survivors: DataFrame, passed: DataFrame, spec: CleanSpec) -> Merged:
    """:func:`merge_versions` of an increment whose keys are many: all versions of a key meet in one
    shuffle (those of a hot key of the increment are reduced before it)."""
    keys, columns = list(spec.keys), survivors.columns
    order = list(spec.order) if spec.order else total_order(survivors, keys)
    hot = hot_rows(passed, keys)
    if hot is not None:
        passed = dedupe(passed.where(hot), keys, order).unionByName(passed.where(~hot))
    both = survivors.withColumn("_landed", F.lit(False)).unionByName(passed.select(*columns).withColumn("_landed", F.lit(True)))
    key = Window.partitionBy(*keys)
    ranked = both.withColumns({"_touched": F.max("_landed").over(key), "_rank": F.row_number().over(key.orderBy(*order))})
    kept = ranked.where(F.col("_touched") & ((F.col("_rank") == 1) | ~F.col("_landed"))).drop("_touched").checkpoint()
    new = kept.where(F.col("_rank") == 1).select(*columns)
    same = [F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}")) for k in keys]
    touched = broadcast_checked(measured(new.select(*keys)))
    untouched = survivors.alias("a").join(touched.alias("b"), same, "left_anti")
    return Merged(untouched, kept.where(~F.col("_landed")).select(*columns), new)


def additive(rows: DataFrame, by: Sequence[str], sums: Mapping[str, Column], sign: int = 1) -> DataFrame:
    """Groups with their number of rows ``n`` and sums, all times ``sign``."""
    return rows.groupBy(*by).agg((F.count(F.lit(1)) * sign).alias("n"),
                                 *[(F.coalesce(F.sum(c), F.lit(0)) * sign).alias(name) for name, c in sums.items()])


def maintain(mart: DataFrame, old: DataFrame, new: DataFrame, by: Sequence[str], sums: Mapping[str, Column]) -> DataFrame:
    """An :func:`additive` mart after ``old`` rows left and ``new`` ones came; a group without rows goes."""
    changed = mart.unionByName(additive(old, by, sums, -1)).unionByName(additive(new, by, sums))
    return (changed.groupBy(*by).agg(F.sum("n").alias("n"), *[F.sum(c).alias(c) for c in sums])
            .where(F.col("n") != 0))


def extend_dim(dim: DataFrame, fresh: DataFrame, natural: str, key: str) -> DataFrame:
    """``dim`` with the members that only ``fresh`` (the same columns, its own keys) has, numbered
    after the largest key in the order of ``natural``. Members that are there keep key and
    attributes."""
    unseen = fresh.where(F.col(natural).isNotNull()).join(broadcast_checked(dim.select(natural), basis=dim), natural, "left_anti")
    last = dim.agg(F.coalesce(F.max(key), F.lit(0)).alias("_last"))
    numbered = with_position(unseen, [natural], "_pos").crossJoin(F.broadcast(last))
    numbered = numbered.withColumn(key, (F.greatest(F.col("_last"), F.lit(0)) + F.col("_pos")).cast(dim.schema[key].dataType))
    return dim.unionByName(numbered.select(*dim.columns))


def replace_facts(fact: DataFrame, old_ids: DataFrame, new_facts: DataFrame, key: str = "id") -> DataFrame:
    """Facts without those of ``old_ids`` (a column ``key``), and the new ones."""
    gone = broadcast_checked(measured(old_ids.select(key)))
    return fact.join(gone, key, "left_anti").select(*fact.columns).unionByName(new_facts)
