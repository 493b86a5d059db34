"""Whole-number vectors, and the one shuffle in which queries meet the entries of a shard.

Shared by the exact vector operators: vectors become integer vectors, equal rows become one
entry with a number of copies, entries are dealt into shards, and every shard gets the
queries that it may answer. A shard's entries are gathered first (at most ``SHARD`` of them
in expectation), its queries then stream past in Arrow batches, so a task's memory depends
on the shard alone, however many queries there are.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.graph import checkpointed
from tessera.llm.ship import ship
from tessera.llm.words import column, release

#: Distinct entries of a shard, at most (in expectation): 64 components of them take 64 MB.
SHARD = 131_072
#: Components beyond it have no exact 64-bit products; the operators refuse them.
LIMIT = 1 << 24


def finite(vector: Column) -> Column:
    """Whether a vector is there and has only finite components."""
    whole = F.forall(vector, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return F.coalesce(vector.isNotNull() & whole, F.lit(False))


def matrix(lists) -> np.ndarray:
    lists = lists.combine_chunks() if isinstance(lists, pa.ChunkedArray) else lists
    n = len(lists)
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(n, -1 if n and len(lists.flatten()) else 0)


def integers(lists, scale: int) -> np.ndarray:
    """floor(scale * x) of every component; a component beyond ``LIMIT`` is an error."""
    x = np.floor(matrix(lists).astype(np.float64) * scale)
    if x.size and np.abs(x).max() > LIMIT:
        raise ValueError(f"a vector has a component beyond {LIMIT} after scaling by {scale}")
    return x.astype(np.int64)


def lists_of(x: np.ndarray) -> pa.ListArray:
    """Rows of a matrix as an Arrow list of 32-bit integers."""
    n, d = x.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * d, pa.int32()),
                                    pa.array(x.ravel().astype(np.int32), pa.int32()))


def rows(df: DataFrame, vec_id: str, vector: str, extra: list[Column] | None = None) -> DataFrame:
    """(vec_id long, v, extra) of rows whose vector is finite; an id that is no whole number becomes null."""
    v = column(vector)
    if df.schema[vector].dataType.simpleString() not in ("array<float>", "array<double>"):
        v = v.cast("array<double>")
    return (df.select(column(vec_id).try_cast("long").alias("vec_id"), v.alias("v"), *(extra or []))
            .where(finite(F.col("v"))))


def frequent_length(found: DataFrame) -> int | None:
    """The most frequent length of ``v`` (the larger of equally frequent ones), None without rows."""
    first = found.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    return None if first is None else first["d"]


def entries(df: DataFrame, dimensions: int, scale: int, extra: tuple[str, ...] = ()) -> DataFrame:
    """(vec_id, *extra, c, size, copies): distinct rows with an id as integer vectors c of one
    length; size is their squared length, copies how often the row is there. Checkpointed."""
    ship(df.sparkSession)
    source = df.where(F.col("vec_id").isNotNull() & (F.size("v") == dimensions)).select("vec_id", *extra, "v")
    kinds = ", ".join(f"{c} {source.schema[c].dataType.simpleString()}" for c in extra)

    def convert(batches):
        for batch in batches:
            x = integers(batch.column(batch.num_columns - 1), scale)
            yield pa.RecordBatch.from_arrays(batch.columns[:-1] + [lists_of(x), pa.array((x * x).sum(1), pa.int64())],
                                             names=["vec_id", *extra, "c", "size"])
        release()

    made = source.mapInArrow(convert, f"vec_id long, {kinds + ', ' if kinds else ''}c array<int>, size long")
    return checkpointed(made.groupBy("vec_id", *extra, "c", "size").agg(F.count(F.lit(1)).alias("copies")))


def shards_for(n: int, shard: int = SHARD) -> int:
    """Shards for ``n`` entries: a square root of them, as many more as ``shard`` asks for.

    Queries are copied once for each shard, so their number grows slower than the entries
    as long as a shard fits a task."""
    return max(1, math.ceil(math.sqrt(n / 64)), -(-n // shard))


def meet(kept: DataFrame, asks: DataFrame, shards: int, index: Callable, answer: Callable, schema: str,
         group: tuple[str, ...] = ()) -> DataFrame:
    """Every query row meets the entries of its shard (and group within it).

    Both frames have ``shard`` and ``group`` columns. ``index(table)`` gets all entries of a
    group, ``answer(index, batch)`` some of its queries and returns a record batch of ``schema``.
    """
    both = kept.withColumn("asks", F.lit(False)).unionByName(asks.withColumn("asks", F.lit(True)), allowMissingColumns=True)
    keys = ["shard", *group]
    placed = both.repartitionById(shards, F.col("shard").cast("int")).sortWithinPartitions(*keys, "asks")

    def run(batches) -> Iterator[pa.RecordBatch]:
        now, held, made = None, [], None
        for batch in batches:
            for key, asking, part in _runs(batch, keys):
                if key != now:
                    now, held, made = key, [], None
                if not asking:
                    held.append(part)
                elif held:
                    if made is None:
                        made = index(pa.Table.from_batches(held))
                    yield answer(made, part)
        release()

    return placed.mapInArrow(run, schema)


def _runs(batch: pa.RecordBatch, keys: list[str]):
    """Consecutive rows of equal keys and kind: (key, whether queries, rows)."""
    n = batch.num_rows
    if not n:
        return
    new = np.zeros(n, bool)
    new[0] = True
    for name in [*keys, "asks"]:
        values = batch.column(batch.schema.get_field_index(name))
        differ = pc.fill_null(pc.not_equal(values.slice(1), values.slice(0, n - 1)), False).to_numpy(zero_copy_only=False)
        void = values.is_null().to_numpy(zero_copy_only=False)
        new[1:] |= differ | (void[1:] != void[:-1])
    begin = np.flatnonzero(new)
    for a, b in zip(begin, np.append(begin[1:], n), strict=True):
        part = batch.slice(a, b - a)
        key = tuple(part.column(part.schema.get_field_index(k))[0].as_py() for k in keys)
        yield key, part.column(part.schema.get_field_index("asks"))[0].as_py(), part


class Products:
    """Exact inner products with the rows of an integer matrix, in the narrowest exact type.

    No sum of products, however grouped, passes the product of two lengths: below 2^24 a
    32-bit float holds all of them, below 2^53 a 64-bit one.
    """

    def __init__(self, x: np.ndarray):
        self.x, self.length = x, math.sqrt(float((x.astype(np.float64) ** 2).sum(1).max())) if len(x) else 0.0
        self._typed: dict[type, np.ndarray] = {}

    def kind(self, q: np.ndarray) -> type:
        most = self.length * math.sqrt(float((q.astype(np.float64) ** 2).sum(1).max())) if len(q) else 0.0
        return np.float32 if most < 2**23 else np.float64 if most < 2**52 else np.int64

    def of(self, q: np.ndarray, rows: np.ndarray | slice | None = None, kind: type | None = None) -> np.ndarray:
        """Products (queries x rows), as whole numbers of ``kind``."""
        kind = kind or self.kind(q)
        if kind not in self._typed:
            self._typed[kind] = self.x.astype(kind)
        x = self._typed[kind]
        return q.astype(kind) @ (x if rows is None else x[rows]).T


def best(score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` highest scores, ties by smaller id, in that order."""
    if len(score) > 4 * k:
        some = np.flatnonzero(score >= np.partition(score, len(score) - k)[len(score) - k])
        return some[np.lexsort((ids[some], -score[some]))[:k]]
    return np.lexsort((ids, -score))[:k]
