"""Global positions without a single-partition window over data of unbounded size.

``row_number() OVER (ORDER BY k)`` and ``ntile(n) OVER (ORDER BY k)`` move the whole table
into one task. That is the best plan for a table whose statistics prove it small; any
other one is numbered in two phases: rows are range-partitioned on the order, each partition
numbers its rows locally, and a per-partition offset (one number per partition, a literal of
the plan) turns local numbers into global ones. Both equal the global window exactly (tested
on random inputs).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.operators.fact import remember_size, row_bytes, size_of
from tessera.session import ensure_checkpoint_dir

_PID, _LOCAL = "_tp_pid", "_tp_local"
#: Input that the plan's own statistics prove to be at most so large is numbered in one task.
ONE_TASK_BYTES = 16 << 20


def _one_task(df: DataFrame) -> bool:
    """Whether the plan bounds its rows: statistics within ``ONE_TASK_BYTES``, and nothing in it
    that makes rows which its statistics do not count."""
    plan = df._jdf.queryExecution().optimizedPlan()
    text = plan.toString()
    if any(node in text for node in ("Generate", "MapIn", "FlatMap", "MapPartitions", "Expand")):
        return False
    return int(str(plan.stats().sizeInBytes())) <= ONE_TASK_BYTES


def _order_cols(order: Sequence[Column | str]) -> list[Column]:
    return [F.col(o).asc_nulls_first() if isinstance(o, str) else o for o in order]


def with_position(df: DataFrame, order: Sequence[Column | str], name: str = "_pos",
                  total: str | None = None, partitions: int | None = None) -> DataFrame:
    """Add ``name`` = 1-based position in the total order ``order`` (nulls first for plain
    names), and optionally ``total`` = number of rows.

    ``order`` must be a total order (append a unique key as last tie-breaker) for the
    positions to be reproducible. A small table (:func:`_one_task`) is a window of one task. Else
    rows are range-partitioned (AQE may merge adjacent ranges; partition ids stay in range
    order), sorted inside each partition, numbered locally and checkpointed to the shared
    folder: offsets and rows read the same written partitions, whatever executor is lost, and
    nothing stays cached. The job that counts the partitions also records the size of the
    result, so a later broadcast check needs no job.
    """
    cols = _order_cols(order)
    if partitions is None and _one_task(df):
        whole = Window.orderBy(*cols)
        out = df.withColumn(name, F.row_number().over(whole).cast("long"))
        return out.withColumn(total, F.count(F.lit(1)).over(Window.partitionBy())) if total else out
    ranged = (df.repartitionByRange(partitions, *cols) if partitions
              else df.repartitionByRange(*cols))
    ranged = ranged.sortWithinPartitions(*cols).withColumn(_PID, F.spark_partition_id())
    # monotonically_increasing_id = (partition index << 33) + row index in the partition
    ranged = ranged.withColumn(
        _LOCAL, F.monotonically_increasing_id() - F.shiftleft(F.col(_PID).cast("long"), 33))
    ensure_checkpoint_dir(df.sparkSession)
    ranged = ranged.checkpoint()
    parts = sorted(ranged.groupBy(_PID).agg(F.count(F.lit(1)).alias("n"),
                                            F.sum(row_bytes(df)).alias("b")).collect())
    rows, size, starts = 0, 0, {}
    for p in parts:
        starts[p[_PID]] = rows
        rows, size = rows + p["n"], size + p["b"]
    # by partition id; a partition without rows is never asked
    offsets = F.array(*[F.lit(starts.get(i, 0)).cast("long") for i in range(max(starts, default=0) + 1)])
    out = ranged.withColumn(name, F.element_at(offsets, F.col(_PID) + 1) + F.col(_LOCAL) + 1)
    if total:
        out = out.withColumn(total, F.lit(rows).cast("long"))
    return remember_size(out.drop(_PID, _LOCAL), rows, size + 16 * rows)


def _sized_like(src: DataFrame, out: DataFrame, more: int = 0) -> DataFrame:
    """A projection, or a few more rows, keeps the size recorded for its source."""
    size = size_of(src)
    return remember_size(out, size[0] + more, size[1] + 256 * more) if size else out


def with_surrogate_key(df: DataFrame, order: Sequence[Column | str], name: str,
                       key_type: str = "int") -> DataFrame:
    """Surrogate key = ``row_number()`` over the global order, computed at scale.

    More members than ``key_type`` can number raise an error (ANSI cast): pass ``long``.
    """
    out = with_position(df, order, name)
    return _sized_like(out, out.withColumn(name, F.col(name).cast(key_type)))


def ntile_of(pos: Column, total: Column, n: int) -> Column:
    """``ntile(n)`` from a 1-based position and the row count: with ``q = total div n`` and
    ``r = total mod n`` the first ``r`` tiles hold ``q + 1`` rows, the others ``q``."""
    q = F.floor(total / n)
    r = total - q * n
    big = r * (q + 1)
    return (F.when(pos <= big, F.floor((pos - 1) / (q + 1)) + 1)
            .otherwise(r + F.floor((pos - big - 1) / q) + 1)).cast("int")


def with_ntiles(df: DataFrame, specs: dict[str, tuple[int, Sequence[Column | str]]]) -> DataFrame:
    """Add one ntile column per spec ``name -> (n, order)``; nulls sort first, as in
    ``ntile(n) OVER (ORDER BY x)``. A small table is read once for all specs. Else each spec
    of plain column names finds the borders of its tiles in a ranged pass over its order
    columns alone, and one pass over ``df`` compares rows with the borders of all specs; other
    orders are a ranged pass of whole rows each."""
    if _one_task(df):
        return df.withColumns({name: F.ntile(n).over(Window.orderBy(*_order_cols(order))) for name, (n, order) in specs.items()})
    named = [df.schema[o].dataType for _, order in specs.values() for o in order if isinstance(o, str)]
    if len(named) == sum(len(order) for _, order in specs.values()) and all(isinstance(t, _BORDER_TYPES) for t in named):
        return df.withColumns({name: _tile_by_borders(df, n, list(order)) for name, (n, order) in specs.items()})
    out = df
    for name, (n, order) in specs.items():
        at = with_position(out, order, "_nt_pos", total="_nt_total")
        tiled = at.withColumn(name, ntile_of(F.col("_nt_pos"), F.col("_nt_total"), n))
        out = _sized_like(at, tiled.drop("_nt_pos", "_nt_total"))
    return out


#: Types whose values come back from the driver as they were.
_BORDER_TYPES = (T.IntegralType, T.FractionalType, T.StringType, T.BooleanType, T.DateType)


def _tile_by_borders(df: DataFrame, n: int, order: list[str]) -> Column:
    """Number of the tile: 1 + the borders (first rows of the tiles 2, 3, ...) at or before a row."""
    at = with_position(df.select(*order), order, "_nt_pos", total="_nt_total", partitions=None)
    tiled = at.withColumn("_tile", ntile_of(F.col("_nt_pos"), F.col("_nt_total"), n))
    # the first row of a tile: n - 1 of them
    q, r = F.floor(F.col("_nt_total") / n), F.col("_nt_total") % n
    before = (F.col("_tile") - 1) * q + F.least(F.col("_tile") - 1, r)
    borders = tiled.where((F.col("_nt_pos") == before + 1) & (F.col("_tile") > 1)).orderBy("_nt_pos").select(*order).collect()
    row = F.struct(*[F.col(c) for c in order])
    tile = F.lit(1)
    for b in borders:
        border = F.struct(*[F.lit(b[c]).cast(df.schema[c].dataType).alias(c) for c in order])
        tile = tile + (row >= border).cast("int")
    return tile


def with_ntile(df: DataFrame, n: int, order: Sequence[Column | str], name: str) -> DataFrame:
    return with_ntiles(df, {name: (n, order)})


def with_unknown(df: DataFrame, values: dict[str, object]) -> DataFrame:
    """Append the "unknown" member: one row with the given values and typed nulls elsewhere."""
    spark = df.sparkSession
    row = tuple(values.get(f.name) for f in df.schema.fields)
    schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in df.schema.fields])
    unknown = spark.createDataFrame([row], schema)
    return _sized_like(df, df.unionByName(unknown), more=1)
