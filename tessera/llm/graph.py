"""Connected components and id joins, shared by operators on pairs."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Ids (8 bytes each) that may be broadcast to filter a wide table; beyond it both sides are shuffled.
BROADCAST_IDS = 2_000_000


def shared_folder(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir`` that all executors share.

    It is read from the session; a temporary one is set only where none is, on a local master.
    """
    context = spark.sparkContext
    now = context._jsc.sc().getCheckpointDir()
    if now.isDefined():
        return now.get()
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
    if not folder:
        if not context.master.startswith("local[") and context.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="tessera-checkpoint-")
    context.setCheckpointDir(folder)
    return context._jsc.sc().getCheckpointDir().get()


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint in the shared folder."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


def join_ids(df: DataFrame, key, ids: DataFrame, how: str, most: int = BROADCAST_IDS) -> DataFrame:
    """``df`` joined (semi or anti) on ``key`` with the one column of distinct ``ids``.

    ``ids`` must be cheap to count (checkpointed): up to ``most`` of them are broadcast, so
    the wide side is not shuffled; more are joined by a shuffle of both sides.
    """
    name = ids.columns[0]
    side = F.broadcast(ids) if ids.count() <= most else ids
    return df.join(side, key == side[name], how)


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of ``edges`` (a, b): root is the smallest node of its component.

    Alternating large-star and small-star contraction: every round hangs the neighbours of a
    node under its smallest neighbour, until only stars are left. A round is two
    aggregations and two equi-joins over at most the first round's number of edges.
    """
    now = checkpointed(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                       .where("a <> b").distinct())
    state = _state(now)
    while True:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = (both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .where("a <> b").distinct())
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(least, "a").select(F.explode(F.array(F.struct(F.col("a"), F.col("m").alias("b")),
                                                                 F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e"))
                 .select("e.a", "e.b").where("a <> b").distinct())
        now = checkpointed(small)
        new = _state(now)
        if new == state:
            break
        state = new
    roots = now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)


def _state(edges: DataFrame):
    """Number and order-free digest of the edges."""
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b") % F.lit(1 << 31)),
                           F.sum(F.xxhash64("b", "a") % F.lit(1 << 31))).first())
