"""Hard-negative mining with segment summaries.

An anchor's positives are its best entries of the same label; its hard negatives for one
positive are the best entries of other labels whose score lies in a window below the
positive's. Scores are inner products of whole numbers.

Every entry carries summaries of its segments: the mean of each and its deviation. The
product of two segments is the product of their means, give or take the product of their
deviations (times the length), so the sums over segments bound a score from both sides. The
bounds are taken over one segment first, then over 4 and over 16; only entries whose bounds
still reach a window are refined, and only those that pass the last level are scored exactly.

Positives are searched among the entries of one label, dealt into salted shards where a label
is large. Negatives are searched in all shards, in two passes: a few shards first, whose k-th
best scores are floors that the windows of the second pass start from.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.graph import checkpointed
from tessera.llm.vectors import SHARD, Products, best, entries, frequent_length, matrix, meet, rows, shards_for
from tessera.llm.words import column

POSITIVES, NEGATIVES, LOW, HIGH, SCALE = 5, 10, 30, 90, 256
LEVELS = (1, 4, 16)
#: Above this share of open pairs a level is one matrix product for all of them.
DENSE = 0.2
#: Scores computed at once.
TILE = 1 << 21
_EMPTY = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


class _Level:
    """Means and deviations of equal segments, times the root of the segment's length."""

    def __init__(self, x: np.ndarray, segments: int):
        begin = np.unique(np.linspace(0, x.shape[1], segments, endpoint=False).astype(int))
        length = np.diff(np.append(begin, x.shape[1])).astype(np.float64)
        total = np.add.reduceat(x, begin, axis=1).astype(np.float64)
        square = np.add.reduceat(x * x, begin, axis=1).astype(np.float64)
        self.mean = total / np.sqrt(length)
        self.deviation = np.sqrt(np.maximum(square - total * total / length, 0.0))

    def bounds(self, of: _Level, i, at=slice(None)):
        """Middle and radius of the scores of rows ``i`` of another level with rows ``at``."""
        return of.mean[i] @ self.mean[at].T, of.deviation[i] @ self.deviation[at].T


class Segments:
    """Integer vectors with their summaries, scored against queries within windows."""

    def __init__(self, x: np.ndarray):
        self.products = Products(x)
        self.levels = [_Level(x, s) for s in LEVELS if s <= x.shape[1]]
        self.refined = np.zeros(len(self.levels) + 1, np.int64)
        self._idle: set[int] = set()

    def within(self, q: np.ndarray, low: np.ndarray, high: np.ndarray, open_: np.ndarray | None = None):
        """Per query, places and scores of rows with low <= score <= high, of those ``open_``."""
        n = self.products.x.shape[0]
        asked = [_Level(q, s) for s in LEVELS if s <= q.shape[1]]
        kind = self.products.kind(q)
        # against rounding in the sums: both lengths bound what is added up
        slack = 1e-9 * (1 + self.products.length * np.sqrt((q.astype(np.float64) ** 2).sum(1)))
        if open_ is None:
            open_ = np.ones((len(q), n), bool)
        for number, (level, of) in enumerate(zip(self.levels, asked, strict=True)):
            before = int(open_.sum())
            if not before or number in self._idle:
                continue
            self.refined[number] += before
            if before > DENSE * open_.size:
                middle, radius = level.bounds(of, slice(None))
                open_ &= (middle + radius >= (low - slack)[:, None]) & (middle - radius <= (high + slack)[:, None])
            else:
                for i in np.flatnonzero(open_.any(1)):
                    at = np.flatnonzero(open_[i])
                    middle, radius = level.bounds(of, i, at)
                    open_[i, at] = (middle + radius >= low[i] - slack[i]) & (middle - radius <= high[i] + slack[i])
            if int(open_.sum()) > 0.95 * before:
                self._idle.add(number)  # rules out next to nothing here: later queries go on without it
        left = int(open_.sum())
        self.refined[-1] += left
        if left > DENSE * open_.size:
            score = self.products.of(q, None, kind)
            open_ &= (score >= low[:, None]) & (score <= high[:, None])
            for i in range(len(q)):
                at = np.flatnonzero(open_[i])
                yield at, score[i, at].astype(np.int64)
        else:
            for i in range(len(q)):
                at = np.flatnonzero(open_[i])
                score = self.products.of(q[i:i + 1], at, kind)[0].astype(np.int64)
                inside = (score >= low[i]) & (score <= high[i])
                yield at[inside], score[inside]


class _Shard:
    """Entries of a shard in order of their label."""

    def __init__(self, table: pa.Table):
        label = table["label"].combine_chunks().dictionary_encode()
        code = label.indices.to_numpy()
        by = np.lexsort((table["vec_id"].to_numpy(), code))
        self.ids, self.copies = table["vec_id"].to_numpy()[by], table["copies"].to_numpy()[by]
        self.labels = {v: i for i, v in enumerate(label.dictionary.to_pylist())}
        edge = np.searchsorted(code[by], np.arange(len(self.labels) + 1))
        self.edge = edge
        self.segments = Segments(matrix(table["c"]).astype(np.int64)[by])

    def own(self, label) -> slice:
        """Entries of a label."""
        i = self.labels.get(label)
        return slice(0, 0) if i is None else slice(int(self.edge[i]), int(self.edge[i + 1]))


def _columns(part: pa.RecordBatch) -> dict:
    return {name: part.column(i) for i, name in enumerate(part.schema.names)}


def _tiles(n: int, size: int):
    step = max(1, TILE // max(1, size))
    return [slice(i, min(i + step, n)) for i in range(0, n, step)]


def _positives(k: int):
    """Best entries of a shard of the anchors' own label."""

    def answer(shard: _Shard, part: pa.RecordBatch) -> pa.RecordBatch:
        of = _columns(part)
        own, q, keys = of["vec_id"].to_numpy(), matrix(of["c"]).astype(np.int64), of["key"].to_numpy()
        n = len(shard.ids)
        # some entries set a floor that the others have to pass
        sample = slice(0, min(n, 64 * k))
        out = []
        for tile in _tiles(len(q), n):
            some = shard.segments.products.of(q[tile], sample).astype(np.float64)
            some[shard.ids[None, sample] == own[tile, None]] = -np.inf
            floor = np.full(len(some), -np.inf)
            if some.shape[1] >= k:
                floor = np.partition(some, some.shape[1] - k, axis=1)[:, some.shape[1] - k]
            found = shard.segments.within(q[tile], floor, np.full(len(some), np.inf),
                                          shard.ids[None, :] != own[tile, None])
            for key, (at, score) in zip(keys[tile], found, strict=True):
                top = best(score, shard.ids[at], k)
                out.append((np.full(len(top), key), at[top], score[top]))
        key, at, score = (np.concatenate(c) for c in zip(*out, strict=True))
        return pa.RecordBatch.from_arrays(
            [pa.array(key), pa.array(shard.ids[at]), pa.array(np.minimum(shard.copies[at], k)), pa.array(score)],
            names=["key", "vec_id", "copies", "score"])
    return answer


def _negatives(k: int):
    """Best entries of other labels in the windows of every positive."""

    def answer(shard: _Shard, part: pa.RecordBatch) -> pa.RecordBatch:
        of = _columns(part)
        own, q, keys = of["vec_id"].to_numpy(), matrix(of["c"]).astype(np.int64), of["key"].to_numpy()
        labels = of["label"].to_pylist()
        lows, highs = of["lows"].to_pylist(), of["highs"].to_pylist()
        low, high = (np.array([f(w) for w in ws], np.float64) for f, ws in ((min, lows), (max, highs)))
        out = []
        for tile in _tiles(len(q), len(shard.ids)):
            open_ = shard.ids[None, :] != own[tile, None]
            for i in range(tile.start, tile.stop):
                open_[i - tile.start, shard.own(labels[i])] = False
            for i, (at, score) in enumerate(shard.segments.within(q[tile], low[tile], high[tile], open_), tile.start):
                by = np.lexsort((shard.ids[at], -score))
                at, score = at[by], score[by]
                for p, (a, b) in enumerate(zip(lows[i], highs[i], strict=True)):
                    first, last = np.searchsorted(-score, [-b, -a + 1])
                    last = min(last, first + k)
                    if last > first:
                        out.append((np.full(last - first, keys[i]), np.full(last - first, p), at[first:last], score[first:last]))
        key, p, at, score = (np.concatenate(c) for c in zip(*out, strict=True)) if out else [np.zeros(0, np.int64)] * 4
        return pa.RecordBatch.from_arrays(
            [pa.array(key), pa.array(p.astype(np.int32)), pa.array(shard.ids[at]), pa.array(np.minimum(shard.copies[at], k)),
             pa.array(score)], names=["key", "p", "vec_id", "copies", "score"])
    return answer


def _ranked(found: DataFrame, by: list[str], k: int) -> DataFrame:
    """The ``k`` best of every key, copies counted each."""
    each = found.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))).drop("copies", "copy")
    rank = F.row_number().over(Window.partitionBy(*by).orderBy(F.desc("score"), "vec_id"))
    return each.withColumn("rank", rank).where(F.col("rank") <= k)


def _hundredth(score: Column) -> Column:
    """floor(score / 100)"""
    return ((score - F.pmod(score, F.lit(100).cast("long"))) / 100).cast("long")


def mine(vectors: DataFrame, anchors: DataFrame, n_positives: int = POSITIVES, k: int = NEGATIVES, low: int = LOW, high: int = HIGH,
         scale: int = SCALE, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label",
         shard: int = SHARD) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    A component x counts as floor(scale * x); a score is the inner product with the anchor,
    higher ones come first, ties by smaller id. Positives are the first ``n_positives`` rows of
    the anchor's label, negatives for a positive the first ``k`` rows of other labels with
    low * positive <= 100 * score <= high * positive; all, where there are fewer. ``anchors``
    has the columns of ``vectors``. Rows with the anchor's own id are neither to it. A repeated
    anchor row is answered as often as it is there, a repeated positive or negative is one each.
    Rows without a label or an id (or with one that is no whole number), vectors that are null,
    hold null or non-finite components, or differ from the most frequent length (the larger of
    equally frequent ones) take no part. Scaled components beyond 2^24 are an error.
    """
    spark = vectors.sparkSession
    labelled = column(label).cast("string").alias("label")
    found = rows(vectors, vec_id, vector, [labelled]).where(F.col("label").isNotNull())
    dimensions = frequent_length(found)
    if not dimensions:
        return spark.createDataFrame([], _EMPTY)
    kept = entries(found, dimensions, scale, ("label",)).drop("size")
    asked = entries(rows(anchors, vec_id, vector, [labelled]).where(F.col("label").isNotNull()), dimensions, scale, ("label",))
    asked = (asked.drop("size").withColumnRenamed("copies", "times").withColumn("key", F.monotonically_increasing_id()))
    n = kept.count()
    shards = shards_for(n, shard)
    per = -(-n // shards) if n else 1

    # a label of more than a shard is salted: at most ``shards`` labels are that large
    large = (kept.groupBy("label").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > per)
             .select("label", F.ceil(F.col("n") / per).cast("int").alias("salts")))
    salts = F.coalesce("salts", F.lit(1))

    def placed(df, salt):
        df = df.join(F.broadcast(large), "label", "left").withColumn("salt", salt).drop("salts")
        return df.withColumn("shard", F.pmod(F.xxhash64("label", "salt"), F.lit(shards)).cast("int"))

    same = meet(placed(kept, F.pmod(F.xxhash64("vec_id", "c"), salts).cast("int")),
                placed(asked, F.explode(F.sequence(F.lit(0), salts - 1))), shards, _Shard, _positives(n_positives),
                "key long, vec_id long, copies long, score long", ("label", "salt"))
    # of the few positives of an anchor: windows of whole scores, empty below a negative one
    best_of = (_ranked(same, ["key"], n_positives).groupBy("key")
               .agg(F.array_sort(F.collect_list(F.struct("rank", "vec_id", "score"))).alias("p"))
               .withColumn("p", F.transform("p", lambda s: F.struct(
                   s["vec_id"].alias("id"), s["score"].alias("score"), (-_hundredth(-s["score"] * low)).alias("low"),
                   _hundredth(s["score"] * high).alias("high")))))
    asks = checkpointed(asked.join(best_of, "key").where(F.exists("p", lambda s: s["low"] <= s["high"])))
    asks = asks.withColumn("lows", F.transform("p", lambda s: s["low"])).withColumn("highs", F.transform("p", lambda s: s["high"]))

    dealt = kept.withColumn("shard", F.pmod(F.xxhash64("vec_id", "label", "c"), F.lit(shards)).cast("int"))
    seeds = math.ceil(math.sqrt(shards))
    to_ask = asks.drop("p", "times")
    schema = "key long, p int, vec_id long, copies long, score long"
    first = to_ask.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(seeds - 1))))
    seen = checkpointed(_ranked(meet(dealt.where(F.col("shard") < seeds), first, seeds, _Shard, _negatives(k), schema), ["key", "p"], k))
    if shards > seeds:
        floors = (seen.where(F.col("rank") == k).groupBy("key")
                  .agg(F.map_from_entries(F.collect_list(F.struct("p", "score"))).alias("floor")))
        # element i of the windows belongs to positive i
        raised = F.transform("lows", lambda a, i: F.greatest(a, F.coalesce(F.try_element_at("floor", i), a)))
        rest = (to_ask.join(floors, "key", "left").withColumn("lows", raised).drop("floor")
                .withColumn("shard", F.explode(F.sequence(F.lit(seeds), F.lit(shards - 1)))))
        more = meet(dealt.where(F.col("shard") >= seeds), rest, shards, _Shard, _negatives(k), schema)
        seen = _ranked(seen.select("key", "p", "vec_id", F.lit(1).cast("long").alias("copies"), "score").unionByName(more), ["key", "p"], k)
    told = asks.select("key", F.col("vec_id").alias("anchor_id"), "times", F.posexplode("p").alias("p", "positive"))
    return (seen.join(told, ["key", "p"]).withColumn("time", F.explode(F.sequence(F.lit(1).cast("long"), F.col("times"))))
            .select("anchor_id", F.col("positive.id").alias("positive_id"), "rank", F.col("vec_id").alias("negative_id"),
                    F.col("positive.score").alias("positive_score"), F.col("score").alias("negative_score")))
