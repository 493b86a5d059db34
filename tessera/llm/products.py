"""Exact top-k search by inner product in buckets of vector length.

Entries are grouped by their length, longest first, and large groups are dealt into shards.
A first pass answers every query from the longest entries; the k-th score found there is a
threshold that the true answer cannot fall below. The second pass sends a query only to
groups whose longest entry can still reach its threshold. Within a shard the threshold
becomes a local cosine threshold; by it the shard either scans the entries that are long
enough (length pruning) or, where cosines have to be high, looks up only entries whose
largest query coordinates lie in the range that such a cosine allows (coordinate pruning).
What is left is scored exactly on whole numbers.

The longest ``sqrt(shards)`` shards make the first pass: with few, the threshold is loose and
every other shard returns many entries; with many, the first pass itself returns many.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.graph import checkpointed
from tessera.llm.vectors import SHARD, Products, best, entries, frequent_length, matrix, meet, rows, shards_for

K, SCALE = 20, 64
#: Lengths of one class differ by at most this factor.
RATIO = 0.9
#: Coordinates looked up for a query, rows that estimate what they leave, the share below which they are used.
FOCUS, SKETCH, GAIN = 3, 1024, 0.15
#: Scores computed at once: 16 MB of 32-bit floats.
TILE = 1 << 22
_NONE = -(1 << 62)
_EMPTY = "query_id long, rank int, vec_id long, score long"


class Bucket:
    """Entries of a shard, longest first."""

    def __init__(self, ids: np.ndarray, copies: np.ndarray, x: np.ndarray):
        length = np.sqrt((x.astype(np.float64) ** 2).sum(1))
        by = np.lexsort((ids, -length))
        self.ids, self.copies, self.length = ids[by], copies[by], length[by]
        self.products = Products(x[by])
        self._unit: np.ndarray | None = None
        self._sketch: np.ndarray | None = None
        self._sorted: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    @property
    def unit(self) -> np.ndarray:
        if self._unit is None:
            self._unit = self.products.x / np.where(self.length > 0, self.length, 1)[:, None]
        return self._unit

    def _share(self, f: int, low: float, high: float) -> float:
        """About which share of the entries has coordinate ``f`` in the range."""
        if self._sketch is None:
            self._sketch = np.sort(self.unit[np.linspace(0, len(self.ids) - 1, min(SKETCH, len(self.ids))).astype(int)], axis=0)
        column = self._sketch[:, f]
        return (np.searchsorted(column, high, "right") - np.searchsorted(column, low, "left")) / len(column)

    def ranges(self, q: np.ndarray, threshold: float) -> list[tuple[int, float, float]]:
        """Ranges of the largest coordinates of a query that an entry needs for the threshold.

        A cosine of t at least means an angle of acos(t) at most, so the angle of the entry to
        an axis differs from the query's by no more. Ranges are widened against rounding.
        """
        size = math.sqrt(float((q.astype(np.float64) ** 2).sum()))
        local = threshold / (size * self.length[0]) if size and self.length[0] else 0.0
        if local <= 0:
            return []
        reach = math.acos(min(1.0, local * (1 - 1e-9)))
        out = []
        for f in np.argsort(-np.abs(q), kind="stable")[:FOCUS]:
            angle = math.acos(max(-1.0, min(1.0, q[f] / size)))
            out.append((int(f), math.cos(min(math.pi, angle + reach)) - 1e-9, math.cos(max(0.0, angle - reach)) + 1e-9))
        return out

    def by_coordinates(self, ranges: list[tuple[int, float, float]]) -> np.ndarray | None:
        """Entries within all ranges, or None where a scan by length is the cheaper way."""
        if not ranges or min(self._share(*r) for r in ranges) > GAIN:
            return None
        ranges = sorted(ranges, key=lambda r: self._share(*r))
        f, low, high = ranges[0]
        if f not in self._sorted:
            order = np.argsort(self.unit[:, f], kind="stable")
            self._sorted[f] = order, self.unit[order, f]
        order, values = self._sorted[f]
        found = order[np.searchsorted(values, low, "left"):np.searchsorted(values, high, "right")]
        for f, low, high in ranges[1:]:
            at = self.unit[found, f]
            found = found[(at >= low) & (at <= high)]
        return found

    def answer(self, own: np.ndarray, q: np.ndarray, threshold: np.ndarray, k: int):
        """Per query: places of its k best entries at or above the threshold, and their scores."""
        size = np.sqrt((q.astype(np.float64) ** 2).sum(1))
        kind = self.products.kind(q)
        scan, out = [], [None] * len(q)
        upto = np.full(len(q), len(self.ids))
        for i, t in enumerate(threshold):
            if t > 0:
                # |q| * |x| >= t is needed; lengths fall along the bucket
                least = t / size[i] * (1 - 1e-9) if size[i] else math.inf
                upto[i] = np.searchsorted(-self.length, -least, "right")
            found = self.by_coordinates(self.ranges(q[i], t)) if t > 0 and upto[i] else None
            if found is None:
                scan.append(i)
            else:
                out[i] = self._pick(self.products.of(q[i:i + 1], found, kind)[0], found, own[i], t, k)
        scan = np.array(scan, int)
        while len(scan):
            step = max(1, TILE // max(1, len(self.ids)))
            now, scan = scan[:step], scan[step:]
            some = slice(0, int(upto[now].max()))
            for i, score in zip(now, self.products.of(q[now], some, kind), strict=True):
                out[i] = self._pick(score[:upto[i]], None, own[i], threshold[i], k)
        return out

    def _pick(self, score, found, own, threshold, k):
        at = np.flatnonzero(score >= threshold)
        place = at if found is None else found[at]
        other = self.ids[place] != own
        at, place = at[other], place[other]
        top = best(score[at], self.ids[place], k)
        return place[top], score[at[top]].astype(np.int64)


def _index(table: pa.Table) -> Bucket:
    return Bucket(table["vec_id"].to_numpy(), table["copies"].to_numpy(), matrix(table["c"]))


def _ask(k: int):
    def answer(bucket: Bucket, part: pa.RecordBatch) -> pa.RecordBatch:
        of = {name: part.column(i) for i, name in enumerate(part.schema.names)}
        threshold = of["threshold"].to_numpy()
        found = bucket.answer(of["vec_id"].to_numpy(), matrix(of["c"]), threshold, k)
        n = [len(place) for place, _ in found]
        at = np.concatenate([place for place, _ in found]).astype(np.int64)
        return pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(of["key"].to_numpy(), n)), pa.array(bucket.ids[at]), pa.array(np.minimum(bucket.copies[at], k)),
             pa.array(np.concatenate([s for _, s in found]).astype(np.int64))], names=["key", "vec_id", "copies", "score"])
    return answer


def top_products(vectors: DataFrame, queries: DataFrame, k: int = K, scale: int = SCALE, vec_id: str = "vec_id",
                 vector: str = "embedding", shard: int = SHARD) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` entries of the highest inner products of every query.

    A component x counts as floor(scale * x), so scores are whole numbers; ties go to the
    smaller id. ``queries`` has the columns of ``vectors``; rows with the query's own id are no
    candidates of it, all if fewer than ``k`` are left. Every query row is answered by itself,
    so a repeated one is answered as often as it is there; repeated candidates are candidates
    each. Vectors that are null, hold null or non-finite components, or differ from the most
    frequent length (the larger of equally frequent ones) take no part, nor do rows whose id
    is null or no whole number; zero vectors do. Scaled components beyond 2^24 are an error.
    """
    spark = vectors.sparkSession
    found = rows(vectors, vec_id, vector)
    dimensions = frequent_length(found)
    if not dimensions:
        return spark.createDataFrame([], _EMPTY)
    kept = entries(found, dimensions, scale)
    asked = entries(rows(queries, vec_id, vector), dimensions, scale).withColumn("key", F.monotonically_increasing_id())
    # length classes: a few hundred at most, as squared lengths are below 2^62
    step = 2 * math.log2(1 / RATIO)
    kept = kept.withColumn("class", F.floor(F.log2(F.greatest("size", F.lit(1).cast("long")).cast("double")) / F.lit(step)).cast("int"))
    classes = kept.groupBy("class").agg(F.count(F.lit(1)).alias("n"), F.max("size").alias("size")).orderBy(F.desc("class")).collect()
    n = sum(r["n"] for r in classes)
    if not n:
        return spark.createDataFrame([], _EMPTY)
    per = -(-n // shards_for(n, shard))
    groups, where = [], []  # [first shard, shards, largest squared length]
    held = []
    for i, r in enumerate(classes):
        held.append(r)
        have = sum(h["n"] for h in held)
        # short classes in a row share a group, so that no shard holds a few rows only
        if have >= per or i == len(classes) - 1:
            first = groups[-1][0] + groups[-1][1] if groups else 0
            groups.append((first, -(-have // per), max(h["size"] for h in held)))
            where += [(h["class"], first, groups[-1][1]) for h in held]
            held = []
    shards = groups[-1][0] + groups[-1][1]
    placed = (kept.join(F.broadcast(spark.createDataFrame(where, "class int, first int, number int")), "class")
              .select("vec_id", "c", "copies",
                      (F.col("first") + F.pmod(F.xxhash64("vec_id", "c"), F.col("number"))).cast("int").alias("shard")))
    schema = "key long, vec_id long, copies long, score long"
    asks = asked.select("key", "vec_id", "c", "size", F.col("copies").alias("times"))
    seeds = math.ceil(math.sqrt(shards))
    first = (asks.withColumn("threshold", F.lit(_NONE).cast("long"))
             .withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(seeds - 1)))))
    seen = checkpointed(_ranked(meet(placed.where(F.col("shard") < seeds), first, seeds, _index, _ask(k), schema), k))
    if shards > seeds:
        last = seen.where(F.col("rank") == k).select("key", F.col("score").alias("threshold"))
        asks = asks.join(last, "key", "left").withColumn("threshold", F.coalesce("threshold", F.lit(_NONE).cast("long")))
        group = F.explode(F.array(*[F.struct(F.lit(a).alias("first"), F.lit(b).alias("number"), F.lit(float(s)).alias("most"))
                                    for a, b, s in groups if a + b > seeds]))
        t = F.col("threshold").cast("double")
        reached = (t <= 0) | (F.col("size").cast("double") * F.col("g.most") * (1 + 1e-9) >= t * t)
        rest = (asks.withColumn("g", group).where(reached)
                .withColumn("shard", F.explode(F.sequence(F.greatest("g.first", F.lit(seeds)), F.col("g.first") + F.col("g.number") - 1)))
                .drop("g"))
        more = meet(placed.where(F.col("shard") >= seeds), rest, shards, _index, _ask(k), schema)
        seen = _ranked(seen.select("key", "vec_id", F.lit(1).cast("long").alias("copies"), "score").unionByName(more), k)
    answers = seen.join(asked.select("key", F.col("vec_id").alias("query_id"), F.col("copies").alias("times")), "key")
    return (answers.withColumn("time", F.explode(F.sequence(F.lit(1).cast("long"), F.col("times"))))
            .select("query_id", "rank", "vec_id", "score"))


def _ranked(found: DataFrame, k: int) -> DataFrame:
    """The ``k`` best of every query key, copies counted each."""
    each = found.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))).drop("copies", "copy")
    rank = F.row_number().over(Window.partitionBy("key").orderBy(F.desc("score"), "vec_id"))
    return each.withColumn("rank", rank).where(F.col("rank") <= k)
