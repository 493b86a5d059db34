"""Approximate nearest neighbours with an inverted multi-index.

The two halves of every vector are quantized by codebooks of their own; a pair of centroids
is a cell. A query visits cells in the order of the summed squared distances of its halves
to the pair (a heap walks the two sorted distance lists), until the visited cells hold a
set share of all vectors. Their entries are reranked by the exact distance.

Codebooks are fitted on a bounded sample; every vector is indexed. The share that has to be
visited is measured on that sample too: for exact neighbours within it, the share of entries
whose cells come before the neighbour's is known, and a quantile of it is the share that
finds so many of them. On clustered vectors that is a few percent, on vectors without
structure most of them.

Entries are shuffled once, into shards of neighbouring cells (a cell of many entries is dealt
to several); a query goes to the shards that hold cells it visits and to no others, with the
summed distance at which its walk stopped; a shard returns its nearest entries only.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.graph import checkpointed
from tessera.llm.ship import ship
from tessera.llm.vectors import SHARD, finite, frequent_length, matrix, meet, rows, shards_for

#: Neighbours within the sample that the visited share has to find, and queries that measure it.
RECALL, MEASURED = 0.95, 256
SAMPLE, SEED = 20_000, 3


@dataclass
class Codebooks:
    left: np.ndarray
    right: np.ndarray

    @property
    def half(self) -> int:
        return self.left.shape[1]

    def distances(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Squared distances of both halves of each row to the centroids."""
        return tuple(((h**2).sum(1)[:, None] - 2 * h @ c.T + (c**2).sum(1)[None, :])
                     for h, c in ((x[:, :self.half], self.left), (x[:, self.half:], self.right)))

    def cells(self, x: np.ndarray) -> np.ndarray:
        a, b = self.distances(x)
        return a.argmin(1) * len(self.right) + b.argmin(1)


def kmeans(x: np.ndarray, k: int, rounds: int = 12, seed: int = SEED) -> np.ndarray:
    """Centroids of Lloyd's algorithm, started from distinct rows; an empty one stays in place."""
    start = np.unique(x, axis=0)
    rng = np.random.default_rng(seed)
    c = start[rng.permutation(len(start))[:k]].copy()
    for _ in range(rounds):
        near = ((c**2).sum(1)[None, :] - 2 * x @ c.T).argmin(1)
        count = np.bincount(near, minlength=len(c))
        for d in range(x.shape[1]):
            total = np.bincount(near, weights=x[:, d], minlength=len(c))
            c[:, d] = np.where(count > 0, total / np.maximum(count, 1), c[:, d])
    return c


def visit(a: np.ndarray, b: np.ndarray, count: np.ndarray, enough: int) -> tuple[list[int], float]:
    """Cells in the order of summed distance until they hold ``enough`` entries, and the last
    of these distances."""
    by_a, by_b, width = np.argsort(a, kind="stable"), np.argsort(b, kind="stable"), len(b)
    sa, sb = a[by_a].tolist(), b[by_b].tolist()
    heap, out, have, reach = [(sa[0] + sb[0], 0, 0)], [], 0, 0.0
    while heap and have < enough:
        reach, i, j = heapq.heappop(heap)
        cell = int(by_a[i]) * width + int(by_b[j])
        if count[cell]:
            out.append(cell)
            have += int(count[cell])
        # every pair is pushed once: along j from its left neighbour, along i only from j = 0
        if j + 1 < len(sb):
            heapq.heappush(heap, (sa[i] + sb[j + 1], i, j + 1))
        if j == 0 and i + 1 < len(sa):
            heapq.heappush(heap, (sa[i + 1] + sb[0], i + 1, 0))
    return out, reach


def needed_share(books: Codebooks, count: np.ndarray, points: np.ndarray, k: int, recall: float) -> float:
    """Share of all entries that a walk visits before it has found ``recall`` of the ``k`` nearest
    points of a point, measured on up to ``MEASURED`` points of the sample."""
    asked = points[np.linspace(0, len(points) - 1, min(MEASURED, len(points))).astype(int)]
    cell, total, shares = books.cells(points), max(1, int(count.sum())), []
    size = (points**2).sum(1)
    for q, a, b in zip(asked, *books.distances(asked), strict=True):
        d = size - 2 * points @ q
        own = (points == q).all(1)
        d[own] = np.inf
        near = np.argsort(d, kind="stable")[:min(k, int((~own).sum()))]
        sums = (a[:, None] + b[None, :]).ravel()
        order = np.argsort(sums, kind="stable")
        upto = np.empty(len(sums), np.int64)
        upto[order] = np.cumsum(count[order])
        shares.append(upto[cell[near]] / total)
    shares = np.concatenate(shares) if shares else np.zeros(0)
    return float(min(1.0, np.quantile(shares, recall))) if len(shares) else 1.0


def usable(vector: Column, dimensions: int | None = None) -> Column:
    """Whether a vector takes part: not null, not zero, only finite components."""
    ok = finite(vector) & (F.size(vector) > 1) & F.exists(vector, lambda v: v != 0)
    return F.coalesce(ok if dimensions is None else ok & (F.size(vector) == dimensions), F.lit(False))


def _distinct(df: DataFrame, dimensions: int) -> DataFrame:
    """(vec_id, v, copies) of usable rows; checkpointed."""
    kept = df.where(F.col("vec_id").isNotNull() & usable(F.col("v"), dimensions))
    return checkpointed(kept.groupBy("vec_id", "v").agg(F.count(F.lit(1)).alias("copies")))


@dataclass
class Index:
    """Codebooks, entries per cell, and shards: cell c lies in shards first[c], ..., first[c] + number[c] - 1."""

    books: Codebooks
    count: np.ndarray
    share: float
    first: np.ndarray
    number: np.ndarray
    shards: int

    @classmethod
    def of(cls, books: Codebooks, count: np.ndarray, share: float, per: int) -> Index:
        number = np.maximum(1, -(-count // per))
        # cells in order share a shard until it is full; a large cell has shards of its own
        first, now, room = np.empty(len(count), np.int64), 0, per
        for c, n in enumerate(count.tolist()):
            if n > room and room < per:
                now, room = now + 1, per
            first[c] = now
            room -= n
            if room <= 0:
                now, room = now + int(number[c]), per
        return cls(books, count, share, first, number, now + (room < per))

    def shards_of(self, cells: list[int]) -> list[int]:
        out: set[int] = set()
        for c in cells:
            out.update(range(int(self.first[c]), int(self.first[c] + self.number[c])))
        return sorted(out)


def build_index(kept: DataFrame, k: int = 10, share: float | None = None, recall: float = RECALL, sample: int = SAMPLE,
                shard: int = SHARD) -> Index:
    """Index over distinct rows (vec_id, v) of one length: codebooks from about ``sample`` of them,
    all rows counted by cell. ``share`` is measured where it is not given."""
    spark = kept.sparkSession
    n = kept.count()
    if not n:
        return Index.of(Codebooks(np.zeros((1, 1)), np.zeros((1, 1))), np.zeros(1, np.int64), 1.0, 1)
    pick = F.pmod(F.xxhash64("vec_id", "v", F.lit("sample")), F.lit(1 << 30)) < int(min(1.0, sample / n) * (1 << 30))
    # of bounded size: rows are distinct, so a repeated id or vector is no more than its share
    fitted = kept.where(pick).select("vec_id", "v").collect() or kept.select("vec_id", "v").limit(sample).collect()
    points = np.array([r["v"] for r in sorted(fitted, key=lambda r: (r["vec_id"], r["v"]))], np.float64)
    half, size = points.shape[1] // 2, int(min(256, max(2, round((n / 32) ** 0.5))))
    books = Codebooks(kmeans(points[:, :half], size), kmeans(points[:, half:], size))
    shipped = spark.sparkContext.broadcast(books)

    def assign(batches):
        for batch in batches:
            x = matrix(batch.column(0)).astype(np.float64)
            cell = shipped.value.cells(x) if len(x) else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(cell.astype(np.int32))], names=["cell"])

    count = np.zeros(len(books.left) * len(books.right), np.int64)
    for r in kept.select("v").mapInArrow(assign, "cell int").groupBy("cell").count().collect():  # at most 256 x 256 cells
        count[r["cell"]] = r["count"]
    share = needed_share(books, count, points, k, recall) if share is None else share
    return Index.of(books, count, share, -(-n // shards_for(n, shard)))


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 10, vec_id: str = "vec_id", vector: str = "embedding",
            share: float | None = None, recall: float = RECALL, sample: int = SAMPLE, shard: int = SHARD) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest vectors found for every query.

    ``queries`` has the columns of ``vectors``; an entry with the query's own id is no
    candidate. score is the Euclidean distance in double precision, ties go to the smaller
    id. Vectors that are null, zero, of one dimension, hold null or non-finite components, or
    differ from the most frequent length (the larger of equally frequent ones) take no part,
    nor do rows whose id is null or no whole number. Rows that repeat an id are entries of their
    own, and queries of their own: a query row that is there twice is answered twice, and two
    vectors of one id have an answer each.

    ``share`` of all vectors is visited for a query at least: more finds more, at 1 everything.
    By default it is what finds ``recall`` of the neighbours in a sample (:func:`needed_share`).
    """
    spark = vectors.sparkSession
    ship(spark)
    found = rows(vectors, vec_id, vector)
    dimensions = frequent_length(found.where(F.col("vec_id").isNotNull() & usable(F.col("v"))))
    empty = "query_id long, rank int, vec_id long, score double"
    if dimensions is None:
        return spark.createDataFrame([], empty)
    kept = _distinct(found, dimensions)
    asked = _distinct(rows(queries, vec_id, vector), dimensions).withColumn("key", F.monotonically_increasing_id())
    index = build_index(kept, k, share, recall, sample, shard)
    shipped = spark.sparkContext.broadcast(index)
    enough = max(int(np.ceil(index.share * index.count.sum())), k + 1)
    kind = kept.schema["v"].dataType.simpleString()

    def place(batches):
        for batch in batches:
            index, x = shipped.value, matrix(batch.column(1)).astype(np.float64)
            cell = index.books.cells(x) if len(x) else np.zeros(0, np.int64)
            # rows of a large cell are dealt to its shards by their hash
            at = index.first[cell] + batch.column(3).to_numpy() % index.number[cell]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array(cell.astype(np.int32)), pa.array(at.astype(np.int32))],
                names=["vec_id", "v", "copies", "cell", "shard"])

    def walk(batches):
        for batch in batches:
            index, x = shipped.value, matrix(batch.column(1)).astype(np.float64)
            a, b = index.books.distances(x) if len(x) else ([], [])
            walks = [visit(p, q, index.count, enough) for p, q in zip(a, b, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), batch.column(2), pa.array([reach for _, reach in walks], pa.float64()),
                 pa.array([index.shards_of(cells) for cells, _ in walks], pa.list_(pa.int32()))],
                names=["vec_id", "v", "key", "reach", "shards"])

    hashed = kept.select("vec_id", "v", "copies", F.pmod(F.xxhash64("vec_id", "v"), F.lit(1 << 30)).alias("hash"))
    left = hashed.mapInArrow(place, f"vec_id long, v {kind}, copies long, cell int, shard int")
    walked = asked.select("vec_id", "v", "key").mapInArrow(walk, f"vec_id long, v {kind}, key long, reach double, shards array<int>")
    right = walked.withColumn("shard", F.explode("shards")).drop("shards")
    answers = meet(left, right, index.shards, _Cells, _rerank(shipped, k), "key long, vec_id long, copies long, score double")
    # the window keeps k rows of a query on each map task already
    each = answers.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))).drop("copies", "copy")
    rank = F.row_number().over(Window.partitionBy("key").orderBy("score", "vec_id"))
    best = each.withColumn("rank", rank).where(F.col("rank") <= k)
    told = asked.select("key", F.col("vec_id").alias("query_id"), F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
    return best.join(told, "key").select("query_id", "rank", "vec_id", "score")


class _Cells:
    """Entries of a shard in the order of their cells."""

    def __init__(self, table: pa.Table):
        ids, cell = table["vec_id"].to_numpy(), table["cell"].to_numpy()
        order = np.lexsort((ids, cell))
        self.ids, self.cell, self.copies = ids[order], cell[order], table["copies"].to_numpy()[order]
        self.x = matrix(table["v"]).astype(np.float64)[order]
        self.first = np.flatnonzero(np.append(True, self.cell[1:] != self.cell[:-1]))
        self.last = np.append(self.first[1:], len(self.cell))


def _rerank(shipped, k: int):
    def answer(own: _Cells, asking: pa.RecordBatch) -> pa.RecordBatch:
        out: list[list] = [[], [], [], []]
        books = shipped.value.books
        lefts, rights = np.divmod(own.cell[own.first], len(books.right))
        of = {name: asking.column(i) for i, name in enumerate(asking.schema.names)}
        q, reach, queries = matrix(of["v"]).astype(np.float64), of["reach"].to_numpy(), of["vec_id"].to_numpy()
        a, b = books.distances(q)
        for i, key in enumerate(of["key"].to_pylist()):
            # cells within reach, with room for how sums are rounded
            mine = np.flatnonzero(a[i, lefts] + b[i, rights] <= reach[i] + 1e-9 * (1 + abs(reach[i])))
            size = own.last[mine] - own.first[mine]
            at = np.repeat(own.first[mine] - (np.cumsum(size) - size), size) + np.arange(size.sum())
            at = at[own.ids[at] != queries[i]]
            if not len(at):
                continue
            d = np.sqrt(((own.x[at] - q[i]) ** 2).sum(1))
            if len(d) > k:
                near = d <= np.partition(d, k - 1)[k - 1]
                at, d = at[near], d[near]
            best = np.lexsort((own.ids[at], d))[:k]
            out[0] += [key] * len(best)
            out[1] += own.ids[at[best]].tolist()
            out[2] += np.minimum(own.copies[at[best]], k).tolist()
            out[3] += d[best].tolist()
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out[:3]] + [pa.array(out[3], pa.float64())],
                                          names=["key", "vec_id", "copies", "score"])
    return answer
