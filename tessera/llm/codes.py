"""Vector code compression: product codes whose nearest entries a GNAT finds.

Vectors become integers and are cut into equal parts; every part position has a codebook of
its own, fitted by a few rounds of integer k-means, and a vector's code is the number of the
nearest entry in each part. The entries of a codebook hang in a geometric near-neighbour
access tree: a node holds some split points, and for each pair of them the range of
distances from the one to the entries below the other. The distance of a part to a split
point then rules out every subtree whose range it cannot reach.

Subtrees go only when they are strictly too far, with roots and sums rounded against it;
distances themselves are whole numbers, so ties go to the lower entry exactly.

A round is one map over the vectors that returns sums per entry, at most parts x entries x
width numbers a task; only those sums and the codebooks pass the driver.
"""

from __future__ import annotations

import hashlib
import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.graph import checkpointed
from tessera.llm.ship import ship
from tessera.llm.vectors import frequent_length, integers, rows
from tessera.llm.words import column, release

PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256
#: Split points of a node.
ARITY = 6
#: Bytes of label sums that may be broadcast; beyond it they are joined by salted label.
BROADCAST_BYTES, SALTS = 32 << 20, 64
_UP, _DOWN = 1 + 2.0**-48, 1 - 2.0**-48


@dataclass
class _Node:
    splits: list[int]
    low: np.ndarray  # (split, child): least and largest distance from a split to the points at a child
    high: np.ndarray
    children: list[_Node | None]


class Gnat:
    """Exact nearest entries, ties to the lower number, of integer points."""

    def __init__(self, points: np.ndarray, arity: int = ARITY):
        self.points, self.arity = points.astype(np.int64), max(2, arity)
        self.compared = 0
        self.root = self._build(list(range(len(points))))

    def _squares(self, i: int, members) -> np.ndarray:
        return ((self.points[members] - self.points[i]) ** 2).sum(1)

    def _build(self, members: list[int]) -> _Node | None:
        if not members:
            return None
        splits, far = [members[0]], self._squares(members[0], members)
        while len(splits) < min(self.arity, len(members)):
            far[[members.index(s) for s in splits]] = -1
            splits.append(members[int(far.argmax())])
            far = np.minimum(far, self._squares(splits[-1], members))
        rest = [m for m in members if m not in set(splits)]
        near = np.array([self._squares(s, rest) for s in splits]).argmin(0) if rest else np.zeros(0, int)
        groups = [[m for m, j in zip(rest, near, strict=True) if j == i] for i in range(len(splits))]
        low, high = (np.empty((len(splits), len(splits))) for _ in range(2))
        for i, s in enumerate(splits):
            for j, group in enumerate(groups):
                # a split itself is compared before its own subtree is judged
                inside = group if i == j else [splits[j], *group]
                d = np.sqrt(self._squares(s, inside).astype(np.float64)) if inside else np.array([math.inf])
                low[i, j], high[i, j] = d.min() * _DOWN, d.max() * _UP
        return _Node(splits, low, high, [self._build(g) for g in groups])

    def nearest(self, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(number, squared distance) of the nearest entry of every row."""
        q = q.astype(np.int64)
        state = (np.full(len(q), len(self.points)), np.full(len(q), np.iinfo(np.int64).max), np.full(len(q), math.inf))
        if self.root is not None and len(q):
            self._search(self.root, q, np.arange(len(q)), *state)
        return state[0], state[1]

    def _search(self, node: _Node, q, at, entry, square, reach) -> None:
        open_ = np.ones((len(at), len(node.splits)), bool)
        for i, s in enumerate(node.splits):
            live = np.flatnonzero(open_[:, i])
            if not len(live):
                continue
            r = at[live]
            self.compared += len(r)
            d = ((q[r] - self.points[s]) ** 2).sum(1)
            better = (d < square[r]) | ((d == square[r]) & (s < entry[r]))
            entry[r[better]], square[r[better]] = s, d[better]
            root = np.sqrt(d.astype(np.float64))
            reach[r[better]] = root[better] * _UP
            bound = reach[r][:, None]
            gone = (root * _DOWN)[:, None] > (node.high[i][None, :] + bound) * _UP
            gone |= node.low[i][None, :] > ((root * _UP)[:, None] + bound) * _UP
            open_[live] &= ~gone
        for j, child in enumerate(node.children):
            if child is not None:
                live = np.flatnonzero(open_[:, j])
                if len(live):
                    self._search(child, q, at[live], entry, square, reach)


def _cut(x: np.ndarray, parts: int) -> np.ndarray:
    """(row, part, position); a length that the parts do not divide is filled up with zeros."""
    width = -(-x.shape[1] // parts)
    return np.pad(x, ((0, 0), (0, width * parts - x.shape[1]))).reshape(len(x), parts, width)


def _assign(books: np.ndarray, batch: pa.RecordBatch, at: int, scale: int):
    """Parts of a batch's vectors, with their entries and squared distances."""
    x = _cut(integers(batch.column(at), scale), len(books))
    entry, square = (np.empty(x.shape[:2], np.int64) for _ in range(2))
    for p, book in enumerate(books):
        entry[:, p], square[:, p] = Gnat(book).nearest(x[:, p])
    return x, entry, square


def _sums(kept: DataFrame, books: np.ndarray, scale: int) -> list:
    """(part, entry, position, total, n) over all vectors."""
    shipped = kept.sparkSession.sparkContext.broadcast(books)
    parts, n_entries, width = books.shape

    def add(batches):
        total, n = np.zeros((parts, n_entries, width), np.int64), np.zeros((parts, n_entries), np.int64)
        for batch in batches:
            x, entry, _ = _assign(shipped.value, batch, 0, scale)
            for p in range(parts):
                n[p] += np.bincount(entry[:, p], minlength=n_entries)
                np.add.at(total[p], entry[:, p], x[:, p])
        p, e = np.nonzero(n)
        release()
        columns = [np.repeat(p, width), np.repeat(e, width), np.tile(np.arange(width), len(p)),
                   total[p, e].ravel(), np.repeat(n[p, e], width)]
        yield pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)) for c in columns],
                                         names=["part", "entry", "position", "total", "n"])

    made = kept.select("v").mapInArrow(add, "part long, entry long, position long, total long, n long")
    return made.groupBy("part", "entry", "position").agg(F.sum("total").alias("total"), F.sum("n").alias("n")).collect()


def fit(kept: DataFrame, parts: int = PARTS, n_entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> np.ndarray:
    """Codebooks (part, entry, position) of the vectors ``v`` of ``kept``, which all have one length.

    They start as the parts of the ``n_entries`` rows of smallest vec_id (nulls last, rows of
    one id by their vectors).
    """
    first = kept.orderBy(F.asc_nulls_last("vec_id"), "v").limit(n_entries).select("v").collect()
    start = integers(pa.array([list(r["v"]) for r in first], pa.list_(pa.float64())), scale)
    books = np.ascontiguousarray(_cut(start, parts).transpose(1, 0, 2))
    for _ in range(rounds if books.shape[2] else 0):
        books = books.copy()
        for r in _sums(kept, books, scale):
            books[r["part"], r["entry"], r["position"]] = r["total"] // r["n"]
    return books


def compress(vectors: DataFrame, parts: int = PARTS, n_entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE,
             vec_id: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """(vec_id, code, error, label_error, codebooks_sha256) of every vector.

    A component x counts as floor(scale * x). code has two hex digits a part, error is the sum
    of the squared distances of the parts to their entries, label_error its sum over the rows
    of one label (nulls together), codebooks_sha256 the digest of the entries as decimal
    numbers. Vectors that are null, hold null or non-finite components, or differ from the
    most frequent length (the larger of equally frequent ones) are dropped; a length that the
    parts do not divide is filled up with zeros. Rows without an id are coded like all others
    and start no codebook while others do; repeated rows count and are returned each. Without
    rows there are no codes. Scaled components beyond 2^24 are an error.
    """
    if n_entries > 256:
        raise ValueError("a code has two hex digits: at most 256 entries")
    spark = vectors.sparkSession
    ship(spark)
    found = rows(vectors, vec_id, vector, [column(label).alias("label")])
    dimensions = frequent_length(found)
    if dimensions is None:
        return spark.createDataFrame([], "vec_id long, code string, error long, label_error long, codebooks_sha256 string")
    kept = found.where(F.size("v") == dimensions)
    books = fit(kept, parts, n_entries, rounds, scale)
    digest = hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()
    shipped = spark.sparkContext.broadcast(books)

    def code(batches):
        for batch in batches:
            _, entry, square = _assign(shipped.value, batch, 2, scale)
            text = entry.astype(np.uint8).tobytes().hex()
            codes = [text[i:i + 2 * parts] for i in range(0, len(text), 2 * parts)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(codes, pa.string()),
                                              pa.array(square.sum(1), pa.int64())], names=["vec_id", "label", "code", "error"])
        release()

    kind = kept.schema["label"].dataType.simpleString()
    coded = checkpointed(kept.select("vec_id", "label", "v").mapInArrow(code, f"vec_id long, label {kind}, code string, error long"))
    sums = checkpointed(coded.groupBy("label").agg(F.sum("error").alias("label_error"))).withColumnRenamed("label", "of_label")
    size = sums.agg(F.sum(F.coalesce(F.octet_length(F.col("of_label").cast("string")), F.lit(0)) + 64)).first()[0]
    if size <= BROADCAST_BYTES:
        with_sums = coded.join(F.broadcast(sums), coded["label"].eqNullSafe(sums["of_label"]))
    else:
        salted = coded.withColumn("salt", F.pmod(F.xxhash64("vec_id", "code"), F.lit(SALTS)))
        each = sums.withColumn("of_salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
        with_sums = salted.join(each, salted["label"].eqNullSafe(each["of_label"]) & (salted["salt"] == each["of_salt"]))
    return with_sums.select("vec_id", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))
