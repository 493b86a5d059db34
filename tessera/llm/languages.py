"""Language identification with hyperdimensional profiles.

Every letter has a random vector of +1 and -1, seeded by its code point. An n-gram of letters
binds its letters' vectors, permuted (rotated) by their place, into one vector; a text bundles
(adds) the vectors of its n-grams; a language's prototype bundles its texts. A text gets the
language whose prototype has the largest cosine with it. Word borders are a symbol of their
own, so that beginnings and endings of words count.

Prototypes are sums and are formed by a distributed aggregation; only they (languages x
dimensions) reach the driver and are broadcast.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.graph import checkpointed
from tessera.llm.ship import ship
from tessera.llm.words import add_columns, column, slices

DIMENSIONS, N, MAX_ROWS_PER_LANG, SEED = 1024, 3, 5000, 2024
#: Prototypes take 8 KB each on the driver and 4 KB in every task.
MAX_LANGS = 10_000


@dataclass
class Profiles:
    langs: list[str]
    vectors: np.ndarray  # one unit row per language
    n: int = N
    seed: int = SEED


class Encoder:
    """Bundles of texts; letter vectors are made once and kept."""

    def __init__(self, dimensions: int, n: int, seed: int):
        self.d, self.n, self.seed = dimensions, n, seed
        self.letters: dict[int, np.ndarray] = {}
        self.alpha: dict[int, bool] = {}

    def _vector(self, point: int) -> np.ndarray:
        v = self.letters.get(point)
        if v is None:
            rng = np.random.Generator(np.random.Philox(key=[self.seed, point]))
            v = self.letters[point] = (rng.integers(0, 2, self.d, dtype=np.int8) * 2 - 1).astype(np.int8)
        return v

    def grams(self, texts: list[str | None]):
        """(text, n-gram as columns of symbols, count); symbols are letters, 0 a word border."""
        folded = [f" {(t or '').lower()} " for t in texts]
        points = np.frombuffer("".join(folded).encode("utf-32-le", "surrogatepass"), np.uint32)
        present = np.flatnonzero(np.bincount(points))
        for p in present.tolist():
            if p not in self.alpha:
                self.alpha[p] = chr(p).isalpha()
        letters = np.array([p for p in present.tolist() if self.alpha[p]], np.int64)
        number = np.zeros(int(present.max()) + 1, np.int64)
        number[letters] = np.arange(1, len(letters) + 1)
        row = np.repeat(np.arange(len(texts)), [len(t) for t in folded])
        z = number[points]
        keep = z != 0
        keep[1:] |= z[:-1] != 0  # one border after each word
        keep[0] = True
        z, row = z[keep], row[keep]
        n, size = self.n, len(letters) + 1
        if len(z) < n:
            return np.zeros(0, np.int64), np.zeros((0, n), np.int64), np.zeros(0, np.int64)
        count = len(z) - n + 1
        code, inner = np.zeros(count, np.int64), np.ones(count, bool)
        for i in range(n):
            code = code * size + z[i:i + count]
            if 0 < i < n - 1:
                inner &= z[i:i + count] != 0
        if n < 3:
            inner &= z[n - 1:] != 0
        middle = row[(n - 1) // 2:][:count] if n > 2 else row[n - 1:]
        total = size ** n
        pairs, times = np.unique(middle[inner] * total + code[inner], return_counts=True)
        code = pairs % total
        symbols = np.empty((len(code), n), np.int64)
        for i in reversed(range(n)):
            symbols[:, i] = code % size
            code = code // size
        names = np.append(0, letters)
        return pairs // total, names[symbols], times

    def bundles(self, texts: list[str | None]) -> np.ndarray:
        row, symbols, times = self.grams(texts)
        out = np.zeros((len(texts), self.d), np.float32)
        if not len(row):
            return out
        points, inverse = np.unique(symbols, return_inverse=True)
        table = np.stack([self._vector(int(p)) for p in points])
        kinds, kind = np.unique(inverse.reshape(symbols.shape) @ (len(points) ** np.arange(self.n)), return_inverse=True)
        # blocks of n-grams keep the bound vectors and counts small
        order = np.argsort(kind, kind="stable")
        kind, row, times = kind[order], row[order], times[order]
        for begin in range(0, len(kinds), 2048):
            block = kinds[begin:begin + 2048]
            bound = np.ones((len(block), self.d), np.int8)
            code = block.copy()
            for i in range(self.n):
                bound *= np.roll(table, self.n - 1 - i, axis=1)[code % len(points)]
                code //= len(points)
            a, b = np.searchsorted(kind, [begin, begin + len(block)])
            counts = np.zeros((len(texts), len(block)), np.float32)
            counts[row[a:b], kind[a:b] - begin] = times[a:b]
            out += counts @ bound.astype(np.float32)
        return out


def _unit(v: np.ndarray) -> np.ndarray:
    length = np.linalg.norm(v, axis=1, keepdims=True)
    return np.divide(v, length, out=np.zeros_like(v), where=length > 0)


def train(docs: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id", dimensions: int = DIMENSIONS,
          n: int = N, max_rows_per_lang: int = MAX_ROWS_PER_LANG, seed: int = SEED) -> Profiles:
    """Prototypes of the languages in ``lang``; rows without text or language are left out.

    About ``max_rows_per_lang`` rows of a language, chosen by a hash of ``key`` and text, are used,
    one at least. Each text counts alike, whatever its length. More than ``MAX_LANGS`` different
    values in ``lang`` are an error: prototypes of all of them are held at once.
    """
    ship(docs.sparkSession)
    rows = docs.select(column(text).alias("text"), column(lang).alias("lang"), column(key).cast("string").alias("key"))
    rows = rows.where("text is not null and lang is not null")
    rows = rows.withColumn("hash", F.pmod(F.xxhash64("key", "text", F.lit("sample")), F.lit(1 << 30)))
    counts = checkpointed(rows.groupBy("lang").agg(F.count(F.lit(1)).alias("count"), F.min("hash").alias("least")))
    n_langs = counts.count()
    if n_langs > MAX_LANGS:
        raise ValueError(f"{n_langs} different values in {lang}: more than {MAX_LANGS} languages are not learned")
    # one row a language: shipped to the texts, so that these are not shuffled by so skewed a key
    share = F.least(F.lit(1.0), F.lit(float(max_rows_per_lang)) / F.col("count"))
    chosen = (rows.join(F.broadcast(counts), "lang")
              .where((F.col("hash") / float(1 << 30) < share) | (F.col("hash") == F.col("least"))))

    def bundle(batches):
        encoder, sums = Encoder(dimensions, n, seed), {}
        for batch in batches:
            for part in slices(batch, "text"):
                v = _unit(encoder.bundles(part.column(part.schema.get_field_index("text")).to_pylist()))
                names = np.array(part.column(part.schema.get_field_index("lang")).to_pylist(), object)
                for name in dict.fromkeys(names.tolist()):
                    sums[name] = sums.get(name, 0) + v[names == name].sum(axis=0, dtype=np.float64)
        for name, v in sums.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * dimensions), pa.array(np.arange(dimensions, dtype=np.int32)), pa.array(v)],
                names=["lang", "i", "v"])

    sums = chosen.select("text", "lang").mapInArrow(bundle, "lang string, i int, v double")
    found = sums.groupBy("lang", "i").agg(F.sum("v").alias("v")).groupBy("lang").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("i", "v"))), lambda x: x["v"]).alias("v")).collect()
    found.sort(key=lambda r: r["lang"])
    vectors = np.array([r["v"] for r in found]).reshape(len(found), dimensions)
    return Profiles([r["lang"] for r in found], _unit(vectors).astype(np.float32), n, seed)


def predict(docs: DataFrame, profiles: Profiles, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Append lang_pred and score (the cosine with its prototype, 0 to 1) to every document.

    A text that is null or has no letters gets ``und`` and 0; so does every text if no
    language was learned. Equal cosines go to the name that sorts first. Columns of ``docs``
    named like the new ones give way.
    """
    shipped = docs.sparkSession.sparkContext.broadcast(profiles)
    cache: dict = {}

    def rows_of(part):
        p = shipped.value
        if "encoder" not in cache:
            cache["encoder"] = Encoder(p.vectors.shape[1], p.n, p.seed)
        bundles = cache["encoder"].bundles(part.column(part.schema.get_field_index(text)).to_pylist())
        known = bundles.any(axis=1) & (len(p.langs) > 0)
        if not p.langs:
            return [pa.array(["und"] * part.num_rows), pa.array(np.zeros(part.num_rows))]
        cosines = _unit(bundles) @ p.vectors.T
        best = cosines.argmax(axis=1)
        score = np.where(known, np.clip(cosines[np.arange(len(best)), best].astype(np.float64), 0, 1), 0.0)
        names = [p.langs[b] if k else "und" for b, k in zip(best.tolist(), known.tolist(), strict=True)]
        return [pa.array(names, pa.string()), pa.array(score)]

    return add_columns(docs, rows_of, [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())],
                       keep, text)
