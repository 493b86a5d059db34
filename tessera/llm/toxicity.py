"""Toxicity: FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Features of a text are the presence of hashed words, word beginnings, word pairs and word
pairs with one word between them. Training runs over a bounded sample of labelled rows in
one task, with per-coordinate learning rates and an L1 term that leaves few weights; those
(index, weight) pairs are broadcast, and scoring is one map pass over the documents.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.ship import ship
from tessera.llm.words import ALNUM, Words, add_columns, buffers, column, find_words, mix, slices

_U = np.uint64


@dataclass(frozen=True)
class Settings:
    """Hash bits, FTRL rates, passes over the sample, the sample's bounds in rows and in bytes of
    text, the bytes of word beginnings, and the sample texts that a feature must occur in to be used."""

    bits: int = 20
    alpha: float = 0.5
    beta: float = 1.0
    l1: float = 8.0
    l2: float = 1.0
    passes: int = 4
    max_rows: int = 15_000
    max_bytes: int = 256 << 20
    prefixes: tuple[int, ...] = (4, 5)
    least: int = 5
    seed: int = 11


@dataclass
class Model:
    settings: Settings
    bias: float
    index: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    weight: np.ndarray = field(default_factory=lambda: np.zeros(0))

    def dense(self) -> np.ndarray:
        table = np.zeros(1 << self.settings.bits, np.float32)
        table[self.index] = self.weight
        return table


def features(words: Words, settings: Settings) -> list[tuple[np.ndarray, np.ndarray]]:
    """(text, feature) arrays, one of each kind: words, beginnings, pairs, skip pairs."""
    shift = _U(64 - settings.bits)
    rows, h = words.rows, words.hash
    out = [(rows, mix(h + _U(1)) >> shift)]
    # the first bytes of longer words, for endings that training has not seen
    length = words.end - words.start
    for prefix in settings.prefixes:
        long = np.flatnonzero(length > prefix)
        key = np.full(len(long), _U(prefix))
        for i in range(prefix):
            byte = words.data[words.start[long] + i]
            key = key * _U(257) + np.where((byte >= 65) & (byte <= 90), byte + 32, byte).astype(_U)
        out.append((rows[long], mix(key * _U(0x9E3779B97F4A7C15) + _U(2)) >> shift))
    for gap in (1, 2):
        if len(h) > gap:
            same = rows[gap:] == rows[:-gap]
            pair = mix(mix(h[:-gap] + _U(2 + gap)) + h[gap:]) >> shift
            out.append((rows[gap:][same], pair[same]))
    return out


def _column(part, name):
    return part.column(part.schema.get_field_index(name))


def _presence(words: Words, settings: Settings, only: np.ndarray | None = None):
    """Distinct (text, feature) pairs, sorted by text; ``only`` keeps features marked there."""
    parts = features(words, settings)
    if only is not None:
        parts = [(r[only[f]], f[only[f]]) for r, f in parts]
    row = np.concatenate([r for r, _ in parts]).astype(np.int64)
    feature = np.concatenate([f for _, f in parts]).astype(np.int64)
    tagged = np.unique((row << settings.bits) | feature)
    return tagged >> settings.bits, tagged & ((1 << settings.bits) - 1)


def ftrl(examples: list[np.ndarray], labels: np.ndarray, settings: Settings) -> Model:
    """FTRL-proximal over binary features; the last coordinate is the (unpenalized) bias."""
    size = 1 << settings.bits
    l1 = settings.l1 * min(1.0, np.sqrt(len(examples) / 3000))  # fewer rows gather smaller gradients
    z, n = np.zeros(size + 1), np.zeros(size + 1)
    order = np.arange(len(examples))
    rng = np.random.default_rng(settings.seed)
    bias = np.array([size])

    def weights(at):
        w = -(z[at] - np.sign(z[at]) * l1) / ((settings.beta + np.sqrt(n[at])) / settings.alpha + settings.l2)
        w[np.abs(z[at]) <= l1] = 0
        if at[-1] == size:
            w[-1] = -z[size] / ((settings.beta + np.sqrt(n[size])) / settings.alpha)
        return w

    for _ in range(settings.passes):
        rng.shuffle(order)
        for k in order:
            at = np.concatenate([examples[k], bias])
            w = weights(at)
            p = 1 / (1 + np.exp(-np.clip(w.sum(), -35, 35)))
            g = p - labels[k]
            z[at] += g - (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / settings.alpha * w
            n[at] += g * g
    every = np.arange(size + 1)
    w = weights(every)
    index = np.flatnonzero(w[:-1])
    return Model(settings, float(w[-1]), index, w[index])


def sample(rows: DataFrame, key, most: int) -> DataFrame:
    """About ``most`` of the rows, chosen by a hash of ``key`` (all, if there are no more)."""
    n = rows.count()
    if n <= most:
        return rows
    return rows.where(F.pmod(F.xxhash64(key, F.lit("sample")), F.lit(1 << 30)) < F.lit(int(most / n * (1 << 30))))


def train(docs: DataFrame, labels: DataFrame, settings: Settings = Settings(), doc_id: str = "doc_id",
          text: str = "text", label: str = "toxic") -> Model:
    """Fit on labelled documents: ``labels`` (doc_id, label 0/1), null ids and labels left out.

    At most about ``settings.max_rows`` labelled documents are used, in the order of a hash of
    their ids until their texts make ``settings.max_bytes``; a text of more than a 64th of that
    teaches nothing (it is scored as any other). An id labelled more than
    once takes its largest label, and of rows that repeat an id the smallest text is used.
    Without any labelled row every score is 0.5.
    """
    ship(docs.sparkSession)
    marked = (labels.where(column(label).isNotNull() & column(doc_id).isNotNull())
              .groupBy(column(doc_id).alias("__id")).agg(F.max(column(label)).cast("double").alias("__label")))
    marked = sample(marked, F.col("__id"), settings.max_rows)
    source = docs.select(column(doc_id).alias("__id"), column(text).alias("__text"))
    # the sample is bounded: ids and labels of 16 bytes each
    rows = source.join(F.broadcast(marked), "__id")
    # so is what is left of repeated ids, reduced in every task first
    rows = rows.groupBy("__id", "__label").agg(F.coalesce(F.min("__text"), F.lit("")).alias("__text"))
    # ids order the rows of the fit; those that are no numbers by a hash
    whole = isinstance(rows.schema["__id"].dataType, T.IntegralType)
    rows = rows.withColumn("__id", F.col("__id").cast("long") if whole else F.xxhash64("__id"))
    rows = rows.where(F.octet_length("__text") <= settings.max_bytes // 64)

    def extract(batches):
        for batch in batches:
            for part in slices(batch, "__text"):
                row, feature = _presence(find_words(_column(part, "__text"), ALNUM, lower=True), settings)
                offsets = np.searchsorted(row, np.arange(part.num_rows + 1)).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(feature.astype(np.int32)))
                _, ends = buffers(_column(part, "__text"))
                yield pa.RecordBatch.from_arrays([_column(part, "__id"), _column(part, "__label"), lists, pa.array(np.diff(ends))],
                                                 names=["id", "label", "features", "bytes"])

    def fit(batches):
        ids, ys, sizes, flats, left = [], [], [], [], settings.max_bytes
        times = np.zeros(1 << settings.bits, np.int64)
        for batch in batches:
            # rows come in the order of a hash; those beyond the bound are read and not kept
            taken = int(np.searchsorted(np.cumsum(batch.column(3).to_numpy()), left, "right"))
            left = left - int(batch.column(3).to_numpy()[:taken].sum()) if taken == batch.num_rows else 0
            batch = batch.slice(0, taken)
            if not taken:
                continue
            lists = batch.column(2)
            ids.append(batch.column(0).to_numpy())
            ys.append(batch.column(1).to_numpy())
            sizes.append(lists.value_lengths().to_numpy())
            flats.append(lists.flatten().to_numpy())
            times += np.bincount(flats[-1], minlength=len(times))
        if not ids:
            return
        # a few long arrays, not one small array for each text
        ids, ys, sizes, flat = (np.concatenate(x) for x in (ids, ys, sizes, flats))
        flats.clear()
        often = (times >= settings.least)[flat]
        ends = np.concatenate([[0], np.cumsum(often)])[np.cumsum(sizes)]
        begins = np.append(0, ends[:-1])
        flat = flat[often]
        by = np.lexsort((ys, sizes, ids))  # the same order wherever rows came from
        model = ftrl([flat[begins[i]:ends[i]] for i in by], ys[by], settings)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(model.index, -1)), pa.array(np.append(model.weight, model.bias))],
                                         names=["index", "weight"])

    extracted = rows.mapInArrow(extract, "id long, label double, features array<int>, bytes long")
    in_order = extracted.repartition(1).sortWithinPartitions(F.xxhash64("id", F.lit("size")), "id")
    fitted = in_order.mapInArrow(fit, "index long, weight double").collect()
    weights = {r["index"]: r["weight"] for r in fitted}
    bias = weights.pop(-1, 0.0)
    index = np.array(sorted(weights), np.int64)
    return Model(settings, bias, index, np.array([weights[i] for i in index]))


def score(docs: DataFrame, model: Model, text: str = "text", threshold: float = 0.5, keep: list[str] | None = None,
          drop: bool = False) -> DataFrame:
    """Append score (0 to 1) and predicted (1 from ``threshold``); ``drop`` instead leaves out such documents.

    A null or empty text has no features and gets the score of the bias alone. Columns of
    ``docs`` named score or predicted give way.
    """
    shipped = docs.sparkSession.sparkContext.broadcast(model)
    cache: dict = {}

    def rows_of(part):
        model = shipped.value
        if "w" not in cache:
            cache["w"] = model.dense()
        table = cache["w"]
        row, feature = _presence(find_words(_column(part, text), ALNUM, lower=True), model.settings, table != 0)
        total = np.bincount(row, weights=table[feature], minlength=part.num_rows) + model.bias
        p = 1 / (1 + np.exp(-np.clip(total, -35, 35)))
        if drop:
            return [pa.array(p < threshold)]
        return [pa.array(p), pa.array((p >= threshold).astype(np.int32))]

    fields = [] if drop else [T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())]
    return add_columns(docs, rows_of, fields, keep, text)
