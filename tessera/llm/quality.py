"""Quality classifier: a sparse rule ensemble over text statistics.

One map pass computes statistics of every whole text. On a bounded sample of labelled rows,
shallow boosted trees are grown; each path from a root to a node is a conjunctive rule, a
lasso logistic regression picks few of them, and these are compiled into one Spark column
expression over the statistics.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.words import SPACED, Sequences, add_columns, byte_class, column, find_words, mix

_U = np.uint64
_LINES = byte_class(b"\n")
STATS = ["bytes_log", "words_log", "lines_log", "word_bytes", "line_words", "symbols", "marks", "capitals", "digits",
         "high_bytes", "spaces", "distinct", "echo", "top_word", "distinct_lines", "distinct_grams", "ends",
         "short_words", "long_words", "no_letters"]


def _class(chars: str) -> np.ndarray:
    table = np.zeros(256, bool)
    table[np.frombuffer(chars.encode(), np.uint8)] = True
    return table


_UPPER = _class("ABCDEFGHIJKLMNOPQRSTUVWXYZ")
_DIGIT = _class("0123456789")
_MARK = _class(".,;:!?'\"()-")
_SYMBOL = _class("#$%&*+/<=>@[\\]^_`{|}~")
_SPACE = ~SPACED
_LETTER = _class("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz") | (np.arange(256) >= 128)
_END = _class(".!?")


def _distinct(rows, keys, n):
    """Number of distinct keys of each text, and the largest number of equal ones."""
    tagged, counts = np.unique(mix(keys + rows.astype(_U) * _U(0x9FB21C651E98DF25)), return_counts=True)
    # a tag's text: found through the first place it stands at
    order = np.argsort(mix(keys + rows.astype(_U) * _U(0x9FB21C651E98DF25)), kind="stable")
    owner = rows[order[np.cumsum(counts) - counts]]
    most = np.zeros(n, np.int64)
    np.maximum.at(most, owner, counts)
    return np.bincount(owner, minlength=n), most


def statistics(text: pa.Array) -> np.ndarray:
    """One row of ``STATS`` for each text; a null text counts as empty."""
    words, lines = find_words(text, SPACED), find_words(text, _LINES)
    n = len(words.first) - 1
    data = words.data
    length = pc.binary_length(text.fill_null("") if text.null_count else text).to_numpy(zero_copy_only=False).astype(np.int64)
    of_byte = np.repeat(np.arange(n), length)
    n_words, n_lines = np.diff(words.first), np.diff(lines.first)
    rows = words.rows

    def share(table):
        return np.bincount(of_byte, weights=table[data], minlength=n) / np.maximum(length, 1)

    def of_words(flag):
        return np.bincount(rows, weights=flag, minlength=n) / np.maximum(n_words, 1)

    size = words.end - words.start
    distinct, most = _distinct(rows, words.hash, n)
    lines_distinct, _ = _distinct(lines.rows, lines.hash, n)
    echo = np.zeros(len(rows))
    echo[1:] = (words.hash[1:] == words.hash[:-1]) & (rows[1:] == rows[:-1])
    grams = np.maximum(n_words - 2, 0)
    at = np.flatnonzero(np.arange(len(rows)) + 3 <= words.first[1:][rows]) if len(rows) else np.zeros(0, np.int64)
    grams_distinct, _ = _distinct(rows[at], Sequences(words.hash).of(at, 3), n)
    letters = np.concatenate([[0], np.cumsum(_LETTER[data])])
    plain = letters[words.end] == letters[words.start]
    ends = _END[data[words.end - 1]] if len(rows) else np.zeros(0)
    return np.stack([
        np.log1p(length), np.log1p(n_words), np.log1p(n_lines), of_words(size), n_words / np.maximum(n_lines, 1),
        share(_SYMBOL), share(_MARK), share(_UPPER), share(_DIGIT), share(np.arange(256) >= 128), share(_SPACE),
        distinct / np.maximum(n_words, 1), of_words(echo), most / np.maximum(n_words, 1),
        lines_distinct / np.maximum(n_lines, 1), grams_distinct / np.maximum(grams, 1), of_words(ends),
        of_words(size <= 3), of_words(size >= 12), of_words(plain)], axis=1).astype(np.float64)


def with_statistics(docs: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``docs`` with one double column ``stat_<name>`` for each of ``STATS``."""
    fields = [T.StructField(f"stat_{s}", T.DoubleType()) for s in STATS]

    def rows_of(part):
        found = statistics(part.column(part.schema.get_field_index(text)))
        return [pa.array(found[:, i]) for i in range(found.shape[1])]

    return add_columns(docs, rows_of, fields, keep, text)


@dataclass(frozen=True)
class Settings:
    """Trees, their depth, split candidates of a statistic, shrinkage, smallest node, lasso
    penalty, and the bound of the sample in rows."""

    trees: int = 40
    depth: int = 3
    cuts: int = 40
    shrink: float = 0.2
    least: int = 10
    penalty: float = 0.002
    max_rows: int = 15_000
    seed: int = 5


#: A rule: conditions (statistic, above, cut); above is value > cut, else value <= cut.
Rule = tuple[tuple[int, bool, float], ...]


@dataclass
class Model:
    bias: float
    rules: list[tuple[Rule, float]]


def _grow(bins, cuts, target, rows, settings, rules: list[Rule], path: Rule, update):
    """Split ``rows`` greedily on squared error; every node but the root is a rule."""
    if path:
        rules.append(tuple(sorted(path)))
    total, n = target[rows].sum(), len(rows)
    best = (1e-9, None, None)
    if len(path) < settings.depth and n >= 2 * settings.least:
        for f in range(bins.shape[1]):
            b = bins[rows, f]
            count = np.cumsum(np.bincount(b, minlength=len(cuts[f]) + 1))[:-1]
            part = np.cumsum(np.bincount(b, weights=target[rows], minlength=len(cuts[f]) + 1))[:-1]
            ok = (count >= settings.least) & (n - count >= settings.least)
            if ok.any():
                gain = np.where(ok, part**2 / np.maximum(count, 1) + (total - part)**2 / np.maximum(n - count, 1) - total**2 / n, -1)
                k = int(gain.argmax())
                if gain[k] > best[0]:
                    best = (gain[k], f, k)
    if best[1] is None:
        update[rows] = total / n
        return
    _, f, k = best
    low = bins[rows, f] <= k
    for part, above in ((rows[low], False), (rows[~low], True)):
        _grow(bins, cuts, target, part, settings, rules, (*path, (f, above, float(cuts[f][k]))), update)


def _holds(rule: Rule, x: np.ndarray) -> np.ndarray:
    out = np.ones(len(x), bool)
    for f, above, cut in rule:
        out &= (x[:, f] > cut) if above else (x[:, f] <= cut)
    return out


def fit(x: np.ndarray, y: np.ndarray, settings: Settings = Settings()) -> Model:
    """Rules of boosted trees, weighted by lasso logistic regression."""
    if len(y) == 0 or y.min() == y.max():
        p = float(np.clip(y.mean() if len(y) else 0.5, 0.01, 0.99))
        return Model(float(np.log(p / (1 - p))), [])
    rng = np.random.default_rng(settings.seed)
    cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, settings.cuts + 2)[1:-1])) for f in range(x.shape[1])]
    bins = np.stack([np.searchsorted(c, x[:, f]) for f, c in enumerate(cuts)], axis=1)
    rules: list[Rule] = []
    margin = np.full(len(y), np.log(y.mean() / (1 - y.mean())))
    for _ in range(settings.trees):
        p = 1 / (1 + np.exp(-margin))
        rows = np.sort(rng.permutation(len(y))[:max(len(y) // 2, min(len(y), 200))])
        found: list[Rule] = []
        _grow(bins, cuts, y - p, rows, settings, found, (), np.zeros(len(y)))
        for rule in found:
            rules.append(rule)
        leaf = np.zeros(len(y))
        deepest = [r for r in found if not any(set(r) < set(o) for o in found)]
        for rule in deepest:
            at = _holds(rule, x)
            h = (p[at] * (1 - p[at])).sum() + 1.0
            leaf[at] = (y[at] - p[at]).sum() / h
        margin = margin + settings.shrink * leaf
    rules = sorted(set(rules))
    if not rules:  # too few rows for any split
        p = float(np.clip(y.mean(), 0.01, 0.99))
        return Model(float(np.log(p / (1 - p))), [])
    hold = np.stack([_holds(r, x) for r in rules], axis=1).astype(np.float64)
    spread = hold.std(axis=0)
    use = spread > 0
    rules, hold, spread = [r for r, u in zip(rules, use, strict=True) if u], hold[:, use], spread[use]
    weight, bias = _lasso((hold - hold.mean(axis=0)) / spread, y, settings.penalty)
    weight = weight / spread
    bias -= float((weight * hold.mean(axis=0)).sum())
    return Model(bias, [(r, float(w)) for r, w in zip(rules, weight, strict=True) if w != 0])


def _lasso(z: np.ndarray, y: np.ndarray, penalty: float, rounds: int = 400):
    """Accelerated proximal gradient for the mean logistic loss with an L1 term (bias free)."""
    n, m = z.shape
    v = np.ones(m)
    for _ in range(20):  # largest eigenvalue of z'z/n
        v = z.T @ (z @ v) / n
        v /= np.linalg.norm(v) + 1e-12
    step = 1 / (0.25 * (float(v @ (z.T @ (z @ v))) / n + 1) + 1e-9)
    w, b = np.zeros(m), float(np.log(y.mean() / (1 - y.mean())))
    u, c, t = w.copy(), b, 1.0
    for _ in range(rounds):
        r = 1 / (1 + np.exp(-np.clip(z @ u + c, -35, 35))) - y
        new = u - step * (z.T @ r) / n
        new = np.sign(new) * np.maximum(np.abs(new) - step * penalty, 0)
        new_b = c - step * r.mean()
        t2 = (1 + np.sqrt(1 + 4 * t * t)) / 2
        u, c = new + (t - 1) / t2 * (new - w), new_b + (t - 1) / t2 * (new_b - b)
        w, b, t = new, new_b, t2
    return w, b


def compile_rules(model: Model) -> Column:
    """The model's score as one expression over the ``stat_`` columns."""
    terms = [F.lit(model.bias)]
    for rule, weight in model.rules:
        holds = None
        for f, above, cut in rule:
            value = F.col(f"stat_{STATS[f]}")
            one = value > F.lit(cut) if above else value <= F.lit(cut)
            holds = one if holds is None else holds & one
        terms.append(F.when(holds, F.lit(weight)).otherwise(F.lit(0.0)))
    while len(terms) > 1:  # added in pairs, so that the expression stays shallow
        terms = [a + b for a, b in zip(terms[::2], terms[1::2], strict=False)] + terms[len(terms) & ~1:]
    margin = terms[0]
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-margin))


def train(docs: DataFrame, labels: DataFrame, settings: Settings = Settings(), doc_id: str = "doc_id",
          text: str = "text", label: str = "quality") -> Model:
    """Fit on labelled documents: ``labels`` (doc_id, label 0/1), null ids and labels left out.

    About ``settings.max_rows`` labelled rows at most, chosen by a hash of the id, are used:
    their statistics (20 numbers each) are what reaches the driver. An id labelled more than
    once takes its largest label, and of rows that repeat an id the smallest text is used.
    Without labels every score is 0.5.
    """
    marked = (labels.where(column(label).isNotNull() & column(doc_id).isNotNull())
              .groupBy(column(doc_id).alias("__id")).agg(F.max(column(label)).cast("double").alias("__label")))
    n = marked.count()
    if n > settings.max_rows:
        marked = marked.where(F.pmod(F.xxhash64("__id", F.lit("sample")), F.lit(1 << 30)) < int(settings.max_rows / n * (1 << 30)))
    rows = docs.select(column(doc_id).alias("__id"), column(text).alias("__text")).join(F.broadcast(marked), "__id")
    # rows that repeat an id are reduced to one, in every task first
    rows = rows.groupBy("__id", "__label").agg(F.min("__text").alias("__text"))
    found = with_statistics(rows, "__text", keep=["__id", "__label"]).toPandas()
    found = found.sort_values(["__id", *[f"stat_{s}" for s in STATS]], kind="stable")
    return fit(found[[f"stat_{s}" for s in STATS]].to_numpy(np.float64).reshape(len(found), len(STATS)),
               found["__label"].to_numpy(np.float64), settings)


def score(docs: DataFrame, model: Model, text: str = "text", threshold: float = 0.7, keep: list[str] | None = None) -> DataFrame:
    """Append score (0 to 1) and predicted (1 from ``threshold``); a null text is scored as an empty one.

    Columns of ``docs`` named score, predicted or like a statistic give way.
    """
    kept = [c for c in (keep or docs.columns) if c.lower() not in ("score", "predicted")]
    found = with_statistics(docs, text, kept).withColumn("score", compile_rules(model))
    names = [c for c in kept if not c.lower().startswith("stat_") or c.lower()[5:] not in STATS]
    return found.select(*[column(c) for c in names], "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
