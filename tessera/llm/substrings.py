"""Removal of long word spans that repeat an earlier document: a sparse De Bruijn graph.

Nodes are token k-mers, picked by a rule that looks at the k-mer alone (its smallest
sub-word stands first or last: a closed syncmer), so that every window of ``width`` words
contains one and equal windows contain equal ones. The edge between two neighbouring nodes
is the k-mer pair with its distance; as neighbours overlap, an edge fixes all its words.

1. The nodes of all documents are aggregated: smallest and largest document, and whether
   every occurrence continues by the same edge on either side.
2. A join gives every document its repeated nodes. Neighbours joined by the only edge out
   of one and the only edge into the other are compacted into a nonbranching path. A path is
   traversed whole wherever it occurs, so all windows inside it start in the same documents.
3. Windows across the ends of paths (branches, borders of a repeat) are verified at their
   source coordinates: they are hashed whole (128 bits), aggregated and joined back.

Nothing is collected: hot k-mers are aggregated on the map side, and the join back to
their occurrences is a plain equi-join whose hot keys adaptive execution splits.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.ship import ship
from tessera.llm.words import SPACED, Sequences, Words, column, find_words, mix, release, slices, without

WIDTH = 50
_U = np.uint64
_ODD = _U(0x9FB21C651E98DF25)
_NODE = "k1 long, k2 long, doc long, prev long, next long"
_WINDOW = "w1 long, w2 long, doc long"


def kmer_sizes(width: int) -> tuple[int, int]:
    """(k, s): k-mers chosen by their smallest s-mer, one at least in every window."""
    s = 2 if width >= 8 else 1
    return (width + 1 + s) // 2, s


def _sliding_min(a: np.ndarray, n: int) -> np.ndarray:
    size, out = 1, a
    while 2 * size <= n:
        out = np.minimum(out[:-size], out[size:])
        size *= 2
    return np.minimum(out[:len(a) - n + 1], out[n - size:n - size + len(a) - n + 1])


class Nodes:
    """The graph nodes of consecutive texts, in order: place, text, keys."""

    def __init__(self, words: Words, width: int):
        k, s = kmer_sizes(width)
        n = len(words.hash)
        self.k, self.words, self.width = k, words, width
        self.seq = Sequences(words.hash, 0), Sequences(words.hash, 1)
        rows = words.rows
        self.stop = words.first[1:][rows]  # end of each word's text
        if n < width:
            self.at = np.zeros(0, np.int64)
        else:
            small = self.seq[0].of(np.arange(n - s + 1), s)
            m = k - s + 1
            least = _sliding_min(small, m)
            i = np.arange(len(least))
            first = words.first[:-1][rows[i]]
            pick = (least == small[i]) | (least == small[i + m - 1])
            pick &= (i + k <= self.stop[i]) & (self.stop[i] - first >= width)
            self.at = np.flatnonzero(pick)
        self.row = rows[self.at]
        self.k1 = self.seq[0].of(self.at, k)
        self.edge = np.zeros(len(self.at) + 1, _U)  # edge[i]: from node i - 1 to node i, 0 across texts
        if len(self.at) > 1:
            joined = self.row[1:] == self.row[:-1]
            edge = mix(self.k1[:-1] + mix(self.k1[1:] + np.diff(self.at).astype(_U) * _ODD)) | _U(1)
            self.edge[1:-1] = np.where(joined, edge, _U(0))

    def windows(self):
        """Window starts with the first and last node inside."""
        n = len(self.words.hash)
        start = np.flatnonzero(np.arange(n) + self.width <= self.stop)
        before = np.zeros(n + 1, np.int64)
        before[self.at + 1] = 1
        before = np.cumsum(before)  # nodes that start before a word
        return start, before[start], before[start + self.width - self.k + 1] - 1


def _text(part: pa.RecordBatch, name: str) -> pa.Array:
    return part.column(part.schema.get_field_index(name))


def node_rows(docs: DataFrame, width: int, doc_id: str, text: str) -> DataFrame:
    """(k1, k2, doc, prev, next): every node of every document with the edges around it."""
    source = docs.select(column(doc_id).cast("long").alias("doc"), column(text).alias("text")).where("doc is not null")

    def run(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                nodes = Nodes(find_words(_text(part, "text"), SPACED), width)
                prev, nxt = nodes.edge[:-1], nodes.edge[1:]
                by = np.lexsort((nxt, prev, nodes.k1, nodes.row))
                same = np.zeros(len(by), bool)
                a, b = by[1:], by[:-1]
                same[1:] = ((nodes.row[a] == nodes.row[b]) & (nodes.k1[a] == nodes.k1[b])
                            & (prev[a] == prev[b]) & (nxt[a] == nxt[b]))
                take = by[~same]
                doc = _text(part, "doc").to_numpy(zero_copy_only=False)
                k2 = nodes.seq[1].of(nodes.at[take], nodes.k)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x.view(np.int64)) for x in (nodes.k1[take], k2, doc[nodes.row[take]], prev[take], nxt[take])],
                    names=["k1", "k2", "doc", "prev", "next"])
        release()

    return source.mapInArrow(run, _NODE)


class _Table:
    """Looks up (text, key) pairs among per-text lists."""

    def __init__(self, lists: pa.Array, key: str):
        lists = lists.fill_null([]) if lists.null_count else lists
        size = lists.value_lengths().to_numpy(zero_copy_only=False)
        items = lists.flatten()
        struct = pa.types.is_struct(items.type)
        self.items = items
        keys = (items.field(key) if struct else items).to_numpy(zero_copy_only=False).view(_U)
        tagged = self._tag(keys, np.repeat(np.arange(len(size)), size))
        self.order = np.argsort(tagged)
        self.keys = tagged[self.order]

    @staticmethod
    def _tag(keys, rows):
        return mix(keys + rows.astype(_U) * _ODD)

    def find(self, keys, rows):
        """Index into the items, and whether there is one."""
        if not len(self.keys):
            return np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
        tagged = self._tag(keys, rows)
        at = np.minimum(np.searchsorted(self.keys, tagged), len(self.keys) - 1)
        return self.order[at], self.keys[at] == tagged

    def field(self, name, index):
        values = self.items.field(name).to_numpy(zero_copy_only=False)
        return values[index] if len(values) else np.zeros(len(index), np.int64)


def _judge(words: Words, repeated: pa.Array, width: int):
    """(nodes, window starts, smallest document of windows inside one path, windows to verify)."""
    nodes = Nodes(words, width)
    table = _Table(repeated, "k1")
    index, known = table.find(nodes.k1, nodes.row)
    low = table.field("low", index)
    code = np.where(known, table.field("code", index), 0)
    linked = np.zeros(len(known) + 1, bool)  # node i - 1 leads to node i and nowhere else
    if len(known) > 1:
        linked[1:-1] = ((nodes.edge[1:-1] != 0) & known[1:] & known[:-1]
                        & ((code[:-1] & 2) > 0) & ((code[1:] & 1) > 0))
    path = np.cumsum(~linked[:-1]) - 1
    head = np.flatnonzero(~linked[:-1])
    tail = np.append(head[1:], len(known)) - 1
    start, i, j = nodes.windows()
    new = np.concatenate([[0], np.cumsum(~known)])
    all_known = new[j + 1] == new[i]
    inside = (path[i] == path[j]) & (start >= nodes.at[head[path[i]]]) & (start + width <= nodes.at[tail[path[i]]] + nodes.k)
    sure, open_ = all_known & inside, all_known & ~inside
    return nodes, start[sure], low[i[sure]], start[open_]


def window_rows(joined: DataFrame, width: int, doc_id: str, text: str) -> DataFrame:
    """(w1, w2, doc): windows of repeated nodes that no single path decides."""

    def run(batches):
        for batch in batches:
            for part in slices(batch, text):
                part = part.filter(_text(part, "__nodes").is_valid())
                words = find_words(_text(part, text), SPACED)
                nodes, _, _, at = _judge(words, _text(part, "__nodes"), width)
                row = words.rows[at]
                w1 = nodes.seq[0].of(at, width)
                by = np.lexsort((w1, row))
                new = np.ones(len(by), bool)
                new[1:] = (row[by[1:]] != row[by[:-1]]) | (w1[by[1:]] != w1[by[:-1]])
                by = by[new]
                doc = _text(part, doc_id).cast(pa.int64()).to_numpy(zero_copy_only=False)
                w2 = nodes.seq[1].of(at[by], width)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x.view(np.int64)) for x in (w1[by], w2, doc[row[by]])], names=["w1", "w2", "doc"])
        release()

    return joined.mapInArrow(run, _WINDOW)


def _cut(words: Words, gone: np.ndarray, texts: list[bytes | None], offsets: np.ndarray, joined: bool):
    """Each text without the words marked as gone."""
    out = []
    removed = np.concatenate([[0], np.cumsum(gone)])
    for r, raw in enumerate(texts):
        a, b = words.first[r], words.first[r + 1]
        lost = removed[b] - removed[a]
        if raw is None:
            out.append(None)
        elif joined:
            parts = raw.split()
            out.append(b" ".join(itertools.compress(parts, ~gone[a:b]) if lost else parts))
        elif not lost:
            out.append(raw)
        else:
            # keep what stands before the first word of a removed run and from the next kept word on
            flag = np.concatenate([[False], gone[a:b], [False]])
            begin = np.flatnonzero(flag[1:-1] & ~flag[:-2])
            after = np.flatnonzero(flag[1:-1] & ~flag[2:]) + 1
            base, pieces, at = offsets[r], [], 0
            for x, y in zip(begin, after, strict=True):
                pieces.append(raw[at:words.start[a + x] - base])
                at = words.start[a + y] - base if a + y < b else len(raw)
            pieces.append(raw[at:])
            out.append(b"".join(pieces).rstrip() if len(pieces[-1]) == 0 else b"".join(pieces))
    return out


def remove_repeats(docs: DataFrame, width: int = WIDTH, doc_id: str = "doc_id", text: str = "text",
                   joined: bool = False, counts: tuple[str, str] = ("n_words", "n_removed")) -> DataFrame:
    """Cut from each text the words of windows that also start in a document of smaller id.

    A window is ``width`` consecutive words (``[^\\x20\\x09-\\x0D]+``); windows are judged on
    the input. All columns are kept; ``text`` is replaced and n_words and n_removed (or the names
    in ``counts``) are added; columns of these names give way. ``joined`` gives the kept words joined by one
    space; else the text between kept words stays as it is.

    ``doc_id`` is an integer. A null text stays null and has no words; a text shorter than a
    window keeps all words. Rows that share an id are judged each by itself, against smaller
    ids only; a document without an id keeps all its words and is nobody's source.
    """
    ship(docs.sparkSession)
    docs = without(docs, [*counts, "__nodes", "__windows", "__doc", "__doc2"])
    nodes = node_rows(docs, width, doc_id, text)
    stats = (nodes.groupBy("k1", "k2")
             .agg(F.min("doc").alias("low"), F.max("doc").alias("high"),
                  ((F.min("prev") == F.max("prev")).cast("long")
                   + 2 * (F.min("next") == F.max("next")).cast("long")).alias("code"))
             .where("low < high").drop("high"))
    repeated = (nodes.select("k1", "k2", "doc").join(stats, ["k1", "k2"])
                .groupBy(F.col("doc").alias("__doc"))
                .agg(F.collect_list(F.struct("k1", "low", "code")).alias("__nodes")))
    with_nodes = docs.join(repeated, column(doc_id).cast("long") == F.col("__doc"), "left").drop("__doc")

    windows = window_rows(with_nodes, width, doc_id, text)
    earliest = (windows.groupBy("w1", "w2").agg(F.min("doc").alias("low"), F.max("doc").alias("high"))
                .where("low < high").drop("high"))
    later = (windows.join(earliest, ["w1", "w2"]).where("low < doc")
             .groupBy(F.col("doc").alias("__doc2")).agg(F.collect_list("w1").alias("__windows")))
    ready = with_nodes.join(later, column(doc_id).cast("long") == F.col("__doc2"), "left").drop("__doc2")

    names = docs.columns
    schema = T.StructType([docs.schema[c] for c in names]
                          + [T.StructField(c, T.LongType()) for c in counts])

    def run(batches):
        for batch in batches:
            for part in slices(batch, text):
                raw = _text(part, text)
                words = find_words(raw, SPACED)
                nodes, sure, low, open_ = _judge(words, _text(part, "__nodes"), width)
                ids = _text(part, doc_id).cast(pa.int64()).fill_null(-2**63).to_numpy(zero_copy_only=False)
                found = _Table(_text(part, "__windows"), "w1").find(nodes.seq[0].of(open_, width), words.rows[open_])[1]
                hit = np.concatenate([sure[low < ids[words.rows[sure]]], open_[found]])
                edge = np.zeros(len(words.hash) + 1, np.int64)
                np.add.at(edge, hit, 1)
                np.add.at(edge, hit + width, -1)
                gone = np.cumsum(edge)[:-1] > 0
                sizes = np.diff(words.first)
                lost = np.concatenate([[0], np.cumsum(gone)])
                lost = lost[words.first[1:]] - lost[words.first[:-1]]
                length = np.array([0 if x is None else x for x in pc.binary_length(raw).to_pylist()], np.int64)
                offsets = np.cumsum(length) - length
                cut = _cut(words, gone, raw.cast(pa.binary()).to_pylist(), offsets, joined)
                new = {text: pa.array(cut, pa.binary()).cast(pa.string())}
                yield pa.RecordBatch.from_arrays(
                    [new[c] if c == text else _text(part, c) for c in names] + [pa.array(sizes), pa.array(lost)],
                    names=[*names, *counts])
        release()

    return ready.mapInArrow(run, schema)
