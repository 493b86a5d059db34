"""Benchmark decontamination with suffix arrays over training shards.

Every Spark task cuts its documents into shards of a few megabytes and builds a word
suffix array over each shard. Every suffix of every benchmark item is then binary-searched
in it: the range of suffixes that agree with it is narrowed word by word, until a window of
words has matched. Suffixes that begin with the same window are searched once. The ranges of
different windows of one length are disjoint, so the words that they cover and the documents
they touch are read from at most one pass over the array, however often a window occurs.
Where a match begins that no earlier word extends, its whole length is looked up, which
gives the longest verbatim matches with their places. A shard holds whole documents, so
nothing is shuffled; what grows with the corpus is only the number of shards.

The benchmark is the query set. It is shipped to the tasks in blocks of a checked size
(``block_bytes``); a task reads them one after another for each shard, so it holds one block
at a time, however many there are.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.ship import ship
from tessera.llm.words import ALNUM, Sequences, Words, add_columns, column, find_words, release, slices

WINDOW = 10
#: Benchmark text of a block; its words and windows take about 20 times as much memory.
BLOCK_BYTES = 16 << 20
#: Text of a shard: larger ones share a search among more suffixes, and take 40 times as much memory.
SHARD_BYTES = 2 << 20
#: Matches whose lengths are looked up at once.
CHUNK = 1 << 20

RESULT = [T.StructField("n_words", T.LongType()), T.StructField("n_hit", T.LongType()),
          T.StructField("n_items", T.LongType()), T.StructField("items_sha256", T.StringType()),
          T.StructField("contaminated", T.BooleanType()), T.StructField("longest_match", T.LongType())]


@dataclass
class TestSet:
    """Words of benchmark items, back to back, and their different windows."""

    ids: list[str]
    hash: np.ndarray
    first: np.ndarray  # words of item i: first[i]:first[i + 1]
    item: np.ndarray  # of a word
    begin: np.ndarray  # of window c: the place of its first occurrence
    need: np.ndarray  # words of window c
    starts: np.ndarray  # places at which window c starts: starts[at[c]:at[c + 1]]
    at: np.ndarray
    items: np.ndarray  # different items with window c: items[of[c]:of[c + 1]]
    of: np.ndarray

    @classmethod
    def of_rows(cls, rows: list, width: int) -> TestSet:
        words = find_words(pa.array([r[1] for r in rows], pa.string()), ALNUM, lower=True)
        n, item = np.diff(words.first), words.rows.astype(np.int32)
        need = np.minimum(width, n[item])
        starts = np.flatnonzero(np.arange(len(item)) + need <= words.first[1:][item])
        need = need[starts]
        keys = [Sequences(words.hash, which).of(starts, need) for which in (0, 1)]
        by = np.lexsort((starts, *keys, need))
        starts, need, keys = starts[by], need[by], [k[by] for k in keys]
        new = np.ones(len(by), bool)
        new[1:] = (np.diff(need) != 0) | (keys[0][1:] != keys[0][:-1]) | (keys[1][1:] != keys[1][:-1])
        first = np.flatnonzero(new)
        window = np.cumsum(new) - 1
        # starts of a window are in order, and so are their items
        fresh = new.copy()
        fresh[1:] |= np.diff(item[starts]) != 0
        return cls([str(r[0]) if r[0] is not None else "" for r in rows], words.hash, words.first, item, starts[first], need[first],
                   starts, np.append(first, len(starts)), item[starts[fresh]],
                   np.searchsorted(window[fresh], np.arange(len(first) + 1)))


def suffix_array(ids: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Order of all suffixes. ``ids``: words as numbers from 1, with a 0 after each text;
    ``end``: the place of that 0 for every position. Ranks of one word become ranks of 2, 4,
    8 words, and so on, and only suffixes that are still equal are ranked further. A rank is
    below the number of positions, so two of them fit a 64-bit key up to 3 billion."""
    n = len(ids)
    at = np.arange(n)
    size = n + 1
    rank, order = ids.astype(np.int64), at
    longest = int((end - at).max()) if n else 0
    places, width = at, 1  # places of the order that are still open, ascending
    order = np.argsort(rank, kind="stable")
    rank = _ranks(rank[order], order, at, rank)
    rank[ids == 0] = 0
    places = _open(rank[order], places)
    while len(places) and width < longest:
        some = order[places]
        key = rank[some] * size + rank[np.minimum(some + width, end[some])]
        by = np.argsort(key)
        some, key = some[by], key[by]
        order[places] = some
        rank = _ranks(key, some, places, rank)
        places = places[_open_runs(key)]
        width *= 2
    return order


def _ranks(key: np.ndarray, some: np.ndarray, places: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """Ranks of sorted suffixes: 1 + the place of the first of equal keys."""
    new = np.ones(len(key), bool)
    new[1:] = key[1:] != key[:-1]
    rank = rank.copy()
    rank[some] = places[np.maximum.accumulate(np.where(new, np.arange(len(key)), 0))] + 1
    return rank


def _open_runs(key: np.ndarray) -> np.ndarray:
    """Whether a sorted key has an equal neighbour."""
    same = np.zeros(len(key), bool)
    same[1:] = key[1:] == key[:-1]
    same[:-1] |= same[1:]
    return same


def _open(ranked: np.ndarray, places: np.ndarray) -> np.ndarray:
    return places[_open_runs(ranked) & (ranked > 0)]


def _bounds(ids, end, order, word, depth, lo, hi):
    """Narrow ranges ``[lo, hi)`` of the order to suffixes with ``word`` at ``depth``."""

    def first(at_least):
        left, right = lo.copy(), hi.copy()
        while True:
            open_ = np.flatnonzero(left < right)
            if not len(open_):
                return left
            mid = (left[open_] + right[open_]) >> 1
            place = order[mid]
            less = ids[np.minimum(place + depth, end[place])] < at_least[open_]
            left[open_] = np.where(less, mid + 1, left[open_])
            right[open_] = np.where(less, right[open_], mid)

    return first(word), first(word + 1)


def _spread(lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Members of the ranges ``[lo, hi)``, back to back: (number of the range, member)."""
    n = hi - lo
    which = np.repeat(np.arange(len(lo)), n)
    return which, np.arange(len(which)) + np.repeat(lo - (np.cumsum(n) - n), n)


class Shard:
    """Suffix array over the words of some documents."""

    def __init__(self, words: Words):
        self.words, self.row = words, words.rows
        n_texts = len(words.first) - 1
        self.vocabulary, inverse = np.unique(words.hash, return_inverse=True)
        # a gap after each text
        self.ids = np.zeros(len(words.hash) + n_texts, np.int64)
        slot = np.arange(len(words.hash)) + self.row
        self.ids[slot] = inverse + 1
        self.stop = words.first[1:] + np.arange(n_texts)
        self.end = np.empty(len(self.ids), np.int64)
        self.end[slot], self.end[self.stop] = self.stop[self.row], self.stop
        self.order = suffix_array(self.ids, self.end)

    def numbers(self, hashes: np.ndarray) -> np.ndarray:
        """Words as numbers of this shard, -1 for others."""
        at = np.searchsorted(self.vocabulary, hashes)
        known = at < len(self.vocabulary)
        known[known] = self.vocabulary[at[known]] == hashes[known]
        return np.where(known, at + 1, -1)

    def ranges(self, test: TestSet) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Windows of the test set that occur, with the ranges of the order in which they do."""
        none = np.zeros(0, np.int64)
        if not len(self.words.hash) or not len(test.begin):
            return none, none, none
        word = self.numbers(test.hash)
        lo, hi = np.zeros(len(test.begin), np.int64), np.full(len(test.begin), len(self.ids))
        live, done = np.arange(len(test.begin)), []
        for depth in range(int(test.need.max())):
            next_ = word[test.begin[live] + depth]
            live, next_ = live[next_ > 0], next_[next_ > 0]
            if not len(live):
                break
            lo[live], hi[live] = _bounds(self.ids, self.end, self.order, next_, depth, lo[live], hi[live])
            live = live[lo[live] < hi[live]]
            done.append(live[test.need[live] == depth + 1])
            live = live[test.need[live] > depth + 1]
        found = np.concatenate(done) if done else none
        return found, lo[found], hi[found]

    def places(self, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(number of the range, word) of all suffixes in the ranges."""
        which, rank = _spread(lo, hi)
        slot = self.order[rank]
        # back from slots to words
        return which, slot - np.searchsorted(self.stop, slot)

    def maximal(self, test: TestSet) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(test word, shard word, length) of maximal verbatim matches of at least a window.

        A match begins where the words before the two places differ, or one has none. Such
        pairs are built from ranges of equal windows sorted by the word before, so pairs
        inside a longer match are never listed.
        """
        found, lo, hi = self.ranges(test)
        if not len(found):
            return
        which, place = self.places(lo, hi)
        first = np.zeros(len(self.words.hash) + 1, bool)
        first[self.words.first[:-1]] = True
        before = np.where(first[place], 0, self.ids[place + self.row[place] - 1])
        by = np.lexsort((before, which))
        which, place, before = which[by], place[by], before[by]
        edge = np.searchsorted(which, np.arange(len(found) + 1))
        window, at = _spread(test.at[found], test.at[found + 1])
        q = test.starts[at]
        number = self.numbers(test.hash)
        word = np.where(q == test.first[test.item[q]], -2, number[q - 1])
        # of the places of a window, those before and after the run with the same word before
        key, most = which * (len(self.vocabulary) + 2) + before, len(self.vocabulary) + 2
        left = np.where(word > 0, np.searchsorted(key, window * most + np.maximum(word, 0), "left"), edge[window + 1])
        right = np.where(word > 0, np.searchsorted(key, window * most + np.maximum(word, 0), "right"), edge[window + 1])
        begin, stop = np.concatenate([edge[window], right]), np.concatenate([left, edge[window + 1]])
        q = np.concatenate([q, q])
        total = np.cumsum(stop - begin)
        cut = 0
        ours, theirs = Sequences(self.words.hash), Sequences(test.hash)
        while cut < len(q):
            # ranges of about a chunk; one of more is a chunk of its own
            upto = max(cut + 1, int(np.searchsorted(total, (total[cut - 1] if cut else 0) + CHUNK, "right")))
            pair, member = _spread(begin[cut:upto], stop[cut:upto])
            a, p = q[cut:upto][pair], place[member]
            room = np.minimum(test.first[1:][test.item[a]] - a, self.words.first[1:][self.row[p]] - p)
            # the longest common run: hashes of runs are equal up to it
            low, high = np.ones(len(a), np.int64), room
            while len(a):
                open_ = np.flatnonzero(low < high)
                if not len(open_):
                    break
                mid = (low[open_] + high[open_] + 1) >> 1
                same = theirs.of(a[open_], mid) == ours.of(p[open_], mid)
                low[open_] = np.where(same, mid, low[open_])
                high[open_] = np.where(same, high[open_], mid - 1)
            yield a, p, low
            cut = upto


def _blocks(bench: DataFrame, item: str, text: str, block_bytes: int, width: int) -> list[Broadcast]:
    """Test sets of about ``block_bytes`` text each; repeated items are one. One at a time passes the driver."""
    rows = bench.select(column(item).alias("id"), column(text).alias("text")).where(F.col("text").isNotNull()).distinct()
    size = rows.agg(F.sum(F.octet_length("text") + 64)).first()[0] or 0
    n = max(1, -(-size // block_bytes))
    context = bench.sparkSession.sparkContext
    return [context.broadcast(TestSet.of_rows(rows.where(F.pmod(F.xxhash64("id", "text"), F.lit(n)) == i).collect(), width))
            for i in range(n)]


def _each(blocks: list[Broadcast]) -> Iterator[TestSet]:
    """The test sets one after another; with several, each is given back before the next is read."""
    for shipped in blocks:
        yield shipped.value
        if len(blocks) > 1:
            vars(shipped).pop("_value", None)


def _digest(ids: list[str]) -> str:
    return hashlib.sha256(",".join(ids).encode()).hexdigest()


def annotate(docs: DataFrame, bench: DataFrame, width: int = WINDOW, text: str = "text", item: str = "item_id",
             item_text: str = "text", keep: list[str] | None = None, block_bytes: int = BLOCK_BYTES,
             drop: bool = False, longest: bool = True) -> DataFrame:
    """Append to every document its overlap with the benchmark.

    Adds n_words, n_hit (words inside any occurrence of a window), n_items, items_sha256
    (over the item ids, sorted as strings and comma-joined), contaminated, and with
    ``longest`` longest_match (words of the longest verbatim match, 0 without one). A window
    is ``width`` consecutive item words, or a whole shorter item. ``drop`` leaves out
    contaminated documents and the added columns. A null or wordless text has no words and no
    hits; a null item text is ignored, a null item id counts as ''. Rows that repeat a document
    are judged one by one, items that share an id count once. A column of ``docs`` named like
    an added one gives way to it; all others stay.
    """
    blocks = _blocks(bench, item, item_text, block_bytes, width)
    clean = pa.scalar(_digest([]), pa.string())

    def rows_of(part):
        words = find_words(part.column(part.schema.get_field_index(text)), ALNUM, lower=True)
        shard, n_docs = Shard(words), part.num_rows
        edge = np.zeros(len(words.hash) + 1, np.int64)
        items: dict[int, set[str]] = {}
        most = np.zeros(n_docs, np.int64)
        for test in _each(blocks):
            found, lo, hi = shard.ranges(test)
            for need in np.unique(test.need[found]):
                mine = np.flatnonzero(test.need[found] == need)
                which, place = shard.places(lo[mine], hi[mine])
                # windows of one length start at different words
                edge[place] += 1
                edge[place + need] -= 1
                if drop:
                    continue
                pairs = np.unique(shard.row[place] * len(mine) + which)
                for doc, some in _grouped(pairs // len(mine), found[mine[pairs % len(mine)]]):
                    hit = np.zeros(len(test.ids), bool)
                    for c in some:
                        hit[test.items[test.of[c]:test.of[c + 1]]] = True
                    items.setdefault(doc, set()).update(test.ids[i] for i in np.flatnonzero(hit))
            if longest and not drop and len(found):
                for _, p, n in shard.maximal(test):
                    np.maximum.at(most, shard.row[p], n)
        covered = np.concatenate([[0], np.cumsum(np.cumsum(edge)[:-1] > 0)])
        hit = covered[words.first[1:]] - covered[words.first[:-1]]
        if drop:
            return [pa.array(hit == 0)]
        n_items = np.array([len(items.get(r, ())) for r in range(n_docs)], np.int64)
        digests = {r: _digest(sorted(ids)) for r, ids in items.items()}
        digest = pa.array([digests.get(r) for r in range(n_docs)], pa.string()).fill_null(clean)
        out = [pa.array(np.diff(words.first)), pa.array(hit), pa.array(n_items), digest, pa.array(hit > 0)]
        return [*out, pa.array(most)] if longest else out

    fields = [] if drop else RESULT if longest else RESULT[:-1]
    return add_columns(docs, rows_of, fields, keep, text, SHARD_BYTES)


def _grouped(keys: np.ndarray, values: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Values of each of the sorted keys."""
    begin = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else []
    for a, b in zip(begin, np.append(begin[1:], len(keys)), strict=True):
        yield int(keys[a]), values[a:b]


def matches(docs: DataFrame, bench: DataFrame, width: int = WINDOW, doc_id: str = "doc_id", text: str = "text",
            item: str = "item_id", item_text: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Maximal verbatim matches of at least a window: (doc_id, item_id, begin, item_begin, n_words), in words."""
    ship(docs.sparkSession)
    blocks = _blocks(bench, item, item_text, block_bytes, width)
    source = docs.select(column(doc_id).alias("doc_id"), column(text).alias("text"))
    kind = source.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", "item_id", "begin", "item_begin", "n_words"]

    def run(batches):
        for batch in batches:
            for part in slices(batch, "text", SHARD_BYTES):
                words = find_words(part.column(1), ALNUM, lower=True)
                shard = Shard(words)
                for test in _each(blocks):
                    ids = pa.array(test.ids, pa.string())
                    for q, p, n in shard.maximal(test):
                        row, of = shard.row[p], test.item[q]
                        yield pa.RecordBatch.from_arrays(
                            [part.column(0).take(pa.array(row)), ids.take(pa.array(of)), pa.array(p - words.first[row]),
                             pa.array(q - test.first[of]), pa.array(n)], names=names)
        release()

    return source.mapInArrow(run, f"doc_id {kind}, item_id string, begin long, item_begin long, n_words long")


def remove_contaminated(docs: DataFrame, bench: DataFrame, **options) -> DataFrame:
    """Documents that share no window with the benchmark, with their columns as they are."""
    return annotate(docs, bench, drop=True, **options)
