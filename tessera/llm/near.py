"""N-gram Jaccard join: MinHash banding, verified on the full n-gram sets.

1. One map pass gives every document a 128-bit key of its n-gram set and the hashes of its
   MinHash bands. Band and row counts follow from the wanted recall at the threshold.
   Documents of equal sets are one class; only its first document goes on.
2. Band hashes are shuffled; buckets with one class are dropped.
3. Buckets of up to ``small`` classes give candidate pairs, distinct over the bands, with
   sizes that allow the threshold. Their full sets are joined and the similarity computed.
4. Larger buckets are never expanded into pairs: members are dealt into blocks by the size of
   their sets. Sets whose sizes differ by more than the threshold cannot be linked, so a block
   meets only those of its own and the next size band; a block is bounded in members and in
   bytes. Each such pair of blocks is one group, and a matrix product counts what all its
   pairs share. A pair in several large buckets counts in the first one only. A group
   returns one row per member (its links and the smallest class it hangs together with).
5. Links give the number of links of every document and, by star contraction, its component.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.graph import checkpointed, components, join_ids
from tessera.llm.ship import ship
from tessera.llm.words import ALNUM, Sequences, Words, add_columns, column, find_words, mix, release, slices

NGRAM, THRESHOLD, RECALL = 5, 0.8, 0.9999
SMALL, BLOCK = 64, 512
#: Grams of a block take at most so many bytes (one larger set is a block of its own).
BLOCK_BYTES = 16 << 20
_U = np.uint64
_ODD = _U(0x9FB21C651E98DF25)


def banding(threshold: float = THRESHOLD, recall: float = RECALL, most_hashes: int = 128) -> tuple[int, int]:
    """(bands, rows): the most selective rows whose bands reach ``recall`` at ``threshold``."""
    best = None
    for rows in range(1, 33):
        bands = max(1, math.ceil(math.log(1 - recall) / math.log1p(-(threshold ** rows)))) if threshold < 1 else 1
        if bands * rows <= most_hashes:
            best = bands, rows
    return best or (most_hashes, 1)


def _multipliers(n: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.Generator(np.random.PCG64(7))
    return rng.integers(0, 2**64, n, dtype=_U) | _U(1), rng.integers(0, 2**64, n, dtype=_U)


def ngram_sets(words: Words, n: int):
    """Distinct n-gram hashes of each text: (hashes, text of each). A shorter text that has
    words is one gram."""
    size = np.diff(words.first)
    grams = np.where(size > 0, np.maximum(size - n + 1, 1), 0)
    row = np.repeat(np.arange(len(size)), grams)
    at = np.arange(len(row)) - np.repeat(np.cumsum(grams) - grams, grams) + words.first[:-1][row]
    h = Sequences(words.hash).of(at, np.minimum(n, size)[row])
    _, index = np.unique(mix(h + row.astype(_U) * _ODD), return_index=True)
    index.sort()
    return h[index], row[index]


def _column(part, name):
    return part.column(part.schema.get_field_index(name))


def signatures(docs: DataFrame, n: int, bands: int, rows: int, doc_id: str, text: str) -> DataFrame:
    """(doc, s1, s2, size, bands) of every document that has words."""
    source = docs.select(column(doc_id).cast("long").alias("doc"), column(text).alias("text"))
    source = source.where("doc is not null and text is not null")
    a, b = _multipliers(bands * rows)

    def run(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                h, row = ngram_sets(find_words(_column(part, "text"), ALNUM, lower=True), n)
                begin = np.flatnonzero(np.append([True], row[1:] != row[:-1])) if len(h) else np.zeros(0, np.int64)
                out = [_column(part, "doc").take(pa.array(row[begin]))]
                if len(h):
                    size = np.diff(np.append(begin, len(h)))
                    s1, s2 = np.add.reduceat(mix(h), begin), np.add.reduceat(mix(h ^ _ODD), begin)
                    keys = np.empty((len(begin), bands), _U)
                    for i in range(bands):
                        key = np.full(len(begin), _U(i + 1))
                        for j in range(i * rows, (i + 1) * rows):
                            key = mix(key + np.minimum.reduceat(h * a[j] + b[j], begin))
                        keys[:, i] = key
                    flat = pa.array(keys.ravel().view(np.int64))
                    lists = pa.ListArray.from_arrays(pa.array(np.arange(len(begin) + 1, dtype=np.int32) * bands), flat)
                    out += [pa.array(s1.view(np.int64)), pa.array(s2.view(np.int64)), pa.array(size), lists]
                else:
                    out += [pa.array([], pa.int64())] * 3 + [pa.array([], pa.list_(pa.int64()))]
                yield pa.RecordBatch.from_arrays(out, names=["doc", "s1", "s2", "size", "bands"])
        release()

    return source.mapInArrow(run, "doc long, s1 long, s2 long, size long, bands array<long>")


def gram_lists(docs: DataFrame, n: int) -> DataFrame:
    """(doc, grams) of documents given as (doc, text)."""

    def run(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                h, row = ngram_sets(find_words(_column(part, "text"), ALNUM, lower=True), n)
                offsets = np.searchsorted(row, np.arange(part.num_rows + 1)).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(h.view(np.int64)))
                yield pa.RecordBatch.from_arrays([_column(part, "doc"), lists], names=["doc", "grams"])
        release()

    return docs.mapInArrow(run, "doc long, grams array<long>")


def _shared(sets: list[np.ndarray], width: int = 4096) -> np.ndarray:
    """Number of grams that each two sets share."""
    member = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, gram, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    often = count > 1
    number = np.cumsum(often) - 1
    use = often[gram]
    member, gram = member[use], number[gram[use]]
    by = np.argsort(gram, kind="stable")
    member, gram = member[by], gram[by]
    both = np.zeros((len(sets), len(sets)))
    for begin in range(0, int(often.sum()), width):
        i, j = np.searchsorted(gram, [begin, begin + width])
        m = np.zeros((len(sets), width), np.float32)
        m[member[i:j], gram[i:j] - begin] = 1
        both += m @ m.T
    return both


def _block_links(frame: pa.Table, threshold: float) -> pa.Table:
    """Links within one pair of blocks of one large bucket: a row per member."""
    frame = frame.combine_chunks()
    bucket = frame["bucket"][0].as_py()
    doc = frame["doc"].to_numpy()
    grams = frame["grams"].combine_chunks()
    flat, offsets = grams.flatten().to_numpy(), np.append(0, np.cumsum(grams.value_lengths().to_numpy()))
    sets = [flat[a:b] for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
    size = np.diff(offsets)
    both = _shared(sets)
    link = both / np.maximum(size[:, None] + size[None, :] - both, 1.0) >= threshold
    link &= doc[:, None] != doc[None, :]
    if frame["i"][0] != frame["j"][0]:  # pairs across the two blocks only
        block = frame["block"].to_numpy()
        link &= block[:, None] != block[None, :]
    # a pair counts in the first large bucket that it shares
    earlier: dict[int, list[int]] = {}
    for m, buckets in enumerate(frame["large"].to_pylist()):
        for x in buckets:
            if x < bucket:
                earlier.setdefault(x, []).append(m)
    for members in earlier.values():
        if len(members) > 1:
            link[np.ix_(members, members)] = False
    copies = frame["copies"].to_numpy()
    root = doc.copy()
    while True:  # smallest document that hangs together with each
        new = np.minimum(root, np.where(link, root[None, :], np.iinfo(np.int64).max).min(axis=1))
        if (new == root).all():
            break
        root = new
    linked = link.any(axis=1)
    return pa.table({"doc": doc[linked], "n": (link @ copies)[linked], "root": root[linked]})


def block_pairs(large: DataFrame, threshold: float, block: int = BLOCK, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(doc, bucket, block, i, j): the groups (bucket, i, j) in which a member of a large bucket is
    compared; i and j are blocks, ``block`` its own. ``large`` has (doc, bucket, size)."""
    # sizes that allow the threshold differ by one band at most, against rounding too
    band = F.col("size") if threshold >= 1 else F.floor(F.ln(F.col("size").cast("double")) / (math.log(1 / threshold) * (1 + 1e-9)))
    banded = large.select("doc", "bucket", "size", band.cast("long").alias("band"))
    blocks = F.greatest(F.ceil(F.count(F.lit(1)) / block), F.ceil(F.sum("size") * 8 / block_bytes))
    # a few dozen bands a bucket
    per = (banded.groupBy("bucket", "band").agg(blocks.cast("long").alias("blocks")).groupBy("bucket")
           .agg(F.map_from_entries(F.collect_list(F.struct("band", "blocks"))).alias("blocks")))
    here = F.col("band")

    def number(of):
        return F.coalesce(F.try_element_at("blocks", of), F.lit(0).cast("long"))

    def codes(of):
        none = F.array().cast("array<long>")
        return F.when(number(of) > 0, F.transform(F.sequence(F.lit(0).cast("long"), number(of) - 1), lambda b: of * (1 << 24) + b)).otherwise(none)

    own = here * (1 << 24) + F.pmod(F.xxhash64("doc"), number(here))
    others = codes(here) if threshold >= 1 else F.concat(codes(here - 1), codes(here), codes(here + 1))
    dealt = banded.join(per, "bucket").select("doc", "bucket", own.alias("block"), F.explode(others).alias("other"))
    return dealt.select("doc", "bucket", "block", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"))


def links(docs: DataFrame, n: int = NGRAM, threshold: float = THRESHOLD, recall: float = RECALL,
          doc_id: str = "doc_id", text: str = "text", small: int = SMALL, block: int = BLOCK):
    """(members, per_class, edges): documents with their class, links of classes, and edges that span them.

    members (doc, s1, s2); classes (s1, s2, rep, copies); degree (doc, n): linked documents of
    other classes; edges (a, b) between representatives, enough to connect what is linked.
    """
    ship(docs.sparkSession)
    bands, rows = banding(threshold, recall)
    sigs = checkpointed(signatures(docs, n, bands, rows, doc_id, text))
    classes = checkpointed(
        sigs.groupBy("s1", "s2").agg(F.min_by(F.struct("doc", "size", "bands"), "doc").alias("first"),
                                     F.count(F.lit(1)).alias("copies"))
        .select("s1", "s2", F.col("first.doc").alias("rep"), "first.size", "first.bands", "copies"))

    keyed = classes.select(F.col("rep").alias("doc"), "size", F.explode("bands").alias("bucket"))
    counts = keyed.groupBy("bucket").agg(F.count(F.lit(1)).alias("members")).where("members > 1")
    shared = checkpointed(keyed.join(counts, "bucket"))

    pair_buckets = (shared.where(F.col("members") <= small).groupBy("bucket")
                    .agg(F.array_sort(F.collect_list(F.struct("doc", "size"))).alias("m")))
    # i < j of one bucket, at most small^2 / 2 of them; sizes must allow the threshold
    pairs = F.flatten(F.transform("m", lambda x: F.transform(
        F.filter("m", lambda y: (y["doc"] > x["doc"])
                 & (F.least(x["size"], y["size"]) >= threshold * F.greatest(x["size"], y["size"]))),
        lambda y: F.struct(x["doc"].alias("a"), y["doc"].alias("b")))))
    pairs = checkpointed(pair_buckets.select(F.explode(pairs).alias("p")).select("p.a", "p.b").distinct())
    large = checkpointed(shared.where(F.col("members") > small))

    needed = checkpointed(pairs.select(F.col("a").alias("need")).union(pairs.select("b"))
                          .union(large.select("doc")).distinct())
    texts = docs.select(column(doc_id).cast("long").alias("doc"), column(text).alias("text")).where("text is not null")
    sets = gram_lists(join_ids(texts, F.col("doc"), needed, "left_semi"), n)
    weight = classes.select(F.col("rep").alias("doc"), "copies")
    buckets = large.groupBy("doc").agg(F.collect_set("bucket").alias("large"))
    sets = checkpointed(sets.join(weight, "doc", "left").join(buckets, "doc", "left"))

    def side(name):
        return sets.select(F.col("doc").alias(name), F.col("grams").alias(f"g{name}"),
                           F.col("copies").alias(f"c{name}"), F.col("large").alias(f"l{name}"))

    both = F.size(F.array_intersect("ga", "gb"))
    verified = (pairs.join(side("a"), "a").join(side("b"), "b")
                .where(both / (F.size("ga") + F.size("gb") - both) >= threshold)
                .where(~F.coalesce(F.arrays_overlap("la", "lb"), F.lit(False)))
                .select("a", "b", "ca", "cb").distinct())
    verified = checkpointed(verified)
    degree = (verified.select(F.col("a").alias("doc"), F.col("cb").alias("n"))
              .unionByName(verified.select(F.col("b").alias("doc"), F.col("ca").alias("n"))))
    edges = verified.select("a", "b")

    if not large.isEmpty():
        dealt = block_pairs(large, threshold, block)
        full = dealt.join(sets, "doc")
        found = checkpointed(full.groupBy("bucket", "i", "j").applyInArrow(
            lambda frame: _block_links(frame, threshold), "doc long, n long, root long"))
        degree = degree.unionByName(found.select("doc", "n"))
        edges = edges.unionByName(found.select(F.col("doc").alias("a"), F.col("root").alias("b")))
    degree = degree.groupBy("doc").agg(F.sum("n").alias("n"))
    return sigs.select("doc", "s1", "s2"), classes.select("s1", "s2", "rep", "copies"), degree, edges


def near_duplicates(docs: DataFrame, n: int = NGRAM, threshold: float = THRESHOLD, recall: float = RECALL,
                    doc_id: str = "doc_id", text: str = "text", small: int = SMALL, block: int = BLOCK) -> DataFrame:
    """(doc_id, class_id, copy_of, n_links) of every document.

    Two documents are linked if the Jaccard similarity of their sets of word n-grams (words as
    in ``words.ALNUM``, A-Z lower-cased; a text of fewer words is one gram) is at least
    ``threshold``. class_id is the smallest document that a document is connected with by
    links, copy_of the smallest with the same set, n_links the number of documents linked to
    it, copies included.

    A document without words (or a null text) is linked to nothing: its class is itself. A
    row without an id gets nulls and no links. Rows that repeat an id are copies of each other if
    their texts are; else one document that is linked by either.
    """
    members, classes, degree, edges = links(docs, n, threshold, recall, doc_id, text, small, block)
    roots = components(edges)
    per_class = (classes.join(degree.withColumnRenamed("doc", "rep"), "rep", "left")
                 .join(roots.withColumnRenamed("node", "rep"), "rep", "left")
                 .select("s1", "s2", F.col("rep").alias("copy_of"), F.coalesce("root", "rep").alias("class_id"),
                         (F.col("copies") - 1 + F.coalesce("n", F.lit(0))).alias("n_links")))
    known = members.join(per_class, ["s1", "s2"]).select(F.col("doc").alias("doc_id"), "class_id", "copy_of", "n_links")
    ids = docs.select(column(doc_id).cast("long").alias("doc_id"), column(text).alias("text"))
    other = ids.where(F.col("doc_id").isNull() | F.col("text").isNull()
                      | ~F.col("text").rlike(r"[0-9A-Za-z\x{80}-\x{10FFFF}]"))
    other = other.select("doc_id", F.col("doc_id").alias("class_id"), F.col("doc_id").alias("copy_of"),
                         F.when(F.col("doc_id").isNotNull(), F.lit(0).cast("long")).alias("n_links"))
    return known.unionByName(other)


def keep_one(docs: DataFrame, doc_id: str = "doc_id", *, repeats: bool = True, n: int = NGRAM, text: str = "text",
             **options) -> DataFrame:
    """One document of each group of near duplicates: the one with the smallest id.

    Documents are told apart by their ids: rows that repeat the smallest id all stay, unless
    ``repeats`` is false. Then of the rows that repeat an id with the same set of n-grams one
    stays, the smallest over the columns in their order; rows of an id with other sets are
    other texts and stay, and so do rows without an id or without words, which are copies of
    nothing.
    """
    found = near_duplicates(docs, n, doc_id=doc_id, text=text, **options)
    gone = checkpointed(found.where("class_id <> doc_id").select(F.col("doc_id").alias("__gone")).distinct())
    kept = join_ids(docs, column(doc_id).cast("long"), gone, "left_anti")
    return kept if repeats else _one_row(kept, n, doc_id, text)


def _one_row(docs: DataFrame, n: int, doc_id: str, text: str) -> DataFrame:
    """``docs`` without further rows of the same id and set; only rows of repeated ids are shuffled."""
    key = column(doc_id).cast("long")
    counts = docs.select(key.alias("__again")).where("__again is not null").groupBy("__again").count()
    again = checkpointed(counts.where("count > 1").select("__again"))
    if again.isEmpty():
        return docs
    names = docs.columns

    def sets(part):
        h, row = ngram_sets(find_words(_column(part, text), ALNUM, lower=True), n)
        begin = np.flatnonzero(np.append([True], row[1:] != row[:-1])) if len(h) else np.zeros(0, np.int64)
        sums, none = np.zeros((2, part.num_rows), _U), np.ones(part.num_rows, bool)
        if len(h):
            at = row[begin]
            sums[0, at], sums[1, at], none[at] = np.add.reduceat(mix(h), begin), np.add.reduceat(mix(h ^ _ODD), begin), False
        return [pa.array(s.view(np.int64), mask=none) for s in sums]

    fields = [T.StructField("__s1", T.LongType()), T.StructField("__s2", T.LongType())]
    rows = add_columns(join_ids(docs, key, again, "left_semi"), sets, fields, names, text)
    # a window of row number 1 leaves one row of a key in every task before the shuffle
    order = [F.to_json(F.struct(column(f.name))) if "map<" in f.dataType.simpleString() else column(f.name) for f in docs.schema]
    first = F.row_number().over(Window.partitionBy(key, "__s1", "__s2").orderBy(*order))
    one = rows.where("__s1 is not null").withColumn("__first", first).where("__first = 1")
    return (join_ids(docs, key, again, "left_anti")
            .unionByName(rows.where("__s1 is null").select(*[column(c) for c in names]))
            .unionByName(one.select(*[column(c) for c in names])))
