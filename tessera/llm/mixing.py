"""Mixing sources to target weights by Poisson replication, in DataFrame functions only.

A source with weight w gets the mean repetition rate w * budget / (its documents). A uniform
number seeded by a hash of the document is inverted in the Poisson distribution of that
rate, so the count of a document depends on nothing but its id, the seed and the rate, and
a lost task gives the same copies again. Copies are exploded and dealt by a hash of
(document, copy): that spreads hot sources and often repeated documents evenly, and sorting
each partition by the hash gives a global random order.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.words import column, without

SEED = "mix-1"
#: Sources (about 100 bytes each, with their rates) that are broadcast; more are joined by a shuffle.
BROADCAST_SOURCES = 100_000


def uniform(key: Column, seed: str) -> Column:
    """A number in [0, 1) from the first 52 bits of md5(seed:key)."""
    digits = F.substring(F.md5(F.concat(F.lit(seed + ":"), key).cast("binary")), 1, 13)
    return F.conv(digits, 16, 10).cast("double") / F.lit(float(1 << 52))


def poisson_count(u: Column, rate: Column) -> Column:
    """The smallest k whose cumulative Poisson probability passes ``u``: terms are added up from
    where they are above 0 to where the rest is below 1e-15, so it takes about as many steps as
    it gives copies, and 50 times the root of a large rate."""
    low = F.floor(rate - 40 * F.sqrt(rate))
    first = F.when(low >= 256, low).otherwise(0).cast("long")
    last = F.ceil(rate + 10 * F.sqrt(rate) + 20).cast("long")
    x = first.cast("double")
    # ln(first!) by Stirling's series
    log_factorial = F.when(first > 0, x * F.ln(x) - x + 0.5 * F.ln(2 * math.pi * x) + 1 / (12 * x) - 1 / (360 * x * x * x)).otherwise(0.0)
    start = F.struct((x * F.ln(rate) - rate - log_factorial).alias("log_p"), F.lit(0.0).alias("total"), F.lit(-1).cast("long").alias("n"))

    def step(a, k):
        # a sum is compared one step later, so that it is computed once
        return F.struct((a["log_p"] + F.ln(rate) - F.ln((k + 1).cast("double"))).alias("log_p"), (a["total"] + F.exp(a["log_p"])).alias("total"),
                        (a["n"] + (a["total"] <= u).cast("long")).alias("n"))

    counted = F.aggregate(F.sequence(first, last), start, step, lambda a: a["n"] + (a["total"] <= u).cast("long"))
    return F.when(rate > 0, first + counted).otherwise(F.lit(0).cast("long"))


def mix_sources(docs: DataFrame, weights: DataFrame | None = None, budget: float | None = None, seed: str = SEED,
                doc_id: str = "doc_id", source: str = "source", size: str | None = None) -> DataFrame:
    """Replicate documents so that sources come out in the proportion of their weights.

    ``weights`` (source, weight >= 0) is normalized to sum 1; without it all sources weigh the
    same, and a source that is not listed gets nothing. ``budget`` is the expected number of
    rows (the number of documents by default); with ``size`` (a numeric column, e.g. tokens)
    weights hold for the sums of it. Adds copy_no (from 0) and mix_key, by which every
    partition is sorted; columns of these names give way. All copies of a document carry its
    columns unchanged.

    A null source is a source of its own (weight from a null row of ``weights``). A null id is
    an id: its rows get the same count. Rows that repeat an id are replicated alike, one by one.
    A null or negative size counts as 0; a source whose sizes sum to 0 gets nothing.
    """
    docs = without(docs, ["copy_no", "mix_key", "__rate", "__source", "__u", "__n"])
    mass = F.lit(1.0) if size is None else F.greatest(F.coalesce(column(size).cast("double"), F.lit(0.0)), F.lit(0.0))
    sums = docs.groupBy(column(source).alias("__source")).agg(F.sum(mass).alias("__mass"), F.count(F.lit(1)).alias("__rows"))
    if weights is None:
        sums = sums.withColumn("__weight", F.lit(1.0))
    else:
        given = weights.select(column(source).alias("__s"), column("weight").cast("double").alias("__weight"))
        sums = (sums.join(given.groupBy("__s").agg(F.sum("__weight").alias("__weight")), F.col("__source").eqNullSafe(F.col("__s")), "left")
                .drop("__s").withColumn("__weight", F.coalesce("__weight", F.lit(0.0))))
    # one row a source: their totals are an aggregate of that small table
    total = sums.agg(F.sum(F.when(F.col("__mass") > 0, F.col("__weight"))).alias("w"), F.sum("__mass").alias("m"),
                     F.count(F.lit(1)).alias("n")).first()
    weight = total["w"] or 0.0
    target = float(total["m"] or 0.0) if budget is None else float(budget)
    rate = (F.when((F.col("__mass") > 0) & F.lit(weight > 0), F.col("__weight") * F.lit(target) / F.lit(weight or 1.0) / F.col("__mass"))
            .otherwise(0.0))
    rates = sums.select("__source", rate.alias("__rate")).where("__rate > 0")
    rates = F.broadcast(rates) if total["n"] <= BROADCAST_SOURCES else rates
    u = uniform(F.coalesce(column(doc_id).cast("string"), F.lit("")), seed)
    drawn = docs.join(rates, column(source).eqNullSafe(F.col("__source"))).drop("__source")
    drawn = drawn.withColumn("__u", u)
    drawn = drawn.withColumn("__n", poisson_count(F.col("__u"), F.col("__rate")).cast("int")).drop("__rate", "__u").where("__n > 0")
    copies = drawn.withColumn("copy_no", F.explode(F.sequence(F.lit(0), F.col("__n") - 1))).drop("__n")
    key = F.md5(F.concat_ws(":", F.lit(seed), F.coalesce(column(doc_id).cast("string"), F.lit("")), F.col("copy_no").cast("string")).cast("binary"))
    return copies.withColumn("mix_key", key).repartition(F.col("mix_key")).sortWithinPartitions("mix_key")


ORACLE_SQL = """
WITH sums AS (SELECT source, count(*) AS docs FROM documents GROUP BY source),
rates AS (
  SELECT source, (SELECT count(*) FROM documents)::DOUBLE / (SELECT count(*) FROM sums) / docs AS rate FROM sums),
terms AS (
  SELECT source, k, exp(sum(CASE WHEN k > 0 THEN ln(rate) - ln(k) ELSE -rate END) OVER (PARTITION BY source ORDER BY k)) AS p
  FROM rates, LATERAL unnest(range(0, ceil(rate + 10 * sqrt(rate) + 20)::BIGINT + 1)) g(k)),
steps AS (SELECT source, k, sum(p) OVER (PARTITION BY source ORDER BY k) AS cdf FROM terms),
drawn AS (
  SELECT d.*, ('0x' || substr(md5('mix-1:' || coalesce(doc_id::VARCHAR, '')), 1, 13))::BIGINT / 4503599627370496.0 AS u
  FROM documents d),
counted AS (
  SELECT doc_id, (SELECT count(*) FROM steps s WHERE s.source IS NOT DISTINCT FROM drawn.source AND s.cdf <= drawn.u) AS n FROM drawn)
SELECT d.doc_id, d.text, d.lang, d.source, d.n_chars, c.copy_no::INTEGER AS copy_no,
       md5('mix-1:' || coalesce(d.doc_id::VARCHAR, '') || ':' || c.copy_no) AS mix_key
FROM documents d JOIN (SELECT doc_id, unnest(range(0, n)) AS copy_no FROM counted WHERE n > 0) c USING (doc_id)
"""
