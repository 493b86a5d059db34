"""One registered query per operator, over its whole table, and SQL for those SQL can state."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import (ann, codes, decontaminate, languages, mixing, near, negatives, pages, products, quality, sql, substrings,
                         tokens, toxicity)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _bucket(n: int):
    """crc32(doc_id as text) mod n."""
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(n))


def op1_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document; rows of crc32 remainder 2 are held out from learning."""
    docs, held_out = _table(spark, sf_dir, "documents"), _bucket(4) == 2
    profiles = languages.train(docs.where(~held_out))
    return languages.predict(docs, profiles, keep=["doc_id"]).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op2_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents replicated to equal source weights, in a global random order."""
    return mixing.mix_sources(_table(spark, sf_dir, "documents"))


def op3_inverted_multi_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 nearest vectors found for every hundredth vector."""
    vectors = _table(spark, sf_dir, "embeddings")
    return ann.nearest(vectors, vectors.where("vec_id % 100 = 0"))


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Overlap of every document with the benchmark."""
    return decontaminate.annotate(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"),
                                  keep=["doc_id"], longest=False)


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words left of every document without the 50-word spans of earlier documents."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    kept = substrings.remove_repeats(docs, joined=True)
    return kept.select("doc_id", "n_words", "n_removed",
                       F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("kept_sha256"))


def op6_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate class and number of links of every document."""
    return near.near_duplicates(_table(spark, sf_dir, "documents"))


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words and unigram tokens of every document."""
    return tokens.token_counts(_table(spark, sf_dir, "documents"), keep=["doc_id"])


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document; labels of crc32 remainder 2 are held out."""
    docs, held_out = _table(spark, sf_dir, "documents"), _bucket(4) == 2
    model = quality.train(docs, _table(spark, sf_dir, "labels").where(~held_out))
    return quality.score(docs, model, keep=["doc_id"]).select("doc_id", held_out.alias("held_out"), "score", "predicted")


def op9_page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return pages.extract(_table(spark, sf_dir, "pages"), keep=["page_id", "url"])


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document; labels of crc32 remainder 0 are held out."""
    docs, held_out = _table(spark, sf_dir, "documents"), _bucket(5) == 0
    model = toxicity.train(docs, _table(spark, sf_dir, "labels").where(~held_out))
    return toxicity.score(docs, model, keep=["doc_id"]).select("doc_id", held_out.alias("held_out"), "score", "predicted")


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Product code and error of every vector."""
    return codes.compress(_table(spark, sf_dir, "embeddings"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every hundredth vector; every seventh vector moves to the next label."""
    vectors = _table(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = vectors.withColumn("label", moved)
    return negatives.mine(vectors, vectors.where("vec_id % 100 = 0"))


def op13_top_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 highest inner products of every twentieth vector."""
    vectors = _table(spark, sf_dir, "embeddings")
    return products.top_products(vectors, vectors.where("vec_id % 20 = 0"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_language, op2_mix_sources, op3_inverted_multi_index, op4_decontaminate, op5_substring_dedup, op6_ngram_jaccard,
        op7_token_counts, op8_quality, op9_page_text, op10_toxicity, op11_vector_codes, op12_hard_negatives,
        op13_top_products)}

ORACLE: dict[str, str] = {
    "op2_mix_sources": mixing.ORACLE_SQL,
    "op4_decontaminate": sql.DECONTAMINATE,
    "op5_substring_dedup": sql.SUBSTRINGS,
    "op6_ngram_jaccard": sql.NEAR,
    "op11_vector_codes": sql.CODES,
    "op12_hard_negatives": sql.NEGATIVES,
    "op13_top_products": sql.PRODUCTS,
}
