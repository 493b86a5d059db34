"""Corpus cleaning pipeline: toxicity, near duplicates, repeated spans, benchmark leaks, mixing.

``STAGES`` lists (name, function) pairs; every function takes (spark, docs, sf_dir) and
returns the documents it keeps. ``run`` applies them to ``documents``; each result is
written as Parquet to the folder in spark.checkpoint.dir and read again as the next
stage's input, so a lost executor costs at most a stage.
"""

from __future__ import annotations

import os
import sys
import uuid

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from tessera.llm import decontaminate, mixing, near, substrings, toxicity  # noqa: E402
from tessera.llm.graph import shared_folder  # noqa: E402
from tessera.llm.words import column  # noqa: E402


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model does not reject.

    The model is fitted on the labelled documents of the stage's own input; a null or empty
    text has no features and stays.
    """
    model = toxicity.train(docs, _table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model, drop=True)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id, of each group with 5-gram similarity >= 0.8.

    Of rows that repeat an id with the same set of 5-grams, such as rows delivered twice, one stays.
    """
    return near.keep_one(docs, repeats=False)


def cut_repeated_spans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the 50-word windows that an earlier document has; n_chars follows the text.

    A document that loses every word goes; one that had no words stays as it is.
    """
    cut = substrings.remove_repeats(docs, counts=("__words", "__removed")).where("__removed = 0 or __removed < __words")
    changed = F.col("__removed") > 0
    if "n_chars" in docs.columns:
        size = F.char_length("text").cast(docs.schema["n_chars"].dataType)
        cut = cut.withColumn("n_chars", F.when(changed, size).otherwise(F.col("n_chars")))
    return cut.select(*[column(c) for c in docs.columns])


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share no 10-word window with a benchmark item."""
    return decontaminate.remove_contaminated(docs, _table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents replicated to equal source weights, in a global random order."""
    return mixing.mix_sources(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("substring_dedup", cut_repeated_spans),
    ("decontamination", drop_contaminated),
    ("mixing", mix),
]

#: The toxicity model is trained, which SQL cannot express; tests use a brute-force version.
ORACLE_SQL = None


def _remove(spark: SparkSession, path: str) -> None:
    """Delete a folder of this run in the file system that holds it."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's documents. A stage's folder is removed when the next one is written; the
    last one stays, as the result reads it."""
    docs = _table(spark, sf_dir, "documents")
    base = f"{shared_folder(spark)}/corpus-{uuid.uuid4().hex}"
    before = None
    for k, (name, stage) in enumerate(STAGES):
        path = f"{base}/{k}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if before:
            _remove(spark, before)
        before = path
    return docs
