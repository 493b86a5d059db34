"""The pipeline against a brute-force version of every stage on its own input."""

import os

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as P
from tessera.llm import toxicity
from test_decontaminate import brute as brute_overlap
from test_mixing import brute as brute_mix
from test_near import brute as brute_near
from test_substrings import WORD
from test_substrings import brute as brute_cut

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """(input rows, output rows) of every stage, each read back from Parquet."""
    base, out = tmp_path_factory.mktemp("stages"), {}
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for name, stage in P.STAGES:
        stage(spark, docs, SF).write.parquet(f"{base}/{name}")
        result = spark.read.parquet(f"{base}/{name}")
        out[name] = [r.asDict() for r in docs.collect()], [r.asDict() for r in result.collect()]
        if name != P.STAGES[-1][0]:
            assert result.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        docs = result
    return out


def by_id(rows):
    return {r["doc_id"]: r for r in rows}


def test_toxic_documents_go(spark, stages):
    before, after = stages["toxicity"]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    scored = toxicity.score(docs, toxicity.train(docs, labels)).collect()
    keep = {r.doc_id for r in scored if r.score < 0.5}
    assert 0 < len(keep) < len(before) and by_id(after) == {d: r for d, r in by_id(before).items() if d in keep}
    clean = {r.doc_id for r in labels.where("toxic = 0").collect()}
    assert len(clean - keep) <= 0.02 * len(clean)


def test_one_document_of_each_group_stays(stages):
    before, after = stages["near_duplicates"]
    classes = brute_near([(r["doc_id"], r["text"]) for r in before])
    assert by_id(after) == {d: r for d, r in by_id(before).items() if classes[d][0] == d}
    assert len(after) < len(before)


def test_repeated_spans_go(stages):
    before, after = stages["substring_dedup"]
    want = {d: (n, text) for d, n, text in brute_cut([(r["doc_id"], r["text"]) for r in before], 50)}
    got = by_id(after)
    assert set(got) == {d for d, (n, text) in want.items() if n == 0 or text}
    for d, r in got.items():
        assert " ".join(WORD.findall(r["text"])) == want[d][1] and r["n_chars"] == len(r["text"])


def test_contaminated_documents_go(spark, stages):
    before, after = stages["decontamination"]
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    assert by_id(after) == {r["doc_id"]: r for r in before if not brute_overlap(r["text"], items, 10)[-1]}
    assert len(after) < len(before)


def test_mixed_counts(stages):
    before, after = stages["mixing"]
    counts = {}
    for r in after:
        counts[r["doc_id"]] = counts.get(r["doc_id"], 0) + 1
    assert counts == brute_mix(before)


def test_run_writes_and_reads_every_stage(spark, stages):
    got = P.run(spark, SF)
    # only the folder that the result reads is left of the run
    last = got.inputFiles()[0].removeprefix("file://").rsplit("/", 2)
    assert last[1] == "4-mixing" and os.listdir(last[0]) == ["4-mixing"]
    want = stages["mixing"][1]
    assert got.count() == len(want)
    assert got.agg(F.sum("doc_id")).first()[0] == sum(r["doc_id"] for r in want)


@pytest.mark.parametrize("k", range(len(P.STAGES)))
def test_stages_take_hard_rows_and_empty_tables(spark, hard_docs, k):
    name, stage = P.STAGES[k]
    kept = stage(spark, hard_docs, SF)
    assert kept.count() >= 5 and stage(spark, hard_docs.limit(0), SF).count() == 0
    extra = hard_docs.withColumn("n_words", F.lit("mine")).withColumn("Score", F.lit(1))
    if k < len(P.STAGES) - 1:
        found = stage(spark, extra, SF)
        assert found.columns == extra.columns and {r.n_words for r in found.collect()} == {"mine"}


def test_rows_delivered_twice_stay_once(spark, hard_docs, stages):
    near = dict(P.STAGES)["near_duplicates"]
    assert [r.doc_id for r in near(spark, hard_docs, SF).collect()].count(5) == 1
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("doc_id < 60 and text rlike '[a-z]'")
    once = near(spark, docs, SF).collect()
    assert sorted(near(spark, docs.unionByName(docs), SF).collect()) == sorted(once)
