import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.llm import substrings as S

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows, width):
    """{index: (n_words, kept words)}"""
    first = {}
    toks = [WORD.findall(t or "") for _, t in rows]
    for (doc, _), w in zip(rows, toks):
        for i in range(len(w) - width + 1):
            if doc is not None:
                key = tuple(w[i:i + width])
                first[key] = min(first.get(key, doc), doc)
    out = []
    for (doc, text), w in zip(rows, toks):
        gone = [False] * len(w)
        for i in range(len(w) - width + 1):
            if doc is not None and first[tuple(w[i:i + width])] < doc:
                gone[i:i + width] = [True] * width
        out.append((doc, len(w), None if text is None else " ".join(x for x, g in zip(w, gone) if not g)))
    return sorted(out, key=repr)


def check(df, width):
    rows = [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]
    got = S.remove_repeats(df, width, joined=True).collect()
    assert sorted([(r.doc_id, r.n_words, r.text) for r in got], key=repr) == brute(rows, width)


@pytest.mark.parametrize(("width", "letters", "seed"), [(3, 2, 1), (5, 2, 2), (8, 3, 3), (12, 4, 4)])
def test_matches_brute_force(frame, width, letters, seed):
    rng = np.random.default_rng(seed)
    base = [" ".join(rng.choice(list("abcd")[:letters], 40)) for _ in range(6)]
    rows = []
    for i in range(40):
        a = base[rng.integers(6)].split()
        cut = rng.integers(0, 40)
        rows.append((int(rng.permutation(100)[0]) + 100 * i, "\n".join(a[cut:]) + "  " + " ".join(rng.choice(list("abxy"), rng.integers(0, 30)))))
    check(frame(rows, "doc_id long, text string"), width)


def test_registered_query_table(documents):
    check(documents, 50)


def test_hard_rows(hard_docs):
    check(hard_docs, 50)
    out = S.remove_repeats(hard_docs)
    assert out.columns == [*hard_docs.columns, "n_words", "n_removed"]
    assert out.where("doc_id = 4").first()["n_removed"] == 30_000


def test_text_between_kept_words_stays(frame):
    same = " ".join(f"w{i}" for i in range(10))
    docs = frame([(1, same), (2, f"Keep  this\n\n{same}\tand  that ")], "doc_id long, text string")
    got = S.remove_repeats(docs, 10).where("doc_id = 2").first()
    assert got["text"] == "Keep  this\n\nand  that " and got["n_removed"] == 10


def test_empty_table_and_clashing_names(spark, frame):
    assert S.remove_repeats(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    docs = frame([(1, "a b", 9, "q")], "doc_id long, text string, N_words int, __nodes string")
    got = S.remove_repeats(docs, 2)
    assert got.columns == ["doc_id", "text", "n_words", "n_removed"] and got.first()["n_words"] == 2


def test_every_window_holds_a_node():
    from tessera.llm.words import SPACED, find_words
    import pyarrow as pa

    rng = np.random.default_rng(5)
    for width in (1, 2, 3, 7, 8, 50):
        text = pa.array([" ".join(rng.choice(list("abc"), 300)), " ".join(["x"] * 120)])
        nodes = S.Nodes(find_words(text, SPACED), width)
        _, i, j = nodes.windows()
        assert (i <= j).all() and len(i) == 300 - width + 1 + 120 - width + 1
        assert np.diff(nodes.at)[np.diff(nodes.row) == 0].max() <= nodes.k


def test_docs_exchange_is_reused(documents):
    out = S.remove_repeats(documents.select("doc_id", "text")).agg(F.sum("n_removed"))
    out.collect()
    assert out._jdf.queryExecution().executedPlan().toString().count("ReusedExchange") >= 1
