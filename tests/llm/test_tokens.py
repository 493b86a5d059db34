import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tessera.llm import tokens as K


@pytest.fixture(scope="module")
def vocabulary():
    return K.load()


def tokenizer(v):
    from tokenizers import Tokenizer, models

    pieces = [("<unk>", 0.0), *v.scores.items(), *((f"<0x{i:02X}>", -1000.0) for i in range(256))]
    return Tokenizer(models.Unigram(pieces, unk_id=0, byte_fallback=True))


def test_counts_equal_the_public_unigram_model(spark, documents, vocabulary):
    t, seen = tokenizer(vocabulary), {}
    for r in K.token_counts(documents, vocabulary).collect():
        words = re.findall(r"[^\x20\x09-\x0D]+", r.text)
        for w in words:
            if w not in seen:
                seen[w] = len(t.encode(K.MARK + w, add_special_tokens=False).ids)
        assert (r.n_words, r.n_tokens) == (len(words), sum(seen[w] for w in words))


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet="abcé日", min_size=1, max_size=9), max_size=12))
def test_shared_prefixes_change_nothing(words):
    v = K.Vocabulary({"▁": -2.0, "a": -3.0, "b": -3.1, "c": -3.3, "ab": -4.2, "▁a": -3.9, "bca": -5.03, "é": -4.4, "cé": -6.07}, -20.0)

    def plain(text):
        best = [(0.0, 0)]
        for end in range(1, len(text) + 1):
            ways = [(best[b][0] + v.scores[text[b:end]], best[b][1] + 1) for b in range(end) if text[b:end] in v.scores]
            if text[end - 1] not in v.scores:
                ways.append((best[end - 1][0] + v.unknown, best[end - 1][1] + len(text[end - 1].encode())))
            best.append(max(ways, key=lambda w: w[0]))
        return best[-1][1]

    words = sorted(words)
    assert K.count_words(words, v) == [plain(K.MARK + w) for w in words]


def test_edges(spark, hard_docs, vocabulary):
    got = {(r.doc_id, r.n_words) for r in K.token_counts(hard_docs, vocabulary).collect()}
    assert {(1, 0), (2, 0), (6, 0), (3, 30_000), (7, 1), (5, 2)} <= got
    assert K.token_counts(hard_docs.limit(0), vocabulary).count() == 0
    named = hard_docs.selectExpr("*", "'x' AS N_tokens")
    assert K.token_counts(named, vocabulary).columns == [*hard_docs.columns, "n_words", "n_tokens"]
