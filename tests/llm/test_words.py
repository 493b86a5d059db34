import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from tessera.llm.words import ALNUM, SPACED, Sequences, find_words

TEXTS = st.lists(st.one_of(st.none(), st.text(alphabet="aZ0 .-\n\té日\x7f{", max_size=40)), max_size=8)


@settings(max_examples=150, deadline=None)
@given(TEXTS)
def test_words_are_those_of_the_patterns(texts):
    column = pa.array(texts, pa.string())
    for table, lower, pattern in ((SPACED, False, r"[^\x20\x09-\x0D]+"), (ALNUM, True, r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")):
        words = find_words(column, table, lower)
        found = [bytes(words.data[a:b]).decode() for a, b in zip(words.start, words.end)]
        fold = (lambda t: "".join(c.lower() if c.isascii() else c for c in t)) if lower else (lambda t: t)
        want = [re.findall(pattern, fold(t or "")) for t in texts]
        assert [fold(w) for w in found] == [w for row in want for w in row]
        assert np.diff(words.first).tolist() == [len(row) for row in want]
        by_hash = {}
        for w, h in zip(found, words.hash.tolist()):
            assert by_hash.setdefault(h, fold(w)) == fold(w)
        assert len(by_hash) == len({fold(w) for w in found})


def test_slice_of_a_column_and_long_words():
    long = "x" * 5000
    column = pa.array(["drop", "a " + long, None, long + "y a"])[1:]
    words = find_words(column, SPACED)
    assert np.diff(words.first).tolist() == [2, 0, 2]
    assert words.hash[0] == words.hash[3] and words.hash[1] != words.hash[2]


def test_sequence_hash_depends_on_words_and_order_only():
    words = find_words(pa.array(["p q r s", "z p q r", "r q p"]), SPACED)
    for which in (0, 1):
        seq = Sequences(words.hash, which)
        h = seq.of(np.array([0, 5, 8, 1]), np.array([3, 3, 3, 3]))
        assert h[0] == h[1] and len(set(h.tolist())) == 3
