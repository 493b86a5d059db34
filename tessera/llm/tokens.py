"""Token counts of a unigram tokenizer by dynamic programming over a trie of pre-tokens.

A pre-token is a word with the piece alphabet's word mark in front. The distinct pre-tokens
of a slice of texts are walked as a trie, in sorted order: the best forward score (and the
number of pieces on the best path) of a prefix is computed once and shared by all words
that begin with it; the count at a word's last node is its number of tokens. A document's
count is the sum over its words, so nothing is shuffled.

The vocabulary is a file of pieces with scores, read once on the driver and broadcast.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tessera.llm.words import SPACED, add_columns, find_words

MARK = "▁"
DEFAULT_FILE = "/opt/tokenizers/piece_bpe_32k.model"
#: Words whose count a worker remembers (about 100 bytes each).
REMEMBERED = 300_000
SLICE = 2 << 20


@dataclass
class Vocabulary:
    """Pieces with log probabilities. A character outside of it costs ``unknown`` and counts
    one token for each of its UTF-8 bytes."""

    scores: dict[str, float]
    unknown: float
    #: pieces by their characters from last to first; "" holds the score of a whole piece
    endings: dict = field(default_factory=dict, repr=False)

    def __post_init__(self):
        for piece, score in self.scores.items():
            node = self.endings
            for c in reversed(piece):
                node = node.setdefault(c, {})
            node[""] = score


def load(path: str = DEFAULT_FILE) -> Vocabulary:
    """Vocabulary of a sentencepiece model file.

    The scores of a unigram model are used as they are. Those of a merge-ranked model (whole
    numbers 0, -1, -2, ...) are no probabilities: rank r gets Zipf's log(1 / (r + 2.7)), normalized.
    """
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    rows = [(model.id_to_piece(i), model.get_score(i)) for i in range(model.get_piece_size())
            if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
    values = [s for _, s in rows]
    if values and all(float(s).is_integer() for s in values):
        weight = {p: 1 / (k + 2.7) for k, (p, _) in enumerate(sorted(rows, key=lambda r: -r[1]))}
        total = math.fsum(weight.values())
        scores = {p: math.log(w / total) for p, w in weight.items()}
    else:
        scores = dict(rows)
    return Vocabulary(scores, min(scores.values(), default=0.0) - 10.0)


def count_words(words: list[str], vocabulary: Vocabulary) -> list[int]:
    """Tokens of each word; ``words`` must be sorted. Of equal paths the first found, from the
    shortest last piece on, counts."""
    endings, unknown = vocabulary.endings, vocabulary.unknown
    out: list[int] = []
    text, best, pieces = "", [0.0], [0]
    for word in words:
        new = MARK + word
        shared, most = 0, min(len(new), len(text))
        while shared < most and new[shared] == text[shared]:
            shared += 1
        del best[shared + 1:], pieces[shared + 1:]
        text = new
        for end in range(shared + 1, len(text) + 1):
            top, n = -math.inf, 0
            node, begin, single = endings, end, False
            while begin:
                node = node.get(text[begin - 1])
                if node is None:
                    break
                begin -= 1
                score = node.get("")
                if score is not None:
                    single = single or begin == end - 1
                    score += best[begin]
                    if score > top:
                        top, n = score, pieces[begin] + 1
            if not single:
                score = best[end - 1] + unknown
                if score > top:
                    top, n = score, pieces[end - 1] + len(text[end - 1].encode("utf-8", "surrogateescape"))
            best.append(top)
            pieces.append(n)
        out.append(pieces[-1])
    return out


_remembered: dict[int, int] = {}
_owner: list = [None]


def token_counts(docs: DataFrame, vocabulary: Vocabulary | None = None, text: str = "text",
                 keep: list[str] | None = None) -> DataFrame:
    """Append n_words and n_tokens to every document.

    Words are separated by white space (``[\\x20\\x09-\\x0D]``). A null or empty text has no
    words and no tokens. Columns of ``docs`` with these names give way.
    """
    vocabulary = vocabulary or load()
    shipped = docs.sparkSession.sparkContext.broadcast(vocabulary)
    name = repr((len(vocabulary.scores), sorted(vocabulary.scores.items())[:50], vocabulary.unknown, shipped._jbroadcast.id()))

    def rows_of(part):
        v = shipped.value
        if _owner[0] != name:
            _owner[0] = name
            _remembered.clear()
        words = find_words(part.column(part.schema.get_field_index(text)), SPACED)
        distinct, first, inverse = np.unique(words.hash, return_index=True, return_inverse=True)
        keys = distinct.tolist()
        if len(_remembered) > REMEMBERED:
            _remembered.clear()
        raw = words.data.tobytes()
        new = sorted((raw[words.start[i]:words.end[i]].decode("utf-8", "surrogateescape"), k)
                     for i, k in zip(first.tolist(), keys, strict=True) if k not in _remembered)
        _remembered.update(zip((k for _, k in new), count_words([w for w, _ in new], v), strict=True))
        each = np.array([_remembered[k] for k in keys], np.int64)
        total = np.concatenate([[0], np.cumsum(each[inverse])]) if len(keys) else np.zeros(1, np.int64)
        return [pa.array(np.diff(words.first)), pa.array(total[words.first[1:]] - total[words.first[:-1]])]

    return add_columns(docs, rows_of, [T.StructField("n_words", T.LongType()), T.StructField("n_tokens", T.LongType())],
                       keep, text, SLICE)
